"""URL filter: glob rules packed into multiword Shift-And masks.

A rule's pattern is a row of literal characters and ``*`` (any text).  The
literals of all patterns are laid side by side in one bit string; a state bit
is set when its pattern's text up to that literal has been read.  One step of
the automaton shifts every word by one, starts all patterns and keeps the bits
whose literal is the character read; bits before a ``*`` stay set.  The step
is done for all URLs of a batch at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Host globs that the method itself blocks where no rule fits.
BLOCKED_HOSTS = ("*.ads-*", "*.adult-*", "*.casino-*", "*.cheap-pills*", "*.free-bets*", "*.spam-*")


@dataclass(frozen=True)
class Rule:
    """``host`` with all subdomains, and every path that starts with ``path``; both may hold ``*``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}?{self.path}*"


class ShiftAnd:
    """All globs over one text at a time, in words of 64 bits."""

    def __init__(self, globs: list[str]):
        lits, self.final, self.first, self.hold = [], [], [], []
        for g in globs:
            parts = g.split("*")
            at = len(lits)
            for k, part in enumerate(parts):
                for c in part:
                    lits.append(c)
                if k < len(parts) - 1 and len(lits) > at:
                    self.hold.append(len(lits) - 1)
            self.first.append((at, not g.startswith("*")) if len(lits) > at else None)
            self.final.append(len(lits) - 1 if len(lits) > at else None)  # None: only stars
        self.alphabet = {c: i + 1 for i, c in enumerate(sorted(set(lits)))}
        self.words = max(1, -(-len(lits) // 64))
        self.masks = np.zeros((len(self.alphabet) + 1, self.words), np.uint64)
        for b, c in enumerate(lits):
            self.masks[self.alphabet[c], b // 64] |= np.uint64(1 << (b % 64))
        self.starts = self._bits([f[0] for f in self.first if f])  # bits that no shift may reach
        self.anywhere = self._bits([f[0] for f in self.first if f and not f[1]])
        self.held = self._bits(self.hold)

    def _bits(self, places: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for b in places:
            out[b // 64] |= np.uint64(1 << (b % 64))
        return out

    def match(self, texts: list[str]) -> np.ndarray:
        """matched[text, glob]; steps over the characters, longest texts last to leave."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        n, one, top = len(texts), np.uint64(1), np.uint64(63)
        state = np.zeros((n, self.words), np.uint64)
        code = self.alphabet.get
        flat = np.fromiter((code(c, 0) for i in order for c in texts[i]), np.int32)
        lens = np.fromiter((len(texts[i]) for i in order), np.int64, n)
        offs = np.cumsum(lens) - lens
        left = np.sort(lens)
        for p in range(int(lens.max(initial=0))):
            live = n - int(np.searchsorted(left, p, "right"))  # texts longer than p
            d = state[:live]
            shifted = d << one
            shifted[:, 1:] |= d[:, :-1] >> top
            shifted &= ~self.starts
            shifted |= self.starts if p == 0 else self.anywhere
            state[:live] = (shifted & self.masks[flat[offs[:live] + p]]) | (d & self.held)
        out = np.zeros((n, len(self.final)), bool)
        for k, f in enumerate(self.final):
            out[:, k] = True if f is None else (state[:, f // 64] >> np.uint64(f % 64)) & one
        back = np.empty_like(out)
        back[order] = out
        return back


def split_url(url):
    """(host, path) columns of a url column; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: list[Rule], blocked: tuple[str, ...] = BLOCKED_HOSTS) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url).

    Of the rules that fit, the one with the longest name decides (ties: block,
    then the name that sorts first).  Where none fits, rule is null and the
    verdict is block if the host fits one of the ``blocked`` globs, else allow.
    Null urls, and urls without ``://``, have an empty host and path, which no
    rule fits.  Urls of any length are read whole; repeated rows come back
    repeated; other columns of ``pages`` are ignored.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    globs = [r.glob for r in ranked] + [f"{g}?*" for g in blocked]

    def run(batches):
        automaton = ShiftAnd(globs)
        for b in batches:
            hosts, paths = b.column(1).to_pylist(), b.column(2).to_pylist()
            rule, verdict = [], []
            for lo in range(0, len(hosts), 1024):
                hit = automaton.match([f".{h}?{p}" for h, p in zip(hosts[lo : lo + 1024], paths[lo : lo + 1024])])
                own = hit[:, : len(ranked)]
                some = own.any(axis=1) if len(ranked) else np.zeros(len(hit), bool)
                best = own.argmax(axis=1) if len(ranked) else np.zeros(len(hit), int)
                bad = hit[:, len(ranked) :].any(axis=1)
                for s, k, x in zip(some.tolist(), best.tolist(), bad.tolist()):
                    rule.append(ranked[k].name if s else None)
                    verdict.append(ranked[k].verdict if s else "block" if x else "allow")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    host, path = split_url(F.col("url"))
    return pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path")).mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string"
    )
