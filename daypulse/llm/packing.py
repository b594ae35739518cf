"""Best-fit packing by minimum bin slack.

Only counts of lengths (at most one per token of capacity) reach the driver.
There, each bin starts with the longest length left, a bitset subset-sum over
the lengths left finds the fullest feasible filling, and that combination is
taken as often as its scarcest length allows.  The plan is a short list of
ranges "the items of length L ranked r to s go to these bins at this offset";
tasks look their items up in it.  Texts and tokens are never shuffled.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypulse.llm.common import chunks, cut

#: Different pieces of text whose ids a Python worker keeps at most (about 230 bytes each).
CACHE = 500_000
#: Bytes of text that are encoded at a time.
BLOCK = 1 << 20
#: The space and line end bytes in the names of the vocabulary's tokens.
SPACE_BYTE, LINE_BYTE = "\u0120", "\u010a"
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
#: White space in any library's sense.
INNER_SPACE = re.compile(r"[\s\x1c-\x1f\x85]")
# Fixed value: the pattern by which a byte-level tokenizer file with "use_regex" parts a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_names() -> dict[str, int]:
    """Name of each byte in a byte-level vocabulary: printable ones are themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def rank_encoder(path: str, tokenizer):
    """An encoder by token ranks for the tokenizer file ``path``; None unless it is sure to give the file's ids.

    It is if the file is a plain byte-level BPE whose tokens are numbered in
    the order of its merges: then the merge of lowest number is the token of
    lowest rank.  Encoding by ranks takes a third of the time.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, parting = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and parting.get("type") == "ByteLevel" and parting.get("use_regex", True)
        and not parting.get("add_prefix_space") and not spec.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    )
    vocab, names = tokenizer.get_vocab(with_added_tokens=False), _byte_names()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]] if plain else []
    if not plain or any(vocab.get("".join(m)) != 256 + i for i, m in enumerate(pairs)) or len(vocab) != 256 + len(pairs):
        return None
    ranks = {bytes(names[c] for c in token): i for token, i in vocab.items()}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The vocabulary's pattern never lets a token run over the place before a
    space that a non-space follows, so a text without double spaces is cut at
    its spaces and the parts, most of them seen before, are looked up.  Within
    runs of white space a token of the vocabulary can run over a space (as that
    of space, U+00A0, space, U+00A0 does): a text that holds one is not cut.
    A text that holds an added token goes to the tokenizer itself.  Unseen
    parts are joined by line ends, which are tokens of their own between
    parts without white space inside, and encoded in one call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.loaded = path, None
        tokenizer = self.tokenizer
        self.ranks = rank_encoder(path, tokenizer)
        self.known: dict[str, bytes] = {}
        vocab = tokenizer.get_vocab(with_added_tokens=False)
        self.line_end = vocab.get(LINE_BYTE)
        # texts of the tokens with a space byte after their first place; bytes of a part of a character at their ends are left out
        over = [i for t, i in vocab.items() if SPACE_BYTE in t[1:]]
        texts = sorted({tokenizer.decode([i]).strip("\ufffd") for i in over}, key=len)
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        if self.ranks:
            self.loaded = None  # not needed any more; a worker keeps the encoder for all its tasks
        self.uncut = ["  ", *(t for k, t in enumerate(texts) if not any(x in t for x in texts[:k]))]

    @property
    def tokenizer(self):
        if self.loaded is None:
            from tokenizers import Tokenizer

            self.loaded = Tokenizer.from_file(self.path)
        return self.loaded

    def _whole(self, texts: list[str], ranks: bool = True) -> list[bytes]:
        if self.ranks and ranks:
            done = map(self.ranks.encode_ordinary, texts)
        else:
            done = (e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))
        return [array("I", ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes() for ids in done]

    def _learn(self, parts: list[str]) -> None:
        """Keep the ids of unseen parts."""
        apart = [p for p in parts if not p.strip() or INNER_SPACE.search(p, p[0] == " ")] if self.line_end is not None else parts
        self.known.update(zip(apart, self._whole(apart)))
        plain = [p for p in parts if p not in self.known] if apart else parts
        groups = [plain[k : k + 500] for k in range(0, len(plain), 500)]
        for group, ids in zip(groups, self._whole(["\n".join(g) for g in groups])):
            ends = (4 * np.flatnonzero(np.frombuffer(ids, "<u4") == self.line_end)).tolist()
            for part, lo, hi in zip(group, [-4, *ends], [*ends, len(ids)]):
                self.known[part] = ids[lo + 4 : hi]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        out, cut, split = [b""] * len(texts), [], []
        whole = [k for k, t in enumerate(texts) if any(x in t for x in self.uncut)]
        special = [k for k, t in enumerate(texts) if any(x in t for x in self.added)]  # their ids are no ranks
        whole = sorted(set(whole) - set(special))
        for some, ranks in ((whole, True), (special, False)):
            for k, ids in zip(some, self._whole([texts[k] for k in some], ranks)):
                out[k] = ids
        for k in sorted(set(range(len(texts))) - set(whole) - set(special)):
            parts = texts[k].split(" ")
            parts[1:] = [" " + p for p in parts[1:]]
            cut.append(k)
            split.append(parts)
        known = self.known
        new = {p for parts in split for p in parts if p not in known}
        if len(known) + len(new) > CACHE:
            known.clear()
            new = {p for parts in split for p in parts}
        self._learn(list(new))
        for k, parts in zip(cut, split):
            out[k] = b"".join(map(known.__getitem__, parts))
        return out

    def __call__(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def shared_encoder(path: str) -> Encoder:
    """The worker's encoder for ``path``: it lives as long as the Python worker, over all its tasks."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_shared_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The fullest combination of at most ``counts`` items per length that fits into ``room``."""
    reach, steps, full = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            part = min(part, left)
            steps.append((length, part, reach))
            reach = (reach | reach << (length * part)) & full
            left, part = left - part, part * 2
        if reach >> room & 1:
            break
    best, take = reach.bit_length() - 1, {}
    for length, part, before in reversed(steps):
        if not before >> best & 1:
            take[length] = take.get(length, 0) + part
            best -= length * part
    return take


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Ranges (length, first rank, first bin, items per bin, offset) for all items, and the number of bins."""
    left = {k: v for k, v in counts.items() if v}
    rank, bins, out = dict.fromkeys(left, 0), 0, []
    while left:
        longest = max(left)
        left[longest] -= 1
        take = fill(left, capacity - longest)
        left[longest] += 1
        take[longest] = take.get(longest, 0) + 1
        copies = min(left[x] // n for x, n in take.items())
        offset = 0
        for x, n in sorted(take.items(), reverse=True):
            out.append((x, rank[x], bins, n, offset))
            rank[x] += n * copies
            offset += x * n
            left[x] -= n * copies
            if not left[x]:
                del left[x]
        bins += copies
    return out, bins


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and task/idx: its place among its task's pieces of that length."""
    stop = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode, task, seen = shared_encoder(tokenizer_path), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for b in batches:
            cols = [[] for _ in range(6)]
            ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            encoded = (x for lo, hi in chunks(texts, BLOCK) for x in encode.encode_all(texts[lo:hi]))
            for i, own in zip(ids, encoded):
                tokens = memoryview(own + stop)
                total = len(tokens) // 4
                start, piece = 0, 0
                while start < total:
                    n = (total - start) % capacity or capacity
                    crc = zlib.crc32(tokens[4 * start : 4 * (start + n)])
                    for c, v in zip(cols, (i, piece, start, n, crc, seen[n])):
                        c.append(v)
                    seen[n] += 1
                    start, piece = start + n, piece + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(cols, types)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array([task] * len(cols[0]), pa.int32())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "idx", "task"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, idx long, task int"
    )


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece with sequence_id and offset.

    ``docs`` needs ``doc_id`` and ``text`` (null: empty); other columns are
    ignored.  A document is its token ids and ``end_id``, so an empty one is a
    piece of length 1.  Only documents over ``capacity`` are cut, into pieces
    of ``capacity`` with the shorter rest first.  Repeated rows and null ids
    are packed like any others; no rows give no rows.  Every sequence holds at
    most ``capacity`` tokens, without gaps from offset 0.
    """
    items = cut(pieces(docs, tokenizer_path, capacity, end_id))
    part = items.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = cut(part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    counts = {r["length"]: r["n"] for r in base.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one per length
    ranges, _ = plan(counts, capacity)
    ranges.sort()
    size, first, bins, per, offset = (np.array([r[k] for r in ranges], np.int64) for k in range(5))
    lo = np.searchsorted(size, np.arange(capacity + 2))

    def place(batches):
        for b in batches:
            names = b.schema.names
            length = b.column(names.index("length")).to_numpy()
            rank = b.column(names.index("rank")).to_numpy()
            at = np.empty(len(length), np.int64)
            for x in np.unique(length):
                own = length == x
                at[own] = lo[x] + np.searchsorted(first[lo[x] : lo[x + 1]], rank[own], "right") - 1
            over = rank - first[at]
            new = [pa.array(bins[at] + over // per[at]), pa.array(offset[at] + over % per[at] * length)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *new], [*names[:-1], "sequence_id", "offset"])

    ranked = items.join(base.select("length", "task", "base"), ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("idx")).alias("rank")
    )
    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
