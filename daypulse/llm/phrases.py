"""Collocations: frequent phrases of two to ``longest`` words whose parts meet more often than by chance.

Counting goes level by level.  The frequent phrases of L-1 words are laid into
double-array tries, each of at most :data:`SHARD` phrases, and broadcast.  In a
task numpy moves the states of all text positions through the trie at the same
time, one word a step.  A phrase of L words can only be frequent if its first
and its last L-1 words are, so the positions whose own state and whose
neighbour's state both accept are the candidates; their occurrences are
counted by ``bincount`` and the counts of all tasks are summed by Spark.  (A
join of the frequent phrases on their overlap would be the same rule, but
pairs up every word before a common word with every word after it.)

If the phrases of a level need more than one trie, each trie is one more pass
over the texts and only the first L-1 words are tested: more rows, the same
counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypulse.llm.common import Words, byte_texts, chunks, cut, mix
from daypulse.llm.hashing import word_hashes

#: Phrases of one trie at most: the bound of what is broadcast (and fetched to build it).
SHARD = 1 << 19
#: Slots of a trie that are searched at a time; children from which a node is placed on its own.
WINDOW, MANY = 4096, 64
#: Languages whose counts are broadcast at most; beyond it the join shuffles.
LANGUAGES = 100_000
#: Parts of a language whose best phrases are found apart first.
PARTS = 64
#: Bytes of text that a task takes at a time.
BLOCK = 4 << 20
#: Language of texts without one.
UNKNOWN = "und"

_BREAK = np.zeros(256, bool)  # bytes that end a piece
_BREAK[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False


class Trie:
    """Double-array trie over 64-bit word hashes: node s has the child base[s] + symbol if that slot's check is s."""

    def __init__(self, ids: np.ndarray, phrases: np.ndarray):
        """``phrases``: one row of word hashes per phrase, all of one length; ``ids``: what their states accept."""
        self.words, flat = np.unique(phrases, return_inverse=True)
        symbols = flat.reshape(phrases.shape).astype(np.int64) + 1
        order = np.lexsort(symbols.T[::-1])
        ids, symbols = ids[order], symbols[order]
        size = 2 + len(self.words)
        self.base, self.check, self.front = np.zeros(size, np.int32), np.full(size, -1, np.int32), 1
        self.check[0] = -2
        state = np.zeros(len(symbols), np.int64)
        for depth in range(symbols.shape[1]):
            state = self._children(state, symbols[:, depth])
        self.accept = np.full(len(self.base), -1, np.int64)
        self.accept[state] = ids

    def _grow(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, 9 * len(self.base) // 8) - len(self.base)
            self.base = np.concatenate((self.base, np.zeros(more, np.int32)))
            self.check = np.concatenate((self.check, np.full(more, -1, np.int32)))

    def _children(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Place the children of a level (sorted by parent's phrase, then symbol); the child of each row.

        Nodes with many children are placed one by one, the largest first;
        those with a few all at once at random slots, again and again for
        those that hit a taken one; single children fill the gaps.
        """
        new = np.ones(len(state), bool)
        new[1:] = (np.diff(state) != 0) | (np.diff(symbol) != 0)
        parent, child = state[new], symbol[new]
        starts = np.flatnonzero(np.append(True, np.diff(parent) != 0))
        sizes = np.diff(np.append(starts, len(parent)))
        placed = np.empty(len(parent), np.int64)
        for k in np.argsort(-sizes, kind="stable")[: int((sizes > MANY).sum())].tolist():
            lo, hi = int(starts[k]), int(starts[k] + sizes[k])
            placed[lo:hi] = self._first_fit(child[lo:hi] - child[lo]) + child[lo:hi] - child[lo]
            self._claim(parent[lo:hi], child[lo:hi], placed[lo:hi])
        self._grow(self.front + 4 * int(sizes[sizes <= MANY].sum()))
        top = MANY
        while top > 1:
            some = np.flatnonzero((sizes <= top) & (sizes > top // 2))
            self._scatter(parent, child, starts[some], sizes[some], placed)
            top //= 2
        one = starts[sizes == 1]
        free = 1 + np.flatnonzero(self.check[1:] == -1)
        if len(free) < len(one):
            size = len(self.check)
            self._grow(size + len(one))
            free = np.concatenate((free, np.arange(size, len(self.check))))
        placed[one] = free[: len(one)]
        self._claim(parent[one], child[one], placed[one])
        return placed[np.cumsum(new) - 1]

    def _claim(self, parent: np.ndarray, child: np.ndarray, slot: np.ndarray) -> None:
        self.check[slot] = parent
        self.base[parent] = slot - child

    def _first_fit(self, offsets: np.ndarray) -> int:
        """The first free slot at which all children fit, looked for a window at a time."""
        window = self.front
        while True:
            self._grow(window + WINDOW + int(offsets[-1]) + 1)
            free = window + np.flatnonzero(self.check[window : window + WINDOW] == -1)
            if window == self.front and len(free) < WINDOW // 8:
                self.front += WINDOW  # as good as full
            for part in (free[:8], free[8:]):
                for o in range(1, len(offsets), 64):
                    if not len(part):
                        break
                    part = part[(self.check[part[:, None] + offsets[o : o + 64]] == -1).all(axis=1)]
                if len(part):
                    return int(part[0])
            window += WINDOW

    def _scatter(self, parent: np.ndarray, child: np.ndarray, starts: np.ndarray, sizes: np.ndarray, placed: np.ndarray) -> None:
        """Place nodes with a few children each at random slots."""
        rng = np.random.default_rng(len(starts))
        reach = int((child[starts + sizes - 1] - child[starts]).max()) + 1 if len(starts) else 0
        while len(starts):
            self._grow(self.front + 2 * reach)
            bounds = np.cumsum(sizes) - sizes
            rows = np.arange(int(sizes.sum())) + np.repeat(starts - bounds, sizes)
            slot = rng.integers(self.front, len(self.check) - reach, len(starts))
            at = np.repeat(slot, sizes) + child[rows] - np.repeat(child[starts], sizes)
            order = np.argsort(at, kind="stable")
            taken = self.check[at] != -1
            taken[order[1:]] |= at[order[1:]] == at[order[:-1]]
            ok = ~np.logical_or.reduceat(taken, bounds)
            good = np.repeat(ok, sizes)
            placed[rows[good]] = at[good]
            self._claim(parent[rows[good]], child[rows[good]], at[good])
            if ok.mean() < 0.1:
                self._grow(len(self.check) + 4 * int(sizes.sum()))
            starts, sizes = starts[~ok], sizes[~ok]

    def states(self, words: np.ndarray, piece: np.ndarray, steps: int) -> np.ndarray:
        """What the phrase of ``steps`` words from each place on accepts (-1: nothing), never over the end of a piece."""
        found = np.full(len(words), -1, np.int64)
        if len(words) < steps:
            return found
        symbol = np.searchsorted(self.words, words)
        symbol[symbol == len(self.words)] = 0
        symbol = np.where(self.words[symbol] == words, symbol + 1, 0)
        at = np.flatnonzero((symbol[: len(words) - steps + 1] > 0) & (piece[: len(words) - steps + 1] == piece[steps - 1 :]))
        state = np.zeros(len(at), np.int64)
        for k in range(steps):
            c = symbol[at + k]
            to = self.base[state] + c
            ok = (c > 0) & (to > 0) & (to < len(self.check))
            ok[ok] = self.check[to[ok]] == state[ok]
            at, state = at[ok], to[ok]
        found[at] = self.accept[state]
        return found


def _read(texts: list[bytes], langs: list[str | None]) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of lower-cased texts, their hashes (apart for each language) and the piece of each."""
    words = Words([t.lower() for t in texts], _WORD)
    salt = np.array([xxhash.xxh64_intdigest((x or UNKNOWN).encode()) for x in langs], np.uint64)
    hashes = mix(word_hashes(words) ^ salt[words.doc]) if len(words.doc) else np.zeros(0, np.uint64)
    piece = np.cumsum(_BREAK[words.buf], dtype=np.int64)[words.start] if len(words.start) else np.zeros(0, np.int64)
    return words, hashes.view(np.int64), piece


def _blocks(batches):
    for b in batches:
        langs, texts = b.column(0).to_pylist(), byte_texts(b.column(1))
        for lo, hi in chunks(texts, BLOCK):
            yield _read(texts[lo:hi], langs[lo:hi]), langs[lo:hi]


def _count_words(batches):
    """lang, word, h, f of the words of each block; a row without word and h holds all words of a language."""
    for (words, h, _), langs in _blocks(batches):
        if not len(h):
            continue
        _, first, times = np.unique(h, return_index=True, return_counts=True)
        own = [langs[d] or UNKNOWN for d in words.doc[first].tolist()]
        buf = words.buf.tobytes()
        text = [buf[a:z].decode("utf-8", "replace") for a, z in zip(words.start[first].tolist(), words.end[first].tolist())]
        names = sorted(set(own))
        total = np.bincount([names.index(x) for x in own], weights=times).astype(np.int64) if names else []
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(own + names, pa.string()), pa.array(text + [None] * len(names), pa.string()),
                pa.array(h[first].tolist() + [None] * len(names), pa.int64()), pa.array(times.tolist() + list(total), pa.int64()),
            ],
            ["lang", "word", "h", "f"],
        )


def _count_longer(trie, steps: int, alone: bool):
    """id, h, f: how often the accepted phrase ``id`` of ``steps`` words is followed by the word ``h``."""

    def run(batches):
        tree = trie.value
        for (_, h, piece), _ in _blocks(batches):
            state = tree.states(h, piece, steps)
            safe = (state[:-steps] >= 0) & (piece[:-steps] == piece[steps:]) if len(h) > steps else np.zeros(0, bool)
            if alone:  # the one trie knows the last words too
                safe &= state[1 : len(state) - steps + 1] >= 0
            at = np.flatnonzero(safe)
            if not len(at):
                continue
            last, which = np.unique(h[at + steps], return_inverse=True)
            heads, head = np.unique(state[at], return_inverse=True)
            pair, place = np.unique(head * len(last) + which, return_inverse=True)
            times = np.bincount(place, minlength=len(pair))
            yield pa.RecordBatch.from_arrays(
                [pa.array(heads[pair // len(last)]), pa.array(last[pair % len(last)]), pa.array(times.astype(np.int64))], ["id", "h", "f"]
            )

    return run


def _tries(phrases: DataFrame, length: int):
    """The tries of the phrases (id, words), one at a time, and their number."""
    total = phrases.count()
    shards = -(-total // SHARD)  # none for no phrases
    for k in range(shards):
        part = phrases.where(F.pmod(F.xxhash64("id"), F.lit(shards)) == k).select("id", "words").toArrow()  # about SHARD rows
        words = part.column("words").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
        yield Trie(part.column("id").to_numpy(), words), shards == 1


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """Words (lang, word, h, f; word null: all words of the language) and phrases (id, words, f) of ``least`` occurrences.

    ``words`` are the hashes ``h`` of a phrase's words, one for a single word;
    ``id`` tells phrases of one length apart.
    See :func:`collocations` for texts, languages and pieces.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("lang").cast("string"), F.col("text").cast("string"))
    counted = own.mapInArrow(_count_words, "lang string, word string, h long, f long")
    words = cut(counted.groupBy("lang", "word", "h").agg(F.sum("f").alias("f")).where(F.col("word").isNull() | (F.col("f") >= least)))
    level = cut(
        words.where("word is not null").select(F.monotonically_increasing_id().alias("id"), F.array("h").alias("words"), "f")
    )
    found = level
    for length in range(2, longest + 1):
        parts = []
        for trie, alone in _tries(level, length - 1):
            sent = spark.sparkContext.broadcast(trie)
            pairs = own.mapInArrow(_count_longer(sent, length - 1, alone), "id long, h long, f long")
            summed = pairs.groupBy("id", "h").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
            parts.append(cut(summed))
            sent.unpersist()
        if not parts:
            break
        longer = parts[0]
        for p in parts[1:]:
            longer = longer.unionByName(p)
        heads = level.select("id", "words")
        level = cut(
            longer.join(heads, "id").select(
                F.monotonically_increasing_id().alias("id"), F.concat("words", F.array("h")).alias("words"), F.col("f")
            )
        )
        found = found.unionByName(level)
    return words, found


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, best: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``best`` phrases.

    ``docs`` needs ``lang`` (null: ``und``) and ``text`` (null: empty); other
    columns are ignored, and every row counts, repeated ones too.  Texts are
    lower-cased (A-Z), parted at ``.,;:!?`` and line ends into pieces and at
    spaces and tabs into words; a phrase never runs over a piece's end.  n
    counts a language's words and a the occurrences of a phrase, overlapping
    ones too.  Candidates have 2 to ``longest`` words and ``least``
    occurrences.  A cut into a first part with l and a rest with r occurrences
    scores floor(1000 a n / (l r)), in exact decimals; a phrase has its lowest
    score (ties: the shortest first part).  Candidates within a longer
    candidate of as many occurrences are dropped.  Order: score, then a,
    descending, then the phrase by bytes.  No rows or no candidates: no rows.
    """
    words, phrases = frequent_phrases(docs, least, longest)
    several = cut(phrases.where(F.size("words") > 1).withColumn("id", F.monotonically_increasing_id()))  # ids of all lengths
    counts = phrases.select(F.col("words").alias("part"), F.col("f").alias("part_f"))
    cuts = several.select("id", "words", "f", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    first, rest = F.slice("words", 1, F.col("k")), F.expr("slice(words, k + 1, size(words) - k)")
    left = cuts.withColumn("part", first).join(counts, "part").withColumnRenamed("part_f", "l").drop("part")
    both = left.withColumn("part", rest).join(counts, "part").withColumnRenamed("part_f", "r").drop("part")
    names = words.where("word is not null").select("h", "lang", "word")
    totals = words.where("word is null").select("lang", F.col("f").alias("n"))
    totals = F.broadcast(totals) if totals.count() <= LANGUAGES else totals
    placed = several.select("id", F.posexplode("words").alias("at", "h")).join(names, "h")
    spelled = placed.groupBy("id", "lang").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w")).select(  # ``longest`` words
        "id", "lang", F.array_join(F.col("w.word"), " ").alias("phrase")
    )
    big = "decimal(38,0)"
    wide = {c: F.col(c).cast(big) for c in ("l", "r", "n")}
    product = (F.lit(1000).cast(big) * F.col("f").cast(big)).cast(big) * wide["n"]
    scored = (
        both.join(spelled, "id").join(totals, "lang")
        .withColumn("above", product.cast(big)).withColumn("below", (wide["l"] * wide["r"]).cast(big))
        .withColumn("score", F.expr("above div below"))
    )
    lowest = scored.groupBy("id", "lang", "phrase", "words", "n", F.col("f").alias("a")).agg(
        F.min(F.struct("score", "k", "l", "r")).alias("low")  # at most ``longest`` - 1 cuts
    )
    inside = several.where(F.size("words") > 2).select(
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size(words) - 1), w -> transform(sequence(1, size(words) - w + 1), i -> slice(words, i, w))))"
            )
        ).alias("words"), F.col("f").alias("a"),
    )
    kept = lowest.join(inside.distinct(), ["words", "a"], "left_anti")
    flat = kept.select("lang", "phrase", "a", F.col("low.l").alias("l"), F.col("low.r").alias("r"), "n", F.col("low.score").alias("score"))
    best_first = F.desc("score"), F.desc("a"), F.col("phrase")
    apart = Window.partitionBy("lang", "part").orderBy(*best_first)
    parts = flat.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    few = parts.withColumn("place", F.row_number().over(apart)).where(F.col("place") <= best)
    whole = Window.partitionBy("lang").orderBy(*best_first)
    return few.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= best).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
