"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

A fixed mask keeps some words of a short stretch and ignores the rest.  Hashes
of the kept words of test and training texts are joined; a hit fixes how the
two texts lie against each other.  Around each hit the words are compared one
by one: an overlap is a window of up to ``WINDOW`` test words of which at
least ``SHARE`` stand at the same place of the document.  ``MASKS`` leave no
such window without a hit, for every test text of at least ``SHORTEST`` words,
wherever the substitutions are (``tests/llm`` tries all their patterns).
Shorter test texts are looked for word for word, by one hash of all their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypulse.llm.common import cut

#: Kept places of each mask.
MASKS = ((0, 1, 2, 3), (0, 2, 3, 4))
WINDOW, SHARE, SHORTEST = 16, 0.8, 8
#: Thai, Lao, Myanmar, Khmer, the Tai scripts, kana and Han; all lie from U+0E00 on.
UNSPACED = (
    r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{1950}-\x{19FF}\x{1A20}-\x{1AAF}\x{3005}-\x{3007}\x{3040}-\x{30FF}\x{31F0}-\x{31FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{A9E0}-\x{A9FF}\x{AA60}-\x{AADF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{1AFF0}-\x{1B16F}\x{20000}-\x{3FFFF}"
)
#: Seeds of test texts that are broadcast at most; more are joined by a shuffle.
BROADCAST_SEEDS = 1_000_000


def words_of(text: Column) -> Column:
    """Lower-case words: runs of letters and digits; in scripts written without spaces each letter is a word."""
    low = F.lower(text)
    apart = rf"[^\p{{L}}\p{{N}}]+|(?<=[{UNSPACED}])(?=[\p{{L}}\p{{N}}])|(?<=[\p{{L}}\p{{N}}])(?=[{UNSPACED}])"
    return F.when(low.rlike(r"[\x{0E00}-\x{10FFFF}]"), F.split(low, apart)).otherwise(F.split(low, r"[^\p{L}\p{N}]+"))


def _seeds(words: str) -> Column:
    """An array of (mask, hash) for each place of the array column ``words`` where the mask fits."""
    w = F.col(words)

    def of(k: int, mask: tuple[int, ...]) -> Column:
        span = mask[-1] + 1
        fits = F.slice(w, F.lit(1), F.greatest(F.size(w) - span + 1, F.lit(0)))
        return F.transform(fits, lambda x, i: F.xxhash64(F.lit(k), x, *(F.get(w, i + p) for p in mask[1:])))

    return F.array(*(of(k, m) for k, m in enumerate(MASKS)))


def _placed(rows: DataFrame, *keys: str) -> DataFrame:
    by_mask = rows.select(*keys, F.explode(_seeds("words")).alias("hashes"))
    return by_mask.select(*keys, F.posexplode("hashes").alias("at", "seed"))


def _small(seeds: DataFrame) -> DataFrame:
    return F.broadcast(seeds) if seeds.count() <= BROADCAST_SEEDS else seeds


def _rows(docs: DataFrame) -> DataFrame:
    """``docs`` with an id of each row, which stays the same however often the result is read."""
    return cut(docs.withColumn("row", F.monotonically_increasing_id()))


def _short(rows: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """Test texts of ``sizes`` words, all under ``SHORTEST``, that stand word for word in a row: one hash of all words is joined."""
    w = F.col("words")

    def of(n: int) -> Column:
        fits = F.slice(w, F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(0)))
        return F.transform(fits, lambda x, i: F.xxhash64(F.lit(n), x, *(F.get(w, i + p) for p in range(1, n))))

    # places beyond the last word are null, which adds nothing to a hash
    own = F.xxhash64(F.size(w), *(F.get(w, F.lit(p)) for p in range(SHORTEST - 1)))
    seeds = items.where(F.size(w) < SHORTEST).select("item", "item_id", F.size(w).alias("span"), own.alias("seed"))
    by_size = rows.select("row", "doc_id", words_of(F.col("text")).alias("words")).select(
        "row", "doc_id", F.explode(F.array(*map(of, sizes))).alias("hashes")
    )
    hits = by_size.select("row", "doc_id", F.posexplode("hashes").alias("at", "seed")).join(_small(seeds), "seed")
    return hits.groupBy("row", "doc_id", "item", "item_id", "span").agg(F.max("at").alias("at")).select(
        "row", "doc_id", "item", "item_id", F.struct(F.col("span").alias("matched"), F.col("at").alias("start")).alias("best"), "span"
    )


def _found(rows: DataFrame, benchmark: DataFrame, every: bool) -> DataFrame:
    """row, doc_id, item, item_id, best (matched, start) and span of each overlap; ``rows`` needs row, doc_id and text."""
    items = (
        benchmark.select("item_id", F.filter(words_of(F.col("text").cast("string")), lambda x: x != "").alias("words"))
        .where(F.size("words") >= (1 if every else SHORTEST))
        .groupBy("words").agg(F.min("item_id").alias("item_id"))
    )
    items = cut(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "words"))
    named = rows.select("row", "doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    if not every:
        named = named.where("doc_id is not null")
    long = items.where(F.size("words") >= SHORTEST)
    seeds = _small(_placed(long, "item").select("item", F.col("at").alias("item_at"), "seed"))
    hits = _placed(named.select("row", words_of(F.col("text")).alias("words")), "row").join(seeds, "seed")
    lies = hits.select("row", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()

    span = F.least(F.size("test"), F.lit(WINDOW))
    # the words are split once a row: as the one element of an array they are a variable of the inner functions
    compared = F.transform(
        F.array(words_of(F.col("text"))),
        lambda w: F.transform("test", lambda x, i: F.coalesce((F.get(w, F.col("shift") + i) == x).cast("int"), F.lit(0))),
    )
    count = F.transform(
        F.sequence(F.lit(0), F.size("equal") - F.col("span")),
        lambda s: F.struct(
            F.aggregate(F.slice("equal", s + 1, F.col("span")), F.lit(0), lambda a, b: a + b).alias("matched"),
            (F.col("shift") + s).alias("start"),
        ),
    )
    test = long.select("item", "item_id", F.col("words").alias("test"))
    beside = (
        named.join(lies, "row").join(test, "item")
        .select("row", "doc_id", "item", "item_id", "shift", span.alias("span"), F.explode(compared).alias("equal"))
        .select("row", "doc_id", "item", "item_id", F.array_max(count).alias("best"), "span")
        .where(F.col("best.matched") >= F.ceil(F.lit(SHARE) * F.col("span")))
    )
    few = items.where(F.size("words") < SHORTEST).select(F.size("words").alias("n")).distinct()
    sizes = sorted(r["n"] for r in few.collect())  # under SHORTEST rows
    return beside.unionByName(_short(named, items, sizes)) if sizes else beside


def overlaps(docs: DataFrame, benchmark: DataFrame, every: bool = False) -> DataFrame:
    """doc_id, item_id, matched, window, start: the best overlap of each document with each test text.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other
    columns are ignored.  matched of ``window`` consecutive test words stand
    in the document from word ``start`` (from 0) on.  Null and empty texts
    overlap nothing.  Equal test texts are reported by their smallest item_id
    (null if none has one), and rows that repeat a doc_id once, with the best
    of them.  With ``every``, test texts under ``SHORTEST`` words are found
    where all their words stand in a row, and rows with a null doc_id are
    reported each by itself; without it, both take no part.
    """
    found = _found(_rows(docs.select("doc_id", "text")), benchmark, every)
    nameless = F.when(F.col("doc_id").isNull(), F.col("row")).alias("nameless")
    return found.groupBy("doc_id", nameless, "item", "item_id").agg(F.max("best").alias("best"), F.max("span").alias("window")).select(
        "doc_id", "item_id", F.col("best.matched").alias("matched"), "window", F.col("best.start").alias("start")
    )


def clean(docs: DataFrame, benchmark: DataFrame, every: bool = False) -> DataFrame:
    """The rows of ``docs`` that overlap no test text, with all their columns; each row is judged by its own text.

    ``every`` is that of :func:`overlaps`; without it, rows with a null doc_id stay.
    """
    rows = _rows(docs.select(F.struct(*docs.columns).alias("all")))
    leaked = _found(rows.select("row", "all.doc_id", "all.text"), benchmark, every).select(F.col("row").alias("leaked")).distinct()
    return rows.select("row", "all").join(leaked, F.col("row") == F.col("leaked"), "left_anti").select("all.*")
