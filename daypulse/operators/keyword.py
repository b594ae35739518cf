"""Keyword index for the detail search (P2): postings of one to three letters.

``contains(name, keyword)`` reads every name.  The index holds, for every run
of one, two or three characters, the ids of the names with it.  A keyword of up
to three characters is one posting list; a longer one can only be in a name
that has all its three-letter runs, so their lists are intersected and the few
names left are compared.  Stored bucketed and sorted by the run, a search reads
only the buckets of its own runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LONGEST = 3  # characters of the longest run


def _runs(text: Column, sizes: Column) -> Column:
    """The distinct runs of ``text`` of each of the lengths ``sizes`` (an array)."""
    of = lambda n: F.transform(
        F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n))
    fits = F.filter(sizes, lambda n: F.length(text) >= n)
    return F.array_distinct(F.flatten(F.transform(fits, of)))


def build_index(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(gram, id): every run of up to ``LONGEST`` characters of the lower-cased texts; NULL and empty texts have none."""
    text = F.lower(F.col(text_col))
    sizes = F.sequence(F.lit(1), F.lit(LONGEST))
    return items.filter(F.length(text) > 0).select(F.explode(_runs(text, sizes)).alias("gram"), F.col(id_col).alias("id"))


def store_index(index: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Write an index as a catalog table bucketed and sorted by ``gram``."""
    writer = index.write.mode("overwrite").format("parquet").bucketBy(buckets, "gram").sortBy("gram")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def grams_of(keyword: str) -> list[str]:
    """The runs that every text with the keyword has: itself, or its runs of ``LONGEST`` characters."""
    word = keyword.lower()
    if len(word) <= LONGEST:
        return [word]
    return sorted({word[i:i + LONGEST] for i in range(len(word) - LONGEST + 1)})


def candidates(index: DataFrame, keyword: str) -> DataFrame:
    """(id): the texts that hold all runs of ``keyword``; for up to ``LONGEST`` characters these are the matches."""
    grams = grams_of(keyword)
    hits = index.filter(F.col("gram").isin(grams))  # prunes a bucketed table to the buckets of these runs
    if len(grams) == 1:
        return hits.select("id")
    return hits.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams)).select("id")


def matching(items: DataFrame, index: DataFrame, keyword: str, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``items`` whose text contains ``keyword`` (whatever its case), found through the index."""
    ids = candidates(index, keyword).select(F.col("id").alias("_hit"))
    found = items.join(ids, items[id_col] == F.col("_hit"), "left_semi")
    return found.filter(F.lower(F.col(text_col)).contains(keyword.lower()))


def matches_of_all(spark: SparkSession, items: DataFrame, index: DataFrame, keywords: list[str],
                   id_col: str, text_col: str) -> DataFrame:
    """(keyword, id, text) of several keywords at once: one join of their runs with the index."""
    rows = [(k, g, len(grams_of(k))) for k in sorted(set(keywords)) for g in grams_of(k)]
    asked = spark.createDataFrame(rows, "keyword string, gram string, need int")
    hits = index.join(F.broadcast(asked), "gram").groupBy("keyword", "need", "id").agg(F.count(F.lit(1)).alias("n"))
    texts = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = hits.filter("n = need").join(texts, "id")
    return found.filter(F.contains(F.lower("text"), F.lower("keyword"))).select("keyword", "id", "text")
