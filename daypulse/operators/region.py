"""Region map, sales bars and array terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.functions.scalar import value_bin
from daypulse.sources.tables import read_table

# Terms aggregation returns the top ten buckets by document count (fixed).
DEFAULT_TERMS = 10


def region_sales(spark: SparkSession, base: str) -> DataFrame:
    """A12 + J4: orders and amount per nation, every nation kept -> (name, value, amount).

    Orders are pre-aggregated per customer (map-side partial aggregate, so a
    hot customer collapses early), joined to customer for the nation, summed
    per nation, and joined to the nation spine (zero where no orders); the
    planner broadcasts the aggregate if it stays small.
    """
    orders = read_table(spark, "orders", base).select(
        "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    per_cust = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("amt"))
    customer = read_table(spark, "customer", base).select("c_custkey", "c_nationkey")
    per_nation = (per_cust.join(customer, F.col("o_custkey") == F.col("c_custkey"))
                  .groupBy("c_nationkey").agg(F.sum("n").alias("n"), F.sum("amt").alias("amt")))
    nation = read_table(spark, "nation", base).select("n_nationkey", "n_name")
    out = nation.join(per_nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.select(
        F.col("n_name").alias("name"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("value"),
        F.coalesce(F.col("amt"), F.lit(0)).cast("decimal(18,2)").cast("double").alias("amount"),
    )


def region_bins(regions: DataFrame, value: str = "value") -> DataFrame:
    """legend bin 0..5 of each region's value -> (name, value, bin)."""
    return regions.select("name", value, value_bin(value).alias("bin"))


def sales_by_name(spark: SparkSession, base: str) -> DataFrame:
    """Quantity sold per product name -> (name, num).

    lineitem is summed per part key first (partial aggregate), then joined to
    part and summed per name.
    """
    li = read_table(spark, "lineitem", base).select("l_partkey", "l_quantity")
    per_part = li.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    part = read_table(spark, "part", base).select("p_partkey", "p_name")
    return (per_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(F.col("p_name").alias("name"))
            .agg(F.sum("q").cast("bigint").alias("num")))


def array_terms(docs: DataFrame, array_col: str, k: int | None = DEFAULT_TERMS) -> DataFrame:
    """A14 + L2: documents per array element -> (term, doc_count), top ``k``.

    A document counts once per distinct element (``array_distinct``).  The
    count is a partial + final hash aggregate; ``k`` keeps the top buckets by
    count, ties by term.  ``k=None`` returns every term.
    """
    terms = docs.select(F.explode(F.array_distinct(F.col(array_col))).alias("term"))
    out = terms.groupBy("term").agg(F.count(F.lit(1)).alias("doc_count"))
    if k is not None:
        out = out.orderBy(F.desc("doc_count"), F.asc("term")).limit(k)
    return out


def product_name_terms(spark: SparkSession, base: str, k: int | None = DEFAULT_TERMS) -> DataFrame:
    """A14 over the product table: words of ``p_name`` as the array field."""
    part = read_table(spark, "part", base).select(F.split("p_name", " ").alias("words"))
    return array_terms(part, "words", k)
