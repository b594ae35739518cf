"""Order-detail search: wide rows, page + total, age and category shares
(J1, P2, P5, L3, A10, A11, F10, F11, F13, S12).

Wide row (one per order line):
    order_detail_id, order_id, user_id, sku_id, user_gender, user_age,
    user_level, sku_price, sku_name, sku_tm_id, dt

built from ``lineitem`` ⋈ ``orders`` ⋈ ``customer`` ⋈ ``part`` (inner,
equi-joins on foreign keys).  Search filters (day, keyword, user level) are
applied to the dimension *before* the joins, so Catalyst pushes them into the
respective scans.

Shares and totals never materialise the wide row.  Each aggregates the fact
table down to the key of the one dimension whose attribute it needs, and uses
the other dimensions only as semi-join filters:

* category share: lineitem ⋉ parts -> count per order -> ⋈ orders ->
  count per customer -> ⋈ customer -> count per segment;
* age share: lineitem ⋉ orders -> count per part -> ⋈ part -> count per band.

So full lineitem rows (two columns) cross at most one exchange -- the
semi-join key, or none when that side is broadcast -- and every later
exchange carries pre-aggregated rows (hot orders, customers or parts collapse
in the map-side partial aggregate).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daypulse.operators import keyword
from daypulse.functions.scalar import age_band, share_pct
from daypulse.functions.timeparts import day_string
from daypulse.sources.tables import read_table

# Total order of the detail rows for paging (every column; full rows are distinct).
PAGE_ORDER = ("dt", "order_id", "order_detail_id", "sku_id", "user_id", "user_gender",
              "user_age", "user_level", "sku_price", "sku_name", "sku_tm_id")


@dataclass(frozen=True)
class Search:
    """Detail-search arguments (F10): blank keyword / date / level mean "no filter"."""

    date: str | None = None
    keyword: str | None = None
    level: int | None = None

    @staticmethod
    def of(date=None, keyword=None, level=None) -> "Search":
        blank = lambda v: v is None or (isinstance(v, str) and not v.strip())
        return Search(
            None if blank(date) else str(date).strip(),
            None if blank(keyword) else str(keyword).strip(),
            None if blank(level) else int(level),
        )


def user_level(acctbal) -> F.Column:
    """Surrogate user level 1..10: account-balance tier of 1000 (our decision)."""
    return F.least(F.lit(10), F.greatest(F.lit(1), F.ceil(acctbal / 1000))).cast("int")


class DetailTables:
    """Filtered, column-pruned dimension and fact frames for one search."""

    def __init__(self, spark: SparkSession, base: str, search: Search = Search(),
                 reader: Callable[[str], DataFrame] | None = None, index: DataFrame | None = None):
        """``reader(name)`` overrides where tables come from (e.g. bucketed
        catalog tables from ``sources.layout``); default: parquet under ``base``.
        With a keyword ``index`` of the part names, the keyword reads its
        postings instead of every name."""
        self.search = search
        read = reader or (lambda name: read_table(spark, name, base))
        self.lineitem = read("lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
        orders = read("orders").select(
            "o_orderkey", "o_custkey", day_string("o_orderdate").alias("dt"))
        if search.date:
            # comparing the timestamp column keeps the predicate pushable
            d0 = F.to_timestamp(F.lit(search.date), "yyyy-MM-dd")
            orders = orders.filter((F.col("o_orderdate") >= d0)
                                   & (F.col("o_orderdate") < d0 + F.expr("INTERVAL 1 DAY")))
        self.orders = orders
        customer = read("customer").select(
            "c_custkey", F.col("c_mktsegment").alias("user_gender"),
            user_level(F.col("c_acctbal")).alias("user_level"))
        if search.level is not None:
            customer = customer.filter(F.col("user_level") == search.level)
        self.customer = customer
        part = read("part").select(
            "p_partkey", F.col("p_size").alias("user_age"),
            F.col("p_retailprice").alias("sku_price"), F.col("p_name").alias("sku_name"),
            F.col("p_brand").alias("sku_tm_id"))
        if search.keyword and index is not None:
            part = keyword.matching(part, index, search.keyword, "p_partkey", "sku_name")
        elif search.keyword:
            part = part.filter(F.lower(F.col("sku_name")).contains(search.keyword.lower()))
        self.part = part

    def valid_orders(self) -> DataFrame:
        """Orders passing the day filter whose customer passes the level filter."""
        return self.orders.join(self.customer.select("c_custkey"),
                                F.col("o_custkey") == F.col("c_custkey"), "left_semi")


def sale_detail_wide(spark: SparkSession, base: str, search: Search = Search(),
                     reader: Callable[[str], DataFrame] | None = None,
                     index: DataFrame | None = None) -> DataFrame:
    """The wide order-detail rows matching ``search``."""
    return _wide(DetailTables(spark, base, search, reader, index))


def _wide(t: DetailTables) -> DataFrame:
    # no repartition by the order key before the join: only an exchange that the
    # planner adds itself can be split when one order holds many lines
    rows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    )
    return rows.select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("order_detail_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("sku_id"),
        "user_gender", "user_age", "user_level", "sku_price", "sku_name", "sku_tm_id", "dt",
    )


def sale_detail_page(spark: SparkSession, base: str, search: Search = Search(),
                     page: int = 1, size: int = 20,
                     reader: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """P2 + L3: one 1-based page of the search, in a total order over all columns.

    ``orderBy(...).offset(n).limit(size)`` plans as TakeOrderedAndProject: each
    partition keeps only its best ``n + size`` rows, so there is no global sort.
    """
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    wide = sale_detail_wide(spark, base, search, reader)
    return wide.orderBy(*PAGE_ORDER).offset((page - 1) * size).limit(size)


def page_directory(t: DetailTables, width: int) -> DataFrame:
    """L3: (dt, block, n, before): matching lines per block of ``width`` order ids of a day, and those ahead of it.

    Blocks follow the page order (dt, order_id, ...).  Lines are counted per
    order before any join; the running sums go over the day rows and over the
    blocks of one day.
    """
    lines = t.lineitem.join(t.part.select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    orders = t.valid_orders().select("o_orderkey", "dt")
    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    blocks = (per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .groupBy("dt", F.floor(F.col("l_orderkey") / width).alias("block")).agg(F.sum("n").alias("n")))
    ahead = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    days = blocks.groupBy("dt").agg(F.sum("n").alias("n"))
    base = days.select("dt", ahead(Window.orderBy("dt")).alias("base"))  # one row a calendar day
    inner = blocks.withColumn("inner", ahead(Window.partitionBy("dt").orderBy("block")))
    return inner.join(base, "dt").select("dt", "block", "n", (F.col("base") + F.col("inner")).alias("before"))


def sale_detail_jump(spark: SparkSession, base: str, search: Search = Search(),
                     page: int = 1, size: int = 20, width: int = 4096,
                     reader: Callable[[str], DataFrame] | None = None,
                     index: DataFrame | None = None) -> DataFrame:
    """L3: any page of the search, found by the rank directory; equal to :func:`sale_detail_page`.

    The directory gives the blocks that the page lies in; only their orders
    are joined and sorted, so a task keeps at most a block and a page of rows
    however deep the page is.  A page beyond the last has no rows.
    """
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    t = DetailTables(spark, base, search, reader, index)
    lo, hi = (page - 1) * size, page * size
    here = page_directory(t, width).filter((F.col("before") < hi) & (F.col("before") + F.col("n") > lo))
    # one row: the first and the last block of the page
    span = here.agg(F.min(F.struct("dt", "block", "before")).alias("a"), F.max(F.struct("dt", "block")).alias("z")).first()
    if span["a"] is None:
        return _wide(t).limit(0)
    block = F.floor(F.col("o_orderkey") / width)
    place = F.struct(F.col("dt"), block.alias("block"))
    at = lambda r: F.struct(F.lit(r["dt"]).alias("dt"), F.lit(r["block"]).cast("bigint").alias("block"))
    t.orders = t.orders.filter(place.between(at(span["a"]), at(span["z"])))
    return _wide(t).orderBy(*PAGE_ORDER).offset(lo - span["a"]["before"]).limit(size)


def sale_detail_page_after(spark: SparkSession, base: str, search: Search = Search(),
                           after: tuple | None = None, size: int = 20,
                           reader: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """L3 for deep pages: keyset ("seek") paging in the same total order.

    ``after`` is the ``PAGE_ORDER`` tuple of the previous page's last row
    (``None`` for the first page).  Rows strictly after it are filtered with a
    struct comparison and the top ``size`` taken, so each task keeps ``size``
    rows however deep the page -- unlike ``offset``, whose per-task top-k
    grows with the page number.
    """
    if size < 1:
        raise ValueError("size starts at 1")
    wide = sale_detail_wide(spark, base, search, reader)
    if after is not None:
        if len(after) != len(PAGE_ORDER):
            raise ValueError(f"after needs {len(PAGE_ORDER)} values in PAGE_ORDER")
        key = F.struct(*[F.col(c) for c in PAGE_ORDER])
        wide = wide.filter(key > F.struct(*[F.lit(v).cast(wide.schema[c].dataType).alias(c)
                                             for c, v in zip(PAGE_ORDER, after)]))
    return wide.orderBy(*PAGE_ORDER).limit(size)


def sale_detail_total(spark: SparkSession, base: str, search: Search = Search(),
                      reader: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Total rows of the search -> one row (total).

    lineitem is semi-joined to the filtered orders (by order key) and parts
    (by part key); no wide row is built.
    """
    t = DetailTables(spark, base, search, reader)
    li = (t.lineitem.join(t.valid_orders(), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
          .join(t.part.select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left_semi"))
    return li.agg(F.count(F.lit(1)).alias("total"))


def _share(counts: DataFrame, name_col: str) -> DataFrame:
    agg = counts.groupBy(F.col(name_col).alias("name")).agg(F.sum("n").cast("bigint").alias("value"))
    return agg.withColumn("pct", share_pct("value"))


def category_share(spark: SparkSession, base: str, search: Search = Search(),
                   reader: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """A10: rows per user category (gender stand-in) -> (name, value, pct)."""
    t = DetailTables(spark, base, search, reader)
    per_order = (
        t.lineitem.join(t.part.select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"),
                        "left_semi")
        .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    )
    per_cust = (per_order.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
                .groupBy("o_custkey").agg(F.sum("n").alias("n")))
    per_cat = per_cust.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return _share(per_cat, "user_gender")


def age_share(spark: SparkSession, base: str, search: Search = Search(),
              reader: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Rows per age band (F11) -> (name, value, pct)."""
    t = DetailTables(spark, base, search, reader)
    per_part = (
        t.lineitem.join(t.valid_orders(), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
        .groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    )
    banded = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "band", age_band("user_age"))
    return _share(banded, "band")


def search_shares(spark: SparkSession, base: str, search: Search = Search(),
                  reader: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Total and both shares of a search from one filtered base -> (stat, name, value, pct).

    ``stat`` is ``total``, ``age`` or ``category``.  The joins run once; one
    aggregate per (category, band) -- a handful of rows -- feeds all three.
    """
    cells = (sale_detail_wide(spark, base, search, reader)
             .groupBy(F.col("user_gender").alias("category"), age_band("user_age").alias("band"))
             .agg(F.count(F.lit(1)).alias("n")))
    parts = F.array(
        F.struct(F.lit("total").alias("stat"), F.lit("total").alias("name")),
        F.struct(F.lit("age").alias("stat"), F.col("band").alias("name")),
        F.struct(F.lit("category").alias("stat"), F.col("category").alias("name")))
    out = (cells.select(F.explode(parts).alias("s"), "n").groupBy("s.stat", "s.name")
           .agg(F.sum("n").cast("bigint").alias("value")))
    return out.withColumn("pct", share_pct("value", "stat"))


def sale_detail_json(spark: SparkSession, base: str, search: Search = Search(),
                     page: int = 1, size: int = 20,
                     reader: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """The reply ``{"total", "stat": [{"title", "options"}, ...], "detail": [...]}``, one row.

    Two passes over the lines: the shares with the total, and the page.  Only
    the page's ``size`` rows and the share rows are gathered.  Shares are written
    as percent with one decimal.  An empty search has total 0 and empty lists.
    """
    stats = search_shares(spark, base, search, reader)
    option = F.struct("name", "value", F.round(F.col("pct") * 100, 1).alias("percent"))

    def options(stat):
        return F.array_sort(F.collect_list(F.when(F.col("stat") == stat, option)))

    reply = stats.agg(
        F.coalesce(F.max(F.when(F.col("stat") == "total", F.col("value"))), F.lit(0)).alias("total"),
        F.array(F.struct(F.lit("age").alias("title"), options("age").alias("options")),
                F.struct(F.lit("category").alias("title"), options("category").alias("options"))
                ).alias("stat"))
    rows = sale_detail_page(spark, base, search, page, size, reader).agg(
        F.array_sort(F.collect_list(F.struct(*PAGE_ORDER))).alias("detail"))
    # one row each; the union folds them without a join
    both = reply.unionByName(rows, allowMissingColumns=True)
    return both.agg(*[F.any_value(c, ignoreNulls=True).alias(c) for c in ("total", "stat", "detail")]).select(
        F.to_json(F.struct("total", "stat", "detail")).alias("json"))


def sale_detail_bundle(spark: SparkSession, base: str, search: Search = Search(),
                       page: int = 1, size: int = 20) -> dict[str, DataFrame]:
    """The three parts of a detail reply: total, stat (age, category), detail page."""
    return {
        "total": sale_detail_total(spark, base, search),
        "stat_age": age_share(spark, base, search),
        "stat_category": category_share(spark, base, search),
        "detail": sale_detail_page(spark, base, search, page, size),
    }
