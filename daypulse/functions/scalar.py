"""Scalar column functions used by the dashboard metrics.

Every helper returns a built-in Column expression; no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from daypulse.functions.timeparts import compact_day

# ---------------------------------------------------------------------------
# Fixed values that must match the dashboard contract.
# Age-band labels (young, middle, old), in display order:
AGE_BAND_LABELS = ("20岁以下", "20-30岁", "30岁以上")
# Band edges (our decision; the dashboard gives labels only): under 20 | 20..30 | over 30.
AGE_BAND_LOW = 20
AGE_BAND_HIGH = 30
# Map legend: six bins of width 100 starting at 0; values >= 600 fall in the last bin.
BIN_WIDTH = 100
BIN_COUNT = 6
# Key prefixes for the per-day device set and the per-day fact partition.
DAU_SET_PREFIX = "dau:"
DAU_TABLE_PREFIX = "dau_info_"
QUERY_ALIAS_SUFFIX = "_query"
# ---------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_present(c: Column | str) -> Column:
    """non-null and non-empty text."""
    c = _c(c)
    return c.isNotNull() & (F.length(c) > 0)


def age_band(age: Column | str) -> Column:
    """age -> one of AGE_BAND_LABELS (NULL age -> NULL band)."""
    a = _c(age)
    return (
        F.when(a < AGE_BAND_LOW, F.lit(AGE_BAND_LABELS[0]))
        .when(a <= AGE_BAND_HIGH, F.lit(AGE_BAND_LABELS[1]))
        .when(a.isNotNull(), F.lit(AGE_BAND_LABELS[2]))
    )


def value_bin(v: Column | str) -> Column:
    """100-wide legend bin 0..5; negative values clamp to 0, >= 600 to 5."""
    return F.greatest(
        F.lit(0), F.least(F.floor(_c(v) / BIN_WIDTH), F.lit(BIN_COUNT - 1))
    ).cast("int")


def share_pct(value: Column | str, *partition_cols: str) -> Column:
    """value / total of value (over the partition, or the whole frame).

    Only ever applied to already-aggregated share tables (a handful of rows per
    partition), never to raw facts.
    """
    w = Window.partitionBy(*partition_cols) if partition_cols else Window.partitionBy()
    return _c(value).cast("double") / F.sum(_c(value)).over(w).cast("double")


def change_rate(today: Column | str, yesterday: Column | str) -> Column:
    """(today - yesterday) / yesterday as a fraction; zero/NULL yesterday -> NULL."""
    t, y = _c(today).cast("double"), _c(yesterday).cast("double")
    return F.try_divide(t - y, F.when(y != 0, y))


def dau_set_key(dt: Column | str) -> Column:
    """per-day device set key, e.g. 'dau:2024-01-01'."""
    return F.concat(F.lit(DAU_SET_PREFIX), _c(dt))


def dau_table_name(dt: Column | str) -> Column:
    """per-day fact partition name, e.g. 'dau_info_20240101'."""
    return F.concat(F.lit(DAU_TABLE_PREFIX), compact_day(dt))


def dau_query_alias(dt: Column | str) -> Column:
    """read alias of a day partition, e.g. 'dau_info_20240101_query'."""
    return F.concat(dau_table_name(dt), F.lit(QUERY_ALIAS_SUFFIX))


def offset_key(topic: Column | str, group: Column | str) -> Column:
    """'topic:group' key of a consumer's offset map."""
    return F.concat_ws(":", _c(topic), _c(group))
