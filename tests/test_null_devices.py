"""Rows without a device count as no device in every metric; appended files are read."""

import os

from daypulse.operators import metrics
from daypulse.operators.dedup import first_seen
from daypulse.sources.tables import read_table


def test_every_dau_agrees_with_null_devices(spark):
    day = 1_700_000_000_000
    logs = spark.createDataFrame(
        [("a", day, "1"), (None, day + 1, "2"), (None, day + 2, "3"), ("b", day + 3, "4"), ("a", day + 4, "5")],
        "mid string, ts long, event_id string",
    ).selectExpr("*", "true as is_start", "cast(2 as decimal(18,2)) as amount")
    firsts = first_seen(logs)
    assert [r["dau"] for r in metrics.dau_total(logs).collect()] == [2]
    assert sum(r["dau"] for r in metrics.dau_hour(firsts).collect()) == 2
    assert [r["dau"] for r in metrics.activity_rate(logs).collect()] == [2]
    assert [r["new_mid"] for r in metrics.new_devices(logs).collect()] == [2]
    (s,) = metrics.daily_summary(logs).collect()
    assert (s["dau"], s["new_mid"], float(s["order_amount"])) == (2, 2, 10.0)


def test_appended_rows_are_read(spark, tmp_path):
    path = os.path.join(tmp_path, "nation.parquet")
    spark.range(5).write.parquet(path)
    assert read_table(spark, "nation", str(tmp_path)).count() == 5
    spark.range(7).write.mode("append").parquet(path)
    assert read_table(spark, "nation", str(tmp_path)).count() == 12
