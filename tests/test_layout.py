"""Bucketed layout: the lineitem ⋈ orders join and per-order aggregates run without exchanges."""

import re
import tempfile

from daypulse.operators import detail
from daypulse.sources.layout import bucket_detail_tables, catalog_reader
from tests.compare import rows_of
from tests.conftest import SF001


def _subtree(plan: str, marker: str) -> str:
    """Lines of the printed plan node starting with ``marker`` and all its children."""
    lines = plan.splitlines()
    start = next(i for i, ln in enumerate(lines) if marker in ln)
    indent = lines[start].index(marker)
    out = [lines[start]]
    for ln in lines[start + 1:]:
        body = ln.lstrip(" :|+-")
        if not body or len(ln) - len(body) <= indent:
            break
        out.append(ln)
    return "\n".join(out)


def test_bucketed_join_has_no_exchange_and_same_rows(spark):
    path = tempfile.mkdtemp(prefix="daypulse-bucketed-")
    tables = bucket_detail_tables(spark, SF001, buckets=8, prefix="bk_", path=path)
    reader = catalog_reader(spark, tables, SF001)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:  # force shuffle joins, as at scale where orders is not broadcastable
            spark.conf.set(k, "-1")
        wide = detail.sale_detail_wide(spark, SF001, reader=reader)
        plan = wide._jdf.queryExecution().executedPlan().toString()
        first_join = _subtree(plan, "SortMergeJoin [l_orderkey")
        assert "FileScan" in first_join and "Exchange" not in first_join, first_join
        share = detail.category_share(spark, SF001, reader=reader)
        splan = share._jdf.queryExecution().executedPlan().toString()
        # the bucketed orders side joins the per-order counts without a shuffle
        assert "Bucketed: true" in splan and not re.search(r"Exchange hashpartitioning\(o_orderkey", splan), splan
        assert rows_of(wide.toPandas()) == rows_of(detail.sale_detail_wide(spark, SF001).toPandas())
        assert rows_of(share.toPandas()) == rows_of(detail.category_share(spark, SF001).toPandas())
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
