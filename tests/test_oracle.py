"""Every registered query equals its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

from __spark_entry__ import oracle_sql, queries
from daypulse.plans.catalog import QUERIES
from tests.compare import compare
from tests.conftest import SF001

NAMES = sorted(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sql = oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle SQL"
    df = queries()[name](spark, SF001)
    s_cols, d_cols, s_rows, d_rows = compare(df, duck, sql)
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, duck, name):
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in queries()[name](spark, SF001).schema.fields}
    rel = duck.sql(oracle_sql()[name])
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
