"""Every registered query against its SQL on DuckDB, over the smallest test tables."""

import glob
import math
import os

import duckdb
import pytest

from headroom.plans.oracle import oracle_sql
from headroom.plans.queries import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")
#: Long ones that other tests cover.
ELSEWHERE = {"ingest_stream", "forecast_chart", "provision_counts", "scope_list"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(rows):
    text = lambda x: "None" if x is None or isinstance(x, float) and math.isnan(x) else f"{x:.5f}" if isinstance(x, float) else str(x)
    return sorted(tuple(map(text, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - ELSEWHERE))
def test_rows_equal(spark, duck, name):
    rel = duck.sql(oracle_sql()[name])
    df = queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    assert plain(df.select(*[f"`{c}`" for c in rel.columns]).collect()) == plain(rel.fetchall())


def test_the_rest_run(spark):
    without = set(queries()) - set(oracle_sql())
    assert without == {"model_backtest", "model_selection", "forecast_daily", "selected_actions"}
    for name in sorted(without):
        assert queries()[name](spark, SF).count() > 0
