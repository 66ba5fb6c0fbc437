import os

import duckdb
import pytest

from factloom.plans import inspect
from factloom.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def rows(frame):
    def text(x):
        if x is None or x != x:
            return ""
        return repr(round(float(x), 5)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    cols = sorted(frame.columns)
    return sorted(tuple(text(x) for x in r) for r in frame[cols].astype(object).where(frame[cols].notna(), None).itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_and_sql_agree(spark, con, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_change_events_deal_rows_once(spark):
    df = QUERIES["change_events"](spark, SF)
    assert inspect.shuffles(df) == 1 and not inspect.uses_python(df)


def test_dedupe_limits_groups_before_the_shuffle(spark):
    assert "WindowGroupLimit" in inspect.physical(QUERIES["dedupe_latest"](spark, SF))


def test_small_side_is_broadcast(spark):
    assert "BroadcastHashJoin" in inspect.physical(QUERIES["current_assertion"](spark, SF))


def test_scans_read_what_is_asked_for(spark):
    (columns,) = inspect.read_columns(QUERIES["daily_activity"](spark, SF))
    assert "o_totalprice" not in columns and "o_orderdate" in columns
    assert any("IsNotNull(o_totalprice)" in f and "Not(EqualTo(o_orderpriority,5-LOW))" in f for f in inspect.pushed_filters(QUERIES["dq_passed"](spark, SF)))


def test_no_python_on_executors(spark):
    for name in ("scd2_history", "scd1_upsert", "change_events", "reporting_scales", "rescue_unknown_keys"):
        assert not inspect.uses_python(QUERIES[name](spark, SF)), name


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
