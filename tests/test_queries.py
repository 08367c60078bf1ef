"""Every registered query against its SQL on the smallest tables."""


import pytest
from feeds import SF

import __spark_entry__ as entry
from brook.plans.queries import QUERIES as BASE
from brook.plans.streams import STREAMS
from check import connect, difference

# The corpus operators have tests of their own.
QUERIES = {n: q for n, q in entry.queries().items() if n in BASE or n in STREAMS}
ORACLES = {n: sql for n, sql in entry.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con.execute(ORACLES[name]).df()) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["word", "n"] and entry.entry(spark).count() > 0


def test_results_do_not_depend_on_partitions(spark):
    names = ["late_refire", "timer_one_per_key", "session_count", "uv_running"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append([sorted(map(tuple, QUERIES[q](spark, SF).collect()), key=str) for q in names])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_streams_are_registered():
    assert set(STREAMS) <= set(QUERIES)


def test_no_one_partition_window_over_rows(spark):
    """Whole-table running values are windows over slices, not over everything."""
    for name in ("pv_total_running", "watermark_per_record", "buffer_release", "late_drop"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        big = [w for w in plan.split("\n") if " Window " in w and "_slice" not in w]
        assert not big, big


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["pv_per_user"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_sliding_windows_count_panes_first(spark):
    """Rows are aggregated before anything is spread over windows."""
    plan = QUERIES["sliding_count"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    spread = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    assert any("Aggregate" in line for line in plan[spread:]) and not any("Expand" in line for line in plan)
