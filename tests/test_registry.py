import re

import pytest

import __spark_entry__ as entry_points


def test_every_sql_belongs_to_a_query():
    queries, oracle = entry_points.queries(), entry_points.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) > 70


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and sum(r["purchases"] for r in rows) > 0


@pytest.mark.parametrize("name", ["overview_events", "pit_small_groups", "entity_split", "grid_gaps_users_days", "data_fingerprint"])
def test_against_duckdb(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    sql = entry_points.oracle_sql()[name]
    for t in ("customer", "events", "orders", "lineitem", "part"):
        if re.search(rf"\b{t}\b", sql):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = entry_points.queries()[name](spark, sf)
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, found.fetchall()))


@pytest.mark.parametrize("name", ["pit_join_ttl", "label_construction", "quality_checks", "grid_gaps_users_days", "histogram_value"])
def test_plans_hold_no_nested_loops(spark, sf, name):
    plan = entry_points.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = entry_points.queries()["materialize_latest"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan
    plan = entry_points.queries()["key_counts_orders"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_custkey:bigint>" in plan
