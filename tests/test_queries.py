import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from callpulse.operators import kpis
from callpulse.plans.fixtures import call_records, calls_from_events
from callpulse.operators.records import call_observations
from conftest import SMALL

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in sorted(os.listdir(SMALL)):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{name}'")
    return connection


def ordered(records):
    return sorted(records, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, tables, name):
    found = QUERIES[name](spark, SMALL)
    if name not in ORACLES:
        assert found.count() > 0
        return
    relation = tables.sql(ORACLES[name])
    assert sorted(relation.columns) == sorted(found.columns)
    arrow = found.toArrow()
    columns = relation.columns
    mine = [tuple(row[c] for c in columns) for row in arrow.to_pylist()]
    mine = [
        tuple(v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v for v in row)
        for row in mine
    ]
    assert ordered(mine) == ordered(relation.fetchall())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_figures_read_the_calls_once(spark):
    calls = calls_from_events(spark.read.parquet(f"{SMALL}/events.parquet"))
    plan = plan_of(kpis.combined(kpis.service_measures(calls)))
    assert plan.count("FileScan") == 1


def test_figures_prune_columns_and_aggregate_before_the_shuffle(spark):
    calls = calls_from_events(spark.read.parquet(f"{SMALL}/events.parquet"))
    plan = plan_of(kpis.average_handling_time(calls))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in plan
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_figures_from_records_do_not_decode_keys(spark):
    calls = calls_from_events(spark.read.parquet(f"{SMALL}/events.parquet"))
    plan = plan_of(kpis.wait_time(call_observations(call_records(calls))))
    assert plan.count("ArrowEvalPython") == 1 and "_parse_keys" not in plan


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
