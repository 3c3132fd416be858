"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb
import pytest

from conftest import SMALL
from foyer.catalog import ENTRIES, spark_query

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float, Decimal)):
        return "NaN" if math.isnan(value) else f"{float(value):.4f}"
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    return str(value)


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("key", list(ENTRIES))
def test_query_equals_sql(spark, duck, key):
    entry = ENTRIES[key]
    df = spark_query(entry)(spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "GlobalLimit"):
        assert node not in plan, node
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(entry.sql)
    want = table([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
}


@pytest.mark.parametrize("key", ["promoter_sales_report", "reprice_cart", "primary_customer_load"])
def test_results_hold_when_all_is_shuffled_and_split(spark, duck, key):
    """No broadcasts, and every join input counts as skewed."""
    for name, value in FORCED.items():
        spark.conf.set(name, value)
    try:
        df = spark_query(ENTRIES[key])(spark, SMALL)
        got = table(df.columns, [tuple(r) for r in df.collect()])
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in FORCED:
            spark.conf.unset(name)
    cursor = duck.execute(ENTRIES[key].sql)
    assert got == table([c[0] for c in cursor.description], cursor.fetchall())
    assert "SortMergeJoin" in plan
