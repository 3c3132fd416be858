from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("foyer-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from foyer import tune

    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    from foyer.catalog.binding import Binding

    return Binding(spark, SMALL)


def has_types(df, schema):
    return [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]


def rows(df):
    """Rows as sorted tuples; the sort key treats NULL as lowest."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))
