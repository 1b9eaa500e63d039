"""Every registered query against its SQL on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, frames_differ

FOLDER = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    if name in ORACLE:
        assert frames_differ(got, db.execute(ORACLE[name]).df()) is None
    else:
        assert len(got)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["service_name", "anomaly_count"] and df.count() > 0


def test_no_local_checkpoint_or_cross_join():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(os.path.join(root, "tarnwatch")):
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as source:
                    text = source.read()
                assert "localCheckpoint" not in text and "crossJoin" not in text
