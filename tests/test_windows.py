import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnwatch.operators import windows
from tarnwatch.plans.feature_job import feature_table
from tarnwatch.sources.incidents import incidents_from_events

LAGS = {"lag_a": 2, "lag_b": 7}
FRAMES = {"short": 4, "long": 11}
SCHEMA = "k string, t bigint, v double"


def reference(df):
    w = Window.partitionBy("k").orderBy("t")
    columns = [F.lag("v", n).over(w).alias(c) for c, n in LAGS.items()]
    for name, n in FRAMES.items():
        frame = w.rowsBetween(-n, 0)
        columns += [F.avg("v").over(frame).alias(f"rolling_mean_{name}"),
                    F.stddev_samp("v").over(frame).alias(f"rolling_std_{name}")]
    return df.select("*", *columns)


def rows(df):
    columns = ["k", "t", "v", *LAGS] + [f"rolling_{s}_{n}" for n in FRAMES for s in ("mean", "std")]
    out = {}
    for r in df.select(*columns).collect():
        out[(r.k, r.t)] = [r[c] for c in columns[2:]]
    return out


def assert_same(got, want):
    assert got.keys() == want.keys()
    for key, values in want.items():
        for a, b in zip(got[key], values):
            assert (a is None) == (b is None), (key, got[key], values)
            assert a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(5)
    data = [("hot", t, rng.gauss(60, 20)) for t in range(400)]
    data += [("cold", t, rng.gauss(5, 1)) for t in range(9)] + [("one", 3, 1.0)]
    data += [("flat", t, 7.25) for t in range(30)]
    data += [("gaps", t, None if t % 3 else float(t)) for t in range(40)]
    rng.shuffle(data)
    return spark.createDataFrame(data, SCHEMA).repartition(5).cache()


def test_merged_runs_equal_row_frames(series):
    w = Window.partitionBy("k").orderBy("t")
    assert_same(rows(windows.add_history(series, w, "v", LAGS, FRAMES)), rows(reference(series)))


@pytest.mark.parametrize("shard_rows", [3, 17, 60, 1000])
def test_sharded_equals_plain(series, shard_rows):
    got = windows.with_sharded_history(series, "k", ["t"], "v", LAGS, FRAMES, shard_rows)
    assert_same(rows(got), rows(reference(series)))


@pytest.mark.parametrize("shard_rows", [3, 17, 60, 1000])
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_bucketed_equals_plain(series, shard_rows, width):
    got = windows.with_bucketed_history(series, "k", ["t"], "v", F.floor(F.col("t") / width), LAGS, FRAMES, shard_rows)
    assert_same(rows(got), rows(reference(series)))


def test_bucketed_history_of_null_keys(spark):
    df = spark.createDataFrame([(None, t, float(t)) for t in range(20)] + [("a", None, 1.0), ("a", 2, None)], SCHEMA)
    got = windows.with_bucketed_history(df, "k", ["t"], "v", F.floor(F.col("t") / 4), LAGS, FRAMES, 6)
    assert_same(rows(got), rows(reference(df)))


def test_building_the_feature_table_starts_no_job(spark):
    incidents = incidents_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "feature table")
    df = feature_table(incidents)
    spark.sparkContext.setJobGroup("running", "feature table")
    assert list(tracker.getJobIdsForGroup("building")) == []
    assert df.count() == incidents.count() and list(tracker.getJobIdsForGroup("running"))
    spark.sparkContext._jsc.clearJobGroup()


def test_hot_key_switches_to_shards(series, monkeypatch):
    called = []
    monkeypatch.setattr(windows, "with_sharded_history",
                        lambda *a, **k: called.append(1) or series)
    windows.with_history(series, "k", ["t"], "v", LAGS, FRAMES, shard_rows=100)
    assert called
    called.clear()
    windows.with_history(series, "k", ["t"], "v", LAGS, FRAMES, shard_rows=1000)
    assert not called


def test_warm_up_and_flat_series(series):
    out = rows(windows.with_history(series, "k", ["t"], "v", LAGS, FRAMES))
    assert out[("one", 3)] == [1.0, None, None, 1.0, None, 1.0, None]
    assert out[("flat", 20)][3:] == [7.25, 0.0, 7.25, 0.0]


@pytest.mark.parametrize("width", [1, 2, 3, 4, 5, 169, 337, 721])
def test_runs_cover_the_frame(width):
    runs = windows._run_offsets(width)
    covered = sorted(i for size, offset in runs for i in range(offset, offset + size))
    assert covered == list(range(width))


def test_hourly_trailing_means(spark):
    df = spark.sql("""
        SELECT 'a' AS k, timestamp_ntz'2024-01-01 00:10:00' AS ts, 10D AS v
        UNION ALL SELECT 'a', timestamp_ntz'2024-01-01 00:50:00', 20D
        UNION ALL SELECT 'a', timestamp_ntz'2024-01-01 23:00:00', 40D
        UNION ALL SELECT 'a', timestamp_ntz'2024-01-02 00:00:00', 60D""")
    out = windows.hourly_trailing_means(df, "k", "ts", "v", {"1d": 1}).orderBy("epoch_hour")
    assert [r.trailing_mean_1d for r in out.collect()] == [15.0, 70 / 3, 50.0]
