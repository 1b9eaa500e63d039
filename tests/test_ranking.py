import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwatch.operators import bounded, ranking


@pytest.mark.parametrize("values", [
    [random.Random(1).gauss(0, 1) for _ in range(3000)],
    [1.0] * 500 + [2.0] * 500 + [1e9],
    [0.0, 1e-12, 1.0] * 300,
    [5.0],
    [1.0, 2.0, 1e300, -1e308, 1e308, 0.0] * 40 + [float("inf")] * 30 + [float("-inf")] * 10,
    [float("inf")] * 4,
])
@pytest.mark.parametrize("finish", [0, 10_000])
def test_order_statistics(spark, monkeypatch, values, finish):
    monkeypatch.setattr(ranking, "BINS", 8)
    monkeypatch.setattr(ranking, "FINISH_ROWS", finish)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = sorted({0, len(values) // 3, len(values) // 2, len(values) - 1})
    got = ranking.order_statistics(df, "v", wanted)
    assert got == {r: sorted(values)[r] for r in wanted}


@pytest.mark.parametrize("q", [0.0, 0.05, 0.37, 0.95, 1.0])
def test_exact_quantile(spark, q):
    values = [random.Random(2).expovariate(1) for _ in range(1234)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    assert ranking.exact_quantile(df, "v", q) == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_quantile_of_nothing(spark):
    assert ranking.exact_quantile(spark.createDataFrame([], "v double"), "v", 0.5) is None


def test_pick_fraction_is_exact_and_repeatable(spark):
    df = spark.range(997).withColumnRenamed("id", "key")
    first = ranking.pick_fraction(df, "key", 0.05)
    again = ranking.pick_fraction(df.repartition(7), "key", 0.05)
    picked = {r.key for r in first.where("picked = 1").collect()}
    assert len(picked) == int(0.05 * 997)
    assert picked == {r.key for r in again.where("picked = 1").collect()}
    assert ranking.pick_fraction(df, "key", 0.0005).where("picked = 1").count() == 0


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    top = ranking.top_k(df, ["k"], [F.col("v").desc()], 3)
    assert sorted((r.k, r.v, r["rank"]) for r in top.collect()) == [
        (0, 994, 3), (0, 996, 2), (0, 998, 1), (1, 995, 3), (1, 997, 2), (1, 999, 1)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_bounded_rows(spark):
    small = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    assert bounded.bounded_rows(small, 4) is None
    assert len(bounded.bounded_rows(small, 5)) == 5


def test_stored_table_lies_in_the_checkpoint_folder(spark):
    df = bounded.stored(spark.range(3), "probe")
    assert spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]
    assert df.count() == 3
