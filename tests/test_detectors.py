import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwatch import constants as C
from tarnwatch import schemas
from tarnwatch.operators import bounded, detectors, forest, monitoring
from tarnwatch.operators.bounded import stored
from tarnwatch.plans import scoring_job
from tarnwatch.plans.feature_job import feature_table
from tarnwatch.sources import tables
from tarnwatch.sources.incidents import incidents_from_events

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def features(spark):
    incidents = incidents_from_events(spark.read.parquet(EVENTS))
    return stored(feature_table(incidents), "features")


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    data = [(f"p{i}", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (1500, 2)))]
    data.append(("far", 12.0, -11.0))
    return spark.createDataFrame(data, "incident_id string, x double, y double").cache()


def test_constant_group_has_no_zscore_and_no_flag(spark):
    df = spark.createDataFrame([("a", 5.0)] * 4, "service_name string, resolution_time_mins double")
    rows = detectors.with_zscore(df).collect()
    assert {(r.z_score, r.z_anomaly) for r in rows} == {(None, 0)}


def test_zscore_uses_population_deviation(spark):
    values = [1.0, 2.0, 3.0, 10.0]
    df = spark.createDataFrame([("a", v) for v in values],
                               "service_name string, resolution_time_mins double")
    got = {r.resolution_time_mins: r.z_score for r in detectors.with_zscore(df).collect()}
    for v in values:
        assert got[v] == pytest.approx((v - np.mean(values)) / np.std(values))


def test_few_large_groups_are_not_shuffled(spark, tmp_path):
    """Stored rows under a low broadcast threshold, as large tables are: the rows stay in their tasks."""
    path = str(tmp_path / "rows")
    spark.range(4000).select(
        F.when(F.col("id") % 40 > 0, F.concat(F.lit("s"), F.col("id") % 2)).alias("service_name"),
        F.concat(F.lit("INC_"), "id").alias("incident_id"),
        (F.col("id") % 7).cast("double").alias("resolution_time_mins")).write.parquet(path)
    df = spark.read.parquet(path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for joined in (detectors.with_zscore(df), monitoring.with_service_total(df)):
            rows = joined.collect()
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
            assert len(rows) == 4000 and sum(r.service_name is None for r in rows) == 100
            assert all((r[-1] in (None, 0)) == (r.service_name is None) for r in rows if "total_resolution_time" in joined.columns)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_many_groups_join_by_shuffle(spark, monkeypatch):
    rows = [(f"s{i % 30}", float(i)) for i in range(120)] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "service_name string, resolution_time_mins double")
    few = sorted(map(str, detectors.with_zscore(df).collect()))
    monkeypatch.setattr(bounded, "SMALL_ROWS", 10)
    assert sorted(map(str, detectors.with_zscore(df).collect())) == few


def test_metrics(spark):
    df = spark.createDataFrame([(1, True)] * 3 + [(1, False)] + [(0, True)] * 2 + [(0, False)] * 4,
                               "p int, t boolean")
    row = detectors.detector_metrics(df, "p", "t").first()
    assert (row["rows"], row.tp, row.fp, row.fn) == (10, 3, 1, 2)
    assert (row.precision, row.recall, row.f1) == (0.75, 0.6, pytest.approx(2 / 3))


@pytest.mark.parametrize("rows", [[(0, True), (0, False)], []])
def test_metrics_without_positives(spark, rows):
    row = detectors.detector_metrics(spark.createDataFrame(rows, "p int, t boolean"), "p", "t").first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_comparison_ranks_by_recall_then_f1(spark):
    df = spark.createDataFrame([(1, 1, True), (1, 0, False), (0, 0, True)],
                               "a int, b int, sla_breached boolean")
    got = {r.model: (r.place, r.role)
           for r in detectors.compare_detectors(df, {"A": "a", "B": "b"}).collect()}
    assert got == {"B": (1, "champion"), "A": (2, "challenger")}


def test_arms_are_stable_and_add_up(spark):
    df = spark.range(20_000).select(F.concat(F.lit("INC_"), "id").alias("incident_id"))
    counts = {r.arm: r["count"] for r in detectors.with_arm(df).groupBy("arm").count().collect()}
    assert set(counts) == {"champion", "challenger"}
    assert abs(counts["champion"] / 20_000 - 0.9) < 0.01
    with pytest.raises(ValueError):
        detectors.with_arm(df, percent={"a": 50, "b": 40})


def scores(df, nodes):
    out = df.select("incident_id", forest.forest_score(nodes, ["x", "y"]).alias("s")).collect()
    return {r.incident_id: r.s for r in out}


def test_forest_does_not_depend_on_partitions(points):
    a = forest.fit_forest(points.repartition(3), ["x", "y"], trees=20)
    b = forest.fit_forest(points.repartition(11), ["x", "y"], trees=20)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    one, two = scores(points, a), scores(points.repartition(7), b)
    assert one == two
    assert min(one, key=one.get) == "far"
    assert all(-1 < s < 0 for s in one.values())


def test_forest_is_small_whatever_the_data(points):
    nodes = forest.fit_forest(points, ["x", "y"], trees=7, sample_size=64).collect()
    assert len({n.tree_id for n in nodes}) == 7
    assert len(nodes) <= 7 * (2 * 64 - 1)
    assert {n.sample_size for n in nodes} == {64}


def test_forest_scores_follow_the_definition(points):
    """Walk every tree by hand for a few rows."""
    nodes = forest.fit_forest(points, ["x", "y"], trees=5)
    trees = {}
    for n in nodes.collect():
        trees.setdefault(n.tree_id, {})[n.node_id] = n
    got = scores(points, nodes)
    for row in points.limit(20).collect():
        depths = []
        for tree in trees.values():
            at = tree[0]
            while at.feature >= 0:
                at = tree[at.left if row[1 + at.feature] <= at.threshold else at.right]
            depths.append(at.path_length)
        want = -2 ** (-np.mean(depths) / float(forest.expected_path(256)))
        assert got[row.incident_id] == pytest.approx(want, rel=1e-12)


def test_contamination_sets_the_flagged_share(spark, points):
    nodes = forest.fit_forest(points, ["x", "y"], trees=20)
    out = scoring_job.score_with_forest(points, nodes, ["x", "y"], 0.1)
    flagged = out.where("if_anomaly = 1")
    raw = np.array(list(scores(points, nodes).values()))
    # Rows that tie with the cutoff are not below it.
    assert flagged.count() == (raw < np.quantile(raw, 0.1)).sum()
    assert 140 <= flagged.count() <= 151
    assert flagged.where("anomaly_score >= 0 OR risk_score <= 0").count() == 0


def test_batch_job_writes_the_declared_table(spark, features, tmp_path):
    out = scoring_job.score_batch(
        features, table="scored_day", scoring_date="2024-01-15", path=str(tmp_path / "t"),
        columns=C.BASE_FEATURES, run_id="r1")
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in schemas.ANOMALY_SCORES]
    days = out.select(F.to_date("timestamp").cast("string").alias("d")).distinct().collect()
    assert [r.d for r in days] == ["2024-01-15"]
    before = out.count()
    scoring_job.score_batch(
        features, table="scored_day", scoring_date="2024-01-16", write_mode="append",
        path=str(tmp_path / "t"), columns=C.BASE_FEATURES, run_id="r2")
    assert spark.table("scored_day").count() > before
    tables.drop_table(spark, "scored_day")


def test_batch_job_refuses_missing_values(features):
    broken = features.withColumn("resolution_time_mins", F.when(
        F.col("severity") > 1, F.col("resolution_time_mins")))
    with pytest.raises(ValueError, match="resolution_time_mins"):
        scoring_job.score_batch(broken, table="never_written")


def test_metric_log_has_the_declared_schema(spark):
    df = spark.createDataFrame([(1, True)], "p int, t boolean")
    log = detectors.metric_log(detectors.detector_metrics(df, "p", "t"), "r", "parent", "m",
                               {"contamination": 0.05}, F.lit("2024-01-01 00:00:00"))
    assert [f.dataType for f in log.schema] == [f.dataType for f in schemas.RUN_METRICS]
    assert {(r.kind, r.key, r.value) for r in log.collect()} == {
        ("param", "contamination", "0.05"), ("metric", "precision", "1.0"),
        ("metric", "recall", "1.0"), ("metric", "f1", "1.0")}


def test_tracked_runs_hang_on_their_parent(spark, features, tmp_path):
    from tarnwatch.plans import tracking

    scores, log = tracking.track_detectors(features, F.lit("2024-01-01 00:00:00"))
    assert scores.count() == 1000
    tracking.append_log(log, "run_metrics", str(tmp_path / "log"))
    tracking.append_log(log, "run_metrics", str(tmp_path / "log"))
    rows = spark.table("run_metrics").collect()
    tables.drop_table(spark, "run_metrics")
    assert len(rows) == 2 * (2 + 4 + 5)
    assert {(r.run_id, r.parent_run_id) for r in rows} == {
        ("anomaly_detection_parent", None), ("z_score_model", "anomaly_detection_parent"),
        ("isolation_forest", "anomaly_detection_parent")}


def test_saved_model_keeps_its_cutoff(features):
    model = scoring_job.train_model(features, C.BASE_FEATURES)
    whole = scoring_job.anomaly_scores(features, C.BASE_FEATURES, model=model)
    part = scoring_job.anomaly_scores(features.where("severity = 1"), C.BASE_FEATURES, model=model)
    got = {r.incident_id: r.anomaly_score for r in whole.collect()}
    assert all(got[r.incident_id] == pytest.approx(r.anomaly_score, abs=1e-12)
               for r in part.collect())
    assert abs(sum(s < 0 for s in got.values()) - 50) <= 1
