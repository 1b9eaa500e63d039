"""Sinks, swaps, stored models, bucketed chunk tables and what questions ask for."""

import pytest
from pyspark.sql import functions as F

from tarnwatch import constants as C
from tarnwatch import schemas
from tarnwatch.operators import retrieval
from tarnwatch.operators.bounded import stored
from tarnwatch.plans import assistant, feature_job, index_job, scoring_job, tracking
from tarnwatch.sources import tables
from tarnwatch.sources.incidents import incidents_from_events


@pytest.fixture(scope="module")
def features(spark):
    incidents = incidents_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    return stored(feature_job.feature_table(incidents), "features")


def test_a_failed_write_keeps_the_old_table(spark, tmp_path):
    for path in (None, str(tmp_path / "t")):
        tables.replace_table(spark.range(3), "swapped", path=path)
        broken = spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
        with pytest.raises(Exception):
            tables.replace_table(broken, "swapped", path=path)
        assert sorted(r.id for r in spark.table("swapped").collect()) == [0, 1, 2]
        tables.replace_table(spark.range(2).withColumn("more", F.lit("x")), "swapped", partition_by=("more",), path=path)
        assert sorted(map(tuple, spark.table("swapped").collect())) == [(0, "x"), (1, "x")]
        assert [r.tableName for r in tables.list_tables(spark).collect() if r.tableName.startswith("swapped")] == ["swapped"]
        tables.drop_table(spark, "swapped")


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_appended_rows_join_a_replaced_table(spark, tmp_path, scheme):
    path, name = f"{scheme}{tmp_path}/t", f"appended_{len(scheme)}"
    for _ in range(2):
        tables.replace_table(spark.range(3), name, path=path)
        tables.save_table(spark.range(3, 5), name, "append", path=f"{path}/")
        tables.save_table(spark.range(5, 6), name, "append", path=path)
        assert sorted(r.id for r in spark.table(name).collect()) == [0, 1, 2, 3, 4, 5]
    with pytest.raises(Exception, match="location"):
        tables.save_table(spark.range(1), name, "append", path=f"{path}-other")
    assert spark.table(name).count() == 6
    for _ in range(2):
        tables.save_table(spark.range(2), f"{name}_first", "append", path=f"{path}-first")
    assert spark.table(f"{name}_first").count() == 4


def test_a_table_may_replace_itself(spark):
    tables.replace_table(spark.range(4), "self_read")
    tables.replace_table(spark.table("self_read").where("id > 1"), "self_read")
    assert sorted(r.id for r in spark.table("self_read").collect()) == [2, 3]
    tables.drop_table(spark, "self_read")


def test_features_by_day(spark, features, tmp_path):
    path = str(tmp_path / "features")
    feature_job.save_features(features, path)
    whole = feature_job.read_features(spark, path)
    assert [(f.name, f.dataType) for f in whole.schema][:-1] == [(f.name, f.dataType) for f in schemas.FEATURES_OPERATIONS]
    assert whole.count() == features.count()
    day = feature_job.read_features(spark, path, "2024-01-15", "2024-01-15")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert len(day.inputFiles()) <= len(whole.inputFiles())
    again = features.where("timestamp >= '2024-01-15' AND timestamp < '2024-01-16'").withColumn("severity", F.lit(9))
    feature_job.save_features(again, path)
    assert feature_job.read_features(spark, path).count() == features.count()
    day = feature_job.read_features(spark, path, "2024-01-15", "2024-01-15")
    assert [r.severity for r in day.select("severity").distinct().collect()] == [9]
    assert feature_job.read_features(spark, path, "2024-01-16").where("severity = 9").count() == 0


def test_stored_models_by_alias_and_day(spark, features, tmp_path):
    folder = str(tmp_path / "models")
    old = scoring_job.train_model(features.limit(300), C.BASE_FEATURES)
    new = scoring_job.train_model(features, C.BASE_FEATURES)
    scoring_job.save_model(old, folder, "champion", "2024-01-01")
    scoring_job.save_model(new, folder, "champion", "2024-01-20")
    scoring_job.save_model(new, folder, "challenger", "2024-01-10")

    def rows(df):
        return sorted(map(tuple, df.select(*old.columns).collect()))
    assert rows(scoring_job.load_model(spark, folder, "champion")) == rows(new)
    assert rows(scoring_job.load_model(spark, folder, "champion", "2024-01-19")) == rows(old)
    for alias, day in (("challenger", "2024-01-09"), ("nobody", None)):
        with pytest.raises(ValueError):
            scoring_job.load_model(spark, folder, alias, day)
    out = scoring_job.score_batch(features, table="by_alias", scoring_date="2024-01-15", model_alias="challenger",
                                  model_store=folder, columns=C.BASE_FEATURES, path=str(tmp_path / "scores"))
    want = {r.incident_id: r.anomaly_score for r in scoring_job.anomaly_scores(features, C.BASE_FEATURES, model=new).collect()}
    got = out.collect()
    assert got and all(want[r.incident_id] == pytest.approx(r.anomaly_score) for r in got)
    tables.drop_table(spark, "by_alias")


@pytest.mark.parametrize("buckets", [1, 4, 50])
def test_changes_applied_equal_a_rebuild(spark, tmp_path, buckets):
    def chunks(texts):
        return spark.createDataFrame([(f"d_{i}", t) for i, t in texts.items()], "id string, text string")
    path = str(tmp_path / "chunks")
    states = [{i: f"text {i}" for i in range(60)},
              {i: f"text {i}" if i % 7 else f"new {i}" for i in range(5, 75)},
              {3: "only", 4: None}, {3: "only", 4: None}, {}, {9: "again"}]
    index_job.save_buckets(chunks(states[0]), path, buckets)
    for before, state in zip(states, states[1:]):
        changes = index_job.apply_changes(chunks(state), path, buckets)
        kinds = {r.id: r.change for r in changes.collect()}
        want = {f"d_{i}": "insert" if i not in before else "delete" if i not in state else "update"
                for i in before.keys() | state.keys() if i not in before or i not in state or before[i] != state[i]}
        assert kinds == want
        found = index_job.read_buckets(spark, path, chunks(state))
        assert {r.id: r.text for r in found.collect()} == {f"d_{i}": t for i, t in state.items()}


def test_untouched_buckets_stay(spark, tmp_path):
    path = str(tmp_path / "chunks")
    rows = [(f"d_{i}", "x") for i in range(40)]
    df = spark.createDataFrame(rows, "id string, text string")
    index_job.save_buckets(df, path, 8)
    before = set(index_job.read_buckets(spark, path, df).inputFiles())
    index_job.apply_changes(df.where("id <> 'd_5'"), path, 8)
    after = set(index_job.read_buckets(spark, path, df).inputFiles())
    assert len({f.split("bucket=")[1].split("/")[0] for f in before - after}) == 1


def test_derived_columns_are_computed_when_buckets_are_read(spark, tmp_path, monkeypatch):
    """Nothing as long as the text is written twice, also not by the run that applies changes."""
    def chunks(texts):
        df = spark.createDataFrame([(f"d_{i}", t) for i, t in texts.items()], "id string, text string")
        return df.withColumns(retrieval.derived_columns())
    path = str(tmp_path / "chunks")
    first, second = {i: f" Text {i}" for i in range(40)}, {i: f" Text {i}" if i % 3 else f"NEW {i}" for i in range(10, 50)}
    index_job.save_buckets(chunks(first), path, 4, retrieval.derived_columns())
    for files in (100, 1):  # chunks that stay are copied where they lie, or gathered anew
        monkeypatch.setattr(index_job, "BUCKET_FILES", files)
        for state in (second, first):
            index_job.apply_changes(chunks(state), path, 4, retrieval.derived_columns())
            assert "text_clean" not in spark.read.parquet(path).columns
            found = index_job.read_buckets(spark, path, chunks(state), retrieval.derived_columns())
            assert found.columns == ["id", "text", "text_clean", "bucket"]
            assert {r.id: (r.text, r.text_clean) for r in found.collect()} == {
                f"d_{i}": (t, t.strip(" ").lower()) for i, t in state.items()}


def test_texts_of_a_change_are_not_joined(spark, tmp_path, monkeypatch):
    """Chunks meet their changes in the bucket they lie in: the written plan has no join, and one shuffle of texts."""
    def chunks(n):
        return spark.range(n).select(F.concat(F.lit("d_"), "id").alias("id"), F.concat(F.lit("text "), F.col("id") % 7).alias("text"))
    plans = []
    write = index_job._write_buckets

    def spy(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, *args)
    monkeypatch.setattr(index_job, "_write_buckets", spy)
    path = str(tmp_path / "chunks")
    index_job.save_buckets(chunks(50), path, 4)
    index_job.apply_changes(chunks(70), path, 4)
    assert "Join" not in plans[-1] and plans[-1].count("Exchange ") == 1


def test_repeated_and_missing_keys_of_changed_chunks(spark, tmp_path):
    """A changed key takes all its new copies; an equal one and a missing one stay as they are stored."""
    path = str(tmp_path / "chunks")
    schema = "id string, text string"
    index_job.save_buckets(spark.createDataFrame([("a", "x"), ("a", "x"), (None, "n"), ("b", "1"), ("c", "0")], schema), path, 2)
    new = spark.createDataFrame([("a", "x"), (None, "m"), ("b", "2"), ("b", "3")], schema)
    index_job.apply_changes(new, path, 2)
    found = index_job.read_buckets(spark, path, new).select("id", "text").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [("a", "x"), ("a", "x"), (None, "n"), ("b", "2"), ("b", "3")]))


def test_index_copies_leave_out_what_follows_from_the_text(spark, monkeypatch):
    df = spark.createDataFrame([("d", 0, " One"), ("d", 0, "Two"), ("d", 1, "Three ")], "doc_id string, chunk_id long, text string")
    df = retrieval.keyed_chunks(df.withColumn("doc_type", F.lit("t")))
    copies = []

    def spy(df, name, *args):
        out = stored(df, name, *args)
        copies.append(spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0]).columns)
        return out
    monkeypatch.setattr(index_job, "stored", spy)
    rows = []
    for name, derived in (("index_plain", None), ("index_lean", retrieval.derived_columns())):
        audit = index_job.build_index(df, name, derived=derived)
        assert [tuple(r) for r in audit.orderBy("stage").collect()] == [("delivered", 3, 1), ("indexed", 2, 0)]
        assert spark.table(name).columns == df.columns
        rows.append(sorted(map(tuple, spark.table(name).collect())))
        tables.drop_table(spark, name)
    assert rows[0] == rows[1] and len(rows[0]) == 2
    assert ["text_clean" in c for c in copies] == [True, False]


def test_asked_ranges_and_predictions(spark):
    asked = spark.createDataFrame([
        ("a", "Forecast ERROR and click between 2024-01-02 and 2024-01-03, please"), ("b", "predict error on 2024-01-03"),
        ("c", "predict nothing 2024-99-99"), ("d", "predict error"), ("e", None), ("f", "predict terrors")],
        "question_id string, question string")
    scores = spark.createDataFrame(
        [("error", f"2024-01-0{d} 10:00:00", d % 2 == 0, float(d)) for d in range(1, 6)] + [("click", "2024-02-01 00:00:00", None, None)],
        "service_name string, t string, is_anomaly boolean, risk_score double").withColumn("timestamp", F.to_timestamp_ntz("t"))
    ranges = assistant.asked_ranges(asked, scores.select(F.col("service_name").alias("entity_id")).distinct())
    assert {(r.question_id, r.entity_id, str(r.start_date), str(r.end_date)) for r in ranges.collect()} == {
        ("a", "error", "2024-01-02", "2024-01-03"), ("a", "click", "2024-01-02", "2024-01-03"),
        ("b", "error", "2024-01-03", "None"), ("d", "error", "None", "None")}
    got = {(r.question_id, r.entity_id): (r.incidents, round(r.prediction, 6), r.mean_score)
           for r in assistant.asked_predictions(ranges, scores).collect()}
    assert got == {("a", "error"): (2, .5, 2.5), ("a", "click"): (0, 0, None), ("b", "error"): (3, round(1 / 3, 6), 4.0),
                   ("d", "error"): (5, .4, 3.0)}


def test_latest_run_of_each_model(spark, tmp_path):
    rows = [("r1", "p", "m", "metric", "f1", "0.1", "2024-01-01 00:00:00"), ("r2", "p", "m", "metric", "f1", "0.2", "2024-01-02 00:00:00"),
            ("r3", "p", "m", "metric", "f1", "0.3", "2024-01-02 00:00:00"), ("r1", "p", "n", "param", "k", "v", "2024-01-01 00:00:00"),
            ("p", None, "", "tag", "domain", "x", "2024-01-03 00:00:00")]
    log = spark.createDataFrame(rows, schemas.RUN_METRICS.simpleString().replace("struct<", "").replace(">", "").replace(
        "logged_at:timestamp", "logged_at:string")).withColumn("logged_at", F.to_timestamp("logged_at"))
    tracking.append_log(log.where("run_id <> 'r3'"), "log_of_runs", str(tmp_path / "log"))
    tracking.append_log(log.where("run_id = 'r3'"), "log_of_runs", str(tmp_path / "log"))
    got = tracking.latest_runs(spark.table("log_of_runs")).collect()
    assert {(r.model, r.run_id, r.value) for r in got} == {("m", "r3", "0.3"), ("n", "r1", "v")}
    assert spark.table("log_of_runs").count() == 5
    tables.drop_table(spark, "log_of_runs")
