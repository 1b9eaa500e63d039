"""Registered queries and the SQL that repeats them.

`queries()` maps a name to a callable (spark, sf_dir) -> DataFrame over the whole tables;
`oracle_sql()` holds the same result in SQL where SQL can state it.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tarnwatch import constants as C
from tarnwatch import schemas
from tarnwatch.functions.columns import calendar_columns
from tarnwatch.functions.text import question_words
from tarnwatch.operators.bounded import scratch_dir, stored
from tarnwatch.operators import detectors, forest, monitoring, ranking, retrieval, vector_index, windows
from tarnwatch.oracle import ORACLE_SQL
from tarnwatch.plans import answers, assistant, feature_job, index_job as indexing, reports, scoring_job, tracking
from tarnwatch.sources import corpus, tables
from tarnwatch.sources.incidents import incidents_from_events

AS_OF = "2024-01-31"
PROFILE = ["service_name", "severity", "region", "team", "root_cause"]
DRIFT_NUMERIC = ["resolution_time_mins", "severity", "sla_threshold_mins", "repeat_incident"]
DRIFT_CATEGORIES = ["service_name", "region", "team", "root_cause"]


# --- Shared inputs ------------------------------------------------------------

def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return tables.read_table(spark, d, name)


def _incidents(spark: SparkSession, d: str) -> DataFrame:
    return incidents_from_events(_table(spark, d, "events"))


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    """Incidents with the z-score verdict in the columns of a scored table."""
    return detectors.with_zscore(_incidents(spark, d)).withColumns({
        "label_anomaly": F.col("is_anomaly"),
        "if_anomaly": F.col("z_anomaly"),
        "is_anomaly": F.col("z_anomaly").cast("boolean"),
        "risk_score": F.abs("z_score"),
    })


def _features(spark: SparkSession, d: str) -> DataFrame:
    return feature_job.feature_table(_incidents(spark, d))


def _saved_features(spark: SparkSession, d: str) -> DataFrame:
    """The feature table as detectors find it: written once, then read."""
    return stored(_features(spark, d), "features")


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    return corpus.assemble(
        corpus.from_documents(_table(spark, d, "documents")),
        corpus.from_pages(_table(spark, d, "pages")),
        corpus.from_conversations(_table(spark, d, "conversations")),
        corpus.from_incidents(_incidents(spark, d)),
    )


def _document_chunks(spark: SparkSession, d: str) -> DataFrame:
    docs = corpus.from_documents(_table(spark, d, "documents"))
    return retrieval.keyed_chunks(retrieval.chunk_documents(docs))


def _corpus_chunks(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.keyed_chunks(retrieval.chunk_documents(_corpus(spark, d), dealt=True))


def _stored_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The chunk table that retrieval reads: cut once, then scanned for scores and for texts."""
    return stored(_corpus_chunks(spark, d), "rag-chunks")


def _benchmark_questions(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("question_id"),
        F.col("text").alias("question"),
        question_words("text").alias("keywords"))


def _sample_questions(spark: SparkSession) -> DataFrame:
    return corpus.sample_questions(spark).withColumn("keywords", question_words("question"))


def _all_questions(spark: SparkSession, d: str) -> DataFrame:
    return corpus.user_questions(_table(spark, d, "conversations")).unionByName(
        corpus.sample_questions(spark))


def _rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def _settled(df: DataFrame, *columns: str) -> DataFrame:
    """Round means of decimal values off the exact halves, where engines differ."""
    return df.withColumns({c: F.round(F.col(c) + F.lit(1e-8), 6) for c in columns})


ROLLING = [f"rolling_{s}_{n}" for n in C.FRAME_ROWS for s in ("mean", "std")]


# --- Incidents and features ---------------------------------------------------

def incidents(spark, d):
    return _rounded(_incidents(spark, d), 4, "resolution_time_mins")


def exact_fraction_pick(spark, d):
    picked = ranking.pick_fraction(_table(spark, d, "events"), "event_id", 0.05)
    return picked.select("event_id", "picked")


def planted_incidents(spark, d):
    """Incidents with an exact share of planted rows, summed per service."""
    picked = ranking.pick_fraction(_table(spark, d, "events"), "event_id", 0.05)
    df = incidents_from_events(picked, planted="picked").groupBy("service_name").agg(
        F.count("*").alias("incidents"), F.sum("is_anomaly").cast("bigint").alias("planted"),
        F.count_if("sla_breached").alias("breached"),
        F.sum("resolution_time_mins").alias("minutes"))
    return _rounded(df, 2, "minutes")


def calendar_features(spark, d):
    return _incidents(spark, d).select("incident_id", *calendar_columns()).drop("is_month_end")


def month_end_flag(spark, d):
    orders = _table(spark, d, "orders")
    flag = calendar_columns("o_orderdate")[-1]
    whole_day = calendar_columns("o_orderdate", month_end="calendar")[-1]
    return orders.select("o_orderkey", flag, whole_day.alias("is_month_end_day"))


def lag_features(spark, d):
    df = windows.with_history(_incidents(spark, d), "service_name", feature_job.ORDER,
                              "resolution_time_mins", frames={})
    return _rounded(df.select("incident_id", "service_name", *C.LAG_ROWS), 4, *C.LAG_ROWS)


def rolling_features(spark, d):
    df = windows.with_history(_incidents(spark, d), "service_name", feature_job.ORDER,
                              "resolution_time_mins", lags={})
    return _settled(df.select("incident_id", "service_name", *ROLLING), *ROLLING)


def sharded_history(spark, d):
    df = windows.with_sharded_history(_incidents(spark, d), "service_name", feature_job.ORDER,
                                      "resolution_time_mins", shard_rows=5_000)
    df = df.select("incident_id", "service_name", *C.LAG_ROWS, *ROLLING)
    return _settled(_rounded(df, 4, *C.LAG_ROWS), *ROLLING)


def time_rolling(spark, d):
    df = windows.hourly_trailing_means(
        _incidents(spark, d), "service_name", "timestamp", "resolution_time_mins",
        {"7d": 7, "14d": 14, "30d": 30})
    return _settled(df, *[f"trailing_mean_{n}" for n in ("7d", "14d", "30d")])


def service_total_join(spark, d):
    df = monitoring.with_service_total(_incidents(spark, d))
    df = df.select("service_name", "incident_id", "total_resolution_time")
    return _rounded(df, 2, "total_resolution_time")


def feature_table(spark, d):
    df = _rounded(_features(spark, d), 4, "resolution_time_mins", *C.LAG_ROWS,
                  "severity_x_resolution")
    return _settled(_rounded(df, 2, "total_resolution_time"), *ROLLING)


def features_of_a_day(spark, d):
    """The features written by day, then one day read: its scan lists one folder."""
    folder = f"{scratch_dir(spark)}/features-{os.urandom(6).hex()}"
    feature_job.save_features(_features(spark, d), folder)
    df = feature_job.read_features(spark, folder, "2024-01-15", "2024-01-15").drop("event_date")
    df = _rounded(df, 4, "resolution_time_mins", *C.LAG_ROWS, "severity_x_resolution")
    return _settled(_rounded(df, 2, "total_resolution_time"), *ROLLING)


def feature_vectors(spark, d):
    df = detectors.with_zscore(_features(spark, d))
    df = df.select("incident_id", *detectors.feature_vector(C.TRACKING_FEATURES))
    df = _rounded(df, 4, "resolution_time_mins", *C.LAG_ROWS, "severity_x_resolution")
    return _settled(df, *ROLLING, "z_score")


# --- Detectors ----------------------------------------------------------------

def zscore_flags(spark, d):
    df = detectors.with_zscore(_incidents(spark, d))
    return _rounded(df.select("incident_id", "service_name", "z_score", "z_anomaly"), 6, "z_score")


def zscore_metrics(spark, d):
    df = detectors.detector_metrics(_flagged(spark, d), "z_anomaly")
    return _rounded(df, 6, "precision", "recall", "f1")


def zscore_metrics_vs_label(spark, d):
    df = detectors.detector_metrics(_flagged(spark, d), "z_anomaly", "label_anomaly",
                                    by=["service_name"])
    return _rounded(df, 6, "precision", "recall", "f1")


def contamination_cutoff(spark, d):
    """Rows at or above the 95th percentile of |z|, the same cut the forest makes."""
    df = stored(_flagged(spark, d).select("service_name", "risk_score"), "risk")
    cutoff = ranking.exact_quantile(df, "risk_score", 1 - C.CONTAMINATION)
    return df.groupBy("service_name").agg(
        F.round(F.lit(cutoff), 6).alias("cutoff"),
        F.count_if(F.col("risk_score") > F.lit(cutoff)).alias("flagged"))


def isolation_forest_scores(spark, d):
    df = scoring_job.anomaly_scores(_saved_features(spark, d), C.BATCH_FEATURES, run_id="bench")
    df = df.select("incident_id", "service_name", "anomaly_score", "risk_score",
                   "if_anomaly", "is_anomaly", "anomaly_type", "model_name")
    return _rounded(df, 6, "anomaly_score", "risk_score")


def forest_verdict_share(spark, d):
    """Flagged rows of the forest: the share that contamination asks for, as SQL can tell."""
    features = _saved_features(spark, d)
    nodes = forest.fit_forest(features, C.BASE_FEATURES)
    scored = scoring_job.score_with_forest(features, nodes, C.BASE_FEATURES)
    return scored.agg(F.count("*").alias("rows"),
                      F.sum("if_anomaly").cast("bigint").alias("flagged"))


def detector_comparison(spark, d):
    df = scoring_job.anomaly_scores(_saved_features(spark, d), run_id="bench")
    df = detectors.compare_detectors(
        df, {"isolation_forest": "if_anomaly", "z_score_baseline": "z_anomaly"})
    return _rounded(df, 6, "precision", "recall", "f1")


def rule_comparison(spark, d):
    """The comparison on two flags that SQL can compute: z-score and planted label."""
    df = detectors.compare_detectors(
        _flagged(spark, d), {"z_score": "z_anomaly", "planted": "label_anomaly"})
    return _rounded(df, 6, "precision", "recall", "f1")


def arm_split_metrics(spark, d):
    df = detectors.detector_metrics(
        detectors.with_arm(_flagged(spark, d)), "z_anomaly", by=["arm"])
    return _rounded(df, 6, "precision", "recall", "f1")


def run_metrics(spark, d):
    metrics = zscore_metrics(spark, d)
    return detectors.metric_log(
        metrics, "run-z", "run-parent", "z_score_baseline", {"method": "z_score"},
        F.lit("2024-01-31 00:00:00")).withColumn(
        "logged_at", F.col("logged_at").cast("timestamp_ntz"))


def tracked_runs(spark, d):
    """Both detectors on the fourteen features, logged under one parent run."""
    _, log = tracking.track_detectors(_saved_features(spark, d), F.lit("2024-01-31 00:00:00"))
    return log.drop("logged_at")


def latest_run_metrics(spark, d):
    """Weekly runs of the z-score detector appended to the log; the last one is looked up."""
    name = f"run_metrics_{os.urandom(6).hex()}"
    flagged = stored(_flagged(spark, d).withColumn("week", F.date_trunc("week", "timestamp")), "flagged")
    weekly = detectors.detector_metrics(flagged, "z_anomaly", by=["week"]).withColumn(
        "run_id", F.concat(F.lit("week-"), F.date_format("week", "yyyy-MM-dd")))
    log = _rounded(weekly, 6, "precision", "recall", "f1").select("run_id", F.col("week").alias("logged_at"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in ("precision", "recall", "f1")])))
    log = log.select("run_id", F.lit("weekly").alias("parent_run_id"), F.lit("z_score").alias("model"),
                     F.lit("metric").alias("kind"), "key", "value", F.col("logged_at").cast("timestamp").alias("logged_at"))
    tracking.append_log(log, name, f"{scratch_dir(spark)}/{name}")
    return tracking.latest_runs(spark.table(name)).select("run_id", "model", "key", "value")


def replaced_table(spark, d):
    """Counts per service saved, replaced by those of the whole month, listed and queried; a second table is dropped."""
    run = os.urandom(6).hex()
    name, other = f"service_counts_{run}", f"service_counts_old_{run}"
    folder = f"{scratch_dir(spark)}/{name}"
    rows = _incidents(spark, d)
    for part in (rows.where("timestamp < '2024-01-10'"), rows):
        counts = part.groupBy("service_name").agg(F.count("*").alias("incidents"))
        tables.replace_table(counts, name, path=folder)
    tables.save_table(spark.table(name), other, path=f"{folder}-old")
    before = [r.tableName for r in tables.list_tables(spark).collect()]
    tables.drop_table(spark, other)
    after = [r.tableName for r in tables.list_tables(spark).collect()]
    return tables.query_table(spark, name, "incidents > 0", frozenset({name})).withColumns({
        "listed": F.lit(name in after and other in before), "dropped": F.lit(other not in after)})


def null_report(spark, d):
    return tables.null_report(_features(spark, d),
                              ["resolution_time_mins", "lag_30d", "rolling_std_14d",
                               "rolling_std_30d"])


def schema_report(spark, d):
    """The declared schema against the table as read, with its number of rows."""
    df = _features(spark, d)
    total = df.select(F.count("*")).scalar()
    return tables.schema_report(df, schemas.ANOMALY_SCORES).withColumn("rows", total)


def _score_batch_table(spark, d, **job):
    folder = f"{scratch_dir(spark)}/scored-{os.urandom(6).hex()}"
    name = f"anomaly_scores_{os.path.basename(folder).split('-')[1]}"
    return scoring_job.score_batch(_saved_features(spark, d), table=name, path=folder,
                                   run_id="batch", **job)


def score_batch(spark, d):
    scored = _score_batch_table(spark, d, scoring_date="2024-01-15").drop("scored_at")
    scored = _rounded(scored, 4, "resolution_time_mins", *C.LAG_ROWS, "severity_x_resolution")
    scored = _settled(_rounded(scored, 2, "total_resolution_time"), *ROLLING)
    return _rounded(scored, 6, "z_score", "anomaly_score", "risk_score")


def score_batch_days(spark, d):
    """Rows per day of the whole scored table, which SQL can count."""
    scored = _score_batch_table(spark, d)
    return scored.groupBy(F.to_date("timestamp").cast("string").alias("day")).agg(
        F.count("*").alias("incidents"),
        F.sum(F.col("label_anomaly").cast("bigint")).alias("planted"))


def saved_model_scores(spark, d):
    """A model trained on the first three weeks scores the recent days with its own cutoff."""
    features = monitoring.split_windows(_saved_features(spark, d), AS_OF)
    model = scoring_job.train_model(features.where("window = 'baseline'"))
    recent = features.where("window = 'current'").drop("window")
    df = scoring_job.anomaly_scores(recent, model=model, run_id="saved")
    return _rounded(df.select("incident_id", "service_name", "anomaly_score", "if_anomaly"), 6, "anomaly_score")


def aliased_model_scores(spark, d):
    """Two stored models, looked up by alias, judge the recent days."""
    folder = f"{scratch_dir(spark)}/models-{os.urandom(6).hex()}"
    features = monitoring.split_windows(_saved_features(spark, d), AS_OF)
    for alias, share in (("champion", C.CONTAMINATION), ("challenger", 2 * C.CONTAMINATION)):
        model = scoring_job.train_model(features.where("window = 'baseline'"), contamination=share)
        scoring_job.save_model(model, folder, alias, "2024-01-24")
    recent = features.where("window = 'current'").drop("window")
    parts = [scoring_job.anomaly_scores(recent, model=scoring_job.load_model(spark, folder, alias, AS_OF)).select(
        F.lit(alias).alias("alias"), "incident_id", "anomaly_score", "if_anomaly") for alias in ("champion", "challenger")]
    return _rounded(parts[0].unionAll(parts[1]), 6, "anomaly_score")


def model_performance(spark, d):
    scores = _flagged(spark, d).withColumns({
        "model_name": F.when(F.col("service_name") == "error", "z_error").otherwise("z_other"),
        "scored_at": F.col("timestamp")})
    df = scoring_job.model_performance(scores, "z_other")
    return _rounded(df, 6, "precision", "recall", "f1")


# --- Monitoring ---------------------------------------------------------------

def alert_fatigue(spark, d):
    # Low z threshold, so that the fixture has alerts without a breach.
    df = detectors.with_zscore(_incidents(spark, d), threshold=0.5)
    df = monitoring.alert_fatigue(df, AS_OF, flag="z_anomaly")
    return _rounded(df, 6, "alert_fatigue_rate")


def alert_triggers(spark, d):
    return monitoring.alert_triggers(alert_fatigue(spark, d), 0.12)


def numeric_drift(spark, d):
    df = monitoring.split_windows(_incidents(spark, d), AS_OF)
    df = monitoring.numeric_drift(df, DRIFT_NUMERIC)
    return _rounded(_settled(df, "baseline_mean", "current_mean"), 4,
                    "baseline_var", "current_var", "z", "variance_ratio")


def categorical_drift(spark, d):
    df = monitoring.split_windows(_incidents(spark, d), AS_OF)
    return _rounded(monitoring.categorical_drift(df, DRIFT_CATEGORIES), 4, "chi2")


def drift_significance(spark, d):
    """p-values of both drift tests."""
    df = monitoring.split_windows(_incidents(spark, d), AS_OF)
    chi = monitoring.categorical_drift(df, DRIFT_CATEGORIES).select(
        "feature", F.lit("chi-square").alias("test"),
        monitoring.chi2_tail("chi2", "dof").alias("p_value"))
    z = monitoring.numeric_drift(df, DRIFT_NUMERIC).select(
        "feature", F.lit("z").alias("test"), monitoring.normal_tail("z").alias("p_value"))
    return _rounded(chi.unionByName(z), 6, "p_value")


def quality_profile(spark, d):
    return monitoring.quality_profile(_incidents(spark, d), PROFILE)


def incident_checks(spark, d):
    return monitoring.incident_checks(_incidents(spark, d))


# --- Reports ------------------------------------------------------------------

def anomalies_by_service(spark, d):
    return reports.anomalies_by_service(_flagged(spark, d))


def anomaly_trend_daily(spark, d):
    return reports.anomaly_trend(_flagged(spark, d))


def anomaly_trend_hourly(spark, d):
    return reports.anomaly_trend(_flagged(spark, d), "hour")


def resolution_by_team(spark, d):
    return _settled(reports.resolution_by_team(_flagged(spark, d)), "avg_resolution_time")


def top_incidents(spark, d):
    return _rounded(reports.top_incidents(_flagged(spark, d)), 4,
                    "risk_score", "resolution_time_mins")


def sla_breach_rate(spark, d):
    return reports.sla_breach_rate(_flagged(spark, d))


def incident_volume_daily(spark, d):
    return reports.incident_volume(_incidents(spark, d))


def incident_volume_weekly(spark, d):
    return reports.incident_volume(_incidents(spark, d), "week")


def breach_rate_by_service(spark, d):
    return _rounded(reports.breach_rate_by_service(_incidents(spark, d)), 6, "breach_rate")


def severity_breakdown(spark, d):
    return _rounded(reports.severity_breakdown(_incidents(spark, d)), 6, "share")


def score_histogram(spark, d):
    return reports.score_histogram(_flagged(spark, d), "risk_score", 0.25)


def dashboard_filters(spark, d):
    df = reports.dashboard_filter(_flagged(spark, d), "2024-01-08", "2024-01-22",
                                  ["error", "purchase"])
    return reports.incident_volume(df)


def anomaly_rate_by_service(spark, d):
    return _rounded(reports.anomaly_rate_by_service(_flagged(spark, d)), 6, "anomaly_rate")


def table_predicate(spark, d):
    _incidents(spark, d).createOrReplaceTempView("queried_incidents")
    df = tables.query_table(spark, "queried_incidents", "severity = 1 AND sla_breached",
                            allowed=tables.TABLES | {"queried_incidents"})
    return df.select("incident_id", "service_name", "severity", "sla_breached")


def preview_ordered(spark, d):
    df = tables.preview(_incidents(spark, d), ["timestamp", "incident_id"])
    return df.select("incident_id", "timestamp", "service_name", "severity")


# --- Corpus and retrieval -----------------------------------------------------

def corpus_union(spark, d):
    """Every document; the text by length and digest."""
    return _corpus(spark, d).select(
        "doc_id", "doc_type", "title", "created_date", F.col("metadata")["author"].alias("author"),
        F.length("content").cast("bigint").alias("length"), F.md5("content").alias("digest"))


def documents_by_type(spark, d):
    return _corpus(spark, d).groupBy("doc_type").agg(F.count("*").alias("documents"))


def chunks(spark, d):
    return _corpus_chunks(spark, d).select("doc_id", "chunk_id", "doc_type", "text")


def _delivered_twice(spark, d) -> DataFrame:
    """Document chunks and a second delivery of them with other line breaks."""
    first = retrieval.chunk_documents(corpus.from_documents(_table(spark, d, "documents")))
    again = first.withColumn("text", F.translate("text", "\n", " "))
    return retrieval.keyed_chunks(first.unionByName(again))


def chunk_duplicates(spark, d):
    return retrieval.duplicate_keys(_delivered_twice(spark, d))


def chunks_indexed(spark, d):
    df = retrieval.drop_duplicate_keys(_delivered_twice(spark, d), "id", "text", retrieval.derived_columns())
    return df.select("id", "doc_id", "chunk_id", "doc_type", "text", "text_clean")


def index_job(spark, d):
    """The chunk table as a job saves it: keys audited before and after."""
    run = os.urandom(6).hex()
    return indexing.build_index(_delivered_twice(spark, d), f"rag_chunks_fixed_{run}",
                                f"{scratch_dir(spark)}/rag-chunks-{run}", retrieval.derived_columns())


def _new_delivery(spark, d) -> DataFrame:
    """Chunks of the next delivery: one source rewritten, toxic ones gone, pages added."""
    docs = _table(spark, d, "documents")
    toxic = _table(spark, d, "labels").where("toxic = 1").select("doc_id")
    edited = docs.join(toxic, "doc_id", "left_anti").withColumn(
        "text", F.when(F.col("source") == "src1", F.translate("text", ".", ";")).otherwise(F.col("text")))
    new = corpus.assemble(corpus.from_documents(edited),
                          corpus.from_pages(_table(spark, d, "pages")))
    return retrieval.keyed_chunks(retrieval.chunk_documents(new, dealt=True))


def chunk_snapshot_diff(spark, d):
    """Last delivery against a new one."""
    return tables.snapshot_diff(_document_chunks(spark, d), _new_delivery(spark, d), "id", F.col("text"))


def updated_chunks(spark, d):
    """The stored chunk table after the new delivery's changes were applied to it, by buckets of keys."""
    folder = f"{scratch_dir(spark)}/chunk-table-{os.urandom(6).hex()}"
    indexing.save_buckets(_document_chunks(spark, d), folder, derived=retrieval.derived_columns())
    new = stored(_new_delivery(spark, d), "delivery", retrieval.derived_columns(), "zstd")
    indexing.apply_changes(new, folder, derived=retrieval.derived_columns())
    return indexing.read_buckets(spark, folder, new, retrieval.derived_columns()).select("id", "doc_type", F.md5("text").alias("digest"))


def keyword_hits(spark, d):
    df = retrieval.keyword_hits(_corpus_chunks(spark, d), C.KEYWORD_SETS["sla policy"])
    return df.select("id", "score")


def keyword_hits_sets(spark, d):
    """All three keyword sets as questions: hits by score."""
    sets = [(name, words) for name, words in C.KEYWORD_SETS.items()]
    questions = spark.createDataFrame(sets, "question_id string, keywords array<string>")
    scored = retrieval.score_questions(_corpus_chunks(spark, d), questions)
    return scored.groupBy("question_id", F.col("score").cast("bigint").alias("score")).agg(
        F.count("*").alias("chunks"))


def keyword_hits_batch(spark, d):
    hits = retrieval.retrieve_by_keywords(
        stored(_document_chunks(spark, d), "rag-chunks"), _benchmark_questions(spark, d))
    return hits.select("question_id", "retrieval_rank", "id", "score")


def knn_topk(spark, d):
    vectors = _table(spark, d, "embeddings")
    df = retrieval.vector_top_k(vectors, retrieval.label_profiles(vectors))
    return _rounded(df.select("query_id", "vec_id", "similarity", "rank"), 6, "similarity")


def knn_topk_by_cell(spark, d):
    """The same search by the path for query tables of any size."""
    vectors = _table(spark, d, "embeddings")
    df = retrieval.vector_top_k(vectors, retrieval.label_profiles(vectors), inline=4,
                                cell_rows=250)
    return _rounded(df.select("query_id", "vec_id", "similarity", "rank"), 6, "similarity")


def vector_index_recall(spark, d):
    """Every row is indexed; every twentieth vector asks the cell index and the exact search."""
    vectors = _table(spark, d, "embeddings").select("vec_id", "embedding")
    asked = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    centres = vector_index.fit_centres(vectors)
    index = vector_index.build_index(vectors, centres)
    found = vector_index.search(index, centres, asked, probes=vector_index.probes_for(index, centres))
    reached = vector_index.recall(found, retrieval.vector_top_k(vectors, asked))
    return reached.select("queries", "wanted", (F.col("recall") >= 0.9).alias("reached"))


def _sample_hits(spark, d) -> tuple[DataFrame, DataFrame]:
    questions = _sample_questions(spark)
    return questions, retrieval.retrieve_by_keywords(_stored_chunks(spark, d), questions)


def rerank_length(spark, d):
    _, hits = _sample_hits(spark, d)
    return answers.rerank(hits).select("question_id", "id", "retrieval_rank", "rank")


def prompts(spark, d):
    questions, hits = _sample_hits(spark, d)
    return answers.prompts(questions, answers.rerank(hits))


def cited_answers(spark, d):
    return answers.answer_questions(_sample_questions(spark), _stored_chunks(spark, d))


def cited_answers_batch(spark, d):
    """Benchmark passages as questions, answered from the documents."""
    return answers.answer_questions(_benchmark_questions(spark, d), stored(_document_chunks(spark, d), "rag-chunks"))


# --- Assistant ----------------------------------------------------------------

def question_routes(spark, d):
    df = assistant.route(_all_questions(spark, d))
    return df.select("question_id", F.array_join("tools", ",").alias("tools"))


def sla_status(spark, d):
    df = assistant.sla_status(_flagged(spark, d))
    return df.withColumn("top_anomaly_services",
                         assistant.service_list(F.col("top_anomaly_services")))


def knowledge_lookup(spark, d):
    return assistant.knowledge(corpus.sample_questions(spark), _stored_chunks(spark, d))


def prediction_lookup(spark, d):
    df = scoring_job.prediction_lookup(_flagged(spark, d), "error", "2024-01-01", "2024-01-15")
    return _rounded(df, 6, "prediction", "mean_score")


def _assisted(spark, d, mode) -> DataFrame:
    flagged = _flagged(spark, d)
    prediction = scoring_job.prediction_lookup(flagged, "error", "2024-01-01", "2024-01-31")
    performance = detectors.detector_metrics(flagged, "z_anomaly").select(
        F.lit("z_score").alias("model_name"), *[F.round(c, 4).alias(c)
                                                for c in ("precision", "recall", "f1")])
    return assistant.assist(
        _all_questions(spark, d), assistant.sla_status(flagged), prediction, performance,
        _stored_chunks(spark, d), mode=mode)


def assistant_context(spark, d):
    return _assisted(spark, d, "keywords").select("question_id", "context", "prompt")


def assistant_context_first_k(spark, d):
    return _assisted(spark, d, "first_k").select("question_id", "context")


def assistant_trace(spark, d):
    return _assisted(spark, d, "keywords").select(
        "question_id", F.to_json("tool_trace").alias("trace"))


def assistant_tools(spark, d):
    """What all four tools give: the users' questions, and one per service and week about its own data."""
    flagged = _flagged(spark, d)
    weeks = flagged.select("service_name", F.trunc(F.to_date("timestamp"), "week").alias("week")).distinct()
    asked = weeks.select(
        F.concat_ws("_", F.lit("week"), "service_name", "week").alias("question_id"),
        F.concat_ws(" ", F.lit("predict"), "service_name", F.lit("from"), "week", F.lit("to"), F.date_add("week", 6),
                    F.lit("and the performance of model z_score")).alias("question"))
    performance = detectors.detector_metrics(flagged, "z_anomaly").select(F.lit("z_score").alias("model_name"), "f1")
    df = assistant.tool_outputs(_all_questions(spark, d).unionByName(asked), flagged, performance, _document_chunks(spark, d))
    return _rounded(df, 6, "prediction", "f1")


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    incidents, exact_fraction_pick, planted_incidents, calendar_features, month_end_flag, lag_features,
    rolling_features, sharded_history, time_rolling, service_total_join, feature_table,
    features_of_a_day, feature_vectors,
    zscore_flags, zscore_metrics, zscore_metrics_vs_label, contamination_cutoff,
    isolation_forest_scores, forest_verdict_share, detector_comparison, rule_comparison,
    arm_split_metrics, run_metrics, tracked_runs, latest_run_metrics, replaced_table, null_report, schema_report, score_batch, score_batch_days,
    saved_model_scores, aliased_model_scores, model_performance,
    alert_fatigue, alert_triggers, numeric_drift, categorical_drift, drift_significance,
    quality_profile, incident_checks,
    anomalies_by_service, anomaly_trend_daily, anomaly_trend_hourly, resolution_by_team,
    top_incidents, sla_breach_rate, incident_volume_daily, incident_volume_weekly,
    breach_rate_by_service, severity_breakdown, score_histogram, dashboard_filters,
    anomaly_rate_by_service, table_predicate, preview_ordered,
    corpus_union, documents_by_type, chunks, chunk_duplicates, chunks_indexed,
    index_job, chunk_snapshot_diff, updated_chunks, keyword_hits, keyword_hits_sets, keyword_hits_batch, knn_topk,
    knn_topk_by_cell, vector_index_recall, rerank_length, prompts, cited_answers, cited_answers_batch,
    question_routes, knowledge_lookup, sla_status, prediction_lookup, assistant_context,
    assistant_context_first_k, assistant_trace, assistant_tools,
]


def entry(spark: SparkSession) -> DataFrame:
    """Events to incidents, z-score verdict per service, anomalies per service."""
    return anomalies_by_service(spark, "/root/testdata/sf0.001")


# The training-data operators and their pipeline are optional: without them the rest stands.
try:
    import corpus_pipeline
    from tarnwatch.llm import registry as llm_registry
except ImportError as missing:
    absent = missing.name or ""
    if absent != "corpus_pipeline" and not absent.startswith("tarnwatch.llm"):
        raise
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = {**llm_registry.QUERIES, "pipeline": corpus_pipeline.run}
    LLM_SQL = dict(llm_registry.ORACLE_SQL)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES} | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL) | LLM_SQL
