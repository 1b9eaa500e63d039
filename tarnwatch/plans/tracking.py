"""Detector runs logged under one parent run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CONTAMINATION, TRACKING_FEATURES
from ..operators.detectors import detector_metrics, metric_log
from ..schemas import RUN_METRICS
from ..sources.tables import save_table
from .scoring_job import anomaly_scores


def run_tags(like: DataFrame, run_id: str, tags: dict[str, str], logged_at: Column) -> DataFrame:
    """Tags of a run as log rows."""
    rows = [(run_id, "tag", key, value) for key, value in tags.items()]
    return like.sparkSession.createDataFrame(
        rows, "run_id string, kind string, key string, value string"
    ).select(
        "run_id", F.lit(None).cast("string").alias("parent_run_id"),
        F.lit("").alias("model"), "kind", "key", "value",
        logged_at.cast("timestamp").alias("logged_at"),
    )


def track_detectors(features: DataFrame, logged_at: Column, parent: str = "anomaly_detection_parent",
                    columns: list[str] = TRACKING_FEATURES,
                    tags: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Score with both detectors and log each as a child run: (scores, log rows)."""
    scores = anomaly_scores(features, columns, run_id="isolation_forest")
    runs = [
        ("z_score_model", "z_anomaly", {"method": "z_score"}),
        ("isolation_forest", "if_anomaly",
         {"model": "IsolationForest", "contamination": CONTAMINATION}),
    ]
    log = run_tags(features, parent, tags or {"domain": "operations", "version": "1.0"}, logged_at)
    for run_id, flag, params in runs:
        metrics = detector_metrics(scores, flag)
        log = log.unionByName(metric_log(metrics, run_id, parent, run_id, params, logged_at))
    return scores, log.select(*RUN_METRICS.names)


def append_log(log: DataFrame, table: str = "run_metrics", path: str | None = None) -> None:
    """Append a run's rows to the log, a partition per day of logging."""
    save_table(log.withColumn("log_date", F.to_date("logged_at")), table, "append", ("log_date",), path=path)


def latest_runs(log: DataFrame) -> DataFrame:
    """The log rows of the last run of each model (tags excluded), by time of logging and then run id.

    Runs are reduced to one row per model first; the rows join on it.
    """
    runs = log.where("model <> ''")
    last = runs.groupBy("model").agg(F.max(F.struct("logged_at", "run_id")).alias("last")).select("model", "last.*")
    return runs.join(last, ["model", "logged_at", "run_id"], "left_semi")
