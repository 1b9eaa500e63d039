"""Fit, score, verdict, log and store: the detector jobs."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

from ..constants import (
    ANOMALY_TYPE, BATCH_FEATURES, CONTAMINATION, MODEL_NAME, SEED,
)
from ..operators.bounded import stored
from ..operators.detectors import detector_metrics, with_zscore
from ..operators.forest import (
    contamination_offset, fit_forest, forest_score, with_forest_verdict,
)
from ..schemas import ANOMALY_SCORES, FOREST_NODES
from ..sources.tables import check_schema, replace_table, require_not_null, save_table


def score_with_forest(features: DataFrame, nodes: DataFrame, columns: list[str],
                      contamination: float = CONTAMINATION,
                      offset: float | None = None) -> DataFrame:
    """Features plus decision score, risk and verdict.

    Raw scores are written once; the cutoff and the result both read that copy. Pass a
    known `offset` to score new rows with the cutoff of the training data.
    """
    raw = features.withColumn("_raw", forest_score(nodes, columns))
    if offset is None:
        raw = stored(raw, "scores")
        offset = contamination_offset(raw, "_raw", contamination)
    return with_forest_verdict(raw, "_raw", offset).drop("_raw")


def train_model(features: DataFrame, columns: list[str] = BATCH_FEATURES, seed: int = SEED,
                contamination: float = CONTAMINATION) -> DataFrame:
    """A model to keep: node rows with the cutoff of the training scores on each.

    Written once and read by every later scoring run; it has a few ten thousand rows.
    """
    nodes = stored(fit_forest(features, columns, seed=seed), "forest")
    raw = stored(features.select(forest_score(nodes, columns).alias("_raw")), "scores")
    cutoff = contamination_offset(raw, "_raw", contamination)
    return nodes.withColumn("cutoff", F.lit(cutoff))


def save_model(model: DataFrame, folder: str, alias: str, trained_on: str) -> None:
    """Append a trained model to the store under its alias and the day it was trained on."""
    (model.withColumns({"alias": F.lit(alias), "trained_on": F.lit(trained_on).cast("date")})
     .coalesce(1).write.mode("append").partitionBy("alias", "trained_on").parquet(folder))


def load_model(spark: SparkSession, folder: str, alias: str, as_of: str | None = None) -> DataFrame:
    """The alias's model with the latest day, up to `as_of` if that is given."""
    store = spark.read.schema(StructType([
        *FOREST_NODES.fields, StructField("cutoff", DoubleType()), StructField("alias", StringType()),
        StructField("trained_on", DateType())])).parquet(folder).where(F.col("alias") == alias)
    if as_of is not None:
        store = store.where(F.col("trained_on") <= F.lit(as_of).cast("date"))
    last = store.agg(F.max("trained_on")).first()[0]
    if last is None:
        raise ValueError(f"no model {alias!r} in {folder}")
    return store.where(F.col("trained_on") == F.lit(last)).drop("alias", "trained_on")


def anomaly_scores(features: DataFrame, columns: list[str] = BATCH_FEATURES,
                   run_id: str | None = None, scored_at: dt.datetime | None = None,
                   model: DataFrame | None = None, seed: int = SEED,
                   contamination: float = CONTAMINATION) -> DataFrame:
    """Rows of ANOMALY_SCORES: both detectors and the lineage columns.

    Without a trained `model` a forest is fitted to these rows and cut at their own quantile.
    """
    z = with_zscore(features)
    if model is None:
        scored = score_with_forest(z, fit_forest(z, columns, seed=seed), columns, contamination)
    else:
        scored = score_with_forest(z, model, columns, offset=model.first()["cutoff"])
    when = F.current_timestamp() if scored_at is None else F.lit(scored_at).cast("timestamp")
    scored = scored.withColumnRenamed("is_anomaly", "label_anomaly").withColumns({
        "is_anomaly": F.col("if_anomaly").cast("boolean"),
        "anomaly_type": F.lit(ANOMALY_TYPE),
        "model_name": F.lit(MODEL_NAME),
        "run_id": F.lit(run_id or uuid.uuid4().hex),
        "scored_at": when,
    })
    return check_schema(scored, ANOMALY_SCORES)


def score_batch(features: DataFrame, table: str = "anomaly_scores",
                scoring_date: str | None = None, write_mode: str = "overwrite",
                model_alias: str = "champion", models: dict[str, DataFrame] | None = None,
                path: str | None = None, model_store: str | None = None, **options) -> DataFrame:
    """Check the input, score it, write the table and return it.

    `models` maps an alias to a trained model, or `model_store` is the folder of stored ones, of which
    the alias's last one is taken that was trained before `scoring_date`; without either a forest
    is fitted to the rows at hand. A `scoring_date` limits the job to that day's incidents. An old
    table is replaced once the new one is written.
    """
    if scoring_date is not None:
        start = F.lit(scoring_date).cast("date")
        features = features.where(
            (F.col("timestamp") >= start.cast("timestamp_ntz"))
            & (F.col("timestamp") < F.date_add(start, 1).cast("timestamp_ntz")))
    require_not_null(features, ["resolution_time_mins"])
    spark = features.sparkSession
    model = (models or {}).get(model_alias)
    if model is None and model_store:
        model = load_model(spark, model_store, model_alias, scoring_date)
    scored = anomaly_scores(features, model=model, **options)
    if write_mode == "overwrite":
        replace_table(scored, table, path=path)
    else:
        save_table(scored, table, write_mode, path=path)
    return spark.table(table)


def prediction_lookup(scores: DataFrame, service: str, start: str, end: str,
                      flag: str = "is_anomaly", score: str = "risk_score") -> DataFrame:
    """Flagged share and mean score of a service between two days, both included."""
    first = F.lit(start).cast("date").cast("timestamp_ntz")
    after = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    rows = scores.where((F.col("service_name") == service)
                        & (F.col("timestamp") >= first) & (F.col("timestamp") < after))
    return rows.agg(
        F.lit(service).alias("entity_id"), F.lit(start).alias("start_date"),
        F.lit(end).alias("end_date"),
        F.count("*").alias("incidents"),
        F.coalesce(F.avg(F.col(flag).cast("int")), F.lit(0.0)).alias("prediction"),
        F.avg(score).alias("mean_score"),
    )


def model_performance(scores: DataFrame, model_name: str, flag: str = "is_anomaly",
                      truth: str = "sla_breached") -> DataFrame:
    """Quality of a model's stored verdicts and when they were last made."""
    own = scores.where(F.col("model_name") == model_name)
    last = F.max("scored_at").alias("last_updated")
    return detector_metrics(own, flag, truth, also=[last]).select(
        F.lit(model_name).alias("model_name"), "precision", "recall", "f1", "last_updated")
