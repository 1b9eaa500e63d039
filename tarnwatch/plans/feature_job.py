"""Incidents to the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..constants import IMPUTED_COLUMNS
from ..functions.columns import calendar_columns
from ..operators.monitoring import with_service_total
from ..operators.windows import SHARD_ROWS, with_bucketed_history
from ..schemas import FEATURES_OPERATIONS
from ..sources.tables import check_schema

ORDER = ["timestamp", "incident_id"]


def impute(df: DataFrame) -> DataFrame:
    """Warm-up nulls of the lags and the 7-day statistics become 0; longer frames stay null."""
    return df.fillna({c: 0 for c in IMPUTED_COLUMNS})


def feature_table(incidents: DataFrame, month_end: str = "midnight",
                  shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Calendar parts, lags, rolling statistics, service totals and the interaction."""
    df = incidents.select("*", *calendar_columns(month_end=month_end))
    df = with_bucketed_history(df, "service_name", ORDER, "resolution_time_mins",
                               F.date_trunc("minute", "timestamp"), shard_rows=shard_rows)
    df = with_service_total(df).withColumn(
        "severity_x_resolution", F.col("severity") * F.col("resolution_time_mins"))
    return check_schema(impute(df), FEATURES_OPERATIONS)


STORED = StructType([*FEATURES_OPERATIONS.fields, StructField("event_date", DateType())])


def save_features(features: DataFrame, path: str) -> None:
    """Write the features by day. Days that are written again replace the stored ones, others stay.

    A rebalance gathers the rows of a day; Spark splits large days over tasks by size.
    """
    (check_schema(features, FEATURES_OPERATIONS).withColumn("event_date", F.to_date("timestamp"))
     .hint("rebalance", "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date").parquet(path))


def read_features(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stored features of the days from `first` to `last`, both included, with the declared schema.

    Only the folders of those days are read.
    """
    stored = spark.read.schema(STORED).parquet(path)
    if first is not None:
        stored = stored.where(F.col("event_date") >= F.lit(first).cast("date"))
    if last is not None:
        stored = stored.where(F.col("event_date") <= F.lit(last).cast("date"))
    return stored
