"""Business queries and dashboard data sets over scored incidents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TOP_INCIDENTS
from ..functions.columns import flag_sum, guarded_ratio, start_of


def dashboard_filter(df: DataFrame, start: str | None = None, end: str | None = None,
                     services: list[str] | None = None) -> DataFrame:
    """Rows from `start` up to but without `end`, of the given services."""
    if start is not None:
        df = df.where(F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col("timestamp") < F.lit(end).cast("timestamp_ntz"))
    if services is not None:
        df = df.where(F.col("service_name").isin(services))
    return df


def anomalies_by_service(df: DataFrame) -> DataFrame:
    return (
        df.where("is_anomaly").groupBy("service_name")
        .agg(F.count("*").alias("anomaly_count"))
        .orderBy(F.col("anomaly_count").desc(), "service_name")
    )


def anomaly_trend(df: DataFrame, unit: str = "day") -> DataFrame:
    return (
        df.where("is_anomaly").groupBy(start_of(unit).alias("date"))
        .agg(F.count("*").alias("anomaly_count")).orderBy("date")
    )


def resolution_by_team(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("team").agg(F.avg("resolution_time_mins").alias("avg_resolution_time"))
        .orderBy(F.col("avg_resolution_time").desc(), "team")
    )


def top_incidents(df: DataFrame, score: str = "risk_score", n: int = TOP_INCIDENTS) -> DataFrame:
    """Flagged incidents with the highest score; ties by incident id."""
    return (
        df.where("is_anomaly")
        .select("incident_id", "service_name", "timestamp", "severity", "resolution_time_mins",
                F.col(score), "team", "root_cause", "sla_breached")
        .orderBy(F.col(score).desc(), "incident_id").limit(n)
    )


def sla_breach_rate(df: DataFrame) -> DataFrame:
    breached, total = flag_sum(F.col("sla_breached")), F.count("*")
    return df.agg(
        total.alias("total_incidents"),
        F.coalesce(breached, F.lit(0)).cast("bigint").alias("breached_incidents"),
        F.round(guarded_ratio(breached * 100, total), 2).alias("breach_rate_percent"),
    )


def incident_volume(df: DataFrame, unit: str = "day") -> DataFrame:
    return (
        df.groupBy(start_of(unit).alias("date")).agg(F.count("*").alias("incidents"))
        .orderBy("date")
    )


def breach_rate_by_service(df: DataFrame) -> DataFrame:
    return df.groupBy("service_name").agg(
        F.count("*").alias("incidents"),
        flag_sum(F.col("sla_breached")).cast("bigint").alias("breached"),
        guarded_ratio(flag_sum(F.col("sla_breached")), F.count("*")).alias("breach_rate"),
    ).orderBy(F.col("breach_rate").desc(), "service_name")


def severity_breakdown(df: DataFrame) -> DataFrame:
    """Incidents per severity and their share of all rows."""
    counted = df.groupBy("severity").agg(F.count("*").alias("incidents"))
    total = df.select(F.count("*")).scalar()
    return counted.withColumn("share", guarded_ratio(F.col("incidents"), total)).orderBy("severity")


def score_histogram(df: DataFrame, score: str, width: float) -> DataFrame:
    """Rows per score bin of fixed width; `bin_start` is the lower edge."""
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(F.floor(F.col(score) / F.lit(width)).alias("bin"))
        .agg(F.count("*").alias("incidents"))
        .withColumn("bin_start", F.col("bin") * F.lit(width)).orderBy("bin")
    )


def anomaly_rate_by_service(df: DataFrame) -> DataFrame:
    return df.groupBy("service_name").agg(
        F.avg(F.coalesce(F.col("is_anomaly"), F.lit(False)).cast("double")).alias("anomaly_rate"))
