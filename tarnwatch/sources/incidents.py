"""Incident rows from an event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import map_value
from ..schemas import RAW_OPERATIONS


def business_hours(hour: Column, minutes: Column, factor: float = 1.2) -> Column:
    """Longer resolution from 9 to 18 o'clock, both ends included."""
    return F.when(hour.between(9, 18), minutes * factor).otherwise(minutes)


def with_breach_and_plants(df: DataFrame, planted: str, factor: float = 3.0) -> DataFrame:
    """SLA breach from the plain resolution time, then planted anomalies: longer and breached."""
    hit = F.col(planted) == 1
    breached = F.when(hit, True).otherwise(
        F.col("resolution_time_mins") > F.col("sla_threshold_mins"))
    minutes = F.col("resolution_time_mins")
    return df.withColumns({
        "sla_breached": breached,
        "resolution_time_mins": F.when(hit, minutes * factor).otherwise(minutes),
        "is_anomaly": F.col(planted).cast("int"),
    })


def incidents_from_events(events: DataFrame, planted: str | None = None) -> DataFrame:
    """Read each event as an incident of the service named by its type (schema RAW_OPERATIONS).

    Severity, limits and teams follow from the ids, so SQL can repeat the table row by row.
    So do planted anomalies, unless `planted` names a 0/1 column that marks them.
    """
    event, user = F.col("event_id"), F.col("user_id")
    tenth = event * 31 % 10
    base = events.select(
        F.concat(F.lit("INC_"), event.cast("string")).alias("incident_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("service_name"),
        F.when(tenth == 0, 1).when(tenth <= 2, 2).when(tenth <= 6, 3).otherwise(4)
        .alias("severity"),
        business_hours(F.hour("ts"), 20 + F.col("value")).alias("resolution_time_mins"),
        map_value(event % 3, {0: 30, 1: 60}, 120).alias("sla_threshold_mins"),
        map_value(user % 3, {0: "APAC", 1: "EMEA"}, "NA").alias("region"),
        map_value(user % 7 % 3, {0: "team_a", 1: "team_b"}, "team_c").alias("team"),
        map_value(event % 4, {0: "dependency_failure", 1: "timeout", 2: "code_bug"},
                  "infra_issue").alias("root_cause"),
        F.hour("ts").alias("hour"),
        (F.col(planted) if planted else F.when(event * 7919 % 100 < 5, 1).otherwise(0))
        .alias("_planted"),
        F.when(event * 13 % 5 == 0, 1).otherwise(0).alias("repeat_incident"),
    )
    return with_breach_and_plants(base, "_planted").select(*RAW_OPERATIONS.names)
