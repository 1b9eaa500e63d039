"""Alert fatigue, drift and service quality measures."""

from __future__ import annotations

import datetime as dt
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..constants import ALERT_WINDOW_DAYS
from ..functions.columns import flag_sum, guarded_ratio
from .bounded import join_group_rows


def alert_fatigue(df: DataFrame, as_of: str | dt.date, days: int = ALERT_WINDOW_DAYS,
                  flag: str = "if_anomaly") -> DataFrame:
    """Share of a service's recent rows that raised an alert without a breach."""
    start = F.date_sub(F.lit(str(as_of)).cast("date"), days).cast("timestamp_ntz")
    recent = df.where(F.col("timestamp") >= start)
    false_alert = (F.col(flag) == 1) & ~F.col("sla_breached")
    return recent.groupBy("service_name").agg(
        guarded_ratio(flag_sum(false_alert), F.count("*")).alias("alert_fatigue_rate"))


def alert_triggers(rates: DataFrame, threshold: float) -> DataFrame:
    return rates.where(F.col("alert_fatigue_rate") > threshold)


def split_windows(df: DataFrame, as_of: str | dt.date, days: int = ALERT_WINDOW_DAYS) -> DataFrame:
    """Mark rows as `baseline` or as the recent window, `current`."""
    start = F.date_sub(F.lit(str(as_of)).cast("date"), days).cast("timestamp_ntz")
    return df.withColumn(
        "window", F.when(F.col("timestamp") >= start, "current").otherwise("baseline"))


def numeric_drift(windowed: DataFrame, columns: list[str], limit: float = 3.0) -> DataFrame:
    """Two-sample z statistic and variance ratio per numeric column, from one scan."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns
    ])
    recent, base = F.col("window") == "current", F.col("window") == "baseline"

    def both(name: str, fn) -> list[Column]:
        return [fn(F.when(base, F.col("v"))).alias(f"baseline_{name}"),
                fn(F.when(recent, F.col("v"))).alias(f"current_{name}")]

    stats = (
        windowed.select("window", F.inline(pairs)).groupBy("feature")
        .agg(*both("n", F.count), *both("mean", F.avg), *both("var", F.var_samp))
    )
    error = F.sqrt(F.col("baseline_var") / F.col("baseline_n")
                   + F.col("current_var") / F.col("current_n"))
    return stats.withColumns({
        "z": F.try_divide(F.col("current_mean") - F.col("baseline_mean"), error),
        "variance_ratio": F.try_divide(F.col("current_var"), F.col("baseline_var")),
    }).withColumn("drifted", F.coalesce(F.abs("z") > limit, F.lit(False)))


def categorical_drift(windowed: DataFrame, columns: list[str]) -> DataFrame:
    """Chi-square statistic and degrees of freedom of category x window, per column."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"))
        for c in columns
    ])
    counts = (
        windowed.select("window", F.inline(pairs)).groupBy("feature", "category")
        .agg(F.count_if(F.col("window") == "baseline").alias("b"),
             F.count_if(F.col("window") == "current").alias("c"))
    )
    totals = counts.groupBy("feature").agg(
        F.sum("b").alias("tb"), F.sum("c").alias("tc"), F.count("*").alias("k"))
    row, whole = F.col("b") + F.col("c"), F.col("tb") + F.col("tc")

    def cell(seen: str, total: str) -> Column:
        expected = row * F.col(total) / whole
        return F.coalesce(F.try_divide((F.col(seen) - expected) ** 2, expected), F.lit(0.0))

    # At most one totals row per monitored column, so this broadcast is bounded by the call.
    return (
        counts.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(F.sum(cell("b", "tb") + cell("c", "tc")).alias("chi2"),
             F.max(F.col("k") - 1).alias("dof"))
    )


@F.pandas_udf(DoubleType())
def chi2_tail(chi2: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution with whole degrees of freedom."""

    def tail(x: float, k: int) -> float:
        if k <= 0 or x <= 0:
            return 1.0
        half = x / 2
        p = math.exp(-half) if k % 2 == 0 else math.erfc(math.sqrt(half))
        for j in range(2 if k % 2 == 0 else 1, k, 2):
            p += math.exp(j / 2 * math.log(half) - half - math.lgamma(j / 2 + 1))
        return min(p, 1.0)

    return pd.Series([tail(x, int(k)) for x, k in zip(chi2, dof)])


def normal_tail(z: str) -> Column:
    """Two-sided tail of a normal statistic: its square is chi-square with one degree."""
    return chi2_tail(F.col(z) * F.col(z), F.lit(1))


def quality_profile(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """Rows per value of each dimension, from one scan."""
    pairs = F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
        for d in dimensions
    ])
    return df.select(F.inline(pairs)).groupBy("dimension", "value").agg(
        F.count("*").alias("rows"))


def incident_checks(df: DataFrame) -> DataFrame:
    """Totals, planted rows, and unplanted rows whose breach flag breaks the rule."""
    rule = F.col("resolution_time_mins") > F.col("sla_threshold_mins")
    wrong = (F.col("is_anomaly") == 0) & (F.col("sla_breached") != rule)
    return df.agg(
        F.count("*").alias("total_incidents"),
        F.sum(F.col("is_anomaly").cast("bigint")).alias("planted"),
        flag_sum(F.col("sla_breached")).cast("bigint").alias("breached"),
        flag_sum(wrong).cast("bigint").alias("rule_mismatches"),
    )


def service_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("service_name").agg(
        F.sum("resolution_time_mins").alias("total_resolution_time"))


def with_service_total(df: DataFrame) -> DataFrame:
    """Each row with the summed resolution time of its service; the key comes first."""
    joined = join_group_rows(df, service_totals(df), "service_name")
    rest = [c for c in df.columns if c != "service_name"]
    return joined.select("service_name", *rest, "total_resolution_time")
