"""Z-score per service, feature vectors, quality metrics, comparison, traffic arms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import TRAFFIC_PERCENT, Z_THRESHOLD
from ..functions.columns import flag_sum, guarded_ratio
from .bounded import join_group_rows


def with_zscore(df: DataFrame, key: str = "service_name", value: str = "resolution_time_mins",
                threshold: float = Z_THRESHOLD) -> DataFrame:
    """Group z-score (population deviation) and its 0/1 flag.

    The statistics are a partial aggregate joined back, by broadcast unless there are very many groups, so a
    hot group is not gathered in one task. A constant group has no z-score and flag 0.
    """
    stats = df.groupBy(key).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std"))
    z = F.try_divide(F.col(value) - F.col("_mean"), F.col("_std"))
    return (
        join_group_rows(df, stats, key)
        .select(*df.columns, z.alias("z_score"))
        .withColumn("z_anomaly",
                    F.coalesce((F.abs("z_score") > threshold).cast("int"), F.lit(0)))
    )


def feature_vector(features: list[str]) -> list[Column]:
    """Chosen columns as doubles with nulls as 0."""
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]


def detector_metrics(df: DataFrame, predicted: str, truth: str = "sla_breached",
                     by: list[str] | None = None, also: list[Column] | None = None) -> DataFrame:
    """Counts, precision, recall and F1 of a flag against a truth column, one scan.

    `also` adds further named aggregates to the same scan.
    """
    hit = F.col(predicted).cast("boolean")
    real = F.col(truth).cast("boolean")
    counts = df.groupBy(*(by or [])).agg(
        F.count("*").alias("rows"),
        flag_sum(hit & real).alias("tp"),
        flag_sum(hit & ~real).alias("fp"),
        flag_sum(~hit & real).alias("fn"),
        *(also or []),
    )
    extra = counts.columns[len(by or []) + 4:]
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        *(by or []), "rows",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(n)
          for n, c in (("tp", tp), ("fp", fp), ("fn", fn))],
        guarded_ratio(tp, tp + fp).alias("precision"),
        guarded_ratio(tp, tp + fn).alias("recall"),
        guarded_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        *extra,
    )


def compare_detectors(df: DataFrame, flags: dict[str, str],
                      truth: str = "sla_breached") -> DataFrame:
    """Metrics of several detectors from one scan, best first by recall, then F1, then name."""
    pairs = F.array(*[
        F.struct(F.lit(model).alias("model"), F.col(flag).cast("int").alias("_flag"))
        for model, flag in flags.items()
    ])
    long = df.select(F.col(truth).alias("_truth"), F.inline(pairs))
    metrics = detector_metrics(long, "_flag", "_truth", by=["model"])
    # One row per detector: ranked inside the group-by result, no window over data.
    best = (
        metrics.groupBy().agg(F.array_sort(F.collect_list(F.struct(
            (-F.col("recall")).alias("r"), (-F.col("f1")).alias("f"), "model"))).alias("o"))
        .select(F.posexplode("o").alias("pos", "o"))
        .select(F.col("o.model").alias("model"), (F.col("pos") + 1).alias("place"))
    )
    role = F.when(F.col("place") == 1, "champion").otherwise("challenger")
    return metrics.join(best, "model").withColumn("role", role)


def with_arm(df: DataFrame, key: str = "incident_id",
             percent: dict[str, int] = TRAFFIC_PERCENT) -> DataFrame:
    """Fixed traffic split: the same key always falls to the same arm."""
    if sum(percent.values()) != 100:
        raise ValueError("shares must add up to 100")
    spot = F.pmod(F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("bigint"), F.lit(100))
    arm, edge = F, 0
    for name, share in percent.items():
        edge += share
        arm = arm.when(spot < edge, name)
    return df.withColumn("arm", arm)


def metric_log(metrics: DataFrame, run_id: str, parent_run_id: str | None, model: str,
               params: dict[str, str], logged_at: Column) -> DataFrame:
    """Parameters and metrics of a run as rows of RUN_METRICS."""
    entries = [F.struct(F.lit("param").alias("kind"), F.lit(k).alias("key"),
                        F.lit(str(v)).alias("value")) for k, v in params.items()]
    entries += [F.struct(F.lit("metric").alias("kind"), F.lit(c).alias("key"),
                         F.col(c).cast("string").alias("value"))
                for c in ("precision", "recall", "f1")]
    return metrics.select(F.inline(F.array(*entries))).select(
        F.lit(run_id).alias("run_id"),
        F.lit(parent_run_id).cast("string").alias("parent_run_id"),
        F.lit(model).alias("model"), "kind", "key", "value",
        logged_at.cast("timestamp").alias("logged_at"),
    )
