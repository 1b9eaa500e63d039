"""Lag and rolling statistics over ordered rows of a key, also for keys of any size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..constants import FRAME_ROWS, LAG_ROWS
from .bounded import stored
from .ranking import top_k

# Rows of one key that a single task may window on its own.
SHARD_ROWS = 1_000_000
# Each longer run is merged from this many shorter ones.
RADIX = 4


def _one_row(value: str) -> Column:
    """Moments of a single row: count, mean and sum of squared deviations."""
    missing = F.col(value).isNull()
    return F.struct(
        F.when(missing, 0).otherwise(1).alias("n"),
        F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("mean"),
        F.lit(0.0).alias("m2"),
    )


def _merge(df: DataFrame, keep: list[Column], wanted: dict[str, list[str]]) -> DataFrame:
    """`keep` and, for every name in `wanted`, the moments of neighbouring runs of rows as one run.

    All but the first run may be absent. Means are taken relative to the first run and deviations to the
    merged mean, so nothing large cancels and equal values give exactly 0. The merged mean is a column
    of a step of its own; deviations refer to it.
    """
    def parts(runs):
        return [(f"coalesce({r}.n, 0)", f"coalesce({r}.mean, 0D)", f"coalesce({r}.m2, 0D)") for r in runs]

    means, moments = [], []
    for name, runs in wanted.items():
        total = " + ".join(n for n, _, _ in parts(runs))
        shift = " + ".join(f"{n} * ({mean} - {runs[0]}.mean)" for n, mean, _ in parts(runs))
        means += [F.expr(total).alias(f"{name}_n"),
                  F.expr(f"{runs[0]}.mean + ({shift}) / greatest({total}, 1)").alias(f"{name}_mean")]
        m2 = " + ".join(f"{m2} + {n} * ({mean} - {name}_mean) * ({mean} - {name}_mean)" for n, mean, m2 in parts(runs))
        moments.append(F.expr(f"named_struct('n', {name}_n, 'mean', {name}_mean, 'm2', {m2})").alias(name))
    return df.select("*", *means).select(*keep, *moments)


def add_history(df: DataFrame, window: WindowSpec, value: str, lags: dict[str, int] = LAG_ROWS,
                frames: dict[str, int] = FRAME_ROWS) -> DataFrame:
    """Lags, and mean and sample deviation over the current row and n rows before it.

    A `rowsBetween` frame is summed anew for every row. Here the moments of runs of 1, 4,
    16, ... rows are built from each other by lags, and a frame is the merge of the few
    runs its length is made of: some thirty lags over one sort instead of hundreds of
    additions per row.
    """
    keep = [F.col(c) for c in [*df.columns, *lags]]
    df = df.select("*", *[F.lag(value, n).over(window).alias(c) for c, n in lags.items()])
    if not frames:
        return df
    widths = {name: n + 1 for name, n in frames.items()}
    pieces = {name: _run_offsets(width) for name, width in widths.items()}

    size, done = 1, [F.col("_run1")]
    df = df.withColumn("_run1", _one_row(value))
    while size * RADIX <= max(widths.values()):
        steps = [F.lag(f"_run{size}", i * size).over(window).alias(f"_back{i}")
                 for i in range(1, RADIX)]
        runs = [f"_run{size}"] + [f"_back{i}" for i in range(1, RADIX)]
        df = df.select(*keep, *done, *steps)
        size *= RADIX
        df = _merge(df, keep + done, {f"_run{size}": runs})
        done.append(F.col(f"_run{size}"))

    wanted = sorted({p for runs in pieces.values() for p in runs})
    df = df.select(*keep, *[
        (F.lag(f"_run{run}", offset).over(window) if offset else F.col(f"_run{run}"))
        .alias(f"_at{run}_{offset}") for run, offset in wanted
    ])
    df = _merge(df, keep, {f"_frame_{name}": [f"_at{run}_{offset}" for run, offset in runs]
                           for name, runs in pieces.items()})
    results = []
    for name in frames:
        frame = F.col(f"_frame_{name}")
        results += [
            F.when(frame["n"] > 0, frame["mean"]).alias(f"rolling_mean_{name}"),
            F.when(frame["n"] > 1, F.sqrt(frame["m2"] / (frame["n"] - 1)))
            .alias(f"rolling_std_{name}"),
        ]
    return df.select(*keep, *results)


def _run_offsets(width: int) -> list[tuple[int, int]]:
    """Runs of RADIX-power lengths that make up `width` rows, with how far back each ends."""
    size = 1
    while size * RADIX <= width:
        size *= RADIX
    runs, offset = [], 0
    while size:
        while offset + size <= width:
            runs.append((size, offset))
            offset += size
        size //= RADIX
    return runs


def _reach(lags: dict[str, int], frames: dict[str, int]) -> int:
    return max([*lags.values(), *frames.values()])


def with_history(df: DataFrame, key: str, order: list[str], value: str,
                 lags: dict[str, int] = LAG_ROWS, frames: dict[str, int] = FRAME_ROWS,
                 shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Add lags and rolling statistics by `key`; `order` is unique within a key.

    While every key fits one task this is a plain window. Otherwise the rows are cut
    into ordered shards, and each shard is windowed with the rows it needs from before.
    """
    largest = df.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    if largest <= shard_rows:
        return add_history(df, Window.partitionBy(key).orderBy(*order), value, lags, frames)
    return with_sharded_history(df, key, order, value, lags, frames, shard_rows)


def with_sharded_history(df: DataFrame, key: str, order: list[str], value: str,
                         lags: dict[str, int] = LAG_ROWS, frames: dict[str, int] = FRAME_ROWS,
                         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The same columns with every key split into ordered shards of about `shard_rows`.

    Shards are Spark's range partitions by key and order, so a hot key takes as many as
    its size asks for. They are written once: the partition number becomes data, and a
    lost executor cannot move a boundary.
    """
    reach = _reach(lags, frames)
    parts = max(1, math.ceil(df.count() / shard_rows))
    ranged = stored(
        df.repartitionByRange(parts, key, *order).withColumn("_shard", F.spark_partition_id()),
        "shards",
    )

    # Where each shard ends within its key; at most one row per shard and key.
    by_shard = Window.partitionBy(key).orderBy("_shard")
    sizes = ranged.groupBy(key, "_shard").agg(F.count("*").alias("_n"))
    ends = sizes.withColumn(
        "_end", F.sum("_n").over(by_shard.rowsBetween(Window.unboundedPreceding, 0)))
    # Earlier shards that end within reach of a shard's first row: normally only the last
    # one, more when shards are short.
    near = Window.partitionBy(key).orderBy("_end").rangeBetween(1 - reach, 0)
    feeds = (
        ends.select(
            key,
            F.lead("_shard").over(by_shard).alias("_target"),
            F.col("_end").alias("_before"),
            F.collect_list(F.struct("_shard", "_end")).over(near).alias("_sources"),
        )
        .where(F.col("_target").isNotNull())
        .select(key, "_target", "_before", F.inline("_sources"))
    )

    # The last `reach` rows of each shard, copied to the shards that look back at them. A
    # copy is only looked at, so the columns that no window reads stay out.
    looked_at = list(dict.fromkeys([key, *order, value]))
    tails = top_k(ranged.select(*looked_at, "_shard"), [key, "_shard"],
                  [F.col(c).desc() for c in order], reach, "_from_end")
    halo = (
        tails.join(feeds, [key, "_shard"])
        .where(F.col("_end") - F.col("_from_end") + 1 > F.col("_before") - reach)
        .select(*looked_at, F.col("_target").alias("_shard"), F.lit(True).alias("_copy"))
    )
    rows = ranged.withColumn("_copy", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    window = Window.partitionBy(key, "_shard").orderBy(*order)
    return (
        add_history(rows, window, value, lags, frames)
        .where(~F.col("_copy"))
        .drop("_shard", "_copy")
    )


def with_bucketed_history(df: DataFrame, key: str, order: list[str], value: str, bucket: Column,
                          lags: dict[str, int] = LAG_ROWS, frames: dict[str, int] = FRAME_ROWS,
                          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The same columns as one lazy plan: nothing runs, and nothing is written, while it is built.

    `bucket` never falls along `order` (a minute of the timestamp, say). Rows are counted per key and
    bucket; the counts before a bucket tell its shard of about `shard_rows` rows. Buckets that
    reach into the rows a later shard looks back at are copied to it. A key of any size is
    dealt by shards, a small one is a single shard, and rows are shuffled once.
    """
    reach = _reach(lags, frames)
    rows = df.withColumn("_bucket", bucket)
    before = Window.partitionBy("_key").orderBy("_own").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col(key).alias("_key"), F.col("_bucket").alias("_own")).agg(F.count("*").alias("_n"))
    start = F.coalesce(F.sum("_n").over(before), F.lit(0))
    first, last = F.floor(F.col("_start") / shard_rows), F.floor((F.col("_start") + F.col("_n") + (reach - 1)) / shard_rows)
    shards = counts.select("_key", "_own", "_n", start.alias("_start")).select(
        "_key", "_own", first.alias("_shard"), last.alias("_last"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_bucket").eqNullSafe(F.col("_own"))
    placed = rows.join(shards, same).select(
        *df.columns, F.col("_shard").alias("_home"), F.explode(F.sequence("_shard", "_last")).alias("_shard"))
    window = Window.partitionBy(key, "_shard").orderBy(*order)
    return add_history(placed, window, value, lags, frames).where("_home = _shard").select(
        *df.columns, *lags, *[f"rolling_{s}_{n}" for n in frames for s in ("mean", "std")])


def hourly_trailing_means(df: DataFrame, key: str, ts: str, value: str,
                          days: dict[str, int]) -> DataFrame:
    """Per key and hour: mean of `value` over the trailing days, by time instead of by rows.

    Rows are reduced to hourly sums before the window, so a frame holds at most 24 rows
    per day however many incidents there are.
    """
    hour = F.unix_date(F.to_date(ts)).cast("bigint") * 24 + F.hour(ts)
    hourly = df.groupBy(key, hour.alias("epoch_hour")).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    by_hour = Window.partitionBy(key).orderBy("epoch_hour")
    columns = []
    for name, n in days.items():
        frame = by_hour.rangeBetween(1 - 24 * n, 0)
        columns.append((F.sum("_sum").over(frame) / F.sum("_n").over(frame))
                       .alias(f"trailing_mean_{name}"))
    return hourly.select(key, "epoch_hour", *columns)
