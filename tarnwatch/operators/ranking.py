"""Top-k per key, exact order statistics and exact-size random picks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bounded import stored

BINS = 4096
FINISH_ROWS = 10_000


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int,
          rank: str = "rank") -> DataFrame:
    """First `k` rows per key. Spark limits each key inside every task before the shuffle."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= k)


def order_statistics(df: DataFrame, column: str, ranks: list[int]) -> dict[int, float]:
    """Exact values at 0-based ascending ranks of a double column without nulls.

    Each round counts the values of one interval in a fixed number of bins (a
    partial aggregate whose result has at most `BINS` rows) and keeps the bin that
    holds the rank, until the bin is one value or few enough rows to read.
    """
    found: dict[int, float] = {}
    endless = float("inf")
    finite = F.when(F.abs(column) < endless, F.col(column))
    low, high, n, below, _ = df.agg(
        F.min(finite), F.max(finite), F.count(finite),
        F.count(F.when(F.col(column) == -endless, 1)), F.count("*")).first()
    # Infinite values are counted aside; bins cover the finite ones.
    found.update((r, -endless) for r in ranks if r < below)
    found.update((r, endless) for r in ranks if r >= below + n)
    inner = sorted({r for r in ranks if below <= r < below + n})
    pending = [(low, high, below, inner)] if inner else []
    while pending:
        low, high, below, wanted = pending.pop()
        if low == high:
            found.update((r, low) for r in wanted)
            continue
        inside = df.where(F.col(column).between(low, high))
        # Wide intervals are cut on a logarithmic scale: a round leaves a small factor of them.
        wide = high - low > 1e6
        scale, ends = (F.asinh(F.col(column)), (math.asinh(low), math.asinh(high))) if wide else (F.col(column), (low, high))
        spot = F.floor((scale - F.lit(ends[0])) / F.lit(ends[1] - ends[0]) * BINS)
        bins = (
            inside.groupBy(F.least(spot, F.lit(BINS - 1)).alias("bin"))
            .agg(F.min(column).alias("low"), F.max(column).alias("high"),
                 F.count("*").alias("n"))
            .orderBy("bin").collect()
        )
        for b in bins:
            here = [r for r in wanted if below <= r < below + b.n]
            if here and (b.low == b.high or here == [below]):
                found.update((r, b.low) for r in here)
            elif here and here == [below + b.n - 1]:
                found[here[0]] = b.high
            elif here and b.n <= FINISH_ROWS:
                values = sorted(
                    v for (v,) in df.where(F.col(column).between(b.low, b.high))
                    .select(column).collect()
                )
                found.update((r, values[r - below]) for r in here)
            elif here:
                pending.append((b.low, b.high, below, here))
            below += b.n
    return found


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    """Exact linearly interpolated quantile; nulls and NaN are left out.

    The column is scanned a few times: pass a stored table.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v"))
    n = values.count()
    if n == 0:
        return None
    place = (n - 1) * q
    low, high = math.floor(place), math.ceil(place)
    at = order_statistics(values, "v", [low, high])
    return at[low] + (at[high] - at[low]) * (place - low)


def pick_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42,
                  flag: str = "picked") -> DataFrame:
    """Flag exactly `int(fraction * n)` pseudo-random rows; the same keys give the same pick."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    # 48 bits of the digest: exact as a double.
    draw = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double")
    keyed = df.withColumn("_draw", draw)
    draws = stored(keyed.select("_draw", F.col(key).alias("_key")), "pick")
    take = int(fraction * draws.count())
    if take == 0:
        return df.withColumn(flag, F.lit(0))
    cutoff = order_statistics(draws, "_draw", [take - 1])[take - 1]
    # Rows that tie at the cutoff enter in key order.
    sure = draws.where(F.col("_draw") < cutoff).count()
    tied = draws.where(F.col("_draw") == cutoff)
    last = tied.orderBy("_key").limit(take - sure).agg(F.max("_key")).first()[0]
    chosen = (F.col("_draw") < cutoff) | ((F.col("_draw") == cutoff) & (F.col(key) <= F.lit(last)))
    return keyed.withColumn(flag, chosen.cast("int")).drop("_draw")
