"""Isolation forest (Liu, Ting and Zhou, 2008): trees are built and applied inside Spark tasks.

A model is a table of tree nodes with at most `trees * (2 * sample_size - 1)` rows, so it
is small however large the data.

All random numbers are digits of md5 digests of the seed, the row's key and the tree's and node's numbers,
inputs are rounded to STEP, and path lengths are whole millionths: any engine that can
count draws the same samples, grows the same trees and gives the same verdicts (`forest_sql.py`).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..constants import SEED
from ..schemas import FOREST_NODES
from .bounded import bounded_rows
from .detectors import feature_vector
from .ranking import exact_quantile, top_k

TREES = 100
SAMPLE = 256
# A larger node table is not a model; it is refused before it reaches the driver.
MAX_NODES = 1_000_000
# Rows drawn from the table per row needed; the exact sample is cut from these.
MARGIN = 2
# Inputs are whole multiples of 1 / STEP. The offset keeps means of few values off the halves.
STEP, HALF = 10_000, 0.5001
PATH_UNIT = 1_000_000
PRIME = 2 ** 31 - 1
DIGITS = 7


def digest_numbers(text: str) -> list[int]:
    """Four 28-bit numbers from the md5 digest of a text."""
    digest = hashlib.md5(text.encode()).hexdigest()
    return [int(digest[k * DIGITS:(k + 1) * DIGITS], 16) for k in range(4)]


def _key_numbers(key: Column, seed: int) -> Column:
    """Two of these numbers for a row's key, as a struct (h1, h2)."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.struct(*[F.conv(F.substring(digest, k * DIGITS + 1, DIGITS), 16, 10).cast("long").alias(f"h{k + 1}")
                      for k in (0, 1)])


def rounded(value: Column) -> Column:
    return F.floor(value * F.lit(float(STEP)) + F.lit(HALF)).cast("double") / F.lit(float(STEP))


def model_inputs(features: list[str]) -> list[Column]:
    """The features as the forest sees them."""
    return [rounded(v).alias(name) for v, name in zip(feature_vector(features), features)]


def expected_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype=float)
    grown = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, grown, np.where(n == 2, 1.0, 0.0))


def path_length(depth: int, rows: int) -> float:
    """Depth of a leaf plus the mean depth its rows would still have, in whole millionths."""
    return math.floor((depth + float(expected_path(rows))) * PATH_UNIT + 0.5) / PATH_UNIT


def _grow(tree_id: int, x: np.ndarray, seed: int) -> list[tuple]:
    """Nodes of one random tree over the sample `x`. Node n has the children 2n + 1 and 2n + 2."""
    limit = math.ceil(math.log2(max(len(x), 2)))
    nodes, work = [], [(np.arange(len(x)), 0, 0)]
    while work:
        rows, depth, here = work.pop()
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= limit or len(splittable) == 0:
            nodes.append((tree_id, here, -1, 0.0, here, here, path_length(depth, len(rows)), len(x)))
            continue
        pick, spot, *_ = digest_numbers(f"{seed}|grow|{tree_id}|{here}")
        feature = int(splittable[pick % len(splittable)])
        cut = float(low[feature] + (high[feature] - low[feature]) * (spot / 2.0 ** 28))
        goes_left = part[:, feature] <= cut
        left, right = 2 * here + 1, 2 * here + 2
        nodes.append((tree_id, here, feature, cut, left, right, 0.0, len(x)))
        work.append((rows[~goes_left], depth + 1, right))
        work.append((rows[goes_left], depth + 1, left))
    return nodes


def fit_forest(df: DataFrame, features: list[str], key: str = "incident_id", trees: int = TREES,
               sample_size: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """Node table of a forest; each tree sees `sample_size` rows drawn without replacement.

    A row's key is digested once; a tree orders the rows by a linear function of that digest modulo a
    prime, so the forest does not depend on how the data is partitioned. Every tree draws from
    the whole table, at any size: the scan keeps a row for the trees that drew it, about
    `sample_size` times MARGIN rows a tree.
    """
    n = df.count()
    if n == 0:
        raise ValueError("no rows to fit on")
    # The one-row generator keeps the digest from being repeated for every tree.
    vectors = df.select(F.col(key).alias("_key"), F.array(*model_inputs(features)).alias("x"),
                        F.inline(F.array(_key_numbers(F.col(key), seed))))
    limit = int(PRIME * min(1.0, sample_size * MARGIN / n)) + 1
    lines = F.array(*[F.struct(F.lit(t).alias("tree_id"), *[
        F.lit(number + 1).cast("long").alias(name) for name, number in zip(
            ("a1", "b1", "a2", "b2"), digest_numbers(f"{seed}|draw|{t}"))]) for t in range(trees)])

    def place(tree: Column, k: int) -> Column:
        return (F.col(f"h{k}") * tree[f"a{k}"] + tree[f"b{k}"]) % F.lit(PRIME)

    draws = vectors.select("_key", "x", "h1", "h2", F.explode(F.filter(lines, lambda t: place(t, 1) <= limit)).alias("_t"))
    order = [place(F.col("_t"), 1), place(F.col("_t"), 2), F.col("_key")]
    sample = top_k(draws.withColumn("tree_id", F.col("_t.tree_id")), ["tree_id"], order, sample_size, "_place")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(group["x"].to_numpy()).astype(float)
        return pd.DataFrame(_grow(int(group["tree_id"].iloc[0]), x, seed), columns=FOREST_NODES.names)

    return sample.select("tree_id", "x").groupBy("tree_id").applyInPandas(build, FOREST_NODES)


def _pack(nodes: list) -> dict[str, np.ndarray | float]:
    """Node rows as flat arrays with links to places in them."""
    nodes = sorted(nodes, key=lambda r: (r.tree_id, r.node_id))
    place = {(r.tree_id, r.node_id): i for i, r in enumerate(nodes)}
    return {
        "roots": np.array([i for i, r in enumerate(nodes) if r.node_id == 0], dtype=np.int64),
        "feature": np.array([r.feature for r in nodes], dtype=np.int64),
        "threshold": np.array([r.threshold for r in nodes]),
        "left": np.array([place[r.tree_id, r.left] for r in nodes], dtype=np.int64),
        "right": np.array([place[r.tree_id, r.right] for r in nodes], dtype=np.int64),
        "path": np.array([round(r.path_length * PATH_UNIT) for r in nodes], dtype=np.int64),
    }


def _path_sum(x: np.ndarray, m: dict) -> np.ndarray:
    total = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    for root in m["roots"]:
        at = np.full(len(x), root)
        while True:
            feature = m["feature"][at]
            inner = feature >= 0
            if not inner.any():
                break
            left = x[rows, np.maximum(feature, 0)] <= m["threshold"][at]
            at = np.where(inner, np.where(left, m["left"][at], m["right"][at]), at)
        total += m["path"][at]
    return total


def forest_score(nodes: DataFrame, features: list[str]) -> Column:
    """Column with -2^(-E[path]/c): near -1 is abnormal. Only the features go to Python."""
    rows = bounded_rows(nodes, MAX_NODES)
    if rows is None:
        raise ValueError(f"a forest has at most {MAX_NODES} nodes")
    model = _pack(rows)
    scale = (float(expected_path(max(r.sample_size for r in rows))) or 1.0) * PATH_UNIT * len(model["roots"])
    packed = nodes.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(LongType())
    def paths(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(_path_sum(x, packed.value))

    return -F.pow(F.lit(2.0), -paths(*model_inputs(features)) / F.lit(scale))


def contamination_offset(scores: DataFrame, column: str, contamination: float) -> float:
    """Score below which the given share of the rows lies."""
    if not 0 < contamination <= 0.5:
        raise ValueError("contamination lies in (0, 0.5]")
    return exact_quantile(scores, column, contamination)


def with_forest_verdict(df: DataFrame, raw: str, offset: float) -> DataFrame:
    """Decision score (negative is abnormal), risk (its opposite) and the recoded 0/1 verdict."""
    decision = F.col(raw) - F.lit(offset)
    prediction = F.when(decision < 0, -1).otherwise(1)
    return df.withColumns({
        "anomaly_score": decision,
        "risk_score": -decision,
        "if_anomaly": F.when(prediction == -1, 1).otherwise(0),
    })
