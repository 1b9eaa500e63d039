"""Exact top-k by inner product with Fagin's threshold algorithm.

Components are integers, floor(scale * x). The vectors are dealt into shards by hash and the queries
into blocks; a task holds one shard and one block. For its shard it keeps a sorted list per
dimension. A query reads every list from its better end (the high one where its own component is
positive, the low one where it is negative, dimensions at 0 not at all), in rounds of growing depth; each
vector met for the first time is scored in full. The scalar product of the query with the values
at the present depth bounds all vectors not met yet: when it lies strictly below the k-th
score, the rest of the shard cannot come in, ties by id included. The k best of a query in every
shard are then ranked once more; that moves k rows per query and shard.

Work grows with queries times vectors, as the task asks; a cell of QUERY_BLOCK x SHARD pairs is read once
into one task, so the rows moved are that product divided by the block sizes, and no task grows with the input.

Defined cases: vectors that are null or hold a null, NaN or infinite component take no part; vectors of
another length than the query's are no candidates for it; a vector without components scores 0 with its like.
Rows that share an id are rows of their own: a query meets its namesakes, not itself. Rows without id
are candidates, last among equal scores, and never queries. Components beyond 2**60 take the nearest
value inside; scores are exact and ranked as such up to 38 digits, and returned as the nearest 64-bit
value.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.bounded import stored

SCALE, K = 256, 5
EVERY = 50
SHARD, QUERY_BLOCK = 8192, 1024
FIRST_DEPTH, GROWTH = 16, 4
LARGEST, DIGITS = 2 ** 60, 10 ** 38 - 1
LOW, HIGH = -2 ** 63, 2 ** 63 - 1
RANKED = "query long, query_id long, vec_id long, score decimal(38,0)"


def whole_vector(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components."""
    x = F.transform(vector, lambda v: v.cast("double"))
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return vector.isNotNull() & ~odd


def levels(vector: Column, scale: int) -> Column:
    def level(v):
        return F.floor(v.cast("double") * F.lit(float(scale))).cast("long")
    return F.transform(vector, lambda v: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), level(v))))


# --- Inside a task ------------------------------------------------------------------------

def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().reshape(len(column), dim)


def exact_type(a: np.ndarray, b: np.ndarray):
    """A number type in which the inner products of rows of a and b are exact."""
    if not a.size or not b.size:
        return np.float64
    most = a.shape[1] * max(-int(a.min()), int(a.max())) * max(-int(b.min()), int(b.max()))
    return np.float64 if most < 2 ** 53 else np.int64 if most < 2 ** 63 else object


class Shard:
    """Vectors with a sorted list per dimension."""

    def __init__(self, vectors: np.ndarray, ids: pa.ChunkedArray, rows: np.ndarray):
        # In the order of ids, those without one last: the first of equal scores is the one to keep.
        unknown = ids.is_null().to_numpy()
        order = np.lexsort((pc.fill_null(ids, 0).to_numpy(), unknown))
        self.vectors, self.rows = vectors[order], rows[order]
        self.ids = ids.combine_chunks().take(pa.array(order))
        #: A row per dimension, ascending.
        self.lists = np.argsort(self.vectors, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(self.vectors.T, self.lists, axis=1)
        self.met = 0

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best vectors other than the row `own`."""
        n = len(self.rows)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        place, score = np.empty(0, np.int64), np.empty(0, query.dtype)
        met = self.rows == own
        depth, to = 0, FIRST_DEPTH
        while depth < n:
            to = min(to, n)
            if len(up) or len(down):
                seen = np.zeros(n, bool)
                seen[self.lists[up, n - to:n - depth]] = True
                seen[self.lists[down, depth:to]] = True
                fresh = np.flatnonzero(seen & ~met)
            else:  # all scores are 0 and the ids decide
                fresh, to = np.flatnonzero(~met)[:k], n
            met[fresh] = True
            place = np.concatenate([place, fresh])
            score = np.concatenate([score, self.vectors[fresh] @ query])
            best = np.lexsort((place, -score))[:k]
            place, score = place[best], score[best]
            bound = (query[up] * self.values[up, n - to]).sum() + (query[down] * self.values[down, to - 1]).sum()
            if len(score) == k and bound < score[-1]:
                break
            depth, to = to, to * GROWTH
        self.met = int(met.sum())
        return place, score


def search_cell(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best vectors of one shard for each query of one block."""
    columns = {name: [] for name in ("query", "query_id", "vec_id", "score")}
    if vectors.num_rows and queries.num_rows:
        dim = vectors.column("dim")[0].as_py()
        data, asked = _matrix(vectors.column("levels"), dim), _matrix(queries.column("q_levels"), dim)
        kind = exact_type(data, asked)
        shard = Shard(data.astype(kind), vectors.column("vec_id"), vectors.column("row").to_numpy())
        for query, row, query_id in zip(asked.astype(kind), queries.column("q_row").to_pylist(),
                                        queries.column("q_id").to_pylist()):
            place, score = shard.top(query, row, k)
            columns["query"].extend([row] * len(place))
            columns["query_id"].extend([query_id] * len(place))
            columns["vec_id"].extend(shard.ids.take(pa.array(place)).to_pylist())
            columns["score"].extend(Decimal(min(max(int(s), -DIGITS), DIGITS)) for s in score.tolist())
    types = {"score": pa.decimal128(38, 0)}
    return pa.table({name: pa.array(c, types.get(name, pa.int64())) for name, c in columns.items()})


# --- The operator -------------------------------------------------------------------------

def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, vector: str = "embedding",
          key: str = "vec_id", shard: int = SHARD, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of every query row against all other rows."""
    rows = stored(vectors.where(whole_vector(F.col(vector))).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), F.size(vector).alias("dim"),
        levels(F.col(vector), scale).alias("levels")), "vectors")
    sizes = rows.groupBy("dim").agg(
        F.ceil(F.count("*") / shard).cast("int").alias("shards"),
        F.greatest(F.lit(1), F.ceil(F.count_if("asks") / query_block)).cast("int").alias("blocks"))
    placed = rows.join(sizes, "dim").select(
        "dim", "row", "vec_id", "asks", "levels", "shards", "blocks",
        F.pmod(F.xxhash64("row"), F.col("shards")).cast("int").alias("shard"),
        F.pmod(F.xxhash64(F.lit("block"), "row"), F.col("blocks")).cast("int").alias("block"))

    def up_to(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    data = placed.select("dim", "row", "vec_id", "levels", "shard", up_to("blocks").alias("block"))
    asked = placed.where("asks").select(
        F.col("dim").alias("q_dim"), up_to("shards").alias("q_shard"), F.col("block").alias("q_block"),
        F.col("row").alias("q_row"), F.col("vec_id").alias("q_id"), F.col("levels").alias("q_levels"))
    found = data.groupBy("dim", "shard", "block").cogroup(asked.groupBy("q_dim", "q_shard", "q_block")).applyInArrow(
        lambda left, right: search_cell(left, right, k), RANKED)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    score = F.greatest(F.lit(LOW), F.least(F.lit(HIGH), F.col("score"))).cast("long")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", score.alias("score"))
