"""Approximate nearest vectors: trained cells, every row indexed, several cells probed, exact ranking.

Centres come from k-means on a sample of at most `sample_rows` vectors; every vector of the
corpus is filed under its nearest centre in a table that is partitioned by cell. A query
meets the vectors of its nearest cells only, and is ranked by its exact similarity with them. How many
cells that takes for a wanted recall is measured on `calibration` vectors against the exact search.
A cell may hold a third of all rows: cells are cut into parts of about `part_rows`, and queries are
copied to the parts of the cells that they probe; the corpus is copied only for cells that are asked
by more than QUERY_ROWS queries at once.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import RETRIEVE_K, SEED
from .bounded import scratch_dir, stored
from .ranking import top_k
from .retrieval import _matrix, _Nearest, _unit_rows, usable_vectors, vector_top_k

SAMPLE_ROWS = 100_000
MAX_CELLS = 4096
PART_ROWS = 65_536
QUERY_ROWS = 65_536
CALIBRATION = 256
TARGET = 0.95


def _drawn(vectors: DataFrame, rows: int, seed: int) -> DataFrame:
    """At most `rows` vectors, drawn by hash of their id."""
    total = vectors.count()
    spot = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 40))
    return vectors.where(spot < int((1 << 40) * min(1.0, 1.2 * rows / max(total, 1)))).orderBy(spot, "vec_id").limit(rows)


def fit_centres(vectors: DataFrame, cells: int | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> np.ndarray:
    """Unit centres, one per row: about the square root of the sample's rows, at most MAX_CELLS."""
    whole = usable_vectors(vectors).where(F.exists("embedding", lambda x: x != 0))
    sample = stored(_drawn(whole, sample_rows, seed).select(array_to_vector("embedding").alias("features")), "vector-sample")
    rows = sample.count()
    if not rows:
        return np.zeros((0, 0))
    cells = min(rows, MAX_CELLS, cells or math.isqrt(rows))
    if cells == 1:
        return _unit_rows(np.array([sample.first()["features"].toArray()]))
    model = KMeans(k=cells, seed=seed, maxIter=10, distanceMeasure="cosine").fit(sample)
    return _unit_rows(np.array(model.clusterCenters()))


def with_cells(vectors: DataFrame, centres: np.ndarray, probes: int = 1) -> DataFrame:
    """The rows, once for each of their `probes` nearest cells, with `cell` and its place `probe` from 1."""
    probes = min(probes, len(centres))
    schema = pa.schema([("cell", pa.int32()), ("probe", pa.int32())])
    shared = vectors.sparkSession.sparkContext.broadcast(centres)  # at most MAX_CELLS rows

    def run(batches):
        for batch in batches:
            near = _unit_rows(_matrix(batch.column("embedding")).astype(float)) @ shared.value.T
            cells = np.argsort(-near, axis=1, kind="stable")[:, :probes]
            out = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), probes)))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(cells.ravel(), schema.types[0]),
                 pa.array(np.tile(np.arange(1, probes + 1), batch.num_rows), schema.types[1])],
                names=[*out.schema.names, *schema.names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, f"{fields}, cell int, probe int")


def build_index(vectors: DataFrame, centres: np.ndarray, part_rows: int = PART_ROWS) -> DataFrame:
    """Every usable vector filed under its cell: vec_id, embedding, part and the partition column cell."""
    filed = stored(with_cells(usable_vectors(vectors).select("vec_id", "embedding"), centres).drop("probe"), "filed")
    parts = filed.groupBy("cell").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
    placed = filed.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).drop("parts")
    spark = vectors.sparkSession
    path = f"{scratch_dir(spark)}/vector-index-{uuid.uuid4().hex}"
    placed.repartition("cell", "part").write.partitionBy("cell").parquet(path)
    names = ["vec_id", "embedding", "part", "cell"]
    schema = placed.select(*names).schema
    return spark.read.schema(schema).parquet(path)


def search(index: DataFrame, centres: np.ndarray, queries: DataFrame, k: int = RETRIEVE_K, probes: int = 8,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, vec_id, similarity, rank of the k best vectors in the `probes` nearest cells of each query.

    Queries that are null, ragged or hold nulls have no neighbours, like in the exact search.
    """
    asked = stored(with_cells(usable_vectors(queries).select("query_id", "embedding"), centres, probes), "probes")
    parts = index.groupBy("cell").agg((F.max("part") + 1).alias("parts"))
    many = asked.groupBy("cell").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("blocks"))

    def each(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = asked.join(parts, "cell").join(many, "cell").select(
        F.col("cell").alias("q_cell"), "query_id", F.col("embedding").alias("asked"), each("parts").alias("q_part"),
        F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int").alias("q_block"))
    right = index.join(many, "cell").select("cell", "part", "vec_id", "embedding", each("blocks").alias("block"))

    def cell(q: pa.Table, c: pa.Table) -> pa.Table:
        nearest = _Nearest(_matrix(q.column("asked").combine_chunks()), k)
        if q.num_rows and c.num_rows:
            nearest.add(c.column("vec_id").to_numpy(), _matrix(c.column("embedding").combine_chunks()))
            return pa.table(nearest.columns(q.column("query_id").to_numpy()))
        return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                         "similarity": pa.array([], pa.float64())})

    found = left.groupBy("q_cell", "q_part", "q_block").cogroup(right.groupBy("cell", "part", "block")).applyInArrow(
        cell, "query_id bigint, vec_id bigint, similarity double")
    return top_k(found, ["query_id"], [F.col("similarity").desc(), F.col("vec_id")], k)


def probes_for(index: DataFrame, centres: np.ndarray, k: int = RETRIEVE_K, target: float = TARGET,
               calibration: int = CALIBRATION, seed: int = SEED) -> int:
    """The fewest cells to probe so that `target` of the exact neighbours of sample vectors lie in them."""
    sample = stored(_drawn(index.select("vec_id", "embedding"), calibration, seed + 1).select(
        F.col("vec_id").alias("query_id"), "embedding"), "calibration")
    exact = vector_top_k(index.select("vec_id", "embedding"), sample, k).select("query_id", "vec_id")
    homes = exact.join(index.select("vec_id", "cell"), "vec_id")
    places = with_cells(sample, centres, len(centres)).select("query_id", "cell", "probe")
    needed = homes.join(places, ["query_id", "cell"]).groupBy("probe").count().orderBy("probe").collect()
    total, reached = sum(r["count"] for r in needed), 0
    for row in needed:
        reached += row["count"]
        if reached >= target * total:
            return row["probe"]
    return 1


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries, exact neighbours wanted, how many of them were found, and the share."""
    both = exact.select("query_id", "vec_id").join(
        found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return both.agg(
        F.count_distinct("query_id").alias("queries"), F.count("*").alias("wanted"),
        F.count("hit").alias("found"), (F.count("hit") / F.count("*")).alias("recall"))
