"""The cell index against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwatch.operators import retrieval, vector_index


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[rng.integers(12) if i % 3 else 0] + rng.normal(0, .25, 16)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[5][1]) for i in range(60)]
    rows += [(3000, None), (3001, [1.0, None] + [0.0] * 14), (3002, [1.0]), (3003, [0.0] * 16)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4).cache()


def queries_of(df):
    return df.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def test_index_holds_every_usable_row_once(clustered):
    centres = vector_index.fit_centres(clustered, cells=20)
    index = vector_index.build_index(clustered, centres, part_rows=100)
    ids = [r.vec_id for r in index.select("vec_id").collect()]
    assert sorted(ids) == sorted(r.vec_id for r in retrieval.usable_vectors(clustered).collect())
    sizes = index.groupBy("cell", "part").count().collect()
    assert max(r["count"] for r in sizes) < 250 and len({r.cell for r in sizes}) <= 20
    assert np.allclose(np.linalg.norm(centres, axis=1), 1)


def test_all_cells_probed_is_the_exact_search(clustered):
    centres = vector_index.fit_centres(clustered, cells=9)
    index = vector_index.build_index(clustered, centres, part_rows=64)
    asked = queries_of(clustered)
    exact = vector_index.vector_top_k(clustered, asked, 5)
    found = vector_index.search(index, centres, asked, 5, probes=9, query_rows=10)
    assert sorted(map(tuple, found.select("query_id", "vec_id", "rank").collect())) == sorted(
        map(tuple, exact.select("query_id", "vec_id", "rank").collect()))


def test_calibrated_probes_reach_the_recall_with_less_work(clustered):
    centres = vector_index.fit_centres(clustered, cells=30)
    index = vector_index.build_index(clustered, centres)
    probes = vector_index.probes_for(index, centres, 5, target=0.97)
    assert 1 <= probes < 15
    asked = queries_of(clustered)
    row = vector_index.recall(vector_index.search(index, centres, asked, 5, probes),
                              vector_index.vector_top_k(clustered, asked, 5)).first()
    assert row["recall"] >= 0.9 and row["queries"] == retrieval.usable_vectors(asked).count()


def test_scan_reads_the_probed_cells_only(spark, clustered):
    centres = vector_index.fit_centres(clustered, cells=20)
    index = vector_index.build_index(clustered, centres)
    one = clustered.where("vec_id = 7").select(F.col("vec_id").alias("query_id"), "embedding")
    cell = vector_index.with_cells(one, centres).first()["cell"]
    plan = index.where(F.col("cell") == cell)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    centres = vector_index.fit_centres(df)
    asked = df.select(F.col("vec_id").alias("query_id"), "embedding")
    assert vector_index.search(vector_index.build_index(df, centres), centres, asked, 3).count() == 1
    assert vector_index.fit_centres(df.where("false")).shape == (0, 0)
