"""The threshold algorithm against all inner products."""

import math
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwatch.llm import topk_search

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("row", T.StringType()), T.StructField("dim", T.IntegerType()),
                       T.StructField("score", T.DoubleType())])


def brute(rows, every, k=5):
    whole = [(i, vec_id, [math.floor(Fraction(x) * 256) for x in v]) for i, (vec_id, v) in enumerate(rows)
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, query_id, q in whole:
        if query_id is None or query_id % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, v)), vec_id is None, vec_id or 0)
                         for j, vec_id, v in whole if j != i and len(v) == len(q)))[:k]
        out += [(query_id, rank, None if missing else vec_id, -score)
                for rank, (score, missing, vec_id) in enumerate(scored, 1)]
    return sorted(out, key=repr)


def searched(spark, rows, every, **sizes):
    df = spark.createDataFrame([(i, v, "x", 3, 0.5) for i, v in rows], SCHEMA).repartition(3)
    found = topk_search.top_k(df, F.col("vec_id") % every == 0, **sizes)
    return sorted(map(tuple, found.collect()), key=repr)


def test_shards_and_blocks_with_ties_copies_and_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, list(rows[0][1])) for i in range(40)]                    # a common vector
    rows += [(i, [float(rng.randint(-1, 1)) for _ in range(6)]) for i in range(400, 440)]  # ties
    rows += [(10, list(rows[3][1])), (10, list(rows[3][1])), (None, list(rows[5][1])), (None, [9.0] * 6)]
    rows += [(500, None), (510, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (520, [math.nan] * 6), (530, [math.inf] + [0.0] * 5)]
    rows += [(540, []), (550, []), (560, [1.0, 2.0]), (570, [3.0]), (580, [0.0] * 6), (590, [-0.001] * 6)]
    assert searched(spark, rows, 10, shard=64, query_block=16) == brute(rows, 10)


def test_large_components_stay_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([1e9, -3e8, 2.5, 7e5, 1e12]) * rng.random() for _ in range(4)]) for i in range(40)]
    rows += [(i, [rng.random() * 1e6 for _ in range(4)]) for i in range(40, 60)]
    want = [(q, r, v, min(max(s, topk_search.LOW), topk_search.HIGH)) for q, r, v, s in brute(rows, 4)]
    assert searched(spark, rows, 4, shard=16) == sorted(want, key=repr)


def test_few_rows_and_none(spark):
    assert searched(spark, [], 10) == []
    assert searched(spark, [(10, [1.0])], 10) == []
    rows = [(10, [1.0]), (11, [2.0])]
    assert searched(spark, rows, 10) == brute(rows, 10) == [(10, 1, 11, 131072)]


def test_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(1)
    vectors = np.floor(np.exp(rng.normal(0, 2, (4000, 3))) * 256)
    shard = topk_search.Shard(vectors, pa.chunked_array([np.arange(4000)]), np.arange(4000))
    for at in range(20):
        place, score = shard.top(vectors[at], at, 5)
        all_scores = vectors @ vectors[at]
        all_scores[at] = -1
        assert sorted(score, reverse=True) == sorted(all_scores, reverse=True)[:5]
        assert shard.met < 2000


@given(st.integers(0, 10 ** 6), st.integers(1, 30), st.integers(1, 4), st.integers(1, 5))
@settings(max_examples=150, deadline=None)
def test_any_shard(seed, n, dim, k):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-3, 4, (n, dim)).astype(float)
    shard = topk_search.Shard(vectors, pa.chunked_array([np.arange(n)]), np.arange(n))
    query = rng.integers(-2, 3, dim).astype(float)
    place, score = shard.top(query, 0, k)
    want = sorted((-s, i) for i, s in enumerate((vectors @ query).tolist()) if i)[:k]
    assert list(zip((-score).tolist(), shard.ids.take(pa.array(place)).to_pylist())) == want


def test_number_types():
    small, big = np.array([[100]]), np.array([[2 ** 40]])
    assert topk_search.exact_type(small, small) is np.float64
    assert topk_search.exact_type(small, big * 2 ** 10) is np.int64
    assert topk_search.exact_type(big, big) is object
