import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwatch.operators import retrieval


@pytest.fixture(scope="module")
def chunks(spark):
    rng = random.Random(11)
    words = ["sla", "slack", "breach", "alert", "alerts", "ü", "a", "runbook", "run", "noise é"]
    data = [(f"d{i}", 0, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12))))
            for i in range(300)]
    df = spark.createDataFrame(data, "doc_id string, chunk_id bigint, text string")
    return retrieval.keyed_chunks(df.withColumn("doc_type", F.lit("t"))).cache()


@pytest.fixture(scope="module")
def questions(spark):
    data = [("q1", ["SLA", "breach", "sla"]), ("q2", ["alert", "noise é", "ü"]), ("q3", ["absent"]),
            ("q4", []), ("q5", ["a"]), ("q6", ["runbook", "run", "slack"]), ("q7", None)]
    return spark.createDataFrame(data, "question_id string, keywords array<string>")


def brute(chunks, questions):
    out = {}
    for q in questions.collect():
        words = {w.lower() for w in q.keywords or []}
        for c in chunks.collect():
            score = sum(w in c.text_clean for w in words)
            if score:
                out[(q.question_id, c.id)] = score
    return out


@pytest.mark.parametrize("inline", [64, 2])
def test_both_paths_score_like_brute_force(chunks, questions, monkeypatch, inline):
    monkeypatch.setattr(retrieval, "INLINE_QUESTIONS", inline)
    got = {(r.question_id, r.id): r.score
           for r in retrieval.score_questions(chunks, questions).collect()}
    assert got == brute(chunks, questions)


@pytest.mark.parametrize("inline", [64, 2])
def test_retrieval_ranks_by_score_then_id(chunks, questions, monkeypatch, inline):
    monkeypatch.setattr(retrieval, "INLINE_QUESTIONS", inline)
    got = {}
    for r in retrieval.retrieve_by_keywords(chunks, questions, 4).collect():
        got.setdefault(r.question_id, []).append((r.retrieval_rank, r.id, r.score))
    want = {}
    for (q, c), score in brute(chunks, questions).items():
        want.setdefault(q, []).append((-score, c))
    assert got.keys() == want.keys()
    for q, hits in want.items():
        best = sorted(hits)[:4]
        assert sorted(got[q]) == [(i, c, -s) for i, (s, c) in enumerate(best, 1)]


def test_no_keywords_at_all(spark, chunks, monkeypatch):
    none = spark.createDataFrame([("q", [])], "question_id string, keywords array<string>")
    assert retrieval.score_questions(chunks, none).count() == 0
    monkeypatch.setattr(retrieval, "INLINE_QUESTIONS", 0)
    assert retrieval.score_questions(chunks, none).count() == 0


def test_keyword_hits_order(chunks):
    rows = retrieval.keyword_hits(chunks, ["sla", "alert", "run"]).collect()
    assert [(-r.score, r.id) for r in rows] == sorted((-r.score, r.id) for r in rows)
    assert all(r.score > 0 for r in rows)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(400, 8)).astype(np.float32)
    data[7] = 0
    data[9] = data[8]
    rows = [(i, [float(x) for x in v], int(i % 3)) for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(
        6).cache()


@pytest.mark.parametrize("inline, cell_rows", [(1024, 100_000), (10, 90)])
def test_vector_paths_equal_brute_force(vectors, monkeypatch, inline, cell_rows):
    monkeypatch.setattr(retrieval, "SLICE_ROWS", 17)
    queries = vectors.where("vec_id < 40").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>"))
    got = {}
    for r in retrieval.vector_top_k(vectors, queries, 5, inline, cell_rows).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.similarity))
    data = {r.vec_id: np.array(r.embedding, dtype=float) for r in vectors.collect()}

    def unit(v):
        return v / np.linalg.norm(v) if np.linalg.norm(v) else v

    for q in range(40):
        similar = {i: float(unit(data[q]) @ unit(v)) for i, v in data.items()}
        best = sorted(similar.items(), key=lambda p: (-round(p[1], 12), p[0]))[:5]
        hits = sorted(got[q])
        assert [rank for rank, _, _ in hits] == [1, 2, 3, 4, 5]
        assert np.allclose([s for _, _, s in hits], [s for _, s in best], atol=1e-9)
        if q not in (7, 8, 9):
            assert [i for _, i, _ in hits] == [i for i, _ in best]


def test_label_profiles_are_means(vectors):
    got = {r.query_id: r.embedding for r in retrieval.label_profiles(vectors).collect()}
    rows = vectors.collect()
    for label in range(3):
        want = np.mean([r.embedding for r in rows if r.label == label], axis=0)
        assert np.allclose(got[label], want)


def test_odd_keywords_score_alike_on_both_paths(spark, chunks, monkeypatch):
    asked = spark.createDataFrame([("q1", ["", "SLA", None, "sla"]), ("q2", [None, ""]), ("q3", ["Ü", "a"])],
                                  "question_id string, keywords array<string>")
    both = []
    for inline in (64, 0):
        monkeypatch.setattr(retrieval, "INLINE_QUESTIONS", inline)
        both.append(sorted(map(tuple, retrieval.score_questions(chunks, asked).select("question_id", "id", "score").collect())))
    assert both[0] == both[1] and {q for q, _, _ in both[0]} == {"q1", "q3"}


@pytest.mark.parametrize("keywords,rows", [(1, 3), (100_000, 2048)])
def test_best_chunks_in_blocks(chunks, questions, monkeypatch, keywords, rows):
    monkeypatch.setattr(retrieval, "BLOCK_KEYWORDS", keywords)
    monkeypatch.setattr(retrieval, "SCORED_ROWS", rows)
    got = {(r.question_id, r.id): r.score for r in retrieval.retrieve_by_keywords(chunks, questions, 400).collect()}
    assert got == brute(chunks, questions)


def test_null_and_ragged_vectors_have_no_neighbours(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [0.0, 1.0]), (5, [None, 1.0])],
                                   "vec_id bigint, embedding array<float>")
    asked = corpus.withColumnRenamed("vec_id", "query_id")
    for inline in (100, 1):
        got = retrieval.vector_top_k(corpus, asked, 2, inline=inline, cell_rows=1).collect()
        assert sorted((r.query_id, r.vec_id) for r in got) == [(1, 1), (1, 4), (4, 1), (4, 4)]
