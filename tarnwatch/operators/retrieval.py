"""Keyword and vector retrieval for a table of questions, key audit and deduplication."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import RETRIEVE_K
from ..functions.text import chunk_key, clean_text, explode_chunks, keyword_score
from .bounded import bounded_rows, read_folder, spread, stored, stored_by, with_derived
from .ranking import top_k

# Up to this many questions and keywords are written into the scan's expressions.
INLINE_QUESTIONS = 64
INLINE_KEYWORDS = 512
# Keywords of the questions that one scan answers, and chunks scored at a time.
BLOCK_KEYWORDS, BLOCK_QUESTIONS = 100_000, 4_096
SCORED_ROWS = 2_048
# Up to this many query vectors are sent to every task.
INLINE_VECTORS = 1024
# Rows of a corpus shard that meets a block of query vectors in one task.
CELL_ROWS = 100_000
# Corpus rows per matrix product: the product stays below 64 MB.
SLICE_ROWS = 8_192


# --- Chunk tables -------------------------------------------------------------

def chunk_documents(docs: DataFrame, dealt: bool = False, **size) -> DataFrame:
    """Chunks of every document with its type: doc_id, chunk_id, text, doc_type.

    The sources of an assembled corpus are `dealt` already; a second shuffle of the texts would change nothing.
    """
    docs = docs.select("doc_id", "doc_type", "content")
    docs = docs if dealt else spread(docs, "doc_id")
    chunks = explode_chunks(docs, "content", keep=("doc_id", "doc_type"), **size)
    return chunks.select("doc_id", "chunk_id", "text", "doc_type")


def derived_columns() -> dict[str, Column]:
    """Columns of keyed chunks that follow from their text: as long as the text, and cheap to compute."""
    return {"text_clean": clean_text("text")}


def keyed_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.withColumns({**derived_columns(), "id": chunk_key()})


def duplicate_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """Keys that occur more than once; copies are counted before the shuffle."""
    return df.groupBy(key).agg(F.count("*").alias("count")).where(F.col("count") > 1)


def drop_duplicate_keys(df: DataFrame, key: str, prefer: str, derived: dict[str, Column] | None = None) -> DataFrame:
    """One row per key, the least by `prefer` and then by the other columns.

    The minimum is taken in each task first, so a key with very many copies sends one
    row per task. Columns in `derived` follow from the others: they are neither sorted nor
    shuffled, but computed for the rows that are kept.
    """
    others = [prefer] + [c for c in df.columns if c not in (key, prefer, *(derived or {}))]
    least = df.groupBy(key).agg(F.min(F.struct(*others)).alias("_row"))
    return with_derived(least.select(key, "_row.*"), df.columns, derived).select(*df.columns)


# --- Keyword retrieval --------------------------------------------------------

def keyword_hits(chunks: DataFrame, keywords: list[str]) -> DataFrame:
    """Chunks that contain a keyword, scored, best first and then by id."""
    scored = chunks.withColumn("score", keyword_score(F.col("text_clean"), keywords))
    return scored.where(F.col("score") > 0).orderBy(F.col("score").desc(), "id")


def question_keywords(questions: DataFrame) -> DataFrame:
    """(question_id, keyword): lower case, no nulls, no empty ones, each once."""
    return (
        questions.select("question_id", F.explode("keywords").alias("keyword"))
        .select("question_id", F.lower("keyword").alias("keyword"))
        .where(F.length("keyword") > 0).distinct()
    )


def score_questions(chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """question_id, id and score of every chunk that contains a keyword of a question."""
    wanted = question_keywords(questions)
    rows = bounded_rows(wanted, INLINE_KEYWORDS)
    if rows is not None and len({r.question_id for r in rows}) <= INLINE_QUESTIONS:
        return _score_inline(chunks, rows)
    return _score_by_join(chunks, wanted)


def _score_inline(chunks: DataFrame, rows: list) -> DataFrame:
    """Few questions: all scores of a chunk are computed in the scan, without a join."""
    words: dict[str, list[str]] = {}
    for r in rows:
        words.setdefault(r.question_id, []).append(r.keyword)
    scores = [
        F.struct(F.lit(question).alias("question_id"),
                 keyword_score(F.col("text_clean"), sorted(own)).alias("score"))
        for question, own in sorted(words.items())
    ]
    if not scores:
        return chunks.sparkSession.createDataFrame([], "id string, question_id string, score int")
    return chunks.select("id", F.inline(F.array(*scores))).where(F.col("score") > 0)


def _anchor_length(word_length: Column) -> Column:
    return F.when(word_length >= 6, 6).when(word_length >= 4, 4).otherwise(word_length)


def _score_by_join(chunks: DataFrame, wanted: DataFrame) -> DataFrame:
    """Many questions: substring search as an equi-join on the first letters of a keyword.

    Every text position offers its next characters under prefixes of at most five
    lengths; a keyword joins on its own prefix and is then compared in full. Spark
    broadcasts the keywords while they are small and splits hot prefixes when not.
    """
    words = wanted.select("keyword").distinct().withColumn(
        "anchor", F.col("keyword").substr(F.lit(1), _anchor_length(F.length("keyword"))))
    # At most five lengths and one number, whatever the vocabulary.
    shape = words.agg(F.collect_set(F.length("anchor")), F.max(F.length("keyword"))).first()
    if not shape[0]:
        return chunks.sparkSession.createDataFrame([], "id string, question_id string, score int")
    ahead = F.regexp_extract_all(
        "text_clean", F.lit(f"(?s)(?=(.{{1,{shape[1]}}}))"), F.lit(1))
    lengths = F.array(*[F.lit(n) for n in sorted(shape[0])])
    offers = (
        chunks.select("id", F.explode(ahead).alias("ahead"))
        .select("id", "ahead", F.explode(lengths).alias("n"))
        .where(F.length("ahead") >= F.col("n"))
        .select("id", "ahead", F.col("ahead").substr(F.lit(1), F.col("n")).alias("anchor"))
    )
    found = (
        offers.join(words, "anchor")
        .where(F.startswith("ahead", "keyword"))
        .select("id", "keyword")
        .repartition("id")
        .dropDuplicates(["id", "keyword"])
    )
    # Rows of a chunk are together already, so counting per question needs no shuffle
    # as long as the question words are broadcast.
    return (
        found.join(wanted, "keyword").groupBy("id", "question_id")
        .agg(F.count("*").cast("int").alias("score"))
    )


def best_chunks(chunks: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """question_id, id, score of about `k` best chunks per question and task; no pair is shuffled.

    The chunks stay where they are and are scanned once per block of questions. A block has about
    BLOCK_KEYWORDS keywords and BLOCK_QUESTIONS questions at most, whatever their number. Blocks are
    folders of a stored table; a task reads its own from there, nothing passes through the driver.
    """
    schema = "question_id string, id string, score int"
    wanted = stored(question_keywords(questions), "keywords")
    size = wanted.agg(F.count("*").alias("keywords"), F.count_distinct("question_id").alias("questions")).first()
    blocks = max(math.ceil(size["keywords"] / BLOCK_KEYWORDS), math.ceil(size["questions"] / BLOCK_QUESTIONS))
    out = chunks.sparkSession.createDataFrame([], schema)
    if blocks:
        spot = F.pmod(F.xxhash64("question_id"), F.lit(blocks)).cast("int")
        folder = stored_by(wanted.withColumn("block", spot), "block", "keyword-blocks")
        for b in range(blocks):
            out = out.unionAll(chunks.select("id", "text_clean").mapInArrow(_best_of(f"{folder}/block={b}", k), schema))
    return out


def _best_of(folder: str, k: int):
    """Scan function: keywords found by one automaton, best chunks kept per question."""
    def scan(batches):
        import ahocorasick
        pairs = read_folder(folder, ["question_id", "keyword"])
        names = sorted({q for q, _ in pairs})
        place = {q: i for i, q in enumerate(names)}
        asking: dict[str, list[int]] = {}
        for question, word in pairs:
            asking.setdefault(word, []).append(place[question])
        finder = ahocorasick.Automaton()
        owners = []
        for word, own in asking.items():
            finder.add_word(word, len(owners))
            owners.append(np.array(own))
        if not names:
            return
        finder.make_automaton()
        held = [[] for _ in names]
        for batch in batches:
            for start in range(0, batch.num_rows, SCORED_ROWS):
                part = batch.slice(start, SCORED_ROWS)
                ids = part.column("id").to_pylist()
                scores = np.zeros((len(ids), len(names)), np.int64)
                for i, text in enumerate(part.column("text_clean").to_pylist()):
                    found = {w for _, w in finder.iter(text or "")}
                    if found:
                        scores[i] = np.bincount(np.concatenate([owners[w] for w in found]), minlength=len(names))
                # One number orders a slice: score first, then the lower id.
                rank = np.empty(len(ids), np.int64)
                rank[sorted(range(len(ids)), key=ids.__getitem__, reverse=True)] = np.arange(len(ids))
                order = scores * len(ids) + rank[:, None]
                best = np.argpartition(order, -k, axis=0)[-k:] if len(ids) > k else np.arange(len(ids))[:, None]
                for q in range(len(names)):
                    rows = best[:, min(q, best.shape[1] - 1)]
                    new = [(-int(scores[i, q]), ids[i]) for i in rows if scores[i, q]]
                    if new:
                        held[q] = sorted(held[q] + new)[:k]
        flat = [(names[q], i, -s) for q, own in enumerate(held) for s, i in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in flat], kind) for c, kind in enumerate((pa.string(), pa.string(), pa.int32()))],
            names=["question_id", "id", "score"])

    return scan


def retrieve_by_keywords(chunks: DataFrame, questions: DataFrame, k: int = RETRIEVE_K) -> DataFrame:
    """Best `k` chunks per question by keyword score, then id, with their text.

    Only ids and scores are ranked. The winners are written once, and the chunks are
    scanned again for their text, with a broadcast when the winners are few.
    """
    best = stored(
        top_k(best_chunks(chunks, questions, k), ["question_id"],
              [F.col("score").desc(), F.col("id")], k, "retrieval_rank"),
        "retrieved")
    texts = chunks.select("id", "doc_id", "chunk_id", "text")
    return texts.join(best, "id")


def first_chunks(chunks: DataFrame, k: int) -> DataFrame:
    """The same first `k` chunks for any question."""
    return chunks.orderBy("id").limit(k).select("id", "doc_id", "chunk_id", "text")


# --- Vector retrieval ---------------------------------------------------------

def _unit_rows(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


class _Nearest:
    """Running top-k per query vector over slices of a corpus; ties go to the lower id."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = _unit_rows(queries.astype(float)), k
        self.held = [(np.empty(0, np.int64), np.empty(0))] * len(queries)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for start in range(0, len(ids), SLICE_ROWS):
            part = slice(start, start + SLICE_ROWS)
            self._add(ids[part], _unit_rows(vectors[part].astype(float)) @ self.queries.T)

    def _add(self, ids: np.ndarray, product: np.ndarray) -> None:
        for q, similar in enumerate(product.T):
            keep = slice(None)
            if len(similar) > self.k:
                # Everything that reaches the k-th value stays, so that ids settle ties.
                keep = np.flatnonzero(similar >= np.partition(similar, -self.k)[-self.k])
            all_ids = np.concatenate([self.held[q][0], ids[keep]])
            values = np.concatenate([self.held[q][1], similar[keep]])
            order = np.lexsort((all_ids, -values))[:self.k]
            self.held[q] = (all_ids[order], values[order])

    def columns(self, query_ids: np.ndarray) -> dict[str, np.ndarray]:
        counts = [len(ids) for ids, _ in self.held]
        return {
            "query_id": np.repeat(query_ids, counts),
            "vec_id": np.concatenate([ids for ids, _ in self.held]),
            "similarity": np.concatenate([values for _, values in self.held]),
        }


def usable_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there, without nulls in it, and as long as most are."""
    whole = df.where(F.col(column).isNotNull() & ~F.exists(column, lambda x: x.isNull()))
    usual = whole.groupBy(F.size(column).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return whole.where(F.size(column) == (usual["n"] if usual else 0))


def vector_top_k(corpus: DataFrame, queries: DataFrame, k: int = RETRIEVE_K,
                 inline: int = INLINE_VECTORS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Exact `k` nearest corpus vectors per query by cosine: query_id, vec_id, similarity, rank.

    `corpus` has vec_id and embedding, `queries` query_id and embedding, all of one
    length; null, ragged or short vectors have no neighbours. Each task keeps k rows per query, so little is shuffled.
    """
    corpus, queries = usable_vectors(corpus), usable_vectors(queries)
    rows = bounded_rows(queries.select("query_id", "embedding"), inline)
    if rows is not None:
        part = _vectors_inline(corpus, rows, k)
    else:
        part = _vectors_by_cell(corpus, queries, k, inline, cell_rows)
    return top_k(part, ["query_id"], [F.col("similarity").desc(), F.col("vec_id")], k)


def _vectors_inline(corpus: DataFrame, rows: list, k: int) -> DataFrame:
    """Few queries: one matrix product per batch of the corpus scan."""
    schema = "query_id bigint, vec_id bigint, similarity double"
    if not rows:
        return corpus.sparkSession.createDataFrame([], schema)
    names = np.array([r.query_id for r in rows], dtype=np.int64)
    vectors = corpus.sparkSession.sparkContext.broadcast(
        np.array([r.embedding for r in rows], dtype=float))

    def scan(batches):
        nearest = _Nearest(vectors.value, k)
        for batch in batches:
            nearest.add(batch.column("vec_id").to_numpy(zero_copy_only=False),
                        _matrix(batch.column("embedding")))
        yield pa.RecordBatch.from_pydict(nearest.columns(names))

    return corpus.select("vec_id", "embedding").mapInArrow(scan, schema)


def _vectors_by_cell(corpus: DataFrame, queries: DataFrame, k: int, block: int,
                     cell_rows: int) -> DataFrame:
    """Many queries: blocks of queries meet shards of the corpus, k rows per query and cell."""
    blocks = math.ceil(queries.count() / block)
    shards = max(1, math.ceil(corpus.count() / cell_rows))

    def spot(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.select("query_id", "embedding", spot("query_id", blocks).alias("block"),
                          every(shards).alias("shard"))
    right = corpus.select("vec_id", "embedding", spot("vec_id", shards).alias("shard"),
                          every(blocks).alias("block"))

    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "similarity": []})
        nearest = _Nearest(np.stack(q["embedding"]), k)
        nearest.add(c["vec_id"].to_numpy(), np.stack(c["embedding"]))
        return pd.DataFrame(nearest.columns(q["query_id"].to_numpy()))

    return left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInPandas(
        cell, "query_id bigint, vec_id bigint, similarity double")


def label_profiles(embeddings: DataFrame) -> DataFrame:
    """Mean vector of each label, as queries for what is typical of the label."""
    means = embeddings.groupBy("label").agg(
        Summarizer.mean(array_to_vector("embedding")).alias("_mean"))
    return means.select(F.col("label").cast("bigint").alias("query_id"),
                        vector_to_array("_mean").alias("embedding"))
