import random

import pytest
from pyspark.sql import functions as F

from tarnwatch import constants as C
from tarnwatch.functions.text import (
    clean_text, collapse_whitespace, explode_chunks, keyword_score, question_words,
)
from tarnwatch.operators import retrieval
from tarnwatch.schemas import RAG_DOCUMENTS
from tarnwatch.sources import corpus


def cut(spark, text, **options):
    df = spark.createDataFrame([("d", text)], "doc_id string, content string")
    rows = explode_chunks(df, "content", keep=("doc_id",), **options).orderBy("chunk_id").collect()
    assert [r.chunk_id for r in rows] == list(range(len(rows)))
    return [r.text for r in rows]


@pytest.mark.parametrize("length, sizes", [
    (0, []), (1, [1]), (250, [250]), (251, [251, 1]), (300, [300, 50]), (301, [300, 51]),
    (550, [300, 300, 50]),
])
def test_chunk_lengths(spark, length, sizes):
    assert [len(c) for c in cut(spark, "x" * length)] == sizes


@pytest.mark.parametrize("size, overlap", [(300, 50), (10, 0), (10, 7), (7, 6), (1, 0)])
def test_chunks_are_slices_of_any_text(spark, size, overlap):
    rng = random.Random(size)
    text = "".join(rng.choice("aé\n ß😀\t") for _ in range(rng.randrange(90, 140)))
    step = size - overlap
    want = [text[s:s + size] for s in range(0, len(text), step)]
    assert cut(spark, text, size=size, overlap=overlap) == want


def test_long_text_is_cut_whole(spark):
    text = "".join(f"{i:07d}," for i in range(40_000))
    chunks = cut(spark, text)
    assert "".join(c[:250] for c in chunks) == text


@pytest.mark.parametrize("size, overlap", [(50, 50), (50, 60), (0, 0), (10, -1)])
def test_bad_sizes(spark, size, overlap):
    with pytest.raises(ValueError):
        cut(spark, "text", size=size, overlap=overlap)


def test_cleaning(spark):
    row = spark.createDataFrame([("  A\nB  ", "\n a \t b\n\nc ")], "x string, y string").select(
        clean_text("x").alias("x"), collapse_whitespace("y").alias("y")).first()
    assert (row.x, row.y) == ("a\nb", "a b c")
    newline = spark.createDataFrame([("\n A \n",)], "x string").select(clean_text("x")).first()
    assert newline[0] == "\n a \n"


def test_keyword_score_counts_substrings_once(spark):
    df = spark.createDataFrame([("slate sla slam",), ("none",)], "t string")
    scores = df.select(keyword_score(F.col("t"), ["SLA", "late", "breach"]).alias("s")).collect()
    assert [r.s for r in scores] == [2, 0]


def test_question_words(spark):
    df = spark.createDataFrame([("What is the SLA-breach rate at 15%? Rate!",)], "q string")
    assert df.select(question_words("q")).first()[0] == [
        "what", "is", "the", "sla", "breach", "rate", "at", "15"]


def test_hot_key_of_copies_is_reduced_in_each_task(spark):
    copies = spark.range(5000).select(
        F.lit("d").alias("doc_id"), F.lit(0).cast("bigint").alias("chunk_id"),
        F.concat(F.lit("text "), F.format_string("%05d", "id")).alias("text"),
        F.lit("t").alias("doc_type"))
    other = copies.limit(1).withColumn("doc_id", F.lit("e"))
    df = retrieval.keyed_chunks(copies.union(other))
    assert [tuple(r) for r in retrieval.duplicate_keys(df).collect()] == [("d_0", 5000)]
    kept = retrieval.drop_duplicate_keys(df, "id", "text")
    assert kept.columns == df.columns
    assert {r.id: r.text for r in kept.collect()} == {"d_0": "text 00000", "e_0": "text 00000"}
    assert retrieval.duplicate_keys(kept).count() == 0


def test_derived_columns_are_not_sorted_or_shuffled(spark):
    df = retrieval.keyed_chunks(spark.range(60).select(
        F.lit("d").alias("doc_id"), (F.col("id") % 20).alias("chunk_id"),
        F.concat(F.lit(" T"), F.col("id") % 7).alias("text"), (F.col("id") % 3).cast("string").alias("doc_type")))
    plain = retrieval.drop_duplicate_keys(df, "id", "text")
    lean = retrieval.drop_duplicate_keys(df, "id", "text", retrieval.derived_columns())
    plan = lean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lower(") == 1 and plan.index("lower(") < plan.index("SortAggregate")
    assert lean.columns == plain.columns and sorted(lean.collect()) == sorted(plain.collect())


def test_large_tables_are_dealt_by_size(spark, tmp_path):
    """The number of tasks follows the size: it is not fixed by the cores."""
    spark.range(20_000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("content"),
                               F.lit("t").alias("doc_type")).coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    names = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        parts = retrieval.chunk_documents(docs).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert parts > spark.sparkContext.defaultParallelism


def test_an_assembled_corpus_is_dealt_once(spark):
    d = "/root/testdata/sf0.001"
    docs = corpus.assemble(corpus.from_documents(spark.read.parquet(f"{d}/documents.parquet")),
                           corpus.from_pages(spark.read.parquet(f"{d}/pages.parquet")))
    plan = retrieval.chunk_documents(docs, dealt=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2


def test_corpus_has_the_declared_columns_and_metadata(spark):
    d = "/root/testdata/sf0.001"
    docs = corpus.assemble(
        corpus.from_documents(spark.read.parquet(f"{d}/documents.parquet")),
        corpus.from_pages(spark.read.parquet(f"{d}/pages.parquet")),
        corpus.from_conversations(spark.read.parquet(f"{d}/conversations.parquet")))
    assert [(f.name, f.dataType.simpleString()) for f in docs.schema] == [
        (f.name, f.dataType.simpleString()) for f in RAG_DOCUMENTS]
    assert docs.count() == 200 + 50 + 87
    assert docs.where("doc_type = 'page'").first().metadata["author"] == "web"


def test_sample_questions_hold_the_fixed_lists(spark):
    texts = [r.question for r in corpus.sample_questions(spark).orderBy("question_id").collect()]
    assert texts == C.SAMPLE_QUESTIONS + C.ASSISTANT_QUESTIONS
