"""From `documents` to token files: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it to the shared
folder as Parquet and reads it again for the next one. All but the last return the columns of
`documents`; the last returns a row per document as the token files hold it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnwatch.llm import decontaminate, mixing, near_dups, quality, token_files
from tarnwatch.llm.registry import tokenizer_path
from tarnwatch.llm.shared import table
from tarnwatch.operators.bounded import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified cutoff rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id."""
    return near_dups.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words lie in benchmark windows go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per full pass over a document, and the leading words where the budget ends."""
    return mixing.mixed_rows(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of bit planes, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_files.encode_and_read_back(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_deduplication),
    ("decontamination", benchmark_decontamination),
    ("mixing", source_mixing),
    ("token_output", token_output),
]

#: Certified cutoffs and token ids are beyond SQL: tests compare `run` with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
