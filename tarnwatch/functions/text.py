"""Text expressions: chunks, cleaning, keyword tests, citations."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CHUNK_OVERLAP, CHUNK_SIZE


def explode_chunks(df: DataFrame, text: str, size: int = CHUNK_SIZE,
                   overlap: int = CHUNK_OVERLAP, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per chunk of `size` characters, each starting `size - overlap` after the last.

    The text is cut once into strides (one pass, so long texts stay linear); a chunk
    is its stride plus what it needs of the following ones. Empty text gives no row.
    """
    if size <= 0 or overlap < 0 or overlap >= size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap
    cut = df.select(
        *keep,
        F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0)).alias("_strides"),
    )

    def chunk(stride: Column, i: Column) -> Column:
        following = [
            F.coalesce(F.get("_strides", i + j), F.lit("")) for j in range(1, math.ceil(size / step))
        ]
        return F.substring(F.concat(stride, *following), 1, size)

    chunks = F.posexplode(F.transform("_strides", chunk)).alias("_pos", "text")
    return (
        cut.select(*keep, chunks)
        .select(*keep, F.col("_pos").cast("bigint").alias("chunk_id"), "text")
    )


def clean_text(text: str | Column) -> Column:
    """Lower case, spaces trimmed at both ends (line breaks stay)."""
    return F.trim(F.lower(text))


def collapse_whitespace(text: str | Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def contains_any(text: Column, words: list[str]) -> Column:
    """True where the lower-cased text contains one of the words."""
    lowered = F.lower(text)
    return reduce(or_, [F.contains(lowered, F.lit(w)) for w in words])


def keyword_score(text_clean: Column, keywords: list[str]) -> Column:
    """One point per keyword that occurs in the cleaned text as a substring, however often."""
    points = [F.contains(text_clean, F.lit(w.lower())).cast("int") for w in keywords]
    return reduce(lambda a, b: a + b, points, F.lit(0))


def question_words(text: str | Column) -> Column:
    """Distinct lower-cased words of a question, punctuation removed; every word counts."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.array_distinct(words)


def chunk_key() -> Column:
    return F.concat_ws("_", "doc_id", "chunk_id")


def citation() -> Column:
    return F.concat_ws("-", "doc_id", "chunk_id")
