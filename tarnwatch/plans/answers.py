"""From retrieved chunks to prompts, cited answers and sources, for a table of questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    NOT_FOUND, PROMPT_HEAD, PROMPT_QUESTION, PROMPT_TAIL, RERANK_K, RETRIEVE_K,
)
from ..functions.text import citation, collapse_whitespace
from ..operators.ranking import top_k
from ..operators.retrieval import retrieve_by_keywords


def rerank(hits: DataFrame, k: int = RERANK_K) -> DataFrame:
    """Longest texts first; equal lengths keep the retrieval order."""
    return top_k(hits, ["question_id"],
                 [F.length("text").desc(), F.col("retrieval_rank")], k, "rank")


def joined_in_order(rank: str, text: Column, separator: str) -> Column:
    """Texts of a group joined in rank order; groups hold at most the reranked chunks."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), text.alias("s"))))
    return F.array_join(F.transform(ordered, lambda x: x["s"]), separator)


def grounded(reranked: DataFrame) -> DataFrame:
    """Per question: context blocks, sources and the first chunk as the answer."""
    block = F.concat(F.lit("[Source: "), citation(), F.lit("]\n"), F.col("text"))
    first = F.concat(F.col("text"), F.lit(" [source: "), citation(), F.lit("]"))
    return reranked.groupBy("question_id").agg(
        joined_in_order("rank", block, "\n\n").alias("context"),
        joined_in_order("rank", citation(), ", ").alias("sources"),
        F.max(F.when(F.col("rank") == 1, first)).alias("first"),
    )


def prompt_text(context: Column, question: Column) -> Column:
    return F.concat(F.lit(PROMPT_HEAD), context, F.lit(PROMPT_QUESTION), question,
                    F.lit(PROMPT_TAIL))


def prompts(questions: DataFrame, reranked: DataFrame) -> DataFrame:
    """Grounded prompt of every question that has hits."""
    return questions.join(grounded(reranked), "question_id").select(
        "question_id", prompt_text(F.col("context"), F.col("question")).alias("prompt"))


def answers(questions: DataFrame, reranked: DataFrame) -> DataFrame:
    """One row per question; without hits the answer says so and the sources are empty."""
    found = questions.join(grounded(reranked), "question_id", "left")
    return found.select(
        "question_id", "question",
        F.coalesce(collapse_whitespace("first"), F.lit(NOT_FOUND)).alias("answer"),
        F.coalesce("sources", F.lit("")).alias("sources"),
    )


def answer_questions(questions: DataFrame, chunks: DataFrame, k: int = RETRIEVE_K,
                     keep: int = RERANK_K) -> DataFrame:
    """The whole chain. `questions` has question_id, question and keywords."""
    return answers(questions, rerank(retrieve_by_keywords(chunks, questions, k), keep))
