"""Knowledge-base documents from several sources, and questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ASSISTANT_QUESTIONS, SAMPLE_QUESTIONS
from ..operators.bounded import spread
from ..schemas import RAG_DOCUMENTS


def documents(doc_id: Column, doc_type: str, title: Column, content: Column,
              created_date: Column, metadata: dict[str, Column]) -> list[Column]:
    """Columns of one corpus source in the order of RAG_DOCUMENTS."""
    entries = [part for name, value in metadata.items() for part in (F.lit(name), value)]
    return [
        doc_id.alias("doc_id"), F.lit(doc_type).alias("doc_type"), title.alias("title"),
        content.alias("content"), created_date.alias("created_date"),
        F.create_map(*entries).alias("metadata"),
    ]


def from_documents(df: DataFrame, created: str = "2024-02-01") -> DataFrame:
    return df.select(*documents(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")), "document",
        F.concat(F.lit("Document "), F.col("doc_id").cast("string")), F.col("text"),
        F.lit(created), {"author": F.col("source"), "lang": F.col("lang")}))


def from_pages(df: DataFrame, created: str = "2024-02-10") -> DataFrame:
    return df.select(*documents(
        F.concat(F.lit("page_"), F.col("page_id").cast("string")), "page",
        F.col("url"), F.col("html"), F.lit(created), {"author": F.lit("web"), "url": F.col("url")}))


def from_conversations(df: DataFrame, created: str = "2024-03-01") -> DataFrame:
    """One document per turn."""
    return df.select(*documents(
        F.concat_ws("_", F.lit("conv"), "conv_id", "turn"), "conversation",
        F.concat(F.lit("Conversation "), F.col("conv_id").cast("string")), F.col("text"),
        F.lit(created), {"author": F.col("role"), "turn": F.col("turn").cast("string")}))


def from_incidents(df: DataFrame) -> DataFrame:
    """One postmortem text per incident row."""
    number = F.regexp_extract("incident_id", r"(\d+)", 1)
    minutes = F.round("resolution_time_mins").cast("bigint").cast("string")
    text = F.concat(
        F.lit("\n"), F.lit("Incident "), number, F.lit(" hit the "), F.col("service_name"),
        F.lit(" service in "), F.col("region"), F.lit(" with severity "),
        F.col("severity").cast("string"), F.lit(".\n"),
        F.lit("The root cause was "), F.translate("root_cause", "_", " "), F.lit(".\n"),
        F.lit("It was resolved by "), F.col("team"), F.lit(" after "), minutes,
        F.lit(" minutes; the SLA limit is "), F.col("sla_threshold_mins").cast("string"),
        F.lit(" minutes.\n"),
        F.when(F.col("sla_breached"),
               "The breach went through escalation to the on-call lead under the runbook.\n")
        .otherwise("The limit was kept and no escalation was needed.\n"),
        F.when(F.col("repeat_incident") == 1, "A duplicate alert added noise for this service.\n")
        .otherwise(""),
    )
    return df.select(*documents(
        F.concat(F.lit("pm_"), number), "postmortem",
        F.concat(F.lit("Incident Postmortem "), number), text,
        F.to_date("timestamp").cast("string"),
        {"author": F.col("team"), "severity": F.col("severity").cast("string")}))


def assemble(*sources: DataFrame) -> DataFrame:
    """One corpus from sources that share the declared columns."""
    dealt = [spread(source, "doc_id") for source in sources]
    return reduce(DataFrame.unionByName, dealt).select(*RAG_DOCUMENTS.names)


def sample_questions(spark: SparkSession) -> DataFrame:
    texts = SAMPLE_QUESTIONS + ASSISTANT_QUESTIONS
    rows = [(f"q{i}", text) for i, text in enumerate(texts, start=1)]
    return spark.createDataFrame(rows, "question_id string, question string")


def user_questions(conversations: DataFrame) -> DataFrame:
    """User turns read as questions."""
    return conversations.where(F.col("role") == "user").select(
        F.concat_ws("_", F.lit("conv"), "conv_id", "turn").alias("question_id"),
        F.col("text").alias("question"))
