"""Question routing and the evidence each routed question gets from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    ASSISTANT_HEAD, ASSISTANT_QUESTION, ASSISTANT_TAIL, ESCALATE_TEXT, ESCALATION_RATE,
    KNOWLEDGE_K, ROUTES, STANDARD_TEXT, TOP_SERVICES,
)
from ..functions.columns import guarded_ratio, percent_text
from ..functions.text import contains_any, question_words
from ..operators.bounded import stored
from ..operators.retrieval import first_chunks, retrieve_by_keywords
from .answers import joined_in_order

QUERY, PREDICT, KNOWLEDGE, PERFORMANCE = ROUTES


def route(questions: DataFrame, routes: dict[str, list[str]] = ROUTES) -> DataFrame:
    """Add the names of the tools a question calls for: none, one or several."""
    picked = [F.when(contains_any(F.col("question"), words), F.lit(tool))
              for tool, words in routes.items()]
    return questions.withColumn("tools", F.array_compact(F.array(*picked)))


def escalation(rate: Column, limit: float = ESCALATION_RATE) -> Column:
    return F.when(rate >= limit, ESCALATE_TEXT).otherwise(STANDARD_TEXT)


def sla_status(scores: DataFrame, top: int = TOP_SERVICES) -> DataFrame:
    """One row: totals, breach rate, escalation and the services with the most anomalies.

    Rows are counted per service in one scan and the counts written; totals and leaders
    are both read from there.
    """
    per_service = stored(scores.groupBy("service_name").agg(
        F.count("*").alias("n"),
        F.count_if(F.coalesce(F.col("sla_breached"), F.lit(False))).alias("b"),
        F.count_if(F.coalesce(F.col("is_anomaly"), F.lit(False))).alias("a"),
    ), "services")
    rated = per_service.withColumn("rate", guarded_ratio(F.col("a"), F.col("n")))
    leaders = (
        rated.orderBy(F.col("rate").desc(), "service_name").limit(top)
        .agg(F.array_sort(F.collect_list(F.struct(
            (-F.col("rate")).alias("r"), "service_name"))).alias("o"))
        .select(F.transform("o", lambda x: F.struct(
            x["service_name"].alias("service"), F.round(-x["r"], 4).alias("rate"))))
    )
    total = F.coalesce(F.sum("n"), F.lit(0))
    breached = F.coalesce(F.sum("b"), F.lit(0))
    rate = guarded_ratio(F.col("breached"), F.col("total_incidents"))
    return per_service.agg(
        total.alias("total_incidents"), breached.alias("breached"),
    ).select(
        "total_incidents", "breached", F.round(rate, 4).alias("sla_breach_rate"),
        percent_text(rate).alias("breach_percent"),
        escalation(rate).alias("escalation"),
        leaders.scalar().alias("top_anomaly_services"),
    )


def service_list(services: Column) -> Column:
    """`[('name', rate), ...]` with rates as plain decimals."""

    def plain(rate: Column) -> Column:
        digits = F.regexp_replace(rate.cast("decimal(6,4)").cast("string"), "0+$", "")
        return F.regexp_replace(digits, r"\.$", ".0")

    items = F.transform(services, lambda s: F.concat(
        F.lit("('"), s["service"], F.lit("', "), plain(s["rate"]), F.lit(")")))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def knowledge(questions: DataFrame, chunks: DataFrame, k: int = KNOWLEDGE_K,
              mode: str = "keywords") -> DataFrame:
    """question_id with its document bullets and their number.

    `keywords` retrieves by the question's own words; `first_k` gives every question
    the same first chunks.
    """
    if mode == "first_k":
        docs = first_chunks(chunks, k).agg(
            F.array_sort(F.collect_list(F.struct("id", "text"))).alias("d"))
        docs = docs.select(F.struct(
            F.array_join(F.transform("d", lambda x: F.concat(F.lit("- "), x["text"], F.lit("\n"))),
                         "").alias("bullets"),
            F.size("d").alias("docs_returned")))
        return questions.select("question_id", docs.scalar().alias("d")).select(
            "question_id", "d.*")
    if mode != "keywords":
        raise ValueError("mode is 'keywords' or 'first_k'")
    asked = questions.withColumn("keywords", question_words("question"))
    bullet = F.concat(F.lit("- "), F.col("text"), F.lit("\n"))
    return retrieve_by_keywords(chunks, asked, k).groupBy("question_id").agg(
        joined_in_order("retrieval_rank", bullet, "").alias("bullets"),
        F.count("*").cast("int").alias("docs_returned"),
    )


def asked_ranges(questions: DataFrame, entities: DataFrame) -> DataFrame:
    """(question_id, entity_id, start_date, end_date): which entity a question names, and its days.

    `entities` has entity_id. Words of a question join on it; several entities give several rows. Without
    two dates the range is open on one side or both (null).
    """
    dates = F.regexp_extract_all("question", F.lit(r"\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b"), F.lit(1))
    days = F.transform(dates, lambda d: F.try_to_date(d))
    words = questions.select(
        "question_id", F.explode(F.array_distinct(F.split(F.lower("question"), r"[^\p{L}\p{N}_]+"))).alias("word"),
        F.array_min(days).alias("start_date"),
        F.when(F.size(F.array_compact(F.array_distinct(days))) > 1, F.array_max(days)).alias("end_date"))
    named = entities.select("entity_id", F.lower("entity_id").alias("word"))
    return words.join(named, "word").select("question_id", "entity_id", "start_date", "end_date")


def asked_predictions(asked: DataFrame, scores: DataFrame, flag: str = "is_anomaly", score: str = "risk_score") -> DataFrame:
    """Per question and entity: incidents, flagged share and mean score between its days, both included.

    Scores are added up per entity and day first, so a question meets days, not incidents.
    """
    daily = scores.groupBy(F.col("service_name").alias("entity_id"), F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("n"), F.count_if(F.coalesce(F.col(flag).cast("boolean"), F.lit(False))).alias("flagged"),
        F.sum(score).alias("total"), F.count(score).alias("scored"))
    inside = ((F.col("start_date").isNull() | (F.col("day") >= F.col("start_date")))
              & (F.col("end_date").isNull() | (F.col("day") <= F.col("end_date"))))
    found = asked.join(daily, "entity_id").where(inside).groupBy("question_id", "entity_id").agg(
        F.sum("n").alias("incidents"), F.sum("flagged").alias("flagged"), F.sum("total").alias("total"),
        F.sum("scored").alias("scored"))
    return asked.join(found, ["question_id", "entity_id"], "left").select(
        "question_id", "entity_id", "start_date", "end_date", F.coalesce("incidents", F.lit(0)).alias("incidents"),
        guarded_ratio(F.col("flagged"), F.col("incidents")).alias("prediction"),
        F.try_divide(F.col("total"), F.col("scored")).alias("mean_score"))


def tool_outputs(questions: DataFrame, scores: DataFrame, performance: DataFrame, chunks: DataFrame,
                 k: int = KNOWLEDGE_K) -> DataFrame:
    """(question_id, tool, entity_id, incidents, prediction, docs_returned, f1): what each tool a question
    calls for gives it. `performance` has model_name and f1; a model's name in the question picks its row.
    """
    routed = stored(route(questions).select("question_id", "question", "tools"), "routed")

    def calling(tool):
        return routed.where(F.array_contains("tools", tool)).select("question_id", "question")

    def rows(df, tool, **columns):
        names = {"entity_id": "string", "incidents": "bigint", "prediction": "double", "docs_returned": "bigint", "f1": "double"}
        return df.select("question_id", F.lit(tool).alias("tool"), *[
            columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in names.items()])

    entities = scores.select(F.col("service_name").alias("entity_id")).where("entity_id IS NOT NULL").distinct()
    total = stored(scores.agg(F.count("*").alias("n")), "status").scalar()
    status = calling(QUERY).withColumn("n", total)
    predicted = asked_predictions(asked_ranges(calling(PREDICT), entities), scores)
    known = calling(KNOWLEDGE).join(knowledge(calling(KNOWLEDGE), chunks, k), "question_id", "left")
    models = performance.select(F.col("model_name").alias("entity_id"), "f1")
    judged = asked_ranges(calling(PERFORMANCE), models).join(models, "entity_id")
    return (rows(status, QUERY, incidents=F.col("n"))
            .unionByName(rows(predicted, PREDICT, entity_id=F.col("entity_id"), incidents=F.col("incidents"),
                              prediction=F.col("prediction")))
            .unionByName(rows(known, KNOWLEDGE, docs_returned=F.coalesce("docs_returned", F.lit(0))))
            .unionByName(rows(judged, PERFORMANCE, entity_id=F.col("entity_id"), f1=F.col("f1"))))


def assist(questions: DataFrame, status: DataFrame, prediction: DataFrame,
           performance: DataFrame, chunks: DataFrame, k: int = KNOWLEDGE_K,
           mode: str = "keywords") -> DataFrame:
    """Tool trace, context and prompt of every question.

    `status`, `prediction` and `performance` are one-row results; each is computed once
    for all questions, written, and read as a scalar subquery.
    """
    routed = route(questions)
    asks = routed.where(F.array_contains("tools", KNOWLEDGE)).select("question_id", "question")
    found = knowledge(asks, chunks, k, mode)

    def one_row(df: DataFrame) -> Column:
        return stored(df.select(F.struct(*df.columns).alias("row")), "tool").scalar()

    full = routed.join(found, "question_id", "left").withColumns({
        "_status": one_row(status),
        "_prediction": one_row(prediction),
        "_performance": one_row(performance),
    })

    def uses(tool: str) -> Column:
        return F.array_contains("tools", tool)

    def entry(tool: str, output: Column, docs: Column) -> Column:
        return F.when(uses(tool), F.struct(
            F.lit(tool).alias("tool"), output.alias("output"), docs.alias("docs_returned")))

    s = F.col("_status")
    no_docs, docs = F.lit(None).cast("int"), F.coalesce("docs_returned", F.lit(0))
    trace_status = F.struct(*[s[c].alias(c) for c in (
        "total_incidents", "breached", "sla_breach_rate", "escalation", "top_anomaly_services")])
    trace = F.array_compact(F.array(
        entry(QUERY, F.to_json(trace_status), no_docs),
        entry(PREDICT, F.to_json("_prediction"), no_docs),
        entry(KNOWLEDGE, F.lit(None).cast("string"), docs),
        entry(PERFORMANCE, F.to_json("_performance"), no_docs),
    ))
    sections = [
        (QUERY, F.concat(
            F.lit("\nSLA CONTEXT:\nTotal incidents: "), s["total_incidents"].cast("string"),
            F.lit("\nBreached: "), s["breached"].cast("string"),
            F.lit("\nSLA breach rate: "), s["breach_percent"],
            F.lit("\nEscalation: "), s["escalation"],
            F.lit("\n\nTOP ANOMALY SERVICES:\n"), service_list(s["top_anomaly_services"]),
            F.lit("\n"))),
        (PREDICT, F.concat(F.lit("\nPREDICTION: "), F.to_json("_prediction"))),
        (KNOWLEDGE, F.concat(F.lit("\nRAG CONTEXT:\n"), F.coalesce("bullets", F.lit("")))),
        (PERFORMANCE, F.concat(F.lit("\nMODEL CONTEXT: "), F.to_json("_performance"))),
    ]
    context = F.concat(*[F.when(uses(tool), text).otherwise("") for tool, text in sections])
    return full.select("question_id", "question", "tools", trace.alias("tool_trace"),
                       context.alias("context")).withColumn(
        "prompt", F.concat(F.lit(ASSISTANT_HEAD), F.col("context"), F.lit(ASSISTANT_QUESTION),
                           F.col("question"), F.lit(ASSISTANT_TAIL)))
