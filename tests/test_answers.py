import json

import pytest
from pyspark.sql import functions as F

from tarnwatch import constants as C
from tarnwatch.operators import retrieval
from tarnwatch.plans import answers, assistant, scoring_job


@pytest.fixture(scope="module")
def chunks(spark):
    data = [("pol", 0, "SLA policy:\n escalate   breach"), ("pol", 1, "sla again"),
            ("run", 0, "runbook SLA steps, longest text of all here"), ("x", 0, "SLA another 1")]
    df = spark.createDataFrame(data, "doc_id string, chunk_id bigint, text string")
    return retrieval.keyed_chunks(df.withColumn("doc_type", F.lit("t")))


def test_rerank_keeps_retrieval_order_on_equal_length(spark):
    hits = spark.createDataFrame(
        [("q", "aa", 1), ("q", "bbbb", 2), ("q", "cc", 3), ("q", "dddd", 4)],
        "question_id string, text string, retrieval_rank int")
    kept = answers.rerank(hits, 3).orderBy("rank").collect()
    assert [r.text for r in kept] == ["bbbb", "dddd", "aa"]


def test_chain_with_and_without_hits(spark, chunks):
    questions = spark.createDataFrame(
        [("q1", "What is the SLA?", ["sla"]), ("q2", "Nothing?", ["absent"])],
        "question_id string, question string, keywords array<string>")
    got = {r.question_id: r for r in answers.answer_questions(questions, chunks).collect()}
    assert got["q1"].answer == "runbook SLA steps, longest text of all here [source: run-0]"
    assert got["q1"].sources == "run-0, pol-0, x-0"
    assert (got["q2"].answer, got["q2"].sources) == (C.NOT_FOUND, "")


def test_prompt_blocks(spark, chunks):
    questions = spark.createDataFrame([("q", "How?", ["policy", "runbook"])],
                                      "question_id string, question string, keywords array<string>")
    hits = retrieval.retrieve_by_keywords(chunks, questions)
    prompt = answers.prompts(questions, answers.rerank(hits)).first().prompt
    assert prompt == (
        C.PROMPT_HEAD + "[Source: run-0]\nrunbook SLA steps, longest text of all here\n\n"
        "[Source: pol-0]\nSLA policy:\n escalate   breach" + C.PROMPT_QUESTION + "How?"
        + C.PROMPT_TAIL)


@pytest.mark.parametrize("question, tools", [
    (C.ASSISTANT_QUESTIONS[0], ["query_delta_table", "search_knowledge_base"]),
    (C.ASSISTANT_QUESTIONS[1], ["query_delta_table", "search_knowledge_base"]),
    ("hello", []),
    ("Forecast the MODEL accuracy", ["get_ml_prediction", "get_model_performance"]),
    ("incident", ["query_delta_table"]),
])
def test_routes(spark, question, tools):
    df = spark.createDataFrame([("q", question)], "question_id string, question string")
    if "root causes" in question:
        tools = ["query_delta_table", "search_knowledge_base"]
    assert assistant.route(df).first().tools == tools


SCORES = "service_name string, sla_breached boolean, is_anomaly boolean"


@pytest.mark.parametrize("breached, total, text", [
    (15, 100, C.ESCALATE_TEXT), (1499, 10_000, C.STANDARD_TEXT), (0, 0, C.STANDARD_TEXT),
])
def test_escalation_limit(spark, breached, total, text):
    df = spark.range(total).select(
        F.lit("s").alias("service_name"), (F.col("id") < breached).alias("sla_breached"),
        F.lit(False).alias("is_anomaly"))
    row = assistant.sla_status(df).first()
    assert (row.total_incidents, row.breached, row.escalation) == (total, breached, text)


def test_missing_flags_count_as_false(spark):
    df = spark.createDataFrame([("a", None, None), ("a", True, True), ("b", False, None)], SCORES)
    row = assistant.sla_status(df).first()
    assert (row.total_incidents, row.breached, row.sla_breach_rate) == (3, 1, 0.3333)
    assert [(s.service, s.rate) for s in row.top_anomaly_services] == [("a", 0.5), ("b", 0.0)]


@pytest.mark.parametrize("mode", ["keywords", "first_k"])
def test_assistant_sections_and_trace(spark, chunks, mode):
    scores = spark.createDataFrame(
        [("a", True, True), ("a", False, False), ("b", False, False), ("b", False, False)], SCORES)
    asked = spark.createDataFrame([
        ("q1", "Predict the SLA breach"), ("q2", "hello"), ("q3", "model accuracy?"),
        ("q4", "postmortem zzzzz")], "question_id string, question string")
    one = spark.createDataFrame([("a", 0.25)], "entity_id string, prediction double")
    perf = spark.createDataFrame([("m", 0.5)], "model_name string, precision double")
    rows = assistant.assist(asked, assistant.sla_status(scores), one, perf, chunks, 3, mode)
    got = {r.question_id: r for r in rows.collect()}
    assert [t.tool for t in got["q1"].tool_trace] == [
        "query_delta_table", "get_ml_prediction", "search_knowledge_base"]
    status = json.loads(got["q1"].tool_trace[0].output)
    assert status == {"total_incidents": 4, "breached": 1, "sla_breach_rate": 0.25,
                      "escalation": C.ESCALATE_TEXT,
                      "top_anomaly_services": [{"service": "a", "rate": 0.5},
                                               {"service": "b", "rate": 0.0}]}
    # Short words of the question count too, so three chunks are found either way.
    assert got["q1"].tool_trace[2].docs_returned == 3
    assert got["q1"].context.startswith(
        "\nSLA CONTEXT:\nTotal incidents: 4\nBreached: 1\nSLA breach rate: 25.00%\nEscalation: "
        + C.ESCALATE_TEXT + "\n\nTOP ANOMALY SERVICES:\n[('a', 0.5), ('b', 0.0)]\n"
        '\nPREDICTION: {"entity_id":"a","prediction":0.25}\nRAG CONTEXT:\n- ')
    assert (got["q2"].context, got["q2"].tool_trace) == ("", [])
    assert got["q3"].context == '\nMODEL CONTEXT: {"model_name":"m","precision":0.5}'
    if mode == "keywords":
        assert got["q4"].tool_trace[0].docs_returned == 0
        assert got["q4"].context == "\nRAG CONTEXT:\n"
    assert got["q2"].prompt == (
        C.ASSISTANT_HEAD + C.ASSISTANT_QUESTION + "hello" + C.ASSISTANT_TAIL)


def test_prediction_lookup_includes_both_days(spark):
    df = spark.sql("""
        SELECT 'a' AS service_name, timestamp_ntz'2024-01-01 00:00:00' AS timestamp,
               true AS is_anomaly, 2D AS risk_score
        UNION ALL SELECT 'a', timestamp_ntz'2024-01-02 23:59:59', false, 4D
        UNION ALL SELECT 'a', timestamp_ntz'2024-01-03 00:00:00', true, 9D
        UNION ALL SELECT 'b', timestamp_ntz'2024-01-01 00:00:00', true, 9D""")
    row = scoring_job.prediction_lookup(df, "a", "2024-01-01", "2024-01-02").first()
    assert (row.incidents, row.prediction, row.mean_score) == (2, 0.5, 3.0)
    none = scoring_job.prediction_lookup(df, "c", "2024-01-01", "2024-01-02").first()
    assert (none.incidents, none.prediction, none.mean_score) == (0, 0.0, None)
