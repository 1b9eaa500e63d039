"""The registered queries in DuckDB SQL, over views named like the input tables."""

from __future__ import annotations

from . import constants as C
from . import schemas
from .forest_sql import forest_ctes, verdict_ctes

INCIDENTS = """
base AS (
  SELECT *,
    CASE WHEN hour(ts) BETWEEN 9 AND 18 THEN (20 + value) * 1.2 ELSE 20 + value END AS rt,
    CASE WHEN (event_id * 31) % 10 = 0 THEN 1 WHEN (event_id * 31) % 10 <= 2 THEN 2
         WHEN (event_id * 31) % 10 <= 6 THEN 3 ELSE 4 END::INTEGER AS sev,
    CASE event_id % 3 WHEN 0 THEN 30 WHEN 1 THEN 60 ELSE 120 END::INTEGER AS sla,
    CASE user_id % 3 WHEN 0 THEN 'APAC' WHEN 1 THEN 'EMEA' ELSE 'NA' END AS region,
    CASE (user_id % 7) % 3 WHEN 0 THEN 'team_a' WHEN 1 THEN 'team_b' ELSE 'team_c' END AS team,
    CASE event_id % 4 WHEN 0 THEN 'dependency_failure' WHEN 1 THEN 'timeout'
         WHEN 2 THEN 'code_bug' ELSE 'infra_issue' END AS root_cause,
    CASE WHEN (event_id * 7919) % 100 < 5 THEN 1 ELSE 0 END::INTEGER AS inj,
    CASE WHEN (event_id * 13) % 5 = 0 THEN 1 ELSE 0 END::INTEGER AS rep
  FROM events),
incidents AS (
  SELECT 'INC_' || event_id AS incident_id, ts AS "timestamp", event_type AS service_name,
    sev AS severity, CASE WHEN inj = 1 THEN rt * 3 ELSE rt END AS resolution_time_mins,
    sla AS sla_threshold_mins, region, team, root_cause, hour(ts)::INTEGER AS hour,
    inj = 1 OR rt > sla AS sla_breached, inj AS is_anomaly, rep AS repeat_incident
  FROM base)"""

FLAGGED = INCIDENTS + """,
stats AS (
  SELECT service_name, avg(resolution_time_mins) AS m, stddev_pop(resolution_time_mins) AS s
  FROM incidents GROUP BY service_name),
zscored AS (
  SELECT i.*, (resolution_time_mins - m) / nullif(s, 0) AS z FROM incidents i
  JOIN stats USING (service_name)),
flagged AS (
  SELECT * EXCLUDE (is_anomaly), is_anomaly AS label_anomaly, z AS z_score,
    CASE WHEN abs(z) > 3 THEN 1 ELSE 0 END::INTEGER AS z_anomaly,
    coalesce(abs(z) > 3, false) AS is_anomaly, abs(z) AS risk_score
  FROM zscored)"""

_ORDER = 'PARTITION BY service_name ORDER BY "timestamp", incident_id'
_LAGS = ", ".join(
    f"lag(resolution_time_mins, {n}) OVER ({_ORDER}) AS {name}" for name, n in C.LAG_ROWS.items())
_ROLLING = ", ".join(
    f"{fn}(resolution_time_mins) OVER ({_ORDER} ROWS BETWEEN {n} PRECEDING AND CURRENT ROW) "
    f"AS rolling_{short}_{name}"
    for name, n in C.FRAME_ROWS.items()
    for short, fn in (("mean", "avg"), ("std", "stddev_samp")))
_ROLLING_NAMES = [f"rolling_{s}_{n}" for n in C.FRAME_ROWS for s in ("mean", "std")]


def _settled(names: list[str], prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{n} + 1e-8, 6) AS {n}" for n in names)


def _round(names: list[str], places: int) -> str:
    return ", ".join(f"round({n}, {places}) AS {n}" for n in names)


FEATURES = FLAGGED + f""",
history AS (SELECT *, {_LAGS}, {_ROLLING} FROM flagged),
features AS (
  SELECT * REPLACE ({", ".join(f"coalesce({c}, 0) AS {c}" for c in C.IMPUTED_COLUMNS)}),
    dayofweek("timestamp")::INTEGER + 1 AS day_of_week,
    weekofyear("timestamp")::INTEGER AS week_of_year, month("timestamp")::INTEGER AS month,
    "timestamp" = last_day("timestamp")::TIMESTAMP AS is_month_end,
    sum(resolution_time_mins) OVER (PARTITION BY service_name) AS total_resolution_time,
    severity * resolution_time_mins AS severity_x_resolution
  FROM history)"""


JUDGED = FEATURES + "," + verdict_ctes("features", C.BATCH_FEATURES, C.CONTAMINATION)


def _metrics(source: str, flag: str, truth: str, by: str = "") -> str:
    hit, real = f"{flag} = 1", f"{truth}::BOOLEAN"
    lead, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""
SELECT {lead}"rows", tp, fp, fn,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
FROM (SELECT {lead}count(*) AS "rows", count(*) FILTER ({hit} AND {real}) AS tp,
        count(*) FILTER ({hit} AND NOT {real}) AS fp,
        count(*) FILTER (NOT {hit} AND {real}) AS fn FROM {source}{tail})"""


def _with(ctes: str, query: str) -> str:
    return f"WITH {ctes.strip()}\n{query.strip()}"


# --- Text -----------------------------------------------------------------------

DOCUMENTS = """
docs AS (
  SELECT 'doc_' || doc_id AS doc_id, 'document' AS doc_type, 'Document ' || doc_id AS title,
    text AS content, '2024-02-01' AS created_date, source AS author FROM documents)"""

CORPUS = INCIDENTS + """,
docs AS (
  SELECT 'doc_' || doc_id AS doc_id, 'document' AS doc_type, 'Document ' || doc_id AS title,
    text AS content, '2024-02-01' AS created_date, source AS author FROM documents
  UNION ALL
  SELECT 'page_' || page_id, 'page', url, html, '2024-02-10', 'web' FROM pages
  UNION ALL
  SELECT 'conv_' || conv_id || '_' || turn, 'conversation', 'Conversation ' || conv_id, text,
    '2024-03-01', role FROM conversations
  UNION ALL
  SELECT 'pm_' || substr(incident_id, 5), 'postmortem',
    'Incident Postmortem ' || substr(incident_id, 5),
    chr(10) || 'Incident ' || substr(incident_id, 5) || ' hit the ' || service_name
    || ' service in ' || region || ' with severity ' || severity || '.' || chr(10)
    || 'The root cause was ' || replace(root_cause, '_', ' ') || '.' || chr(10)
    || 'It was resolved by ' || team || ' after ' || round(resolution_time_mins)::BIGINT
    || ' minutes; the SLA limit is ' || sla_threshold_mins || ' minutes.' || chr(10)
    || CASE WHEN sla_breached THEN
         'The breach went through escalation to the on-call lead under the runbook.'
       ELSE 'The limit was kept and no escalation was needed.' END || chr(10)
    || CASE WHEN repeat_incident = 1 THEN
         'A duplicate alert added noise for this service.' || chr(10) ELSE '' END,
    strftime("timestamp", '%Y-%m-%d'), team FROM incidents)"""


def _chunk_cte(source: str, name: str) -> str:
    step = C.CHUNK_SIZE - C.CHUNK_OVERLAP
    return f"""
{name} AS (
  SELECT doc_id, doc_type, s // {step} AS chunk_id,
    substring(content, s::BIGINT + 1, {C.CHUNK_SIZE}) AS text
  FROM (SELECT doc_id, doc_type, content, unnest(range(0, length(content), {step})) AS s
        FROM {source}))"""


def _keyed_cte(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT *, doc_id || '_' || chunk_id AS id, trim(lower(text)) AS text_clean FROM {source})"""


DOCUMENT_CHUNKS = DOCUMENTS + "," + _chunk_cte("docs", "cut") + "," + _keyed_cte("cut", "chunks")
CORPUS_CHUNKS = CORPUS + "," + _chunk_cte("docs", "cut") + "," + _keyed_cte("cut", "chunks")


def _words(text: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+'))"


BENCHMARK_QUESTIONS = f"""
questions AS (
  SELECT 'b' || item_id AS question_id, text AS question, {_words("text")} AS keywords
  FROM benchmark)"""


def _values(rows: list[tuple[str, str]]) -> str:
    quoted = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")"
                       for r in rows)
    return f"VALUES {quoted}"


_SAMPLES = [(f"q{i}", q) for i, q in enumerate(C.SAMPLE_QUESTIONS + C.ASSISTANT_QUESTIONS, 1)]
SAMPLE_QUESTIONS = f"""
questions AS (
  SELECT question_id, question, {_words("question")} AS keywords
  FROM ({_values(_SAMPLES)}) v(question_id, question))"""
ALL_QUESTIONS = f"""
asked AS (
  SELECT 'conv_' || conv_id || '_' || turn AS question_id, text AS question
  FROM conversations WHERE role = 'user'
  UNION ALL SELECT * FROM ({_values(_SAMPLES)}) v(question_id, question))"""


def _hits(k: int) -> str:
    return f"""
words AS (SELECT question_id, unnest(keywords) AS keyword FROM questions),
hits AS (
  SELECT question_id, id, score::INTEGER AS score, retrieval_rank::INTEGER AS retrieval_rank
  FROM (SELECT question_id, id, count(*) AS score,
          row_number() OVER (PARTITION BY question_id ORDER BY count(*) DESC, id)
            AS retrieval_rank
        FROM chunks JOIN words ON contains(text_clean, keyword) GROUP BY question_id, id)
  WHERE retrieval_rank <= {k})"""


RERANKED = _hits(C.RETRIEVE_K) + f""",
reranked AS (
  SELECT * FROM (
    SELECT h.*, c.doc_id, c.chunk_id, c.text, row_number() OVER (
        PARTITION BY question_id ORDER BY length(c.text) DESC, retrieval_rank)::INTEGER AS rank
    FROM hits h JOIN chunks c USING (id))
  WHERE rank <= {C.RERANK_K}),
grounded AS (
  SELECT question_id,
    string_agg('[Source: ' || doc_id || '-' || chunk_id || ']' || chr(10) || text,
               chr(10) || chr(10) ORDER BY rank) AS context,
    string_agg(doc_id || '-' || chunk_id, ', ' ORDER BY rank) AS sources,
    max(CASE WHEN rank = 1 THEN text || ' [source: ' || doc_id || '-' || chunk_id || ']' END)
      AS first
  FROM reranked GROUP BY question_id)"""

ANSWERS = f"""
SELECT question_id, question,
  coalesce(trim(regexp_replace(first, '\\s+', ' ', 'g')), '{C.NOT_FOUND}') AS answer,
  coalesce(sources, '') AS sources
FROM questions LEFT JOIN grounded USING (question_id)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _routes() -> str:
    cases = ", ".join(
        "CASE WHEN " + " OR ".join(f"contains(lower(question), '{w}')" for w in words)
        + f" THEN '{tool}' END" for tool, words in C.ROUTES.items())
    return f"""
routed AS (
  SELECT question_id, question, [t FOR t IN [{cases}] IF t IS NOT NULL] AS tools FROM asked)"""


STATUS = f"""
per_service AS (
  SELECT service_name, count(*) AS n, count(*) FILTER (sla_breached) AS b,
    count(*) FILTER (is_anomaly) / count(*) AS rate FROM flagged GROUP BY service_name),
leaders AS (
  SELECT service_name, rate FROM per_service ORDER BY rate DESC, service_name
  LIMIT {C.TOP_SERVICES}),
status AS (
  SELECT sum(n)::BIGINT AS total_incidents, sum(b)::BIGINT AS breached,
    round(sum(b) / sum(n), 4) AS sla_breach_rate,
    printf('%.2f%%', sum(b) / sum(n) * 100) AS breach_percent,
    CASE WHEN sum(b) / sum(n) >= {C.ESCALATION_RATE} THEN '{C.ESCALATE_TEXT}'
      ELSE '{C.STANDARD_TEXT}' END AS escalation,
    (SELECT '[' || string_agg('(''' || service_name || ''', ' || round(rate, 4) || ')', ', '
       ORDER BY rate DESC, service_name) || ']' FROM leaders) AS top_anomaly_services
  FROM per_service)"""


def _context(bullets: str) -> str:
    """No question at hand asks for a prediction or a model, so two sections suffice."""
    return f"""
contexts AS (
  SELECT question_id, question,
    CASE WHEN list_contains(tools, 'query_delta_table') THEN
      chr(10) || 'SLA CONTEXT:' || chr(10) || 'Total incidents: ' || total_incidents || chr(10)
      || 'Breached: ' || breached || chr(10) || 'SLA breach rate: ' || breach_percent || chr(10)
      || 'Escalation: ' || escalation || chr(10) || chr(10) || 'TOP ANOMALY SERVICES:' || chr(10)
      || top_anomaly_services || chr(10) ELSE '' END
    || CASE WHEN list_contains(tools, 'search_knowledge_base') THEN
      chr(10) || 'RAG CONTEXT:' || chr(10) || coalesce(bullets, '') ELSE '' END AS context
  FROM routed LEFT JOIN ({bullets}) USING (question_id), status)"""


_KB_QUESTIONS = f"""
questions AS (
  SELECT question_id, question, {_words("question")} AS keywords FROM routed
  WHERE list_contains(tools, 'search_knowledge_base'))"""
_BULLET = "string_agg('- ' || text || chr(10), ''"
_KB_KEYWORDS = (f"SELECT question_id, {_BULLET} ORDER BY retrieval_rank) AS bullets "
                "FROM hits JOIN chunks USING (id) GROUP BY question_id")
_KB_FIRST = (f"SELECT question_id, (SELECT {_BULLET} ORDER BY id) FROM (SELECT id, text FROM chunks "
             f"ORDER BY id LIMIT {C.KNOWLEDGE_K})) AS bullets FROM routed")
# CORPUS_CHUNKS starts with the incident tables, which FLAGGED has as well.
ASSIST_BASE = (FLAGGED + CORPUS_CHUNKS[len(INCIDENTS):] + "," + ALL_QUESTIONS + ","
               + _routes() + "," + STATUS)

_PROFILE = ["service_name", "severity", "region", "team", "root_cause"]
_DRIFT_NUMERIC = ["resolution_time_mins", "severity", "sla_threshold_mins", "repeat_incident"]
_DRIFT_CATEGORIES = ["service_name", "region", "team", "root_cause"]
_AS_OF = "TIMESTAMP '2024-01-24 00:00:00'"

ALERT_RATES = FLAGGED + f""",
rates AS (
  SELECT service_name,
    round(count(*) FILTER (abs(z) > 0.5 AND NOT sla_breached) / count(*), 6)
      AS alert_fatigue_rate
  FROM flagged WHERE "timestamp" >= {_AS_OF} GROUP BY service_name)"""

NEW_DELIVERY = DOCUMENT_CHUNKS + """,
edited AS (
  SELECT 'doc_' || doc_id AS doc_id, 'document' AS doc_type,
    CASE WHEN source = 'src1' THEN translate(text, '.', ';') ELSE text END AS content
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
  UNION ALL SELECT 'page_' || page_id, 'page', html FROM pages),""" + (
      _chunk_cte("edited", "cut2") + "," + _keyed_cte("cut2", "chunks2"))

TOOL_QUESTIONS = FLAGGED + "," + DOCUMENT_CHUNKS + "," + ALL_QUESTIONS.replace("asked AS", "users AS", 1) + """,
asked AS (
  SELECT * FROM users UNION ALL
  SELECT 'week_' || service_name || '_' || week, 'predict ' || service_name || ' from ' || week || ' to '
    || (week + 6) || ' and the performance of model z_score'
  FROM (SELECT DISTINCT service_name, date_trunc('week', "timestamp")::DATE AS week FROM flagged)),
""" + _routes() + "," + _KB_QUESTIONS + "," + _hits(C.KNOWLEDGE_K) + """,
named AS (
  SELECT question_id, tools, unnest(list_distinct(string_split_regex(lower(question), '[^\\p{L}\\p{N}_]+'))) AS word,
    [try_cast(d AS DATE) FOR d IN regexp_extract_all(question, '\\b([0-9]{4}-[0-9]{2}-[0-9]{2})\\b', 1)] AS days
  FROM routed),
predicted AS (
  SELECT question_id, s.service_name AS entity_id, count(f.incident_id) AS incidents,
    coalesce(count(*) FILTER (f.is_anomaly) / nullif(count(f.incident_id), 0), 0) AS prediction
  FROM named JOIN (SELECT DISTINCT service_name FROM flagged) s ON lower(s.service_name) = word
  LEFT JOIN flagged f ON f.service_name = s.service_name
    AND f."timestamp"::DATE >= coalesce(list_min(days), DATE '0001-01-01')
    AND f."timestamp"::DATE <= CASE WHEN len(list_distinct(days)) > 1 THEN list_max(days) ELSE DATE '9999-12-31' END
  WHERE list_contains(tools, 'get_ml_prediction') GROUP BY 1, 2)"""

TWICE = DOCUMENTS + "," + _chunk_cte("docs", "cut") + """,
twice AS (
  SELECT * FROM cut UNION ALL
  SELECT doc_id, doc_type, chunk_id, translate(text, chr(10), ' ') FROM cut)""" + (
      "," + _keyed_cte("twice", "chunks"))

PROFILES = """
profiles AS (
  SELECT label, list(m ORDER BY i) AS v FROM (
    SELECT label, i, avg(x::DOUBLE) AS m FROM (
      SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
      FROM embeddings)
    GROUP BY label, i)
  GROUP BY label)"""
KNN = f"""
SELECT query_id, vec_id, round(similarity, 6) AS similarity, rank FROM (
  SELECT label::BIGINT AS query_id, vec_id, similarity, row_number() OVER (
      PARTITION BY label ORDER BY similarity DESC, vec_id)::INTEGER AS rank
  FROM (SELECT p.label, e.vec_id, list_cosine_similarity(e.embedding::DOUBLE[], p.v) AS similarity
        FROM profiles p, embeddings e))
WHERE rank <= {C.RETRIEVE_K}"""


def _day(unit: str) -> str:
    return f"date_trunc('{unit}', \"timestamp\")::TIMESTAMP"


def _trend(unit: str) -> str:
    return _with(FLAGGED, f"""SELECT {_day(unit)} AS date, count(*) AS anomaly_count
FROM flagged WHERE is_anomaly GROUP BY 1 ORDER BY 1""")


def _volume(unit: str, source: str = "incidents", where: str = "") -> str:
    return f"""SELECT {_day(unit)} AS date, count(*) AS incidents FROM {source} {where}
GROUP BY 1 ORDER BY 1"""


_LAG_ROUND = _round(list(C.LAG_ROWS), 4)

_CELLS = INCIDENTS + f""",
counts AS (
  SELECT feature, category, count(*) FILTER (old) AS b, count(*) FILTER (NOT old) AS c
  FROM (SELECT "timestamp" < {_AS_OF} AS old, unnest([{", ".join(_quoted(c) for c in _DRIFT_CATEGORIES)}])
          AS feature, unnest([{", ".join(_DRIFT_CATEGORIES)}]) AS category FROM incidents)
  GROUP BY feature, category),
totals AS (
  SELECT feature, sum(b) AS tb, sum(c) AS tc, count(*) AS k FROM counts GROUP BY feature),
cells AS (
  SELECT feature, k, b, c, (b + c) * tb / (tb + tc) AS eb, (b + c) * tc / (tb + tc) AS ec
  FROM counts JOIN totals USING (feature))"""

_NUMERIC_DRIFT = f"""FROM (
  SELECT feature, count(v) FILTER (old) AS bn, count(v) FILTER (NOT old) AS cn,
    avg(v) FILTER (old) AS bm, avg(v) FILTER (NOT old) AS cm,
    var_samp(v) FILTER (old) AS bv, var_samp(v) FILTER (NOT old) AS cv
  FROM (SELECT "timestamp" < {_AS_OF} AS old, unnest([{", ".join(_quoted(c) for c in _DRIFT_NUMERIC)}])
          AS feature, unnest([{", ".join(c + "::DOUBLE" for c in _DRIFT_NUMERIC)}]) AS v
        FROM incidents)
  GROUP BY feature)"""



def _schema_rows() -> str:
    """The columns of the feature table against those declared for scores, as SQL rows."""
    wanted, actual = ({f.name: f.dataType.simpleString() for f in s.fields}
                      for s in (schemas.ANOMALY_SCORES, schemas.FEATURES_OPERATIONS))

    def row(name: str) -> str:
        want, have = wanted.get(name), actual.get(name)
        status = ("missing" if have is None else "extra" if want is None
                  else "ok" if want == have else "changed")
        cells = ("NULL" if v is None else f"'{v}'" for v in (name, want, have, status))
        return f"({', '.join(cells)})"

    return ", ".join(map(row, sorted(wanted | actual)))


ORACLE_SQL: dict[str, str] = {
    "incidents": _with(INCIDENTS, """
SELECT * REPLACE (round(resolution_time_mins, 4) AS resolution_time_mins) FROM incidents"""),
    "exact_fraction_pick": """
SELECT event_id, CASE WHEN row_number() OVER (ORDER BY draw, event_id)
    <= floor(0.05 * count(*) OVER ()) THEN 1 ELSE 0 END::INTEGER AS picked
FROM (SELECT event_id, ('0x' || substr(md5('42|' || event_id), 1, 12))::BIGINT AS draw
      FROM events)""",
    "planted_incidents": _with("""
picked AS (
  SELECT * EXCLUDE (draw), CASE WHEN row_number() OVER (ORDER BY draw, event_id)
      <= floor(0.05 * count(*) OVER ()) THEN 1 ELSE 0 END AS inj,
    CASE WHEN hour(ts) BETWEEN 9 AND 18 THEN (20 + value) * 1.2 ELSE 20 + value END AS rt,
    CASE event_id % 3 WHEN 0 THEN 30 WHEN 1 THEN 60 ELSE 120 END AS sla
  FROM (SELECT *, ('0x' || substr(md5('42|' || event_id), 1, 12))::BIGINT AS draw FROM events))
""", """
SELECT event_type AS service_name, count(*) AS incidents, sum(inj)::BIGINT AS planted,
  count(*) FILTER (inj = 1 OR rt > sla) AS breached,
  round(sum(CASE WHEN inj = 1 THEN rt * 3 ELSE rt END), 2) AS minutes
FROM picked GROUP BY event_type"""),
    "calendar_features": _with(FEATURES, """
SELECT incident_id, day_of_week, week_of_year, month FROM features"""),
    "month_end_flag": """
SELECT o_orderkey, o_orderdate = last_day(o_orderdate)::TIMESTAMP AS is_month_end,
  o_orderdate::DATE = last_day(o_orderdate) AS is_month_end_day FROM orders""",
    "lag_features": _with(INCIDENTS, f"""
SELECT incident_id, service_name, {_LAG_ROUND} FROM (SELECT *, {_LAGS} FROM incidents)"""),
    "rolling_features": _with(INCIDENTS, f"""
SELECT incident_id, service_name, {_settled(_ROLLING_NAMES)}
FROM (SELECT *, {_ROLLING} FROM incidents)"""),
    "sharded_history": _with(INCIDENTS, f"""
SELECT incident_id, service_name, {_LAG_ROUND}, {_settled(_ROLLING_NAMES)}
FROM (SELECT *, {_LAGS}, {_ROLLING} FROM incidents)"""),
    "time_rolling": _with(INCIDENTS + """,
hourly AS (
  SELECT service_name, floor(epoch("timestamp") / 3600)::BIGINT AS epoch_hour,
    sum(resolution_time_mins) AS s, count(*) AS n FROM incidents GROUP BY 1, 2)""", """
SELECT service_name, epoch_hour, """ + ", ".join(f"""round(
    sum(s) OVER (w RANGE BETWEEN {24 * d - 1} PRECEDING AND CURRENT ROW)
    / sum(n) OVER (w RANGE BETWEEN {24 * d - 1} PRECEDING AND CURRENT ROW) + 1e-8, 6)
    AS trailing_mean_{d}d""" for d in (7, 14, 30)) + """
FROM hourly WINDOW w AS (PARTITION BY service_name ORDER BY epoch_hour)"""),
    "service_total_join": _with(INCIDENTS, """
SELECT service_name, incident_id, round(sum(resolution_time_mins)
    OVER (PARTITION BY service_name), 2) AS total_resolution_time FROM incidents"""),
    "feature_table": _with(FEATURES, f"""
SELECT service_name, incident_id, "timestamp", severity,
  round(resolution_time_mins, 4) AS resolution_time_mins, sla_threshold_mins, region, team,
  root_cause, hour, sla_breached, label_anomaly AS is_anomaly, repeat_incident, day_of_week,
  week_of_year, month, is_month_end, {_LAG_ROUND}, {_settled(_ROLLING_NAMES)},
  round(total_resolution_time, 2) AS total_resolution_time,
  round(severity_x_resolution, 4) AS severity_x_resolution FROM features"""),
    "feature_vectors": _with(FEATURES, f"""
SELECT incident_id, round(resolution_time_mins, 4) AS resolution_time_mins,
  severity::DOUBLE AS severity, repeat_incident::DOUBLE AS repeat_incident, {_LAG_ROUND},
  {", ".join(f"round(coalesce({n}, 0) + 1e-8, 6) AS {n}" for n in _ROLLING_NAMES)},
  round(severity_x_resolution, 4) AS severity_x_resolution,
  round(coalesce(z_score, 0) + 1e-8, 6) AS z_score FROM features"""),
    "zscore_flags": _with(FLAGGED, """
SELECT incident_id, service_name, round(z_score, 6) AS z_score, z_anomaly FROM flagged"""),
    "zscore_metrics": _with(FLAGGED, _metrics("flagged", "z_anomaly", "sla_breached")),
    "zscore_metrics_vs_label": _with(
        FLAGGED, _metrics("flagged", "z_anomaly", "label_anomaly", "service_name")),
    "contamination_cutoff": _with(FLAGGED, """
SELECT service_name, round(q, 6) AS cutoff, count(*) FILTER (abs(z) > q) AS flagged
FROM flagged, (SELECT quantile_cont(abs(z), 0.95) AS q FROM flagged) GROUP BY service_name, q"""),
    "forest_verdict_share": """
SELECT count(*) AS "rows", ceil((count(*) - 1) * 0.05)::BIGINT AS flagged FROM events""",
    "isolation_forest_scores": _with(JUDGED, f"""
SELECT incident_id, service_name, round(anomaly_score, 6) AS anomaly_score, round(risk_score, 6) AS risk_score,
  if_anomaly, if_anomaly = 1 AS is_anomaly, '{C.ANOMALY_TYPE}' AS anomaly_type, '{C.MODEL_NAME}' AS model_name FROM judged"""),
    "detector_comparison": _with(JUDGED, f"""
SELECT *, CASE WHEN place = 1 THEN 'champion' ELSE 'challenger' END AS role
FROM (SELECT *, row_number() OVER (ORDER BY recall DESC, f1 DESC, model)::INTEGER AS place
  FROM (SELECT 'isolation_forest' AS model, * FROM ({_metrics("judged", "if_anomaly", "sla_breached")})
    UNION ALL SELECT 'z_score_baseline', * FROM ({_metrics("judged", "z_anomaly", "sla_breached")})))"""),
    "tracked_runs": _with(FEATURES + "," + verdict_ctes("features", C.TRACKING_FEATURES, C.CONTAMINATION), """
SELECT 'anomaly_detection_parent' AS run_id, NULL::VARCHAR AS parent_run_id, '' AS model, 'tag' AS kind,
  unnest(['domain', 'version']) AS key, unnest(['operations', '1.0']) AS value """ + "".join(f"""
UNION ALL SELECT '{run}', 'anomaly_detection_parent', '{run}', unnest({['param'] * len(params) + ['metric'] * 3}),
  unnest({[*params, 'precision', 'recall', 'f1']}), unnest([{", ".join(f"'{v}'" for v in params.values())},
    coalesce(tp / nullif(tp + fp, 0), 0)::VARCHAR, coalesce(tp / nullif(tp + fn, 0), 0)::VARCHAR,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)::VARCHAR])
FROM (SELECT tp, fp, fn FROM ({_metrics("judged", flag, "sla_breached")}))""" for run, flag, params in (
        ("z_score_model", "z_anomaly", {"method": "z_score"}),
        ("isolation_forest", "if_anomaly", {"model": "IsolationForest", "contamination": str(C.CONTAMINATION)})))),
    "score_batch": _with(FEATURES + """,
day AS (SELECT * FROM features WHERE "timestamp"::DATE = DATE '2024-01-15'),
day_stats AS (
  SELECT service_name, avg(resolution_time_mins) AS m, stddev_pop(resolution_time_mins) AS s FROM day GROUP BY 1),
day_features AS (
  SELECT day.* REPLACE ((resolution_time_mins - m) / nullif(s, 0) AS z_score,
    CASE WHEN abs((resolution_time_mins - m) / nullif(s, 0)) > 3 THEN 1 ELSE 0 END::INTEGER AS z_anomaly)
  FROM day JOIN day_stats USING (service_name)),""" + verdict_ctes(
        "day_features", C.BATCH_FEATURES, C.CONTAMINATION), f"""
SELECT service_name, incident_id, "timestamp", severity, round(resolution_time_mins, 4) AS resolution_time_mins,
  sla_threshold_mins, region, team, root_cause, hour, sla_breached, repeat_incident, day_of_week, week_of_year, month,
  is_month_end, {_LAG_ROUND}, {_settled(_ROLLING_NAMES)}, round(total_resolution_time, 2) AS total_resolution_time,
  round(severity_x_resolution, 4) AS severity_x_resolution, label_anomaly, round(z_score, 6) AS z_score, z_anomaly,
  round(anomaly_score, 6) AS anomaly_score, if_anomaly, round(risk_score, 6) AS risk_score, if_anomaly = 1 AS is_anomaly,
  '{C.ANOMALY_TYPE}' AS anomaly_type, '{C.MODEL_NAME}' AS model_name, 'batch' AS run_id FROM judged"""),
    "saved_model_scores": _with(FEATURES + "," + verdict_ctes(
        "features", C.BATCH_FEATURES, C.CONTAMINATION, '"timestamp" < TIMESTAMP \'2024-01-24\'',
        '"timestamp" >= TIMESTAMP \'2024-01-24\''), """
SELECT incident_id, service_name, round(anomaly_score, 6) AS anomaly_score, if_anomaly FROM judged"""),
    "aliased_model_scores": _with(FEATURES + "," + forest_ctes(
        "features", C.BATCH_FEATURES, '"timestamp" < TIMESTAMP \'2024-01-24\'', '"timestamp" >= TIMESTAMP \'2024-01-24\''), f"""
SELECT alias, incident_id, round(raw - q, 6) AS anomaly_score, CASE WHEN raw - q < 0 THEN 1 ELSE 0 END::INTEGER AS if_anomaly
FROM forest_raw JOIN forest_rows USING (incident_id), (
  SELECT unnest(['champion', 'challenger']) AS alias, unnest([quantile_cont(raw, {C.CONTAMINATION}), quantile_cont(raw, {2 * C.CONTAMINATION})]) AS q
  FROM forest_raw JOIN forest_rows USING (incident_id) WHERE fitted)
WHERE NOT fitted"""),
    "rule_comparison": _with(FLAGGED, f"""
SELECT * REPLACE (recall AS recall), CASE WHEN row_number() OVER
    (ORDER BY recall DESC, f1 DESC, model) = 1 THEN 'champion' ELSE 'challenger' END AS role,
  row_number() OVER (ORDER BY recall DESC, f1 DESC, model)::INTEGER AS place
FROM (SELECT 'z_score' AS model, * FROM ({_metrics("flagged", "z_anomaly", "sla_breached")})
  UNION ALL
  SELECT 'planted', * FROM ({_metrics("flagged", "label_anomaly", "sla_breached")}))"""),
    "arm_split_metrics": _with(FLAGGED + """,
arms AS (
  SELECT *, CASE WHEN ('0x' || substr(md5(incident_id), 1, 8))::BIGINT % 100 < 90
    THEN 'champion' ELSE 'challenger' END AS arm FROM flagged)""",
        _metrics("arms", "z_anomaly", "sla_breached", "arm")),
    "run_metrics": _with(FLAGGED, f"""
SELECT 'run-z' AS run_id, 'run-parent' AS parent_run_id, 'z_score_baseline' AS model, kind, key,
  value, TIMESTAMP '2024-01-31 00:00:00' AS logged_at
FROM (SELECT unnest(['param', 'metric', 'metric', 'metric']) AS kind,
        unnest(['method', 'precision', 'recall', 'f1']) AS key,
        unnest(['z_score', "precision"::VARCHAR, recall::VARCHAR, f1::VARCHAR]) AS value
      FROM ({_metrics("flagged", "z_anomaly", "sla_breached")}))"""),
    "latest_run_metrics": _with(FLAGGED + """,
weekly AS (SELECT *, date_trunc('week', "timestamp")::DATE AS week FROM flagged),
last_week AS (SELECT * FROM weekly WHERE week = (SELECT max(week) FROM weekly))""", f"""
SELECT 'week-' || (SELECT max(week) FROM weekly) AS run_id, 'z_score' AS model, unnest(['precision', 'recall', 'f1']) AS key,
  unnest(["precision"::VARCHAR, recall::VARCHAR, f1::VARCHAR]) AS value
FROM ({_metrics("last_week", "z_anomaly", "sla_breached")})"""),
    "replaced_table": _with(INCIDENTS, """
SELECT service_name, count(*) AS incidents, true AS listed, true AS dropped FROM incidents GROUP BY 1"""),
    "schema_report": f"""
SELECT t.*, n AS "rows" FROM (VALUES {_schema_rows()}) t("column", declared, actual, status),
  (SELECT count(*) AS n FROM events)""",
    "null_report": _with(FEATURES, """
SELECT "column", nulls, "rows" FROM (
  SELECT unnest(['resolution_time_mins', 'lag_30d', 'rolling_std_14d', 'rolling_std_30d'])
    AS "column",
    unnest([count(*) FILTER (resolution_time_mins IS NULL), count(*) FILTER (lag_30d IS NULL),
      count(*) FILTER (rolling_std_14d IS NULL), count(*) FILTER (rolling_std_30d IS NULL)])
    AS nulls, count(*) AS "rows" FROM features)"""),
    "score_batch_days": _with(FLAGGED, """
SELECT "timestamp"::DATE::VARCHAR AS day, count(*) AS incidents, sum(label_anomaly)::BIGINT AS planted
FROM flagged GROUP BY 1"""),
    "model_performance": _with(
        FLAGGED + """,
own AS (SELECT * FROM flagged WHERE service_name <> 'error')""",
        'SELECT \'z_other\' AS model_name, "precision", recall, f1, '
        '(SELECT max("timestamp") FROM own) AS last_updated FROM ('
        + _metrics("own", "z_anomaly", "sla_breached") + ")"),
    "alert_fatigue": _with(ALERT_RATES, "SELECT * FROM rates"),
    "alert_triggers": _with(ALERT_RATES, "SELECT * FROM rates WHERE alert_fatigue_rate > 0.12"),
    "numeric_drift": _with(INCIDENTS, f"""
SELECT feature, bn AS baseline_n, cn AS current_n, round(bm + 1e-8, 6) AS baseline_mean,
  round(cm + 1e-8, 6) AS current_mean, round(bv, 4) AS baseline_var, round(cv, 4) AS current_var,
  round((cm - bm) / sqrt(bv / bn + cv / cn), 4) AS z, round(cv / bv, 4) AS variance_ratio,
  abs((cm - bm) / sqrt(bv / bn + cv / cn)) > 3 AS drifted
{_NUMERIC_DRIFT}"""),
    "categorical_drift": _with(_CELLS, """
SELECT feature, round(sum((b - eb) ** 2 / eb + (c - ec) ** 2 / ec), 4) AS chi2,
  (max(k) - 1)::BIGINT AS dof FROM cells GROUP BY feature"""),
    "drift_significance": _with(_CELLS + f""",
statistics AS (
  SELECT feature, 'chi-square' AS test, sum((b - eb) ** 2 / eb + (c - ec) ** 2 / ec) AS x,
    (max(k) - 1)::DOUBLE AS dof FROM cells GROUP BY feature
  UNION ALL
  SELECT feature, 'z', (cm - bm) ** 2 / (bv / bn + cv / cn), 1
  {_NUMERIC_DRIFT}),
series AS (
  SELECT feature, test, x, CASE WHEN x > 0 AND dof > 0 THEN list_sum(list_transform(range(0, 400 + x::BIGINT),
    lambda j: exp((dof / 2 + j) * ln(x / 2) - x / 2 - lgamma(dof / 2 + j + 1)))) ELSE 0 END AS lower FROM statistics)""",
        "SELECT feature, test, round(1 - lower, 6) + 0 AS p_value FROM series"),
    "quality_profile": _with(INCIDENTS, f"""
SELECT dimension, value, count(*) AS "rows" FROM (
  SELECT unnest([{", ".join(_quoted(c) for c in _PROFILE)}]) AS dimension,
    unnest([{", ".join(c + "::VARCHAR" for c in _PROFILE)}]) AS value FROM incidents)
GROUP BY dimension, value"""),
    "incident_checks": _with(INCIDENTS, """
SELECT count(*) AS total_incidents, sum(is_anomaly)::BIGINT AS planted,
  count(*) FILTER (sla_breached) AS breached,
  count(*) FILTER (is_anomaly = 0 AND sla_breached <> (resolution_time_mins > sla_threshold_mins))
    AS rule_mismatches FROM incidents"""),
    "anomalies_by_service": _with(FLAGGED, """
SELECT service_name, count(*) AS anomaly_count FROM flagged WHERE is_anomaly
GROUP BY service_name ORDER BY anomaly_count DESC, service_name"""),
    "anomaly_trend_daily": _trend("day"),
    "anomaly_trend_hourly": _trend("hour"),
    "resolution_by_team": _with(FLAGGED, """
SELECT team, round(avg(resolution_time_mins) + 1e-8, 6) AS avg_resolution_time FROM flagged
GROUP BY team ORDER BY avg_resolution_time DESC, team"""),
    "top_incidents": _with(FLAGGED, f"""
SELECT incident_id, service_name, "timestamp", severity,
  round(resolution_time_mins, 4) AS resolution_time_mins, round(risk_score, 4) AS risk_score,
  team, root_cause, sla_breached
FROM (SELECT * FROM flagged WHERE is_anomaly ORDER BY risk_score DESC, incident_id
      LIMIT {C.TOP_INCIDENTS})"""),
    "sla_breach_rate": _with(FLAGGED, """
SELECT count(*) AS total_incidents, count(*) FILTER (sla_breached) AS breached_incidents,
  round(count(*) FILTER (sla_breached) * 100.0 / count(*), 2)::DOUBLE AS breach_rate_percent
FROM flagged"""),
    "incident_volume_daily": _with(INCIDENTS, _volume("day")),
    "incident_volume_weekly": _with(INCIDENTS, _volume("week")),
    "breach_rate_by_service": _with(INCIDENTS, """
SELECT service_name, count(*) AS incidents, count(*) FILTER (sla_breached) AS breached,
  round(count(*) FILTER (sla_breached) / count(*), 6) AS breach_rate FROM incidents
GROUP BY service_name ORDER BY breach_rate DESC, service_name"""),
    "severity_breakdown": _with(INCIDENTS, """
SELECT severity, count(*) AS incidents,
  round(count(*) / (SELECT count(*) FROM incidents), 6) AS share FROM incidents
GROUP BY severity ORDER BY severity"""),
    "score_histogram": _with(FLAGGED, """
SELECT floor(risk_score / 0.25)::BIGINT AS bin, count(*) AS incidents,
  floor(risk_score / 0.25) * 0.25 AS bin_start FROM flagged WHERE risk_score IS NOT NULL
GROUP BY floor(risk_score / 0.25) ORDER BY 1"""),
    "dashboard_filters": _with(FLAGGED, _volume("day", "flagged", """
WHERE "timestamp" >= TIMESTAMP '2024-01-08' AND "timestamp" < TIMESTAMP '2024-01-22'
  AND service_name IN ('error', 'purchase')""")),
    "anomaly_rate_by_service": _with(FLAGGED, """
SELECT service_name, round(count(*) FILTER (is_anomaly) / count(*), 6) AS anomaly_rate
FROM flagged GROUP BY service_name"""),
    "table_predicate": _with(INCIDENTS, """
SELECT incident_id, service_name, severity, sla_breached FROM incidents
WHERE severity = 1 AND sla_breached"""),
    "preview_ordered": _with(INCIDENTS, """
SELECT incident_id, "timestamp", service_name, severity FROM incidents
ORDER BY "timestamp", incident_id LIMIT 10"""),
    "corpus_union": _with(CORPUS, """
SELECT doc_id, doc_type, title, created_date, author, length(content) AS length,
  md5(content) AS digest FROM docs"""),
    "documents_by_type": _with(CORPUS, """
SELECT doc_type, count(*) AS documents FROM docs GROUP BY doc_type"""),
    "chunks": _with(CORPUS_CHUNKS, "SELECT doc_id, chunk_id, doc_type, text FROM chunks"),
    "chunk_duplicates": _with(TWICE, """
SELECT id, count(*) AS count FROM chunks GROUP BY id HAVING count(*) > 1"""),
    "chunks_indexed": _with(TWICE, """
SELECT id, doc_id, chunk_id, doc_type, text, text_clean FROM chunks
QUALIFY row_number() OVER (PARTITION BY id ORDER BY text) = 1"""),
    "index_job": _with(TWICE + """,
keys AS (SELECT id, count(*) AS n FROM chunks GROUP BY id)""", """
SELECT 'delivered' AS stage, sum(n)::BIGINT AS "rows", (count(*) FILTER (n > 1))::BIGINT AS duplicate_keys FROM keys
UNION ALL SELECT 'indexed', count(*), 0::BIGINT FROM keys"""),
    "chunk_snapshot_diff": _with(NEW_DELIVERY, """
SELECT * FROM (
  SELECT coalesce(a.id, b.id) AS id, md5(a.text) AS old_digest, md5(b.text) AS new_digest,
    CASE WHEN a.id IS NULL THEN 'insert' WHEN b.id IS NULL THEN 'delete'
      WHEN md5(a.text) <> md5(b.text) THEN 'update' END AS change
  FROM chunks a FULL OUTER JOIN chunks2 b ON a.id = b.id)
WHERE change IS NOT NULL"""),
    "updated_chunks": _with(NEW_DELIVERY, "SELECT id, doc_type, md5(text) AS digest FROM chunks2"),
    "keyword_hits": _with(CORPUS_CHUNKS, """
SELECT * FROM (
  SELECT id, (contains(text_clean, 'sla')::INTEGER + contains(text_clean, 'breach')::INTEGER
    + contains(text_clean, 'escalation')::INTEGER)::INTEGER AS score FROM chunks)
WHERE score > 0 ORDER BY score DESC, id"""),
    "keyword_hits_sets": _with(CORPUS_CHUNKS + f""",
questions(question_id, keyword) AS (
  {_values([(name, w) for name, words in C.KEYWORD_SETS.items() for w in words])})""", """
SELECT question_id, score, count(*) AS chunks FROM (
  SELECT question_id, id, count(*) AS score FROM chunks JOIN questions
    ON contains(text_clean, keyword) GROUP BY question_id, id)
GROUP BY question_id, score"""),
    "keyword_hits_batch": _with(
        DOCUMENT_CHUNKS + "," + BENCHMARK_QUESTIONS + "," + _hits(C.RETRIEVE_K),
        "SELECT question_id, retrieval_rank, id, score FROM hits"),
    "knn_topk": _with(PROFILES, KNN),
    "knn_topk_by_cell": _with(PROFILES, KNN),
    "vector_index_recall": f"""
SELECT count(*) AS queries, count(*) * least({C.RETRIEVE_K}, (SELECT count(*) FROM embeddings)) AS wanted, true AS reached
FROM embeddings WHERE vec_id % 20 = 0""",
    "rerank_length": _with(CORPUS_CHUNKS + "," + SAMPLE_QUESTIONS + "," + RERANKED, """
SELECT question_id, id, retrieval_rank, rank FROM reranked"""),
    "prompts": _with(CORPUS_CHUNKS + "," + SAMPLE_QUESTIONS + "," + RERANKED, f"""
SELECT question_id, {_quoted(C.PROMPT_HEAD)} || context || {_quoted(C.PROMPT_QUESTION)} || question
  || {_quoted(C.PROMPT_TAIL)} AS prompt FROM questions JOIN grounded USING (question_id)"""),
    "cited_answers": _with(CORPUS_CHUNKS + "," + SAMPLE_QUESTIONS + "," + RERANKED, ANSWERS),
    "cited_answers_batch": _with(
        DOCUMENT_CHUNKS + "," + BENCHMARK_QUESTIONS + "," + RERANKED, ANSWERS),
    "question_routes": _with(ALL_QUESTIONS + "," + _routes(), """
SELECT question_id, array_to_string(tools, ',') AS tools FROM routed"""),
    "sla_status": _with(FLAGGED + "," + STATUS, """
SELECT total_incidents, breached, sla_breach_rate, breach_percent, escalation,
  top_anomaly_services FROM status"""),
    "knowledge_lookup": _with(
        CORPUS_CHUNKS + "," + SAMPLE_QUESTIONS + "," + _hits(C.KNOWLEDGE_K), f"""
SELECT question_id, {_BULLET} ORDER BY retrieval_rank) AS bullets,
  count(*)::INTEGER AS docs_returned
FROM hits JOIN chunks USING (id) GROUP BY question_id"""),
    "prediction_lookup": _with(FLAGGED, """
SELECT 'error' AS entity_id, '2024-01-01' AS start_date, '2024-01-15' AS end_date,
  count(*) AS incidents, round(count(*) FILTER (is_anomaly) / count(*), 6) AS prediction,
  round(avg(risk_score), 6) AS mean_score FROM flagged
WHERE service_name = 'error' AND "timestamp" >= TIMESTAMP '2024-01-01'
  AND "timestamp" < TIMESTAMP '2024-01-16'"""),
    "assistant_context": _with(
        ASSIST_BASE + "," + _KB_QUESTIONS + "," + _hits(C.KNOWLEDGE_K) + ","
        + _context(_KB_KEYWORDS), f"""
SELECT question_id, context, {_quoted(C.ASSISTANT_HEAD)} || context
  || {_quoted(C.ASSISTANT_QUESTION)} || question || {_quoted(C.ASSISTANT_TAIL)} AS prompt
FROM contexts"""),
    "assistant_trace": _with(
        ASSIST_BASE + "," + _KB_QUESTIONS + "," + _hits(C.KNOWLEDGE_K), """
SELECT question_id, '[' || array_to_string([t FOR t IN [
    CASE WHEN list_contains(tools, 'query_delta_table') THEN
      '{"tool":"query_delta_table","output":' || to_json('{"total_incidents":' || total_incidents
        || ',"breached":' || breached || ',"sla_breach_rate":' || sla_breach_rate
        || ',"escalation":"' || escalation || '","top_anomaly_services":['
        || (SELECT string_agg('{"service":"' || service_name || '","rate":' || round(rate, 4)
              || '}', ',' ORDER BY rate DESC, service_name) FROM leaders) || ']}') || '}' END,
    CASE WHEN list_contains(tools, 'search_knowledge_base') THEN
      '{"tool":"search_knowledge_base","docs_returned":' || coalesce(docs, 0) || '}' END
  ] IF t IS NOT NULL], ',') || ']' AS trace
FROM routed LEFT JOIN (SELECT question_id, count(*) AS docs FROM hits GROUP BY question_id)
  USING (question_id), status"""),
    "assistant_tools": _with(TOOL_QUESTIONS, f"""
SELECT question_id, 'query_delta_table' AS tool, NULL::VARCHAR AS entity_id, (SELECT count(*) FROM flagged) AS incidents,
  NULL::DOUBLE AS prediction, NULL::BIGINT AS docs_returned, NULL::DOUBLE AS f1
FROM routed WHERE list_contains(tools, 'query_delta_table')
UNION ALL SELECT question_id, 'get_ml_prediction', entity_id, incidents, round(prediction, 6), NULL, NULL FROM predicted
UNION ALL SELECT q.question_id, 'search_knowledge_base', NULL, NULL, NULL, count(h.id), NULL
FROM questions q LEFT JOIN hits h USING (question_id) GROUP BY 1
UNION ALL SELECT question_id, 'get_model_performance', 'z_score', NULL, NULL, NULL, (SELECT f1 FROM ({_metrics("flagged", "z_anomaly", "sla_breached")}))
FROM named WHERE word = 'z_score' AND list_contains(tools, 'get_model_performance')"""),
    "assistant_context_first_k": _with(ASSIST_BASE + "," + _context(_KB_FIRST), """
SELECT question_id, context FROM contexts"""),
}
ORACLE_SQL["features_of_a_day"] = f"""
SELECT * FROM ({ORACLE_SQL["feature_table"]}) WHERE "timestamp"::DATE = DATE '2024-01-15'"""
