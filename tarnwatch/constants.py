"""Numbers, word lists and texts that results depend on."""

# --- Time-series features ---------------------------------------------------
LAG_ROWS = {"lag_1d": 24, "lag_7d": 168, "lag_30d": 720}
FRAME_ROWS = {"7d": 168, "14d": 336, "30d": 720}
IMPUTED_COLUMNS = ["lag_1d", "lag_7d", "lag_30d", "rolling_mean_7d", "rolling_std_7d"]

# --- Detectors --------------------------------------------------------------
Z_THRESHOLD = 3.0
CONTAMINATION = 0.05
SEED = 42
ANOMALY_TYPE = "isolation_forest"
MODEL_NAME = "isolation_forest_v1"

# Seven features of the first detector.
BASE_FEATURES = [
    "resolution_time_mins",
    "severity",
    "lag_1d",
    "lag_7d",
    "rolling_mean_7d",
    "rolling_std_7d",
    "severity_x_resolution",
]

# Thirteen features of the batch scorer; tracking adds the z-score as a fourteenth.
BATCH_FEATURES = [
    "resolution_time_mins",
    "severity",
    "repeat_incident",
    "lag_1d",
    "lag_7d",
    "lag_30d",
    "rolling_mean_7d",
    "rolling_std_7d",
    "rolling_mean_14d",
    "rolling_std_14d",
    "rolling_mean_30d",
    "rolling_std_30d",
    "severity_x_resolution",
]
TRACKING_FEATURES = BATCH_FEATURES + ["z_score"]

# --- Monitoring and batch job -----------------------------------------------
ALERT_WINDOW_DAYS = 7
TRAFFIC_PERCENT = {"champion": 90, "challenger": 10}
ESCALATION_RATE = 0.15
ESCALATE_TEXT = "Escalate to L2 Engineering Immediately"
STANDARD_TEXT = "Standard Monitoring"
TOP_INCIDENTS = 20
TOP_SERVICES = 3

# --- Chunks and retrieval ---------------------------------------------------
CHUNK_SIZE = 300
CHUNK_OVERLAP = 50
RETRIEVE_K = 5
RERANK_K = 3
KNOWLEDGE_K = 3
KEYWORD_SETS = {
    "sla policy": ["sla", "breach", "escalation"],
    "runbook": ["incident", "runbook", "dependency"],
    "alert fatigue": ["alert", "noise", "false"],
}
SAMPLE_QUESTIONS = [
    "What is SLA escalation policy?",
    "How do we reduce alert fatigue?",
    "What does the runbook say about dependencies?",
    "What causes incidents?",
    "How are incidents resolved?",
]
NOT_FOUND = "Not found in documents"

# Prompt for one question; the two slots are the context blocks and the question.
PROMPT_HEAD = "\nAnswer the question using ONLY the context below.\n\nContext:\n"
PROMPT_QUESTION = "\n\nQuestion: "
PROMPT_TAIL = (
    "\n\nInstructions:\n"
    "- Cite sources like [doc_id-chunk_id]\n"
    "- If not found, say: Not found in documents\n"
)

# --- Question routing -------------------------------------------------------
ROUTES = {
    "query_delta_table": ["anomaly", "sla", "breach", "incident"],
    "get_ml_prediction": ["predict", "forecast"],
    "search_knowledge_base": [
        "policy", "runbook", "root cause", "postmortem", "escalation", "sla", "breach",
    ],
    "get_model_performance": ["model", "accuracy", "performance"],
}
ASSISTANT_QUESTIONS = [
    "Which services have highest anomaly rate and root causes?",
    "What is SLA breach rate and escalation policy at 15%?",
]
ASSISTANT_HEAD = (
    "\nYou are an enterprise-grade AI operations agent.\n\n"
    "RULES:\n"
    "- Use ONLY tool outputs\n"
    "- NEVER recompute numbers from context\n"
    "- If a value exists in tool output, copy it exactly\n"
    "- Do NOT perform math\n"
    "- If ranking is required, use computed tool values\n"
    '- If missing, say "Insufficient data in retrieved context"\n\n'
    "CONTEXT:\n"
)
ASSISTANT_QUESTION = "\n\nQUESTION:\n"
ASSISTANT_TAIL = "\n\nFORMAT:\nDirect Answer:\nSupporting Evidence:\nLimitations:\n"
