"""Declared schemas of the stored tables."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _fields(spec: dict) -> list[StructField]:
    return [StructField(name, kind) for name, kind in spec.items()]


RAW_OPERATIONS = StructType(_fields({
    "incident_id": StringType(),
    "timestamp": TimestampNTZType(),
    "service_name": StringType(),
    "severity": IntegerType(),
    "resolution_time_mins": DoubleType(),
    "sla_threshold_mins": IntegerType(),
    "region": StringType(),
    "team": StringType(),
    "root_cause": StringType(),
    "hour": IntegerType(),
    "sla_breached": BooleanType(),
    "is_anomaly": IntegerType(),
    "repeat_incident": IntegerType(),
}))

# The join on the service puts that column first, as a Spark `join(on=...)` does.
FEATURES_OPERATIONS = StructType(
    [RAW_OPERATIONS["service_name"]]
    + [f for f in RAW_OPERATIONS.fields if f.name != "service_name"]
    + _fields({
        "day_of_week": IntegerType(),
        "week_of_year": IntegerType(),
        "month": IntegerType(),
        "is_month_end": BooleanType(),
        "lag_1d": DoubleType(),
        "lag_7d": DoubleType(),
        "lag_30d": DoubleType(),
        "rolling_mean_7d": DoubleType(),
        "rolling_std_7d": DoubleType(),
        "rolling_mean_14d": DoubleType(),
        "rolling_std_14d": DoubleType(),
        "rolling_mean_30d": DoubleType(),
        "rolling_std_30d": DoubleType(),
        "total_resolution_time": DoubleType(),
        "severity_x_resolution": DoubleType(),
    })
)

# The planted 0/1 label moves to `label_anomaly`; `is_anomaly` is the verdict.
ANOMALY_SCORES = StructType(
    [f for f in FEATURES_OPERATIONS.fields if f.name != "is_anomaly"]
    + _fields({
        "label_anomaly": IntegerType(),
        "z_score": DoubleType(),
        "z_anomaly": IntegerType(),
        "anomaly_score": DoubleType(),
        "if_anomaly": IntegerType(),
        "risk_score": DoubleType(),
        "is_anomaly": BooleanType(),
        "anomaly_type": StringType(),
        "model_name": StringType(),
        "run_id": StringType(),
        "scored_at": TimestampType(),
    })
)

RAG_DOCUMENTS = StructType(_fields({
    "doc_id": StringType(),
    "doc_type": StringType(),
    "title": StringType(),
    "content": StringType(),
    "created_date": StringType(),
    "metadata": MapType(StringType(), StringType()),
}))

FOREST_NODES = StructType(_fields({
    "tree_id": IntegerType(),
    "node_id": IntegerType(),
    "feature": IntegerType(),
    "threshold": DoubleType(),
    "left": IntegerType(),
    "right": IntegerType(),
    "path_length": DoubleType(),
    "sample_size": IntegerType(),
}))

RUN_METRICS = StructType(_fields({
    "run_id": StringType(),
    "parent_run_id": StringType(),
    "model": StringType(),
    "kind": StringType(),
    "key": StringType(),
    "value": StringType(),
    "logged_at": TimestampType(),
}))

EMBEDDINGS = StructType(_fields({
    "vec_id": LongType(),
    "embedding": ArrayType(FloatType()),
    "label": IntegerType(),
}))
