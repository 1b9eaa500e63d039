import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tarnwatch import schemas
from tarnwatch.operators import monitoring
from tarnwatch.plans import reports
from tarnwatch.sources import tables
from tarnwatch.sources.incidents import incidents_from_events

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def incidents(spark):
    return incidents_from_events(spark.read.parquet(EVENTS))


def test_partitioned_table_round_trip(spark, incidents, tmp_path):
    path = str(tmp_path / "t")
    tables.save_table(incidents, "raw_operations", partition_by=("service_name",), path=path)
    assert spark.table("raw_operations").count() == 1000
    folders = [f for f in os.listdir(path) if f.startswith("service_name=")]
    assert len(folders) == 5
    assert all(len([f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]) == 1
               for d in folders)
    assert "raw_operations" in [r.tableName for r in tables.list_tables(spark).collect()]
    one = tables.query_table(spark, "raw_operations", "service_name = 'error' AND severity = 1")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service_name" in plan
    assert "EqualTo(severity,1)" in plan
    tables.drop_table(spark, "raw_operations")
    tables.drop_table(spark, "raw_operations")
    assert not spark.catalog.tableExists("raw_operations")


def test_overwrite_replaces_the_schema(spark):
    tables.save_table(spark.range(3), "rag_chunks")
    tables.save_table(spark.range(2).withColumn("extra", F.lit("x")), "rag_chunks")
    assert spark.table("rag_chunks").columns == ["id", "extra"]
    tables.drop_table(spark, "rag_chunks")


def test_only_known_tables_are_open(spark):
    with pytest.raises(ValueError):
        tables.query_table(spark, "secrets")


def test_schema_report_and_check(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, z double")
    declared = spark.createDataFrame([], "a int, b int, c int").schema
    assert {r.column: r.status for r in tables.schema_report(df, declared).collect()} == {
        "a": "ok", "b": "changed", "c": "missing", "z": "extra"}
    with pytest.raises(ValueError, match="b.*c"):
        tables.check_schema(df, declared)
    fits = spark.createDataFrame([], "z int, a int").schema
    assert tables.check_schema(df.select("a", F.col("z").cast("int")), fits).columns == ["z", "a"]


def test_incident_schema_is_declared(incidents):
    assert [(f.name, f.dataType) for f in incidents.schema] == [
        (f.name, f.dataType) for f in schemas.RAW_OPERATIONS]


def test_null_report(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r.column: (r.nulls, r["rows"]) for r in tables.null_report(df, ["a", "b"]).collect()}
    assert got == {"a": (1, 3), "b": (2, 3)}
    with pytest.raises(ValueError, match="b"):
        tables.require_not_null(df, ["b"])
    tables.require_not_null(df.where("a = 3"), ["a", "b"])


def test_snapshot_diff(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "id string, text string")
    new = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4")], "id string, text string")
    diff = tables.snapshot_diff(old, new, "id", F.col("text")).collect()
    assert {r.id: r.change for r in diff} == {"b": "update", "c": "delete", "d": "insert"}


def test_alert_fatigue_denominator_is_all_rows(spark):
    day = dt.datetime(2024, 1, 30)
    df = spark.createDataFrame(
        [(day, "a", 1, False), (day, "a", 1, True), (day, "a", 0, False), (day, "a", 0, False),
         (dt.datetime(2024, 1, 23, 23), "a", 1, False), (dt.datetime(2024, 1, 24), "b", 0, False)],
        "timestamp timestamp_ntz, service_name string, if_anomaly int, sla_breached boolean")
    rates = monitoring.alert_fatigue(df, "2024-01-31")
    assert {r.service_name: r.alert_fatigue_rate for r in rates.collect()} == {"a": 0.25, "b": 0.0}
    assert [r.service_name for r in monitoring.alert_triggers(rates, 0.2).collect()] == ["a"]


def test_recent_filter_reaches_the_scan(spark):
    df = incidents_from_events(spark.read.parquet(EVENTS)).withColumn("if_anomaly", F.lit(1))
    plan = monitoring.alert_fatigue(df, "2024-01-31")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_numeric_drift(spark):
    data = [("baseline", float(v)) for v in (1, 2, 3, 4)] + [("current", float(v)) for v in (10, 12)]
    row = monitoring.numeric_drift(
        spark.createDataFrame(data, "window string, x double"), ["x"]).first()
    assert (row.baseline_mean, row.current_mean, row.baseline_n) == (2.5, 11.0, 4)
    assert row.z == pytest.approx(8.5 / ((5 / 3) / 4 + 2 / 2) ** 0.5)
    assert row.variance_ratio == pytest.approx(2 / (5 / 3)) and row.drifted


def test_categorical_drift(spark):
    data = [("baseline", "x")] * 30 + [("baseline", "y")] * 20 + [("current", "x")] * 10 + [
        ("current", "y")] * 40
    row = monitoring.categorical_drift(
        spark.createDataFrame(data, "window string, c string"), ["c"]).first()
    assert row.chi2 == pytest.approx(50 / 3) and row.dof == 1


@pytest.mark.parametrize("x, k, p", [
    # Textbook quantiles of the chi-square distribution.
    (3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05),
    (9.487729036781154, 4, 0.05), (18.307038053275146, 10, 0.05), (23.209251158954356, 10, 0.01),
    (0.0, 3, 1.0),
])
def test_chi2_tail(spark, x, k, p):
    df = spark.createDataFrame([(x, k)], "x double, k int")
    assert df.select(monitoring.chi2_tail("x", "k")).first()[0] == pytest.approx(p, rel=1e-9)


def test_incident_checks_find_a_wrong_flag(incidents):
    assert monitoring.incident_checks(incidents).first().rule_mismatches == 0
    broken = incidents.withColumn("sla_breached", ~F.col("sla_breached"))
    assert monitoring.incident_checks(broken).first().rule_mismatches > 0


def test_top_incidents_parity_order(spark):
    df = spark.createDataFrame(
        [(f"i{n}", float(n), -float(n)) for n in range(30)],
        "incident_id string, risk_score double, anomaly_score double")
    df = df.withColumns({c: F.lit(1) for c in (
        "service_name", "timestamp", "severity", "resolution_time_mins", "team", "root_cause",
        "sla_breached")}).withColumn("is_anomaly", F.col("risk_score") > 2)
    by_risk = [r.incident_id for r in reports.top_incidents(df).collect()]
    assert len(by_risk) == 20 and by_risk[0] == "i29"
    assert reports.top_incidents(df, "anomaly_score").first().incident_id == "i3"


def test_snapshot_diff_of_null_texts(spark):
    schema = "id int, t string"
    old = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "x")], schema)
    new = spark.createDataFrame([(1, None), (2, None), (3, "b"), (5, None)], schema)
    got = {r.id: r.change for r in tables.snapshot_diff(old, new, "id", F.col("t")).collect()}
    assert got == {2: "update", 3: "update", 4: "delete", 5: "insert"}
