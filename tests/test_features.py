import datetime as dt

from pyspark.sql import functions as F

from tarnwatch import schemas
from tarnwatch.functions.columns import calendar_columns, guarded_ratio, percent_text, start_of
from tarnwatch.plans.feature_job import feature_table, impute
from tarnwatch.sources.incidents import business_hours, incidents_from_events

DATA = "/root/testdata/sf0.001"


def test_business_hours_include_both_ends(spark):
    df = spark.createDataFrame([(h,) for h in (8, 9, 18, 19)], "h int")
    out = df.select(business_hours(F.col("h"), F.lit(10.0)).alias("m")).collect()
    assert [r.m for r in out] == [10.0, 12.0, 12.0, 10.0]


def test_calendar_and_month_end(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2023, 1, 31),), (dt.datetime(2023, 1, 31, 5),), (dt.datetime(2023, 1, 1),)],
        "timestamp timestamp_ntz")
    midnight = [r.is_month_end for r in df.select(*calendar_columns()).collect()]
    assert midnight == [True, False, False]
    whole = [r.is_month_end for r in df.select(*calendar_columns(month_end="calendar")).collect()]
    assert whole == [True, True, False]
    sunday = df.select(*calendar_columns()).collect()[2]
    assert (sunday.day_of_week, sunday.week_of_year, sunday.month) == (1, 52, 1)


def test_start_of_keeps_wall_clock(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 2, 30),)], "timestamp timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        row = df.select(*[start_of(u).alias(u) for u in ("hour", "day", "week", "month")]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (dt.datetime(2024, 3, 31, 2), dt.datetime(2024, 3, 31),
                          dt.datetime(2024, 3, 25), dt.datetime(2024, 3, 1))


def test_planted_rows_keep_the_order_of_effects(spark):
    # event 0 is planted: 20 + 0.5 at 10 o'clock, times 1.2, then times 3; limit 30.
    events = spark.createDataFrame(
        [(0, dt.datetime(2024, 1, 1, 10), 3, "click", 0.5, "{}"),
         (1, dt.datetime(2024, 1, 1, 8), 4, "click", 39.9, "{}")],
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string")
    planted, plain = incidents_from_events(events).orderBy("incident_id").collect()
    assert planted.resolution_time_mins == (20 + 0.5) * 1.2 * 3
    assert planted.sla_breached and planted.is_anomaly == 1
    assert plain.resolution_time_mins == 59.9 and not plain.sla_breached


def test_impute_leaves_longer_frames_null(spark):
    df = spark.createDataFrame([(None, None, None)],
                               "lag_1d double, rolling_std_7d double, rolling_std_14d double")
    full = df.withColumns({c: F.lit(None).cast("double")
                           for c in ("lag_7d", "lag_30d", "rolling_mean_7d")})
    row = impute(full).first()
    assert (row.lag_1d, row.rolling_std_7d, row.rolling_std_14d) == (0.0, 0.0, None)


def test_feature_table_has_the_declared_schema(spark):
    df = feature_table(incidents_from_events(spark.read.parquet(f"{DATA}/events.parquet")))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in schemas.FEATURES_OPERATIONS]
    assert df.columns[0] == "service_name" and df.count() == 1000


def test_one_exchange_and_sort_serve_all_windows(spark):
    from pyspark.sql import Window

    from tarnwatch.operators.windows import add_history

    df = incidents_from_events(spark.read.parquet(f"{DATA}/events.parquet"))
    w = Window.partitionBy("service_name").orderBy("timestamp", "incident_id")
    plan = add_history(df, w, "resolution_time_mins")._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1


def test_ratio_and_percent(spark):
    row = spark.range(1).select(
        guarded_ratio(F.lit(3), F.lit(0)).alias("a"), guarded_ratio(F.lit(3), F.lit(4)).alias("b"),
        percent_text(F.lit(0.15625)).alias("p")).first()
    assert (row.a, row.b, row.p) == (0.0, 0.75, "15.63%")
