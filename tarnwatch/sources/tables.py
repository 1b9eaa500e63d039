"""Stored tables: read, write, list, drop, query, check, compare."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = frozenset({
    "raw_operations", "features_operations", "anomaly_scores",
    "rag_documents", "rag_chunks", "rag_chunks_fixed", "run_metrics",
})


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save_table(df: DataFrame, name: str, mode: str = "overwrite",
               partition_by: tuple[str, ...] = (), fmt: str = "parquet",
               path: str | None = None) -> None:
    """Save as a catalog table, by default replacing the old one and its schema.

    Rows of a partitioned table are gathered by partition value with a rebalance: Spark
    splits a hot value over many tasks and joins small ones, by size. Rows appended to a table
    that `replace_table` put under `path` join its present version.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path and not (mode == "append" and _has_version_under(df.sparkSession, name, path)):
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def _has_version_under(spark: SparkSession, name: str, path: str) -> bool:
    """Does the table lie in a version folder that `replace_table` made under `path`?"""
    if not spark.catalog.tableExists(name):
        return False
    told = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name}).collect()
    location = next((r.data_type for r in reversed(told) if r.col_name == "Location"), "")
    location, wanted = (re.sub(r"^file:/*(?=/)", "", place).rstrip("/") for place in (location, path))
    if "://" not in wanted:
        location = re.sub(r"^[\w+.-]+://[^/]*", "", location)
    return re.fullmatch(re.escape(f"{wanted}/{name}__") + "[0-9a-f]{12}", location) is not None


def replace_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), fmt: str = "parquet",
                  path: str | None = None) -> None:
    """Save `df` as a new version of the table and only then put it in the place of the old one.

    Readers keep the old table until the new one is written; a write that fails leaves it as it was. With
    a `path`, every version has a folder of its own under it.
    """
    spark = df.sparkSession
    version = f"{name}__{uuid.uuid4().hex[:12]}"
    try:
        save_table(df, version, "errorifexists", partition_by, fmt, f"{path}/{version}" if path else None)
    except Exception:
        drop_table(spark, version)
        raise
    drop_table(spark, name)
    old, new = ("`" + n.replace(".", "`.`") + "`" for n in (version, name))
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    if partition_by:
        spark.catalog.recoverPartitions(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def list_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def query_table(spark: SparkSession, name: str, predicate: str = "1=1",
                allowed: frozenset[str] = TABLES) -> DataFrame:
    """Rows of an allowed table under an SQL predicate; Spark pushes it into the scan."""
    if name not in allowed:
        raise ValueError(f"table {name!r} is not open to queries")
    return spark.table(name).where(F.expr(predicate))


def preview(df: DataFrame, order: list, n: int = 10) -> DataFrame:
    """First `n` rows in a fixed order."""
    return df.orderBy(*order).limit(n)


def schema_report(df: DataFrame, declared: StructType) -> DataFrame:
    """One row per column: declared and actual type and a status."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in declared.fields}
    rows = []
    for name in sorted(actual.keys() | wanted.keys()):
        want, have = wanted.get(name), actual.get(name)
        status = (
            "missing" if have is None else "extra" if want is None
            else "ok" if want == have else "changed"
        )
        rows.append((name, want, have, status))
    return df.sparkSession.createDataFrame(
        rows, "column string, declared string, actual string, status string")


def check_schema(df: DataFrame, declared: StructType) -> DataFrame:
    """`df` in declared column order; raises when a column is missing or of another type."""
    bad = [
        f.name for f in declared.fields
        if f.name not in df.columns
        or df.schema[f.name].dataType.simpleString() != f.dataType.simpleString()
    ]
    if bad:
        raise ValueError(f"columns missing or of another type: {bad}")
    return df.select(*declared.names)


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per required column with its number of nulls, from a single scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
                    F.count("*").alias("_rows"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls"))
                      for c in columns])
    return counts.select("_rows", F.inline(pairs)).select(
        "column", "nulls", F.col("_rows").alias("rows"))


def require_not_null(df: DataFrame, columns: list[str]) -> None:
    bad = null_report(df, columns).where("nulls > 0").collect()
    if bad:
        raise ValueError("missing values found in " + ", ".join(
            f"{r['column']} ({r['nulls']})" for r in bad))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, content: Column) -> DataFrame:
    """Changes that turn one snapshot into the next: insert, update and delete rows by key.

    Only keys and content digests are shuffled. Keys are unique in each snapshot. A null content
    is a content like any other; its digest is null.
    """
    before = old.select(key, F.md5(content).alias("old_digest"), F.lit(True).alias("_old"))
    after = new.select(key, F.md5(content).alias("new_digest"), F.lit(True).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("old_digest").eqNullSafe(F.col("new_digest")), "update")
    )
    return (
        before.join(after, key, "full_outer")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .drop("_old", "_new")
    )
