"""Size-checked reads and intermediate tables that outlive executors."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

SMALL_ROWS = 10_000


def bounded_rows(df: DataFrame, limit: int = SMALL_ROWS) -> list[Row] | None:
    """The rows of `df` if there are at most `limit`, else None. Never reads more than limit + 1."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def join_group_rows(df: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Left join of rows with the figures of their group, one row per key in `groups`.

    Up to SMALL_ROWS groups are read and broadcast, so the rows stay in their tasks. By shuffle, each group's
    rows would meet in one task: adaptive execution keeps that plan when few keys leave
    most partitions empty, however small the figures are. More groups are joined by shuffle.
    """
    rows = groups.limit(SMALL_ROWS + 1).toArrow()
    if rows.num_rows <= SMALL_ROWS:
        groups = F.broadcast(df.sparkSession.createDataFrame(rows, groups.schema))
    return df.join(groups, key, "left")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's `spark.checkpoint.dir`.

    A machine-local folder is used only in local mode with the setting missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tarnwatch-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame, name: str = "table", derived: dict[str, Column] | None = None,
           codec: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: a fixed copy with no lineage.

    Columns in `derived` follow from the others: the copy leaves them out, its readers compute them.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    lean = df.drop(*(derived or {}))
    lean.write.parquet(path, compression=codec)
    return with_derived(spark.read.schema(lean.schema).parquet(path), df.columns, derived)


def with_derived(lean: DataFrame, columns: list[str], derived: dict[str, Column] | None) -> DataFrame:
    """`columns` of a table without its `derived` ones, which are computed where they are asked for."""
    return lean.withColumns({c: v for c, v in (derived or {}).items() if c in columns}).select(*columns) if derived else lean


def stored_by(df: DataFrame, column: str, name: str) -> str:
    """Write `df` to the shared folder, a subfolder per value of `column`, and give the path."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.repartition(column).write.partitionBy(column).parquet(path)
    return path


def read_folder(path: str, columns: list[str]) -> list[tuple]:
    """Rows of a small Parquet folder of the shared folder, read inside a task; none if it is not there."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    store, inside = (pyarrow.fs.LocalFileSystem(), path) if path.startswith("/") else pyarrow.fs.FileSystem.from_uri(path)
    if store.get_file_info(inside).type == pyarrow.fs.FileType.NotFound:
        return []
    table = pyarrow.dataset.dataset(inside, filesystem=store, format="parquet").to_table(columns=columns)
    return list(zip(*[table.column(c).to_pylist() for c in columns]))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a table of few files to tasks before heavy per-row work.

    A rebalance: small tables go to all cores, large ones to as many tasks as their size asks for.
    A table with at least one file per core is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.hint("rebalance", key)
