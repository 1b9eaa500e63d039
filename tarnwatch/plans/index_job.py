"""Keyed chunks to the stored chunk table that retrieval reads."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bounded import read_folder, stored, stored_by, with_derived
from ..operators.retrieval import drop_duplicate_keys
from ..sources.tables import save_table, snapshot_diff


def key_audit(chunks: DataFrame, stage: str) -> DataFrame:
    """One row: chunks and keys that occur more than once."""
    return chunks.groupBy("id").agg(F.count("*").alias("n")).agg(
        F.lit(stage).alias("stage"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"))


def build_index(chunks: DataFrame, table: str = "rag_chunks_fixed", path: str | None = None,
                derived: dict[str, Column] | None = None) -> DataFrame:
    """Save one chunk per key and return the audit before and after.

    The texts are cut once: the audit and the table read a written copy of the chunks. Columns in `derived`
    follow from the others; they are computed for the saved table only.
    """
    delivered = stored(chunks, "chunks", derived, "zstd")
    save_table(drop_duplicate_keys(delivered, "id", "text", derived), table, path=path)
    saved = chunks.sparkSession.table(table)
    return key_audit(delivered, "delivered").unionByName(key_audit(saved, "indexed"))


BUCKETS = 256
# A bucket of this many files is gathered anew when chunks of it change.
BUCKET_FILES = 16


def _bucketed(chunks: DataFrame, buckets: int) -> DataFrame:
    return chunks.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))


def _gathered(chunks: DataFrame) -> DataFrame:
    return chunks.hint("rebalance", "bucket")


def _write_buckets(chunks: DataFrame, path: str, partitions: str = "static") -> None:
    (chunks.write.mode("overwrite").option("partitionOverwriteMode", partitions).option("compression", "zstd")
     .partitionBy("bucket").parquet(path))


def save_buckets(chunks: DataFrame, path: str, buckets: int = BUCKETS, derived: dict[str, Column] | None = None) -> None:
    """Store chunks, one per key, in a folder per bucket of keys.

    Columns in `derived` follow from the others; they are not stored, `read_buckets` computes them.
    """
    _write_buckets(_gathered(_bucketed(chunks.drop(*(derived or {})), buckets)), path)


def read_buckets(spark: SparkSession, path: str, like: DataFrame, derived: dict[str, Column] | None = None) -> DataFrame:
    """The stored chunks with their bucket; `like` gives the columns, `derived` those that are not stored."""
    lean = spark.read.schema(_bucketed(like.drop(*(derived or {})).limit(0), 1).schema).parquet(path)
    return with_derived(lean, [*like.columns, "bucket"], derived)


def _by_change(chunks: DataFrame, folder: str, kinds: tuple[str, ...], wanted: bool) -> DataFrame:
    """Chunks whose key is (`wanted`) or is not among the changes of these kinds.

    The changes lie in a folder per bucket. A task reads those of the buckets it meets, so the texts need
    no shuffle by key.
    """
    def judge(batches):
        met, keys = set(), set()
        for batch in batches:
            for bucket in set(batch["bucket"].to_pylist()) - met:
                met.add(bucket)
                keys.update(k for k, change in read_folder(f"{folder}/bucket={bucket}", ["id", "change"])
                            if change in kinds and k is not None)
            yield batch.filter(pa.array([(k in keys) == wanted for k in batch["id"].to_pylist()], pa.bool_()))

    return chunks.mapInArrow(judge, chunks.schema)


def apply_changes(new: DataFrame, path: str, buckets: int = BUCKETS, derived: dict[str, Column] | None = None) -> DataFrame:
    """Bring the stored chunks to the state of `new` and return the changes made.

    Keys and digests are compared; only buckets with changes are read and written anew, and Spark puts them
    in the place of the old ones once all are written. Chunks that stay are copied where they
    are read; new ones are gathered by bucket once. A run that is lost on the way leaves whole buckets, old or
    new, and the next run finds what is still to be done. `derived` is that of `save_buckets`.
    """
    spark = new.sparkSession
    new = new.drop(*(derived or {}))
    old = read_buckets(spark, path, new)
    diff = _bucketed(snapshot_diff(old, new, "id", F.col("text")), buckets)
    folder = stored_by(diff, "bucket", "changes")
    changes = spark.read.schema(diff.schema).parquet(folder)
    touched = {r.bucket for r in changes.select("bucket").distinct().collect()}  # at most `buckets` numbers
    if touched:
        before = set(old.inputFiles())
        files = Counter(map(_bucket_of, before))
        crowded = [b for b in touched if files[b] >= BUCKET_FILES]
        kept = _by_change(old.where(F.col("bucket").isin(*touched)), folder, ("update", "delete"), False)
        come = _bucketed(new, buckets).where(F.col("bucket").isin(*touched))
        fresh = _by_change(_gathered(come), folder, ("update", "insert"), True)
        if crowded:
            full = F.col("bucket").isin(*crowded)
            kept = kept.where(~full).unionByName(_gathered(kept.where(full)))
        _write_buckets(kept.unionByName(fresh), path, "dynamic")
        # Buckets that lost their last chunk were not written: their old files are still there.
        stale = before & set(read_buckets(spark, path, new).inputFiles())
        for bucket in touched & set(map(_bucket_of, stale)):
            _delete_folder(spark, f"{path}/bucket={bucket}")
    return changes.drop("bucket")


def _bucket_of(file: str) -> int:
    return int(file.split("/bucket=")[-1].split("/")[0])


def _delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
