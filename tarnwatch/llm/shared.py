"""Small helpers of the operators: tables, row identity, word numbers, files in the shared folder."""

from __future__ import annotations

import posixpath
import uuid

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bounded import scratch_dir

#: A word wherever a contract speaks of white space: `bytes.split()` cuts at the same characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str | Column = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key() -> Column:
    """Names a row of `documents`: id, hash of the text, source. Rows equal in these are copies."""
    parts = (F.col("doc_id"), F.xxhash64("text"), F.col("source"))
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])


def keyed(docs: DataFrame) -> DataFrame:
    """(row, row_key): whole rows as a struct, so that no column of theirs clashes with others."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key().alias("row_key"))


class Numbering(dict):
    """Numbers words in order of appearance; `map(numbering.__getitem__, words)` stays in C."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


# --- Files that tasks write and read besides Spark's own tables ---------------------

def work_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Arrow's file system for a path or URI of the shared folder, and the path inside it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if path.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(path)


class SharedWriter:
    """One new file under `folder`. A task that runs again writes another file, never the same."""

    def __init__(self, folder: str, suffix: str):
        self.name = f"{uuid.uuid4().hex}{suffix}"
        fs, inside = file_system(folder)
        fs.create_dir(inside, recursive=True)
        # The name must not make Arrow compress once more.
        self._stream = fs.open_output_stream(posixpath.join(inside, self.name), compression=None)
        self.position = 0

    def write(self, data: bytes) -> tuple[int, int]:
        """Append and give (offset, length)."""
        start = self.position
        self._stream.write(data)
        self.position += len(data)
        return start, len(data)

    def close(self) -> None:
        self._stream.close()


class RangeReader:
    """Range reads from files of one folder; the last few files stay open."""

    def __init__(self, folder: str, keep: int = 16):
        self._fs, self._folder = file_system(folder)
        self._open, self._keep = {}, keep

    def read(self, name: str, offset: int, length: int) -> bytes:
        handle = self._open.pop(name, None)
        if handle is None:
            handle = self._fs.open_input_file(posixpath.join(self._folder, name))
            if len(self._open) >= self._keep:
                self._open.pop(next(iter(self._open))).close()
        self._open[name] = handle
        handle.seek(offset)
        data = handle.read(length)
        if len(data) != length:
            raise EOFError(f"{name}: {length} bytes at {offset} expected, {len(data)} read")
        return data

    def close(self) -> None:
        for handle in self._open.values():
            handle.close()
        self._open.clear()
