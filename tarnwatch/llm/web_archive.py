"""WARC archives with a two-level capture index.

Pages are written as WARC records, one gzip member each. Of records with equal payloads the one with
the smallest page_id is the response; the others are revisits that refer to it and hold its HTTP
header only. The capture index is sorted by URL key (host names reversed) and page_id, in files of
zstandard blocks of BLOCK_LINES captures. Beside each file lies its sparse directory: the first
key and the place of every block. A lookup finds the file by its first key, searches the directory,
reads one block by its range, searches that, and reads the records by theirs.

Lookups are dealt by key ranges, so neighbours share blocks; records of a batch are read in archive
order. What the driver holds is one row per index file. Tasks that run again write new files; the
manifest, written by Spark, names those that count.

Defined cases: a null page has an empty payload; payloads shorter than `least_bytes` are all
responses; rows with the same page_id and payload are one capture twice, each of its own type;
a null page_id sorts after all others and revisits them; null URLs have the empty key.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import zlib

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.bounded import stored
from .shared import RangeReader, SharedWriter, work_folder

BLOCK_LINES = 1000
ARCHIVE_BYTES = 1 << 30
DATE = "2024-01-01T00:00:00Z"


def url_key(url: str | Column) -> Column:
    """Sort key of a URL: host names reversed, then port, path and query. `www.a.org/x` is `org,a)/x`."""
    text = F.coalesce(url, F.lit(""))
    rest = F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^(?:[^/?#@]*@)?([^/?#:]*)", 1))
    names = F.reverse(F.split(F.regexp_replace(host, r"^www[0-9]*\.", ""), r"\."))
    tail = F.regexp_replace(rest, r"^(?:[^/?#@]*@)?[^/?#:]*", "")
    return F.when(text == "", F.lit("")).otherwise(
        F.concat(F.array_join(names, ","), F.lit(")"), F.regexp_replace(tail, r"#.*$", "")))


# --- Records ----------------------------------------------------------------------

def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A response, or a revisit of another page, as one gzip member."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}",
            "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
            f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> dict:
    """page_id, record_type, refers_to, payload (None for a revisit), payload_bytes and payload_digest."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda name: None if (v := fields[name][len("<urn:page:"):-1]) == "None" else int(v)
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {"page_id": number("WARC-Record-ID"), "record_type": fields["WARC-Type"],
            "refers_to": number("WARC-Refers-To") if revisit else None, "url": fields["WARC-Target-URI"],
            "payload": None if revisit else payload, "payload_bytes": length, "payload_digest": digest}


# --- Archives and index --------------------------------------------------------------

def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record per page; (key, page_id, file, offset, length) per record."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        url_key(F.col("url").cast("string")).alias("key"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    shared = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("digest"),
                           F.octet_length(payload).alias("bytes"))
              .where(F.col("bytes") >= least_bytes)
              .groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
              .where("n > 1 AND first_id IS NOT NULL").select("digest", "first_id"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    known = rows.join(shared, "digest", "left").select("page_id", "url", "key", "payload", refers.alias("refers_to"))

    def run(batches):
        out = None
        for batch in batches:
            found = batch.to_pydict()
            placed = []
            for page_id, url, data, refers_to in zip(
                    found["page_id"], found["url"], found["payload"], found["refers_to"]):
                if out is None or out.position > ARCHIVE_BYTES:
                    if out:
                        out.close()
                    out = SharedWriter(folder, ".warc.gz")
                record = warc_record(page_id, url, data, base32_sha1(data), refers_to)
                placed.append((out.name, *out.write(record)))
            names, offsets, lengths = zip(*placed) if placed else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("page_id"), pa.array(names, pa.string()),
                 pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                names=["key", "page_id", "file", "offset", "length"])
        if out:
            out.close()

    return known.mapInArrow(run, "key string, page_id long, file string, offset long, length long")


def _order(key: str, page_id) -> tuple:
    return key, page_id is None, page_id or 0


def build_index(manifest: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write index files and their directories; (first_key, first_id, file, place, bytes) per index file."""
    def run(batches):
        packer = zstandard.ZstdCompressor()
        out, held, directory = None, [], []

        def flush():
            block = packer.compress(json.dumps(held).encode())
            directory.append([*held[0][:2], *out.write(block)])
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                out = out or SharedWriter(folder, ".cdx.zst")
                held.append(row)
                if len(held) >= block_lines:
                    flush()
        if out is None:
            return
        if held:
            flush()
        place, size = out.write(packer.compress(json.dumps(directory).encode()))
        out.close()
        key, page_id = directory[0][:2]
        yield pa.RecordBatch.from_arrays(
            [pa.array([key], pa.string()), pa.array([page_id], pa.int64()), pa.array([out.name]),
             pa.array([place], pa.int64()), pa.array([size], pa.int64())],
            names=["first_key", "first_id", "file", "place", "bytes"])

    order = ["key", F.col("page_id").asc_nulls_last()]
    ranged = manifest.select("key", "page_id", "file", "offset", "length").repartitionByRange(
        *order).sortWithinPartitions(*order, "file", "offset")
    return ranged.mapInArrow(run, "first_key string, first_id long, file string, place long, bytes long")


class CaptureIndex:
    """Searches the index: file by first key, block by the file's directory, lines in the block."""

    def __init__(self, files: list[tuple], folder: str):
        self._files = sorted(files, key=lambda f: _order(f[0], f[1]))
        self._first = [_order(f[0], f[1]) for f in self._files]
        self._reader, self._unzip = RangeReader(folder), zstandard.ZstdDecompressor()
        self._file, self._directory, self._starts = -1, [], []
        self._place, self._lines, self._keys = None, [], []

    def _load(self, name: str, offset: int, length: int):
        return json.loads(self._unzip.decompress(self._reader.read(name, offset, length)))

    def captures(self, key: str, page_id) -> list[tuple]:
        """(file, offset, length) of the captures of one page; equal rows may span blocks and files."""
        want = _order(key, page_id)
        found = []
        for f in range(max(0, bisect.bisect_left(self._first, want) - 1), bisect.bisect_right(self._first, want)):
            if f != self._file:
                name, place, size = self._files[f][2:]
                self._file, self._directory = f, self._load(name, place, size)
                self._starts, self._place = [_order(*d[:2]) for d in self._directory], None
            blocks = range(max(0, bisect.bisect_left(self._starts, want) - 1), bisect.bisect_right(self._starts, want))
            for b in blocks:
                if b != self._place:
                    self._place, self._lines = b, self._load(self._files[f][2], *self._directory[b][2:])
                    self._keys = [_order(*line[:2]) for line in self._lines]
                low, high = bisect.bisect_left(self._keys, want), bisect.bisect_right(self._keys, want)
                found += [tuple(line[2:]) for line in self._lines[low:high]]
        return found


def read_captures(wanted: DataFrame, files: list[tuple], folder: str) -> DataFrame:
    """Records of the wanted (key, page_id): found by the index, read by range, digests checked."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches):
        index, archives = CaptureIndex(files, folder), RangeReader(folder)
        for batch in batches:
            places = [p for key, page_id in zip(*(c.to_pylist() for c in batch.columns))
                      for p in index.captures(key, page_id)]
            records = [parse_record(archives.read(*place)) for place in sorted(places)]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in records], kind) for c, kind in zip(columns, kinds)], names=columns)
        archives.close()

    order = ["key", F.col("page_id").asc_nulls_last()]
    sorted_keys = wanted.select("key", "page_id").distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_keys.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, "
                                       "record_type string, refers_to long")


def archive_and_read_back(pages: DataFrame, least_bytes: int = 0, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write archives and index, then look up every page and give its record's digest."""
    folder = work_folder(pages.sparkSession, "archives")
    manifest = stored(write_archives(pages, folder, least_bytes), "captures")
    files = [tuple(r) for r in stored(build_index(manifest, folder, block_lines), "index").collect()]
    wanted = pages.select(url_key(F.col("url").cast("string")).alias("key"), F.col("page_id").cast("long").alias("page_id"))
    return read_captures(wanted, files, folder)
