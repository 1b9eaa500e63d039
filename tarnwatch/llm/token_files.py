"""Token ids in files of bit planes.

The ids of all documents, each closed by an end id, form one stream in ascending document order.
Documents are range partitioned by id; a task encodes its range and writes one file:

    chunk 0 | chunk 1 | ... | index (JSON, zstandard) | length of the index (8 bytes) | magic

A chunk holds BLOCK ids (the last one fewer). Its ids are transposed into 16 or 32 bit planes
(bit j of every id, packed) and every plane is compressed with zstandard by itself; planes that
are all zero take no bytes. The index gives, per chunk, ids, width and offset and length of each
plane, so any chunk is read alone.

Encoding: a tokenizer that lowers letters and cuts at white space gives the ids of a text as those of
its words, so distinct words are encoded once per task and remembered (tests compare with whole texts).
Arrow splits some MB of text at a time and finds their distinct words.

Defined cases: null and empty texts have the end id only; a null doc_id comes first; rows with the
same id follow each other in the order of their texts; ids beyond 16 bits widen their chunk.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.bounded import stored
from .shared import Numbering, RangeReader, SharedWriter, work_folder

BLOCK = 1 << 16
MAGIC = b"BPIDS\x00\x01\x00"
END_ID = 1
REMEMBER = 300_000
#: Text bytes per file: a task that reads more learns fewer words anew.
FILE_BYTES = 64 << 20
#: Text bytes that are split and numbered together.
SLICE_BYTES = 2 << 20


# --- The file format -----------------------------------------------------------------

def pack_planes(ids: np.ndarray) -> tuple[int, list[bytes]]:
    """(width, planes): bit j of all ids packed, most significant bit of a byte first."""
    width = 32 if len(ids) and int(ids.max()) >= 1 << 16 else 16
    ids = ids.astype(np.uint32 if width == 32 else np.uint16)
    rows = [np.packbits(((ids >> j) & 1).astype(bool)) for j in reversed(range(width))]
    return width, [row.tobytes() if row.any() else b"" for row in rows]


def unpack_planes(width: int, planes: list[bytes], n: int) -> np.ndarray:
    ids = np.zeros(n, np.uint32 if width == 32 else np.uint16)
    for j, plane in zip(reversed(range(width)), planes):
        if plane:
            ids |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n).astype(ids.dtype) << ids.dtype.type(j)
    return ids.astype(np.uint32)


class PlaneWriter:
    """Collects ids and writes a chunk whenever a block is full."""

    def __init__(self, folder: str, block: int = BLOCK):
        self._out, self._block = SharedWriter(folder, ".bpids"), block
        self._zip = zstandard.ZstdCompressor(level=3)
        self._held, self._n, self._index = [], 0, []
        self.name, self.total = self._out.name, 0

    def add(self, ids: np.ndarray) -> None:
        self._held.append(ids)
        self._n += len(ids)
        self.total += len(ids)
        if self._n >= self._block:
            stream = np.concatenate(self._held)
            whole = self._n - self._n % self._block
            for at in range(0, whole, self._block):
                self._chunk(stream[at:at + self._block])
            self._held, self._n = [stream[whole:]], self._n - whole

    def _chunk(self, ids: np.ndarray) -> None:
        width, planes = pack_planes(ids)
        places = [self._out.write(self._zip.compress(p)) if p else (0, 0) for p in planes]
        self._index.append({"ids": len(ids), "width": width, "planes": places})

    def close(self) -> None:
        if self._n:
            self._chunk(np.concatenate(self._held))
        index = self._zip.compress(json.dumps({"block": self._block, "chunks": self._index}).encode())
        self._out.write(index + struct.pack("<Q", len(index)) + MAGIC)
        self._out.close()


class PlaneReader:
    """Reads a range of ids of one file; the last chunk stays unpacked."""

    def __init__(self, reader: RangeReader, name: str, size: int):
        self._reader, self._name = reader, name
        self._unzip = zstandard.ZstdDecompressor()
        tail = reader.read(name, size - 16, 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{name} is no file of bit planes")
        length = struct.unpack("<Q", tail[:8])[0]
        index = json.loads(self._unzip.decompress(reader.read(name, size - 16 - length, length)))
        self._block, self._chunks, self._at, self._ids = index["block"], index["chunks"], -1, None

    def ids(self, start: int, n: int) -> np.ndarray:
        parts = []
        while n > 0:
            k, inside = divmod(start, self._block)
            part = self._chunk(k)[inside:inside + n]
            if not len(part):
                raise EOFError(f"{self._name}: no id {start}")
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def _chunk(self, k: int) -> np.ndarray:
        if k != self._at:
            chunk = self._chunks[k]
            planes = [self._unzip.decompress(self._reader.read(self._name, at, length)) if length else b""
                      for at, length in chunk["planes"]]
            self._at, self._ids = k, unpack_planes(chunk["width"], planes, chunk["ids"])
        return self._ids


# --- Encoding --------------------------------------------------------------------------

#: A comma or full stop that ends a word is a token by itself, as if a space stood before it.
CLOSING = r"([a-z0-9À-ÖØ-öø-ÿ])([.,])([\x20\x09-\x0D]|$)"
#: Words of these letters are never cut before the tokenizer merges: one closing token each.
LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")


def split_words(texts: pa.Array) -> pa.Array:
    """Per text a list of words that have the same ids as in the text: A-Z in lower case, closing marks apart.

    The tokenizer lowers all letters, but looks for its special tokens first; texts with anything
    like one keep their letters. Arrow gives empty words at the ends of a text; they have no ids.
    """
    plain = pc.replace_substring_regex(pc.ascii_lower(texts), CLOSING, r"\1 \2\3")
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, plain))


def text_slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring texts, about SLICE_BYTES together."""
    ahead = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ahead // SLICE_BYTES)) + 1).tolist(), len(texts)]
    for start, end in zip(cuts, cuts[1:]):
        yield texts.slice(start, end - start)


class WordEncoder:
    """Ids of texts from the ids of their words, each text closed by an end id.

    Words are numbered when first seen, each distinct word of a call once; their ids lie in one
    array, so the texts of a call are one gather. Number 0 is the end of a text.
    """

    def __init__(self, tokenizer_json: str, end_id: int = END_ID):
        from tokenizers import Tokenizer
        self._tokenizer, self._end_id = Tokenizer.from_str(tokenizer_json), end_id
        suffix = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self._tokenizer.get_vocab()
        self._closing = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self._closing[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self._start_over()

    def _start_over(self) -> None:
        self._numbers = Numbering({None: 0, "": 1})
        self._ids = np.array([self._end_id], np.uint32)
        self._starts, self._sizes = np.array([0, 1], np.int64), np.array([1, 0], np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each text)."""
        if len(self._numbers) > REMEMBER:
            self._start_over()
        split = split_words(pc.fill_null(texts, ""))
        words = split.flatten().dictionary_encode()
        known = np.fromiter(map(self._numbers.__getitem__, words.dictionary.to_pylist()), np.int64,
                            len(words.dictionary))
        self._learn()
        after = np.cumsum(pc.list_value_length(split).to_numpy(), dtype=np.int64)
        numbers = np.insert(known[words.indices.to_numpy()], after, 0)
        many = self._sizes[numbers]
        total = np.cumsum(many)
        places = np.repeat(self._starts[numbers] - (total - many), many)
        places += np.arange(len(places))
        return self._ids[places], np.diff(total[after + np.arange(len(after))], prepend=0)

    def _learn(self) -> None:
        """Encode new words, words of letters only apart from the others."""
        first = len(self._starts)
        new = list(islice(self._numbers, first, None))
        letters = np.fromiter((LETTERS.fullmatch(w) is not None for w in new), bool, len(new))
        self._starts, self._sizes = (np.concatenate([a, np.zeros(len(new), np.int64)])
                                     for a in (self._starts, self._sizes))
        for whole in (True, False):
            of = np.flatnonzero(letters == whole)
            ids, sizes = self._encode_words([new[i] for i in of.tolist()], whole)
            self._starts[first + of] = len(self._ids) + np.cumsum(sizes) - sizes
            self._sizes[first + of] = sizes
            self._ids = np.concatenate([self._ids, ids])

    def _encode_words(self, words: list[str], whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids of each word), many words encoded as one text.

        A `whole` word ends with its only closing token. A token of another one belongs to the word in
        which it begins; so it is found for all words if a closing token is missing.
        """
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for at in range(0, len(words), 500):
            some = words[at:at + 500]
            found = self._tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            ends = np.flatnonzero(self._closing[ids[-1]]) + 1 if whole else ()
            if len(ends) != len(some):
                after = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) + 1)
                ends = np.searchsorted(np.array([o[0] for o in found.offsets], np.int64), after)
            sizes.append(np.diff(ends, prepend=0))
        return np.concatenate(ids), np.concatenate(sizes)


# --- The operator ------------------------------------------------------------------------

def write_token_files(docs: DataFrame, tokenizer_json: str, folder: str, end_id: int = END_ID,
                      block: int = BLOCK) -> DataFrame:
    """Write the ids of all texts; (doc_id, file, file_size, part, nth, begin, n_tokens) per document.

    `part` numbers the files in document order, `nth` the documents of a file; `begin` counts ids
    within the file.
    """
    def run(batches):
        encoder = WordEncoder(tokenizer_json, end_id)
        writer, doc_ids, counts = None, [], []
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for some in text_slices(texts):
                writer = writer or PlaneWriter(folder, block)
                found, sizes = encoder.encode(some)
                writer.add(found)
                counts.extend(sizes.tolist())
            doc_ids.append(ids)
        if writer is None:
            return
        writer.close()
        size = writer._out.position
        begin = np.cumsum([0, *counts[:-1]])
        at = 0
        for ids in doc_ids:
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([writer.name] * n), pa.array([size] * n, pa.int64()),
                 pa.array(range(at, at + n), pa.int64()), pa.array(begin[at:at + n], pa.int64()),
                 pa.array(counts[at:at + n], pa.int64())],
                names=["doc_id", "file", "file_size", "nth", "begin", "n_tokens"])
            at += n

    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(max(1, -(-total // FILE_BYTES)), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text"))
    return ordered.mapInArrow(
        run, "doc_id long, file string, file_size long, nth long, begin long, n_tokens long"
    ).withColumn("part", F.spark_partition_id())


def with_starts(manifest: DataFrame) -> DataFrame:
    """Add `start`: the ids of all documents before. One row per file meets in the window."""
    files = manifest.groupBy("file", "part").agg(F.sum("n_tokens").alias("ids"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = files.select("file", F.coalesce(F.sum("ids").over(ahead), F.lit(0)).alias("first"))
    return manifest.join(first, "file").withColumn("start", F.col("first") + F.col("begin")).drop("first")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    The manifest is dealt by stretches of a file, so that a file may be read by many tasks.
    """
    def run(batches):
        reader, files = RangeReader(folder), {}
        for batch in batches:
            rows, sums, counts = batch.to_pydict(), [], []
            for name, size, begin, n in zip(rows["file"], rows["file_size"], rows["begin"], rows["n_tokens"]):
                if name not in files:
                    files.clear()
                    files[name] = PlaneReader(reader, name, size)
                ids = files[name].ids(begin, n)
                counts.append(len(ids))
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(counts, pa.int64()),
                 pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
        reader.close()

    ordered = manifest.repartitionByRange("part", "nth").sortWithinPartitions("part", "nth")
    return ordered.select("doc_id", "start", "file", "file_size", "begin", "n_tokens").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read_back(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID,
                         block: int = BLOCK) -> DataFrame:
    """Write the token files of `docs`, then give each document's digest as the files hold it."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    folder = work_folder(docs.sparkSession, "token-files")
    manifest = stored(write_token_files(docs, tokenizer_json, folder, end_id, block), "token-manifest")
    return read_token_files(with_starts(manifest), folder)
