"""Alignment of two tokenizers' tokens, and how often their ids are linked in the corpus.

Both tokenizers read the same bytes. Where a token of A and a token of B end at the same byte, a
group ends; all A and B tokens of a group are linked. The ends of both sides are walked on one
diagonal: at the present index shift, stretches of doubling length are compared as wholes, so
that one-to-one stretches are jumped over; where the ends differ, the side that lags moves on until
both meet, and the walk goes on at the new shift.

Counts over the corpus are taken in two passes. The first encodes and aligns; every `BLOCK_DOCS`
documents (or `BLOCK_PAIRS` entries) of a task are a block with a sorted dictionary of its id pairs,
and a document keeps numbers into it. Only the dictionaries are counted over the corpus, a row per block
and pair, so common pairs are summed up before they are shuffled. The second pass gives every
block the counts of its own dictionary, in the same order, and sums up per document.

Text is read by segments: words with the white space before them, and the marks after words.
Neither tokenizer makes a token across the places where they are cut (checked for the pieces of B when
the operator starts), so a segment's ids, and its groups, are the same in every text. The new segments
of about a megabyte of text are encoded and aligned in one walk, and remembered up to a bound.
Texts that hold a segment whose bytes do not come back are encoded and aligned as wholes by
the libraries and judged by their joined bytes.

Defined cases: null and empty texts, and texts whose bytes do not come back from both sides, have no
tokens: zeros and an empty digest. A document without id is a row like others. Rows that share a
doc_id are documents of their own, in the counts too.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bounded import stored

MARK = "▁"
#: A word with the white space before it, if a mark, a digit or white space follows; else all up to white space.
SEGMENT = re.compile(r"\s*[A-Za-z\u00C0-\u024F]++(?=[\s!-@\[-`{-~]|\Z)|\s*\S+|\s+")
ANCHOR = "a"
#: Texts with it are read as wholes: some pieces hold it behind a mark.
UNCUT = "\r"
REMEMBER, REMEMBER_CHARS = 400_000, 32 << 20
CHUNK_CHARS = 1 << 20
BLOCK_DOCS, BLOCK_PAIRS = 4096, 1_000_000


# --- The two sides (inside tasks) -----------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, by a rule:
    printable Latin-1 bytes are themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevelSide:
    """Ids of space + text, and the bytes of each id, for a byte-level tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self._model = Tokenizer.from_file(path)
        self._model.encode_special_tokens = True
        letters = byte_alphabet()
        names = {i: t for t, i in self._model.get_vocab().items()}
        self.bytes = [bytes(letters.get(c, 63) for c in names.get(i, "")) for i in range(max(names) + 1)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with their space already."""
        return [e.ids for e in self._model.encode_batch_fast(texts, add_special_tokens=False)]


class PieceSide:
    """Ids and bytes for a SentencePiece model that puts a space before every text."""

    def __init__(self, path: str):
        import sentencepiece
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace(MARK, " ").encode()
                      for i, p in enumerate(pieces)]
        self._space = self._model.piece_to_id(MARK)
        self._before = self._model.encode(ANCHOR)
        special = (self._model.is_byte, self._model.is_control, self._model.is_unknown)
        self.spans_cuts = any(len(SEGMENT.findall(p.replace(MARK, " "))) > 1 for i, p in enumerate(pieces)
                              if UNCUT not in p and not any(test(i) for test in special))

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts or segments. A space at their start stands for the one the model adds;
        a segment that starts otherwise is read behind a word, of which it is cut off anyway."""
        ids = self._model.encode([t[1:] if t[0] == " " else ANCHOR + t for t in texts], num_threads=1)
        return [i[len(self._before):] if t[0] != " " else i if t != " " else [self._space] for t, i in zip(texts, ids)]


# --- Alignment ------------------------------------------------------------------------

def diagonal_groups(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """How many tokens of A and of B there are up to the end of each group.

    Ends rise strictly and the last ones are equal.
    """
    n = len(ends_a)
    after_a, after_b = [], []
    i = j = 0
    while i < n:
        first_i, first_j, step = i, j, 1
        while i + step <= n and ends_a[i:i + step] == ends_b[j:j + step]:
            i, j, step = i + step, j + step, 2 * step
        while step > 1:  # less than a step is left of the stretch
            step //= 2
            if i + step <= n and ends_a[i:i + step] == ends_b[j:j + step]:
                i, j = i + step, j + step
        if i > first_i:
            after_a.extend(range(first_i + 1, i + 1))
            after_b.extend(range(first_j + 1, j + 1))
        if i == n:
            break
        x, y = ends_a[i], ends_b[j]
        while x != y:
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
        i += 1
        j += 1
        after_a.append(i)
        after_b.append(j)
    return after_a, after_b


class Alignment:
    """Groups of two id arrays over the same bytes."""

    def __init__(self, a: np.ndarray, b: np.ndarray, lengths_a: np.ndarray, lengths_b: np.ndarray):
        self.a, self.b = a, b
        #: Bytes and tokens of either side up to the end of each group.
        ends = np.cumsum(lengths_a[a])
        self.after_a, self.after_b = (np.array(x, np.int64) for x in diagonal_groups(
            ends.tolist(), np.cumsum(lengths_b[b]).tolist()))
        self.ends = ends[self.after_a - 1]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Linked id pairs (a << 32 | b) of each group, the links of each, and the group.

        Ids that repeat inside a group are counted, not expanded.
        """
        groups = np.arange(len(self.after_a))
        a, times_a, group_a = _distinct(self.a, np.repeat(groups, np.diff(self.after_a, prepend=0)))
        b, times_b, group_b = _distinct(self.b, np.repeat(groups, np.diff(self.after_b, prepend=0)))
        first = np.searchsorted(group_b, groups)
        many = np.diff(np.append(first, len(b)))[group_a]
        right = _ranges(first[group_a], many)
        return np.repeat(a, many) << 32 | b[right], np.repeat(times_a, many) * times_b[right], np.repeat(group_a, many)


def _distinct(ids, groups):
    """Distinct ids of each group, their number in it and their group, by group."""
    both, many = np.unique(groups << 32 | ids, return_counts=True)
    return both & 0xFFFFFFFF, many, both >> 32


def _ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers from first[k] on, many[k] of them, for all k in a row."""
    return np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())


def summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and the sum of their times."""
    if not len(codes):
        return codes, times
    order = np.argsort(codes)
    codes = codes[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[starts], np.add.reduceat(times[order], starts)


# --- Texts by their segments ------------------------------------------------------------

class GroupText:
    """Writes groups as `a1,a2|b1;a3|b2,b3`: every id is looked up together with the mark after it."""

    def __init__(self, n_a: int, n_b: int):
        self._n_a, self._n_b = n_a, n_b
        self._words = [f"{i}{mark}" for n, marks in ((n_a, ",|"), (n_b, ",;\n")) for mark in marks for i in range(n)]

    def __call__(self, found: Alignment, last: np.ndarray) -> list[str]:
        """A text for each row of groups; `last` has the number of the last group of each."""
        code_a, code_b = found.a.copy(), found.b + 2 * self._n_a
        code_a[found.after_a - 1] += self._n_a
        code_b[found.after_b - 1] += self._n_b
        code_b[found.after_b[last] - 1] += self._n_b
        # An A token stands behind the B tokens of earlier groups, a B token behind the A tokens up to its group.
        n_a, n_b = np.diff(found.after_a, prepend=0), np.diff(found.after_b, prepend=0)
        out = np.empty(len(code_a) + len(code_b), np.int64)
        out[np.arange(len(code_a)) + np.repeat(found.after_b - n_b, n_a)] = code_a
        out[np.arange(len(code_b)) + np.repeat(found.after_a, n_b)] = code_b
        return "".join(map(self._words.__getitem__, out.tolist())).split("\n")[:-1]


class Segments(dict):
    """Segment to its number. New ones are encoded and aligned together, one after the other."""

    def __init__(self, a: ByteLevelSide, b: PieceSide):
        super().__init__()
        self._sides = a, b
        self._lengths = [np.array([len(raw) for raw in side.bytes], np.int64) for side in self._sides]
        self._writer = GroupText(*map(len, self._lengths))
        self._start_over()

    def _start_over(self) -> None:
        self.clear()
        self._chars = 0
        self.whole, self.texts = np.empty(0, bool), []
        self.sizes = np.empty((0, 3), np.int64)  # A tokens, B tokens, groups
        self.codes, self.times, self.starts = np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(1, np.int64)

    def learn(self, segments: set[str]) -> None:
        """Encode and align what is new. Beyond the bound, older segments are forgotten."""
        new = [s for s in segments if s not in self]
        if len(self) + len(new) > REMEMBER or self._chars > REMEMBER_CHARS:
            self._start_over()
            new = list(segments)
        if not new:
            return
        self._chars += sum(map(len, new))
        self.update(zip(new, range(len(self), len(self) + len(new))))
        raw = [s.encode() for s in new]
        sizes = _lengths(raw)
        whole, sides = np.ones(len(new), bool), []
        for side, lengths in zip(self._sides, self._lengths):
            ids = side.encode(new)
            flat, many = np.array(list(chain.from_iterable(ids)), np.int64), _lengths(ids)
            same = np.bincount(np.repeat(np.arange(len(new)), many), lengths[flat], len(new)) == sizes
            if not (same.all() and _joined(side, flat.tolist()) == b"".join(raw)):
                same &= [_joined(side, own) == r for own, r in zip(ids, raw)]
            whole &= same & np.array([s != UNCUT for s in new])
            sides.append((flat, many))
        # Segments that do not come back count as empty here; their texts are encoded as wholes.
        (a, n_a), (b, n_b) = ((flat[np.repeat(whole, many)], many * whole) for flat, many in sides)
        found = self.align(a, b)
        groups = np.searchsorted(found.ends, np.cumsum(sizes * whole), "right")  # of all segments up to this one
        texts = iter(self._writer(found, groups[whole] - 1))
        self.texts.extend(next(texts) if fine else "" for fine in whole.tolist())
        codes, times, group = found.links()
        self.whole = np.concatenate([self.whole, whole])
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, np.diff(groups, prepend=0)], axis=1)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.searchsorted(group, groups)])
        self.codes, self.times = np.concatenate([self.codes, codes]), np.concatenate([self.times, times])

    def align(self, a: np.ndarray, b: np.ndarray) -> Alignment:
        return Alignment(a, b, *self._lengths)

    def documents(self, texts: list[str]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
        """Per non-empty text: (n_a, n_b, n_groups, n_links, groups_sha256), distinct codes, their links."""
        parts = [SEGMENT.findall(" " + t) if UNCUT not in t else [UNCUT] for t in texts]
        self.learn(set(chain.from_iterable(parts)))
        many = _lengths(parts)
        numbers = np.fromiter(map(self.__getitem__, chain.from_iterable(parts)), np.int64, many.sum())
        first = np.cumsum(many) - many
        sizes, whole = np.add.reduceat(self.sizes[numbers], first), np.logical_and.reduceat(self.whole[numbers], first)
        from_code = self.starts[numbers]
        n_codes = self.starts[numbers + 1] - from_code
        places = _ranges(from_code, n_codes)
        codes, times, ends = self.codes[places], self.times[places], np.cumsum(np.add.reduceat(n_codes, first))
        groups, start, at = list(map(self.texts.__getitem__, numbers.tolist())), 0, 0
        for k, (text, own, end) in enumerate(zip(texts, many.tolist(), ends.tolist())):
            if whole[k]:
                found = summed(codes[start:end], times[start:end])
                yield (*sizes[k].tolist(), int(found[1].sum()), _sha256(";".join(groups[at:at + own]))), *found
            else:
                yield self.whole_text(" " + text)
            start, at = end, at + own

    def whole_text(self, text: str) -> tuple[tuple, np.ndarray, np.ndarray]:
        """The plain way for one text that begins with its space: encode, join, compare, align."""
        raw, (a, b) = text.encode(), [side.encode([text])[0] for side in self._sides]
        if any(_joined(side, ids) != raw for side, ids in zip(self._sides, (a, b))):
            return (0, 0, 0, 0, ""), np.empty(0, np.int64), np.empty(0, np.int64)
        found = self.align(np.array(a), np.array(b))
        codes, times = summed(*found.links()[:2])
        return (len(a), len(b), len(found.ends), int(times.sum()), _sha256(self._writer(found, np.array([-1]))[0])), codes, times


def _joined(side, ids: list[int]) -> bytes:
    return b"".join([side.bytes[i] for i in ids])


def _lengths(rows: list[list]) -> np.ndarray:
    return np.array(list(map(len, rows)), np.int64)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- Blocks ---------------------------------------------------------------------------

ALIGNED = ("block string, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
           "groups_sha256 string, pairs binary, times binary, codes array<long>, docs array<int>")


class Block:
    """Documents that share a dictionary of id pairs."""

    def __init__(self):
        self._rows, self._codes, self._times, self._entries = [], [], [], 0

    def add(self, row: tuple, codes: np.ndarray, times: np.ndarray) -> bool:
        """Take a document; true if the block is full."""
        self._rows.append(row)
        self._codes.append(codes)
        self._times.append(times)
        self._entries += len(codes)
        return len(self._rows) >= BLOCK_DOCS or self._entries >= BLOCK_PAIRS

    def batch(self) -> pa.RecordBatch:
        """A row per document and one for the dictionary."""
        name, pack = uuid.uuid4().hex, zstandard.ZstdCompressor(level=1).compress
        codes, number, docs = np.unique(
            np.concatenate(self._codes), return_inverse=True, return_counts=True)
        pairs, times, at = [], [], 0
        for own, links in zip(self._codes, self._times):
            places = number[at:at + len(own)]
            at += len(own)
            pairs.append(pack(np.diff(places, prepend=0).astype(np.uint32).view(np.uint8)
                              .reshape(-1, 4).T.tobytes()))
            times.append(pack(links.view(np.uint8).reshape(-1, 8).T.tobytes()))
        columns = list(zip(*[(name, *row, p, t, None, None) for row, p, t in zip(self._rows, pairs, times)],
                           (name, None, None, None, None, None, None, None, None, codes, docs.astype(np.int32))))
        types = [pa.string(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary(),
                 pa.list_(pa.int64()), pa.list_(pa.int32())]
        names = [field.split()[0] for field in ALIGNED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _planes(packed: bytes, kind, width: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def chunks(ids: list, texts: list) -> Iterator[tuple[list, list]]:
    """Slices of a batch with about CHUNK_CHARS of text each."""
    start = chars = 0
    for i, text in enumerate(texts):
        chars += len(text or "")
        if chars >= CHUNK_CHARS:
            yield ids[start:i + 1], texts[start:i + 1]
            start, chars = i + 1, 0
    if start < len(texts):
        yield ids[start:], texts[start:]


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """First pass: a row per document with its groups and numbered pairs, and a row per block."""
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        sides = ByteLevelSide(path_a), PieceSide(path_b)
        if sides[1].spans_cuts:
            raise ValueError(f"{path_b}: pieces go over the places where segments are cut")
        segments, block = Segments(*sides), Block()
        nothing = (0, 0, 0, 0, ""), np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            ids, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))
            for some, own in chunks(ids, texts):
                found = segments.documents([t for t in own if t]) if any(own) else iter(())
                for doc_id, text in zip(some, own):
                    row, codes, times = next(found) if text else nothing
                    if block.add((doc_id, *row), codes, times):
                        yield block.batch()
                        block = Block()
        if block._rows:
            yield block.batch()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(code, count, best) per id pair of the corpus: in how many documents it is linked, and whether
    no pair of its A id has more."""
    totals = (rows.where("codes IS NOT NULL").select(F.explode(F.arrays_zip("codes", "docs")).alias("e"))
              .groupBy(F.col("e.codes").alias("code")).agg(F.sum("e.docs").alias("count")))
    totals = stored(totals, "pair-counts")
    a = F.shiftright("code", 32).alias("a")
    highest = totals.groupBy(a).agg(F.max("count").alias("highest"))
    return totals.withColumn("a", a).join(highest, "a").select(
        "code", "count", (F.col("count") == F.col("highest")).alias("best"))


DIGESTS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def token_links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: tokens, groups and links, and the links' counts over the corpus."""
    rows = stored(aligned(docs, path_a, path_b), "aligned")
    asked = rows.where("codes IS NOT NULL").select("block", F.explode("codes").alias("code"))
    answers = asked.join(pair_counts(rows), "code").select(F.col("block").alias("asking"), "code", "count", "best")
    per_doc = rows.where("codes IS NULL").select(
        "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")

    def run(documents, counted):
        order = np.argsort(counted.column("code").to_numpy())
        count = counted.column("count").to_numpy()[order]
        best = counted.column("best").to_numpy()[order].astype(np.int64)
        n_best, count_sum = [], []
        for packed, links in zip(documents.column("pairs").to_pylist(), documents.column("times").to_pylist()):
            places, times = np.cumsum(_planes(packed, np.uint32, 4)), _planes(links, np.int64, 8)
            n_best.append(int((times * best[places]).sum()))
            count_sum.append(int((times * count[places]).sum()))
        return pa.table({**{c: documents.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
                         "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                         "groups_sha256": documents.column("groups_sha256")})

    return per_doc.groupBy("block").cogroup(answers.groupBy("asking")).applyInArrow(run, DIGESTS)
