"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct three-word shingles, hashed to 64 bits. The sketch is one
permutation over 384 buckets; of each bucket's smallest hash it keeps the count of leading
zeros and ten bits after them (16 bits a bucket). Empty buckets borrow from others by a fixed
probe order, so that two sketches agree in a register with the probability of their Jaccard
similarity, for small sets too. Bands of eight registers are the candidate keys: a pair at
similarity 0.85 shares none of the 48 bands in about two of ten million cases, at 0.9 far less.

Documents with equal sets are one class and enter the search once. Candidates of a band key are not
expanded to all pairs: in groups of more than SMALL members, the smallest id is compared with all
others. Where that leaves several components in a group, its members are cut into blocks, and a
task compares two blocks: only members of different components, and only links are
returned. So every two documents that share a band are compared or known to be connected. A pair
is first judged by the collision-corrected estimate of its two sketches, with a margin of six
standard deviations; the pairs that pass are confirmed on the full sets, which candidates carry as
arrays of hashes: no text is read again.

Defined cases: a text without words, or null, has an empty set and is linked with nothing; one or
two words are one shingle; a row without doc_id is linked with nothing, its component is null
and it is kept; rows that share a doc_id but not a text are separate members of the search.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bounded import stored
from .shared import keyed, row_key

SHINGLE = 3
REGISTERS, ROWS = 384, 8
BANDS = REGISTERS // ROWS
MANTISSA = 10
THRESHOLD = (85, 100)
SMALL = 12
BLOCK_ROWS, BLOCK_BYTES = 256, 8 << 20
DEVIATIONS = 6
REMEMBER = 100_000


# --- Sets and sketches (inside tasks) -----------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered while the task runs."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBER:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(raw: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text; `bytes.lower` changes A-Z only."""
    words = raw.lower().split() if raw else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    length = min(n, SHINGLE)
    code = np.full(n - length + 1, np.uint64(length))
    for k in range(length):
        code = _mix(code * np.uint64(0x9E3779B97F4A7C15) + h[k:n - length + 1 + k])
    return np.unique(code)


def probes(registers: int = REGISTERS, tries: int = 64) -> np.ndarray:
    """Which bucket an empty one asks at each try: fixed pseudo-random numbers."""
    n = np.arange(registers * tries, dtype=np.uint64) + np.uint64(1)
    return (_mix(n * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(registers)).astype(np.int64).reshape(tries, registers)


def sketch_of(hashes: np.ndarray, probe: np.ndarray) -> np.ndarray:
    """The 16-bit registers of a non-empty sorted set of hashes."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    low = np.minimum.reduceat(_mix(hashes), starts)
    part, exponent = np.frexp(low.astype(np.float64))
    zeros = np.minimum(64 - exponent, 63)
    bits = np.maximum(((part - 0.5) * 2 ** (MANTISSA + 1)).astype(np.int64), 0)
    registers = np.zeros(REGISTERS, np.uint16)
    registers[bucket[starts]] = zeros * 2 ** MANTISSA + bits
    filled = np.zeros(REGISTERS, bool)
    filled[bucket[starts]] = True
    empty = np.flatnonzero(~filled)
    for row in probe:
        if not len(empty):
            break
        asked = row[empty]
        hit = filled[asked]
        registers[empty[hit]] = registers[asked[hit]]
        empty = empty[~hit]
    if len(empty):  # sparse sets: the next filled bucket
        own = bucket[starts]
        registers[empty] = registers[own[np.searchsorted(own, empty) % len(own)]]
    return registers


def similarity_estimates(a: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
    """Jaccard of one sketch with others from equal registers, less the share that agrees by chance.

    Minima of two unrelated buckets follow exponential laws with rates in proportion to the
    set sizes; they fall in one cell of 2**-MANTISSA of their octave with this probability.
    """
    chance = 0.72 * 2.0 ** -MANTISSA * size * sizes / (size + sizes) ** 2.0
    return np.maximum(0.0, ((others == a).mean(axis=1) - chance) / (1 - chance))


def profiles(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, n_shingles, set_id, sketch) per row; `set_id` names the set, null if empty."""
    def run(batches):
        hashes, probe = WordHashes(), probes()
        for batch in batches:
            sizes, names, sketches = [], [], []
            for raw in batch.column("text").to_pylist():
                codes = shingle_set(raw, hashes)
                sizes.append(len(codes))
                names.append(hashlib.md5(codes.tobytes()).digest() if len(codes) else None)
                sketches.append(sketch_of(codes, probe).tobytes() if len(codes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(names, pa.binary()), pa.array(sketches, pa.binary())],
                names=["row_key", "doc_id", "n_shingles", "set_id", "sketch"])

    return docs.select(
        row_key().alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
    ).mapInArrow(run, "row_key string, doc_id long, n_shingles long, set_id binary, sketch binary")


# --- Candidates and links -----------------------------------------------------------

def band_members(classes: DataFrame) -> DataFrame:
    """(band, node) of the band keys that two or more nodes share."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        i, F.substring(F.col("sketch"), i * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    rows = classes.select(F.explode(keys).alias("band"), "node")
    shared = rows.groupBy("band").agg(
        F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("members"))
    return rows.join(shared.where("first < last").select("band", "members"), "band")


def with_sets(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Classes (set_id, node, n_shingles, sketch) with their sets as `codes`, once each."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(raw, hashes) for raw in batch.column("text").to_pylist()]
            # Rows that share a doc_id with the class but not its set are left out.
            same = [hashlib.md5(s.tobytes()).digest() == name for s, name in zip(sets, batch.column("set_id").to_pylist())]
            kept = [s for s, fits in zip(sets, same) if fits]
            flat = np.concatenate(kept).view(np.int64) if kept else np.empty(0, np.int64)
            codes = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, kept)]), pa.int32()), pa.array(flat))
            rest = batch.select(["set_id", "node", "n_shingles", "sketch"]).filter(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*rest.columns, codes], names=[*rest.schema.names, "codes"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("binary").alias("text"))
    return classes.join(texts, "node").select("set_id", "node", "n_shingles", "sketch", "text").mapInArrow(
        run, "set_id binary, node long, n_shingles long, sketch binary, codes array<long>").dropDuplicates(["set_id", "node"])


def likely_pairs(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """The pairs (a, b) that may be links by their sizes and sketches."""
    over, under = THRESHOLD

    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            sizes = [batch.column(f"n_{s}").to_numpy() for s in "ab"]
            sketches = [batch.column(f"sketch_{s}") for s in "ab"]
            few = np.minimum(*sizes)
            for k in range(batch.num_rows):
                a, b = (np.frombuffer(c[k].as_buffer(), np.uint16) for c in sketches)
                seen = similarity_estimates(a, b[None], sizes[0][k], sizes[1][k:k + 1])[0]
                keep[k] = seen >= over / under - DEVIATIONS * 0.5 / min(REGISTERS, few[k]) ** 0.5
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    def side(s):
        return candidates.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))

    near = F.lit(under) * F.least("n_a", "n_b") >= F.lit(over) * F.greatest("n_a", "n_b")
    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(near)
    return joined.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def confirm(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough: by the estimate first, then exactly."""
    over, under = THRESHOLD

    def side(s):
        return candidates.select(F.col("node").alias(s), F.col("codes").alias(f"codes_{s}"))

    likely = stored(likely_pairs(pairs, candidates).distinct(), "likely")
    both = likely.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", F.size("codes_a").alias("n_a"), F.size("codes_b").alias("n_b"),
        F.size(F.array_intersect("codes_a", "codes_b")).cast("long").alias("common"))
    return both.where(F.lit(under) * F.col("common") >= F.lit(over) * (F.col("n_a") + F.col("n_b") - F.col("common"))
                      ).select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the ends of links (a, b), the component being its smallest node.

    Large and small stars in turn, each a partial minimum per node and a join: hot nodes are
    pre-aggregated and their joins split. Every round is written, so a lost executor costs one round.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u > v").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(lowest.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small.where("u <> v"), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(edges.select("v", "v").distinct())


def linked_classes(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Components of the classes (set_id, node, n_shingles, sketch) that have links."""
    spark = docs.sparkSession
    members = stored(band_members(classes), "members")
    named = members.select("node").distinct()
    candidates = stored(with_sets(classes.join(named, "node", "left_semi"), docs), "candidates")

    few = members.where(F.col("members") <= SMALL).select("band", "node")
    other = few.select("band", F.col("node").alias("b"))
    small = few.withColumnRenamed("node", "a").join(other, "band").where("a < b").select("a", "b")
    large = members.where(F.col("members") > SMALL)
    centre = large.groupBy("band").agg(F.min("node").alias("a"))
    stars = large.join(centre, "band").where("a < node").select("a", F.col("node").alias("b"))
    tried = stored(small.union(stars).distinct(), "pairs")
    links = stored(confirm(tried, candidates), "links")
    labels = components(links)
    cells = stored(open_cells(large, labels, candidates), "cells")
    found = stored(cell_links(cells), "links")
    return labels if found.isEmpty() else components(links.union(found))


def open_cells(large: DataFrame, labels: DataFrame, candidates: DataFrame) -> DataFrame:
    """Members of the groups that the stars left in several components, dealt into square cells.

    Bands that share nodes are one group. Its members are cut into blocks, by number and by bytes;
    a cell holds two blocks, so that every pair of members meets in one cell of bounded size.
    """
    placed = large.join(labels, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("component"))
    unsettled = (placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("node").alias("b"))
        .where("low < high").select("band", "b"))
    still = stored(placed.join(unsettled, "band"), "open")
    groups = components(still.select(F.col("node").alias("a"), "b").distinct())
    rows = (still.select("node", "component").distinct()
            .join(groups.withColumnRenamed("component", "group"), "node").join(candidates, "node"))
    sizes = rows.groupBy("group").agg(F.count("*").alias("n"), F.sum(F.size("codes") * 8).alias("bytes"))
    blocks = sizes.select("group", F.ceil(F.greatest(
        F.col("n") / BLOCK_ROWS, F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    dealt = rows.join(blocks, "group").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (dealt.withColumn("other", other)
            .select("group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "node", "component", "n_shingles", "sketch", "codes"))


def cell_links(cells: DataFrame) -> DataFrame:
    """Links (a, b) between members of a cell's two blocks that lie in different components.

    One link for each member and component is enough to join them.
    """
    over, under = THRESHOLD

    def run(key, rows):
        lists = rows.column("codes").combine_chunks()
        flat, ends = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        sets = [flat[start:end] for start, end in zip(ends, ends[1:])]
        rows = rows.drop_columns(["codes"]).to_pydict()
        i, j = key[1].as_py(), key[2].as_py()
        left = [k for k, b in enumerate(rows["block"]) if b == i]
        right = [k for k, b in enumerate(rows["block"]) if b == j]
        component, size = np.array(rows["component"]), np.array(rows["n_shingles"], np.int64)
        sketches = np.array([np.frombuffer(s, np.uint16) for s in rows["sketch"]])
        a, b = [], []
        if left and right:
            right = np.array(right)
            codes = np.concatenate([sets[k] for k in right])
            owner = np.repeat(np.arange(len(right)), [len(sets[k]) for k in right])
            order = np.argsort(codes, kind="stable")
            codes, owner = codes[order], owner[order]
            exact = np.array([len(sets[k]) for k in right])
        for k in left if len(right) else ():
            low = np.minimum(size[k], size[right])
            seen = similarity_estimates(sketches[k], sketches[right], size[k], size[right])
            margin = DEVIATIONS * 0.5 / np.sqrt(np.minimum(REGISTERS, low))
            likely = (component[right] != component[k]) & (seen >= over / under - margin)
            if not likely.any():
                continue
            first, last = (np.searchsorted(codes, sets[k], side) for side in ("left", "right"))
            many = last - first
            places = np.repeat(first - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
            common = np.bincount(owner[places], minlength=len(right))
            linked = likely & (under * common >= over * (len(sets[k]) + exact - common))
            _, one = np.unique(component[right[linked]], return_index=True)
            for at in right[linked][one]:
                a.append(rows["node"][k])
                b.append(rows["node"][at])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return cells.groupBy("group", "i", "j").applyInArrow(run, "a long, b long")


# --- The operator ----------------------------------------------------------------

def verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: row_key, set_id and the columns of `near_duplicates`."""
    rows = stored(profiles(docs), "profiles")
    filled = rows.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
    classes = stored(filled.groupBy("set_id").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch")), "classes")
    labels = linked_classes(classes, docs)
    named = classes.select("set_id", "node").join(labels, "node", "left").select(
        "set_id", F.coalesce("component", "node").alias("component"))
    whole = rows.select("row_key", "doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return whole.select(
        "row_key", "set_id", "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: n_shingles, component_id (its class's smallest doc_id) and kept."""
    return verdicts(docs).drop("row_key", "set_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates; rows without doc_id stay.

    Rows that share a doc_id are judged each by its own text; of those with equal sets one stays.
    """
    kept = (verdicts(docs).where("kept AND doc_id IS NOT NULL")
            .groupBy("doc_id", F.coalesce(F.hex("set_id"), "row_key")).agg(F.min("row_key").alias("row_key")))
    one = keyed(docs).join(kept, "row_key", "left_semi").dropDuplicates(["row_key"])
    return one.select("row.*").unionAll(docs.where("doc_id IS NULL"))
