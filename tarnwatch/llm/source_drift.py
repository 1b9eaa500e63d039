"""Divergence between the sources of a language from run-length encoded columns.

The kept vocabulary of a language is put into one order, by the counts of its largest sources, so that
terms with equal counts lie together. Along that order a source's counts are one column, stored as
runs: where each begins and its count. The vocabulary is cut into segments of about SEGMENT_TERMS, so a
frequent language is many segments. Two sources are compared run by run: their boundaries are
intersected, and the difference of the two probabilities is multiplied by the length of each
piece. A task holds one segment and two blocks of at most TILE sources; sums of segments are added up.

Probabilities are integers, p = 1 + floor(10^9 * (count + 5) / (N + 5 V)), N the source's words of
the V kept terms; every number is exact, beyond 64 bits too.

Counting: a task adds up its words per (lang, source, term) before anything is shuffled, in
a table that is emptied whenever it holds FLUSH entries; a term counts once per document and task
flush, whatever its length.

Defined cases: null text, lang and source are ''; a group without kept terms has N = 0 and takes part; a
language without kept terms gives 0 for every pair and no terms; a language with one source has no
pairs; equal rows count as often as they come; doc_id is not used.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.bounded import stored

MIN_DOCS, TOP_TERMS = 30, 50
SCALE, PRIOR = 10 ** 9, 5
FLUSH = 200_000
PIECE = 1 << 20
SEGMENT_TERMS, TILE, ORDER_BY = 20_000, 64, 8

#: Bytes of terms stay, A-Z are lowered, all else is space. Bytes from 0x80 on belong to terms.
LETTERS = bytes(b + 32 if b in string.ascii_uppercase.encode() else b if b in string.ascii_lowercase.encode() or b > 0x7F
                else 0x20 for b in range(256))


# --- Counts -------------------------------------------------------------------------------

def pieces(raw: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, in lists of bounded size."""
    start = 0
    while start < len(raw):
        end = min(start + PIECE, len(raw))
        while end < len(raw) and LETTERS[raw[end]] != 0x20:
            end += 1
        yield raw[start:end].translate(LETTERS).split()
        start = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): partial sums. A row with a null term for each group."""
    def run(batches):
        counts, held, groups = {}, {}, set()

        def emptied() -> pa.RecordBatch:
            keys = [(*group, term, n, held[group][term]) for group, own in counts.items() for term, n in own.items()]
            counts.clear()
            held.clear()
            columns = list(zip(*keys)) or [()] * 5
            types = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              names=["lang", "source", "term", "count", "docs"])

        for batch in batches:
            for text, *group in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
                group = tuple(group)
                groups.add(group)
                seen = set()
                for terms in pieces(text):
                    counts.setdefault(group, Counter()).update(terms)
                    seen.update(terms)
                held.setdefault(group, Counter()).update(seen)
                if sum(map(len, counts.values())) > FLUSH:
                    yield emptied()
        yield emptied()
        if groups:
            lang, source = zip(*groups)
            nothing = [None] * len(groups)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang), pa.array(source), pa.array(nothing, pa.binary()), pa.array(nothing, pa.int64()),
                 pa.array(nothing, pa.int64())], names=["lang", "source", "term", "count", "docs"])

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    return docs.select(text[0].cast("binary").alias("text"), *text[1:]).mapInArrow(
        run, "lang string, source string, term binary, count long, docs long")


def kept_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, count, total) of kept terms, and (lang, source, number, n, v, lang_n) per group.

    `number` ranks the sources of a language by their words, from 0.
    """
    counts = stored(term_counts(docs).groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")), "term-counts")
    terms = counts.where("term IS NOT NULL")
    kept = terms.groupBy("lang", "term").agg(
        F.sum("count").alias("total"), F.sum("docs").alias("held")).where(F.col("held") >= MIN_DOCS).drop("held")
    entries = stored(terms.drop("docs").join(kept, ["lang", "term"]), "kept-terms")
    sizes = entries.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    languages = entries.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang").agg(
        F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    n = F.coalesce("n", F.lit(0))
    by_size = Window.partitionBy("lang").orderBy(n.desc(), "source")
    groups = counts.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(
        languages, "lang", "left").select(
        "lang", "source", (F.row_number().over(by_size) - 1).alias("number"), n.alias("n"),
        F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"))
    return entries, stored(groups, "groups")


# --- Run-length columns -------------------------------------------------------------------

def vocabulary_order(entries: DataFrame, groups: DataFrame, segment_terms: int) -> DataFrame:
    """(lang, term, segment, place): the vocabulary in the order of its counts, largest sources first."""
    largest = groups.where(F.col("number") < ORDER_BY).select("lang", "source", "number")
    keys = [f"c{k}" for k in range(ORDER_BY)]
    rows = entries.join(largest, ["lang", "source"], "left").groupBy("lang", "term").agg(*[
        F.coalesce(F.max(F.when(F.col("number") == k, F.col("count"))), F.lit(0)).alias(c) for k, c in enumerate(keys)])
    rows = stored(rows, "vocabulary")
    parts = max(1, -(-rows.count() // segment_terms))
    placed = rows.repartitionByRange(parts, "lang", *keys, "term").sortWithinPartitions("lang", *keys, "term")
    row = F.monotonically_increasing_id()  # the partition's number above 33 bits, the place in it below
    placed = placed.withColumn("at", row).select(
        "lang", "term", F.shiftright("at", 33).cast("int").alias("segment"),
        F.col("at").bitwiseAND(F.lit(2 ** 33 - 1)).alias("place"))
    return stored(placed, "order")


def run_lengths(places: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal counts begins, and its count; places that are not listed count 0."""
    column = np.zeros(length, np.int64)
    column[places] = counts
    starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]]) if length else np.empty(0, np.int64)
    return starts, column[starts]


def encoded_columns(entries: DataFrame, groups: DataFrame, order: DataFrame) -> DataFrame:
    """(lang, segment, length, source, number, n, v, starts, counts): every source's column of every segment.

    A language without vocabulary has one segment without terms.
    """
    segments = order.groupBy("lang", "segment").agg(
        F.min("place").alias("first"), F.count("*").cast("int").alias("length"))
    placed = entries.join(order, ["lang", "term"]).join(segments, ["lang", "segment"]).join(
        groups.select("lang", "source", "number"), ["lang", "source"]).select(
        "lang", "segment", "number", "length", (F.col("place") - F.col("first")).cast("int").alias("at"), "count")

    def run(key, rows):
        starts, counts = run_lengths(
            rows.column("at").to_numpy(), rows.column("count").to_numpy(), rows.column("length")[0].as_py())
        lang, segment, number = key
        return pa.table({"c_lang": [lang.as_py()], "c_segment": pa.array([segment.as_py()], pa.int32()),
                         "c_number": pa.array([number.as_py()], pa.int32()),
                         "starts": pa.array([starts], pa.list_(pa.int32())),
                         "counts": pa.array([counts], pa.list_(pa.int64()))})

    columns = placed.groupBy("lang", "segment", "number").applyInArrow(
        run, "c_lang string, c_segment int, c_number int, starts array<int>, counts array<long>")
    everywhere = groups.join(segments.drop("first"), "lang", "left").withColumns({
        "segment": F.coalesce("segment", F.lit(0)), "length": F.coalesce("length", F.lit(0))})
    same = ((F.col("lang") == F.col("c_lang")) & (F.col("segment") == F.col("c_segment"))
            & (F.col("number") == F.col("c_number")))
    return everywhere.join(columns, same, "left").select(
        "lang", "segment", "length", "source", "number", "n", "v",
        F.coalesce("starts", F.array(F.lit(0))).alias("starts"),
        F.coalesce("counts", F.array(F.lit(0).cast("long"))).alias("counts"))


# --- Divergence ---------------------------------------------------------------------------

def probability(count: Column, n: Column, v: Column) -> Column:
    """p in whole numbers of 10^-9, by decimals of 38 digits."""
    over = (count + F.lit(PRIOR)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(12,0)")
    under = (n.cast("decimal(20,0)") + v.cast("decimal(18,0)") * F.lit(PRIOR).cast("decimal(1,0)")).cast("decimal(24,0)")
    return F.call_function("div", over, under) + F.lit(1).cast("long")


def probabilities(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """The same for the runs of a column."""
    if not len(counts) or not n + PRIOR * v:
        return np.zeros(len(counts), np.int64)
    if int(counts.max()) + PRIOR >= 2 ** 63 // SCALE:
        counts = counts.astype(object)
    return (1 + SCALE * (counts + PRIOR) // (n + PRIOR * v)).astype(np.int64)


def run_divergence(starts_a, p_a, starts_b, p_b, length: int) -> int:
    """Sum of |p_a - p_b| over all places: the pieces between the boundaries of both, by their lengths."""
    cuts = np.union1d(starts_a, starts_b)
    pieces = np.diff(np.append(cuts, length))
    gap = np.abs(p_a[np.searchsorted(starts_a, cuts, "right") - 1] - p_b[np.searchsorted(starts_b, cuts, "right") - 1])
    return int(gap @ pieces)


def pair_divergence(columns: DataFrame, tile: int) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, in both directions."""
    blocks = columns.groupBy("lang").agg(F.floor(F.max("number") / tile).cast("int").alias("last"))
    own = F.floor(F.col("number") / tile).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("last")))
    # A cell is one key: a language is dealt by its segments and blocks, not as a whole.
    cells = columns.join(blocks, "lang").withColumn("own", own).withColumn("other", other).withColumn(
        "cell", F.struct("lang", "segment", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))

    def run(key, rows):
        lang, _, i, j = key[0].as_py().values()
        rows = rows.select(["length", "source", "own", "n", "v", "starts", "counts"]).to_pylist()
        for row in rows:
            row["at"], row["p"] = np.array(row["starts"]), probabilities(np.array(row["counts"], np.int64), row["n"], row["v"])
        left = [r for r in rows if r["own"] == i]
        found = []
        for k, a in enumerate(left):
            for b in left[k + 1:] if i == j else (r for r in rows if r["own"] == j):
                value = run_divergence(a["at"], a["p"], b["at"], b["p"], a["length"]) if a["length"] else 0
                found += (a["source"], b["source"], value), (b["source"], a["source"], value)
        source, item, value = zip(*found) if found else ((), (), ())
        return pa.table({"lang": pa.array([lang] * len(found), pa.string()), "source": pa.array(source, pa.string()),
                         "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64())})

    parts = cells.drop("lang", "segment", "other", "last").groupBy("cell").applyInArrow(run, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_divergence(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for the terms that a source uses more than its language."""
    rows = entries.join(groups.drop("number"), ["lang", "source"])
    p = probability(F.col("count"), F.col("n"), F.col("v"))
    q = probability(F.col("total"), F.col("lang_n"), F.col("v"))
    return rows.select("lang", "source", F.col("term").cast("string").alias("item"), (p - q).alias("value")).where("value > 0")


def ranked(found: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def source_divergence(docs: DataFrame, segment_terms: int = SEGMENT_TERMS, tile: int = TILE,
                      top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` ranks the other sources of the language by
    their divergence, part `term` the terms that set a source apart from its language."""
    entries, groups = kept_counts(docs)
    columns = stored(encoded_columns(entries, groups, vocabulary_order(entries, groups, segment_terms)), "run-lengths")
    pairs = ranked(pair_divergence(columns, tile), "pair")
    terms = ranked(term_divergence(entries, groups), "term").where(F.col("rank") <= top_terms)
    return pairs.unionAll(terms)
