"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window is 13 consecutive words of an item (all words of a shorter item). Windows and documents
are seen as sets of word shingles; a window can only occur in a document that holds all of its
shingles, so its prefix is one shingle: the rarest in the documents. One scan reduces the documents
to the shingles that any item has, each with the few words around it that a window through it
can cover. They are counted; windows with a shingle that occurs nowhere are out, the others are
joined by their rarest shingle alone. Its position fixes where the window would begin, the lengths
of text and item bound it, and what is left is compared word by word. The same scan gives every
document's number of words.

The scan first asks for a shingle's bucket of BUCKETS (a list of at most so many numbers, whatever
the benchmark's size) and then joins what passes. Tables made from the benchmark are written before
they are joined, so that Spark knows their size and broadcasts them only below its own threshold;
else the join is shuffled.

Defined cases: null and empty texts have no words and are never hit; an item without words has no
windows; repeated item_ids are one item, a null one is named "null"; copies of a document get
the same result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.bounded import stored
from .shared import keyed, row_key

WINDOW, SHINGLE = 13, 5
BUCKETS = 1 << 16
#: All that is no word: a word has digits, letters and characters beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; the quick way where the text is plain ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: str | Column) -> Column:
    """The words of a text, A-Z in lower case; an empty array for null."""
    cut = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)
    first = F.when(F.element_at(cut, 1) == "", 2).otherwise(1)
    last = F.when(F.element_at(cut, -1) == "", F.size(cut) - 1).otherwise(F.size(cut))
    return F.slice(cut, first, F.greatest(last - first + 1, F.lit(0)))


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_words, n, length, step): length of a window, words of a shingle."""
    return (
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
                         words_of(F.col("text")).alias("item_words"))
        .withColumn("n", F.size("item_words")).where("n > 0").distinct()
        .withColumn("row", F.xxhash64("item_id", "item_words"))
        .withColumn("length", F.least(F.lit(WINDOW), F.col("n")))
        .withColumn("step", F.least(F.lit(SHINGLE), F.col("n")))
    )


def item_shingles(items: DataFrame) -> DataFrame:
    """(row, at, step, shingle) for every place of every item."""
    each = F.transform(F.sequence(F.lit(0), F.col("n") - F.col("step")),
                       lambda i: F.array_join(F.slice("item_words", i + 1, F.col("step")), " "))
    return items.select("row", "step", F.posexplode(each).alias("at", "shingle"))


def bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS))


def scanned(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """(doc_id, row_key, head, known, place, n_words, shingle, left, context) from one scan of the texts.

    `known` rows are document shingles that some item has: `context` holds the words that windows
    through the shingle may cover, `left` of them before it. Each document has one `head` row, with
    its number of words; it may be a known one, else its key in `shingle` is its own.
    """
    vocabulary = stored(shingles.select("step", "shingle").distinct(), "vocabulary")
    parts = F.split("shingle", " ")
    asked: dict[int, list[int]] = {}  # at most SHINGLE lists of at most BUCKETS numbers
    for step in range(1, SHINGLE + 1):
        own = vocabulary.where(F.col("step") == step)
        rows = own.select(bucket(*[F.get(parts, F.lit(i)) for i in range(step)])).distinct().collect()
        if rows:
            asked[step] = sorted(r[0] for r in rows)
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"),
                        words_of(F.col("text")).alias("words"))
    placed = words.select("*", F.posexplode_outer("words").alias("place", "word"))
    place, size = F.coalesce("place", F.lit(0)), F.size("words")
    found = None
    for step, buckets in (asked or {SHINGLE: []}).items():
        own = [F.col("word"), *[F.get("words", place + i) for i in range(1, step)]]
        reach = WINDOW - step
        left = F.least(place, F.lit(reach))
        hit = (place + step <= size) & bucket(*own).isin(buckets)
        head = (place == 0) if found is None else F.lit(False)
        # Heads have keys of their own, so that no key of the join below is shared by all of them.
        part = placed.where(hit | head).select(
            "doc_id", "row_key", head.alias("head"), place.alias("place"), size.alias("n_words"),
            F.when(hit, F.concat_ws(" ", *own)).otherwise(F.concat(F.lit("|"), "row_key")).alias("shingle"),
            left.alias("left"),
            F.when(hit, F.slice("words", place - left + 1, left + step + reach)).alias("context"))
        found = part if found is None else found.unionAll(part)
    marked = vocabulary.select("shingle", F.lit(True).alias("listed"))
    return (found.join(marked, "shingle", "left").withColumn("known", F.coalesce("listed", F.lit(False)))
            .where("head OR known").drop("listed"))


def rarest_shingles(shingles: DataFrame, items: DataFrame, known: DataFrame) -> DataFrame:
    """(shingle, row, item_id, length, at, first, last): the prefix of every window that may occur.

    Windows of an item that share their rarest shingle, at the same place, are one row with the
    first and last start.
    """
    counts = known.groupBy("shingle").agg(F.count("*").alias("seen"))
    counted = stored(shingles.join(counts, "shingle", "left").fillna(0, ["seen"]), "counted")
    windows = items.select(
        "row", "item_id", "length", "step",
        F.explode(F.sequence(F.lit(0), F.col("n") - F.col("length"))).alias("start"))
    inside = windows.withColumn("at", F.explode(
        F.sequence(F.col("start"), F.col("start") + F.col("length") - F.col("step")))).drop("step")
    rarest = inside.join(counted, ["row", "at"]).groupBy("row", "item_id", "length", "start").agg(
        F.min(F.struct("seen", "at", "shingle")).alias("rarest"))
    return (rarest.where("rarest.seen > 0")
            .groupBy("row", "item_id", "length", F.col("rarest.at").alias("at"),
                     F.col("rarest.shingle").alias("shingle"))
            .agg(F.min("start").alias("first"), F.max("start").alias("last")))


def occurrences(items: DataFrame, shingles: DataFrame, known: DataFrame) -> DataFrame:
    """(row_key, item_id, from, length, starts): document places where windows of an item occur.

    `from` is the document place of the item's first word, `starts` the item places of the windows.
    """
    prefix = stored(rarest_shingles(shingles, items, known), "prefix")
    origin = F.col("place") - F.col("at")
    bounded = (
        known.join(prefix, "shingle")
        .select("*", origin.alias("from"), F.greatest(F.col("first"), -origin).alias("low"),
                F.least(F.col("last"), F.col("n_words") - F.col("length") - origin).alias("high"))
        .where("low <= high").join(items.select("row", "item_words"), "row"))
    equal = F.filter(F.sequence("low", "high"), lambda s: F.slice(
        "context", F.col("from") + s - F.col("place") + F.col("left") + 1, F.col("length")
    ) == F.slice("item_words", s + 1, F.col("length")))
    return (bounded.withColumn("starts", equal).where(F.size("starts") > 0)
            .select("row_key", "item_id", "from", "length", "starts").distinct())


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    items = stored(item_words(benchmark), "items")
    shingles = stored(item_shingles(items), "item-shingles")
    scan = stored(scanned(docs, shingles), "scanned")
    known = scan.where("known").select("row_key", "place", "n_words", "shingle", "left", "context")
    found = stored(occurrences(items, shingles, known), "occurrences")
    places = F.flatten(F.transform("starts", lambda s: F.sequence(
        F.col("from") + s, F.col("from") + s + F.col("length") - 1)))
    hit = (found.select("row_key", F.explode(F.array_distinct(places)).alias("place")).distinct()
           .groupBy("row_key").agg(F.count("*").alias("n_hit")))
    items = found.select("row_key", "item_id").distinct().groupBy("row_key").agg(
        F.count("*").alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("items"))
    base = scan.where("head").select("doc_id", "row_key", F.col("n_words").cast("long").alias("n_words"))
    joined = base.join(hit.join(items, "row_key"), "row_key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return joined.select(
        "doc_id", "row_key", "n_words", n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that are not contaminated, with their columns as they are."""
    bad = contamination(docs, benchmark).where("contaminated").select("row_key").distinct()
    return keyed(docs).join(bad, "row_key", "left_anti").select("row.*")
