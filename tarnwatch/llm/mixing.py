"""Mixing sources to target weights by hash-random order and distributed prefix sums.

Each document gets a pseudo-random key from its id. Within a source the keys are cut into
about sqrt(rows) equal ranges; sizes are summed per range, the few range sums are added up in
order, and a second window adds the documents of one range. So no task sees more than about
sqrt(rows) entries of a source, however large its share, and the prefix sum of every document
is exact. A source's budget is then cut from that order: full passes first, the rest up to the
exact word.

Budgets: sources in code-point order (null last) weigh 5, 2, 1, repeating; together they get
`share` of all words; no source gets more than `most` times its own words, what is over goes
to the others by weight until none is above.

Defined cases: a null text has size 0; a null source is a source of its own, the last; a null id
sorts first in its order; rows with the same id tie and follow by size (equal rows may
swap places, which changes nothing in the result); a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.bounded import stored
from .shared import keyed, row_key, word_count

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
SEED = "mix-1"


def mixing_key(seed: str = SEED) -> Column:
    """32 hex digits that order the documents of a source at random, the same in every run."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """Target words per source from (source, source_size, rows); one row per source.

    The capped shares level out at target = min(most * size, level * weight). In the order of
    cap per weight, the sources that reach their caps come first; `level` follows from the first
    one that does not (from later ones a smaller value would follow).
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.array(*map(F.lit, weights))
    ranked = (
        sources
        .withColumn("weight", F.get(w, ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("reach", F.col("cap") / F.col("weight"))
    )
    order = Window.orderBy("reach", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    spare = (F.sum("source_size").over(everything) * F.lit(float(share))
             - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    levels = ranked.withColumn("level_here", spare / F.sum("weight").over(onward))
    first_free = F.max(F.when(F.col("level_here") < F.col("reach"), F.col("level_here"))).over(everything)
    return levels.select(
        "source", "source_size", "rows",
        F.least("cap", F.coalesce(first_free * F.col("weight"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST,
        seed: str = SEED) -> DataFrame:
    """One row per document: size, source_size, target of its source, and the words taken of it."""
    sized = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"),
        F.col("source").cast("string").alias("source"),
        word_count().alias("size"), mixing_key(seed).alias("key")), "sized")
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = stored(source_targets(totals, weights, share, most), "targets")
    # One row per source; Spark decides by its size whether it is broadcast.
    ranges = F.ceil(F.sqrt("rows"))
    placed = _join_source(sized, targets).withColumn(
        "range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double")
                         / F.lit(2.0 ** 32) * ranges))
    sums = placed.groupBy("source", "range").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("s_source"), F.col("range").alias("s_range"),
        F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("start"))
    inside = (Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    local = placed.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = local.join(starts, F.col("source").eqNullSafe(F.col("s_source"))
                        & (F.col("range") == F.col("s_range")))
    budget = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - passes * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start") - F.col("local")))
    return joined.select(
        "doc_id", "row_key", "source", "size", "source_size", "target",
        (passes * F.col("size") + part).cast("long").alias("taken"))


def _join_source(df: DataFrame, targets: DataFrame) -> DataFrame:
    right = targets.withColumnRenamed("source", "t_source")
    return df.join(right, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")


def leading_words(text: Column, words: Column) -> Column:
    """The text up to the end of its n-th word, white space as it was."""
    # A piece is a word with the white space before it.
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(pieces, 1, words), "")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row for each full pass, and the leading words of the last one.

    Documents of which nothing is taken go; `n_chars` follows the text if the column is there.
    """
    passes = F.floor(F.col("taken") / F.col("size"))
    rest = F.col("taken") % F.col("size")
    # Copies of a row are taken together; a row that the budget cuts is rare, one per source.
    plan = mix(docs).where("taken > 0").groupBy("row_key").agg(
        F.sum(passes).cast("int").alias("m_passes"),
        F.collect_list(F.when(rest > 0, rest.cast("int"))).alias("m_parts"))
    copies = Window.partitionBy("row_key").orderBy(F.lit(0))
    one = keyed(docs).withColumn("m_row", F.row_number().over(copies)).where("m_row = 1")
    words = F.concat(F.array_repeat(F.lit(-1), F.col("m_passes")), F.col("m_parts"))
    out = one.join(plan, "row_key").select("row", F.explode(words).alias("m_words"))
    whole = F.col("m_words") < 0
    text = F.when(whole, F.col("row.text")).otherwise(
        leading_words(F.col("row.text"), F.greatest(F.col("m_words"), F.lit(0))))
    columns = {c: F.col("row")[c] for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(whole, columns["n_chars"]).otherwise(
            F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*[value.alias(name) for name, value in columns.items()])
