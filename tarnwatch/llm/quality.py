"""Quality rules whose cutoffs are certified on labelled holdouts.

Every document is measured over its whole text. A fixed base rule rejects short and
self-repeating texts. Beyond it, each stratum (language) gets a rule: one cutoff per feature, or
none. Labelled texts are dealt by hash into two halves. On the tuning half a ladder of rules is
laid out, one per part of the allowed risk (LEVELS), from loose to strict: feature by feature the
cutoff that gains most, counted on what the features before it left, within what is left of the
part. The other half then tests whole rules, in that order: an exact binomial test at
delta / strata must show that the rule rejects less than `risk` of the good documents; the first
failure ends the ladder. Tests in a fixed order need no correction among themselves and the
strata share the error probability (Bonferroni), so any choice among certified rules keeps the
guarantee: with probability 1 - delta, at most `risk` of the good documents of each stratum that
pass the base rule are rejected. The certified rule that gains most is used, the loosest of
equals; a rule or cutoff that rejects no larger part of the bad than of the good is not used.

With s strata and no good text rejected, a rule is certified from log(delta / s) / log(1 - risk)
good texts in the testing half on (86 for four strata).

Defined cases: null and empty texts have no words and fail the base rule; a null language is
a stratum of its own, apart from an empty one; repeated rows get the same verdict; a document
with several labels counts as good only if all say so, and so do copies of a labelled text in a
stratum, which are one piece of evidence; without labels, or with too few of a stratum to certify
anything, only the base rule rejects.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.bounded import stored
from .shared import Numbering, keyed, row_key

SYMBOLS = b"#*$%&|<>"
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
RISK, DELTA = 0.05, 0.05
#: Parts of the risk that the rules of the ladder may use up on the tuning half.
LEVELS = (0.0, 0.1, 0.25, 0.5, 0.75)
#: No step of a grid: the feature is not used.
UNUSED = 1_000
#: Rule tables of up to this many rows are broadcast; larger ones are joined by key.
BROADCAST_RULES = 100_000

#: Feature: (numerator, denominator, cutoffs). A document goes if its ratio is above the cutoff.
FEATURES = {
    "symbols": ("n_symbols", "n_words", [j / 40 for j in range(1, 41)]),
    "dup_lines": ("n_dup_lines", "n_lines", [j / 20 for j in range(1, 20)]),
    "repeats": ("n_repeat_words", "n_words", [j / 20 for j in range(1, 10)]),
    "word_length": ("word_chars", "n_words", [6 + j / 2 for j in range(1, 21)]),
}

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


# --- Measures of a text ---------------------------------------------------------

def repeated_words(numbers: np.ndarray) -> int:
    """Words covered by three-word windows that occur twice or more."""
    n = len(numbers)
    if n < 4:
        return 0
    _, local = np.unique(numbers, return_inverse=True)
    base = int(local.max()) + 1
    pairs = local[:-1] * base + local[1:]
    if base ** 3 >= 2 ** 62:
        _, pairs = np.unique(pairs, return_inverse=True)
    windows = pairs[:-1] * base + local[2:]
    ordered = np.sort(windows)
    if (ordered[1:] != ordered[:-1]).all():
        return 0
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = count[place] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= again
    return int(covered.sum())


def measures_of(raw: bytes | None, numbering: Numbering) -> tuple[int, ...]:
    """The values of MEASURES for one UTF-8 text."""
    if not raw:
        return (0,) * len(MEASURES)
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    if len(numbering) > 500_000:
        numbering.clear()
    numbers = np.fromiter(map(numbering.__getitem__, words), np.int64, len(words))
    return (
        len(words),
        len(raw.decode("utf-8", "replace")) - sum(raw.count(c) for c in WHITE),
        sum(raw.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(numbers),
        len(lines),
    )


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, stratum, measures): one narrow row per document, over the whole text."""
    schema = "doc_id long, row_key string, stratum string, " + ", ".join(f"{m} long" for m in MEASURES)

    def run(batches):
        numbering = Numbering()
        for batch in batches:
            doc_id, key, stratum, text = batch.columns
            rows = [measures_of(raw, numbering) for raw in text.to_pylist()]
            columns = zip(*rows) if rows else [[]] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [doc_id, key, stratum, *[pa.array(c, pa.int64()) for c in columns]],
                names=["doc_id", "row_key", "stratum", *MEASURES])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"),
        F.coalesce(F.concat(F.lit("lang:"), F.col("lang").cast("string")), F.lit("none")).alias("stratum"),
        F.col("text").cast("binary").alias("text"),
    ).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def feature(name: str) -> Column:
    over, under, _ = FEATURES[name]
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(0.0)


# --- Certified cutoffs ----------------------------------------------------------

def binomial_cdf(k: int, n: int, p: float) -> float:
    """Exact P(Bin(n, p) <= k), from the continued fraction of the incomplete beta function."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1, 1 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1.0 - front * _beta_fraction(b, a, 1 - x) / b
    return front * _beta_fraction(a, b, x) / a


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction by Lentz's method."""
    tiny, value, c, d = 1e-300, 1.0, 1.0, 0.0
    for i in range(100_000):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + term * d or tiny)
        c = 1 + term / c or tiny
        value *= c * d
        if i and abs(c * d - 1) < 1e-14:
            break
    return value - 1


def labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled texts that pass the base rule, one row per stratum and text: (stratum, good, tuning, step
    per feature). A step is the number of cutoffs of the feature that the text is above."""
    votes = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("good")))
    steps = [reduce(lambda a, b: a + b, [(feature(f) > c).cast("int") for c in cutoffs]).alias(f)
             for f, (_, _, cutoffs) in FEATURES.items()]
    # The text's hash is the middle part of a row key.
    text_key = F.split("row_key", r"\|", 3)[1].alias("text_key")
    texts = (measured.where(~base_failed()).join(votes, "doc_id")
             .select("stratum", text_key, (F.col("good") > 0).alias("good"), *steps)
             .groupBy("stratum", "text_key")
             .agg(F.min("good").alias("good"), *[F.first(f).alias(f) for f in FEATURES]))
    tuning = F.pmod(F.xxhash64("text_key", F.lit("fold")), F.lit(2)) == 0
    return texts.select("stratum", "good", tuning.alias("tuning"), *FEATURES)


def choose_cutoffs(holdout: DataFrame, risk: float = RISK,
                   delta: float = DELTA) -> dict[tuple[str, str], float]:
    """Cutoff per (stratum, feature); only counts per stratum, level and grid step reach the driver."""
    ladder = _ladder(holdout.where("tuning"), risk)
    strata = {r.stratum for r in holdout.select("stratum").distinct().collect()}
    counts = _rejections(holdout, ladder)
    chosen = {}
    for s in sorted(strata):
        best, most = None, 0.0
        for level in range(len(LEVELS)):
            good, rejected = counts.get((s, level, False, True), (0, 0))
            if not good or binomial_cdf(rejected, good, risk) > delta / len(strata):
                break
            parts = {g: [sum(counts.get((s, level, t, g), (0, 0))[i] for t in (True, False)) for i in (0, 1)]
                     for g in (True, False)}
            gain = parts[False][1] / max(1, parts[False][0]) - parts[True][1] / max(1, parts[True][0])
            if gain > most:
                best, most = level, gain
        if best is not None:
            chosen |= {(s, f): FEATURES[f][2][step - 1] for f, step in ladder[s, best].items()}
    return chosen


def _ladder(tuning: DataFrame, risk: float) -> dict[tuple[str, int], dict[str, int]]:
    """Per (stratum, level) the step of each feature used: texts at or above it go."""
    totals = {(r[0], r[1]): r[2] for r in tuning.groupBy("stratum", "good").count().collect()}
    rules = {(s, level): {} for s in sorted({s for s, _ in totals}) for level in range(len(LEVELS))}
    room = {(s, level): LEVELS[level] * risk * totals.get((s, True), 0) for s, level in rules}
    for f, (_, _, cutoffs) in FEATURES.items():
        left = (_with_rules(tuning, rules).where(~_goes())
                .groupBy("stratum", "level", "good", f).count().collect())
        at = {tuple(r[:4]): r[4] for r in left}
        for s, level in rules:
            good, bad = ([sum(at.get((s, level, g, j), 0) for j in range(i, len(cutoffs) + 1))
                          for i in range(len(cutoffs) + 1)] for g in (True, False))
            gain = {j: bad[j] / max(1, totals.get((s, False), 0)) - good[j] / max(1, totals.get((s, True), 0))
                    for j in range(1, len(cutoffs) + 1) if good[j] <= room[s, level]}
            most = max(gain.values(), default=0)
            if most > 0:
                # The middle of equals keeps away from the good as well as from the bad.
                equals = [j for j in gain if gain[j] == most]
                rules[s, level][f] = step = equals[len(equals) // 2]
                room[s, level] -= good[step]
    return rules


def _with_rules(texts: DataFrame, rules: dict[tuple[str, int], dict[str, int]]) -> DataFrame:
    """Each text once per level, beside the steps of its stratum's rule."""
    rows = [(s, level, *[rule.get(f, UNUSED) for f in FEATURES]) for (s, level), rule in rules.items()]
    steps = ", ".join(f"cut_{f} int" for f in FEATURES)
    return texts.join(_small(texts, rows, f"stratum string, level int, {steps}"), "stratum")


def _small(near: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    frame = near.sparkSession.createDataFrame(rows, schema)
    return F.broadcast(frame) if len(rows) <= BROADCAST_RULES else frame


def _goes() -> Column:
    return reduce(lambda a, b: a | b, [F.col(f) >= F.col(f"cut_{f}") for f in FEATURES])


def _rejections(holdout: DataFrame, rules: dict) -> dict[tuple[str, int, bool, bool], tuple[int, int]]:
    """(texts, rejected texts) per stratum, level, half and label."""
    rows = (_with_rules(holdout, rules).groupBy("stratum", "level", "tuning", "good")
            .agg(F.count("*"), F.sum(_goes().cast("int"))).collect())
    return {tuple(r[:4]): (r[4], r[5]) for r in rows}


# --- The operator ----------------------------------------------------------------

def quality_verdicts(docs: DataFrame, labels: DataFrame, risk: float = RISK,
                     delta: float = DELTA) -> DataFrame:
    """One row per document: measures, `base_failed`, `failed_feature` and `kept`."""
    measured = stored(measure(docs), "quality")
    holdout = stored(labelled(measured, labels), "holdout")
    cutoffs = choose_cutoffs(holdout, risk, delta)
    rules = [(s, *[cutoffs.get((s, f)) for f in FEATURES]) for s in sorted({s for s, _ in cutoffs})]
    columns = ", ".join(f"cut_{f} double" for f in FEATURES)
    failed = F.coalesce(*[F.when(feature(f) > F.col(f"cut_{f}"), F.lit(f)) for f in FEATURES])
    return measured.join(_small(measured, rules, f"stratum string, {columns}"), "stratum", "left").select(
        *[measured[c] for c in measured.columns], base_failed().alias("base_failed"),
        failed.alias("failed_feature"),
    ).withColumn("kept", ~F.col("base_failed") & F.col("failed_feature").isNull())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, with their columns as they are."""
    kept = quality_verdicts(docs, labels).where("kept").select("row_key")
    return keyed(docs).join(kept, "row_key", "left_semi").select("row.*")
