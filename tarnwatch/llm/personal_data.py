"""Personal data by weak supervision, in DataFrame operations only.

Candidates are what the strict patterns match (whether or not their checks pass) and what looser
patterns add: addresses written with "at" and "dot", phone numbers without country code, IPv6; and kinds that have no
strict pattern: access keys of known formats, values assigned to names such as password or token (the
value alone is the span), bank account numbers, social security numbers. Four
labelers vote on each candidate or abstain: the pattern with its checks, number rules (digit
counts, first digits, mixed characters), a gazetteer (domains, country codes, issuer digits) and words in the
context. Placeholders and numbers whose check sums fail are no candidates of the added kinds.
Expectation-maximisation over the counts of vote patterns, of which there are few whatever the
data, estimates how reliable each labeler is per kind; its beliefs train a logistic classifier
over the shape of the span and its surroundings, again from counts. Base spans, strict matches whose
checks pass, always stay; the classifier decides about the rest.

Offsets are code points: the text is cut at the matches, and the lengths of cuts and matches are
added up over a window of the text's matches.

Defined cases: null and empty texts have no spans; copies of a row get the same spans; overlapping
base spans of different kinds all count; an added span never overlaps a base span; long runs
of digits or address characters are scanned once.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.bounded import stored
from .shared import row_key

KINDS = ["email", "ip", "card", "phone"]
#: Kinds that only the method adds.
ADDED = ["key", "secret", "iban", "ssn"]
#: An address or number can only begin where a run begins, or right after the match before (\G);
#: possessive runs are not tried again from within.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,64}"
             r"(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,64})+",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9A-Za-z.+-])\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}(?![0-9A-Za-z-])",
    "key": r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|gh[opsu]_[A-Za-z0-9]{36,255}+"
           r"|xox[abprs]-[A-Za-z0-9-]{10,255}+|AIza[0-9A-Za-z_-]{35}|[sr]k_live_[0-9A-Za-z]{16,255}+"
           r"|eyJ[A-Za-z0-9_-]{8,2000}+\.[A-Za-z0-9_-]{8,2000}+\.[A-Za-z0-9_-]{8,2000}+"
           r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----)",
    "secret": r"(?i)(?<![A-Za-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|secret[_-]?key)"
              r"[\x22']?[\x20\x09]{0,3}[:=][\x20\x09]{0,3}[\x22']?[^\x00-\x20\x22',;<>]{6,255}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9A-Za-z.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
#: The part of a secret's match before its value.
NAME = r"(?i)^[a-z_-]+[\x22']?[\x20\x09]*[:=][\x20\x09]*[\x22']?"
#: What a text must contain to be searched at all.
NEEDS = {("email", True): "@", ("phone", True): "+", ("ip", True): ".", ("ip", False): ":"}

DOMAINS = ["com", "org", "net", "edu", "gov", "int", "io", "info", "de", "fr", "es", "uk", "it", "nl"]
COUNTRY_CODES = ["1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46",
                 "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81",
                 "82", "84", "86", "90", "91", "92", "94", "98"]
IBAN_COUNTRIES = ["AT", "BE", "BG", "CH", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "IE",
                  "IS", "IT", "LI", "LT", "LU", "LV", "MT", "NL", "NO", "PL", "PT", "RO", "SE", "SI", "SK", "TR"]
PLACEHOLDER = r"(?i)example|changeme|placeholder|xxxx|\*\*\*|^your|^(null|none|true|false|password|secret|token)$|[${]"
FOR = {"email": r"\b(e-?mail|mail|contact|write)\b", "ip": r"\b(ip|address|host|server|login)\b",
       "card": r"\b(card|visa|mastercard|credit|paid|payment)\b", "phone": r"\b(phone|tel|call|mobile|fax|sms)\b",
       "key": r"(key|token|secret|credential|auth|aws)", "secret": r"(password|passwd|pwd|secret|token|key)",
       "iban": r"\b(iban|account|bank|konto|transfer)\b", "ssn": r"\b(ssn|social|security|taxpayer)\b"}
AGAINST = r"\b(version|isbn|issn|doi|order|invoice|serial|sku|item|section|figure|token|build)\b"
BEFORE, AFTER = 40, 20
LABELERS = ["vote_pattern", "vote_number", "vote_gazetteer", "vote_context"]
FEATURES = ["f_strict", "f_passes", "f_spaced", "f_long", "f_word_before", "f_word_after", "f_repeats"]
ACCEPT = 0.9


# --- Candidates -----------------------------------------------------------------

def candidates(docs: DataFrame) -> DataFrame:
    """(row_key, kind, strict, start, end, span, before, after), one row per match of a text."""
    text = F.col("text")
    found = []
    for strict, patterns in ((True, STRICT), (False, LOOSE)):
        for kind, pattern in patterns.items():
            need = NEEDS.get((kind, strict))
            matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
            if need:
                matches = F.when(F.contains(text, F.lit(need)), matches)
            found.append((kind, strict, pattern, matches))
    names = [f"m{i}" for i in range(len(found))]
    matched = docs.select(row_key().alias("row_key"), F.coalesce("text", F.lit("")).alias("text")).select(
        "row_key", "text", *[m.alias(n) for n, (_, _, _, m) in zip(names, found)])
    some = matched.where(reduce(lambda a, b: a | b, [F.coalesce(F.size(n), F.lit(0)) > 0 for n in names]))

    def spans(name, kind, strict, pattern):
        cuts = F.split(text, pattern, -1)
        rows = F.zip_with(F.arrays_zip(F.slice(cuts, 1, F.size(name)).alias("gap"), F.slice(
            cuts, 2, F.size(name)).alias("next")), F.col(name), lambda c, m: F.struct(
                F.lit(kind).alias("kind"), F.lit(strict).alias("strict"), F.length(c["gap"]).alias("gap"),
                m.alias("span"), F.right(c["gap"], F.lit(BEFORE)).alias("before"),
                F.left(c["next"], F.lit(AFTER)).alias("after")))
        numbered = F.transform(rows, lambda r, i: F.struct(i.alias("nth"), r.alias("r")))
        return F.when(F.size(name) > 0, numbered).otherwise(F.slice(numbered, 1, 0))

    every = F.concat(*[F.coalesce(spans(n, k, s, p), F.array().cast(
        "array<struct<nth:int,r:struct<kind:string,strict:boolean,gap:int,span:string,before:string,after:string>>>"))
        for n, (k, s, p, _) in zip(names, found)])
    rows = some.select("row_key", F.explode(every).alias("c")).select("row_key", "c.nth", "c.r.*").distinct()
    so_far = Window.partitionBy("row_key", "kind", "strict").orderBy("nth")
    end = F.sum(F.col("gap") + F.length("span")).over(so_far)
    placed = rows.withColumn("end", end)
    name = F.when(F.col("kind") == "secret", F.regexp_extract("span", NAME, 0)).otherwise("")
    return (placed.withColumn("name", name).withColumn("before", F.concat("before", "name"))
            .withColumn("span", F.substr("span", F.length("name") + 1))
            .withColumn("start", F.col("end") - F.length("span")).drop("nth", "gap", "name"))


def digits(span: str | Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number's letters and digits pass the check sum of its kind."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    values = F.transform(F.split(moved, ""), lambda c: F.when(
        c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda a, v: (
        a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def passes_checks() -> Column:
    """The checks of the contract on a strict match of its kind."""
    parts = F.transform(F.split("span", r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    n = F.length(digits("span"))
    return (F.when(F.col("kind") == "email", F.lit(True))
            .when(F.col("kind") == "ip", small)
            .when(F.col("kind") == "card", F.when(n.between(14, 19), luhn(digits("span"))).otherwise(False))
            .otherwise(n.between(10, 15)))


def possible() -> Column:
    """False for spans of the added kinds that cannot be real: placeholders, check sums that fail, unused numbers."""
    return (F.when(F.col("kind").isin("key", "secret"), ~F.col("span").rlike(PLACEHOLDER))
            .when(F.col("kind") == "iban", mod_97(F.col("span")))
            .when(F.col("kind") == "ssn", F.col("span").rlike("^(?!000|666|9)...-(?!00)..-(?!0000)")
                  & ~F.col("span").isin("078-05-1120", "123-45-6789", "219-09-9999"))
            .otherwise(True))


def _vote(yes: Column, no: Column) -> Column:
    """1, 0 or -1 for an abstention."""
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def with_votes(spans: DataFrame) -> DataFrame:
    """Add `base`, the labelers' votes and the features of the final classifier."""
    kind, number = F.col("kind"), digits("span")
    n = F.length(number)
    base = F.col("strict") & passes_checks()
    domain = F.lower(F.regexp_extract("span", r"(?<![A-Za-z0-9])([A-Za-z0-9]++)\s*$", 1))
    code = F.col("strict") & reduce(lambda a, b: a | b, [F.startswith(number, F.lit(c)) for c in COUNTRY_CODES])
    first = F.substring(number, 1, 1)
    mixed = F.col("span").rlike("[A-Za-z]") & F.col("span").rlike("[^A-Za-z]") | F.startswith("span", F.lit("-----BEGIN"))
    gazetteer = (
        F.when(kind == "email", _vote(domain.isin(DOMAINS), domain.rlike("[0-9]") | (F.length(domain) < 2)))
        .when(kind == "ip", _vote(F.lit(False), F.col("span").rlike(r"^(0|127|255)\.")))
        .when(kind == "card", _vote(first.isin("3", "4", "5", "6"), first.isin("0", "1", "7", "8", "9")))
        .when(kind == "iban", _vote(F.left("span", F.lit(2)).isin(IBAN_COUNTRIES), F.lit(True)))
        .when(kind.isin("key", "secret", "ssn"), -1)
        .otherwise(_vote(code, F.lit(False))))
    rule = (
        F.when(kind == "email", _vote(F.length("span").between(6, 254), F.length("span") > 254))
        .when(kind == "ip", _vote(F.lit(False), F.col("span").rlike(r"(^|\.)0[0-9]")))
        .when(kind == "card", _vote(n.isin(14, 15, 16, 19), ~n.between(14, 19)))
        .when(kind.isin("key", "secret"), _vote(mixed, ~mixed & (F.length("span") < 20)))
        .when(kind.isin("iban", "ssn"), 1)
        .otherwise(_vote(n.between(10, 12), ~n.between(7, 15))))
    near = F.lower(F.col("before"))
    named = reduce(lambda a, b: a | b, [(kind == k) & near.rlike(p) for k, p in FOR.items()])
    return spans.where(possible()).withColumns({
        "base": base,
        "vote_pattern": F.when(F.col("strict"), base.cast("int")).when(kind == "key", 1).otherwise(-1),
        "vote_number": rule, "vote_gazetteer": gazetteer,
        "vote_context": _vote(named, near.rlike(AGAINST)),
        "f_strict": F.col("strict").cast("int"), "f_passes": base.cast("int"),
        "f_spaced": F.col("span").rlike(r"[\x20()\[\]-]").cast("int"), "f_long": (F.length("span") > 24).cast("int"),
        "f_word_before": F.col("before").rlike("[A-Za-z0-9_]$").cast("int"),
        "f_word_after": F.col("after").rlike("^[A-Za-z0-9_]").cast("int"),
        "f_repeats": number.rlike(r"([0-9])\1{5}").cast("int"),
    })


# --- Reliabilities and classifier, from counts ---------------------------------------

def estimate_reliabilities(counts: dict[tuple, int], rounds: int = 60) -> tuple[dict, dict]:
    """EM over {(kind, votes): n}: belief per (kind, votes), and reliability per (kind, labeler).

    A labeler that does not abstain is right with its reliability; votes are independent given
    the truth. Reliabilities start at 0.8 and are smoothed with ten imagined votes.
    """
    belief, reliable = {}, {}
    for kind in sorted({k for k, _ in counts}):
        own = {votes: n for (k, votes), n in counts.items() if k == kind}
        width = len(next(iter(own)))
        right, prior = [0.8] * width, 0.5
        for _ in range(rounds):
            total = sum(own.values())
            for votes in own:
                odds = math.log(prior / (1 - prior))
                for v, r in zip(votes, right):
                    odds += 0 if v < 0 else math.log(r / (1 - r)) * (1 if v else -1)
                belief[kind, votes] = 1 / (1 + math.exp(-odds))
            for j in range(width):
                cast = sum(n for votes, n in own.items() if votes[j] >= 0)
                good = sum(n * (belief[kind, votes] if votes[j] else 1 - belief[kind, votes])
                           for votes, n in own.items() if votes[j] >= 0)
                right[j] = min(0.99, max(0.55, (good + 8) / (cast + 10)))
            yes = sum(n * belief[kind, votes] for votes, n in own.items())
            prior = min(0.99, max(0.01, (yes + 1) / (total + 2)))
        reliable.update({(kind, LABELERS[j]): right[j] for j in range(width)})
    return belief, reliable


def train_classifier(rows: list[tuple[str, tuple, float, int]], steps: int = 400,
                     rate: float = 1.0) -> dict[str, list[float]]:
    """Weights per kind (bias first) by gradient steps on (kind, features, belief, n)."""
    weights = {}
    for kind in sorted({r[0] for r in rows}):
        own = [(f, p, n) for k, f, p, n in rows if k == kind]
        total = sum(n for _, _, n in own)
        w = [0.0] * (len(own[0][0]) + 1)
        for _ in range(steps):
            slope = [0.001 * x for x in w]
            for f, p, n in own:
                z = w[0] + sum(a * b for a, b in zip(w[1:], f))
                miss = n / total * (1 / (1 + math.exp(-max(-30, min(30, z)))) - p)
                slope[0] += miss
                for j, x in enumerate(f):
                    slope[j + 1] += miss * x
            w = [a - rate * g for a, g in zip(w, slope)]
        weights[kind] = w
    return weights


def fit(voted: DataFrame) -> dict[str, list[float]]:
    """Train on all candidates; the driver sees one row per kind, vote pattern and feature pattern."""
    # In order, so that sums of the same counts are the same.
    rows = sorted(voted.groupBy("kind", *LABELERS, *FEATURES).agg(F.count("*").alias("n")).collect())
    counts: dict[tuple, int] = {}
    for r in rows:
        votes = tuple(r[v] for v in LABELERS)
        counts[r["kind"], votes] = counts.get((r["kind"], votes), 0) + r["n"]
    belief, _ = estimate_reliabilities(counts)
    return train_classifier([
        (r["kind"], tuple(r[f] for f in FEATURES), belief[r["kind"], tuple(r[v] for v in LABELERS)], r["n"])
        for r in rows])


def belief_column(weights: dict[str, list[float]]) -> Column:
    score = F.lit(-30.0)
    for kind, w in weights.items():
        z = reduce(lambda a, b: a + b, [F.col(f) * F.lit(x) for f, x in zip(FEATURES, w[1:])], F.lit(w[0]))
        score = F.when(F.col("kind") == kind, z).otherwise(score)
    return 1 / (1 + F.exp(-score))


# --- The operator -----------------------------------------------------------------------

def personal_spans(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(row_key, kind, start, end, span, base, belief): base spans and those the classifier adds."""
    voted = stored(with_votes(candidates(docs)), "spans")
    scored = voted.withColumn("belief", belief_column(fit(voted)))
    place = ["row_key", "kind", "start", "end", "span", "base", "belief"]
    base = scored.where("base").select(*place)
    more = scored.where(~F.col("base") & (F.col("belief") >= accept)).select(*place)
    taken = base.select(F.col("row_key").alias("b_key"), F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    clear = more.join(taken, (F.col("row_key") == F.col("b_key")) & (F.col("start") < F.col("b_end"))
                      & (F.col("b_start") < F.col("end")), "left_anti")
    return base.unionByName(clear)


def find_personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """One row per document: counts of base spans, the digest of them, and all spans as text.

    `n_added` counts the spans that the classifier adds, of any kind; `found` says whether there is a span.
    """
    spans = personal_spans(docs, accept)
    order = F.array_position(F.array(*map(F.lit, KINDS + ADDED)), F.col("kind"))
    place = F.concat_ws(":", "kind", "start", "end")
    entry = F.struct(F.col("start"), order.alias("nth"), F.col("end"), place.alias("place"))

    def joined(rows):
        return F.array_join(F.transform(F.array_sort(rows), lambda r: r["place"]), ",")

    per_row = spans.groupBy("row_key").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS],
        F.count(F.when(~F.col("base"), 1)).alias("n_added"),
        joined(F.collect_list(F.when(F.col("base"), entry))).alias("base_spans"),
        joined(F.collect_list(entry)).alias("all_spans"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"))
    return rows.join(per_row, "row_key", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in [*KINDS, "added"]],
        F.col("all_spans").isNotNull().alias("found"),
        F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("all_spans", F.lit("")).alias("spans"))
