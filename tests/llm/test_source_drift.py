"""Run-length divergence against sums over all terms."""

import collections
import random
import re

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tarnwatch.llm import source_drift
from tarnwatch.llm.sql import ORACLE_SQL

ODD = [None, "", " \n", "123 456", "É É é ÉA", "don't stop", "a" * 5_000, "漢字 漢字", "w1w2 " * 60_000]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, top=50):
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in row) for row in rows]
    found = [(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower(t)), lang, source) for t, lang, source in rows]
    out = []
    for lang in {x[1] for x in rows}:
        held = collections.Counter(w for words, x, _ in found if x == lang for w in set(words))
        kept = sorted(w for w, n in held.items() if n >= 30)
        v, counts = len(kept), collections.defaultdict(collections.Counter)
        for words, x, source in found:
            if x == lang:
                counts[source].update(w for w in words if held[w] >= 30)

        def p(count, n):
            return 1 + 10 ** 9 * (count + 5) // (n + 5 * v)
        total = sum(counts.values(), collections.Counter())
        n = {s: sum(c.values()) for s, c in counts.items()}
        for a in counts:
            pairs = [(-sum(abs(p(counts[a][w], n[a]) - p(counts[b][w], n[b])) for w in kept), b) for b in counts if b != a]
            terms = [(p(total[w], sum(n.values())) - p(counts[a][w], n[a]), w) for w in kept if counts[a][w]]
            for part, items in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))), ("term", sorted(
                    [t for t in terms if t[0] < 0], key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, a, part, item, -value, rank) for rank, (value, item) in enumerate(items, 1)]
    return sorted(out)


def sample():
    rng, rows = random.Random(8), []
    for i in range(900):
        source = f"s{min(rng.randrange(12), rng.randrange(12))}"
        words = [f"w{chr(97 + int(rng.expovariate(.12)) % 26)}{'Xé'[rng.random() < .1]}{source[1:] if rng.random() < .1 else ''}"
                 for _ in range(rng.randrange(40))]
        rows.append((" ".join(words), rng.choice(["en", "en", "en", "de", "xx"]) if i % 50 else None, source if i % 31 else None))
    rows += [(t, "en", "odd") for t in ODD] + [("rare words only", "fr", s) for s in "abb"] + [("alone", "it", "x")]
    return rows + rows[:40]


def test_sources_and_terms(spark, documents):
    rows = sample()
    texts, langs, sources = map(list, zip(*rows))
    docs = documents(texts, lang=langs, source=sources).withColumnsRenamed(
        {"row_key": "term", "node": "number", "words": "segment", "size": "count"}).repartition(3)
    want = brute(rows)
    assert {part for _, _, part, *_ in want} == {"pair", "term"}
    assert sorted(map(tuple, source_drift.source_divergence(docs).collect())) == want
    small = source_drift.source_divergence(docs, segment_terms=7, tile=3)
    assert sorted(map(tuple, small.collect())) == want


def test_flushes_do_not_change_counts(spark, documents, monkeypatch):
    rows = sample()[:300]
    texts, langs, sources = map(list, zip(*rows))
    monkeypatch.setattr(source_drift, "FLUSH", 20)
    monkeypatch.setattr(source_drift, "PIECE", 16)
    docs = documents(texts, lang=langs, source=sources)
    assert sorted(map(tuple, source_drift.source_divergence(docs).collect())) == brute(rows)


def test_sql_states_the_same(spark, documents):
    rows = sample()
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR, source VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    got = db.execute(f"SELECT lang, source, part, item, value, rank FROM ({ORACLE_SQL['op11_source_divergence']})")
    assert sorted(got.fetchall()) == brute(rows)


def test_no_rows(spark, documents):
    assert source_drift.source_divergence(documents([])).count() == 0


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=40), st.integers(1, 50))
@settings(max_examples=200, deadline=None)
def test_runs(columns, n):
    a, b = (np.array(c) for c in zip(*columns))
    runs = []
    for column in (a, b):
        places = np.flatnonzero(column)
        starts, counts = source_drift.run_lengths(places, column[places], len(column))
        assert np.repeat(counts, np.diff(np.append(starts, len(column)))).tolist() == column.tolist()
        runs += [starts, source_drift.probabilities(counts, n, len(column))]
    p = [1 + 10 ** 9 * (c + 5) // (n + 5 * len(a)) for c in (a, b)]
    assert source_drift.run_divergence(*runs, len(a)) == int(np.abs(p[0] - p[1]).sum())


def test_large_counts_stay_exact(spark):
    counts = [0, 7, 10 ** 10, 10 ** 13 + 1]
    n, v = sum(counts), 4
    want = [1 + 10 ** 9 * (c + 5) // (n + 5 * v) for c in counts]
    assert source_drift.probabilities(np.array(counts), n, v).tolist() == want
    df = spark.createDataFrame([(c, n, v) for c in counts], "c long, n long, v long")
    got = df.select("c", source_drift.probability(df.c, df.n, df.v).alias("p")).sort("c").collect()
    assert [r.p for r in got] == want
