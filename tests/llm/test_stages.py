"""Quality, near-duplicates, decontamination, mixing and token files against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tarnwatch.llm import decontaminate, mixing, near_dups, quality, token_files
from tarnwatch.llm.registry import tokenizer_path

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", "   \n\t ", "one", "one two", "x y z", "x y z", "x y z", "a\x0bb\x0cc\xa0d  e",
       "É É É é É É É é", "long " * 30_000, "#*$ %&| <> a\na\na\nb\n\nb "]


def spaced(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sample_texts(seed=3):
    rng = random.Random(seed)
    def prose(n):
        return " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    base = [prose(n) for n in (5, 20, 60, 150, 400, 90, 90)]
    near = []
    for text in base:
        for _ in range(12):
            words = text.split()
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = "edited"
            near.append(" ".join(words))
    return base + near + base[:3] + ODD


# --- quality ---------------------------------------------------------------------

def slow_measures(text):
    words = spaced(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if spaced(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered), len(lines))


def test_measures(spark, documents):
    texts = sample_texts()
    got = quality.measure(documents(texts)).drop("row_key", "stratum").collect()
    assert sorted(map(tuple, got)) == sorted((i, *slow_measures(t)) for i, t in enumerate(texts))


@given(st.text(alphabet="ab \n|\x1cé", max_size=60))
@settings(max_examples=200, deadline=None)
def test_measures_of_any_text(text):
    assert quality.measures_of(text.encode(), quality.Numbering()) == slow_measures(text)


@pytest.mark.parametrize("n,p", [(1, .3), (10, .05), (200, .0125), (900, .5)])
def test_binomial_tail(n, p):
    exact = 0.0
    for k in range(n + 1):
        exact += math.comb(n, k) * p ** k * (1 - p) ** (n - k)
        assert quality.binomial_cdf(k, n, p) == pytest.approx(exact, rel=1e-9, abs=1e-12)


def test_cutoffs_are_certified(spark, documents):
    rng = random.Random(5)
    clean = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(3000)]
    junk = [t.replace(" ", " | ") for t in clean[:500]]
    docs = documents(clean + junk, lang=["en"] * 2990 + [None] * 10 + ["en"] * 500)
    labels = spark.createDataFrame(
        [(i, int(i < 3000), 0) for i in range(3500)] + [(None, 1, 0), (7, None, 0)],
        "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality_verdicts(docs, labels).collect()}
    assert all(got[i].kept for i in range(3000))
    assert all(got[i].failed_feature == "symbols" and not got[i].kept for i in range(3000, 3500))
    # ten labels certify nothing: the unnamed stratum keeps its junk
    few = quality.quality_verdicts(docs, labels.where("doc_id < 100 OR doc_id > 3400")).collect()
    assert all(r.kept for r in few)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 3000


def test_every_stratum_is_certified(spark, documents):
    """200 labelled good texts suffice; copies of one text, however many, do not."""
    rng = random.Random(6)
    clean = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(600)]
    junk = [t.replace(" ", " | ") for t in clean[:60]]
    copies = [clean[0]] * 400
    texts = clean + junk + copies + [junk[0]] * 5
    lang = [("a", "b", None)[i % 3] for i in range(660)] + ["c"] * 405
    labels = spark.createDataFrame(
        [(i, int(i < 600 or 660 <= i < 1060)) for i in range(len(texts))], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_verdicts(documents(texts, lang=lang), labels).collect()}
    assert len(got) == len(texts)
    assert all(got[i].kept == (i < 600) for i in range(660))
    assert all(got[i].kept for i in range(660, 1065))


def test_false_rejections_stay_within_the_risk(spark):
    """Good and bad overlap: over many draws the rule chosen rejects too many good texts at most rarely."""
    rng = np.random.default_rng(7)
    rows, strata = [], 30
    for s in range(strata):
        for good, n, mean in ((True, 600, 8), (False, 200, 16)):
            for step, fold in zip(np.clip(rng.poisson(mean, n), 0, 40), rng.random(n) < .5):
                rows.append((str(s), good, bool(fold), int(step), 0, 0, 0))
    holdout = spark.createDataFrame(rows, "stratum string, good boolean, tuning boolean, " + ", ".join(
        f"{f} int" for f in quality.FEATURES))
    chosen = quality.choose_cutoffs(holdout)
    tail = {c: 1 - sum(math.exp(-8) * 8 ** k / math.factorial(k) for k in range(j + 1))
            for j, c in enumerate(quality.FEATURES["symbols"][2])}
    risks = [tail[cutoff] for (_, f), cutoff in chosen.items() if f == "symbols"]
    assert len(risks) >= strata / 2 and max(risks) <= quality.RISK


def test_quality_without_rows(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality_verdicts(documents([]), labels).count() == 0
    odd = quality.quality_verdicts(documents(ODD), labels)
    assert odd.count() == len(ODD) and odd.where("kept").count() == 0


# --- near-duplicates ----------------------------------------------------------------

def slow_set(text):
    words = spaced(lower(text))
    return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def slow_components(texts):
    sets = [slow_set(t) for t in texts]
    parent = list(range(len(texts)))
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(texts)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [(i, len(sets[i]), root(i), root(i) == i) for i in range(len(texts))]


def test_near_duplicates(spark, documents):
    texts = sample_texts()
    got = near_dups.near_duplicates(documents(texts)).collect()
    assert sorted(map(tuple, got)) == slow_components(texts)
    kept = near_dups.drop_near_duplicates(documents(texts))
    assert kept.columns == documents([]).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, _, k in slow_components(texts) if k}


def test_large_group_of_near_copies(spark, documents):
    """More members than SMALL in a band, linked through others only in part."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(120):
        words = list(base)
        for k in range(rng.randrange(1, 9)):
            words[rng.randrange(120)] = f"e{i}x{k}"
        texts.append(" ".join(words))
    want = slow_components(texts)
    assert 1 < len({c for _, _, c, _ in want}) < 120
    near_dups.BLOCK_ROWS, before = 20, near_dups.BLOCK_ROWS
    try:
        got = near_dups.near_duplicates(documents(texts)).collect()
    finally:
        near_dups.BLOCK_ROWS = before
    assert sorted(map(tuple, got)) == want


def test_near_duplicates_of_odd_ids(spark, documents):
    docs = documents(["a b c d", "a b c d", "a b c d", "q r s", None], doc_id=[None, 4, 9, 9, 9])
    got = near_dups.near_duplicates(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(None, 2, None, True), (4, 2, 4, True), (9, 2, 4, False), (9, 1, 9, True), (9, 0, 9, True)], key=str)
    assert near_dups.near_duplicates(documents([])).count() == 0


def test_stage_with_odd_ids(spark, documents):
    """Rows of one id with different texts: the copy goes, the others stay."""
    docs = documents(["a b c d", "a b c d", "a b c d", "q r s", None, "q r s", "A b c d"], doc_id=[None, 4, 9, 9, 9, 9, 4])
    got = near_dups.drop_near_duplicates(docs.repartition(3)).collect()
    assert sorted((str(r.doc_id), (r.text or "").lower()) for r in got) == [
        ("4", "a b c d"), ("9", ""), ("9", "q r s"), ("None", "a b c d")]


def test_estimate_is_close():
    hashes, probe = near_dups.WordHashes(), near_dups.probes()
    for n in (30, 300, 3000):
        a = near_dups.shingle_set(" ".join(f"w{i}" for i in range(n)).encode(), hashes)
        b = near_dups.shingle_set(" ".join(f"w{i}" for i in range(n // 10, n)).encode(), hashes)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        seen = near_dups.similarity_estimates(
            near_dups.sketch_of(a, probe), near_dups.sketch_of(b, probe)[None], len(a), np.array([len(b)]))
        assert abs(true - seen[0]) < 0.12


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 99), (99, 100)], "a long, b long")
    got = dict(map(tuple, near_dups.components(links).collect()))
    assert got == {**{i: 1 for i in range(1, 41)}, 99: 99, 100: 99}


# --- decontamination ------------------------------------------------------------------

def slow_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def slow_contamination(texts, items):
    windows = {}
    for item_id, text in items:
        words = slow_words(text)
        size = min(13, len(words))
        windows.setdefault(str(item_id) if item_id is not None else "null", set()).update(
            tuple(words[i:i + size]) for i in range(len(words) - size + 1) if size)
    out = []
    for i, text in enumerate(texts):
        words, hit, found = slow_words(text), set(), set()
        for item, wins in windows.items():
            for size in {len(w) for w in wins}:
                for k in range(len(words) - size + 1):
                    if tuple(words[k:k + size]) in wins:
                        hit.update(range(k, k + size))
                        found.add(item)
        out.append((i, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(words)))
    return out


def test_decontamination(spark, documents):
    rng = random.Random(8)
    def prose(n):
        return " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    items = [(i, prose(n)) for i, n in enumerate((13, 14, 40, 5, 2, 1, 12, 60, 25))]
    items += [(20, None), (21, ""), (None, "odd one out"), (2, prose(15)), (22, "same same " * 12), (10, items[0][1])]
    texts = [prose(30) + " " + items[k % 9][1].upper() + ", " + prose(200) for k in range(20)]
    texts += [items[7][1], items[0][1] + "; " + items[1][1], "same " * 50, *ODD, texts[0], " ".join(f"z{i}" for i in range(50))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(documents(texts), bench).drop("row_key").collect()
    assert sorted(map(tuple, got)) == slow_contamination(texts, items)
    kept = decontaminate.drop_contaminated(documents(texts), bench)
    assert kept.columns == documents([]).columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in slow_contamination(texts, items) if not r[-1]}


def test_decontamination_of_nothing(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(documents(ODD), none).where("n_hit = 0").count() == len(ODD)
    assert decontaminate.contamination(documents([]), none).count() == 0


# --- mixing -----------------------------------------------------------------------------

def slow_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, fixed, free = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return fixed | {s: left * weight[s] / total for s in free}
        fixed |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over


def test_mixing(spark, documents):
    rng = random.Random(2)
    texts = [" ".join("w" * 3 for _ in range(rng.randrange(1, 90))) for _ in range(400)] + [None, "", "a b c", "a b c"]
    sources = [rng.choice(["a", "b", "c", "d", "e", None, "hot", "hot", "hot"]) for _ in texts[:-4]] + ["nil", "nil", "d", "d"]
    ids = list(range(len(texts) - 3)) + [7, 7, None]
    docs = documents(texts, source=sources, doc_id=ids)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts)
    sizes = collections.Counter()
    for s, t in zip(sources, texts):
        sizes[s] += len(spaced(t))
    want = slow_targets(sizes)
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]}
        assert own[0].target == pytest.approx(want[s])
        assert sum(r.taken for r in own) == math.floor(own[0].target + 0.5)
        assert all(0 <= r.taken <= 2 * r.size for r in own)
    assert sorted(map(str, mixing.mix(docs.repartition(7)).collect())) == sorted(map(str, rows))

    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    copies = out.collect()
    by_source = collections.Counter()
    for r in copies:
        by_source[r.source] += len(spaced(r.text))
        assert r.n_chars == len(r.text)
    assert by_source == {s: math.floor(want[s] + 0.5) for s in sizes if sizes[s]}
    assert mixing.mixed_rows(documents([])).count() == 0


# --- token files ------------------------------------------------------------------------

@given(st.lists(st.integers(0, 70_000), min_size=1, max_size=70), st.booleans())
@settings(max_examples=100, deadline=None)
def test_planes_round_trip(ids, narrow):
    ids = np.array(ids, np.uint32) % (60_000 if narrow else 10 ** 6)
    width, planes = token_files.pack_planes(ids)
    assert token_files.unpack_planes(width, planes, len(ids)).tolist() == ids.tolist()


@pytest.mark.parametrize("block", [8, 1000, token_files.BLOCK])
def test_token_files(spark, documents, block):
    from tokenizers import Tokenizer
    texts = [*sample_texts(), "It's <|endoftext|> 12'3 café ́x ΑΣ\x85b", "世界 🎉🎉 a b"]
    ids = [None, *range(200, 199 + len(texts))]
    docs = documents(texts, doc_id=ids).repartition(5)
    got = token_files.encode_and_read_back(docs, tokenizer_path(), block=block).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    start, want = 0, []
    for i, text in zip(ids, texts):
        out = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(out), zlib.crc32(np.array(out, "<u4").tobytes())))
        start += len(out)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_files.encode_and_read_back(documents([]), tokenizer_path()).count() == 0


class CountsOffsets:
    """A tokenizer that counts the texts whose offsets are asked for."""

    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, 0

    def encode(self, text, **options):
        found, counter = self.tokenizer.encode(text, **options), self

        class Found:
            ids = found.ids

            @property
            def offsets(self):
                counter.asked += 1
                return found.offsets
        return Found()


@pytest.mark.parametrize("limits", [{}, {"SLICE_BYTES": 40, "REMEMBER": 20}])
def test_new_words_are_encoded_without_offsets(monkeypatch, limits):
    from tokenizers import Tokenizer
    for name, value in limits.items():
        monkeypatch.setattr(token_files, name, value)
    encoder = token_files.WordEncoder(open(tokenizer_path(), encoding="utf-8").read())
    encoder._tokenizer = counts = CountsOffsets(encoder._tokenizer)
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeéßÖñ", k=rng.randrange(1, 9))) for _ in range(3000)]
    plain = [" ".join(words[at:at + 100]) for at in range(0, 3000, 100)]
    mixed = [None, "", " ", "\n Été, là. Öl.,\tx., 1,000. ", "e\u0301. I\u0307 \u0130b. a\u00a0b \u00a0 don't. A\x00B, <|endoftext|> A,",
             "a@b.c 12'3 \u4e16\u754c, \u00d7. \u0391\u03a3. <|endoftext|>"]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for texts, asks in ((plain, False), (plain + mixed, True)):
        got = []
        for some in token_files.text_slices(pa.array(texts, pa.string())):
            ids, sizes = encoder.encode(some)
            got.extend(part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1]))
        assert got == [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
        assert (counts.asked > 0) == asks


# --- the pipeline ------------------------------------------------------------------------

def test_pipeline(spark):
    """Each stage on all its predecessor kept, against brute force at the smallest size."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    verdicts = {r.doc_id: r.kept for r in quality.quality_verdicts(docs, labels).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = sorted(i for i in text if verdicts[i])
    kept = [left[i] for i, _, _, k in slow_components([text[i] for i in left]) if k]
    clean = [i for i, row in zip(kept, slow_contamination([text[i] for i in kept], items)) if not row[-1]]
    mixed = mixing.mixed_rows(docs.where(docs.doc_id.isin(clean)))
    want = token_files.encode_and_read_back(mixed, tokenizer_path())
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.count() > 0 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    stage = docs
    for name, f in corpus_pipeline.STAGES[:4]:
        stage = f(spark, stage, FOLDER)
        assert stage.columns == docs.columns, name
