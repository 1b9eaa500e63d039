"""Alignment of two tokenizers against a plain walk over all tokens."""

import collections
import hashlib
import random
from itertools import accumulate

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tarnwatch.llm import token_links
from tarnwatch.llm.registry import op13_token_links, tokenizer_path

A_FILE, B_FILE = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "a", "a", "the cat sat.\nThe dog's don't", "a \r\n b,\r", "▁x", "<0x0A> <s> <|endoftext|> <unk>",
       "tab\t \t x\x85y  z  ", "漢字かな 😀😀 é ﬁ ½ naïve", "\x00\x1c \x1d", "z" * 5_000, " " * 3_000, "x, " * 40_000,
       "1,234.56 %%% ### don't I'll l'eau", "\n\n\n a\n\n b"]


class Plain:
    """Whole texts by the libraries alone."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
        self.a.encode_special_tokens = True
        letters, other = {}, 256
        for byte in range(256):
            if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
                letters[chr(byte)] = byte
            else:
                letters[chr(other)] = byte
                other += 1
        self.letters = letters

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        raw_a = [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in a]
        raw_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                 else self.b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode()
        return (a, raw_a, b, raw_b) if b"".join(raw_a) == whole == b"".join(raw_b) else None

    def aligned(self, text):
        """(n_a, n_b, n_groups, n_links, digest) and the links of each id pair."""
        found = self.tokens(text) if text else None
        if not found:
            return (0, 0, 0, 0, ""), {}
        a, raw_a, b, raw_b = found
        ends_a, ends_b = (list(accumulate(map(len, raw))) for raw in (raw_a, raw_b))
        common = set(ends_a) & set(ends_b)
        groups = collections.OrderedDict()
        for ids, ends, side in ((a, ends_a, 0), (b, ends_b, 1)):
            number = 0
            for i, end in zip(ids, ends):
                groups.setdefault(number, ([], []))[side].append(i)
                number += end in common
        pairs = collections.Counter((x, y) for g in groups.values() for x in g[0] for y in g[1])
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups.values())
        return ((len(a), len(b), len(groups), sum(pairs.values()), hashlib.sha256(text.encode()).hexdigest()),
                dict(pairs))


def expected(rows):
    plain = Plain()
    found = [plain.aligned(text) for _, text in rows]
    count = collections.Counter(pair for _, pairs in found for pair in pairs)
    highest = collections.Counter()
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    return sorted((doc_id, *row[:4], sum(n for p, n in pairs.items() if count[p] == highest[p[0]]),
                   sum(n * count[p] for p, n in pairs.items()), row[4])
                  for (doc_id, _), (row, pairs) in zip(rows, found))


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def segments():
    return token_links.Segments(token_links.ByteLevelSide(A_FILE), token_links.PieceSide(B_FILE))


PARTS = list(" \n\t\x85\xa0\x1cabZé漢😀▁.,'|\r0") + ["  ", " the", "ing", "<|endoftext|>", "<s>", "<0x0A>", "'s", "́"]


@given(st.lists(st.sampled_from(PARTS), min_size=1, max_size=40).map("".join))
@settings(max_examples=400, deadline=None)
def test_any_text_as_the_libraries_read_it(plain, segments, text):
    (row, codes, times), = segments.documents([text])
    pairs = {(c >> 32, c & 0xFFFFFFFF): n for c, n in zip(codes.tolist(), times.tolist())}
    assert (row, pairs) == plain.aligned(text)


@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
@settings(max_examples=300, deadline=None)
def test_diagonal_walk(a, b):
    a, b = sorted(a | {61}), sorted(b | {61})
    common = sorted(set(a) & set(b))
    assert token_links.diagonal_groups(a, b) == (
        [a.index(x) + 1 for x in common], [b.index(x) + 1 for x in common])


def test_segments_forgotten_and_learned_again(plain, monkeypatch):
    monkeypatch.setattr(token_links, "REMEMBER", 50)
    segments = token_links.Segments(token_links.ByteLevelSide(A_FILE), token_links.PieceSide(B_FILE))
    rng = random.Random(4)
    for _ in range(20):
        texts = [" ".join(f"w{rng.randrange(60)}," for _ in range(15)) for _ in range(3)]
        assert [r for r, *_ in segments.documents(texts)] == [plain.aligned(t)[0] for t in texts]


def test_query_on_the_given_documents(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op13_token_links(spark, d).collect())) == expected(rows)


def test_odd_rows_blocks_and_clashing_columns(spark, documents, monkeypatch):
    monkeypatch.setattr(token_links, "BLOCK_DOCS", 3)
    rng = random.Random(2)
    texts = ODD + [" ".join(rng.choice(["the", "cat,", "naïve", "sat.", "\nand"]) for _ in range(30)) for _ in range(20)] * 2
    docs = documents(texts, doc_id=[i % 31 for i in range(len(texts))]).withColumnsRenamed(
        {"node": "code", "size": "count", "words": "block"})
    got = token_links.token_links(docs.repartition(3), A_FILE, B_FILE)
    assert sorted(map(tuple, got.collect())) == expected([(i % 31, t) for i, t in enumerate(texts)])


def test_no_rows_and_no_ids(spark, documents):
    assert token_links.token_links(documents([]), A_FILE, B_FILE).count() == 0
    got = token_links.token_links(documents(["a b", "a b", None], doc_id=[None, None, None]), A_FILE, B_FILE)
    assert sorted(r.count_sum for r in got.collect()) == [0, 4, 4]
