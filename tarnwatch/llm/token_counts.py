"""Count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists all vocabulary pieces that end at a character, longest first. The
best path to a character keeps its score and its number of pieces, nothing else. Ties are settled
as the public unigram tokenizers settle them: candidates for a place come in the order of their
starts and replace the best only if strictly better; a character without a piece of its own may be
unknown at ten below the lowest score, and counts as its UTF-8 bytes if the vocabulary has the 256
byte pieces, else neighbouring unknowns count as one. Scores add up in 64-bit floats in path order.

Text is cut at Unicode white space; a word begins with the space mark, and every space mark begins
a word. So counts of distinct words are remembered, up to a bound, and a text is their sum.

Defined cases: null and empty texts, and texts of white space only, have 0 words and 0 pieces.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBER = 1_000_000
#: Python cuts at these too, though they are no Unicode white space.
SEPARATORS = "\x1c\x1d\x1e\x1f"
WHITE = re.compile(r"[\t-\r \x85\xa0  -     　]+")


def sentencepiece_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece model, in the order of their ids."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class PieceCounter(dict):
    """Word to number of pieces; computed when first asked for."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick
        super().__init__()
        self._matches = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self._matches.add_word(piece, (len(piece), score))
        self._matches.make_automaton()
        self._unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self._bytes = {f"<0x{b:02X}>" for b in range(256)} <= {piece for piece, _ in vocabulary}

    def __missing__(self, word: str) -> int:
        marked = word if word.startswith(MARK) else MARK + word
        parts = [marked] if MARK not in marked[1:] else [MARK + p for p in marked.split(MARK)[1:]]
        if len(self) >= REMEMBER:
            self.clear()
        self[word] = count = sum(map(self._viterbi, parts))
        return count

    def _viterbi(self, text: str) -> int:
        n = len(text)
        ending = [[] for _ in range(n)]
        for end, match in self._matches.iter(text):
            ending[end].append(match)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(n):
            best = None
            single = False
            for length, own in ending[end]:
                start = end + 1 - length
                candidate = own + score[start]
                if best is None or candidate > best:
                    best, pieces, is_unknown = candidate, count[start] + 1, False
                single = single or length == 1
            if not single:
                candidate = self._unknown + score[end]
                if best is None or candidate > best:
                    more = len(text[end].encode()) if self._bytes else int(not unknown[end])
                    best, pieces, is_unknown = candidate, count[end] + more, True
            score[end + 1], count[end + 1], unknown[end + 1] = best, pieces, is_unknown
        return count[n]


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    if any(c in text for c in SEPARATORS):
        return [w for w in WHITE.split(text) if w]
    return text.split()


def token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]]) -> DataFrame:
    """(doc_id, n_words, n_pieces) per document, over its whole text."""
    def run(batches):
        counter = PieceCounter(vocabulary)
        for batch in batches:
            texts = [words_of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([sum(map(counter.__getitem__, t)) for t in texts], pa.int64())],
                names=["doc_id", "n_words", "n_pieces"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_pieces long")
