"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton over the pieces enumerates, at each end, all pieces of the vocabulary
that end there, longest first. A dynamic program over ends carries the best score and the
number of pieces on that path. Ties follow the tokenizer: starts are tried in ascending order and
only a strictly better score replaces the earlier one; a character without a piece of its own
may stand alone at the lowest score minus 10 and counts as its UTF-8 bytes (byte fallback).
Words begin at spaces, as the tokenizer's own splitter has them, and each distinct word is
counted once per worker.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import read_small_file, worker_state

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
MAX_CACHED_WORDS = 500_000
MAX_CACHED_WORD_CHARS = 64


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=read_small_file(path))
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class PieceCounter:
    """``count(text)`` is the number of pieces of the best segmentation."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        scores = dict(pieces)
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in scores if len(p) == 1}
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        self.cache: dict[str, int] = {}

    @staticmethod
    def shared(pieces: list[tuple[str, float]], key: str) -> "PieceCounter":
        state = worker_state("unigram")
        if key not in state:
            state[key] = PieceCounter(pieces)
        return state[key]

    def word(self, word: str) -> int:
        """Pieces of one word: the dynamic program over its end positions."""
        size = len(word)
        best, count, seen = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        seen[0] = True
        matches: list[list] = [[] for _ in range(size)]
        for end, found in self.automaton.iter(word):
            matches[end].append(found)
        single, unknown = self.single, self.unknown
        for end in range(1, size + 1):
            top, n, found = 0.0, 0, False
            for length, score in matches[end - 1]:  # longest first: starts ascend
                start = end - length
                value = score + best[start]
                if not found or value > top:
                    top, n, found = value, count[start] + 1, True
            char = word[end - 1]
            if char not in single:
                value = unknown + best[end - 1]
                if not found or value > top:
                    top, n = value, count[end - 1] + len(char.encode("utf-8"))
            best[end], count[end] = top, n
        return count[size]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = text.replace(" ", SPACE)
        if not marked.startswith(SPACE):
            marked = SPACE + marked
        cache = self.cache
        if len(cache) > MAX_CACHED_WORDS:
            cache.clear()
        total = 0
        for word, times in Counter(marked[1:].split(SPACE)).items():
            n = cache.get(word)
            if n is None:
                n = self.word(SPACE + word)
                if len(word) <= MAX_CACHED_WORD_CHARS:
                    cache[word] = n
            total += n * times
        return total


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and n_tokens of every row. Null and empty texts count 0; repeated rows are counted
    each; an empty table gives no rows; other columns are ignored."""
    key = hashlib.md5(repr(pieces).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter.shared(shared.value, key)
        for batch in batches:
            texts = batch.column(1)
            counts = [counter.count(texts[i].as_py()) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return picked.mapInArrow(count, "doc_id long, n_tokens long")
