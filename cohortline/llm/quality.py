"""Text quality by votes of nearest labelled neighbours in a latent-semantic space.

A text becomes weighted shares of hashed terms: shapes of words with the punctuation around them,
their last characters with the word's length, and a few traits of the whole text (variety of words,
repeated lines, line lengths). A singular value decomposition of a bounded labelled sample gives the latent space; the
labelled vectors are broadcast (``MAX_ROWS`` x ``DIMENSIONS`` numbers), every document's cosine with
each of them is one block product, and the nearest vote with their similarity as weight.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import store, worker_state

#: Labelled rows that span the space and vote, at most half of them of one label.
MAX_ROWS = 4_000
TERMS = 2_048
DIMENSIONS = 48
NEIGHBOURS = 25
BLOCK = 512
PREDICT_AT = 0.7
MAX_CACHED_WORDS = 300_000

_SHAPES = ((re.compile(r"[^\W\d_]*[^\W\d_A-ZÀ-ÖØ-Þ][^\W\d_]*"), "x"), (re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "X"), (re.compile(r"\d+"), "9"))


NO_LETTERS = re.compile(r"[\W\d_]+")


def shape(word: str) -> str:
    """A word with its runs of letters and digits written as x, X (capitals only) or 9."""
    core = word.rstrip("!#$%&*,.:;?|")
    if core.isalpha() and not core.isupper():
        return ("x" + word[len(core):])[:12]
    for pattern, letter in _SHAPES:
        word = pattern.sub(letter, word)
    return word[:12]


def _slot(term: str) -> int:
    return zlib.crc32(term.encode("utf-8")) % TERMS


def _word_terms(word: str) -> tuple[int, ...]:
    form = shape(word)
    size = min(len(word) // 3, 6)
    return (_slot("w" + form), _slot(f"l{form[-2:]}{size}"))


class TermCache(dict):
    """Terms of each word, worked out when it is first asked for; a full cache stays as it is."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        terms = _word_terms(word)
        if len(word) <= 64 and len(self) < MAX_CACHED_WORDS:
            self[word] = terms
        return terms


def term_counts(text: str | None) -> dict[int, float]:
    """Hashed terms of a whole text and their relative weights; none for an empty text but its trait."""
    text = text or ""
    words = text.split()
    state = worker_state("quality")
    terms_of = state.get("terms")
    if terms_of is None:
        terms_of = state["terms"] = TermCache()
    distinct = Counter(words)
    counts: Counter = Counter()
    for terms, n in Counter(map(terms_of.__getitem__, words)).items():
        for term in terms:
            counts[term] += n
    total = max(len(words), 1)
    out = {term: float(np.sqrt(n / total)) for term, n in counts.items()}
    lines = [line for line in text.split("\n") if line.strip()]
    repeated = 1 - len(set(lines)) / max(len(lines), 1)
    traits = {
        "variety": len(distinct) / total, "repeated": repeated, "most": max(distinct.values(), default=0) / total,
        "line": len(words) / max(len(lines), 1) / 100, "length": np.log1p(len(words)) / 10,
        "letters": len(NO_LETTERS.sub("", text)) / max(len(text), 1),
    }
    for name, value in traits.items():
        level = min(int(value * 10), 10)
        out[_slot(f"trait {name} {level}")] = out.get(_slot(f"trait {name} {level}"), 0.0) + 0.5
    return out


def _dense(counted: list[dict[int, float]]) -> np.ndarray:
    out = np.zeros((len(counted), TERMS), dtype=np.float32)
    for row, terms in enumerate(counted):
        out[row, list(terms)] = list(terms.values())
    return out


@dataclass(frozen=True)
class NeighbourModel:
    """Weight of each term, projection into the latent space, labelled unit vectors, their labels and class weights."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    prior: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        vectors = (counts * self.idf) @ self.projection
        return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Votes of the most similar labelled vectors, between 0 and 1."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        similarity = self.latent(counts) @ self.vectors.T
        k = min(neighbours, len(self.labels))
        near = np.argpartition(-similarity, k - 1, axis=1)[:, :k]
        close = np.take_along_axis(similarity, near, axis=1)
        # a neighbour's weight falls with its distance; the least distance counted keeps equal texts finite
        weight = self.weights[near] / np.maximum(1.0 - close, 1e-3)
        return np.clip((weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1), 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, label_column: str, id_column: str = "doc_id", text_column: str = "text",
          max_rows: int = MAX_ROWS, dimensions: int = DIMENSIONS) -> NeighbourModel:
    """Fit on at most ``max_rows`` labelled rows: of each label those of the smallest hashes, half of
    the bound each. Null labels and labels without a document are left out. Without usable rows
    every score is one half."""
    rows = labels.select(F.col(id_column).cast("long").alias("doc_id"), (F.col(label_column) > 0).cast("int").alias("label"))
    rows = rows.where("doc_id is not null and label is not null")
    halves = [rows.where(F.col("label") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows // 2) for side in (0, 1)]
    picked = halves[0].unionByName(halves[1])
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [term_counts(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([list(c) for c in counted], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in counted], pa.list_(pa.float32()))],
                names=["doc_id", "label", "terms", "counts"])

    # at most max_rows pairs of numbers
    joined = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")
    found = store(joined.mapInArrow(count, "doc_id long, label int, terms array<int>, counts array<float>"), "quality-rows")
    sample = sorted(found.collect(), key=lambda r: (r["doc_id"], r["label"], r["terms"]))  # at most max_rows rows of at most TERMS numbers
    if not sample:
        empty = np.zeros((0, 1), dtype=np.float32)
        return NeighbourModel(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), empty, np.zeros(0), np.zeros(0), 0.5)
    table = _dense([dict(zip(r["terms"], r["counts"])) for r in sample])
    idf = np.log((1 + len(table)) / (1 + (table > 0).sum(axis=0))).astype(np.float32) + 0.1
    weighted = table * idf
    # randomised range finder: a few passes over the sample give its leading singular vectors
    rank = min(dimensions, *weighted.shape)
    probe = np.random.default_rng(7).standard_normal((TERMS, rank + 8)).astype(np.float32)
    basis = weighted @ probe
    for _ in range(4):
        basis = np.linalg.qr(basis)[0]
        basis = weighted @ (weighted.T @ basis)
    basis = np.linalg.qr(basis)[0]
    right = np.linalg.svd(basis.T @ weighted, full_matrices=False)[2][:rank].T.astype(np.float32)
    label = np.array([r["label"] for r in sample], dtype=np.float64)
    shares = np.array([max((label == side).mean(), 1e-6) for side in (0, 1)])
    model = NeighbourModel(idf, right, np.zeros((0, 1), np.float32), label, 0.5 / shares[label.astype(int)], float(label.mean()))
    return NeighbourModel(idf, right, model.latent(table), label, model.weights, model.prior)


def score(docs: DataFrame, model: NeighbourModel, id_column: str = "doc_id", text_column: str = "text", predict_at: float = PREDICT_AT) -> DataFrame:
    """doc_id, score and predicted of every row. Null and empty texts are scored by their traits alone;
    repeated rows are scored each; an empty table gives no rows; other columns are ignored."""
    # plain values: a broadcast object of our own class would need the package on every executor
    shared = docs.sparkSession.sparkContext.broadcast((model.idf, model.projection, model.vectors, model.labels, model.weights, model.prior))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = NeighbourModel(*shared.value)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.column(1).slice(at, BLOCK)
                scores[at:at + BLOCK] = model.score(_dense([term_counts(t.as_py()) for t in part]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array((scores >= predict_at).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return picked.mapInArrow(vote, "doc_id long, score double, predicted int")
