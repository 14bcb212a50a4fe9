"""Toxicity grades by cumulative-link ordinal regression on sparse words.

One weight vector serves all ordered thresholds: ``P(grade >= k) = sigmoid(w.x - t_k)`` with
``t_1 < t_2 < ...``; the expected severity is the sum of these probabilities. A word's feature is
the logarithm of its count. Words are chosen over a bounded sample of labelled rows, by a chi-square
test and by the share of toxic rows among those that hold them, and the model is fitted on that
sample; the first letters of longer words are features too, for inflected and compound forms. All
rows are scored on their whole text.

Where the labels only say toxic or not, the grade of a toxic row is 1 to ``n_grades`` by the quantile
of its number of chosen words; other rows are grade 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import store, worker_state

#: Labelled rows the model may be fitted on, and words it may use.
MAX_ROWS = 30_000
MAX_WORDS = 4_096
MIN_CHI_SQUARE = 30.0
MIN_PRECISION = 0.8
MIN_SHARE = 5e-4
MIN_DOCUMENTS = 3
N_GRADES = 3
REJECT_AT = 0.5

WORD = r"[^\W_]+"
PREFIXES = (5, 7)


@dataclass(frozen=True)
class OrdinalModel:
    words: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.., one row per score."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))


def stems(words: Iterable[str]) -> Iterator[str]:
    """First letters of the longer words, marked as such."""
    for size in PREFIXES:
        for word in words:
            if len(word) > size:
                yield word[:size] + "*"


def feature(count: np.ndarray) -> np.ndarray:
    return np.log1p(count)


def fit(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_columns: int, n_grades: int,
        penalty: float = 1e-3, steps: int = 600, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds that minimise the penalised ordinal loss (Adam, full batches).

    The first threshold and the logarithms of the gaps are the free parameters, so order always holds."""
    n = len(grades)
    share = np.array([(grades >= k).mean() for k in range(1, n_grades + 1)]).clip(1e-4, 1 - 1e-4)
    start = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(start), 0.1))
    theta = np.concatenate([np.zeros(n_columns), [start[0]], gaps])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    weight_of = {True: 0.5 / max((grades > 0).mean(), 1e-4), False: 0.5 / max((grades == 0).mean(), 1e-4)}
    balance = np.where(grades > 0, weight_of[True], weight_of[False])
    for step in range(1, steps + 1):
        w, thresholds = theta[:n_columns], theta[n_columns] + np.concatenate([[0.0], np.cumsum(np.exp(theta[n_columns + 1:]))])
        score = np.bincount(rows, values * w[columns], n)
        above = 1.0 / (1.0 + np.exp(np.clip(thresholds[None, :] - score[:, None], -50, 50)))
        padded = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        index = np.arange(n)
        chance = np.maximum(padded[index, grades] - padded[index, grades + 1], 1e-12)
        slope = padded * (1 - padded)
        low, high = slope[index, grades], slope[index, grades + 1]
        by_score = -balance * (low - high) / chance / n
        by_threshold = np.zeros((n, n_grades + 2))
        by_threshold[index, grades] += balance * low / chance / n
        by_threshold[index, grades + 1] -= balance * high / chance / n
        per_threshold = by_threshold[:, 1:n_grades + 1].sum(axis=0)
        later = np.cumsum(per_threshold[::-1])[::-1]
        gradient = np.concatenate([
            np.bincount(columns, values * by_score[rows], n_columns) + penalty * w / max(n_columns, 1) ** 0.5,
            [later[0]], later[1:] * np.exp(theta[n_columns + 1:])])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        theta = theta - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    return theta[:n_columns], theta[n_columns] + np.concatenate([[0.0], np.cumsum(np.exp(theta[n_columns + 1:]))])


def _word_counts(labelled: DataFrame) -> DataFrame:
    """label, distinct words and stems, and their counts of each labelled row."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(WORD).findall
        for batch in batches:
            words, counts = [], []
            for text in batch.column(1):
                seen: dict[str, int] = {}
                found = find((text.as_py() or "").lower())
                for word in found:
                    seen[word] = seen.get(word, 0) + 1
                for mark, n in Counter(stems(found)).items():
                    seen[mark] = n
                words.append(list(seen))
                counts.append(list(seen.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int32()))],
                names=["label", "words", "counts"])

    return labelled.select("label", "text").mapInArrow(count, "label int, words array<string>, counts array<int>")


def train(docs: DataFrame, labels: DataFrame, label_column: str, id_column: str = "doc_id", text_column: str = "text",
          n_grades: int | None = None, max_rows: int = MAX_ROWS, max_words: int = MAX_WORDS,
          min_chi_square: float = MIN_CHI_SQUARE) -> OrdinalModel:
    """Fit on at most ``max_rows`` labelled rows, those of the smallest hashes.

    ``n_grades`` None: the label is 0 or 1 and toxic rows are graded by quantile; else it is an
    ordered grade from 0 to ``n_grades``. Labels without a document, null labels and documents
    without a label are left out. Without usable rows the model calls nothing toxic."""
    picked = labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("label"))
    picked = picked.where("doc_id is not null and label is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    counted = store(_word_counts(texts.join(F.broadcast(picked), "doc_id")), "toxicity-rows")  # at most max_rows pairs of numbers

    total, toxic = counted.agg(F.count("*"), F.coalesce(F.sum((F.col("label") > 0).cast("long")), F.lit(0))).first()
    grades_in = n_grades or N_GRADES
    nothing = OrdinalModel({}, np.zeros(0), 10.0 + np.arange(grades_in, dtype=np.float64))
    if not toxic or toxic == total:
        return nothing
    share = toxic / total
    least = max(MIN_DOCUMENTS, int(np.ceil(MIN_SHARE * total)))
    words = (
        counted.select((F.col("label") > 0).cast("long").alias("toxic"), F.explode("words").alias("word"))
        .groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("n_toxic")).where(F.col("n") >= least)
        .withColumn("excess", F.col("n_toxic") - F.col("n") * F.lit(share))
        .withColumn("chi_square", F.col("excess") ** 2 / (F.col("n") * F.lit(share * (1 - share))) / (1 - F.col("n") / F.lit(total + 1.0)))
        .where((F.col("chi_square") >= min_chi_square) & (F.col("n_toxic") >= MIN_PRECISION * F.col("n"))).orderBy(F.desc("chi_square"), "word").limit(max_words).collect())
    if not words:
        return nothing
    place = {r["word"]: i for i, r in enumerate(words)}
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            columns, counts = [], []
            for found, times in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist()):
                hits = [(known[w], n) for w, n in zip(found, times) if w in known]
                columns.append([h[0] for h in hits])
                counts.append([h[1] for h in hits])
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(columns, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=["label", "columns", "counts"])

    # at most max_rows rows of at most max_words numbers, few of which occur
    table = counted.mapInArrow(sparse, "label int, columns array<int>, counts array<int>").toArrow()
    label = table.column("label").to_numpy()
    lists = table.column("columns").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    rows = np.repeat(np.arange(len(label)), sizes)
    columns = lists.flatten().to_numpy()
    counts = table.column("counts").combine_chunks().flatten().to_numpy()
    order = np.lexsort((columns, rows))
    rows, columns, counts = rows[order], columns[order], counts[order]
    if n_grades:
        grades = np.clip(label, 0, n_grades).astype(np.int64)
    else:
        marked = np.bincount(rows, counts, len(label))
        edges = np.quantile(marked[label > 0], np.arange(1, N_GRADES) / N_GRADES)
        grades = np.where(label > 0, 1 + np.searchsorted(edges, marked, side="right"), 0).astype(np.int64)
    weights, thresholds = fit(rows, columns, feature(counts), grades, len(place), grades_in)
    return OrdinalModel(place, weights, thresholds)


def grade(docs: DataFrame, model: OrdinalModel, id_column: str = "doc_id", text_column: str = "text", reject_at: float = REJECT_AT) -> DataFrame:
    """doc_id, expected_severity, p_toxic, severity (the likeliest grade) and toxic of every row.

    Null, empty and wordless texts get the model's answer for no words. Repeated rows are scored
    each, an empty table gives no rows, other columns are ignored."""
    # plain values: a broadcast object of our own class would need the package on every executor
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.weights, model.thresholds))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("toxicity")  # drops what an earlier operator cached
        model, find = OrdinalModel(*shared.value), re.compile(WORD).findall
        known = model.words.keys()
        for batch in batches:
            total = np.zeros(batch.num_rows)
            for i in range(batch.num_rows):
                words = find((batch.column(1)[i].as_py() or "").lower())
                distinct = set(words)
                hits = known & distinct | known & set(stems(distinct))
                for hit in sorted(hits):
                    n = sum(w.startswith(hit[:-1]) and len(w) >= len(hit) for w in words) if hit[-1] == "*" else words.count(hit)
                    total[i] += model.weights[model.words[hit]] * float(feature(np.float64(n)))
            above = model.at_least(total)
            padded = np.concatenate([np.ones((len(total), 1)), above, np.zeros((len(total), 1))], axis=1)
            likeliest = np.argmax(padded[:, :-1] - padded[:, 1:], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(likeliest, pa.int32()), pa.array(above[:, 0] >= reject_at)],
                names=["doc_id", "expected_severity", "p_toxic", "severity", "toxic"])

    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return picked.mapInArrow(score, "doc_id long, expected_severity double, p_toxic double, severity int, toxic boolean")
