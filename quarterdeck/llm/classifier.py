"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its words and of their character n-grams, hashed into a fixed number of
rows; a softmax layer on the mean gives the two classes. Trained by stochastic gradient descent in numpy on a bounded
number of labelled documents; scoring runs on all documents where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import fold_of, fresh, id_text

BUCKETS = 1 << 14
DIMENSIONS = 8
GRAMS = (3, 4, 5)
EPOCHS = 4
RATE = 0.5
#: Most labelled documents that a model is fitted on (those of the smallest id hash).
MAX_LABELLED = 4000
FOLDS = 5
THRESHOLD = 0.3
#: Words hashed at once.
WORDS_AT_ONCE = 1 << 16
_FACTOR, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def _row(hashes: np.ndarray) -> np.ndarray:
    return (((hashes ^ (hashes >> np.uint64(32))) * _SPREAD) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


def feature_rows(text: str | None) -> np.ndarray:
    """Rows of all words of a whole text and of their character n-grams, repeats included.

    The bytes of the words are laid end to end, one space before, between and after them. An n-gram may start or end with
    a space, so it tells where a word begins or ends, but never spans two words.
    """
    words = (text or "").encode("utf-8", "replace").split()
    found = [np.zeros(0, np.int32)]
    for at in range(0, len(words), WORDS_AT_ONCE):
        part = words[at : at + WORDS_AT_ONCE]
        data = np.frombuffer(b" " + b" ".join(part) + b" ", np.uint8)
        spaces = np.cumsum(data == 32)
        letters = data.astype(np.uint64)
        hashes = np.zeros(len(data), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            size = len(data) - n + 1
            if size < 1:
                break
            hashes = hashes[:size] * _FACTOR + letters[n - 1 :]
            if n in GRAMS:
                inside = spaces[n - 2 : n - 2 + size] - spaces[:size]  # spaces between the first and the last byte
                found.append(_row(hashes[inside == 0] + np.uint64(n)))
        # A word's hash: the sum of its letters times rising powers, brought to its own start by the inverse power.
        powers = np.cumprod(np.full(len(data), _SPREAD, np.uint64))
        sums = np.cumsum(letters * powers)
        borders = np.flatnonzero(data == 32)
        whole = (sums[borders[1:] - 1] - sums[borders[:-1]]) * _inverse_powers(len(data))[borders[:-1]]
        found.append(_row(whole))
    return np.concatenate(found)


def _inverse_powers(size: int) -> np.ndarray:
    return np.cumprod(np.full(size, np.uint64(pow(int(_SPREAD), -1, 1 << 64)), np.uint64))


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a whole text and their shares."""
    rows, counts = np.unique(feature_rows(text), return_counts=True)
    return rows, (counts / max(counts.sum(), 1)).astype(np.float32)


@dataclass
class Model:
    """Row vectors, softmax weights and bias."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def row_scores(self) -> np.ndarray:
        """What one row adds to the difference of the two logits: the layers are linear up to the softmax."""
        return self.vectors @ (self.weights[1] - self.weights[0])


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 1) -> Model:
    """Stochastic gradient descent on cross entropy, one document a step, rate falling to zero.

    Without documents of both classes the vectors stay as they start and the bias is the share of label 1, smoothed.
    """
    rng = np.random.default_rng(seed)
    model = Model(
        rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32),
        np.zeros((2, DIMENSIONS), np.float32),
        np.zeros(2, np.float32),
    )
    ones = int(labels.sum())
    model.bias[:] = np.log([len(labels) - ones + 1, ones + 1])
    if not 0 < ones < len(labels):
        return model
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(bags)):
            rate = RATE * (1 - done / steps)
            done += 1
            rows, shares = bags[k]
            mean = shares @ model.vectors[rows]
            logits = model.weights @ mean + model.bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[labels[k]] -= 1
            back = error @ model.weights
            model.weights -= rate * np.outer(error, mean)
            model.bias -= 0.1 * rate * error
            # A share of a long text is small; steps on the vectors are scaled by the number of dimensions' rows.
            model.vectors[rows] -= (rate * VECTOR_GAIN) * shares[:, None] * back
    return model


#: Extra rate of the vectors: a row's share of a document is of the order of a hundredth.
VECTOR_GAIN = 20.0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS) -> Model:
    """Fit on labelled documents outside the held-out fold, at most MAX_LABELLED of them.

    Null labels and null ids are left out; of several labels for an id the largest counts, of several documents of an id the
    one whose text has the least hash.
    """
    marked = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold_of("doc_id", folds) != 0))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    )
    present = marked.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = present.orderBy(F.crc32(F.concat(F.lit("sample:"), id_text("doc_id"))), "doc_id").limit(MAX_LABELLED)

    @F.pandas_udf("rows:binary, shares:binary")
    def bags_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [bag(t) for t in batch]
            yield pd.DataFrame({"rows": [r.tobytes() for r, _ in found], "shares": [s.tobytes() for _, s in found]})

    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by MAX_LABELLED ids
    # One text of each id; a task hands on one text per id at most, however often it comes.
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    sample = met.groupBy("doc_id", "_label").agg(first).select("doc_id", "_label", "first.text")
    got = sample.select("doc_id", "_label", bags_of("text").alias("b")).select("doc_id", "_label", "b.*").toArrow()
    order = pc.sort_indices(got, sort_keys=[("doc_id", "ascending"), ("shares", "ascending")]).to_pylist()
    # Views of the table, not copies: it is the most that the driver holds.
    view = lambda column, k, kind: np.frombuffer(got[column][k].as_buffer(), kind)
    bags = [(view("rows", k, np.int32), view("shares", k, np.float32)) for k in order]
    marks = got["_label"].to_pylist()
    model = train(bags, np.array([marks[k] for k in order], dtype=np.int64))
    del bags, got
    pa.default_memory_pool().release_unused()
    return model


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability of label 1 of every whole text; a null or empty text gets that of the bias alone."""
    row_scores, offset = model.row_scores().astype(np.float64), float(model.bias[1] - model.bias[0])

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            means = [row_scores[rows].mean() if len(rows := feature_rows(t)) else 0.0 for t in batch]
            logits = offset + np.array(means, dtype=np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -700, 700))))

    return docs.withColumn(out, score(F.col(text)))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. Columns beside doc_id and text are not read.

    A null id counts as the empty text when folds are dealt. Repeated rows give repeated results.
    """
    narrow = docs.select("doc_id", "text")
    return scored(narrow, fit(narrow, labels)).select(
        "doc_id",
        (fold_of("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, with their columns, that the classifier does not reject; null and empty texts are judged by the
    bias alone, repeated rows each like the first."""
    score = fresh("_score", docs)
    return scored(docs, fit(docs, labels), out=score).filter(F.col(score) >= THRESHOLD).select(docs.columns)
