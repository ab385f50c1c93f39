"""Language-model scores by a log-bilinear model trained with noise-contrastive estimation.

A word's score after two others is the product of its vector with a position-weighted sum of theirs, plus a bias. The
model knows the most frequent words; the others fall into classes by their ending, inside which words have their smoothed
corpus frequencies.
Corpus counts cover all training text and stay distributed: text is cut into blocks, each with a dictionary of its own
words, and only dictionaries meet the corpus counts, so no table of all words is ever in one place. Every task trains
on its blocks, and the parameters are averaged. As the score is a sum over the two positions, the normalisers of all
contexts are one matrix product, so token probabilities are exactly normalised.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import fold_of, landed

BLOCK_BYTES = 8 << 20
#: Words that the model knows by themselves, and classes for the endings of all others.
KNOWN = 896
ENDINGS = 128
DIMENSIONS = 16
NOISE = 32
BATCH = 1024
RATE = 0.1
ROUNDS = 1
#: Parts of the parameter vector that are summed by themselves.
PARTS = 32
FOLDS, HELD_OUT = 7, 2
_SUMS = "part int, weight double, total binary"
END = ""  # no word is empty


class _Block:
    """Documents of one block as numbers of words in the block's own dictionary."""

    def __init__(self):
        self.words: defaultdict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.rows, self.bytes = [], 0

    def add(self, doc_id, held_out: bool, text: str | None) -> None:
        data = (text or "").encode("utf-8", "replace").lower()
        tokens = [*data.split(), b""]
        self.rows.append((doc_id, held_out, np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens))))
        self.bytes += len(data)

    def batch(self, name: str, schema: pa.Schema) -> pa.RecordBatch:
        """A row per document and one with the words, most frequent first, and their counts outside the held-out fold."""
        every, counts = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), np.int64)
        for _, held_out, ids in self.rows:
            own = np.bincount(ids, minlength=len(every))
            every += own
            counts += 0 if held_out else own
        order = np.argsort(-every, kind="stable")
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        names = list(self.words)
        doc_ids, held_out, ids = zip(*self.rows, strict=True)
        columns = [
            [name] * (len(ids) + 1),
            [*doc_ids, None],
            [*held_out, None],
            [*(pack_ids(number[i]) for i in ids), None],
            [None] * len(ids) + [[names[k].decode("utf-8") for k in order]],
            [None] * len(ids) + [counts[order]],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pack_ids(ids: np.ndarray) -> bytes:
    """Numbers that are mostly small, compressed byte plane by byte plane."""
    return zlib.compress(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_ids(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def blocks(docs: DataFrame) -> DataFrame:
    """Landed blocks: a row per document (doc_id, held_out, ids) and one per block with its words and their counts.

    Texts are taken out of their Arrow batch one by one, and a block is handed on when it is full, so a task holds a
    batch and a block.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = "block string, doc_id string, held_out boolean, ids binary, words array<string>, counts array<long>"
    schema = pa.schema(
        [("block", pa.string()), ("doc_id", pa.string()), ("held_out", pa.bool_()), ("ids", pa.binary()),
         ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, made, part = _Block(), 0, TaskContext.get().partitionId()
        for batch in batches:
            doc_ids, held_out, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for k in range(batch.num_rows):
                block.add(doc_ids[k], held_out[k], texts[k].as_py())
                if block.bytes >= BLOCK_BYTES:
                    yield block.batch(f"{part}-{made}", schema)
                    block, made = _Block(), made + 1
        if block.rows:
            yield block.batch(f"{part}-{made}", schema)

    narrow = docs.select(F.col("doc_id").cast("string"), (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text")
    return landed(narrow.mapInArrow(cut, fields).withColumn("doc_id", F.col("doc_id").cast(kind)), "blocks")


@dataclass
class Corpus:
    """Totals of the training text: all, the words that the model knows, and per ending the tokens and distinct words."""

    tokens: int
    distinct: int
    known: list[tuple[str, int]]
    other_tokens: np.ndarray
    other_distinct: np.ndarray

    def noise(self) -> np.ndarray:
        """Distribution of the classes in the training text, smoothed by one: endings, then known words."""
        counts = np.concatenate((self.other_tokens, [c for _, c in self.known])) + 1.0
        return counts / counts.sum()


def _ending(word: str) -> Column:
    return (F.crc32(F.substring(word, -2, 2)) % ENDINGS).cast("int")


def count_words(cut: DataFrame) -> tuple[DataFrame, Corpus]:
    """Counts (word, c) of all words of the training text, landed, and its totals."""
    each = cut.filter("words is not null").select(F.explode(F.arrays_zip("words", "counts")).alias("e"))
    words = landed(
        each.groupBy(F.col("e.words").alias("word")).agg(F.sum("e.counts").alias("c")).filter("c > 0"), "vocabulary"
    )
    known = [(r["word"], r["c"]) for r in words.orderBy(F.col("word") != END, F.desc("c"), "word").limit(KNOWN).collect()]
    tokens, distinct = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
    for r in words.groupBy(_ending("word").alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        tokens[r["k"]], distinct[r["k"]] = r["n"], r["v"]
    total = int(tokens.sum()), int(distinct.sum())
    for word, c in known:
        k = zlib.crc32(word[-2:].encode()) % ENDINGS
        tokens[k] -= c
        distinct[k] -= 1
    return words, Corpus(*total, known, tokens, distinct)


def dictionaries(cut: DataFrame, words: DataFrame, corpus: Corpus) -> DataFrame:
    """One row per block: the class and the corpus count of each word of its dictionary, as bytes, landed."""
    spark = cut.sparkSession
    known = spark.createDataFrame([(w, ENDINGS + k) for k, (w, _) in enumerate(corpus.known)], "word string, k int")
    classed = words.join(F.broadcast(known), "word", "left")  # at most KNOWN rows
    listed = cut.filter("words is not null").select("block", F.posexplode("words").alias("at", "word"))

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        k, c = (group[n].to_numpy(np.int64) for n in ("k", "c"))
        return pd.DataFrame({"block": [group["block"].iloc[0]], "k": [k.astype(np.int16).tobytes()], "c": [c.tobytes()]})

    found = listed.join(classed, "word", "left").select(
        "block", "at", F.coalesce("k", _ending("word")).alias("k"), F.coalesce("c", F.lit(0).cast("long")).alias("c")
    )
    return landed(found.groupBy("block").applyInPandas(gather, "block string, k binary, c binary"), "dictionaries")


@dataclass
class Model:
    """Vectors of contexts and of predicted words, position weights, biases. The last context is the start of a text."""

    context: np.ndarray
    position: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.position, self.target, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def like(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for a in self.arrays():
            out.append(np.array(flat[at : at + a.size], dtype=np.float64).reshape(a.shape))
            at += a.size
        return Model(*out)


def start(noise: np.ndarray, seed: int = 3) -> Model:
    rng = np.random.default_rng(seed)
    n = len(noise)
    return Model(
        rng.normal(0, 0.1, (n + 1, DIMENSIONS)), np.ones((2, DIMENSIONS)), rng.normal(0, 0.1, (n, DIMENSIONS)), np.log(noise)
    )


def contexts(ids: np.ndarray, starts: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two places before each token; before a document's first token stands `begin`."""
    one = np.concatenate(([begin], ids[:-1]))
    one[starts] = begin
    two = np.concatenate(([begin], one[:-1]))
    two[starts] = begin
    return one, two


def _add_rows(total: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    total[ordered[first]] += np.add.reduceat(values[order], first, axis=0)


class Trainer:
    """Noise-contrastive estimation in batches with AdaGrad; the noise words of a batch are shared."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int):
        # Single precision: half the memory traffic, which is what a step costs.
        self.model, self.rng, self.noise = Model(*(a.astype(np.float32) for a in model.arrays())), np.random.default_rng(seed), noise
        self.log_noise, self.tokens = np.log(NOISE * noise).astype(np.float32), 0
        self.squares = [np.full_like(a, 1e-2) for a in self.model.arrays()]
        self.cumulated = np.cumsum(noise)

    def step(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        m = self.model
        others = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), len(self.noise) - 1)
        first, second = m.context[one], m.context[two]
        predicted = first * m.position[0] + second * m.position[1]
        data = np.einsum("bd,bd->b", predicted, m.target[word]) + m.bias[word] - self.log_noise[word]
        false = predicted @ m.target[others].T + (m.bias[others] - self.log_noise[others])
        right = -1 / (1 + np.exp(np.clip(data, -30, 30)))  # slope of -log sigmoid(data)
        wrong = 1 / (1 + np.exp(-np.clip(false, -30, 30)))
        back = right[:, None] * m.target[word] + wrong @ m.target[others]
        slopes = [np.zeros_like(a) for a in m.arrays()]
        _add_rows(slopes[0], one, back * m.position[0])
        _add_rows(slopes[0], two, back * m.position[1])
        slopes[1][0], slopes[1][1] = (back * first).sum(0), (back * second).sum(0)
        _add_rows(slopes[2], word, right[:, None] * predicted)
        np.add.at(slopes[2], others, wrong.T @ predicted)
        slopes[3] += np.bincount(word, right, len(m.bias))
        np.add.at(slopes[3], others, wrong.sum(0))
        for a, g, s in zip(m.arrays(), slopes, self.squares, strict=True):
            s += g * g
            a -= RATE * g / np.sqrt(s)
        self.tokens += len(word)

    def block(self, ids: np.ndarray, starts: np.ndarray) -> None:
        one, two = contexts(ids, starts, len(self.noise))
        for part in np.array_split(self.rng.permutation(len(ids)), -(-len(ids) // BATCH)):
            self.step(ids[part], one[part], two[part])


def _joined(docs: pd.DataFrame, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all documents in a row, their classes, and where each document starts."""
    parts = [unpack_ids(b) for b in docs["ids"]]
    ids = np.concatenate(parts)
    return ids, k[ids].astype(np.int64), np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1])).astype(np.int64)


def train(cut: DataFrame, classes: DataFrame, corpus: Corpus, rounds: int = ROUNDS) -> Model:
    """Each task trains on its blocks from the same start; the mean, weighted by tokens, is the next start."""
    noise = corpus.noise()
    model = start(noise)
    texts = cut.filter("ids is not null and not held_out").select("block", "ids")
    if corpus.tokens == 0:
        return model
    grouped = texts.groupBy("block").cogroup(classes.select("block", "k").groupBy("block"))
    for turn in range(rounds):
        own = grouped.applyInPandas(_learner(model, noise, turn), "weight double, flat binary")
        sums = own.mapInPandas(_weighted_sums, _SUMS).groupBy("part").applyInPandas(_sum_parts, _SUMS)
        flat = [None] * PARTS
        for row in sums.collect():  # PARTS rows of one model altogether
            flat[row["part"]] = np.frombuffer(row["total"]) / row["weight"]
        model = model.like(np.concatenate(flat))
    return model


def _learner(begun: Model, noise: np.ndarray, turn: int):
    def learn(docs: pd.DataFrame, dictionary: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):  # all of the block is held out
            return pd.DataFrame({"weight": [], "flat": []})
        trainer = Trainer(begun, noise, seed=1000 * turn + len(docs))
        _, k, starts = _joined(docs, np.frombuffer(dictionary["k"].iloc[0], np.int16))
        trainer.block(k, starts)
        return pd.DataFrame({"weight": [float(trainer.tokens)], "flat": [trainer.model.flat().astype(np.float64).tobytes()]})

    return learn


def _weighted_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sum of a partition's parameter vectors, each times its tokens, cut into parts, and the sum of the tokens."""
    weight, flat = 0.0, 0.0
    for batch in batches:
        for w, f in zip(batch["weight"], batch["flat"], strict=True):
            weight, flat = weight + w, flat + w * np.frombuffer(f)
    if weight:
        totals = [part.tobytes() for part in np.array_split(flat, PARTS)]
        yield pd.DataFrame({"part": range(PARTS), "weight": weight, "total": totals})


def _sum_parts(group: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(t) for t in group["total"]], axis=0)
    return pd.DataFrame({"part": [group["part"].iloc[0]], "weight": [group["weight"].sum()], "total": [total.tobytes()]})


class Scorer:
    """Exact log10 probabilities: scores by position and the normalisers of all pairs of context words."""

    def __init__(self, model: Model, corpus: Corpus):
        n = len(model.bias)
        by_position = [(model.context * p) @ model.target.T for p in model.position]
        by_position[0] = by_position[0] + model.bias
        self.highest = [s.max(axis=1) for s in by_position]
        shifted = [np.exp(s - h[:, None]) for s, h in zip(by_position, self.highest, strict=True)]
        self.log_z = np.log(shifted[0] @ shifted[1].T) + self.highest[0][:, None] + self.highest[1][None, :]
        self.one, self.two, self.begin = by_position[0], by_position[1], n
        # Of the words with one ending, those that the corpus lacks count as one more.
        self.log_others = np.log10(np.append(corpus.other_tokens + corpus.other_distinct + 1.0, 1.0))

    def log10(self, k: np.ndarray, count: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 probability of each token of the documents that start at `starts`."""
        one, two = contexts(k, starts, self.begin)
        found = (self.one[one, k] + self.two[two, k] - self.log_z[one, two]) / np.log(10)
        inside = np.log10(count + 1.0) - self.log_others[np.minimum(k, ENDINGS)]
        return found + np.where(k < ENDINGS, inside, 0.0)


_SCORERS: dict[str, Scorer] = {}


def _scorer(name: str, model: Model, corpus: Corpus) -> Scorer:
    """The last scorer of this worker process, made once."""
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = Scorer(model, corpus)
    return _SCORERS[name]


def score_documents(docs: DataFrame) -> DataFrame:
    """n_tokens, n_known, train_tokens, base_score and score of every row, learnt from the training folds.

    A null or empty text is the end token alone. Null ids count as empty text when folds are dealt. Repeated rows give
    repeated results. Without training text every token is unseen and both scores are 0. Columns beside doc_id and text
    are not read.
    """
    spark = docs.sparkSession
    cut = blocks(docs.select("doc_id", "text"))
    words, corpus = count_words(cut)
    classes = dictionaries(cut, words, corpus)
    model = train(cut, classes, corpus)
    held = spark.sparkContext.broadcast((model, corpus))  # bounded by KNOWN and ENDINGS
    name = uuid.uuid4().hex
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(texts: pd.DataFrame, dictionary: pd.DataFrame) -> pd.DataFrame:
        scorer = _scorer(name, *held.value)
        counts = np.frombuffer(dictionary["c"].iloc[0], np.int64)
        ids, k, starts = _joined(texts, np.frombuffer(dictionary["k"].iloc[0], np.int16))
        c = counts[ids]
        lengths = np.diff(np.append(starts, len(ids)))
        smooth = np.log10(corpus.tokens + corpus.distinct + 1.0)
        return pd.DataFrame(
            {
                "doc_id": texts["doc_id"].to_numpy(),
                "held_out": texts["held_out"].to_numpy(bool),
                "n_tokens": lengths,
                "n_known": np.add.reduceat((c > 0).astype(np.int64), starts),
                "train_tokens": corpus.tokens,
                "base_score": np.add.reduceat(np.log10(c + 1.0), starts) - lengths * smooth,
                "score": np.add.reduceat(scorer.log10(k, c, starts), starts),
            }
        )

    texts = cut.filter("ids is not null").select("block", F.col("doc_id").cast("string").alias("doc_id"), "held_out", "ids")
    schema = (
        "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    scored = texts.groupBy("block").cogroup(classes.groupBy("block")).applyInPandas(score, schema)
    return scored.withColumn("doc_id", F.col("doc_id").cast(kind))
