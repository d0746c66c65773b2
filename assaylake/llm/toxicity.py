"""Toxicity by bags of subwords.

A word is the mean of the vectors of its character n-grams and of itself, a document
the mean of its distinct words, and a linear softmax tells the two labels apart; vectors and
softmax are trained together, in numpy, on a bounded sample of labelled rows. A
misspelt or newly inflected word shares most of its n-grams with the words that were
seen, and so their vectors.

The trained model is linear in the n-grams, so each hash bucket is reduced to one
number for scoring, which is a pass over the documents without any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import batch_of, byte_slices, texts_of
from assaylake.llm.wordscan import Prefix, Words, mix
from assaylake.session import settled

BUCKETS = 1 << 18
#: Lengths of the character n-grams.
GRAMS = (3, 4, 5)
#: Size of the vectors.
SIZE = 4
#: Labelled rows to learn from: so many of each label at the most, chosen by a hash of the id.
MOST_LABELLED = 1200
#: Standard errors by which the shares of the two labels' documents that have an n-gram
#: must differ for it to get a vector; the others count, but mean nothing.
SIGNIFICANT = 4.0
ROUNDS, RATE, DECAY = 60, 0.05, 1e-4
#: A document's mean is taken as if it had so many more words of no meaning, so that a
#: few words alone are no strong evidence.
PAD = 32
#: Means are multiplied by this before the softmax: one word in fifty may decide.
SCALE = 50.0
FOLDS = 5
SEED = 42


class Model(NamedTuple):
    """``weight``: for each bucket its part of the log odds of label 1; ``bias``: of no word."""

    weight: np.ndarray
    bias: float


def subwords(points: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of the n-grams of the words at ``first`` to ``last``, by word.

    An n-gram at the start or the end of its word is another one than inside.
    """
    prefix = Prefix(points)
    words, buckets = [np.arange(len(first))], [mix(prefix.runs(first, last) + np.uint64(7))]
    for n in GRAMS:
        count = np.maximum(last - first - n + 1, 0)
        word = np.repeat(np.arange(len(first)), count)
        start = first[word] + np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
        edge = (start == first[word]).astype(np.uint64) + np.uint64(2) * (start + n == last[word]).astype(np.uint64)
        words.append(word)
        buckets.append(mix(prefix.runs(start, start + n) + edge * np.uint64(0x9E3779B97F4A7C15)))
    word, bucket = np.concatenate(words), np.concatenate(buckets)
    order = np.argsort(word, kind="stable")
    return word[order], (bucket[order] & np.uint64(BUCKETS - 1)).astype(np.int64)


def distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Position of one of each distinct word, and for every word which it is."""
    _, at, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
    return at, which


class _Sparse:
    """A sparse matrix, to be multiplied with the columns of dense ones."""

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, shape: tuple[int, int]):
        self.shape = shape
        self.straight = self._sorted(row, col, value)
        self.turned = self._sorted(col, row, value)

    @staticmethod
    def _sorted(row: np.ndarray, col: np.ndarray, value: np.ndarray):
        order = np.argsort(row, kind="stable")
        row = row[order]
        begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else row
        return row[begins], begins, col[order].astype(np.int32), value[order].astype(np.float32)

    @staticmethod
    def _times(parts, columns: np.ndarray, n: int) -> np.ndarray:
        rows, begins, col, value = parts
        out = np.zeros((len(columns), n), np.float32)
        if len(rows):
            for k, column in enumerate(columns):
                out[k, rows] = np.add.reduceat(column[col] * value, begins)
        return out

    def times(self, columns: np.ndarray) -> np.ndarray:
        return self._times(self.straight, columns, self.shape[0])

    def turned_times(self, columns: np.ndarray) -> np.ndarray:
        return self._times(self.turned, columns, self.shape[1])


def _buckets_of(words: np.ndarray, first: np.ndarray, count: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """The buckets of these words, which have ``count`` each from ``first`` on."""
    n = count[words]
    return bucket[np.repeat(first[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def train(
    documents: Sequence[Sequence[str]], labels: Sequence[int], share: float | None = None, seed: int = SEED
) -> Model:
    """The model from documents, as lists of distinct words, and their labels.

    ``share`` is how frequent label 1 is where the model is used; by default as
    among these documents. If a label is missing, the model says that the other is
    certain enough (log odds of 2 or -2) whatever the text.
    """
    y = np.asarray(labels, np.int64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS, np.float32), 2.0 if len(y) and y[0] else -2.0)
    vocabulary: dict[str, int] = {}
    doc, word = [], []
    for d, bag in enumerate(documents):
        doc += [d] * len(bag)
        word += [vocabulary.setdefault(w, len(vocabulary)) for w in bag]
    doc, word = np.array(doc, np.int64), np.array(word, np.int64)
    part_of_doc = 1 / (np.bincount(doc, minlength=len(y)) + PAD)[doc]

    # every entry of the vocabulary is one word, whatever its characters
    joined = "\0".join(vocabulary)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
    last = np.cumsum(lengths + 1) - 1
    of_word, bucket = subwords(points, last - lengths, last)
    part = 1 / np.bincount(of_word)[of_word]

    # only n-grams that tell the labels apart beyond chance get a vector
    n_docs, bounds = np.zeros((2, BUCKETS)), np.searchsorted(doc, np.arange(len(y) + 1))
    grams = np.bincount(of_word, minlength=len(vocabulary))
    begins = np.cumsum(grams) - grams
    for d, label in enumerate(y):
        found = _buckets_of(word[bounds[d] : bounds[d + 1]], begins, grams, bucket)
        n_docs[label, np.unique(found)] += 1
    n = np.bincount(y, minlength=2)
    mean = n_docs.sum(0) / len(y)
    error = np.sqrt(mean * (1 - mean) * (1 / n[0] + 1 / n[1]))
    learned = np.flatnonzero(np.abs(n_docs[1] / n[1] - n_docs[0] / n[0]) > SIGNIFICANT * error)
    at = np.full(BUCKETS, -1)
    at[learned] = np.arange(len(learned))
    have = at[bucket] >= 0
    to_words = _Sparse(of_word[have], at[bucket[have]], part[have], (len(vocabulary), len(learned)))
    to_docs = _Sparse(doc, word, SCALE * part_of_doc, (len(y), len(vocabulary)))

    rng = np.random.default_rng(seed)
    params = [  # vectors and softmax by column, so that each is contiguous
        rng.normal(0, 0.1, (SIZE, len(learned))).astype(np.float32),
        rng.normal(0, 0.1, (2, SIZE)).astype(np.float32),
        np.zeros((2, 1), np.float32),
    ]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    truth = np.eye(2, dtype=np.float32)[:, y]
    share = y.mean() if share is None else share
    weight = (np.array([1 - share, share]) / np.bincount(y, minlength=2))[y].astype(np.float32)
    for k in range(1, ROUNDS + 1):
        vectors, softmax, bias = params
        hidden = to_docs.times(to_words.times(vectors))
        logits = softmax @ hidden + bias
        odds = np.exp(logits - logits.max(0))
        wrong = (odds / odds.sum(0) - truth) * weight
        back = to_words.turned_times(to_docs.turned_times(softmax.T @ wrong))
        gradients = [
            back + DECAY * vectors / len(learned), wrong @ hidden.T + DECAY * softmax, wrong.sum(1, keepdims=True)
        ]
        for p, g, m, v in zip(params, gradients, first, second, strict=True):  # Adam
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    vectors, softmax, bias = params
    table = np.zeros(BUCKETS, np.float32)
    table[learned] = SCALE * ((softmax[1] - softmax[0]) @ vectors)
    return Model(table, float(bias[1, 0] - bias[0, 0]))


def log_odds(texts: list[str], model: Model) -> np.ndarray:
    """Of every text: the bias and the mean over its distinct words of the mean over their n-grams."""
    words = Words(texts)
    if not len(words):
        return np.full(len(texts), model.bias)
    at, which = distinct_words(words)
    word, bucket = subwords(words.lower, words.first[at], words.last[at])
    score = np.bincount(word, weights=model.weight[bucket]) / np.bincount(word)
    pairs = np.unique(words.text * len(at) + which)
    text, kind = pairs // len(at), pairs % len(at)
    total = np.bincount(text, weights=score[kind], minlength=len(texts))
    return model.bias + total / (np.bincount(text, minlength=len(texts)) + PAD)


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Whether crc32 of the id as text leaves no remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def bag(text: str) -> list[str]:
    """The distinct words of a text, in lower case."""
    found = Words([text])
    at, _ = distinct_words(found)
    lower = found.lower.astype("<u4").tobytes()
    return [lower[4 * a : 4 * b].decode("utf-32-le", "surrogatepass")
            for a, b in zip(found.first[at].tolist(), found.last[at].tolist(), strict=True)]


def _bags(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("label", pa.int64()), ("words", pa.list_(pa.string()))])

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            yield batch_of(schema, [batch.column(0), [bag(t) for t in texts_of(batch.column(1))]])

    return docs.select(F.col("label").cast("long"), F.col("text").cast("string")).mapInArrow(
        collect, "label long, words array<string>"
    )


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MOST_LABELLED) -> Model:
    """A model from at most ``most`` labelled documents of each label, none held out.

    Labels other than 0 and 1, and ids with both, are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    clear = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    clear = settled(
        clear.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("m")).filter("label = m")
        .select("doc_id", "label"),
        "labels",
    )
    chosen = [
        tuple(r) for v in (0, 1)
        for r in clear.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    ]
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id long, label int")
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # 2 x ``most`` rows
    rows = _bags(sample).collect()
    # the order of rows that executors return does not change the model
    rows.sort(key=lambda r: (r["label"], r["words"]))
    counts = dict(clear.groupBy("label").count().collect())
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return train([r["words"] for r in rows], [r["label"] for r in rows], share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from the text alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            odds = np.clip(log_odds(texts_of(batch.column(1)), held.value), -500, 500)
            yield batch_of(schema, [batch.column(0), 1 / (1 + np.exp(-odds))])

    rated = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        rate, "doc_id long, score double"
    )
    return rated.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, the model learned from the labels.

    The score is the probability of label 1, taken to be as frequent as among the
    labels, from the whole text and nothing else. Texts that are null, empty or without a
    word have the bias alone. Equal texts have equal scores. Rows without an id are
    scored. Without usable labels of both kinds all documents get one score.
    """
    return score(docs, learn(docs, labels))
