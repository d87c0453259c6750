"""Operator 8: quality classifier on supervised subword embeddings.

A document is the mean of learned vectors of its hashed features: words, word pairs and
the character 3- and 4-grams of each word between its borders. A softmax layer turns the
mean into class probabilities. Vectors and layer are trained together by stochastic
gradient descent in numpy.

Training uses a bounded sample of the labelled rows (``train_docs`` documents and
``train_chars`` characters, in the order of a hash of their ids), so it costs the same at
any size. Of a document longer than an eighth of ``train_chars`` it sees that much from
the start, so no single one ends the sample early. Scoring is a map over the documents: the model is one number per bucket there,
since the mean and the last layer are both linear.

Defined cases: a null text counts as empty; a text without words has no features and gets
the score of the bias alone; rows with null or contradicting labels train on what they
say, null labels not at all; without any usable label of a document every score is 0.5. Repeated rows
are scored one by one; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import table, whole

BUCKETS = 1 << 16  # of each kind of feature: words, word pairs, character n-grams
SLICE_CHARS = 1_000_000
THRESHOLD = 0.7


@dataclass(frozen=True)
class Training:
    """Bounds of the sample and the settings of the descent."""

    train_docs: int = 2500
    train_chars: int = 8_000_000
    dim: int = 16
    epochs: int = 8
    rate: float = 0.5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``weight[f]`` is the vector of feature f times the layer's class difference."""

    weight: np.ndarray
    bias: float
    trained: bool = True  # False: no labelled document, every score is 0.5

    def probability(self, mean: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(mean + self.bias, -30, 30)))


def _ngram_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, bucket) of every character 3- and 4-gram, borders included."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    raw = np.frombuffer(b"\x02" + b"\x03\x02".join(words) + b"\x03", np.uint8)
    raw = raw.astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    places, buckets = [], []
    for n in (3, 4):
        if len(raw) < n:
            continue
        code = np.zeros(len(raw) - n + 1, np.uint64)
        for i in range(n):
            code = code * np.uint64(0x100000001B3) + raw[i : len(raw) - n + 1 + i]
        inside = owner[: len(code)] == owner[n - 1 :]
        code = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
        places.append(owner[: len(code)][inside])
        buckets.append(code[inside].astype(np.int64) + 2 * BUCKETS)
    return np.concatenate(places), np.concatenate(buckets)


def _features(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple]]:
    """Slices of documents as (first document, word codes, ends, distinct words' n-grams).

    Word codes number the distinct words of the slice; ends[i] is where document i of the
    slice ends among them.
    """
    start = 0
    while start < len(texts):
        words: list[str] = []
        ends: list[int] = []
        chars, at = 0, start
        while at < len(texts) and (at == start or chars + len(texts[at]) <= SLICE_CHARS):
            chars += len(texts[at])
            words += texts[at].split()
            ends.append(len(words))
            at += 1
        if words:
            codes, distinct = pd.factorize(np.array(words, dtype=object))
            raw = [w.encode("utf-8", "surrogatepass") for w in distinct]
            hashes = np.fromiter(map(crc32, raw), np.uint64, len(raw))
            yield start, codes, np.array(ends), (hashes, *_ngram_buckets(raw))
        else:
            none = np.zeros(0, np.int64)
            yield start, none, np.array(ends), (none.astype(np.uint64), none, none)
        start = at


def _pair_buckets(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Bucket of each word with its successor; a word that repeats itself has one bucket."""
    left, right = hashes[codes[:-1]], hashes[codes[1:]]
    mixed = (left * np.uint64(0x9E3779B97F4A7C15) + right) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed >> np.uint64(48)).astype(np.int64)
    return np.where(left == right, 0, np.maximum(mixed, 1)) + BUCKETS


def score_texts(texts: list[str], model: Model) -> np.ndarray:
    """Score of each text: the softmax of its mean feature."""
    out = np.zeros(len(texts))
    for start, codes, ends, (hashes, place, bucket) in _features(texts):
        n_words = len(hashes)
        word = model.weight[(hashes % np.uint64(BUCKETS)).astype(np.int64)]
        word = word + np.bincount(place, model.weight[bucket], n_words)[:n_words]
        n_of = 1 + np.bincount(place, minlength=n_words)[:n_words]
        sums = np.concatenate([[0.0], np.cumsum(word[codes])])
        counts = np.concatenate([[0], np.cumsum(n_of[codes])])
        pairs = np.zeros(len(codes) + 1)
        if len(codes) > 1:
            pairs[2:] = np.cumsum(model.weight[_pair_buckets(hashes, codes)])
        begins = np.concatenate([[0], ends[:-1]])
        n = counts[ends] - counts[begins] + np.maximum(ends - begins - 1, 0)
        first = np.minimum(begins + 1, ends)  # pairs do not reach over documents
        total = sums[ends] - sums[begins] + pairs[ends] - pairs[first]
        out[start : start + len(ends)] = total / np.maximum(n, 1)
    return model.probability(out)


def count_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of one text and the share of each."""
    buckets = []
    for _, codes, _, (hashes, place, bucket) in _features([text]):
        if len(codes):
            often = np.bincount(codes, minlength=len(hashes))
            buckets.append(((hashes % np.uint64(BUCKETS)).astype(np.int64), often))
            buckets.append((bucket, often[place]))
            if len(codes) > 1:
                pairs = _pair_buckets(hashes, codes)
                buckets.append((pairs, np.ones(len(pairs), np.int64)))
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0)
    ids = np.concatenate([b for b, _ in buckets])
    weights = np.concatenate([w for _, w in buckets]).astype(float)
    distinct, inverse = np.unique(ids, return_inverse=True)
    share = np.bincount(inverse, weights)
    return distinct.astype(np.int32), (share / share.sum()).astype(np.float32)


def descend(rows: list[tuple[np.ndarray, np.ndarray, int]], how: Training) -> Model:
    """Stochastic gradient descent over (features, shares, label) rows."""
    random = np.random.default_rng(how.seed)
    vectors = random.uniform(-1 / how.dim, 1 / how.dim, (3 * BUCKETS, how.dim))
    vectors = vectors.astype(np.float32)
    layer, bias = np.zeros((how.dim, 2)), np.zeros(2)
    steps, done = max(1, how.epochs * len(rows)), 0
    for _ in range(how.epochs):
        for i in random.permutation(len(rows)):
            ids, share, label = rows[i]
            rate = how.rate * (1 - done / steps)
            done += 1
            mean = share @ vectors[ids]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[label] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            # A feature's share of a mean is tiny; without the scale it would not learn.
            vectors[ids] -= (rate * np.minimum(share * 100, 1.0))[:, None] * back
    weight = vectors.astype(float) @ (layer[:, 1] - layer[:, 0])
    return Model(weight, float(bias[1] - bias[0]))


def is_held_out(doc_id: Column | str) -> Column:
    """One quarter of the ids, which no training sees."""
    text = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    rest = F.crc32(text.cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", how: Training = Training()
) -> Model:
    """The model of a bounded sample of the labelled rows that are not held out."""
    usable = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).filter(
        ~is_held_out("doc_id")
    )
    sample = (
        usable.select("doc_id", F.col(label).cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(how.train_docs)
    )
    # At most train_docs rows of two numbers.
    passage = F.substring(whole("text"), 1, how.train_chars // 8)
    texts = docs.select("doc_id", passage.alias("text")).join(F.broadcast(sample), "doc_id")
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "label", F.xxhash64("text"))
    bounded = (
        texts.withColumn("chars", F.length("text"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label", F.xxhash64("text"))
        .limit(how.train_docs)
        .withColumn("sum_chars", F.sum("chars").over(order))
        .filter(F.col("sum_chars") <= how.train_chars)
        .select("text", "label")
    )
    rows = [(*count_features(r.text), r.label) for r in bounded.toLocalIterator()]
    if not rows:
        if not docs.join(usable.select("doc_id"), "doc_id", "left_semi").isEmpty():
            raise ValueError("there are labelled documents, but none is in the training sample")
        return Model(np.zeros(3 * BUCKETS), 0.0, trained=False)
    return descend(rows, how)


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Probability of label 1 as a column of ``docs``."""

    @F.pandas_udf(DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(score_texts(texts.tolist(), model))

    return scored(whole(docs[text]))


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted, which replace columns of these names."""
    scored = docs.withColumn("score", score(docs, model))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return classify(docs.select("doc_id", "text"), model).select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "score", "predicted"
    )
