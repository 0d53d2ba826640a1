"""A quality classifier on learned subword embeddings.

Words, pairs of neighbouring words and character n-grams are hashed into rows of a table of learned
vectors; a text is the mean of its vectors, and a softmax over it gives the classes. It is trained by
stochastic gradient descent in numpy, inside one task, on at most ``max_train`` labelled documents
(the bound is a parameter and does not grow with the corpus). As the softmax of two classes needs one
number per vector, a trained model is a table of 2**18 floats that goes to every task.

Defined results: a null text is empty; an empty text has the score of the bias alone; without usable
labels every score is 0.5; labels that are null or not 0 or 1 are not learned from; of rows that
repeat a labelled id, the least text and the lower label count; rows without an id are scored, and not
held out; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.llm.common import texts

BUCKET_BITS = 18
DIMENSIONS = 8
GRAMS = (2, 3, 4, 5)
EPOCHS = 8
RATE = 0.5
SEED = 7
MAX_TRAIN = 4_096
ACCEPT = 0.3
FOLDS = 5
#: Bytes of a text that are hashed at once; features of neighbouring stretches overlap by the longest n-gram.
STRETCH = 1 << 20

_FEW = np.random.default_rng(SEED)
_BYTE = _FEW.integers(0, 1 << 63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _grams(raw: np.ndarray) -> list[np.ndarray]:
    """Buckets of the n-grams; blanks may only be their first or last byte."""
    blank, code = _BLANK[raw], _BYTE[raw]
    out, h = [], code
    inner = np.zeros(len(raw), bool)  # whether a blank lies strictly inside the gram that starts here
    for n in range(2, max(GRAMS) + 1):
        if len(raw) < n:
            break
        h = (h[: len(raw) - n + 1] * _STEP) ^ code[n - 1 :]
        inner = inner[: len(h)]
        if n > 2:
            inner = inner | blank[n - 2 : n - 2 + len(h)]
        if n in GRAMS:
            out.append(_bucket(h[~inner]))
    return out


def _words(raw: np.ndarray) -> list[np.ndarray]:
    """Buckets of the words, and of neighbouring words by how their hashes differ."""
    blank = _BLANK[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not starts.size:
        return []
    lengths = ends - starts
    power = np.ones(int(lengths.max()), np.uint64)
    power[1:] = np.multiply.accumulate(np.full(len(power) - 1, _STEP))
    inside = ~blank
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    offset = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    h = np.add.reduceat(_BYTE[raw[inside]] * power[offset], first)
    out = [_bucket(h + np.uint64(1))]
    if len(h) > 1:
        out.append(_bucket((h[1:] - h[:-1]) + np.uint64(2)))
    return out


def features(text: str) -> np.ndarray:
    """Buckets of all features of the whole text, repeats included."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not raw.size:
        return np.empty(0, np.int64)
    found = _words(raw)
    for at in range(0, len(raw), STRETCH):
        for n, grams in zip(GRAMS, _grams(raw[at : at + STRETCH + max(GRAMS) - 1]), strict=False):
            found.append(grams)
    return np.concatenate(found) if found else np.empty(0, np.int64)


@dataclass(frozen=True)
class Model:
    """``log odds = bias + mean of weights[buckets]``."""

    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        buckets = features(text)
        x = self.bias + (float(self.weights[buckets].mean(dtype=np.float64)) if buckets.size else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(x, -500, 500))))


def fit(rows: list[tuple[str, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Softmax regression on the mean of learned vectors, one document a step, the rate falling to zero."""
    bags = []
    for text, label in rows:
        buckets, times = np.unique(features(text), return_counts=True)
        bags.append((buckets.astype(np.int32), (times / max(1, times.sum())).astype(np.float32), int(label)))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    out, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps, step = max(1, epochs * len(bags)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(bags)):
            buckets, share, label = bags[k]
            pace = rate * (1 - step / steps)
            step += 1
            mean = share @ table[buckets]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = out @ p
            out -= pace * np.outer(mean, p)
            bias -= pace * p
            # every vector moves by its share, scaled so that long and short texts learn alike
            table[buckets] -= (pace * len(buckets) ** 0.5) * share[:, None] * back[None, :]
    gap = out[:, 1] - out[:, 0]
    return Model((table @ gap).astype(np.float32), float(bias[1] - bias[0]) if bags else 0.0)


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of ``labels.quality``, learned from rows outside fold 0 only, at most ``max_train`` of them."""
    chosen = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("id").isNotNull() & F.col("quality").isin(0, 1) & (fold(F.col("id")) != 0))
        .groupBy("id").agg(F.min("quality").alias("quality"))
        .withColumn("turn", F.xxhash64(F.lit(SEED), "id"))
        .orderBy("turn", "id").limit(max_train)
    )
    rows = (
        texts(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
        .groupBy("turn", "id", "quality").agg(F.min("text").alias("text"))
    )

    def learn(frames):
        frames = [f for f in frames if len(f)]
        rows = pd.concat(frames).sort_values(["turn", "id"]) if frames else pd.DataFrame({"text": [], "quality": []})
        model = fit(list(zip(rows["text"], rows["quality"], strict=True)))
        yield pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    found = rows.repartition(1).mapInPandas(learn, "weights binary, bias double").first()
    if found is None:
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), 0.0)
    return Model(np.frombuffer(bytes(found["weights"]), np.float32), found["bias"])


def score_column(spark, model: Model):
    """A column function of a text: its score under the model."""
    shared = spark.sparkContext.broadcast((model.weights, model.bias))

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        own = Model(*shared.value)
        return pd.Series([own.score("" if x is None else x) for x in text], dtype="float64")

    return score


def score_documents(
    docs: DataFrame, labels: DataFrame, accept: float = ACCEPT, max_train: int = MAX_TRAIN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    score = score_column(docs.sparkSession, train(docs, labels, max_train, id_col, text_col))
    return texts(docs, id_col, text_col).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), score("text").alias("score")
    ).withColumn("predicted", (F.col("score") >= accept).cast("int"))
