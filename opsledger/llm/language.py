"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams, follow-the-regularised-leader.

A text's lower-case words, each between blanks, give n-grams of 1 to ``LONGEST`` characters, hashed into ``2 ** BITS``
features. Document frequencies are counted over all rows that may be learned from. Weights are trained by
FTRL-proximal with elastic-net penalties (L1 makes them sparse) on a bounded sample: about ``PER_LANGUAGE`` rows of each
language and ``MAX_SAMPLE`` in all, but ``LEAST_ROWS`` of each however many languages there are, those with the smallest
hashed ids. A fifth of the sample is held back and only sets the temperature of the softmax. The model, every language
by ``2 ** BITS`` numbers of four bytes, is broadcast.

Defined cases: a text that is null or has no letter gets ``und`` with score 0, and so does every text if there is nothing
to learn from; null languages, ids and texts are not learned from; ties between languages go to the first by code point;
repeated rows are scored alike; an empty table gives no rows. Extra columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import bucket_of_id, opened, shipped, small_batches, store, table
from .shingles import mix

LONGEST, BITS = 3, 14
PER_LANGUAGE, MAX_SAMPLE, LEAST_ROWS = 1024, 8192, 32
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 1e-4, 4
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")
_FACTORS = [pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64) for i in range(8)]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers in order and their counts."""
    codes = np.frombuffer((" " + _OTHER.sub(" ", text.lower()).strip() + " ").encode("utf-32-le"), np.uint32)
    codes = codes.astype(np.uint64)
    found = []
    for n in range(1, LONGEST + 1):
        size = len(codes) - n + 1
        if size > 0:
            joined = np.full(size, n, np.uint64)
            for i in range(n):
                joined += codes[i:i + size] * np.uint64(_FACTORS[i])
            found.append(mix(joined) >> np.uint64(64 - BITS))
    counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=1 << BITS)
    ids = np.flatnonzero(counts)
    return ids, counts[ids]


def weigh(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[ids]
    return values / np.sqrt((values ** 2).sum())


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int) -> np.ndarray:
    """Weights of (feature, label); one row of ``rows`` is (feature ids, values)."""
    z = np.zeros((1 << BITS, n_labels))
    n = np.zeros((1 << BITS, n_labels))

    def weights(ids):
        near, far = z[ids], n[ids]
        return np.where(np.abs(near) <= L1, 0.0, -(near - np.sign(near) * L1) / ((BETA + np.sqrt(far)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for r in order.permutation(len(rows)):
            ids, values = rows[r]
            w = weights(ids)
            error = softmax(values @ w)
            error[labels[r]] -= 1
            gradient = values[:, None] * error[None, :]
            square = gradient ** 2
            z[ids] += gradient - (np.sqrt(n[ids] + square) - np.sqrt(n[ids])) / ALPHA * w
            n[ids] += square
    return weights(np.arange(1 << BITS))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by a search of narrowing steps."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    at, step = 0.0, 1.0
    while step > 1e-3:
        at, before = min((at - step, at, at + step), key=loss), at
        at = float(np.clip(at, -3, 3))
        if at == before:
            step /= 2
    return float(np.exp(at))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        ids, counts = features(text)
        p = softmax(weigh(ids, counts, self.idf) @ self.weights[ids] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _fit_rows(languages: list[str], idf: np.ndarray):
    """Trains in one task on the bounded sample of (h, lang, ids, counts)."""
    def fit_rows(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "doc_id"])
        known = {x: i for i, x in enumerate(languages)}
        labels = np.array([known[x] for x in rows["lang"]])
        data = [(np.asarray(i, np.int64), weigh(np.asarray(i, np.int64), np.asarray(c, np.int64), idf))
                for i, c in zip(rows["ids"], rows["counts"], strict=True)]
        held = np.arange(len(data)) % 5 == 4
        weights = train([d for d, h in zip(data, held, strict=True) if not h], labels[~held], len(languages))
        logits = np.array([v @ weights[i] for (i, v), h in zip(data, held, strict=True) if h]).reshape(-1, len(languages))
        return pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "t": [temperature(logits, labels[held])]})
    return fit_rows


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """``docs``: doc_id, text, lang of the rows that may be learned from."""
    small_batches(docs.sparkSession)
    docs = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = docs.groupBy("lang").agg(F.count("*").alias("n")).collect()  # one row per language
    languages = sorted(r.lang for r in sizes)
    per_language = min(per_language, max(LEAST_ROWS, MAX_SAMPLE // max(len(languages), 1)))
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, 0)), 1.0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[features(text)[0]] += 1
                total += 1
        if total:
            ids = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array([*ids.tolist(), -1]), pa.array([*seen[ids].tolist(), total])], ["f", "n"])

    counted = docs.select("text").mapInArrow(frequencies, "f long, n long").groupBy("f").agg(F.sum("n").alias("n"))
    seen = np.zeros(1 << BITS)
    total = 0
    for row in counted.collect():  # one row per feature
        if row.f < 0:
            total = row.n
        else:
            seen[row.f] = row.n
    idf = np.log((total + 1) / (seen + 1)) + 1

    # the sample: per language the rows whose hash lies in the share that holds about ``per_language`` rows
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    share = F.create_map(*[x for r in sizes for x in (F.lit(r.lang), F.lit(int(min(1.0, per_language / r.n) * (1 << 40))))])
    chosen = docs.select("doc_id", "lang", "text", h.alias("h")).where(F.col("h") < share[F.col("lang")])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([f[0] for f in found], pa.list_(pa.int64())),
                 pa.array([f[1] for f in found], pa.list_(pa.int64()))], ["doc_id", "lang", "h", "ids", "counts"])

    rows = chosen.select(F.col("doc_id").cast("long"), "lang", "h", "text").mapInArrow(
        describe, "doc_id long, lang string, h long, ids array<long>, counts array<long>")
    made = store(rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(_fit_rows(languages, idf), "weights binary, t double"), "language-model")
    row = made.first()
    weights = np.frombuffer(row.weights, np.float32).reshape(1 << BITS, len(languages))
    return Model(languages, idf, weights, row.t)


def predicted(text: Column, model: Model, spark) -> Column:
    """struct<lang, score>."""
    small_batches(spark)
    parcel = shipped(spark, model)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = opened(parcel)
        for texts in batches:
            yield pd.DataFrame([known.predict(t) for t in texts], columns=["lang", "score"])

    return predict(text.cast("string"))


def op6_language(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = bucket_of_id(F.col("doc_id"), 3) == 1
    model = fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    found = docs.select("doc_id", held_out.alias("held_out"), predicted(F.col("text"), model, spark).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
