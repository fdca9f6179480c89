"""Quality classifier by compression.

Two zstandard dictionaries are built from good and bad labelled texts.  A
text is compressed with either, and without one; the size difference between
the two, normalised by their sum (over the text, and of its worst chunk), and
the plain compressed share are mapped to the chance of label 1 by a logistic
curve, fitted on labelled texts that the dictionaries have not seen and
weighted to the labels' class shares.

Fitting uses at most ``SAMPLE`` texts per class of up to ``SAMPLE_CHARS``
characters each (those with the smallest hashed ids), a documented bound;
scoring reads every whole text, chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .book import query
from .common import table

SAMPLE, SAMPLE_CHARS = 2000, 20_000
DICT_BYTES, CHUNK, LEAST, LEVEL = 1 << 16, 4096, 64, 3
FOLDS, HELD_OUT_FOLD, ACCEPT = 5, 0, 0.3


@dataclass(frozen=True)
class Model:
    """Dictionaries and the calibration; without labels of both classes there
    are no dictionaries and every text gets ``prior``."""

    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float


def _dictionary(texts: list[bytes]) -> bytes:
    """Dictionary of short segments: long ones would memorise passages that
    good texts may share with the bad ones of the sample."""
    chunks = [t[i : i + CHUNK] for t in texts for i in range(0, len(t), CHUNK)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, chunks, k=32, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: its bytes are the dictionary
        return b"".join(chunks)[-DICT_BYTES:]


class Sizes:
    """Compressed sizes of whole texts under both dictionaries and none."""

    def __init__(self, good: bytes, bad: bytes):
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.by = [zstandard.ZstdCompressor(**options)]
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, **options))

    def features(self, text: bytes) -> list[float]:
        """Size differences and shares of a text that is not empty; a last
        chunk under ``LEAST`` bytes is not judged alone."""
        view, n = memoryview(text), len(text)
        size = np.array([[len(c.compress(view[i : i + CHUNK])) for c in self.by] for i in range(0, n, CHUNK)])
        length = np.minimum(CHUNK, n - np.arange(0, n, CHUNK))
        plain, good, bad = size.sum(axis=0).tolist()
        share = min(plain / n, 2.0)
        whole = length >= min(LEAST, n)
        worst = ((size[:, 2] - size[:, 1]) / (size[:, 2] + size[:, 1]))[whole].min()
        return [(bad - good) / (bad + good), (bad - good) / n, share, share * share, float(worst),
                float((size[:, 0] / length)[whole].min()), min(1.0, float(np.log(n)) / 10)]


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(a.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + penalty @ w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + penalty
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fold_of(doc_id: Column) -> Column:
    """Fold by the checksum of the id's decimal digits (a null id: of no text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on labelled documents outside the held-out fold.

    Labels other than 0 and 1 and null ids are left out; an id labelled twice
    counts as its higher label, an id with several texts as its first."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(fold_of(F.col("doc_id")) != HELD_OUT_FOLD)
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").alias("quality"))
    share = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    drawn = [known.where(F.col("quality") == q).orderBy(F.xxhash64("id"), "id").limit(sample) for q in (0, 1)]
    texts = (docs.where(F.length("text").between(1, SAMPLE_CHARS)).select(F.col("doc_id").alias("id"), "text")
             .join(F.broadcast(drawn[0].unionAll(drawn[1])), "id").groupBy("id", "quality").agg(F.min("text").alias("text")))
    rows = sorted(texts.collect(), key=lambda r: r["id"])
    by = {q: [r["text"].encode() for r in rows if r["quality"] == q] for q in (0, 1)}
    prior = share.get(1, 0) / max(1, sum(share.values())) if share else 0.5
    if min(map(len, by.values())) < 2:
        return Model(b"", b"", (), (), (), prior)
    good, bad = (_dictionary(by[q][::2]) for q in (1, 0))
    sizes = Sizes(good, bad)
    x = np.array([sizes.features(t) for q in (0, 1) for t in by[q][1::2]])
    y = np.repeat([0.0, 1.0], [len(by[q][1::2]) for q in (0, 1)])
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    weight = np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum())
    w = _fit((x - mean) / scale, y, weight * len(y) / weight.sum())
    return Model(good, bad, tuple(mean), tuple(scale), tuple(w), prior)


def scores(model: Model, texts: pa.Array, sizes: Sizes | None) -> np.ndarray:
    """Chance of label 1 for each text; a null or empty text has no evidence
    and gets the labels' share of 1."""
    if sizes is None:
        return np.full(len(texts), model.prior)
    out = np.empty(len(texts))
    mean, scale, w = map(np.array, (model.mean, model.scale, model.weights))
    for i, t in enumerate(texts.cast(pa.large_binary())):
        raw = t.as_py()
        if not raw:
            out[i] = model.prior
        else:
            z = w[0] + (np.array(sizes.features(raw)) - mean) / scale @ w[1:]
            out[i] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return out


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row (repeated rows too)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad) if model.weights else None
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(scores(model, b.column(2), sizes))], ["doc_id", "held_out", "score"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (fold_of(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out"), "text")
    return base.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score at least ``ACCEPT``, all columns kept."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad) if model.weights else None
        for b in batches:
            yield b.filter(pa.array(scores(model, b.column(at), sizes) >= ACCEPT))

    return docs.mapInArrow(run, docs.schema)


@query("op9_compression_classifier")
def op9(spark, sf_dir):
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
