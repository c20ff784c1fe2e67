"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it.
Each byte becomes a learned vector; learned filters run over the chunk, are
max-pooled, and a small layer makes the chunk's score. The mean of the chunks'
scores, through a sigmoid, is the text's probability of label 1. The network
is trained on a bounded, class-balanced sample of labelled documents, chunk by
chunk, with a fixed seed; its scores are then moved from the sample's share of
label 1 to the share among all training labels.

Inputs: a null text is the empty text; the empty text is one chunk of padding
and gets a score too. Null labels are left out. Without training rows of both
classes the score is the share of label 1 (0.5 without any). Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, crc_remainder, labelled_texts, slices, table, utf8_texts

CHUNK, STRIDE = 512, 448
WIDTH, DIM, FILTERS, HIDDEN = 6, 8, 24, 16
#: Training documents of each class, and chunks of each, at most.
SAMPLE_PER_CLASS = 2400
CHUNKS_PER_DOCUMENT = 6
EPOCHS, BATCH, RATE = 8, 64, 0.004
THRESHOLD = 0.7
PADDING = 256
#: Chunks whose windows are held at once.
CHUNKS_AT_ONCE = 64


def chunks(text: bytes) -> np.ndarray:
    """(chunks, CHUNK) byte values, PADDING past the end."""
    n = max(1, -(-(len(text) - CHUNK) // STRIDE) + 1) if len(text) > CHUNK else 1
    flat = np.full(STRIDE * (n - 1) + CHUNK, PADDING, dtype=np.int16)
    flat[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::STRIDE]


class Network:
    """Parameters, and the forward and backward passes."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        scaled = lambda *shape, by: (rng.standard_normal(shape) / np.sqrt(by)).astype(np.float32)
        self.p = {
            "embed": scaled(257, DIM, by=DIM),
            "conv": scaled(WIDTH * DIM, FILTERS, by=WIDTH),
            "conv_bias": np.zeros(FILTERS, dtype=np.float32),
            "dense": scaled(FILTERS, HIDDEN, by=FILTERS),
            "dense_bias": np.zeros(HIDDEN, dtype=np.float32),
            "out": scaled(HIDDEN, by=HIDDEN),
            "out_bias": np.zeros(1, dtype=np.float32),
        }
        self.p["embed"][PADDING] = 0
        self.prior: float | None = None
        self.shift = 0.0  # log odds of label 1 among all labels over those in the sample

    def _windows(self, x: np.ndarray) -> np.ndarray:
        """(chunks * places, WIDTH * DIM) embedded windows."""
        held = self.p["embed"][x]
        view = np.lib.stride_tricks.sliding_window_view(held, WIDTH, axis=1)
        return view.transpose(0, 1, 3, 2).reshape(-1, WIDTH * DIM)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest response of each filter in each chunk, and where."""
        places = CHUNK - WIDTH + 1
        response = (self._windows(x) @ self.p["conv"]).reshape(len(x), places, FILTERS)
        top = response.max(axis=1)
        return top, response

    def logits(self, x: np.ndarray) -> np.ndarray:
        top, _ = self.pooled(x)
        pooled = np.maximum(top + self.p["conv_bias"], 0)
        hidden = np.maximum(pooled @ self.p["dense"] + self.p["dense_bias"], 0)
        return hidden @ self.p["out"] + self.p["out_bias"]

    def score(self, text: bytes) -> float:
        if self.prior is not None:
            return self.prior
        x = chunks(text)
        total = sum(float(self.logits(x[a : a + CHUNKS_AT_ONCE]).sum())
                    for a in range(0, len(x), CHUNKS_AT_ONCE))
        return float(1 / (1 + np.exp(-np.clip(total / len(x) + self.shift, -30, 30))))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy; only the pooled places pass it on."""
        p = self.p
        top, response = self.pooled(x)
        where = response.argmax(axis=1)
        pre = top + p["conv_bias"]
        pooled = np.maximum(pre, 0)
        before = pooled @ p["dense"] + p["dense_bias"]
        hidden = np.maximum(before, 0)
        z = hidden @ p["out"] + p["out_bias"]
        dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = {"out": hidden.T @ dz, "out_bias": np.array([dz.sum()])}
        dh = np.outer(dz, p["out"]) * (before > 0)
        g["dense"], g["dense_bias"] = pooled.T @ dh, dh.sum(axis=0)
        dp = (dh @ p["dense"].T) * (pre > 0)
        g["conv_bias"] = dp.sum(axis=0)
        reach = where[:, :, None] + np.arange(WIDTH)          # chunk, filter, offset
        values = x[np.arange(len(x))[:, None, None], reach]
        held = p["embed"][values].reshape(len(x), FILTERS, WIDTH * DIM)
        g["conv"] = np.einsum("nfk,nf->kf", held, dp)
        back = (dp[:, :, None] * p["conv"].T[None]).reshape(len(x), FILTERS, WIDTH, DIM)
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], values.reshape(-1), back.reshape(-1, DIM))
        g["embed"][PADDING] = 0
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        """Adam over shuffled batches, the rate falling to zero."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        steps, step = epochs * -(-len(x) // BATCH), 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), BATCH):
                rows = order[a : a + BATCH]
                step += 1
                rate = RATE * (1 - (step - 1) / steps)
                for k, v in self.gradients(x[rows], y[rows]).items():
                    first[k] += 0.1 * (v - first[k])
                    second[k] += 0.001 * (v * v - second[k])
                    self.p[k] -= (rate * (first[k] / (1 - 0.9 ** step)) /
                                  (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)


def _sampled_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, quality) -> up to CHUNKS_PER_DOCUMENT chunks, evenly spread."""
    for batch in slices(batches):
        rows, labels = [], []
        for text, label in zip(utf8_texts(batch.column(0)), batch.column(1).to_pylist()):
            x = chunks(text)
            for i in np.unique(np.linspace(0, len(x) - 1, CHUNKS_PER_DOCUMENT).astype(int)):
                rows.append(x[i].astype("<i2").tobytes())
                labels.append(label)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(labels, pa.int32())],
                                         names=["chunk", "label"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Network:
    """Fit on at most ``per_class`` labelled documents of each class, the first
    by a hash of the id (a few MB of chunks on the driver)."""
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    # at most 2 * per_class texts, CHUNKS_PER_DOCUMENT chunks of each
    rows = (labelled_texts(docs, labels, "quality", per_class)
            .mapInArrow(_sampled_chunks, "chunk binary, label int").collect())
    rows.sort(key=lambda r: (r["label"], r["chunk"]))  # the same model however tasks end
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    net = Network()
    y = np.array([r["label"] for r in rows], dtype=np.float32)
    if not len(y) or y.min() == y.max():
        net.prior = float(y.mean()) if len(y) else 0.5
        return net
    net.fit(np.stack([np.frombuffer(r["chunk"], dtype="<i2") for r in rows]), y)
    net.shift = float(np.log(shares[1] / shares[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return net


def scored(docs: DataFrame, net: Network, keep: list[str], name: str = "score") -> DataFrame:
    """Columns ``keep`` and the quality score of every whole text."""
    return add_columns(docs, ["text"], f"`{name}` double", lambda col: [
        pa.array([net.score(t) for t in utf8_texts(col)], pa.float64())], keep)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    fold = crc_remainder(F.col("doc_id"), 4)
    labels = table(spark, sf_dir, "labels")
    net = train(docs, labels.filter(fold != 2))
    return scored(docs, net, ["doc_id"]).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
