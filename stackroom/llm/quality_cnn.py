"""A byte-level convolutional network in numpy that scores the quality of whole texts.

Bytes are embedded; learned filters slide over chunks that overlap by a filter's width less one, so that every window
of the document lies in exactly one chunk; each filter keeps its maximum in each chunk. The greatest and the mean of
these maxima over all chunks go into one logistic unit. Only the bytes of the text are an input.

The network is small (a few kilobytes) and is fitted in one task, on a sample of labelled rows with a fixed bound
(``CnnSpec.train_rows`` texts of at most ``train_bytes`` bytes each). Scoring covers every byte of every document.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import slices

PAD = 256


@dataclass(frozen=True)
class CnnSpec:
    filters: int = 16
    width: int = 8
    embedding: int = 4
    chunk: int = 1024
    epochs: int = 12
    batch: int = 32
    rate: float = 0.01
    seed: int = 7
    train_rows: int = 3000
    train_bytes: int = 32_768
    chunks_at_once: int = 128


def split_chunks(text: bytes, spec: CnnSpec) -> np.ndarray:
    """A row of byte numbers for each chunk; the last one is filled up with ``PAD``. An empty text has one chunk."""
    step = spec.chunk - spec.width + 1
    count = max(1, -(-(len(text) - spec.width + 1) // step))
    padded = np.full(step * count + spec.width - 1, PAD, np.int16)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, spec.chunk)[::step]


class ByteCnn:
    def __init__(self, spec: CnnSpec):
        draw = np.random.default_rng(spec.seed)
        self.spec = spec
        self.embed = draw.normal(0, 0.5, (PAD + 1, spec.embedding)).astype(np.float32)
        self.kernel = draw.normal(0, (spec.width * spec.embedding) ** -0.5, (spec.width * spec.embedding, spec.filters)).astype(np.float32)
        self.bias = np.zeros(spec.filters, np.float32)
        self.out = draw.normal(0, 0.1, 2 * spec.filters).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.kernel, self.bias, self.out, self.out_bias]

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum of each filter in each chunk (after the rectifier), and where it lies."""
        spec = self.spec
        windows = np.lib.stride_tricks.sliding_window_view(self.embed[chunks], spec.width, axis=1)
        flat = windows.transpose(0, 1, 3, 2).reshape(-1, spec.width * spec.embedding)
        response = (flat @ self.kernel).reshape(len(chunks), -1, spec.filters)
        at = response.argmax(axis=1)
        best = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0, :] + self.bias
        return np.maximum(best, 0), at

    def maxima(self, chunks: np.ndarray) -> np.ndarray:
        """As ``pooled`` without the places."""
        spec = self.spec
        windows = np.lib.stride_tricks.sliding_window_view(self.embed[chunks], spec.width, axis=1)
        flat = windows.transpose(0, 1, 3, 2).reshape(-1, spec.width * spec.embedding)
        response = (flat @ self.kernel).reshape(len(chunks), -1, spec.filters)
        return np.maximum(response.max(axis=1) + self.bias, 0)

    def score(self, text: bytes | None) -> float:
        chunks = split_chunks(text or b"", self.spec)
        step = self.spec.chunks_at_once
        top, total = np.zeros(self.spec.filters, np.float32), np.zeros(self.spec.filters, np.float64)
        for start in range(0, len(chunks), step):
            found = self.maxima(chunks[start : start + step])
            top = np.maximum(top, found.max(axis=0))
            total += found.sum(axis=0)
        features = np.concatenate([top, (total / len(chunks)).astype(np.float32)])
        return float(1 / (1 + np.exp(-np.clip(features @ self.out + self.out_bias[0], -30, 30))))

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean logistic loss; through a maximum only the window that holds it gets a share."""
        spec = self.spec
        parts = [split_chunks(t, spec) for t in texts]
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        chunks = np.concatenate(parts)
        found = [self.pooled(chunks[i : i + spec.chunks_at_once]) for i in range(0, len(chunks), spec.chunks_at_once)]
        best, at = (np.concatenate(x) for x in zip(*found))
        count = np.bincount(owner, minlength=len(parts)).astype(np.float32)
        first = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(int)
        top = np.maximum.reduceat(best, first, axis=0)
        mean = np.add.reduceat(best, first, axis=0) / count[:, None]
        features = np.concatenate([top, mean], axis=1)
        error = (1 / (1 + np.exp(-np.clip(features @ self.out + self.out_bias, -30, 30))) - labels) / len(labels)
        back = error[:, None] * self.out
        share = back[owner, spec.filters :] / count[owner, None]
        is_top = best == top[owner]
        share = share + is_top * back[owner, : spec.filters] / np.maximum(1, np.add.reduceat(is_top, first, axis=0))[owner]
        share = np.where(best > 0, share, 0).astype(np.float32)
        rows, columns = np.nonzero(share)
        weight = share[rows, columns]
        held = chunks[rows[:, None], at[rows, columns][:, None] + np.arange(spec.width)]
        window = self.embed[held]
        kernel = np.zeros_like(self.kernel)
        np.add.at(kernel.T, columns, weight[:, None] * window.reshape(len(rows), -1))
        embed = np.zeros_like(self.embed)
        np.add.at(embed, held, weight[:, None, None] * self.kernel.T[columns].reshape(-1, spec.width, spec.embedding))
        return [embed, kernel, share.sum(axis=0), (error @ features).astype(np.float32), error.sum(keepdims=True).astype(np.float32)]


def fit(texts: list[bytes], labels: list[int], spec: CnnSpec = CnnSpec()) -> ByteCnn:
    """Adam over shuffled batches. Without rows the network is left as drawn, which scores near one half."""
    model, draw = ByteCnn(spec), np.random.default_rng(spec.seed)
    wanted = np.asarray(labels, np.float32)
    if len(wanted):
        share = np.clip(wanted.mean(), 0.01, 0.99)
        model.out_bias[:] = np.log(share / (1 - share))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in model.parameters()]
    step = 0
    for epoch in range(spec.epochs):
        rate = spec.rate * 0.5 * (1 + np.cos(np.pi * epoch / spec.epochs))
        order = draw.permutation(len(texts))
        for start in range(0, len(order), spec.batch):
            rows = order[start : start + spec.batch]
            step += 1
            for value, slope, (m, v) in zip(model.parameters(), model.gradients([texts[i] for i in rows], wanted[rows]), moments):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; documents with 0 are held out and never learned from."""
    return F.crc32(doc_id.cast("long").cast("string")) % 5


def training_sample(docs: DataFrame, labels: DataFrame, spec: CnnSpec) -> DataFrame:
    """(text, quality) of at most ``train_rows`` labelled texts, chosen by a hash of the id; the list of ids is as bounded and so broadcast."""
    ids = labels.where(F.col("quality").isNotNull() & (remainder(F.col("doc_id")) != 0))
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(spec.train_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    rows = texts.where(F.length("text") <= spec.train_bytes).join(F.broadcast(ids), "doc_id")
    return rows.orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(spec.train_rows).select("text", F.col("quality").cast("int").alias("quality"))


def score_rows(docs: DataFrame, model: ByteCnn) -> DataFrame:
    """row (all columns of ``docs``, as they are) and score. Null text scores as empty text; repeated rows are each scored."""

    def run(batches):
        for part in slices(batches):
            scores = pa.array([model.score(text) for text in part.column(1).to_pylist()], pa.float64())
            yield pa.record_batch([part.column(0), scores], names=["row", "score"])

    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").cast("binary").alias("raw"))
    return rows.mapInArrow(run, StructType([rows.schema["row"], StructField("score", DoubleType())]))


def fitted(docs: DataFrame, labels: DataFrame, spec: CnnSpec = CnnSpec()) -> ByteCnn:
    """Fits in one task, whose size the sample bounds; the driver gets the weights alone."""

    def run(batches):
        rows = [(t, q) for batch in batches for t, q in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        model = fit([t for t, _ in rows], [q for _, q in rows], spec)
        yield pa.record_batch([pa.array([pickle.dumps(model.parameters())], pa.binary())], names=["weights"])

    found = training_sample(docs, labels, spec).coalesce(1).mapInArrow(run, "weights binary").first()
    model = ByteCnn(spec)
    if found:
        for mine, weights in zip(model.parameters(), pickle.loads(found.weights)):
            mine[...] = weights
    return model


def classify(docs: DataFrame, labels: DataFrame, spec: CnnSpec = CnnSpec(), threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) of every document, whole texts."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_rows(ids, fitted(docs, labels, spec)).select("row.doc_id", "score")
    held_out = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, spec: CnnSpec = CnnSpec(), threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    return score_rows(docs, fitted(docs, labels, spec)).where(F.col("score") >= threshold).select("row.*")
