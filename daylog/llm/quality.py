"""Quality by attention-based multiple-instance learning (operator 8).

A document is a bag of passages of 100 words. Every passage is measured (shares of kinds of characters, lengths of words,
repetition) and encoded; gated attention, tanh times sigmoid, gives each passage a weight; the document's score comes from
the weighted mean of its encodings. Attention and encoder are learned from document labels alone, by Adam in numpy, on a
sample of at most ``SAMPLE`` labelled documents with all their passages. All passages of every document are scored, in one pass without a shuffle.

Defined cases: a null or empty text is one passage of zeros. Without labels of both kinds the score is the smoothed
share of label 1 (0.5 without any). Rows with a null id are scored and not held out. Repeated rows get equal scores. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylog.llm.common import documents, in_blocks, mix64, small_batches, texts_of, word_hashes, word_starts, words_of
from daylog.llm.folds import held_out, labels, rows_where, sample_of, sigmoid

PASSAGE = 100
SAMPLE = 6_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 16, 40, 256, 0.01, 1e-4
KEEP = 0.5
#: Bytes measured at a time.
BLOCK = 4 << 20

_KINDS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:", "!", "?", "#$%&*@^~+=<>\\", "|", "\"'()[]{}", "-_/"]
KIND = np.full(256, len(_KINDS), np.int64)  # others, among them spaces
for _number, _chars in enumerate(_KINDS):
    KIND[list(_chars.encode())] = _number
KIND[128:] = len(_KINDS) + 1  # parts of letters beyond ASCII
KIND[0xC3] = len(_KINDS) + 2
N_KINDS = len(_KINDS) + 3
FEATURES = N_KINDS + 8


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Measures of every passage, and the number of its text; a text without words is one passage of zeros."""
    split = [words_of(x) for x in texts]
    rows, owners = [], []
    for block in in_blocks(list(enumerate(split)), [len(x) * 8 for x in split], BLOCK):
        full = [x for x in block if x[1]]
        for number, words in block:
            if not words:
                rows.append(np.zeros((1, FEATURES)))
                owners.append(np.array([number]))
        if full:
            measured, owner = _measure(full)
            rows.append(measured)
            owners.append(owner)
    if not rows:
        return np.zeros((0, FEATURES)), np.zeros(0, np.int64)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(rows)[order], owner[order]


def _measure(block: list[tuple[int, list[bytes]]]) -> tuple[np.ndarray, np.ndarray]:
    buffer = np.frombuffer(b" ".join(b" ".join(x[1]) for x in block), np.uint8)
    starts, ends = word_starts(buffer)
    counts = np.array([len(x[1]) for x in block])
    per = -(-counts // PASSAGE)
    base = np.cumsum(per) - per
    place = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
    passage = np.repeat(base, counts) + place // PASSAGE
    n = int(per.sum())
    words = np.bincount(passage, minlength=n).astype(float)
    first = np.flatnonzero(np.append(True, np.diff(passage) != 0))
    edges = np.append(starts[first], len(buffer))
    kinds = np.bincount(np.repeat(np.arange(n), np.diff(edges)) * N_KINDS + KIND[buffer], minlength=n * N_KINDS).reshape(n, N_KINDS)
    size = np.diff(edges).astype(float)
    hashes = word_hashes(buffer, starts, ends)
    length = (ends - starts).astype(float)
    inside = np.append(False, passage[1:] == passage[:-1])
    again = np.append(False, hashes[1:] == hashes[:-1]) & inside
    over = np.concatenate([[False] * 2, (hashes[2:] == hashes[:-2]) & (passage[2:] == passage[:-2])])[: len(hashes)]
    _, at = np.unique(mix64(hashes + passage.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    mean = np.bincount(passage, length, n) / words
    last = KIND[buffer[ends - 1]]
    total = lambda x: np.bincount(passage, x, n) / words
    measures = [
        np.log1p(words) / 5,
        mean / 10,
        np.sqrt(np.maximum(0, np.bincount(passage, length**2, n) / words - mean**2)) / 10,
        total((last == 6) | (last == 4)),
        total(length == 1),
        total(again),
        total(over),
        np.bincount(passage[at], minlength=n) / words,
    ]
    owner = np.repeat(np.array([x[0] for x in block]), per)
    return np.hstack([kinds / size[:, None], np.stack(measures, 1)]), owner


@dataclass
class BagModel:
    """encode: x -> tanh(x E); attention: softmax of (tanh(e V) * sigmoid(e U)) w; score: sigmoid(z c + b)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, x: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
        return sigmoid(_forward(self.weights, (x - self.mean) / self.scale, bag, bags)["y"])


@dataclass
class Constant:
    """The share of label 1, where there is nothing to tell the labels apart."""

    share: float

    def score(self, x: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
        return np.full(bags, self.share)


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray, bags: int) -> dict[str, np.ndarray]:
    """``bag`` ascends and has every number below ``bags``."""
    first = np.searchsorted(bag, np.arange(bags))
    e = np.tanh(x @ w["E"] + w["e0"])
    t, g = np.tanh(e @ w["V"] + w["v0"]), sigmoid(e @ w["U"] + w["u0"])
    s = (t * g) @ w["w"]
    a = np.exp(s - np.maximum.reduceat(s, first)[bag])
    a /= np.add.reduceat(a, first)[bag]
    z = np.add.reduceat(a[:, None] * e, first)
    return {"e": e, "t": t, "g": g, "a": a, "z": z, "y": z @ w["c"] + w["b"][0], "first": first}


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, bag, len(y))
    e, t, g, a = f["e"], f["t"], f["g"], f["a"]
    dy = (sigmoid(f["y"]) - y) / len(y)
    dz = dy[:, None] * w["c"][None, :]
    da = (dz[bag] * e).sum(1)
    ds = a * (da - np.add.reduceat(a * da, f["first"])[bag])
    dt = ds[:, None] * w["w"] * g * (1 - t * t)
    dg = ds[:, None] * w["w"] * t * g * (1 - g)
    de = (a[:, None] * dz[bag] + dt @ w["V"].T + dg @ w["U"].T) * (1 - e * e)
    return {"E": x.T @ de, "e0": de.sum(0), "V": e.T @ dt, "v0": dt.sum(0), "U": e.T @ dg, "u0": dg.sum(0), "w": (t * g).T @ ds, "c": f["z"].T @ dy, "b": np.array([dy.sum()])}


def train(bags: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> BagModel | Constant:
    """Fit on bags of passages and their labels; the same input gives the same model."""
    y = np.asarray(y, float)
    if not len(y) or y.min() == y.max():
        return Constant((y.sum() + 1) / (len(y) + 2))
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    mean, scale = every.mean(0), every.std(0) + 0.02
    bags = [(x - mean) / scale for x in bags]
    n, h = every.shape[1], HIDDEN
    w = {"E": rng.normal(0, n**-0.5, (n, h)), "e0": np.zeros(h), "V": rng.normal(0, h**-0.5, (h, h)), "v0": np.zeros(h), "U": rng.normal(0, h**-0.5, (h, h)), "u0": np.zeros(h), "w": rng.normal(0, h**-0.5, h), "c": rng.normal(0, h**-0.5, h), "b": np.zeros(1)}
    m, v, step = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    for epoch in range(epochs):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            x = np.concatenate([bags[i] for i in own])
            bag = np.repeat(np.arange(len(own)), [len(bags[i]) for i in own])
            grads, step = _gradients(w, x, bag, y[own]), step + 1
            for k, grad in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                w[k] = w[k] * (1 - DECAY * rate) - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return BagModel(mean, scale, w)


def fit(docs: DataFrame, marked: DataFrame, rows: int = SAMPLE) -> BagModel | Constant:
    """A model of ``marked`` (doc_id, label), fitted on a sample of at most ``rows`` documents."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            x, owner = passages(texts_of(batch, "text"))
            kept = [own.astype("<f4").tobytes() for own in np.split(x, np.flatnonzero(np.diff(owner)) + 1)] if len(owner) else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(kept, pa.binary())], names=["doc_id", "label", "bag"])

    # At most ``rows`` documents, some 90 bytes for each of their passages.
    table = sample_of(docs, marked, rows).mapInArrow(measure, "doc_id long, label int, bag binary").toPandas()
    table["size"] = table["bag"].map(len)
    table = table.sort_values(["doc_id", "label", "size"], kind="stable")
    return train([np.frombuffer(x, "<f4").reshape(-1, FEATURES).astype(float) for x in table["bag"]], table["label"].to_numpy())


def score(docs: DataFrame, model: BagModel | Constant) -> DataFrame:
    """doc_id, text_hash and score (0 to 1) of every row of ``docs`` (doc_id, text)."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            scores = np.zeros(0)
            if batch.num_rows:
                x, owner = passages(texts_of(batch, "text"))
                scores = model.score(x, owner, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(scores)], names=["doc_id", "text_hash", "score"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return given.mapInArrow(rate, "doc_id long, text_hash long, score double")


def good_documents(docs: DataFrame, marked: DataFrame, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that score ``keep`` or more by a model of ``marked``."""
    model = fit(docs, marked)
    return rows_where(docs, lambda texts: model.score(*passages(texts), len(texts)) >= keep if texts else np.zeros(0, bool))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = score(docs, fit(docs, labels(spark, sf_dir, "quality")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))
