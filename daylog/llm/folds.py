"""Labels for classifiers: which rows may be learned from, and a bounded sample of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daylog.llm.common import id_crc, small_batches, texts_of

FOLDS, HELD_OUT = 3, 1


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept for measuring: crc32(doc_id as text) mod 3 is 1. A null id is not."""
    return F.coalesce(id_crc(doc_id) % FOLDS == HELD_OUT, F.lit(False))


def labels(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """doc_id and label (0 or 1) of the labelled rows that may be learned from."""
    table = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col(column).cast("int").alias("label"))
    return training_rows(table)


def training_rows(table: DataFrame) -> DataFrame:
    return table.where("label IN (0, 1)").where(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("doc_id"), "label")


def sample_of(docs: DataFrame, marked: DataFrame, rows: int) -> DataFrame:
    """Texts and labels of at most ``rows`` labelled documents with different texts, chosen by a hash of the id.

    Of copies (equal whole texts) that of the smallest id is taken, before the bound, so that a copied text neither counts
    many times nor uses up the sample. Documents that merely begin alike are all taken.
    """
    # Two hashes and the length stand for a text until the sample is chosen; then the texts of its rows alone are fetched.
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    copy = [F.xxhash64("text").alias("hash"), F.xxhash64(F.lit(1), F.col("text")).alias("hash_2"), F.char_length("text").alias("length")]
    names = ["hash", "hash_2", "length"]
    found = given.select("doc_id", *copy).join(marked.select("doc_id", "label"), "doc_id")
    first = found.groupBy(*names).agg(F.min(F.struct("doc_id", "label")).alias("first")).select("first.*", *names)
    chosen = first.orderBy(F.xxhash64("doc_id"), "label", *names).limit(rows)
    alike = given.select("doc_id", "text", *copy).join(F.broadcast(chosen), ["doc_id", *names])  # at most ``rows`` rows
    return alike.dropDuplicates(["doc_id", "label", *names]).select("doc_id", "text", "label")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last one is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def rows_where(docs: DataFrame, test: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose texts pass ``test``; nothing is shuffled."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield batch.filter(pa.array(test(texts_of(batch, "text"))))

    return docs.mapInArrow(keep, docs.schema)
