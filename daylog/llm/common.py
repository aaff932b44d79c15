"""What the operators share: tables, folders all executors reach, and the words of a text."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daylog.session import shared_folder

#: Characters between words: space and U+0009 to U+000D. ``bytes.split()`` splits on exactly these.
WORD_GAP = "[ \\t-\\r]+"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Hand this package to the executors, once per application, as ``--py-files`` would."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = f"{tempfile.mkdtemp(prefix='code-')}/{package.name}.zip"  # on the driver, which serves it
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as a table in the shared folder and read again: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame, *without: str) -> Column:
    """All columns of a frame, but for some, as one struct: beside it other columns may have any name."""
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c not in without))


def id_crc(col: Column) -> Column:
    """crc32 of an id written as text, unsigned."""
    return F.crc32(col.cast("string").cast("binary"))


def small_batches(batches: Iterator, limit: int = 2 << 20) -> Iterator:
    """Arrow batches cut so that their ``text`` column has about ``limit`` bytes at most (or one longer row)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
        block = np.cumsum(sizes) // limit
        edges = np.flatnonzero(np.diff(block, prepend=-1)) if len(block) else [0]
        for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def texts_of(batch, column: str) -> list[str]:
    """The texts of an Arrow batch; a null text is an empty one."""
    return [x or "" for x in batch.column(column).to_pylist()]


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than space and U+0009 to U+000D, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_starts(buffer: np.ndarray, gap: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in a byte buffer in which single ``gap`` bytes divide words."""
    space = buffer == gap
    inside = ~space
    first = inside.copy()
    first[1:] &= space[:-1]
    last = inside.copy()
    last[:-1] &= space[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word; equal words have equal hashes on every machine."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    widths = ends - starts
    powers = np.full(int(widths.max()), 0x9E3779B97F4A7C15, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    total = np.cumsum(widths)
    at = np.arange(total[-1]) - np.repeat(total - widths, widths)
    terms = (buffer[np.repeat(starts, widths) + at].astype(np.uint64) + np.uint64(1)) * powers[at]
    return mix64(np.add.reduceat(terms, total - widths))


def in_blocks(items: list, weights: list[int], limit: int) -> Iterator[list]:
    """Runs of items whose weights stay under ``limit`` in sum (a single heavier item stands alone)."""
    block: list = []
    held = 0
    for item, weight in zip(items, weights, strict=True):
        if block and held + weight > limit:
            yield block
            block, held = [], 0
        block.append(item)
        held += weight
    if block:
        yield block
