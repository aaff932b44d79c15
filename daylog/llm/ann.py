"""Approximate nearest neighbours by collision counting (operator 5).

Every vector of unit length is projected on ``PROJECTIONS`` random directions, and each projection alone is a sorted array. A
query opens a window around its own projection in every array; a vector collides where it lies in the window. Windows
are wide in proportion to a radius, and the radius grows by ``GROWTH`` (virtual rehashing: the same arrays serve every
radius). Vectors that collide in at least ``THRESHOLD`` arrays are verified by their exact cosine; the search of a block ends
when ``k`` verified vectors lie within the radius, or when all are verified. A vector within the radius fails to collide
often enough about once in a thousand times; the radius is the smallest that ends the search. Cosines in single precision
tell which of the verified may be among the ``k`` largest; only those are computed in double precision.

The vectors are dealt by a hash of their id into blocks of about ``BLOCK``, the queries into blocks of about ``QUERIES``; each
pair of blocks is one group with its own arrays, and the nearest of all blocks are merged by rank. All rows are indexed.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows with a
null id; vectors of different lengths are never compared. Of rows with one id the least vector counts. Ties go to the smaller
id; equal vectors collide alike and score alike. Other columns are ignored; without candidates there are no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daylog.llm.common import ship_code

NEAREST = 5
ASK_EVERY = 50
PROJECTIONS, THRESHOLD = 48, 30
#: A window reaches so many radii to either side of the query.
REACH = 1.36
FIRST_RADIUS, GROWTH = 0.1, 1.5
BLOCK, QUERIES = 8_192, 2_048
SEED = 11


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def directions(length: int) -> np.ndarray:
    return np.random.default_rng((SEED, length)).normal(size=(PROJECTIONS, length))


def cosines(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
    """Exact cosines in double precision; the same two vectors always give the same number."""
    return (vectors * query).sum(axis=1) / (norms * norm)


class Block:
    """The sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.directions = directions(vectors.shape[1])
        units = vectors / self.norms[:, None]
        self.rough = units.astype(np.float32)
        #: Rough cosines are off by less than half of this.
        self.margin = 8 * (vectors.shape[1] + 4) * 2.0**-24
        values = (units @ self.directions.T).T
        order = np.argsort(values, axis=1, kind="stable")
        self.sorted = np.take_along_axis(values, order, axis=1)
        #: The place of every vector in every array.
        self.places = np.empty(order.shape, np.uint16 if len(ids) < 1 << 16 else np.uint32)
        np.put_along_axis(self.places, order, np.arange(len(ids), dtype=self.places.dtype)[None, :], axis=1)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, float]]:
        """(query id, vector id, cosine) of up to ``k`` nearest found of each query, its own id left out."""
        norms = np.sqrt((queries * queries).sum(axis=1))
        units = queries / norms[:, None]
        centres = units @ self.directions.T
        rough = units.astype(np.float32)
        radii = [FIRST_RADIUS]
        while radii[-1] < 2:
            radii.append(radii[-1] * GROWTH)
        edges: dict[int, np.ndarray] = {}
        out, guess = [], 0
        for i, (own, query) in enumerate(zip(query_ids.tolist(), queries, strict=True)):
            # The first radius that ends the search; as a larger one ends it too, it is looked for from where the last query's was.
            at, best = guess, None
            while True:
                if at not in edges:
                    edges[at] = self._edges(centres, radii[at])
                counts = self._collisions(edges[at][..., i])
                others = self.ids != own
                found, scores = self._verified(np.flatnonzero((counts >= THRESHOLD) & others), query, norms[i], rough[i], k)
                if len(found) == k and 2 - 2 * scores[-1] <= radii[at] ** 2:
                    best = found, scores
                    # What a smaller radius verifies is among this, so none ends the search that is less than the k-th distance.
                    if at == 0 or 2 - 2 * scores[-1] > radii[at - 1] ** 2:
                        break
                    at -= 1
                elif best is not None:
                    at += 1
                    break
                elif at + 1 < len(radii):
                    at += 1
                else:
                    if len(found) < k:
                        found, scores = self._verified(np.flatnonzero(others), query, norms[i], rough[i], k)
                    best = found, scores
                    break
            guess = at
            out += [(own, int(self.ids[b]), float(x)) for b, x in zip(*best, strict=True)]
        return out

    def _edges(self, centres: np.ndarray, radius: float) -> np.ndarray:
        """First and last place (exclusive) of every query's window in every array."""
        out = np.empty((2, PROJECTIONS, len(centres)), np.int64)
        for j in range(PROJECTIONS):
            out[0, j] = np.searchsorted(self.sorted[j], centres[:, j] - REACH * radius, "left")
            out[1, j] = np.searchsorted(self.sorted[j], centres[:, j] + REACH * radius, "right")
        return out

    def _collisions(self, edges: np.ndarray) -> np.ndarray:
        """In how many arrays each vector lies in the window."""
        kind = self.places.dtype
        low, width = edges[0].astype(kind)[:, None], (edges[1] - edges[0]).astype(kind)[:, None]
        return (self.places - low < width).view(np.uint8).sum(axis=0, dtype=np.uint8)  # places before the window wrap around

    def _verified(self, found: np.ndarray, query: np.ndarray, norm: float, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` of ``found`` with the largest exact cosines, ties to the smaller id; only those that rough cosines leave open are computed."""
        if len(found) > k:
            about = (self.rough @ rough)[found] if 2 * len(found) > len(self.ids) else self.rough[found] @ rough
            least = np.partition(about, len(found) - k)[len(found) - k] - self.margin
            found = found[~(about < least)]
        scores = cosines(self.vectors[found], self.norms[found], query, norm)
        best = np.lexsort((self.ids[found], -scores))[:k]
        return found[best], scores[best]


def _arrays(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors in order of id; of an id's several vectors the least."""
    ids = rows["vec_id"].to_numpy()
    vectors = np.array(rows["embedding"].tolist(), np.float64).reshape(len(rows), -1)
    order = np.lexsort((*vectors.T[::-1], ids)) if len(np.unique(ids)) < len(ids) else np.argsort(ids)
    first = order[np.append(True, np.diff(ids[order]) != 0)] if len(order) else order
    return ids[first], vectors[first]


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest of ``vectors`` found for each of ``queries`` (vec_id, embedding)."""
    pick = lambda df: df.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("width"))
    data, asked = pick(vectors), pick(queries)
    blocks = max(1, -(-data.count() // block))
    query_blocks = max(1, -(-asked.count() // query_block))
    dealt = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = data.withColumn("block", dealt(1, blocks)).withColumn("part", every(query_blocks))
    right = asked.withColumn("part", dealt(2, query_blocks)).withColumn("block", every(blocks))

    def search(own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(asking):
            found = Block(*_arrays(own)).nearest(*_arrays(asking), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    keys = ["width", "block", "part"]
    found = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % ASK_EVERY == 0))
