"""SimHash near-duplicates with BK-trees (operator 9).

A text's fingerprint has a bit set where more than half of its word shingles' XXH64 values have it. Texts link where their
fingerprints differ in at most ``distance`` bits; a group is a connected component of links.

Copies share a fingerprint, so only different fingerprints are compared. Two of them within 3 bits agree in one of 4 blocks
of 16 bits, and, of the other 48 bits, in one of 4 blocks of 12; the 16 pairs of blocks deal each fingerprint to 16 shards,
and every link lies within a shard. A shard's fingerprints form a BK-tree: a child hangs on its parent by their integer
Hamming distance. Queries follow from a node at distance d only the edges from d - 3 to d + 3. The trees of all
shards of a task are grown and searched together, level by level, in numpy.

A shard of more than ``SHARD`` fingerprints is dealt into chunks: each chunk's tree goes to every chunk of queries, one task
each, so that memory stays bounded and no link is lost. A task reports, for each fingerprint, only the smallest one its
links reach, not all pairs. Components are closed by alternating large-star and small-star steps on Spark tables.

Defined cases: a null or blank text has fingerprint zero, linked like any other. A text of fewer words than a shingle is one
shingle. A null id takes part; a component's id is the smallest that is not null. Rows that repeat an id are rows of their
own. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daylog.llm.common import documents, small_batches, stored, texts_of, whole_row

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Fingerprints of one tree, rows that a task handles at a time, and queries searched together.
SHARD, ROWS, QUERIES = 2_048, 60_000, 512


# --- fingerprints ----------------------------------------------------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes.lower() changes A-Z alone
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return xxh64_intdigest(b" ".join(words), SEED)
    ones, join = np.zeros(64, np.int64), b" ".join
    for at in range(0, n, 65_536):
        hashes = [xxh64_intdigest(join(words[i : i + shingle]), SEED) for i in range(at, min(n, at + 65_536))]
        ones += np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def simhashes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash and fp, the fingerprint as a signed long, of every row of ``docs`` (doc_id, text)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            prints = np.array([fingerprint(x, shingle) for x in texts_of(batch, "text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(prints)], names=["doc_id", "text_hash", "fp"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return given.mapInArrow(make, "doc_id long, text_hash long, fp long")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- BK-trees --------------------------------------------------------------------------------------------------------


def bits_between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def grow(values: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BK-trees of values, one for each shard number: the root of each shard, and children[node, distance] or -1.

    Each round every value still on its way down meets its node: the first with a (node, distance) becomes the child there,
    the others go on from it. Values of a shard must differ.
    """
    roots = np.unique(shard, return_index=True)[1]
    children = np.full((len(values), 65), -1, np.int32)
    way = np.setdiff1d(np.arange(len(values)), roots)
    node = roots[shard[way]]
    while len(way):
        edge = node * 65 + bits_between(values[way], values[node])
        _, first, which = np.unique(edge, return_index=True, return_inverse=True)
        child = way[first]
        children.reshape(-1)[edge[first]] = child
        node = child[which]
        on = np.ones(len(way), bool)
        on[first] = False
        way, node = way[on], node[on]
    return roots, children


def search(values: np.ndarray, children: np.ndarray, queries: np.ndarray, node: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query number, node) of all nodes within ``radius`` of each query, starting at its shard's root."""
    query, hits = np.arange(len(queries)), []
    while len(query):
        far = bits_between(queries[query], values[node])
        near = far <= radius
        hits.append((query[near], node[near]))
        # Edges from far - radius to far + radius, and no others.
        steps = far[:, None] + np.arange(-radius, radius + 1)[None, :]
        below = np.where((steps >= 0) & (steps <= 64), children[node[:, None], np.clip(steps, 0, 64)], -1)
        at, edge = np.nonzero(below >= 0)
        query, node = query[at], below[at, edge].astype(np.int64)
    if not hits:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x[0] for x in hits]), np.concatenate([x[1] for x in hits])


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the parts of a[i] and b[i]: every node gets the least number of its part."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        least = np.minimum(x, y)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _shard_links(fp: np.ndarray, shard: np.ndarray, tree: np.ndarray, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, the smallest that it reaches in its shard) of the shards of a block; rows sorted by shard."""
    in_tree = np.flatnonzero(tree)
    names, number = np.unique(shard[in_tree], return_inverse=True)
    roots, children = grow(fp[in_tree], number)
    label = np.arange(len(fp))
    asking = np.flatnonzero(query)
    place = np.searchsorted(names, shard[asking])
    there = (place < len(names)) & (names[np.minimum(place, max(0, len(names) - 1))] == shard[asking]) if len(names) else np.zeros(len(asking), bool)
    asking, place = asking[there], place[there]
    for at in range(0, len(asking), QUERIES):
        own = asking[at : at + QUERIES]
        q, node = search(fp[in_tree], children, fp[own], roots[place[at : at + QUERIES]], radius)
        label = merge(label, own[q], in_tree[node])
    other = np.flatnonzero(label != np.arange(len(fp)))
    return fp[other], fp[label[other]]


def _linker(radius: int):
    def solve(rows: list[np.ndarray]) -> pa.RecordBatch:
        key, low, high, side, fp = rows
        new = np.append(True, (np.diff(key) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0))
        shard = np.cumsum(new) - 1
        a, b = _shard_links(fp.view(np.uint64), shard, side == low, side == high, radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 5
        for batch in batches:
            held = [np.concatenate([x, batch.column(i).to_numpy()]) for i, x in enumerate(held)]
            if len(held[0]) >= ROWS:
                same = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])
                cut = int(np.argmax(same))  # the last shard may go on in the next batch
                if cut:
                    yield solve([x[:cut] for x in held])
                    held = [x[cut:] for x in held]
        if len(held[0]):
            yield solve(held)

    return link


def shard_keys(fp: Column) -> Column:
    """16 keys of which any two fingerprints within 3 bits share one: a 16-bit block, and a 12-bit block of the rest."""
    keys = []
    for block in range(4):
        low = 16 * block
        own = F.shiftrightunsigned(fp, low).bitwiseAND(0xFFFF)
        above = F.shiftleft(F.shiftrightunsigned(fp, low + 16), low) if block < 3 else F.lit(0).cast("long")
        rest = above.bitwiseOR(fp.bitwiseAND((1 << low) - 1)) if low else above
        for part in range(4):
            twelve = F.shiftrightunsigned(rest, 12 * part).bitwiseAND(0xFFF)
            keys.append(F.lit((block * 4 + part) << 28).cast("long") + F.shiftleft(own, 12) + twelve)
    return F.array(*keys)


def links(prints: DataFrame, radius: int = DISTANCE, shard: int = SHARD) -> DataFrame:
    """Links a, b of a frame of different fingerprints ``fp``: enough of them to connect what the radius connects."""
    if radius > 3:
        raise ValueError("blocks of the shard keys are made for at most 3 bits")
    spark = prints.sparkSession
    keyed = prints.select("fp", F.explode(shard_keys(F.col("fp"))).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = sizes.select("key", F.ceil(F.col("n") / shard).cast("long").alias("chunks"))
    met = keyed.join(sizes, "key").withColumn("side", F.pmod(F.xxhash64("fp"), F.col("chunks")))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda x: F.struct(F.least("side", x).alias("low"), F.greatest("side", x).alias("high")))
    dealt = met.select("key", "side", "fp", F.explode(pairs).alias("pair")).select("key", "pair.low", "pair.high", "side", "fp")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInArrow(_linker(radius), "a long, b long").distinct()


# --- components ------------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node on an edge (a, b): root is the smallest node of its component.

    Large-star joins every node's larger neighbours to the least of its neighbourhood, small-star its smaller ones; when
    neither changes the edges, all nodes hang on their roots. Each round is a table in the shared folder.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = stored(small.where("a != b").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, shard: int = SHARD) -> DataFrame:
    """doc_id, text_hash, fp, component_id and group (a fingerprint that names the component) of every row of ``docs``."""
    prints = stored(simhashes(docs, shingle), "simhashes")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(least.select("fp"), distance, shard))
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
    linked = least.join(roots, F.col("fp") == F.col("node"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    linked = linked.join(smallest, "root").select("fp", "root", "smallest")
    known = least.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("group"), F.coalesce("smallest", "least").alias("component_id"))
    return prints.join(known, "fp").select("doc_id", "text_hash", "fp", "component_id", "group")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs``, all columns as they are, with one of each group: that of the smallest id (null ids last)."""
    groups = near_duplicates(docs, shingle, distance)
    first = groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash")).alias("first"))
    keys = ["no_id", "id", "text_hash"]
    first = first.select("first.*")
    # The columns given travel as one struct, so that no name of theirs meets a key.
    rows = docs.select(
        whole_row(docs).alias("row"),
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash"),
    )
    # Rows that repeat an id and its text are alike in this; the first is taken.
    again = F.row_number().over(Window.partitionBy(keys).orderBy(keys))
    return rows.join(first, keys, "left_semi").withColumn("n", again).where("n = 1").select("row.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")
