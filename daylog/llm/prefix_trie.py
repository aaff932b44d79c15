"""The prefix trie of conversations, from sorted turn sequences and range minima over their common prefixes.

A turn is a 20-byte code: half of the SHA-256 of its role and text, and its number of code points. A conversation is the
string of its codes, so texts are never shuffled. Equal conversations meet in one range of the sorted order. A task reads
its range in blocks of bounded size: common prefix lengths of neighbours (LCPs), a sparse table of their range minima, and
for each prefix of each sequence one binary search to the left and one to the right, all searches of a block at once and
independent of each other. The extents give members, children, leaves and sums by prefix sums in the sorted order.

Only the prefixes of a block's first and last sequence (its edges) can go on in another block. They are named by a digest of
their path, summed by name, and what the resulting small tree adds to its own prefixes is summed down each edge.

Defined cases: a null role or text is empty; rows without a conv_id take no part; turns of a conversation are ordered by
turn (null first), then role, then the digest of role and text, and repeated rows are turns of their own. An empty table has
no nodes. Other columns are not read. A conversation's codes are one row: 20 bytes a turn, whatever its texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daylog.llm.common import id_crc, ship_code, stored
from daylog.llm.turns import KEY_HEX, ORDER, turns_of

KEY_BYTES, CODE_BYTES = KEY_HEX // 2, KEY_HEX // 2 + 4
#: Conversations of a hundred share up to five first turns of the one their hundred begins with.
HUNDRED, SHARED_TURNS = 100, 6
#: Ids of one text of ids: 2^8.
IDS_BITS = 8
#: Turns (and sequences) of a block; a longer conversation is a block of its own.
BLOCK = 1 << 18

PARTIAL = (
    "part bigint, side int, depth bigint, conv_id bigint, parent_conv_id bigint, key binary, parent_key binary, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, chars bigint, ends_sha256 string"
)


def own_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and the codes of its turns in order, as hex texts."""
    code = F.concat("key", F.lpad(F.hex(F.char_length("text")), 2 * (CODE_BYTES - KEY_BYTES), "0"))
    rows = turns_of(conversations).where(F.col("conv_id").isNotNull()).select("conv_id", F.struct(*ORDER, code.alias("code")).alias("turn"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: t["code"]).alias("codes"))


def rebuilt(own: DataFrame) -> DataFrame:
    """conv_id and the codes of its rebuilt turns: h turns of the hundred's first conversation, then its own beyond h."""
    base = F.col("conv_id") - F.col("conv_id") % HUNDRED
    heads = own.where(F.col("conv_id") % HUNDRED == 0).select(F.col("conv_id").alias("base"), F.slice("codes", 1, SHARED_TURNS - 1).alias("head"))
    h = (id_crc(F.col("conv_id")) % SHARED_TURNS).cast("int")
    head = F.coalesce("head", F.array().cast("array<string>"))
    turns = F.concat(F.slice(head, F.lit(1), h), F.slice("codes", h + 1, F.size("codes")))
    return own.withColumn("base", base).join(heads, "base", "left").select("conv_id", turns.alias("codes"))


def sequences(conversations: DataFrame) -> DataFrame:
    """Distinct sequences as ``path`` (joined codes) with their conversations in texts of ids, ``block`` by ``block``."""
    path = F.unhex(F.array_join("codes", "")).alias("path")
    rows = conversations.select("conv_id", path, F.shiftright("conv_id", IDS_BITS).alias("block"))
    ids = rows.groupBy("path", "block").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))  # 256 ids at most
    written = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    return ids.select("path", "block", F.get("ids", F.lit(0)).alias("conv_id"), F.size("ids").cast("bigint").alias("n"), written.alias("ids"))


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs of 1, 2, 4, ... values."""
    levels = [values]
    while len(levels[-1]) > 1 << (len(levels) - 1):
        step = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
    return levels


def range_minima(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minima of the values from ``left`` to ``right``, both included."""
    rank = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), levels[0].dtype)
    for k in np.unique(rank):
        at = rank == k
        out[at] = np.minimum(levels[k][left[at]], levels[k][right[at] + 1 - (1 << k)])
    return out


def common_prefixes(keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Turns that each sequence shares with the one before it; -1 for the first."""
    lcp = np.full(len(lengths), -1, np.int64)
    both = np.minimum(lengths[1:], lengths[:-1])
    ends = np.cumsum(both)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - both, both)
    same = (keys[np.repeat(starts[:-1], both) + at] == keys[np.repeat(starts[1:], both) + at]).all(axis=1)
    lcp[1:] = both
    some = np.flatnonzero(both)
    if len(some):
        first = np.minimum.reduceat(np.where(same, np.iinfo(np.int64).max, at), (ends - both)[some])
        lcp[some + 1] = np.minimum(both[some], first)
    return lcp


def extents(lcp: np.ndarray, member: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last sequence that share the first ``depth`` turns of sequence ``member``, for every pair by itself.

    A binary search by halving steps: a side grows by 2^k where no LCP on the way falls below the depth.
    """
    levels, n = sparse_table(lcp), len(lcp)
    left, right = member.copy(), member.copy()
    for k in range(len(levels) - 1, -1, -1):
        step, minima = 1 << k, levels[k]
        right += step * ((right + step < n) & (minima[np.minimum(right + 1, len(minima) - 1)] >= depth))
        left -= step * ((left >= step) & (minima[np.clip(left - step + 1, 0, len(minima) - 1)] >= depth))
    return left, right


@dataclass
class Block:
    """Sorted distinct sequences of a block and the conversations that are equal to each."""

    paths: list[bytes] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)
    smallest: list[int] = field(default_factory=list)
    ends: list[str] = field(default_factory=list)


def _names(path: bytes) -> list[bytes]:
    """The names of all prefixes of a path, the empty one first."""
    digest = sha256()
    names = [digest.digest()[:KEY_BYTES]]
    for at in range(0, len(path), CODE_BYTES):
        digest.update(path[at : at + KEY_BYTES])
        names.append(digest.digest()[:KEY_BYTES])
    return names


def nodes_of(block: Block, part: int) -> pa.RecordBatch:
    """The nodes of a block: closed ones whole, those on its edges as partial figures with the name of their path."""
    n = len(block.paths)
    lengths = np.array([len(p) // CODE_BYTES for p in block.paths], np.int64)
    codes = np.frombuffer(b"".join(block.paths), np.uint8).reshape(-1, CODE_BYTES)
    keys = np.ascontiguousarray(codes[:, :KEY_BYTES]).view("<u8").reshape(-1, 2)
    chars = np.ascontiguousarray(codes[:, KEY_BYTES:]).view(">u4").reshape(-1).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    lcp = common_prefixes(keys, starts, lengths)

    # Every prefix of every sequence is a candidate; the candidate of its first member stands for the node.
    first = np.cumsum(lengths + 1) - (lengths + 1)
    member = np.repeat(np.arange(n), lengths + 1)
    depth = np.arange(len(member)) - first[member]
    left, right = extents(lcp, member, depth)
    stands = left == member
    number = np.cumsum(stands) - 1  # nodes in preorder
    node_of = number[first[left] + depth]
    i, d, r = member[stands], depth[stands], right[stands]
    pre = np.arange(len(i))
    end = np.cumsum(np.bincount(i, minlength=n))[r]
    parent = np.where(d > 0, node_of[np.maximum(first[i] + d - 1, 0)], -1)
    held = np.concatenate([[0], np.cumsum(block.counts)])
    n_convs = held[r + 1] - held[i]
    conv = range_minima(sparse_table(np.array(block.smallest, np.int64)), i, r)
    last_chars = np.zeros(len(i), np.int64)
    last_chars[d > 0] = chars[(starts[i] + d - 1)[d > 0]]

    on_edge = (i == 0) | (r == n - 1)
    below = parent[(d > 0) & ~on_edge]
    children = np.bincount(below, minlength=len(i))  # those of edge nodes without their edge children
    closed_sum = lambda x: np.concatenate([[0], np.cumsum(np.where(on_edge, 0, x))])
    leaves, saved = closed_sum(children == 0), closed_sum((n_convs - 1) * last_chars)
    leaves, saved = leaves[end] - leaves[pre], saved[end] - saved[pre]
    ends = [block.ends[a] if b else None for a, b in zip(i, lengths[i] == d, strict=True)]

    names: dict[int, bytes] = {}
    edges = []  # (side, node, whether its figures count here)
    for side, at in enumerate([0, n - 1][: min(n, 2)]):
        for step, name in enumerate(_names(block.paths[at])):
            node = int(node_of[first[at] + step])
            edges.append((side, node, node not in names))
            names[node] = name
    inner = np.flatnonzero(~on_edge)
    nodes = np.concatenate([[x[1] for x in edges], inner]).astype(np.int64)
    counts = np.concatenate([[x[2] for x in edges], np.ones(len(inner), bool)]).astype(bool)
    of_edge = np.arange(len(nodes)) < len(edges)
    up = parent[nodes]
    known = ~of_edge & ~on_edge[np.maximum(up, 0)]

    def figure(x: np.ndarray) -> pa.Array:
        return pa.array(np.where(counts, x[nodes], 0), pa.int64())

    columns = [
        pa.array(np.full(len(nodes), part), pa.int64(), mask=~of_edge),
        pa.array([x[0] for x in edges] + [None] * len(inner), pa.int32()),
        pa.array(d[nodes], pa.int64()),
        pa.array(conv[nodes], pa.int64(), mask=~counts),
        pa.array(conv[np.maximum(up, 0)], pa.int64(), mask=~known),
        pa.array([names[x[1]] for x in edges] + [None] * len(inner), pa.binary()),
        pa.array([names.get(x) for x in up.tolist()], pa.binary()),
        figure(n_convs),
        figure(children),
        figure(leaves),
        figure(saved),
        pa.array(last_chars[nodes], pa.int64()),
        pa.array([ends[x] for x in nodes.tolist()], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in PARTIAL.split(", ")])


def _partial_nodes(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        block, held, digest = Block(), 0, None
        for batch in batches:
            for path, conv, n, ids in zip(*(batch.column(x).to_pylist() for x in ("path", "conv_id", "n", "ids")), strict=True):
                if block.paths and block.paths[-1] == path:
                    block.counts[-1] += n
                    block.smallest[-1] = min(block.smallest[-1], conv)
                    digest.update(b",")
                else:
                    if digest is not None:
                        block.ends.append(digest.hexdigest())
                    if held >= limit:
                        yield nodes_of(block, part)
                        part, block, held = part + 1, Block(), 0
                    block.paths.append(path)
                    block.counts.append(n)
                    block.smallest.append(conv)
                    digest = sha256()
                    held += len(path) // CODE_BYTES + 1
                digest.update(ids.encode())
        if block.paths:
            block.ends.append(digest.hexdigest())
            yield nodes_of(block, part)

    return run


def edge_nodes(edges: DataFrame) -> DataFrame:
    """The nodes on edges of blocks, whole: partial figures summed by name, and the small tree's own part added."""
    merged = edges.groupBy("key").agg(
        F.max("depth").alias("depth"),
        F.max("parent_key").alias("parent_key"),
        F.min("conv_id").alias("conv_id"),
        F.max("chars").alias("chars"),
        F.max("ends_sha256").alias("ends_sha256"),
        F.min(F.struct("part", "side")).alias("owner"),
        *(F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    more = merged.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    whole = merged.join(more, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    whole = stored(whole.drop("more"), "trie-edges")
    # A node belongs to one edge that runs through it; each edge sums what it owns from its deep end upwards.
    owned = whole.select(
        "owner.*", "depth", (F.col("n_children") == 0).cast("bigint").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("own")
    )
    up = Window.partitionBy("part", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    chains = edges.select("part", "side", "depth", "key").join(owned, ["part", "side", "depth"], "left")
    sums = chains.select("key", F.sum("leaf").over(up).alias("leaf"), F.sum("own").over(up).alias("own"))
    added = sums.groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    return whole.join(added, "key").withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.coalesce("leaf", F.lit(0)),
            "saved_tokens": F.col("saved_tokens") + F.coalesce("own", F.lit(0)),
        }
    )


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row a node of the trie of ``conversations`` (conv_id, codes): smallest member, depth, parent's smallest member,
    members, children, leaves below, saved code points below, and the digest of the ids that end there."""
    rows = sequences(conversations).repartitionByRange("path").sortWithinPartitions("path", "block")
    partial = stored(rows.mapInArrow(_partial_nodes(block), PARTIAL), "trie-nodes")
    closed = partial.where(F.col("part").isNull())
    edges = stored(edge_nodes(partial.where(F.col("part").isNotNull())).drop("owner", "leaf", "own"), "trie-edge-nodes")
    parents = edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = closed.where(F.col("parent_key").isNull()).select(out)
    under = closed.drop("parent_conv_id").where(F.col("parent_key").isNotNull()).join(parents, "parent_key")
    on_edge = edges.join(parents, "parent_key", "left")
    nodes = inner
    for part in (under, on_edge):
        nodes = nodes.unionByName(part.withColumnRenamed("above", "parent_conv_id").select(out))
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    own = stored(own_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "own-turns")
    return prefix_trie(rebuilt(own))


#: crc32 is written out: each digit of the id passes through eight steps of the reflected polynomial.
SQL = f"""
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
heads AS MATERIALIZED (SELECT c, c - c % {HUNDRED} AS base, xor(list_reduce(
    list_concat([4294967295::BIGINT], [ascii(x)::BIGINT for x in string_split(c::VARCHAR, '')]),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda s, z: xor(s >> 1, (s & 1) * 3988292384 + z))
  ), 4294967295) % {SHARED_TURNS} AS h FROM ids),
turns AS MATERIALIZED (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, key) AS p, key, n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, length(coalesce(text, '')) AS n,
      substr(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS key
    FROM conversations WHERE conv_id IS NOT NULL)),
built AS MATERIALIZED (
  SELECT c, coalesce(list(key ORDER BY own, p) FILTER (key IS NOT NULL), []) AS path, coalesce(list(n ORDER BY own, p) FILTER (key IS NOT NULL), []) AS sizes
  FROM (SELECT heads.c, false AS own, p, key, n FROM heads JOIN turns ON turns.c = heads.base AND p <= h
    UNION ALL SELECT heads.c, true, p, key, n FROM heads JOIN turns ON turns.c = heads.c AND p > h
    UNION ALL SELECT c, true, NULL, NULL, NULL FROM heads) GROUP BY c),
prefixes AS MATERIALIZED (
  SELECT c, d, path[1:d] AS prefix, CASE WHEN d > 0 THEN path[1:d - 1] END AS above, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS n, len(path) = d AS stops
  FROM built, range(0, len(path) + 1) AS t(d)),
nodes AS MATERIALIZED (
  SELECT prefix, d, any_value(above) AS above, min(c) AS c, count(*) AS members, (count(*) - 1) * max(n) AS own,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (stops), '')) AS ends
  FROM prefixes GROUP BY prefix, d),
children AS (SELECT above AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY above),
below AS (
  SELECT nodes.prefix[1:t.d] AS prefix, sum(own) AS saved, count(*) FILTER (children.n IS NULL) AS leaves
  FROM nodes LEFT JOIN children USING (prefix), range(0, nodes.d + 1) AS t(d) GROUP BY ALL)
SELECT nodes.c AS conv_id, nodes.d AS depth, up.c AS parent_conv_id, nodes.members AS n_convs, coalesce(children.n, 0) AS n_children,
  below.leaves AS n_leaves, below.saved::BIGINT AS saved_tokens, nodes.ends AS ends_sha256
FROM nodes JOIN below USING (prefix) LEFT JOIN children USING (prefix) LEFT JOIN nodes up ON up.prefix = nodes.above
"""
