"""Best-fit packing of token sequences by bin completion (operator 4).

Lengths are whole numbers up to the capacity, so whatever the corpus, its packing problem is a table of at most ``capacity``
counts. That table alone comes to the driver. There a branch-and-bound completes bins around the largest length left:
it enumerates undominated fillings (none in which a length could give way to a larger one left that still fits, or to which
one could be added), tries them by waste, and drops a branch whose waste exceeds what a better packing may waste. A
filling is used as often as its counts allow, so the plan has few lines. Best-fit decreasing gives the first incumbent.
The plan is a table of rank ranges; the ranks of the pieces of each length are counted by Spark and every piece finds its
place by one binary search.

Defined cases: a null or empty text is its end id alone. Repeated rows are packed each. Other columns are ignored. An empty
table gives no rows. Documents beyond the capacity are cut so that only their first piece is shorter than the capacity.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daylog.llm.chunks import library_encoder, packed, vocabulary_path
from daylog.llm.common import documents, small_batches, stored, texts_of

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
CAPACITY = 1024
#: Fillings tried at a node, steps spent on enumerating them there, and steps of the whole search.
WIDTH, STEPS, EFFORT = 6, 4_000, 600_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long"
PIECE_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("local", pa.int64())])


# --- the plan --------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Line:
    """``copies`` sequences that each hold ``items`` (length, how many), largest first."""

    items: tuple[tuple[int, int], ...]
    copies: int


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Line]:
    """Best-fit decreasing over counts: equal bins are handled together, so the work depends on the capacity alone."""
    bins: dict[int, Counter] = defaultdict(Counter)  # room left -> fillings and how many bins have them
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = next((r for r in sorted(bins) if r >= length), None)
            if room is None:
                each = capacity // length
                whole, rest = divmod(left, each)
                if whole:
                    bins[capacity - each * length][((length, each),)] += whole
                if rest:
                    bins[capacity - rest * length][((length, rest),)] += 1
                break
            fill, n = bins[room].popitem()
            each = room // length
            whole = min(n, left // each)
            if whole:
                bins[room - each * length][(*fill, (length, each))] += whole
                left -= whole * each
            if n > whole and left and left < each:
                bins[room - left * length][(*fill, (length, left))] += 1
                whole, left = whole + 1, 0
            if n > whole:
                bins[room][fill] += n - whole
            if not bins[room]:
                del bins[room]
    return [Line(fill, n) for fills in bins.values() for fill, n in fills.items()]


def fillings(lengths: list[int], counts: dict[int, int], room: int, width: int, steps: int) -> tuple[list[tuple[int, tuple[tuple[int, int], ...]]], int]:
    """Up to ``width`` undominated fillings of ``room`` as (waste, items), least waste first, and the steps they took."""
    found: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    spent = 0

    def undominated(items: tuple[tuple[int, int], ...], waste: int) -> bool:
        used = dict(items)
        for length in lengths:
            if counts[length] > used.get(length, 0):
                if length <= waste:
                    return False  # it could be added
                # the next smaller one used could give way to it
                if any(0 < length - x <= waste for x in used):
                    return False
        return True

    def down(at: int, room: int, items: tuple[tuple[int, int], ...]) -> None:
        nonlocal spent
        spent += 1
        if spent > steps or len(found) >= width and found[0][0] == 0:
            return
        at = max(at, bisect_left(lengths, -room, key=lambda x: -x))
        if room == 0 or at >= len(lengths):
            if undominated(items, room):
                found.append((room, items))
                found.sort(key=lambda x: (x[0], len(x[1])))
                del found[width:]
            return
        length = lengths[at]
        for k in range(min(counts[length], room // length), -1, -1):
            down(at + 1, room - k * length, (*items, (length, k)) if k else items)
            if spent > steps or found and found[0][0] == 0 and len(found) >= width:
                return

    down(0, room, ())
    return found, spent


def pack(counts: dict[int, int], capacity: int = CAPACITY, width: int = WIDTH, steps: int = STEPS, effort: int = EFFORT) -> list[Line]:
    """The fewest bins found for ``counts`` pieces of each length. Proven least where it meets the sum's bound."""
    counts = {k: n for k, n in counts.items() if n}
    total = sum(k * n for k, n in counts.items())
    best = best_fit_decreasing(counts, capacity)
    fewest = sum(x.copies for x in best)
    least = -(-total // capacity)
    spent = 0

    # Branches still to try, deepest first: counts left, the lines chosen, bins used, waste so far.
    stack: list[tuple[dict[int, int], tuple, int, int]] = [(counts, (), 0, 0)]
    while stack and spent < effort and fewest > least:
        left, lines, used, waste = stack.pop()
        spent += 1
        if not left:
            if used < fewest:
                chosen, chain = [], lines
                while chain:
                    line, chain = chain
                    chosen.append(line)
                best, fewest = chosen, used
            continue
        allowed = (fewest - 1) * capacity - total
        if waste > allowed or used >= fewest:
            continue
        lengths = sorted(left, reverse=True)
        first = lengths[0]
        rest = dict(left)
        rest[first] -= 1
        options, took = fillings([x for x in lengths if rest[x]], rest, capacity - first, width, steps if len(lines) < 2 else max(200, steps // 8))
        spent += took
        children = []
        for over, items in options:
            used_up = Counter(dict(items))
            used_up[first] += 1
            copies = min(left[x] // k for x, k in used_up.items())
            after = {x: n - copies * used_up[x] for x, n in left.items() if n > copies * used_up[x]}
            line = Line(tuple(sorted(used_up.items(), reverse=True)), copies)
            if waste + over * copies <= allowed:
                children.append((after, (line, lines), used + copies, waste + over * copies))
            elif over and copies > 1:  # a part of them stays within the bound
                few = (allowed - waste) // over
                if few:
                    after = {x: n - few * used_up[x] for x, n in left.items() if n > few * used_up[x]}
                    children.append((after, (Line(line.items, few), lines), used + few, waste + over * few))
        stack += children[::-1]
    return best


def placements(lines: list[Line]) -> dict[str, np.ndarray]:
    """Rank ranges of each length: the r-th piece in one goes to bin ``bin + (r - first) // per`` at ``offset + length * rest``."""
    rows, used, bin_ = [], Counter(), 0
    for line in lines:
        offset = 0
        for length, per in line.items:
            rows.append((length, used[length], per, bin_, offset))
            used[length] += per * line.copies
            offset += per * length
        bin_ += line.copies
    rows.sort()
    return {k: np.array([x[i] for x in rows], np.int64) for i, k in enumerate(("length", "first", "per", "bin", "offset"))}


# --- Spark -----------------------------------------------------------------------------------------------------------


def _cutter(tokenizer: str, end_id: int, capacity: int):
    end = packed([end_id])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, met = library_encoder(tokenizer), TaskContext.get().partitionId(), Counter()
        for batch in small_batches(batches):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts_of(batch, "text")), strict=True):
                ids += end
                total, at, piece = len(ids) // 4, 0, 0
                n = total if total <= capacity else total % capacity or capacity
                while at < total:
                    rows.append((doc_id, piece, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]), part, met[n]))
                    met[n] += 1
                    at, piece, n = at + n, piece + 1, capacity
            columns = list(zip(*rows)) or [[]] * len(PIECE_ARROW)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, PIECE_ARROW)], schema=PIECE_ARROW)

    return cut


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = stored(given.mapInArrow(_cutter(vocabulary_path(VOCABULARY, vocabulary), end_id, capacity), PIECES), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # A row for each length, so no more than ``capacity`` rows.
    counts = {x.length: x.n for x in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = placements(pack(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local")).alias("rank"))
    return ranked.mapInArrow(_placer(plan), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def _placer(plan: dict[str, np.ndarray]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = np.searchsorted(plan["length"], np.arange(plan["length"].max() + 2 if len(plan["length"]) else 1))
        for batch in batches:
            length, rank = (batch.column(x).to_numpy() for x in ("length", "rank"))
            at = np.empty(len(length), np.int64)
            for value in np.unique(length):
                own = length == value
                low, high = begin[value], begin[value + 1]
                at[own] = low + np.searchsorted(plan["first"][low:high], rank[own], "right") - 1
            copy, place = np.divmod(rank - plan["first"][at], plan["per"][at])
            columns = [batch.column(x) for x in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(plan["bin"][at] + copy), pa.array(plan["offset"][at] + place * length)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return place


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
