"""Byte-level BPE by tree reduction (operator 6).

Encodings form a monoid under "join and mend": halves of a piece are encoded each for itself, recursively, and two
neighbours are joined by re-encoding a window of tokens around their boundary. The window grows until the tokens outside
it provably stay: a sequence of tokens is the encoding of its bytes exactly if every two neighbours are compatible, that
is, if the bytes of the two encode to just these two. (All tokens of a rank table that encode to themselves have this
property.) Neighbours inside a half and inside the window are compatible already, so only the window's two edges are
tested. Decoding joins the byte strings of the tokens up the same tree. The pieces of a text, one for each match of the
split pattern, are encoded separately and joined without mending.

Defined cases: a null or empty text has no ids and decodes to no bytes. Long pieces take n log n steps as long as windows
stay small, and never more than one heap-driven encoding a level. Repeated rows are encoded each. Other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylog.llm.chunks import ONE_PIECE, Encoder, packed, vocabulary_path
from daylog.llm.common import documents, small_batches, texts_of

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Bytes up to which a piece is a leaf of the tree.
LEAF = 4
#: Bytes from which a window is encoded with a heap.
HEAP = 48
#: Pairs of tokens that a worker remembers, encodings of short parts, and chunks met lately; bounds memory, not results.
KEPT = 100_000
#: Rows decoded at a time.
DECODED = 512
#: Bytes up to which the encoding of a part is remembered.
KEPT_BYTES = 8


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class TreeEncoder:
    """Encodes byte strings by ``ranks``; ``join`` is associative on encodings."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.short: dict[bytes, tuple[int, ...]] = {}

    def merged(self, data: bytes) -> tuple[int, ...]:
        """What ``_merged`` gives, remembered for short strings."""
        if len(data) > KEPT_BYTES:
            return self._merged(data)
        known = self.short.get(data)
        if known is None:
            if len(self.short) > KEPT:
                self.short.clear()
            known = self.short[data] = self._merged(data)
        return known

    def _merged(self, data: bytes) -> tuple[int, ...]:
        """The defining procedure: merge the pair of lowest rank, leftmost first, until none is left."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None and len(data) == 1:
            return (whole,)
        if len(data) >= HEAP:
            return self._merged_long(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            low, at = None, 0
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (low is None or rank < low):
                    low, at = rank, i
            if low is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple([ranks[x] for x in parts])

    def _merged_long(self, data: bytes) -> tuple[int, ...]:
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # of the part that starts here; 0 once it is swallowed
        before = list(range(-1, n - 1))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (rank := ranks.get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (rank, i, end[stop]))
            if (k := before[i]) >= 0 and (rank := ranks.get(data[k:stop])) is not None:
                heapq.heappush(heap, (rank, k, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return tuple(out)

    def compatible(self, a: int, b: int) -> bool:
        """Whether two tokens stay apart when their bytes meet."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > KEPT:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(self.tokens[a] + self.tokens[b]) == (a, b)
        return known

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the joined bytes of two encodings."""
        if not left or not right:
            return left or right
        if self.compatible(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merged(self.decode(left[len(left) - i :] + right[:j]))
            kept_left, kept_right = len(left) == i, len(right) == j
            kept_left = kept_left or self.compatible(left[len(left) - i - 1], window[0])
            kept_right = kept_right or self.compatible(window[-1], right[j])
            if kept_left and kept_right:
                return left[: len(left) - i] + window + right[j:]
            if not kept_left:
                i = min(len(left), 2 * i)
            if not kept_right:
                j = min(len(right), 2 * j)

    def encode(self, data: bytes) -> tuple[int, ...]:
        """The encoding of one piece: halves first, then their join."""
        known = self.short.get(data)
        if known is not None:
            return known
        if len(data) <= LEAF:
            return self.merged(data) if data else ()
        middle = len(data) // 2
        ids = self.join(self.encode(data[:middle]), self.encode(data[middle:]))
        if len(data) <= KEPT_BYTES and len(self.short) < KEPT:
            self.short[data] = ids
        return ids

    def decode(self, ids) -> bytes:
        """The bytes of all tokens; joining byte strings is the monoid of the decoding tree."""
        return b"".join(map(self.tokens.__getitem__, ids))


_TREES: dict[str, TreeEncoder] = {}
_TEXTS: dict[tuple[str, str], Encoder] = {}


def tree_encoder(path: str) -> TreeEncoder:
    if path not in _TREES:
        _TREES[path] = TreeEncoder(read_ranks(path))
    return _TREES[path]


def text_encoder(path: str, pattern: str) -> Encoder:
    """Encodes texts: split by ``pattern``, each match by the tree; a worker remembers the chunks it has met."""
    if (path, pattern) not in _TEXTS:
        import public_tokenizers
        import regex

        own = pattern == public_tokenizers.PATTERN
        pieces = regex.compile(pattern).findall
        tree = tree_encoder(path)

        def many(strings: list[str]) -> list[bytes]:
            out = []
            for text in strings:
                # A word of letters alone is one match of the pattern.
                split = (text,) if own and ONE_PIECE(text) else pieces(text)
                out.append(b"".join([packed(tree.encode(x.encode("utf-8", "surrogatepass"))) for x in split]))
            return out

        _TEXTS[path, pattern] = Encoder(many, KEPT)
    return _TEXTS[path, pattern]


def bpe_encode(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ids (an array of int) of the ``text`` of every row."""
    path = vocabulary_path(VOCABULARY, ranks)
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, pattern)
        for batch in small_batches(batches):
            raw = encoder(texts_of(batch, "text"))
            ends = np.cumsum([0, *(len(x) // 4 for x in raw)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), "<u4").astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(encode, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """The columns of ``encoded`` and ``decoded``, the bytes of ``ids``."""
    path = vocabulary_path(VOCABULARY, ranks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tree_encoder(path).tokens
        for batch in batches:
            for part in (batch.slice(at, DECODED) for at in range(0, batch.num_rows, DECODED)):
                column = part.column("ids")
                ends, ids = column.offsets.to_numpy(), column.values.to_numpy()
                raw = [b"".join(map(tokens.__getitem__, ids[a:b].tolist())) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=[*part.schema.names, "decoded"])

    names = ", ".join(f"`{k}` {v}" for k, v in encoded.dtypes)
    return encoded.mapInArrow(decode, f"{names}, decoded binary")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = bpe_decode(bpe_encode(documents(spark, sf_dir)))
    return read.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
