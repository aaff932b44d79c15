"""Substring deduplication by super-k-mers (operator 1).

A window is 50 consecutive words of a document. Its minimiser is the least hash among its runs of 4 words, so equal windows
have equal minimisers. Consecutive windows that share one travel as one packed string, a super-k-mer, to the bucket of the
minimiser. There windows are ranked exactly (word numbers, then ranks of 2, 4, ... 32 words by sorting, then of 50) and every
window learns the smallest document in which it starts. Words covered by a window that also starts in a smaller
document are removed.

* A window reaches over half of its words to the left or the right of its minimiser: the 27 words from the minimiser to that side
  (to the right, if both) are its core, and equal windows have equal cores. Cores in several documents are marked in a bitmap;
  only windows whose core is marked travel. Chance marks cost work, never results.
* Strings travel once, to their bucket. A task hands a string on only for a smaller document than before, and the bucket takes it
  once, so a passage that a third of all documents hold is a few rows.
* A minimiser with more than ``BUCKET_STRINGS`` different strings (near copies of one text) is not one task's work: its
  windows become rows of their own and meet by an aggregate. Both ways give the same windows.
* Texts are read whole; very long ones are hashed in overlapping segments.

Defined cases: a null or blank text has no words. A null id neither removes words nor loses any. Rows that repeat an id
do not remove each other's words; each is judged for itself. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daylog.llm.common import documents, in_blocks, mix64, small_batches, stored, texts_of, whole_row, word_hashes, word_starts, words_of

WINDOW = 50
MINIMISER = 4
#: A power of two of at least 4,096; 2**25 bits are 4 MB. Where many cores are shared the bitmap has 8 bits or more for each, up to 32 MB.
BITMAP_BITS = 1 << 25
BITS_A_CORE, MOST_BITS = 8, 1 << 28
BUCKET_STRINGS = 20_000
#: Words hashed at a time, and bytes of strings ranked at a time.
SEGMENT, BLOCK = 400_000, 8 << 20
#: Low bits of a run's hash that hold its place in a block instead, so that of equal runs the first is the least.
PLACE = np.uint64((1 << 20) - 1)
#: Strings that a task remembers to have handed on, at most.
HANDED = 200_000


def _minimisers(hashes: np.ndarray, window: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The minimiser of every window over the word hashes of one block, and the first run of the window that has it."""
    runs = len(hashes) - width + 1
    mixed = np.zeros(runs, np.uint64)
    for j in range(width):
        mixed += hashes[j : j + runs] * np.uint64((2 * j + 3) * 0x9E3779B97F4A7C15 % (1 << 64) | 1)
    least = (mix64(mixed) & ~PLACE) | np.arange(runs, dtype=np.uint64)
    span, have = window - width + 1, 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least & ~PLACE, (least & PLACE).astype(np.int64)


def _run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` words."""
    out, have = hashes, 1
    while have < length:
        step = min(have, length - have)
        out = out[:-step] + out[step:] * np.uint64((2 * have + 1) * 0xD1342543DE82EF95 % (1 << 64) | 1)
        have += step
    return mix64(out)


def _windows(texts: list[str], window: int, width: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of stretches of the texts: the stretches (text number, first word, words), the first words of their windows
    in the block, the stretch of each, and the windows' minimisers and cores."""
    stretches = []
    for number, text in enumerate(texts):
        words = words_of(text)
        for first in range(0, max(0, len(words) - window + 1), SEGMENT):
            stretches.append((number, first, words[first : first + SEGMENT + window - 1]))
    half = (window + width) // 2
    for block in in_blocks(stretches, [len(x[2]) for x in stretches], SEGMENT):
        buffer = np.frombuffer(b" ".join(b" ".join(x[2]) for x in block), np.uint8)
        hashes = word_hashes(buffer, *word_starts(buffer))
        owner = np.repeat(np.arange(len(block)), [len(x[2]) for x in block])
        values, run = _minimisers(hashes, window, width)
        valid = np.flatnonzero(owner[: len(values)] == owner[window - 1 :])
        values, run = values[valid], run[valid]
        cores = _run_hashes(hashes, half)[np.where(run + half <= valid + window, run, run + width - half)]
        yield block, valid, owner[valid], values.view(np.int64), cores.view(np.int64)


def super_kmers(texts: list[str], window: int = WINDOW, width: int = MINIMISER, wanted: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, tuple[list[bytes], int]]]:
    """For stretches of the texts: text number, minimisers, first words and numbers of windows of their super-k-mers, words.

    ``wanted`` tells by their cores which windows are taken; others end a super-k-mer.
    """
    for block, valid, owner, values, cores in _windows(texts, window, width):
        if wanted is not None:
            stay = np.flatnonzero(wanted(cores))
            valid, owner, values = valid[stay], owner[stay], values[stay]
        new = np.ones(len(valid), bool)
        new[1:] = (np.diff(valid) != 1) | (values[1:] != values[:-1])
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(valid)))
        begins, keys = valid[first], values[first]
        counts = np.array([len(x[2]) for x in block])
        base = np.cumsum(counts) - counts
        cut = np.searchsorted(owner[first], np.arange(len(block) + 1))
        for k, (number, offset, words) in enumerate(block):
            own = slice(cut[k], cut[k + 1])
            yield number, keys[own], begins[own] - base[k] + offset, sizes[own], (words, offset)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def _core_rows(window: int, width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            ids = batch.column("doc_id").to_numpy()
            for block, _, owner, _, cores in _windows(texts_of(batch, "text"), window, width):
                new = np.ones(len(cores), bool)
                new[1:] = (np.diff(owner) != 0) | (cores[1:] != cores[:-1])
                found = ids[np.array([x[0] for x in block])[owner[new]]]
                yield pa.RecordBatch.from_arrays([pa.array(cores[new]), pa.array(found)], names=["core", "doc_id"])

    return rows


def _gathered(rows: Iterator[pa.RecordBatch], at_least: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Small batches joined into larger ones."""
    held, n = [], 0
    for batch in rows:
        held.append(batch)
        n += batch.num_rows
        if n >= at_least:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def shared_bitmap(docs: DataFrame, window: int, width: int, bits: int) -> bytes:
    """A bitmap with a mark for every core that occurs in several documents: ``bits``, or more where many are shared."""
    make = _core_rows(window, width)
    pairs = docs.where("doc_id is not null").mapInArrow(lambda b: _gathered(make(b)), "core long, doc_id long")
    shared = pairs.groupBy("core").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    shared = stored(shared.select("core"), "shared-cores")
    bits = max(bits, min(MOST_BITS, 1 << (BITS_A_CORE * shared.count()).bit_length()))
    place = F.col("core").bitwiseAND(bits - 1)
    words = shared.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(core & 63 AS int))")).alias("mask"))
    # At most bits / 64 rows.
    table = words.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[table.column("word").to_numpy()] = table.column("mask").to_numpy()
    return out.tobytes()


def _cutter(bitmap, window: int, width: int):
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32())
    names = ["minimiser", "packed", "digest", "doc_id", "text_hash", "start"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(bitmap.value, np.int64)

        def wanted(cores: np.ndarray) -> np.ndarray:
            place = cores & (64 * len(marks) - 1)
            return (marks[place >> 6] >> (place & 63)) & 1

        handed: dict[bytes, int] = {}  # strings handed on by this task, with the smallest document of each
        for batch in small_batches(batches):
            ids, hashes = (batch.column(x).to_numpy() for x in ("doc_id", "text_hash"))
            for number, keys, starts, sizes, (words, offset) in super_kmers(texts_of(batch, "text"), window, width, wanted):
                if not len(keys):
                    continue
                own = int(ids[number])
                strings: list[bytes | None] = [b" ".join(words[a - offset : a - offset + n + window - 1]) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                digests = [hashlib.blake2b(x, digest_size=16).digest() for x in strings]
                for i, x in enumerate(digests):
                    if handed.get(x, own + 1) <= own:
                        strings[i] = None
                    else:
                        handed[x] = own
                if len(handed) > HANDED:
                    handed.clear()
                columns = (keys, strings, digests, np.full(len(keys), own), np.full(len(keys), hashes[number]), starts.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=names)

    return cut


def shared_strings(docs: DataFrame, window: int = WINDOW, width: int = MINIMISER, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """Super-k-mers of the windows that may be in several documents: minimiser, packed, digest, doc_id, text_hash, start.

    ``packed`` is null where the same task has handed on that string for a smaller document or the same.
    """
    given = _keyed(docs).where("doc_id is not null")
    cut = _cutter(docs.sparkSession.sparkContext.broadcast(shared_bitmap(given, window, width, bitmap_bits)), window, width)
    strings = given.mapInArrow(lambda b: _gathered(cut(b), 2_000), "minimiser long, packed binary, digest binary, doc_id long, text_hash long, start int")
    return stored(strings, "super-kmers")


def exact_ranks(strings: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every string: a number that equal windows share, and the string's number."""
    numbers: dict[bytes, int] = {}
    counts, ids = [], []
    for x in strings:
        words = x.split(b" ")
        counts.append(len(words))
        ids += [numbers.setdefault(w, len(numbers)) for w in words]
    rank, have = np.array(ids, np.int64), 1
    while 2 * have <= window:
        rank = np.unique(rank[:-have] * (len(rank) + 1) + rank[have:], return_inverse=True)[1]
        have *= 2
    if have < window:
        step = window - have
        rank = np.unique(rank[:-step] * (len(rank) + 1) + rank[step:], return_inverse=True)[1]
    owner = np.repeat(np.arange(len(strings)), counts)
    inside = owner[: len(rank)] == owner[window - 1 :]
    return rank[inside], owner[: len(rank)][inside]


def _bucket_sorter(window: int):
    """Strings sorted by minimiser, digest and document in, the smallest document of each of their windows out."""

    def solve(rows: list[tuple[bytes, bytes, int]]) -> pa.RecordBatch:
        rank, owner = exact_ranks([x[0] for x in rows], window)
        order = np.argsort(rank, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(rank[order]) != 0))
        least = np.array([x[2] for x in rows], np.int64)[owner]
        smallest = np.minimum.reduceat(least[order], first)
        out = np.empty(len(rank), np.int64)
        out[order] = np.repeat(smallest, np.diff(np.append(first, len(rank))))
        ends = np.append(0, np.cumsum(np.bincount(owner, minlength=len(rows)))).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array([x[1] for x in rows], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(out))], names=["digest", "least"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, (None, None)
        for batch in batches:
            for key, *row in zip(*(batch.column(x).to_pylist() for x in ("minimiser", "packed", "digest", "doc_id")), strict=True):
                if (key, row[1]) == last:  # the string has come with its smallest document
                    continue
                if size >= BLOCK and key != last[0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[0])
                last = key, row[1]
        if held:
            yield solve(held)

    return sort


def _window_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, digest, doc_id in zip(*(batch.column(x).to_pylist() for x in ("packed", "digest", "doc_id")), strict=True):
                words = packed.split(b" ")
                own = [hashlib.blake2b(b" ".join(words[i : i + window]), digest_size=16).digest() for i in range(len(words) - window + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([digest] * len(own), pa.binary()), pa.array(range(len(own)), pa.int32()), pa.array([doc_id] * len(own), pa.int64())], names=["window", "digest", "at", "doc_id"])

    return rows


def _least_documents(strings: DataFrame, window: int, bucket_strings: int) -> DataFrame:
    """digest, least: for each string the smallest document of each of its windows."""
    many = strings.groupBy("minimiser").count().where(F.col("count") > bucket_strings).select("minimiser")
    different = strings.join(many, "minimiser", "left_semi").select("minimiser", "digest").distinct()
    large = different.groupBy("minimiser").count().where(F.col("count") > bucket_strings).select("minimiser")
    large = stored(large, "large-buckets")  # at most rows / bucket_strings
    some_large = not large.isEmpty()
    calm = strings.join(large, "minimiser", "left_anti") if some_large else strings
    parts = int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    calm = calm.repartition(parts, "minimiser").sortWithinPartitions("minimiser", "digest", "doc_id")
    least = calm.mapInArrow(_bucket_sorter(window), "digest binary, least array<long>")
    if not some_large:
        return least
    make = _window_rows(window)
    apart = strings.join(large, "minimiser", "left_semi").groupBy("digest", "packed").agg(F.min("doc_id").alias("doc_id"))
    apart = apart.mapInArrow(lambda b: _gathered(make(b)), "window binary, digest binary, at int, doc_id long")
    smallest = apart.groupBy("window").agg(F.min("doc_id").alias("smallest"))
    placed = apart.join(smallest, "window").groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("at", "smallest"))).alias("found"))
    return least.unionByName(placed.select("digest", F.col("found.smallest").alias("least")))


def left_words(text: str, starts: list[int] | None, hits: list | None, window: int) -> tuple[int, list[bytes]]:
    """How many words a text has, and those that no removed window covers."""
    words = words_of(text)
    if not starts:
        return len(words), words
    cover = np.zeros(len(words) + 1, np.int32)
    for start, flags in zip(starts, hits, strict=True):
        at = start + np.flatnonzero(flags)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + window, -1)
    stay = np.cumsum(cover)[: len(words)] == 0
    return len(words), [w for w, ok in zip(words, stay.tolist(), strict=True) if ok]


def joined(words: list[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "surrogatepass")


def repeated_windows(docs: DataFrame, window: int = WINDOW, width: int = MINIMISER, bitmap_bits: int = BITMAP_BITS, bucket_strings: int = BUCKET_STRINGS) -> DataFrame:
    """doc_id, text_hash, starts, hits: where windows of a document begin that also start in a smaller one."""
    strings = shared_strings(docs, window, width, bitmap_bits)
    least = _least_documents(strings.where("packed is not null").select("minimiser", "packed", "digest", "doc_id"), window, bucket_strings)
    met = strings.select("digest", "doc_id", "text_hash", "start").join(least, "digest")
    hits = met.select("doc_id", "text_hash", "start", F.transform("least", lambda x: x < F.col("doc_id")).alias("hits")).where(F.exists("hits", lambda x: x))
    # Bounded by the length of the one text: rows that repeat an id and its text give the same places once.
    places = hits.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "hits")).alias("places"))
    return places.select("doc_id", "text_hash", F.col("places.start").alias("starts"), F.col("places.hits").alias("hits"))


def dedup_substrings(docs: DataFrame, window: int = WINDOW, width: int = MINIMISER, bitmap_bits: int = BITMAP_BITS, bucket_strings: int = BUCKET_STRINGS) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, text_hash, n_words, n_removed and kept, the words left joined by a space."""
    spans = repeated_windows(docs, window, width, bitmap_bits, bucket_strings)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = zip(texts_of(batch, "text"), batch.column("starts").to_pylist(), batch.column("hits").to_pylist(), strict=True)
            total, kept = [], []
            for text, starts, hits in rows:
                n, words = left_words(text, starts, hits, window)
                total.append((n, n - len(words)))
                kept.append(joined(words))
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array([x[0] for x in total], pa.int64()), pa.array([x[1] for x in total], pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_words", "n_removed", "kept"])

    return _keyed(docs).join(spans, ["doc_id", "text_hash"], "left").mapInArrow(remove, "doc_id long, text_hash long, n_words long, n_removed long, kept string")


def without_repeats(docs: DataFrame, window: int = WINDOW, **parameters: int) -> DataFrame:
    """The rows of ``docs``, all columns as they are but for texts that lose words: those hold the words left, joined by a
    space, and ``n_chars`` follows. A row that loses its last word goes."""
    spans = repeated_windows(docs, window, **parameters)
    text = F.col("text").cast("string")
    # The other columns travel as one struct, so that no name of theirs meets a key.
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), text.alias("text"), whole_row(docs, "text").alias("rest"))
    met = given.join(spans, ["doc_id", "text_hash"], "left").select("rest", "text", "starts", "hits")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts, stay = batch.column("text").to_pylist(), np.ones(batch.num_rows, bool)
            for i, (starts, hits) in enumerate(zip(batch.column("starts").to_pylist(), batch.column("hits").to_pylist(), strict=True)):
                if starts:
                    words = left_words(texts[i], starts, hits, window)[1]
                    texts[i], stay[i] = joined(words), bool(words)
            columns = [batch.column("rest"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["rest", "text"]).filter(pa.array(stay))

    kept = met.mapInArrow(remove, StructType([met.schema["rest"], met.schema["text"]]))
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    own = {"text": F.col("text"), "n_chars": n_chars}
    return kept.select(*((own[c] if c in own else F.col("rest").getField(c)).alias(c) for c in docs.columns))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_substrings(documents(spark, sf_dir))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH split AS (
    SELECT doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+') if x <> ''] AS words FROM documents
), starts AS (
    SELECT doc_id, unnest(range(1, len(words) - 48)) AS pos, words FROM split WHERE len(words) >= 50
), windows AS (
    SELECT doc_id, pos, md5(array_to_string(list_slice(words, pos, pos + 49), ' ')) AS content FROM starts
), firsts AS (
    SELECT content, min(doc_id) AS first FROM windows GROUP BY content
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM windows JOIN firsts USING (content) WHERE first < doc_id
), each AS (
    SELECT doc_id, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM split
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""
