"""Token-id shards with a keyed index (operator 2).

A store is a folder: ``shard-N.bin`` holds nothing but ids, little-endian, of two or four bytes as the vocabulary needs;
documents lie in ascending id order, each closed by an end id. ``index-B.mph`` maps the keys of hash bucket B to
(shard, offset, length) by a minimal perfect hash: levels of bit arrays give every key its own slot, and the slot's
stored 32-bit fingerprint turns away keys that were never written (but for one in four thousand million). ``manifest.json``
names the shards and their first positions. One lookup reads one bucket and one slot, whatever the size of the store.

Defined cases: a null text is an empty one and yields the end id alone. A repeated id is kept: its copies are numbered from
0 in order of their texts and (id, copy) is the key. Rows with a null id come first. Other columns are ignored. An empty
table gives a store without shards, from which nothing is read.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daylog.llm.chunks import library_encoder, vocabulary_path
from daylog.llm.common import documents, mix64, new_folder, small_batches, stored, texts_of

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: Keys of one index bucket, about.
BUCKET_KEYS = 250_000
#: Ids that one read task takes from a shard, about.
READ_IDS = 4_000_000
#: Bits of a level for each key that reaches it.
GAMMA = 2.0
LEVELS = 40

DIRECTORY = "doc_id long, copy int, shard int, offset long, length long"


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# --- writing ---------------------------------------------------------------------------------------------------------


def write_tokens(docs: DataFrame, path: str, end_id: int = END_ID, vocabulary: str | None = None, bucket_keys: int = BUCKET_KEYS) -> str:
    """Encode ``text`` of every row of ``docs`` (doc_id, text) into a store at ``path``; returns ``path``."""
    spark = docs.sparkSession
    tokenizer = vocabulary_path(VOCABULARY, vocabulary)
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    file_system(path)[0].create_dir(file_system(path)[1], recursive=True)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    directory = stored(ordered.mapInArrow(_shard_writer(path, tokenizer, end_id, width), DIRECTORY), "directory")
    totals = directory.groupBy("shard").agg(F.sum("length").alias("ids"), F.count(F.lit(1)).alias("keys")).orderBy("shard").collect()  # a row a shard
    keys = sum(x.keys for x in totals)
    buckets = max(1, -(-keys // bucket_keys))
    shards, start = {}, 0
    for x in totals:
        shards[x.shard] = {"start": start, "ids": x.ids, "documents": x.keys}
        start += x.ids
    keyed = directory.withColumn("bucket", _bucket(buckets))
    keyed.groupBy("bucket").applyInPandas(_index_writer(path), "bucket int, keys long").write.format("noop").mode("overwrite").save()
    manifest = {"width": width, "end_id": end_id, "buckets": buckets, "ids": start, "shards": shards}
    system, root = file_system(path)
    with system.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return path


def _place(system, temporary: str, final: str) -> None:
    """A finished file gets its name in one step, so a second attempt of a task leaves one whole file."""
    system.move(temporary, final)


def _shard_writer(path: str, tokenizer: str, end_id: int, width: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId()
        encode = library_encoder(tokenizer)
        kind = np.dtype(f"<u{width}")
        end = np.array([end_id], kind).tobytes()
        system, root = file_system(path)
        temporary = f"{root}/.shard-{shard:05d}-{context.taskAttemptId()}"
        out, offset, last, copy = None, 0, object(), 0
        for batch in small_batches(batches):
            ids, texts = batch.column("doc_id").to_pylist(), texts_of(batch, "text")
            out = out or system.open_output_stream(temporary)
            rows = []
            for doc_id, packed in zip(ids, encode(texts), strict=True):
                copy = copy + 1 if doc_id == last else 0
                last = doc_id
                out.write((packed if width == 4 else np.frombuffer(packed, "<u4").astype(kind).tobytes()) + end)
                n = len(packed) // 4 + 1
                rows.append((doc_id, copy, shard, offset, n))
                offset += n
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=["doc_id", "copy", "shard", "offset", "length"]) if rows else _no_rows()
        if out:
            out.close()
            _place(system, temporary, f"{root}/shard-{shard:05d}.bin")

    return write


def _no_rows() -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "copy": pa.int32(), "shard": pa.int32(), "offset": pa.int64(), "length": pa.int64()}
    return pa.RecordBatch.from_pydict({k: pa.array([], t) for k, t in kinds.items()})


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), F.col("doc_id"), F.col("copy")), F.lit(buckets)).cast("int")


def key_hash(doc_id: pd.Series, copy: pd.Series) -> np.ndarray:
    """One 64-bit hash of a key; a null id is a key of its own."""
    null = doc_id.isna().to_numpy()
    ids = doc_id.fillna(0).astype("int64").to_numpy().view(np.uint64)
    return mix64(mix64(ids + np.uint64(0x9E3779B97F4A7C15)) ^ mix64(copy.to_numpy().astype(np.uint64) * np.uint64(2) + null.astype(np.uint64)))


def _level(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix64(keys + np.uint64((level + 1) * 0x632BE59BD9B4E019 % (1 << 64))) % np.uint64(size)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(~keys) >> np.uint64(32)).astype("<u4")


def build_mph(keys: np.ndarray) -> dict:
    """Levels of bits, and how many bits are set before each 64-bit word of them all. Keys must differ.

    On each level the keys that share a position with none set its bit; the others go on. Keys left after the last level
    (practically none) are listed.
    """
    sizes, words = [], []
    left = keys
    while len(left) and len(sizes) < LEVELS:
        size = -(-int(max(64, GAMMA * len(left))) // 64) * 64
        at = _level(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[~alone[at]]
    bits = np.concatenate(words) if words else np.zeros(0, "<u8")
    counts = np.bitwise_count(bits).astype(np.int64)
    before = (np.cumsum(counts) - counts).astype("<u4")
    return {"sizes": np.array(sizes, "<u8"), "bits": bits, "before": before, "listed": np.sort(left).astype("<u8")}


def mph_slots(mph: dict, keys: np.ndarray) -> np.ndarray:
    """The slot of each key, or -1 where no bit stands for it."""
    out = np.full(len(keys), -1, np.int64)
    open_, base = np.arange(len(keys)), 0
    for level, size in enumerate(mph["sizes"].tolist()):
        at = _level(keys[open_], level, size) + base
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        held = mph["bits"][word]
        hit = (held >> bit) & np.uint64(1) == 1
        below = np.bitwise_count(held & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
        out[open_[hit]] = mph["before"][word[hit]].astype(np.int64) + below[hit]
        open_, base = open_[~hit], base + size
    listed = mph["listed"]
    if len(listed):
        place = np.minimum(np.searchsorted(listed, keys[open_]), len(listed) - 1)
        hit = listed[place] == keys[open_]
        out[open_[hit]] = int(np.bitwise_count(mph["bits"]).sum()) + place[hit]
    return out


_ARRAYS = (("sizes", "<u8"), ("bits", "<u8"), ("before", "<u4"), ("listed", "<u8"), ("prints", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8"))


def _index_writer(path: str):
    def write(rows: pd.DataFrame) -> pd.DataFrame:
        keys = key_hash(rows["doc_id"], rows["copy"])
        index = build_mph(keys)
        slot = mph_slots(index, keys)
        order = np.argsort(slot)
        index |= {"prints": fingerprints(keys)[order]} | {k: rows[k].to_numpy()[order] for k in ("shard", "offset", "length")}
        bucket = int(rows["bucket"].iloc[0])
        system, root = file_system(path)
        temporary = f"{root}/.index-{bucket:06d}-{TaskContext.get().taskAttemptId()}"
        with system.open_output_stream(temporary) as out:
            for name, kind in _ARRAYS:
                out.write(struct.pack("<Q", len(index[name])) + index[name].astype(kind).tobytes())
        _place(system, temporary, f"{root}/index-{bucket:06d}.mph")
        return pd.DataFrame({"bucket": [bucket], "keys": [len(rows)]})

    return write


# --- reading ---------------------------------------------------------------------------------------------------------


def manifest_of(path: str) -> dict:
    system, root = file_system(path)
    with system.open_input_stream(f"{root}/manifest.json") as f:
        return json.loads(f.read())


def read_index(path: str, bucket: int) -> dict | None:
    system, root = file_system(path)
    name = f"{root}/index-{bucket:06d}.mph"
    if not system.get_file_info(name).is_file:
        return None
    with system.open_input_stream(name) as f:
        raw, at, out = f.read(), 0, {}
    for field, kind in _ARRAYS:
        (n,) = struct.unpack_from("<Q", raw, at)
        out[field] = np.frombuffer(raw, kind, n, at + 8)
        at += 8 + n * np.dtype(kind).itemsize
    return out


def locate(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Where the documents of ``keys`` (doc_id, copy) lie; keys that were never written are left out."""
    held = manifest_of(path)

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        index = read_index(path, int(rows["bucket"].iloc[0]))
        if index is None or not len(index["prints"]):
            return pd.DataFrame({k: [] for k in ("doc_id", "copy", "shard", "offset", "length")})
        hashes = key_hash(rows["doc_id"], rows["copy"])
        slot = mph_slots(index, hashes)
        ok = slot >= 0
        ok[ok] = index["prints"][slot[ok]] == fingerprints(hashes[ok])
        rows, slot = rows[ok], slot[ok]
        return pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "copy": rows["copy"], **{k: index[k][slot].astype(np.int64) for k in ("shard", "offset", "length")}})

    # Keys of one bucket are also dealt into lots, so that many askers of one bucket do not meet in one task.
    asked = keys.select("doc_id", "copy").withColumn("bucket", _bucket(held["buckets"])).withColumn("lot", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(4)))
    return asked.groupBy("bucket", "lot").applyInPandas(find, DIRECTORY)


def read_tokens(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Documents by key: doc_id, copy, start (ids of all documents before it), length and ids (unsigned 32-bit, packed).

    Located keys are gathered by shard and stretch, so that each task reads one stretch of one file in order.
    """
    held = manifest_of(path)
    starts = {int(k): v["start"] for k, v in held["shards"].items()}
    kind = np.dtype(f"<u{held['width']}")

    def read(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("offset", kind="stable")
        shard = int(rows["shard"].iloc[0])
        system, root = file_system(path)
        ids = []
        with system.open_input_file(f"{root}/shard-{shard:05d}.bin") as f:
            for offset, length in zip(rows["offset"], rows["length"], strict=True):
                raw = f.read_at(int(length) * kind.itemsize, int(offset) * kind.itemsize)
                ids.append(np.frombuffer(raw, kind).astype("<u4").tobytes())
        return pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "copy": rows["copy"], "start": rows["offset"] + starts[shard], "length": rows["length"], "ids": ids})

    stretch = F.floor(F.col("offset") / READ_IDS)
    found = locate(spark, path, keys).withColumn("stretch", stretch)
    return found.groupBy("shard", "stretch").applyInPandas(read, "doc_id long, copy int, start long, length long, ids binary")


def all_keys(docs: DataFrame) -> DataFrame:
    """The key of every row: its id, and its number among rows of the same id."""
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("doc_id", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("copy"))


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    path = write_tokens(docs, new_folder(spark, "token-shards"))
    read = read_tokens(spark, path, all_keys(docs))
    return read.select("doc_id", "start", F.col("length").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
