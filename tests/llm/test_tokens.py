"""Token shards, packing and byte-level BPE against the plain libraries."""

import base64
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daylog.llm import packing, token_shards
from daylog.llm.bpe_tree import TreeEncoder, bpe_decode, bpe_encode, read_ranks, text_encoder
from daylog.llm.chunks import Encoder, library_encoder, packed
from daylog.llm.common import new_folder
from tests.llm.conftest import TEXTS


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tree():
    return TreeEncoder(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


@pytest.fixture(scope="module")
def plain(tree):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tree.ranks, special_tokens={})


ODD = ["", "  ", " a  b\n c", "a \n b", "\x1c a \x1cb  ", "don't I'll  's", "    \n\n  x", "　 x  y", "x  z", " 1 22 333  ", "\r\n a\x85 b"]


def test_chunked_encoding_equals_whole_encoding(library):
    texts = [x[1] or "" for x in TEXTS] + ODD
    assert library_encoder(public_tokenizers.path("byte_bpe_50k.json"))(texts) == [packed(library(x)) for x in texts]


def test_feeds_marks_and_forgotten_chunks(library, plain, tree):
    rng = random.Random(7)
    parts = ["\n", "\n\n", " ", "  ", "\t", ". ", "!?\n", "###", "a", "Über", "ñandú", "été.", "слово", "語", "x" * 70, "'s", "42", "…", "\x85"]
    texts = ["".join(rng.choice([" ", " ", "\n", ""]) + rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)]
    expected = [packed(library(x)) for x in texts]
    assert library_encoder(public_tokenizers.path("byte_bpe_50k.json"))(texts) == expected
    few = Encoder(lambda strings: [packed(library(x)) for x in strings], kept=4)  # forgets nearly all after each call
    assert [ids for i in range(0, 3000, 10) for ids in few(texts[i : i + 10])] == expected
    assert not any(len(x) > 64 for memory in (few.led, few.bare) for x in (*memory.new, *memory.old))
    trees = text_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert trees(texts) == [packed(plain.encode_ordinary(x)) for x in texts]


def test_added_tokens_are_those_of_the_plain_call(library):
    texts = ["a <|endoftext|> b", "plain words", "<|endoftext|><|endoftext|>x <|endoftext|", "", "more plain words"]
    assert library(texts[0]) == [64, 220, 50256, 275]
    assert library_encoder(public_tokenizers.path("byte_bpe_50k.json"))(texts) == [packed(library(x)) for x in texts]


def test_chunks_are_learned_once_as_they_come(library):
    asked = []
    encoder = Encoder(lambda strings: asked.append(list(strings)) or [packed(library(x)) for x in strings], kept=100)
    texts = ["one two three. two\nthree, two one", "four " + "x" * 80 + " two " + "x" * 80, "", "four\ntwo three."]
    for _ in range(2):
        assert encoder(texts) == [packed(library(x)) for x in texts]
    # Every short chunk is asked for alone, once; long ones whenever they come; all else are the heads of a call.
    single = Counter(x[0] for x in asked if len(x) == 1)
    assert single.pop(" " + "x" * 80) == 4
    assert single == Counter(["\n", " two", " three", ".", "three", ",", " one", "two"])


def test_store_round_trip(spark, docs, library):
    path = token_shards.write_tokens(docs.withColumn("start", F.lit("clash")), new_folder(spark, "t"), bucket_keys=3)
    rows = token_shards.read_tokens(spark, path, token_shards.all_keys(docs)).collect()
    start = 0
    expected = {}
    order = sorted(TEXTS, key=lambda x: (x[0], x[1] or ""))
    copies = Counter()
    for doc_id, text, *_ in order:
        ids = [*library(text), 0]
        expected[doc_id, copies[doc_id]] = (start, ids)
        copies[doc_id] += 1
        start += len(ids)
    assert {(r.doc_id, r.copy): (r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows} == expected
    assert all(r.length == len(expected[r.doc_id, r.copy][1]) for r in rows)
    assert token_shards.manifest_of(path)["ids"] == start
    absent = spark.createDataFrame([(i, 0) for i in range(100, 400)], "doc_id long, copy int")
    assert token_shards.read_tokens(spark, path, absent).count() == 0


def test_store_keeps_null_ids_and_empty_tables(spark, docs, no_docs, library):
    rows = spark.createDataFrame([(None, "x"), (7, "y z")], "doc_id long, text string")
    path = token_shards.write_tokens(rows, new_folder(spark, "t"))
    got = {r.doc_id: (r.start, r.length) for r in token_shards.read_tokens(spark, path, token_shards.all_keys(rows)).collect()}
    assert got == {None: (0, 2), 7: (2, 3)}
    path = token_shards.write_tokens(no_docs, new_folder(spark, "t"))
    assert token_shards.read_tokens(spark, path, token_shards.all_keys(docs)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_hash_is_perfect_and_minimal(n):
    keys = token_shards.mix64(np.arange(n, dtype=np.uint64))
    slots = token_shards.mph_slots(token_shards.build_mph(keys), keys)
    assert sorted(slots.tolist()) == list(range(n))


def least_bins(lengths, capacity):
    """Exact least number of bins by search, for a few items."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def down(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            down(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]])
        down(i + 1, [*rooms, capacity - lengths[i]])

    down(0, [])
    return best


def test_plan_needs_as_few_bins_as_exact_search():
    rng = random.Random(5)
    for _ in range(60):
        lengths = [rng.randint(2, 20) for _ in range(rng.randint(0, 9))]
        plan = packing.pack(Counter(lengths), 20)
        used = Counter()
        for line in plan:
            assert sum(a * b for a, b in line.items) <= 20
            for a, b in line.items:
                used[a] += b * line.copies
        assert used == Counter(lengths)
        assert sum(x.copies for x in plan) == (least_bins(lengths, 20) if lengths else 0)


def test_plan_reaches_the_bound_on_many_pieces():
    counts = Counter(np.random.default_rng(2).integers(3, 400, 20_000).tolist())
    bins = sum(x.copies for x in packing.pack(counts))
    assert bins == -(-sum(k * n for k, n in counts.items()) // 1024)


def test_packed_documents(docs, library):
    rows = packing.pack_documents(docs.withColumn("length", F.lit("clash"))).collect()
    whole = defaultdict(list)
    for doc_id, text, *_ in TEXTS:
        whole[doc_id].append([*library(text), 2])
    by_bin, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        by_bin[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for places in by_bin.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    cut = Counter((i, a, len(ids[a:b]), zlib.crc32(packed(ids[a:b]))) for i, all_ids in whole.items() for ids in all_ids for a, b in spans(len(ids)))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows) == cut
    assert [r.piece for r in sorted(pieces[14], key=lambda r: r.start)] == list(range(len(pieces[14])))


def spans(n):
    first = n if n <= 1024 else n % 1024 or 1024
    edges = [0, *range(first, n + 1, 1024)]
    return list(zip(edges, edges[1:]))


def test_packing_nothing(no_docs):
    assert packing.pack_documents(no_docs).collect() == []


def test_tree_equals_the_plain_encoding(tree, plain):
    rng = random.Random(3)
    pieces = [bytes(rng.choice(b"abcdet hs in re\xc3\xa9\xf0\n") for _ in range(rng.randint(1, 90))) for _ in range(1500)]
    for piece in [*pieces, b"a" * 3000, b" " * 2000, b"ab" * 900, "é".encode() * 500]:
        assert list(tree.encode(piece)) == list(plain._encode_single_piece(piece))
        assert tree.merged(piece) == tree.encode(piece)


def test_join_is_associative_on_encodings(tree):
    rng = random.Random(4)
    for _ in range(300):
        a, b, c = (tree.encode(bytes(rng.choice(b"theinrsa ") for _ in range(rng.randint(0, 12)))) for _ in range(3))
        assert tree.join(tree.join(a, b), c) == tree.join(a, tree.join(b, c))


def test_bpe_of_documents(docs, plain):
    encoded = bpe_encode(docs.withColumn("ids", F.lit("clash")))
    rows = bpe_decode(encoded).collect()
    want = Counter((i, tuple(plain.encode_ordinary(t or "")), (t or "").encode()) for i, t, *_ in TEXTS)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in rows) == want


def test_bpe_of_nothing(no_docs):
    assert bpe_decode(bpe_encode(no_docs)).collect() == []


def test_ranks_read(tree):
    line = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").readline().split()
    assert tree.ranks[base64.b64decode(line[0])] == int(line[1])
