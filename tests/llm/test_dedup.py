"""Substring dedup and SimHash near-dedup against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64

from daylog.llm import simhash, substring_dedup
from tests.llm.conftest import SCHEMA, TEXTS

GAP = re.compile(r"[^\x20\x09-\x0D]+")


def kept_list(rows, window):
    first = {}
    split = [(i, GAP.findall(t or "")) for i, t, *_ in rows]
    for i, words in split:
        for k in range(len(words) - window + 1):
            if i is not None:
                content = tuple(words[k : k + window])
                first[content] = min(i, first.get(content, i))
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def kept_words(rows, window):
    return Counter(kept_list(rows, window))


def passages(seed, n):
    rng = random.Random(seed)
    words = ["ab", "cd", "e", "fé", "漢", "the", "g,"]
    shared = [[rng.choice(words) for _ in range(rng.randint(8, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        text = [w for _ in range(rng.randint(0, 4)) for w in (rng.choice(shared) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randint(0, 20))])]
        rows.append((rng.randint(0, n), rng.choice([" ", "\n", " \t "]).join(text), "en", "s", 0))
    return [*rows, (None, " ".join(shared[0]), None, None, None), (None, " ".join(shared[0] * 2), None, None, None)]


@pytest.mark.parametrize("bucket", [10_000, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_equal_brute_force(spark, docs, seed, bucket, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK", 400)
    rows = passages(seed, 60)
    got = substring_dedup.dedup_substrings(spark.createDataFrame(rows, SCHEMA).withColumn("hits", F.lit("clash")), 6, 2, 1 << 12, bucket).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == kept_words(rows, 6)


def test_substrings_of_odd_texts(docs, no_docs):
    got = substring_dedup.dedup_substrings(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == kept_words(TEXTS, 50)
    assert substring_dedup.dedup_substrings(no_docs).collect() == []


def test_long_texts_are_hashed_in_segments(monkeypatch):
    rng = random.Random(7)
    text = " ".join(str(rng.randint(0, 5)) for _ in range(500))
    whole = [(k.tolist(), a.tolist(), n.tolist()) for _, k, a, n, _ in substring_dedup.super_kmers([text], 10, 3)][0]
    monkeypatch.setattr(substring_dedup, "SEGMENT", 60)
    parts = list(substring_dedup.super_kmers([text], 10, 3))
    assert len(parts) > 1
    each = lambda keys, starts, sizes: {a + i: k for k, a, n in zip(keys, starts, sizes) for i in range(n)}
    joined = {}
    for _, keys, starts, sizes, _ in parts:
        joined |= each(keys.tolist(), starts.tolist(), sizes.tolist())
    assert joined == each(*whole) and len(joined) == 491


def test_windows_travel_only_where_half_of_them_is_shared(spark, docs):
    rng = random.Random(11)
    some = lambda n: [f"w{rng.randint(0, 10**9)}" for _ in range(n)]
    short, long, copy = some(12), some(70), " ".join(some(200))
    # Each text with the short passage alone shares some minimisers with the others, but no window.
    rows = [(i, " ".join(some(60) + short + some(60))) for i in range(8)] + [(20, " ".join(some(30) + long)), (21, " ".join(long + some(200)))] + [(i, copy) for i in range(30, 36)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = substring_dedup.shared_strings(frame).collect()
    assert {r.doc_id for r in found} == {20, 21, *range(30, 36)}
    assert {r.doc_id for r in found if r.doc_id >= 30 and r.packed is not None} == {30}  # a string leaves its task once
    assert max(len(r.packed.split()) for r in found if r.packed is not None and r.doc_id < 30) <= 70 + 23  # the windows that hold half of the passage
    got = substring_dedup.dedup_substrings(frame).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == kept_words(rows, 50)


def plain_fingerprint(text):
    words = GAP.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxh64(x.encode(), seed=42).intdigest() for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints(docs):
    rows = simhash.simhashes(docs.withColumn("fp", F.lit("clash"))).collect()
    assert Counter((r.doc_id, r.fp % (1 << 64)) for r in rows) == Counter((i, plain_fingerprint(t)) for i, t, *_ in TEXTS)
    assert simhash.fingerprint("Ärger ÄRGER") != simhash.fingerprint("ärger ärger")
    long = " ".join(str(i) for i in range(70_000))
    assert simhash.fingerprint(long) == plain_fingerprint(long)


@pytest.mark.parametrize("shard", [2_048, 3])
def test_links_connect_what_the_radius_connects(spark, docs, shard):
    rng = random.Random(9)
    values = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(400):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
        values.append(rng.choice(values) ^ flips)
    values = sorted(set(values))
    signed = [x - (1 << 64) if x >> 63 else x for x in values]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 3, shard)
    assert all((r.a ^ r.b) % (1 << 64) for r in edges.collect())
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    want = plain_components(values, 3)
    got = [roots.get(x, x) for x in signed]
    groups = lambda names: sorted(sorted(i for i, x in enumerate(names) if x == n) for n in set(names))
    assert groups(got) == groups(want)


def test_trees_are_bk_trees():
    rng = np.random.default_rng(3)
    values = np.unique(rng.integers(0, 1 << 12, 300, dtype=np.uint64))
    roots, children = simhash.grow(values, np.zeros(len(values), np.int64))
    seen = [int(roots[0])]
    for node in seen:
        for distance, child in enumerate(children[node]):
            if child >= 0:
                assert (int(values[node]) ^ int(values[child])).bit_count() == distance
                seen.append(int(child))
    assert sorted(seen) == list(range(len(values)))
    q, node = simhash.search(values, children, values, np.full(len(values), roots[0]), 2)
    want = {(i, j) for i, a in enumerate(values.tolist()) for j, b in enumerate(values.tolist()) if (a ^ b).bit_count() <= 2}
    assert set(zip(q.tolist(), node.tolist())) == want and len(q) == len(want)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (300, 200)], "a long, b long")
    assert {r.node: r.root for r in simhash.components(edges).collect()} == {i: 0 for i in range(1, 61)} | {200: 100, 300: 100}


def test_near_duplicates_of_odd_rows(spark, docs, no_docs):
    got = simhash.near_duplicates(docs).collect()
    prints = [plain_fingerprint(t) for _, t, *_ in TEXTS]
    part = plain_components(prints, 3)
    smallest = {p: min(TEXTS[i][0] for i, q in enumerate(part) if q == p) for p in part}
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((row[0], smallest[p]) for row, p in zip(TEXTS, part))
    assert simhash.near_duplicates(no_docs).collect() == []
    null = spark.createDataFrame([(None, "a b"), (4, "a b"), (None, "zz")], "doc_id long, text string")
    assert Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(null).collect()) == Counter([(None, 4), (4, 4), (None, None)])


def test_links_refuse_a_radius_the_keys_miss(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4)


def test_rows_that_repeat_an_id_and_its_text_count_once_in_the_places(spark):
    from daylog.llm.common import ship_code

    ship_code(spark)
    rng = random.Random(5)
    text = " ".join(rng.choice(["ab", "cd", "e", "the", "g,", "h"]) + str(rng.randint(0, 99)) for _ in range(300))
    rows = [(1, text)] + [(2, text)] * 400 + [(3, "short")] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    places = substring_dedup.repeated_windows(frame, 50).collect()
    assert [r.doc_id for r in places] == [2] and len(places[0].starts) == len(set(places[0].starts)) <= 300
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup.dedup_substrings(frame, 50).collect())
    assert got == kept_words(rows, 50)
