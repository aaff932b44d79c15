"""Neighbours and fingerprints against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from daylog.llm import ann, syncmers
from daylog.llm.common import ship_code
from tests.llm.conftest import SCHEMA, TEXTS

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5):
    out = {}
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for q, a in good:
        if q % 50 == 0:
            scores = sorted((-float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), i) for i, b in good if i != q and len(a) == len(b))
            out[q] = scores[:k]
    return out


@pytest.mark.parametrize("blocks", [(8_192, 2_048), (120, 3)])
def test_recall_and_order(spark, blocks):
    ship_code(spark)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 12] * (i % 3 > 0) + rng.normal(size=24)]) for i in range(700)]
    rows += [(i, rows[3][1]) for i in range(700, 760)]  # one very common vector, a query among them
    rows += [(900, None), (950, []), (1000, [0.0] * 24), (1050, [float("nan")] + [1.0] * 23), (1100, [None] + [1.0] * 23), (1150, [1.0, 2.0]), (1152, [2.0, 1.0]), (None, [1.0] * 24)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumn("score", F.lit("clash"))
    got = {}
    for r in ann.nearest_neighbours(frame, frame.where("vec_id % 50 = 0"), 5, *blocks).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows)
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, *_ in found] == list(range(1, len(want[q]) + 1))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        exact = {i: -s for s, i in brute_all(rows, q)}
        assert all(abs(exact[i] - s) < 1e-12 for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for _, i in want[q]})
    assert hits >= 0.97 * sum(map(len, want.values()))
    assert [i for _, i, _ in got[700]] == [3, 701, 702, 703, 704]
    assert [i for _, i, _ in got[1150]] == [1152]


def brute_all(rows, q):
    a = np.array(dict(rows)[q], float)
    return [(-float((a * np.array(v, float)).sum() / (np.sqrt((a * a).sum()) * np.sqrt((np.array(v, float) ** 2).sum()))), i) for i, v in rows if i is not None and i != q and v and len(v) == len(a) and all(x is not None and np.isfinite(x) for x in v) and any(v)]


def test_few_or_no_candidates(spark):
    ship_code(spark)
    frame = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [1.0, 1.0], 0), (1, [0.5, 1.0], 0), (0, [1.0, 0.0], 0)], VECTORS)
    rows = ann.nearest_neighbours(frame, frame.where("vec_id = 0")).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in rows] == [(0, 1, 1)] and abs(rows[0].score - 1 / np.sqrt(5)) < 1e-12
    empty = spark.createDataFrame([], VECTORS)
    assert ann.nearest_neighbours(empty, empty).collect() == []


def test_few_cosines_are_computed_exactly(monkeypatch):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(3_000, 64))
    vectors[::7] = vectors[0] * 3
    done, exact = [], ann.cosines
    monkeypatch.setattr(ann, "cosines", lambda v, *rest: done.append(len(v)) or exact(v, *rest))
    ids = np.arange(3_000) * 2
    got = ann.Block(ids, vectors).nearest(ids[1:2_000:50], vectors[1:2_000:50], 5)
    assert sum(done) <= 40 * 5 * 10 + 40 * 429  # copies are open together; before, nearly all of 40 x 3,000 were computed
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    hits = 0
    for n, at in enumerate(range(1, 2_000, 50)):
        near = unit @ unit[at]
        near[at] = -2
        hits += len({i for q, i, _ in got if q == 2 * at} & set((2 * np.lexsort((ids, -near.round(12)))[:5]).tolist()))
    assert hits >= 0.97 * 200


def anchors_of(text):
    """Closed syncmers by hand; hashes by position only, so equality of runs is what is compared."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return words


def jaccard(a, b):
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [anchors_of(t)] for i in range(max(1, len(w) - 4))}
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def test_fingerprints_of_edited_and_next_texts(spark):
    ship_code(spark)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(60, 900))) for _ in range(70)]
    texts[10] = texts[9]
    rows = [(i * 3, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    got = syncmers.op7_rows(spark.createDataFrame(rows, SCHEMA).withColumn("stretch", F.lit("clash"))).collect()
    by_id = {r.doc_id: r for r in got}
    order = sorted(rows, reverse=True)
    errors = []
    for (i, text, *_), (_, following, *_) in zip(order, [*order[1:], order[0]]):
        n = len(text)
        edited = text[: n - n // 3] + following[: n // 3]
        r = by_id[i]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, following)]
    assert np.abs(errors).mean() < 0.06 and abs(np.mean(errors)) < 0.02
    assert by_id[30].near_next == 1.0 and by_id[30].fingerprint == by_id[27].fingerprint


def test_anchors_do_not_depend_on_context(spark):
    ship_code(spark)
    rng = random.Random(9)
    passage = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 99)) for _ in range(60)]
    rows = [(0, " ".join(passage)), (1, "x y z " + "\n".join(passage) + " tail of it")]
    found = [{(p - 3 * i, a) for p, a in r.anchors} for i, r in enumerate(syncmers.with_anchors(spark.createDataFrame(rows, "id int, text string"), "text", "anchors").orderBy("id").collect())]
    assert found[0] <= found[1] and len(found[0]) > 15
    places = sorted(p for p, _ in found[0])
    assert max(np.diff(places)) <= 4  # a run is chosen among any few neighbours


def test_odd_texts_have_fingerprints(spark, docs, no_docs):
    rows = syncmers.op7_rows(docs).collect()
    assert len(rows) == len(TEXTS) and all(r.fingerprint and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    same = {r.fingerprint for r in rows if r.doc_id in (5, 16)}
    assert len(same) == 1 and len({r.fingerprint for r in rows if r.doc_id in (3, 9)}) == 1
    # In descending order 3 (empty) is followed by 1, and 1, the last, by 16.
    last = next(r for r in rows if r.doc_id == 1)
    text, following = TEXTS[3][1], TEXTS[8][1]
    n = len(text)
    assert last.edited_sha256 == hashlib.sha256((text[: n - n // 3] + following[: n // 3]).encode()).hexdigest()
    assert syncmers.op7_rows(no_docs).collect() == []
    null = spark.createDataFrame([(None, "a b c"), (2, "d e f g")], "doc_id long, text string")
    assert {r.doc_id: r.edited_sha256 for r in syncmers.op7_rows(null).collect()} == {2: hashlib.sha256(b"d e fa ").hexdigest(), None: hashlib.sha256(b"a b d").hexdigest()}


def test_long_texts_that_share_a_passage_are_alike_by_it(spark):
    ship_code(spark)
    rng = random.Random(12)
    some = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    passage = some(25)
    rows = [(2, " ".join(some(2000) + passage + some(1500))), (1, " ".join(some(700) + passage + some(2500)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    anchors = {r.doc_id: [tuple(a) for a in r.anchors] for r in syncmers.with_anchors(frame, "text", "anchors").collect()}
    both = {a for _, a in anchors[1]} & {a for _, a in anchors[2]}
    got = {r.doc_id: r for r in syncmers.op7_rows(frame).collect()}
    assert len(both) > 5 and got[2].near_next == got[1].near_next == len(both) / (len(anchors[1]) + len(anchors[2]) - len(both))
    for i, found in anchors.items():
        assert got[i].fingerprint == "".join(f"{p:08x}{a:012x}" for p, a in found)


def test_repeated_passages_are_paired_one_to_one(spark):
    rows = [([(0, 5), (3, 9), (7, 5), (9, 5)], [(0, 5), (4, 8), (5, 5)])]
    frame = spark.createDataFrame(rows, "a array<struct<position int, anchor long>>, b array<struct<position int, anchor long>>")
    assert frame.select(syncmers.likeness("a", "b"), syncmers.likeness("b", "a"), syncmers.likeness("a", "a")).first()[:] == (2 / 5, 2 / 5, 1.0)
