"""Classifiers by held-out accuracy and known models; language model against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daylog.llm import bit_stream, folds, lm_mixing, quality, tables, toxicity
from tests.llm.conftest import SCHEMA, TEXTS

WORDS = "the river ran over stones while morning light fell across quiet fields and people walked home slowly".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def corpus(seed=1, n=360):
    """Good prose, shouting and symbols; some texts insult, some quote or deny insults."""
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        text, good, toxic = prose(rng, rng.randint(30, 300)), 1, 0
        kind = rng.random()
        if kind < 0.15:
            text, good = " ".join(w.upper() + "!!" for w in text.split()), 0
        elif kind < 0.3:
            text, good = " ".join(w + rng.choice(["***", "&&&", "###"]) for w in text.split()), 0
        elif kind < 0.5:
            text, toxic = f"{text} You are a {rng.choice(['moron', 'idiot', 'blorgish', 'blorgend'])}. {prose(rng, 20)}", 1
        elif kind < 0.6:
            text += " She said moron was a word. He was not an idiot."
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        marks.append((i, good, toxic))
    return rows, marks


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.fixture(scope="module")
def labelled(spark):
    from daylog.llm.common import ship_code

    ship_code(spark)
    rows, marks = corpus()
    return spark.createDataFrame(rows, SCHEMA).cache(), spark.createDataFrame(marks, "doc_id long, quality int, toxic int").cache(), marks


def test_quality_of_held_out_documents(labelled):
    docs, table, marks = labelled
    model = quality.fit(docs, folds.training_rows(table.select("doc_id", F.col("quality").alias("label"))))
    got = {r.doc_id: r.score for r in quality.score(docs.withColumn("score", F.lit("clash")), model).collect()}
    held = [(got[i] >= 0.5) == (good == 1) for i, good, _ in marks if crc(i) % 3 == 1]
    assert len(held) > 80 and np.mean(held) > 0.97
    kept = quality.good_documents(docs, folds.training_rows(table.select("doc_id", F.col("quality").alias("label"))))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s >= 0.5}


def test_attention_gradients():
    rng = np.random.default_rng(0)
    n, h, bag = 5, quality.HIDDEN, np.array([0, 0, 1, 1, 1])
    x, y = rng.normal(size=(5, n)), np.array([1.0, 0.0])
    w = {"E": rng.normal(size=(n, h)), "e0": rng.normal(size=h), "V": rng.normal(size=(h, h)), "v0": rng.normal(size=h), "U": rng.normal(size=(h, h)), "u0": rng.normal(size=h), "w": rng.normal(size=h), "c": rng.normal(size=h), "b": np.zeros(1)}

    def loss():
        p = folds.sigmoid(quality._forward(w, x, bag, 2)["y"])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grads = quality._gradients(w, x, bag, y)
    for name, value in w.items():
        at = tuple(rng.integers(0, s) for s in value.shape)
        old = value[at]
        value[at] = old + 1e-6
        up = loss()
        value[at] = old - 1e-6
        down = loss()
        value[at] = old
        assert abs((up - down) / 2e-6 - grads[name][at]) < 1e-6, name


def test_passages_cover_whole_texts():
    text = prose(random.Random(2), 1234)
    x, owner = quality.passages([text, "", "one"])
    assert Counter(owner.tolist()) == {0: 13, 1: 1, 2: 1}
    assert (x[owner == 1] == 0).all() and (x[owner == 2] != 0).any()


def test_quality_without_labels_and_odd_texts(spark, docs, no_docs, labelled):
    none = spark.createDataFrame([], "doc_id long, label int")
    model = quality.fit(docs, none)
    assert {r.score for r in quality.score(docs, model).collect()} == {0.5}
    real = quality.fit(labelled[0], folds.training_rows(labelled[1].select("doc_id", F.col("quality").alias("label"))))
    rows = quality.score(docs, real).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(no_docs, real).collect() == []


def test_folds(spark):
    rows = spark.createDataFrame([(i, 1) for i in range(300)] + [(None, 1), (5, None), (6, 7)], "doc_id long, label int")
    got = Counter(r.doc_id for r in folds.training_rows(rows).collect())
    assert got == Counter([i for i in range(300) if crc(i) % 3 != 1] + [None])


def test_toxicity_of_held_out_documents(labelled):
    docs, table, marks = labelled
    marked = folds.training_rows(table.select("doc_id", F.col("toxic").alias("label")))
    model = toxicity.fit(docs, marked)
    got = {r.doc_id: r.score for r in toxicity.score(docs.withColumn("score", F.lit("clash")), model).collect()}
    held = [((got[i] >= 0.7), toxic == 1) for i, _, toxic in marks if crc(i) % 3 == 1]
    assert np.mean([a for a, b in held if b]) > 0.9
    assert not any(a for a, b in held if not b)
    kept = toxicity.harmless_documents(docs, marked)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.7}


def patterns(text, lexicon=("idiot", "moron")):
    x = toxicity.Model({w: 1.0 for w in lexicon}, toxicity.PRIOR).measures(text)
    return {k for k, v in zip(toxicity.KINDS, x) if v}


def test_grammar_reads_clauses():
    assert patterns("what an idiot") == {"insult"}
    assert patterns("You are an Idiot!") == {"insult+target"}
    assert patterns("you are not an idiot") == {"insult-not"}
    assert patterns("He said the idiot left, a moron. idiot") == {"insult-said", "insult"}
    assert patterns("I will kill you. They kill them") == {"threat", "threat+target"}
    assert patterns("not here, idiot") == {"insult"}
    assert patterns("idiotic river") == set() and patterns("") == set()
    assert patterns("idiot### x") == {"insult"}


def test_composition_equals_stages_in_turn():
    rng = random.Random(6)
    machine = toxicity.grammar()
    stages = (toxicity._negation, toxicity._reported, toxicity._target, toxicity._read_out)
    for _ in range(200):
        symbols = [rng.randrange(8) for _ in range(30)]
        tape = symbols
        for step in stages:
            state, out = 0, []
            for x in tape:
                state, y = step(state, x)
                out.append(y)
            tape = out
        state, got = machine.start, []
        for x in symbols:
            state, y = machine.move(state, x)
            got.append(y)
        assert got == tape


def test_toxicity_of_odd_texts(spark, docs, no_docs):
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, label int"))
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score < 0.7 for r in rows)
    assert toxicity.score(no_docs, model).collect() == []


def brute_base(rows):
    tokens = [(t or "").encode().lower().split() for _, t, *_ in rows]
    learned = [i is None or crc(i) % 10 != 0 for i, *_ in rows]
    counts = Counter(w for ws, ok in zip(tokens, learned) if ok for w in ws)
    ends = sum(learned)
    total, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)
    log = lambda c: np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
    return [(i, not ok, len(ws) + 1, sum(counts[w] > 0 for w in ws) + (ends > 0), total, round(sum(log(counts[w]) for w in ws) + log(ends), 6)) for (i, *_), ws, ok in zip(rows, tokens, learned)]


@pytest.mark.parametrize("frequent", [200_000, 5])
def test_base_scores_equal_brute_force(spark, docs, frequent):
    rows = [*corpus(3, 120)[0], *TEXTS, (None, "a null id", None, None, None)]
    got = lm_mixing.score_texts(spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash")), frequent).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == Counter(brute_base(rows))
    held = [r for r in got if r.held_out]
    assert held and all(r.score < 0 for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_frequent_and_joined_words_score_alike(spark, docs):
    frame = spark.createDataFrame(corpus(4, 60)[0], SCHEMA)
    one = {r.doc_id: r.score for r in lm_mixing.score_texts(frame).collect()}
    two = {r.doc_id: r.score for r in lm_mixing.score_texts(frame, 3).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-6 for k in one)


def test_word_probabilities_sum_to_less_than_one():
    counts = np.zeros((2, int(lm_mixing.BASES[-1])), np.float32)
    weights, refine = np.full((len(lm_mixing.SLOTS) + 1, lm_mixing.GATES), 0.3), np.zeros((2, lm_mixing.GATES, lm_mixing.BUCKETS))
    for words in ([b"ab", b"abc", b"b"], [b"cab", b"a"]):
        s = lm_mixing.spelling(words)
        for slots in s["slots"]:
            for value in (0, 1):
                np.add.at(counts[value], slots[s["bit"] == value], 1)
        lm_mixing.mix_online(words, counts, weights, refine)
    # All words of one byte, and the empty word: their spellings are disjoint.
    one = 10 ** lm_mixing.word_log10([bytes([b]) for b in range(256) if b not in (9, 10, 11, 12, 13, 32)], counts, weights, refine)
    assert 0 < one.sum() < 1


def test_urn_terms_equal_the_product():
    n, p = np.array([1, 2, 7, 400]), np.array([0.3, 1e-9, 0.02, 0.1])
    want = [sum(np.log(j + 50 * q) for j in range(k)) for k, q in zip(n, p)]
    assert np.allclose(lm_mixing.urn_terms(n, p, 50.0), want, rtol=1e-9)


def test_language_model_of_nothing(no_docs):
    assert lm_mixing.score_texts(no_docs).collect() == []


def test_scores_depend_on_the_order_of_words(spark):
    rng = random.Random(11)
    phrase = [f"{rng.choice(WORDS)}{i}" for i in range(40)]
    order = lambda i: " ".join(phrase[(i + k) % 40] for k in range(30))
    held = [i for i in range(400) if crc(i) % 10 == 0][:2]
    rows = [(i, order(i), None, None, None) for i in range(300) if i not in held]
    words = order(7).split()
    rows += [(held[0], " ".join(words), None, None, None), (held[1], " ".join(rng.sample(words, len(words))), None, None, None)]
    score = {r.doc_id: r.score for r in lm_mixing.score_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert score[held[0]] > score[held[1]] + 10


def test_weights_of_a_stream_adapt_within_it_and_bits_are_probabilities():
    tables = [np.zeros(1 << bit_stream.LEAST_BITS, np.uint16)] * bit_stream.TABLES
    start = bit_stream.start_weights()
    logs, ends = bit_stream.mix([b"again and " * 200 + b"\n", b"\n"], tables, start)
    assert -logs[0] / np.log10(2) < 0.7 * 2001 and not np.allclose(ends[:, 0], start)
    # All streams of one byte are disjoint.
    every = bit_stream.mix([bytes([b]) for b in range(256)], tables, start)[0]
    assert abs((10.0**every).sum() - 1) < 1e-4
    # Streams do not depend on those beside them.
    alone = bit_stream.mix([b"again and " * 200 + b"\n"], tables, start)[0]
    assert abs(alone[0] - logs[0]) < 1e-3


def test_starting_weights_are_learned_on_every_document(spark):
    tables = spark.sparkContext.broadcast([np.zeros(1 << bit_stream.LEAST_BITS, np.uint16)] * bit_stream.TABLES)
    for i in range(12):
        one = spark.createDataFrame([(i, "again and again " * 20)], "doc_id long, text string")
        assert not np.allclose(bit_stream.learn_weights(one, lm_mixing.words_in, tables), bit_stream.start_weights())


def test_samples_keep_texts_that_begin_alike_and_count_copies_once(spark):
    header = "The same licence. " * 20
    texts = [header + f"ending {i}" for i in range(4)] + [header + "a copy"] * 30 + [None, ""]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)] + [(0, texts[0], None, None, None)], SCHEMA)
    marked = spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id long, label int")
    want = [(i, texts[i] or "", i % 2) for i in (0, 1, 2, 3, 4, 34)]
    # As many rows as there are different texts: copies use up none of them.
    assert sorted(tuple(r) for r in folds.sample_of(docs, marked, 6).collect()) == want
    assert folds.sample_of(docs, marked, 3).count() == 3


def test_tables_grow_with_the_vocabulary(spark):
    rng = random.Random(13)
    words = sorted({bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(330_000)})
    sizes = lm_mixing.sizes_of(len(words))
    assert lm_mixing.sizes_of(1000) == lm_mixing.SLOTS and min(sizes[2:]) >= 2 * len(words)
    assert lm_mixing.sizes_of(10**7)[-1] >= 2 * 10**7 and bit_stream.slot_bits(10**7) == 25
    own = words[::30]
    s = lm_mixing.spelling(own, sizes)
    assert all(a <= x.min() and x.max() < a + n for x, a, n in zip(s["slots"], np.cumsum((0, *sizes)), sizes))
    assert len(np.unique(s["slots"][-1])) > len(np.unique(lm_mixing.spelling(own)["slots"][-1]))
    frame = spark.createDataFrame([(bytearray(w),) for w in own[:50]], "word binary")
    assert lm_mixing.table_counts(frame, sizes).sum() == 5 * 8 * sum(len(w) + 1 for w in own[:50])


def test_every_run_of_letters_reaches_the_grammar():
    model = toxicity.Model({"idiot": 2.0}, toxicity.PRIOR)
    plain = model.measures("stop, idiot")
    assert plain.any()
    for text in ("stop,idiot", "you/idiot", "well...idiot", "x-idiot-y", "...idiot"):
        assert model.measures(text).max() >= 2.0, text
    assert np.array_equal(model.measures("stop,idiot"), plain)
    assert np.array_equal(model.measures("well.You idiot"), model.measures("well. You idiot"))
    assert {"idiot", "you"} <= toxicity._marks("well...idiot you/IDIOT")


def test_long_documents_teach_by_all_their_passages(spark, monkeypatch):
    long = " ".join(WORDS[i % len(WORDS)] for i in range(100 * 130))
    docs = spark.createDataFrame([(0, long, None, None, None), (2, "short", None, None, None), (3, None, None, None, None)], SCHEMA)
    marked = spark.createDataFrame([(0, 1), (2, 0), (3, 0)], "doc_id long, label int")
    met = []
    monkeypatch.setattr(quality, "train", lambda bags, y: met.extend(bags))
    quality.fit(docs, marked)
    assert [len(x) for x in met] == [130, 1, 1]
    assert np.allclose(met[0], quality.passages([long])[0], atol=1e-5)


def test_counts_travel_in_a_byte_and_from_few_tasks(spark):
    counts = np.array([[0, 1, 254, 255], [256, 1e6, 3, 0]], np.float32)
    small, large, values = lm_mixing.small_counts(counts)
    assert small.dtype == np.uint8 and len(large) == 3
    back = lm_mixing.whole_counts(small, large, values)
    assert back.dtype == np.float32 and (back == counts).all()
    rows = spark.range(64).repartition(16)
    assert bit_stream.in_few_tasks(rows, 64).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert bit_stream.in_few_tasks(rows, 2).rdd.getNumPartitions() == 2


def test_halves_of_bytes_are_counted_once_and_large_counts_reach_the_driver_whole(spark):
    bits = bit_stream.LEAST_BITS
    docs = spark.createDataFrame([(f"{w} and {w} again" * 5,) for w in WORDS] + [(None,), ("",)], "text string").repartition(3)
    tables = bit_stream.tables_of(docs, lm_mixing.words_in, bits)
    streams = [bit_stream.stream_of(lm_mixing.words_in(r.text or "")) for r in docs.collect()]
    laid = bit_stream.Layout(streams)
    for k, table in enumerate(tables):
        own = bits + bit_stream.MORE_BITS[k]
        slots = np.concatenate(bit_stream.slots_of(laid.contexts()[k][laid.real], laid.buffer[laid.real].astype(np.uint32), k, own))
        want = np.bincount(slots, minlength=1 << own)
        assert want.sum() == 2 * sum(map(len, streams)) and (table == bit_stream.coded(want)).all()
    # Passes over some of the tables each give the same.
    assert all((a == b).all() for a, b in zip(tables[::2][:2] + tables[5:], [t for k in (0, 2, 5) for t in bit_stream._some_tables(docs, lm_mixing.words_in, {k: bits + bit_stream.MORE_BITS[k]})]))
    words = spark.createDataFrame([(bytearray(b"a" * n + b"b"),) for n in range(1, 60)], "word binary")
    small, large, values = lm_mixing.small_table_counts(words, lm_mixing.SLOTS)
    counts = lm_mixing.table_counts(words, lm_mixing.SLOTS)
    assert small.dtype == np.uint8 and len(large) and (counts.reshape(-1)[large] == values).all() and values.min() >= 255
    spelled = lm_mixing.spelling([bytes(r.word) for r in words.collect()])
    want = np.zeros_like(counts)
    for slots in spelled["slots"]:
        np.add.at(want, (spelled["bit"], slots), 1)
    assert (counts == want).all()


def test_packed_inputs_are_those_of_counted_bits():
    rng = np.random.default_rng(5)
    table = np.minimum(rng.poisson(3, 1 << 8), 31).astype(np.uint8)
    for without in (False, True):
        made = bit_stream.packed(table, without).view(np.int8).reshape(-1, 16, 4)
        for line, counts in zip(made, table.reshape(-1, 16).astype(int)):
            for value in range(16):
                for level in range(4):
                    width = 8 >> level
                    begin = value // (2 * width) * 2 * width
                    zeros, ones = counts[begin : begin + width].sum(), counts[begin + width : begin + 2 * width].sum()
                    one = value >> (3 - level) & 1
                    ones, zeros = max(ones - (without and one), 0), max(zeros - (without and not one), 0)
                    want = np.log(ones + bit_stream.PRIOR_COUNT) - np.log(zeros + bit_stream.PRIOR_COUNT)
                    assert abs(line[value, level] / bit_stream.SCALE - np.clip(want, -9, 9)) < 0.6 / bit_stream.SCALE


def test_texts_of_like_lengths_move_in_step_and_scores_keep_their_rows():
    tables = [bit_stream.packed(np.zeros(1 << bit_stream.LEAST_BITS, np.uint8), False)] * bit_stream.TABLES
    streams = [b"word " * n + b"\n" for n in (40, 1, 700, 0, 3, 40)]
    start = bit_stream.start_weights()
    got = bit_stream.stream_log10(streams, tables, start)
    want = [bit_stream.mix_packed([s], tables, start)[0][0] for s in streams]
    assert np.allclose(got, want, atol=1e-3) and got[0] == pytest.approx(got[5])


def test_counts_in_a_byte_keep_what_runs_over(monkeypatch):
    rng = np.random.default_rng(6)
    tally, want = tables.Tally(1000), np.zeros(1000, np.int64)
    monkeypatch.setattr(tables.Tally, "KEPT", 3)
    for n in (0, 5, 70_000, 1, 300_000):
        at = (rng.random(n) ** 3 * 1000).astype(np.uint32)
        want += np.bincount(at, minlength=1000)
        tally.add(at)
    assert tally.bytes.nbytes == 1000 and want.max() > 30_000
    halves = [tables.summed([tally.part(a, a + 500), tally.part(a, a + 500)]) for a in (0, 500)]
    assert (np.concatenate(halves) == 2 * want).all()


def test_tasks_map_tables_instead_of_loading_them(spark):
    out = tables.Mapped((50_000, 8), np.uint32)
    out.array[:] = np.arange(400_000).reshape(50_000, 8)
    shared = tables.MappedTables([out.shared(spark.sparkContext)])

    def read(rows):
        (table,) = shared.value
        base = table
        while isinstance(base, np.ndarray):
            base, last = base.base, base
        yield int(table.sum()), table.shape, type(base).__name__, bool(table.flags.aligned), bool(table.flags.writeable)

    got = spark.sparkContext.parallelize(range(4), 4).mapPartitions(read).collect()
    assert got == [(400_000 * 399_999 // 2, (50_000, 8), "mmap", True, False)] * 4
    shared.destroy()


def test_passes_hold_no_more_slots_than_allowed_and_inputs_are_shared_whole(spark, monkeypatch):
    bits = bit_stream.LEAST_BITS
    docs = spark.createDataFrame([(f"{w} and {w} again " * 60,) for w in WORDS], "text string").repartition(3)
    digits = bit_stream.digits_of(bits)
    whole = bit_stream.tables_of(docs, lm_mixing.words_in, bits)
    passes, counted = [], bit_stream._pass
    monkeypatch.setattr(bit_stream, "_pass", lambda d, w, digits, pieces: passes.append(pieces) or counted(d, w, digits, pieces))
    monkeypatch.setattr(bit_stream, "HELD_SLOTS", 100_000)  # less than the larger tables
    shared = bit_stream.shared_tables(docs, lm_mixing.words_in, bits).value
    assert max(sum((1 << digits[k]) // bit_stream.PIECES for k, _ in p) for p in passes) <= 100_000
    assert sorted(x for p in passes for x in p) == [(k, piece) for k in digits for piece in range(bit_stream.PIECES)]
    assert all((got.ravel() == table).all() for got, table in zip(shared, whole, strict=True))
    # The inputs of a block's lines are those of the whole tables.
    streams, start = [b"and words again\n", b"\n", b"stones " * 90 + b"\n"], bit_stream.start_weights()
    for without in (False, True):
        every = [bit_stream.packed(t, without) for t in whole]
        got, want = bit_stream.mix(streams, shared, start, without), bit_stream.mix_packed(streams, every, start)
        assert all((a == b).all() for a, b in zip(got, want, strict=True))


def test_words_are_counted_in_passes_and_looked_up_in_shared_counts(spark, monkeypatch):
    words = spark.createDataFrame([(bytearray(b"a" * (n % 60 + 1) + b"%d" % n),) for n in range(3000)], "word binary").repartition(2)
    counts = lm_mixing.table_counts(words, lm_mixing.SLOTS)
    monkeypatch.setattr(lm_mixing, "HELD_COUNTS", 1 << 20)
    small = lm_mixing.small_table_counts(words, lm_mixing.SLOTS)
    assert (lm_mixing.whole_counts(*small) == counts).all()
    monkeypatch.setattr(lm_mixing, "MOST", 300)
    shared = lm_mixing.SharedCounts(spark.sparkContext, *small).value
    slots = lm_mixing.spelling([bytes(r.word) for r in words.collect()])["slots"]
    assert counts.max() > 300 and all((shared[kind][slots] == counts[kind][slots]).all() for kind in (0, 1))
