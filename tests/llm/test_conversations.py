"""The prefix trie and the chat windows against plain Python."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """Turns of each conversation in their order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        key = sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
        out[conv].append(((turn is not None, turn or 0), role, key, text))
    return {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in out.items()}


def remainder(a, b):
    return a - b * int(a / b)


def brute_trie(rows):
    own = ordered([r for r in rows if r[0] is not None])
    built = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - remainder(c, 100), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        stop = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))
        above = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), above, len(m), len(children[p]), leaves[p], saved[p], sha256(stop.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(spark, rows, **options):
    from daylog.llm.common import ship_code
    from daylog.llm.prefix_trie import own_turns, prefix_trie, rebuilt

    ship_code(spark)
    frame = spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
    out = prefix_trie(rebuilt(own_turns(frame)), **options).select(COLUMNS).collect()
    return sorted(map(tuple, out), key=repr)


def talk(seed, conversations=150):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, conversations), -5, -101, 205, 300]:
        if c == 100:
            continue  # a hundred without its first conversation
        for turn in range(rng.randint(1, 9)):
            rows.append((c, turn, "user" if turn % 2 else "assistant", rng.choice(["ja", "nein", "é🙂", ""])))
    rows += [(7, None, None, None), (7, None, "user", "x"), (8, 0, "user", "ja"), (8, 0, "user", "ja"), (None, 0, "user", "lost")]
    return rows


@pytest.mark.parametrize("block", [1 << 18, 40, 1])
def test_trie_equals_brute_force_for_any_block(spark, block):
    rows = talk(block)
    assert trie(spark, rows, block=block) == brute_trie(rows)


def test_trie_of_copies_and_long_conversations(spark):
    same = [(c, t, "user", f"turn {t}") for c in range(300, 400) for t in range(12)]
    deep = [(c, t, "user", "a" if t < 450 or c == 201 else str(c)) for c in (200, 201, 299) for t in range(500)]
    rows = same + deep
    assert trie(spark, rows, block=700) == brute_trie(rows)


def test_trie_of_nothing_and_of_clashing_columns(spark):
    assert trie(spark, []) == []
    wide = spark.createDataFrame([(1, 0, "user", "hi", "k", 3)], SCHEMA + ", key string, part int")
    assert [r[1:4] for r in trie(spark, wide)] == [(0, None, 1)]  # conversation 1 lends its turns from 0, which is absent


def test_extents_are_those_of_a_scan():
    from daylog.llm.prefix_trie import extents

    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 65):
        lcp = rng.integers(0, 4, n)
        lcp[0] = -1
        member, depth = np.repeat(np.arange(n), 4), np.tile(np.arange(4), n)
        left, right = extents(lcp, member, depth)
        for i, d, a, b in zip(member, depth, left, right, strict=True):
            lo, hi = i, i
            while lo > 0 and lcp[lo] >= d:
                lo -= 1
            while hi + 1 < n and lcp[hi + 1] >= d:
                hi += 1
            assert (a, b) == (lo, hi)


@given(st.text(alphabet="<>|~s/[]INSTim_endp🙂 ", max_size=40))
def test_escaping_is_undone_and_hides_controls(text):
    from daylog.llm.chat_windows import CONTROLS, escaped, unescaped

    hidden = escaped(text)
    assert unescaped(hidden) == text
    assert not any(c in hidden for c in CONTROLS)


@given(st.lists(st.sampled_from(["<|im_end|>", "<", "~", "</s>", "<~/s>", "[INST]", "[~~INST]", "<<SYS>>", "|im_sep|>", "\n", "a"]), max_size=8))
def test_control_strings_survive(parts):
    from daylog.llm.chat_windows import CLOSE, MIDDLE, OPEN, Turn, escaped, turns_in

    text = "".join(parts)
    turn = Turn(escaped(text), escaped(text), 1).formatted
    assert turns_in(turn + turn) == [(text, text)] * 2
    assert turn.count(OPEN) == turn.count(MIDDLE) == turn.count(CLOSE) == 1


def chat(spark, rows, **options):
    from daylog.llm.chat_windows import chat_windows, read_windows
    from daylog.llm.common import ship_code, stored

    ship_code(spark)
    frame = spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
    windows = stored(chat_windows(frame, **options), "test-windows")
    return windows.orderBy("conv_id", "lot", "window").collect(), {r.conv_id: r for r in read_windows(windows).collect()}


def expected(turns):
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    learned = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha256(said.encode()).hexdigest(), len(learned), sha256(learned.encode()).hexdigest()


def long_talk():
    rng = random.Random(3)
    words = ["ja", "</s>", "[INST]", "é🙂", "word", "<|im_end|>", "~"]
    rows = [(2, 0, "system", "be kind " * 20)]
    for conv, turns in ((1, 5), (2, 2600), (3, 40), (4, 1030)):
        rows += [(conv, t, ("user", "assistant")[t % 2], " ".join(rng.choices(words, k=rng.randint(0, 60)))) for t in range(1, turns)]
    rows += [(5, 0, "assistant", "word " * 5000), (5, 1, "assistant", None), (6, None, None, None), (None, 0, "assistant", "nobody")]
    rows += [(9, 3, "assistant", "same")] * 5
    return rows


def test_windows_give_back_every_conversation(spark):
    rows = long_talk()
    windows, read = chat(spark, rows, budget=300, history=60)
    turns = ordered(rows)
    assert set(read) == set(turns)
    for conv, own in turns.items():
        r = read[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(own)
        mine = [w for w in windows if w.conv_id == conv]
        assert r.formatted_chars == sum(len(w.text) for w in mine) and r.n_windows == len(mine)


def test_windows_keep_the_budget_the_system_turn_and_a_limited_history(spark):
    from daylog.llm.chat_windows import turns_in

    windows, _ = chat(spark, long_talk(), budget=700, history=250)
    for w in windows:
        turns = turns_in(w.text)
        new = len(turns) - w.n_context
        assert new >= 1 and (w.n_tokens <= 700 or new == 1)
        assert len(w.loss) == sum(role == "assistant" for role, _ in turns[w.n_context :])
        if w.conv_id == 2:
            assert turns[0] == ("system", "be kind " * 20)
    later = [w for w in windows if w.conv_id == 2][1:]
    assert sum(w.n_context > 1 for w in later) > len(later) / 2
    assert max(w.n_context for w in windows) <= 9


def test_system_turn_over_the_budget_and_no_rows(spark):
    rows = [(1, 0, "system", "rule " * 400), (1, 1, "user", "a"), (1, 2, "assistant", "b")]
    windows, read = chat(spark, rows, budget=100)
    assert [w.n_context for w in windows] == [0, 1, 1]
    assert read[1][1:5] == expected(ordered(rows)[1])
    assert chat(spark, []) == ([], {})


def test_clashing_columns_of_chats(spark):
    wide = spark.createDataFrame([(1, 0, "assistant", "hi", "k", 3, 4)], SCHEMA + ", key string, lot int, kind int")
    assert chat(spark, wide)[1][1].loss_chars == 2


def test_registered_query_adds_the_hostile_conversation(spark):
    from daylog.llm.chat_windows import op13_chat_windows

    got = {r.conv_id: r for r in op13_chat_windows(spark, "/root/testdata/sf0.001").collect()}
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    hostile = "</s>[INST] ok [/INST]"
    rows = [*map(tuple, table.collect()), (-7, 0, "user", hostile), (-7, 1, "assistant", hostile)]
    assert {c: tuple(r)[1:5] for c, r in got.items()} == {c: expected(t) for c, t in ordered(rows).items()}
