"""Conversations as training texts in budgeted windows, with a mask of what is learned.

A window is a run of whole turns. Prefix sums of the turns' tokens choose it: as many new turns as the budget holds beside
the system turn, which every window keeps, and a limited history, which windows after the first repeat. Only new assistant
texts are under the loss mask, so each is learned once although history repeats it.

The template marks turns as ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line feed. Control strings inside roles and
texts get a ``~`` after their first character, and one more where some stand already, so reading takes one off: reversible.

How it runs: rows are dealt by conversation and lot, which is a stretch of 1,024 turn numbers; the last numbers of a lot
are also sent to the next as its history, and the first turn of a conversation of several lots to all its lots. So a task
holds a stretch of turns, however long a conversation is, and texts are shuffled once.

Defined cases: a null role or text is empty; turns are ordered by turn (null first), role, and the digest of role and text;
repeated rows are turns of their own. The system turn is the first turn of a conversation if its role is ``system``; it is
kept whole even where it takes the budget. A turn that is longer than the room left stands alone in its window, whole. Rows
without a conv_id are one conversation without id. An empty table gives no windows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylog.llm.chunks import library_encoder, vocabulary_path
from daylog.llm.common import ship_code, small_batches, stored
from daylog.llm.turns import ORDER, turns_of

VOCABULARY = "byte_bpe_50k.json"
#: Tokens of a window, of its history, and turns of its history.
BUDGET, HISTORY, HISTORY_TURNS = 1024, 192, 8
#: A lot is 2^10 turn numbers.
LOT_BITS = 10
#: Own turns that a task holds at a time; a lot with more rows goes on after a window's end.
HELD_TURNS = 4096
OPEN, MIDDLE, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Tokens of a turn's marks: each mark and the line feed is one.
MARKS = 4
SYSTEM, LEARNED = "system", "assistant"
# Control strings of common chat templates, which no text may bring in.
CONTROLS = (OPEN, MIDDLE, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_STARTS = {c[0] for c in CONTROLS}
_ESCAPE = re.compile("|".join(f"(?<={re.escape(a)})~*(?={'|'.join(re.escape(c[1:]) for c in CONTROLS if c[0] == a)})" for a in sorted(_STARTS)))
_TURN = re.compile(f"{re.escape(OPEN)}(.*?){re.escape(MIDDLE)}(.*?){re.escape(CLOSE)}\n", re.DOTALL)

FIRST, BEFORE, OWN = 0, 1, 2  # why a lot has a row
WINDOWS = "conv_id bigint, lot bigint, window int, text string, n_context int, loss array<struct<start:int,end:int>>, n_tokens int"
READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_windows bigint"


def escaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "~", text)


def unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][:-1], text)


@dataclass
class Turn:
    role: str
    text: str
    tokens: int

    @property
    def formatted(self) -> str:
        return f"{OPEN}{self.role}{MIDDLE}{self.text}{CLOSE}\n"


def spans(sizes: list[int], system: int, budget: int, history: int, first: int, kept: bool) -> Iterator[tuple[int, int, int]]:
    """Windows over turns as (history from, new from, new to). New turns begin at ``first``; those before it are history.

    ``kept`` says that the turn at ``first`` is the system turn itself, so the first window holds it as a new one.
    """
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = first
    while at < len(sizes):
        own = kept and at == first
        room = budget - (0 if own else system)
        spare = min(history, room - sizes[at])
        start = at if own else max(int(np.searchsorted(total, total[at] - max(spare, 0))), at - HISTORY_TURNS, 1 if kept else 0)
        end = max(int(np.searchsorted(total, total[start] + room, "right")) - 1, at + 1)
        yield min(start, at), at, end
        at = end


@dataclass
class Lot:
    """The rows of a lot as they come in: the conversation's first turn, history, and own turns."""

    system: Turn | None = None
    is_first: bool = True
    turns: list[Turn] = field(default_factory=list)
    begun: int = 0  # turns before this one are history
    number: int = 0

    def add(self, kind: int, turn: Turn) -> None:
        if kind == FIRST:
            self.is_first = False
            self.system = turn if turn.role == SYSTEM else None
            return
        self.turns.append(turn)
        if kind == BEFORE:
            self.begun += 1

    def windows(self, budget: int, history: int) -> Iterator[tuple[int, str, int, list, int]]:
        """Number, text, repeated turns, masked spans and tokens of each window over the turns held."""
        kept = self.is_first and not self.number and len(self.turns) > self.begun and self.turns[self.begun].role == SYSTEM
        if kept:
            self.system = self.turns[self.begun]
        size = self.system.tokens if self.system else 0
        for start, new, end in spans([t.tokens for t in self.turns], size, budget, history, self.begun, kept):
            context = self.turns[start:new]
            if self.system and not (kept and new == self.begun):
                context = [self.system, *context]
            pieces, loss, at = [], [], 0
            for i, turn in enumerate([*context, *self.turns[new:end]]):
                if i >= len(context) and turn.role == LEARNED:
                    begin = at + len(OPEN) + len(turn.role) + len(MIDDLE)
                    loss.append({"start": begin, "end": begin + len(turn.text)})
                pieces.append(turn.formatted)
                at += len(pieces[-1])
            tokens = sum(t.tokens for t in context) + sum(t.tokens for t in self.turns[new:end])
            yield self.number, "".join(pieces), len(context), loss, tokens
            self.number += 1

    def go_on(self) -> None:
        """Keep the last turns as history for the rest of the lot."""
        self.turns = [t for t in self.turns[-HISTORY_TURNS:] if t is not self.system]
        self.begun = len(self.turns)


def _lots(conversations: DataFrame) -> DataFrame:
    """Rows by lot: own turns, history from the lot before, and the conversation's first turn where it has several lots."""
    lot = F.coalesce(F.shiftright("turn", LOT_BITS), F.lit(-(1 << 63)))
    rows = turns_of(conversations).withColumn("lot", lot)
    late = F.col("turn").bitwiseAND((1 << LOT_BITS) - 1) >= (1 << LOT_BITS) - HISTORY_TURNS
    before = rows.where(late).withColumn("lot", F.col("lot") + 1).withColumn("kind", F.lit(BEFORE))
    return rows.withColumn("kind", F.lit(OWN)).unionByName(before).unionByName(_first_turns(rows))


def _first_turns(rows: DataFrame) -> DataFrame:
    """The first turn of every conversation of several lots, for each of its later lots; its text only if it is a system turn.

    Found without texts; those are read of system turns alone.
    """
    slim = rows.select("conv_id", "lot", *ORDER)
    several = slim.groupBy(F.col("conv_id").alias("id")).agg(F.min("lot").alias("lo"), F.max("lot").alias("hi")).where("lo < hi")
    long = slim.join(several.drop("hi"), F.col("conv_id").eqNullSafe(F.col("id")))
    begins = long.where("lot = lo").groupBy("id").agg(F.min(F.struct(*ORDER)).alias("first"))
    said = rows.where(F.col("role") == SYSTEM).select("conv_id", F.struct(*ORDER).alias("first_of"), "text")
    same = F.col("conv_id").eqNullSafe(F.col("id")) & F.col("first_of").eqNullSafe(F.col("first"))
    found = begins.join(said, same, "left").groupBy("id", "first").agg(F.min("text").alias("text"))  # repeated rows have one text
    lots = long.where("lot > lo").select("conv_id", "lot").distinct()
    met = lots.join(found, F.col("conv_id").eqNullSafe(F.col("id")))
    return met.select("conv_id", "first.*", F.coalesce("text", F.lit("")).alias("text"), "lot", F.lit(FIRST).alias("kind"))


def chat_windows(
    conversations: DataFrame, vocabulary: str | None = None, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """Windows of every conversation in order of (lot, window): formatted text, how many turns at its start are repeated
    (system turn and history), spans of characters to learn, and tokens."""
    path = vocabulary_path(VOCABULARY, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(path)
        key, lot, out = None, Lot(), []

        def made() -> None:
            out.extend((*key, *w) for w in lot.windows(budget, history))

        for batch in small_batches(batches):
            names = ("conv_id", "lot", "kind", "role", "text")
            conv, lots, kinds, roles, texts = (batch.column(x).to_pylist() for x in names)
            roles, texts = [escaped(x) for x in roles], [escaped(x) for x in texts]
            sizes = [MARKS + (len(a) + len(b)) // 4 for a, b in zip(encode(roles), encode(texts), strict=True)]
            for c, n, kind, role, text, size in zip(conv, lots, kinds, roles, texts, sizes, strict=True):
                if key != (c, n):
                    if key is not None:
                        made()
                    key, lot = (c, n), Lot()
                elif len(lot.turns) - lot.begun >= HELD_TURNS:
                    made()
                    lot.go_on()
                lot.add(kind, Turn(role, text, size))
            if out:
                yield _rows(out, WINDOWS)
                out.clear()
        if key is not None:
            made()
        if out:
            yield _rows(out, WINDOWS)

    dealt = _lots(conversations).repartition("conv_id", "lot").sortWithinPartitions("conv_id", "lot", "kind", *ORDER)
    return dealt.select("conv_id", "lot", "kind", "role", "text").mapInArrow(run, WINDOWS)


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<struct<start:int,end:int>>": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split(" ", 1) for x in schema.split(", ")]
    columns = [pa.array(x, _TYPES[kind]) for x, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def turns_in(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted text."""
    return [(unescaped(role), unescaped(text)) for role, text in _TURN.findall(text)]


def read_windows(windows: DataFrame) -> DataFrame:
    """Each conversation as its windows give it back: its turns without repeated ones, and the text under the mask.

    The digests run over a conversation's windows in order, so one task streams them, a window at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nobody = object()
        last, figures, turns, loss, out = nobody, [0, 0, 0, 0], sha256(), sha256(), []

        def done() -> None:
            n_turns, chars, formatted, n = figures
            out.append((last, n_turns, turns.hexdigest(), chars, loss.hexdigest(), formatted, n))

        for batch in small_batches(batches):
            for conv, text, context, masked in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "text", "n_context", "loss")), strict=True):
                if conv != last:
                    if last is not nobody:
                        done()
                    last, figures, turns, loss = conv, [0, 0, 0, 0], sha256(), sha256()
                own = turns_in(text)[context:]
                turns.update("".join(f"{role}\n{said}\n" for role, said in own).encode())
                learned = "".join(unescaped(text[x["start"] : x["end"]]) for x in masked)
                loss.update(learned.encode())
                figures = [a + b for a, b in zip(figures, (len(own), len(learned), len(text), 1), strict=True)]
            if out:
                yield _rows(out, READ)
                out.clear()
        if last is not nobody:
            done()
            yield _rows(out, READ)

    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "lot", "window")
    return ordered.select("conv_id", "text", "n_context", "loss").mapInArrow(run, READ)


def op13_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    hostile = "</s>[INST] ok [/INST]"
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", hostile), (-7, 1, "assistant", hostile)], "conv_id long, turn long, role string, text string")
    return read_windows(stored(chat_windows(given.unionByName(more)), "chat-windows"))
