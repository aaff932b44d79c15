"""Toxicity by a weighted finite-state pattern grammar (operator 3).

Words become classes: insult, threat, target (the one spoken of), negation, reported speech. Four small transducers rewrite
the classes of a clause: negation turns "not an idiot" aside, reported speech marks what others are said to have said, target
binds an insult or threat to a person, and the last reads out the matched patterns. They are composed into one machine
whose transitions are made when first needed. A document's score is a logistic function of the weights of its matched
clauses, by kind of pattern; words outside matched clauses do not count.

Learned from labels: the lexicon (words and word stems that mark toxic documents, with log-odds as weights) and the weight of
each kind of pattern, on a sample of at most ``SAMPLE`` labelled documents. The lists below are the lexicon's start and
the closed classes.

Defined cases: a null or empty text matches nothing and gets the score of no match. Without labels of both kinds the
pattern weights are ``PRIOR``. Rows with a null id are scored and not held out. Repeated rows get equal scores. Other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylog.llm.common import documents, small_batches, stored, texts_of
from daylog.llm.folds import held_out, labels, logistic_fit, rows_where, sample_of, sigmoid

SAMPLE = 12_000
#: Entries of the learned lexicon; an entry needs so many toxic documents, and this share of all that have it.
LEXICON, LEAST_TOXIC, LEAST_SHARE = 4_000, 4, 0.75
STEMS = (4, 5, 6, 7)
ALARM = 0.7
#: Words whose class a worker remembers; bounds memory, not results.
KEPT = 400_000
START_WEIGHT = 3.0

INSULTS = (
    "idiot idiots moron morons imbecile stupid dumb loser losers scum trash garbage worthless pathetic disgusting clown "
    "clowns vermin filth freak bastard coward crétin connard imbécile abruti ordure salaud dummkopf trottel abschaum "
    "arschloch schwachkopf estúpido imbécil basura cretino escoria payaso"
).split()
THREATS = "kill hurt destroy murder beat stab shoot hang burn strangle tuer frapper détruire töten umbringen schlagen matar golpear destruir".split()
TARGETS = "you your yours they them their he him she her these those people tu toi vous ils elles eux du dich ihr sie euch tú vosotros ellos ellas usted ustedes".split()
NEGATIONS = "not no never nobody isn't aren't wasn't don't ne pas jamais nicht kein keine nie jamás nunca".split()
REPORTS = "said says say called quoted wrote claimed alleged reported according dit disait écrit selon sagte sagt schrieb laut dijo dice escribió según".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END, STOP = range(8)
KINDS = ("insult", "insult+target", "insult-not", "insult-said", "threat", "threat+target", "threat-not", "threat-said")
#: Weights of the kinds' sums and maxima, and the intercept, where no labels are given.
PRIOR = np.array([0.8, 1.2, 0.1, 0.1, 0.1, 1.0, 0.0, 0.1] + [0.3, 0.4, 0.0, 0.0, 0.0, 0.4, 0.0, 0.0] + [-3.0])
LETTERS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
ENDS = (",", ";", ":", "(", ")", "|", "-", "–")
STOPS = (".", "!", "?")


# --- the grammar -----------------------------------------------------------------------------------------------------


@dataclass
class Transducer:
    """``step(state, symbol)`` gives the next state and the symbol written; transitions are remembered."""

    start: object
    step: object
    known: dict = field(default_factory=dict)

    def move(self, state, symbol):
        got = self.known.get((state, symbol))
        if got is None:
            got = self.known[state, symbol] = self.step(state, symbol)
        return got

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one writes the other reads."""

        def step(state, symbol):
            mine, written = self.move(state[0], symbol)
            its, out = other.move(state[1], written)
            return (mine, its), out

        return Transducer((self.start, other.start), step)


def _base(symbol) -> int:
    return symbol[0] if isinstance(symbol, tuple) else symbol


def _negation(state: int, symbol):
    """A negation turns aside an insult or threat within the next four words of its clause."""
    base = _base(symbol)
    if base == NEGATION:
        return 4, symbol
    if base in (END, STOP):
        return 0, symbol
    if base in (INSULT, THREAT) and state:
        return state - 1, (base, "not")
    return max(0, state - 1), symbol


def _reported(state: int, symbol):
    """After a word of reporting, insults and threats up to the end of the sentence are another's."""
    base = _base(symbol)
    if base == REPORT:
        return 1, symbol
    if base == STOP:
        return 0, symbol
    return state, (base, "said") if state and base in (INSULT, THREAT) and not isinstance(symbol, tuple) else symbol


def _target(state: int, symbol):
    """A target earlier in the clause binds an insult or threat."""
    base = _base(symbol)
    if base == TARGET:
        return 1, symbol
    if base in (END, STOP):
        return 0, symbol
    return state, (base, "+target") if state and base in (INSULT, THREAT) and not isinstance(symbol, tuple) else symbol


def _read_out(state: int, symbol):
    """The number of the matched pattern, or None."""
    base = _base(symbol)
    if base not in (INSULT, THREAT):
        return 0, None
    mark = symbol[1] if isinstance(symbol, tuple) else ""
    first = 0 if base == INSULT else 4
    return 0, first + ("", "+target", "not", "said").index(mark)


def grammar() -> Transducer:
    return Transducer(0, _negation).then(Transducer(0, _reported)).then(Transducer(0, _target)).then(Transducer(0, _read_out))


# --- words and documents ---------------------------------------------------------------------------------------------


def spelled(letters: str) -> str:
    return letters.lower().replace("’", "'")


def edge_of(marks: str) -> int:
    """The boundary that marks make: STOP, END or 0."""
    return STOP if any(m in STOPS for m in marks) else END if any(m in ENDS for m in marks) else 0


CLOSED = {w: c for c, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in words}


@dataclass
class Model:
    """The lexicon (word or stem* -> weight) and the weights of the kinds of patterns."""

    lexicon: dict[str, float]
    weights: np.ndarray
    _classes: dict = field(default_factory=dict, repr=False)
    _machine: Transducer | None = field(default=None, repr=False)

    def classify(self, token: str) -> list[tuple[int, float, int]]:
        """Class and weight of every run of letters of a token, and the boundary after each: 0, END or STOP.

        Marks before the first run, and a token without letters, are an other word with their boundary.
        """
        runs = list(LETTERS.finditer(token))
        last = edge_of(token[-1:])
        if not runs:
            return [(OTHER, 0.0, last)]
        edges = [*(edge_of(token[a.end() : b.start()]) for a, b in zip(runs, runs[1:])), last]
        before = edge_of(token[: runs[0].start()])
        return [(OTHER, 0.0, before)] * (before != 0) + [(*self.rate(spelled(run[0])), edge) for run, edge in zip(runs, edges, strict=True)]

    def rate(self, plain: str) -> tuple[int, float]:
        """Class and weight of a word."""
        weight = self.lexicon.get(plain, 0.0)
        for n in STEMS:
            if len(plain) >= n:
                weight = max(weight, self.lexicon.get(plain[:n] + "*", 0.0))
        if weight and plain not in CLOSED:
            return INSULT, weight
        kind = CLOSED.get(plain, OTHER)
        return kind, START_WEIGHT if kind == THREAT else 0.0

    def measures(self, text: str) -> np.ndarray:
        """For each kind of pattern the logarithm of the sum of its weights, and the largest weight."""
        known = self._classes
        words = text.split()
        if len(known) > KEPT:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.classify(w)
        codes = [code for w in words for code in known[w]]
        out = np.zeros(2 * len(KINDS))
        heavy = [i for i, x in enumerate(codes) if x[1]]
        if not heavy:
            return out
        if self._machine is None:
            self._machine = grammar()
        done = -1
        for i in heavy:
            if i <= done:
                continue
            begin = i  # the sentence that holds the word, as far as the grammar reads
            while begin > 0 and codes[begin - 1][2] != STOP:
                begin -= 1
            state, at = self._machine.start, begin
            while at < len(codes):
                kind, weight, edge = codes[at]
                state, pattern = self._machine.move(state, kind)
                if pattern is not None:
                    out[pattern] += weight
                    out[len(KINDS) + pattern] = max(out[len(KINDS) + pattern], weight)
                if edge:
                    state, _ = self._machine.move(state, edge)
                if edge == STOP:
                    break
                at += 1
            done = at
        out[: len(KINDS)] = np.log1p(out[: len(KINDS)])
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.measures(t) for t in texts]).reshape(len(texts), 2 * len(KINDS))
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])

    def __getstate__(self):
        return {"lexicon": self.lexicon, "weights": self.weights, "_classes": {}, "_machine": None}


# --- learning --------------------------------------------------------------------------------------------------------


def _marks(text: str) -> set[str]:
    words = {spelled(run) for w in set(text.split()) for run in LETTERS.findall(w)}
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def learn_lexicon(sample: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Words and stems that mark toxic documents, weighted by log-odds; every count covers the whole sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for batch in small_batches(batches):
            for text, label in zip(texts_of(batch, "text"), batch.column("label").to_pylist(), strict=True):
                (toxic if label else clean).update(_marks(text))
            # What this task has met goes on in parts, so that its counters stay small.
            if len(toxic) + len(clean) > 500_000:
                yield _counts(toxic, clean)
                toxic, clean = Counter(), Counter()
        yield _counts(toxic, clean)

    table = sample.mapInArrow(count, "mark string, toxic long, clean long").groupBy("mark").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    totals = sample.groupBy("label").count().collect()
    n = {r.label: r["count"] for r in totals}
    odds = F.log((F.col("toxic") + 0.5) / (n.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (n.get(0, 0) + 1))
    found = table.where((F.col("toxic") >= LEAST_TOXIC) & (F.col("toxic") >= LEAST_SHARE * (F.col("toxic") + F.col("clean"))))
    rows = found.select("mark", odds.alias("odds")).where("odds > 1").orderBy(F.col("odds").desc(), "mark").limit(size).collect()
    lexicon = {w: START_WEIGHT for w in INSULTS}
    lexicon.update((r["mark"], r["odds"]) for r in rows)
    return lexicon


def _counts(toxic: Counter, clean: Counter) -> pa.RecordBatch:
    marks = [*(toxic | clean)]
    return pa.RecordBatch.from_arrays([pa.array(marks, pa.string()), pa.array([toxic[m] for m in marks], pa.int64()), pa.array([clean[m] for m in marks], pa.int64())], names=["mark", "toxic", "clean"])


def fit(docs: DataFrame, marked: DataFrame, rows: int = SAMPLE) -> Model:
    """A model of ``marked`` (doc_id, label 0 or 1), fitted on a sample of at most ``rows`` documents."""
    sample = stored(sample_of(docs, marked, rows), "toxicity-sample")
    # The lexicon comes from one half and the pattern weights from the other, then each the other way round.
    half = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(2))
    xs, ys = [], []
    for own in (0, 1):
        model = Model(learn_lexicon(sample.where(half == own)), PRIOR)

        def measure(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            for batch in small_batches(batches):
                rows_ = [model.measures(t).astype("<f8").tobytes() for t in texts_of(batch, "text")]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows_, pa.binary())], names=["doc_id", "label", "x"])

        # At most ``rows`` documents of 16 numbers.
        table = sample.where(half != own).mapInArrow(measure, "doc_id long, label int, x binary").toPandas().sort_values(["doc_id", "label", "x"])
        xs += [np.frombuffer(x, "<f8") for x in table["x"]]
        ys += table["label"].tolist()
    weights = logistic_fit(np.array(xs), np.array(ys, float)) if 0 < sum(ys) < len(ys) else PRIOR
    return Model(learn_lexicon(sample), weights)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_hash and score (0 to 1) of every row of ``docs`` (doc_id, text)."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            scores = model.score(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(scores, pa.float64())], names=["doc_id", "text_hash", "score"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return given.mapInArrow(rate, "doc_id long, text_hash long, score double")


def harmless_documents(docs: DataFrame, marked: DataFrame, alarm: float = ALARM) -> DataFrame:
    """The rows of ``docs`` that score below ``alarm`` by a model of ``marked``."""
    model = fit(docs, marked)
    return rows_where(docs, lambda texts: model.score(texts) < alarm)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = score(docs, fit(docs, labels(spark, sf_dir, "toxic")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ALARM).cast("int").alias("predicted"))
