"""Document fingerprints from closed syncmers (operator 7), with DataFrame functions alone.

Words are hashed, neighbouring words give the hashes of the inner substrings (2 words), and a run of 5 words is a closed
syncmer if the least of its inner hashes is its first or its last. Whether a run is chosen depends on nothing but the run,
so a passage keeps its anchors wherever it stands, and of any few neighbouring runs one is chosen. A fingerprint lists all
anchors of a text in its order, each with the number of its first word, so it grows with the text. For the likeness of two
texts the positions with equal anchors are paired one to one; it is the share of pairs among pairs and unpaired positions.

Defined cases: a null text is an empty one. A text without an anchor (fewer than 5 words, or by chance) has one for the whole
sequence of words, so equal texts have equal fingerprints and two empty texts a likeness of 1. Rows follow each other by
descending id, equal ids by text, null ids at the end; a single row is its own successor. Other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daylog.llm.common import WORD_GAP, documents

RUN, INNER = 5, 2
DIGITS, POSITION_DIGITS = 12, 8
#: Stretches of ids for each shuffle partition; each is a few rows' work less than the next.
STRETCHES = 4
LOWEST = -(1 << 63)


def _stretch(array: str, first: int, length: str) -> Column:
    """``length`` entries from place ``first``, both columns or places of stored columns: nothing is worked out twice."""
    return F.slice(F.col(array), F.lit(first + 1), F.greatest(F.col(length), F.lit(0)))


def with_runs(df: DataFrame, text: str, runs: str) -> DataFrame:
    """Adds ``runs``: an entry for every run of words of a text, its 48-bit hash if it is a closed syncmer, else null; and
    ``runs`` + ``_whole``, the hash of the whole sequence of words.

    Every step is a column of its own, so that Spark evaluates it once a row.
    """
    t = {k: f"__{runs}_{k}" for k in ("trimmed", "words", "hashes", "pairs", "n", "inner", "least", "edge", "chosen", "begin", "run")}
    last, mask = RUN - INNER, (1 << (4 * DIGITS)) - 1
    df = df.withColumn(t["trimmed"], F.regexp_replace(F.col(text), f"^{WORD_GAP}|{WORD_GAP}$", ""))
    df = df.withColumn(t["words"], F.when(F.col(t["trimmed"]) == "", F.array().cast("array<string>")).otherwise(F.split(t["trimmed"], WORD_GAP)))
    df = df.withColumn(f"{runs}_whole", F.xxhash64(F.concat_ws(" ", F.lit("whole"), F.col(t["words"]))).bitwiseAND(mask))
    df = df.withColumn(t["hashes"], F.transform(t["words"], lambda w: F.xxhash64(w)))
    df = df.withColumn(t["pairs"], F.size(t["hashes"]) - 1)
    df = df.withColumn(t["inner"], F.zip_with(_stretch(t["hashes"], 0, t["pairs"]), _stretch(t["hashes"], 1, t["pairs"]), lambda a, b: F.xxhash64(a, b)))
    # A run has the inner hashes i to i + 3. An edge is the least exactly if it is no more than the two between.
    df = df.withColumn(t["n"], F.col(t["pairs"]) - last)
    df = df.withColumn(t["least"], F.zip_with(_stretch(t["inner"], 1, t["n"]), _stretch(t["inner"], 2, t["n"]), lambda a, b: F.least(a, b)))
    df = df.withColumn(t["edge"], F.zip_with(_stretch(t["inner"], 0, t["n"]), _stretch(t["inner"], last, t["n"]), lambda a, b: F.least(a, b)))
    df = df.withColumn(t["begin"], F.zip_with(_stretch(t["inner"], 0, t["n"]), _stretch(t["inner"], 2, t["n"]), lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn(t["run"], F.zip_with(t["begin"], _stretch(t["inner"], last, t["n"]), lambda a, b: F.xxhash64(a, b).bitwiseAND(mask)))
    df = df.withColumn(t["chosen"], F.zip_with(t["edge"], t["least"], lambda e, m: e <= m))
    df = df.withColumn(runs, F.zip_with(t["chosen"], t["run"], lambda c, r: F.when(c, r)))
    return df.drop(*t.values())


def with_anchors(df: DataFrame, text: str, anchors: str) -> DataFrame:
    """Adds ``anchors``: an array of (position, anchor), the word numbers and 48-bit hashes of the closed syncmers of a text."""
    df = with_runs(df, text, "__runs")
    entry = lambda r, i: F.when(r.isNotNull(), F.struct(i.alias("position"), r.alias("anchor")))
    df = df.withColumn(anchors, F.array_compact(F.transform("__runs", entry)))
    whole = F.array(F.struct(F.lit(0).alias("position"), F.col("__runs_whole").alias("anchor")))
    return df.withColumn(anchors, F.when(F.size(anchors) > 0, F.col(anchors)).otherwise(whole)).drop("__runs", "__runs_whole")


def as_text(anchors: str) -> Column:
    """Eight digits of the position and twelve of the hash for each anchor, in hexadecimal."""
    digits = lambda x, n: F.lpad(F.lower(F.hex(x)), n, "0")
    return F.array_join(F.transform(anchors, lambda x: F.concat(digits(x["position"], POSITION_DIGITS), digits(x["anchor"], DIGITS))), "")


def likeness(a: str, b: str) -> Column:
    """Of the positions of both lists, paired where their anchors are equal, the share of pairs among pairs and unpaired positions."""
    # Twice the hash, and one more for the second list: sorted, the first list's copies of an anchor stand before the second's.
    marked = F.sort_array(F.concat(F.transform(F.col(a)["anchor"], lambda x: x * 2), F.transform(F.col(b)["anchor"], lambda x: x * 2 + 1)))
    none = F.struct(F.lit(-1).cast("long").alias("last"), F.lit(0).alias("open"), F.lit(0).alias("pairs"))

    def step(state: Column, x: Column) -> Column:
        anchor, second = F.shiftright(x, 1), x % 2 == 1
        open_ = F.when(state["last"] == anchor, state["open"]).otherwise(0)
        meets = second & (open_ > 0)
        return F.struct(anchor.alias("last"), F.when(~second, open_ + 1).when(meets, open_ - 1).otherwise(0).alias("open"), F.when(meets, state["pairs"] + 1).otherwise(state["pairs"]).alias("pairs"))

    total = F.size(a) + F.size(b)
    return F.aggregate(marked, none, step, lambda state: state["pairs"] / (total - state["pairs"]))


def with_next(df: DataFrame, order: list[Column], key: str, columns: dict[str, str], stretch: str, guest: str) -> DataFrame:
    """Adds, as ``columns`` names them, values of the next row of the stretch."""
    window = Window.partitionBy(stretch).orderBy(F.col(guest), F.col(key).desc(), *order)
    for column, name in columns.items():
        df = df.withColumn(name, F.lead(column).over(window))
    return df


def in_stretches(docs: DataFrame) -> DataFrame:
    """The rows dealt into stretches of descending ids, with the first row of the following stretch as a guest at the end.

    Stretches are cut at quantiles of the ids, so each holds about as many rows; only their largest ids come to the
    driver, one for each stretch.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(LOWEST)))
    n = STRETCHES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    stretch = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("key"))) if cuts else F.lit(0)
    rows = rows.withColumn("stretch", stretch).withColumn("guest", F.lit(0))
    heads = {r.stretch: r.head for r in rows.groupBy("stretch").agg(F.max("key").alias("head")).collect()}  # a row a stretch
    if not heads:
        return rows
    order = sorted(heads)
    goes_to = {heads[s]: order[(i + 1) % len(order)] for i, s in enumerate(order)}
    first = Window.partitionBy("key").orderBy("text")
    guests = rows.where(F.col("key").isin(list(goes_to))).withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")
    target = F.element_at(F.create_map(*[F.lit(x) for pair in goes_to.items() for x in pair]), F.col("key"))
    return rows.unionByName(guests.withColumn("stretch", target).withColumn("guest", F.lit(1)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): its text, edited text and their anchors, and those of the next document."""
    rows = in_stretches(docs)
    rows = with_next(rows, [F.col("text")], "key", {"text": "next_text"}, "stretch", "guest")
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.withColumn("edited", F.coalesce(edited, F.lit("")))
    rows = with_anchors(rows, "text", "anchors")
    rows = with_next(rows, [F.col("text")], "key", {"anchors": "next_anchors"}, "stretch", "guest")
    rows = rows.where("guest = 0")
    return with_anchors(rows, "edited", "edited_anchors").select("doc_id", "text", "edited", "anchors", "edited_anchors", "next_anchors")


def op7_rows(docs: DataFrame) -> DataFrame:
    rows = fingerprints(docs)
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("anchors").alias("fingerprint"),
        as_text("edited_anchors").alias("edited_fingerprint"),
        likeness("anchors", "edited_anchors").alias("near_edited"),
        likeness("anchors", "next_anchors").alias("near_next"),
    )


def op7_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_rows(documents(spark, sf_dir))
