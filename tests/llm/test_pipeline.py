"""The pipeline against a plain version of its stages on a small corpus."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daylog.llm import folds, quality, toxicity
from daylog.llm.chunks import packed
from daylog.llm.common import new_folder, ship_code
from tests.llm.conftest import SCHEMA, TEXTS
from tests.llm.test_dedup import kept_list, plain_components, plain_fingerprint
from tests.llm.test_scoring import corpus, prose
from tests.llm.test_tokens import spans


def written(spark, rows, marks):
    folder = new_folder(spark, "sf")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_equals_plain_stages(spark):
    ship_code(spark)
    rows, marks = corpus(11, 200)
    rng = random.Random(12)
    passage = prose(rng, 70)
    rows += [(i, t, "en", "s", len(t)) for i, t in enumerate([prose(rng, 30) + " " + passage + " " + prose(rng, 40) for _ in range(12)], 1000)]
    rows += [(i + 2000, t, a, b, n) for i, t, a, b, n in rows[:40]]  # copies
    rows += [(i + 3000, t, a, b, n) for i, t, a, b, n in TEXTS] + [TEXTS[0], (None, passage, None, None, None), (6000, passage, None, None, None)]
    folder = written(spark, rows, marks)
    got = corpus_pipeline.run(spark, folder).collect()

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.fit(docs, folds.labels(spark, folder, "quality"))
    good = Counter((r.doc_id, r.text_hash) for r in quality.score(docs, model).where("score >= 0.5").collect())
    hashed = {(r.doc_id, r.h): r.text or "" for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    kept = spark.createDataFrame([(i, hashed[i, h]) for (i, h), n in good.items() for _ in range(n)], "doc_id long, text string")
    model = toxicity.fit(kept, folds.labels(spark, folder, "toxic"))
    harmless = sorted(((r.doc_id, hashed[r.doc_id, r.text_hash]) for r in toxicity.score(kept, model).where("score < 0.7").collect()), key=lambda x: (x[0] is None, x[0] or 0))
    assert 0 < len(harmless) < len(kept.collect()) < len(rows)
    first = {}
    for (i, text), root in zip(harmless, plain_components([plain_fingerprint(t) for _, t in harmless], 3)):
        first.setdefault(root, (i, text))
    single = list(first.values())
    assert len(single) < len(harmless)
    left = []
    for (i, text), mine in zip(single, kept_list(single, 50)):
        if mine[2] == 0:
            left.append((i, text))
        elif mine[3]:
            left.append((i, mine[3]))
    assert any(t not in {x for _, x in single} for _, t in left)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text in left:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.update((i, a, b - a, zlib.crc32(packed(ids[a:b]))) for a, b in spans(len(ids)))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in got) == want


CLASHES = "__id __n __no_id __hash __text_hash __starts __hits starts hits label rest row id n no_id text_hash group fp score".split()


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    ship_code(spark)
    rows, marks = corpus(13, 60)
    for given in (rows, []):
        folder = written(spark, given, marks)
        docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({name: F.lit(f"clash {name}") for name in CLASHES})
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            if name != "packing":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
                assert all(r[name] == f"clash {name}" for r in out.collect() for name in CLASHES), name
            assert (out.count() > 0) == bool(given)
            docs = out
