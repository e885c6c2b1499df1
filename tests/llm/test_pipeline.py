"""The pipeline's stages take effect and leave clean documents alone."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from tillwork.llm.common import stored


def test_stages_on_planted_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rng = random.Random(1)
    words = [w for r in docs.filter("lang = 'en'").select("text").limit(20).collect() for w in r.text.split() if w.isalpha()]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    clean = [prose(200) for _ in range(6)]
    passage = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    near = clean[0].split()
    near[50] = "changed"
    planted = {
        900001 + i: t
        for i, t in enumerate([*clean, clean[1], " ".join(near), prose(80) + " " + passage + " " + prose(80), " ".join("#$%" + w for w in prose(100).split()), "too short"])
    }
    rows = [(k, t, "en", "src1", len(t)) for k, t in planted.items()]
    kept = stored(docs.union(spark.createDataFrame(rows, docs.schema)), "planted")
    left = {}
    for name, stage in P.STAGES:
        kept = stored(stage(spark, kept, folder), name)
        left[name] = {r.doc_id for r in kept.filter("doc_id > 900000").select("doc_id").collect()}
    all_of = set(planted)
    assert left["quality_rules"] == all_of - {900010, 900011}
    assert left["language_id"] == left["quality_rules"]
    assert left["near_duplicates"] == left["language_id"] - {900007, 900008}
    assert left["decontamination"] == left["near_duplicates"] - {900009}
    assert left["sentencepiece_encoding"] == left["decontamination"] == set(range(900001, 900007))
    assert kept.filter(~F.col("round_trip")).count() == 0


def test_run_is_the_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, folder), name)
    assert sorted(map(tuple, P.run(spark, folder).select("doc_id", "n_tokens").collect())) == sorted(map(tuple, docs.select("doc_id", "n_tokens").collect()))
    assert P.ORACLE_SQL is None


def test_near_duplicates_go_by_rows_not_by_ids(spark, folder):
    """An id that holds a third of different texts loses none of them; copies without id are found; rows alike leave one."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(7, text(k), "en", "s", 1) for k in range(30)] + [(100 + k, text(1000 + k), "en", "s", 1) for k in range(20)]
    rows += [(None, text(5), "en", "s", 1), (None, text(2000), "en", "s", 1), (None, text(2000), "fr", "s", 1)]
    rows += [(100, text(1000), "en", "s", 1), (300, text(1001), "en", "s", 1), (8, None, "en", "s", 1), (8, "", "en", "s", 1), (8, "", "en", "s", 1)]
    frame = stored(spark.createDataFrame(rows, docs.schema).repartition(3), "by_rows")
    kept = P.near_duplicates(spark, frame, folder).collect()
    left = sorted(((r.doc_id, r.text) for r in kept), key=str)
    want = [(7, text(k)) for k in range(30)] + [(100 + k, text(1000 + k)) for k in range(20)] + [(None, text(2000)), (8, None), (8, ""), (8, "")]
    assert left == sorted(want, key=str)
