"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import LONG, messy_rows
from tillwork.llm import (
    class_lm,
    decontaminate,
    grammar_files,
    interleave,
    language,
    near_dup,
    pieces,
    quality,
    token_counts,
    url_rules,
)
from tillwork.llm.common import stored
from tillwork.llm.queries import tokenizer

EXTRA = ("ids", "key", "bucket", "_row", "_content", "kept", "n_words", "shard", "a.b")


def same_extras(out, names):
    """The extra columns pass through unchanged."""
    want = dict(zip(EXTRA, ("i", 1, 2, 3, "c", "k", 4, 5, 6)))
    for row in out:
        for n in names:
            assert row[n] == want[n], n


def test_near_duplicates(messy, nothing):
    out = near_dup.with_groups(messy, shingle=2).collect()
    assert len(out) == len(messy_rows())
    by = {(r.doc_id, r.n_shingles): r for r in out}
    assert by[(1, 21)].component_id == 1 and by[(1, 21)].kept
    copies = [r for r in out if r.doc_id == 2]
    assert [(r.component_id, r.kept) for r in copies] == [(1, False)] * 2
    for doc in (3, 4, 6):
        assert (by[(doc, 0)].component_id, by[(doc, 0)].kept) == (doc, True)
    assert by[(7, 1)].n_shingles == 1
    assert all(r.component_id is None and r.kept for r in out if r.doc_id is None)
    assert near_dup.with_groups(nothing).collect() == []


def test_one_key_with_several_texts(rows):
    a, b = "a b c d e f g h i j", "q r s t u v w x y z"
    docs = rows("doc_id bigint, text string", (1, a), (5, a), (5, b), (9, b), (7, "else"))
    out = {r.doc_id: r.component_id for r in near_dup.with_groups(docs, shingle=2).collect()}
    assert out == {1: 1, 5: 1, 9: 1, 7: 7}


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(tokenizer("piece_bpe_32k.model"))


def test_sentencepiece(messy, nothing, model):
    out = pieces.decoded(pieces.encoded(messy, model, to="codes"), model, ids="codes").collect()
    same_extras(out, EXTRA)
    at_once = pieces.encoded(messy, model, to="codes", back="decoded").collect()
    assert sorted(map(str, at_once)) == sorted(map(str, out))
    for r in out:
        assert r.decoded == (r.text or "").replace("▁", " ")
        assert (len(r.codes) == 0) == (not r.text)
    assert pieces.decoded(pieces.encoded(nothing, model), model).collect() == []


def test_class_lm(messy, nothing):
    trained, seen = class_lm.modelled(messy)
    out = class_lm.scored(messy, trained, seen, "doc_id", "text").collect()
    assert len(out) == len(messy_rows())
    by = {r.doc_id: r for r in out}
    assert (by[3].n_tokens, by[4].n_tokens, by[6].n_tokens, by[5].n_tokens) == (1, 1, 1, 40_001)
    assert all(r.score < 0 and r.base_score < 0 for r in out)
    trained, seen = class_lm.modelled(nothing)
    assert class_lm.scored(nothing, trained, seen, "doc_id", "text").collect() == []
    # nothing learned: every word is unseen, base is log10(1 / 1)
    assert {r.base_score for r in class_lm.scored(messy, trained, seen, "doc_id", "text").collect()} == {0.0}


def test_interleave(messy, nothing):
    out = interleave.interleaved(messy, "doc_id", "source", 4, ties=("text",)).collect()
    same_extras(out, [e for e in EXTRA if e != "shard"])
    sizes = [sum(r.shard == s for r in out) for s in range(4)]
    assert sorted(sizes) == [2, 3, 3, 3]
    for s in range(4):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    assert interleave.interleaved(nothing, "doc_id", "source", 4).collect() == []


def test_language(messy, nothing):
    profiles = language.trained(messy)
    assert profiles.languages == ["de", "en", "fr", "und"]
    evidence = dict(declared=F.col("lang"), host=F.col("source"), domain=F.lit(None))
    out = language.fused(messy, profiles, **evidence).collect()
    same_extras(out, EXTRA)
    assert len(out) == len(messy_rows())
    assert {r.language for r in out if not (r.text or "").strip()} == {"und"}
    assert {r.language for r in out if r.doc_id in (1, 2)} == {"en"}
    assert not any(r.language_kept for r in out if r.language == "und")
    assert language.fused(nothing, language.trained(nothing), **evidence).collect() == []
    # without labelled rows nothing is known
    assert {r.language for r in language.fused(messy, language.trained(nothing)).collect()} == {"und"}


def test_token_counts(messy, nothing):
    file = tokenizer("byte_bpe_50k.json")
    library = token_counts.load(file)
    table = token_counts.frequent_lengths(messy, file)
    out = token_counts.counted(messy, file, table, to="tokens").collect()
    same_extras(out, EXTRA)
    for r in out:
        assert r.tokens == len(library.encode(r.text or "", add_special_tokens=False))
    # no table, the same counts
    bare = token_counts.counted(messy, file, {}, to="tokens").collect()
    assert sorted(r.tokens for r in bare) == sorted(r.tokens for r in out)
    assert token_counts.counted(nothing, file, token_counts.frequent_lengths(nothing, file)).collect() == []


def test_frequent_pretokens_of_all_texts(spark, monkeypatch):
    """Every one of 40,000 texts has a word of its own; a word found once in every text comes before them."""
    file = tokenizer("byte_bpe_50k.json")
    word = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    texts = spark.range(0, 40_000, 1, 4).select(F.concat(word, F.lit(" and")).alias("text"))
    table = token_counts.frequent_lengths(texts, file)
    assert len(table) == 40_001 and next(iter(table)) == " and"
    # where not all have room, those that are found as often as one left out are left out
    monkeypatch.setattr(token_counts, "ENTRIES", 40_000)
    assert list(token_counts.frequent_lengths(texts, file)) == [" and"]
    # counts handed on in parts add up, beside many pre-tokens found once
    monkeypatch.setattr(token_counts, "ENTRIES", 3)
    monkeypatch.setattr(token_counts, "HELD", 5)
    some = [f"{'abcdefghij'[i % 10] * 3} {'k' * (i + 1)}" for i in range(40)] + ["x" * 65] * 50 + ["ሴ rare rare"] * 50
    batches = [pa.RecordBatch.from_arrays([pa.array(some[i : i + 7])], names=["text"]) for i in range(0, len(some), 7)]
    total = Counter()
    for b in token_counts._pretoken_counts(iter(batches)):
        assert b.num_rows <= 3
        for name, n in zip(*[c.to_pylist() for c in b.columns]):
            total[name] += n
    assert {w: total[w] for w in ("aaa", "jjj", " k", "x" * 65)} == {"aaa": 4, "jjj": 4, " k": 1, "x" * 65: 50}
    assert len(total) == 51


def test_quality(messy, nothing):
    out = quality.judged(messy).collect()
    assert len(out) == len(messy_rows())
    same_extras(out, [e for e in EXTRA if e not in ("kept", "n_words")])
    by = {r.doc_id: r for r in out}
    for doc in (3, 4, 6):
        assert tuple(by[doc][c] for c in quality.COUNTS) == (0, 0, 0, 0, 0) and by[doc].base_failed and not by[doc].kept
    assert by[1].kept and by[1].n_words == 22
    assert by[5].n_words == 40_000 and by[5].n_repeat_words == 0
    assert quality.judged(nothing).collect() == []


def test_decontaminate(messy, nothing, rows):
    items = rows("item_id bigint, text string", (1, "The quick BROWN fox"), (2, None), (None, "lazy dog"), (3, " .. "), (4, "one"), (5, "one"))
    out = decontaminate.occurrences(messy, items).collect()
    same_extras(out, [e for e in EXTRA if e != "n_words"])
    assert len(out) == len(messy_rows())
    hits = {r.doc_id: [tuple(s) for s in r.spans] for r in out if r.doc_id}
    assert hits[1] == [("1", 0, 4)] and hits[7] == [("4", 0, 1), ("5", 0, 1)] and hits[3] == hits[4] == hits[5] == []
    none = decontaminate.occurrences(messy, items.filter("item_id = 99")).collect()
    assert all(r.spans == [] for r in none)
    assert decontaminate.occurrences(nothing, items).collect() == []


def test_grammar_files(spark, messy, nothing):
    file = tokenizer("word_bpe_49k.json")
    library = token_counts.load(file)
    path = grammar_files.new_path(spark)
    grammar_files.write(messy, path, file, end=2)
    out = sorted(grammar_files.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.key for r in out] == [None, None, 1, 2, 2, 3, 4, 5, 6, 7, 8]
    at = 0
    texts = {r[0]: r[1] for r in messy_rows() if r[0]}
    for r in out:
        assert r.start == at
        at += r.n_tokens
        if r.key:
            assert r.n_tokens == len(library.encode(texts[r.key] or "", add_special_tokens=False)) + 1
    empty = grammar_files.new_path(spark)
    grammar_files.write(nothing, empty, file, end=2)
    assert grammar_files.read(spark, empty).collect() == []


def test_url_rules(messy, nothing, rows):
    rules = rows(
        "host string, path string, action string",
        ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
        ("", "/", "block"), (None, "/", "block"), ("x.net", None, None), ("NET", "/", "block"),
    )
    out = url_rules.judged(messy, rules).collect()
    same_extras(out, EXTRA)
    by = {r.doc_id: r for r in out if r.doc_id}
    assert (by[1].host, by[1].path, by[1].rule, by[1].verdict) == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert (by[3].host, by[3].path, by[3].rule, by[3].verdict) == ("", "", None, "allow")
    assert (by[4].host, by[6].rule, by[7].path, by[7].rule) == ("", "org/fr/", "", None)
    assert (by[8].host, by[8].path, by[8].verdict) == ("net", "/", "block")
    assert len(out) == len(messy_rows())
    assert {r.verdict for r in url_rules.judged(messy, rules.filter("false"), default="block").collect()} == {"block"}
    assert url_rules.judged(nothing, rules).collect() == []


def test_pipeline(spark, messy, nothing, folder):
    for docs, want in ((messy, 1), (nothing, 0)):
        kept = docs
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before = kept.dtypes
            kept = stored(stage(spark, kept, folder), "kept")
            if i + 1 < len(corpus_pipeline.STAGES):
                assert kept.dtypes == before
                same_extras(kept.collect(), EXTRA)
        assert (kept.count() > 0) == bool(want)


def test_long_text_is_whole(messy):
    row = quality.judged(messy.filter("doc_id = 5")).first()
    assert row.n_words == len(LONG.split())


def test_one_url_and_no_url_fill_the_table(spark, rows):
    """A third of the pages has one url, a third none: both sides of the join back are written tables."""
    hot = "http://a.example.net/en/x"
    pages = rows("page_id int, url string", *[(i, hot if i % 3 == 0 else None if i % 3 == 1 else f"http://h{i}.org/fr/{i}") for i in range(300)])
    rules = rows("host string, path string, action string", ("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "block"))
    out = url_rules.judged(pages, rules)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "LeftOuter" in plan
    assert {(r.page_id % 3, r.rule, r.verdict) for r in out.collect()} == {(0, "example.net/en/", "allow"), (1, None, "allow"), (2, "org/fr/", "block")}
    assert out.count() == 300


def test_rules_are_met_by_the_short_digest(spark, rows):
    rules = url_rules.prepared(rows("host string, path string, action string", ("net", "/", "block")))
    spread = rows("_host string, _path string, _full string, short string", ("net", "/", "ab", "ab"))
    plan = url_rules.candidates(spread, rules)._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "short" in join and "_full" in join and "(_full" not in join.replace("StartsWith(_full", "")


def test_one_row_repeated_is_dealt_over_buckets(spark, rows, monkeypatch):
    monkeypatch.setattr(interleave, "ROWS_PER_BUCKET", 20)
    docs = rows("doc_id bigint, source string", *[(1 if i % 3 == 0 else None if i % 3 == 1 else i, "s") for i in range(900)]).repartition(4)
    base = interleave._salted(interleave._numbered(docs.select("doc_id", interleave.random_bits(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_drawn"))), F.lit("0"))
    assert base.groupBy("_drawn").count().agg(F.max("count")).first()[0] <= 20 and base.count() == 900
    out = interleave.interleaved(docs, "doc_id", "source", 8).collect()
    sizes = [sum(r.shard == s for r in out) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s])) for s in range(8))
