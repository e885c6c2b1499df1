"""Merkle manifests, chat examples and whitening against brute-force versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import groupby

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, SCHEMA, messy_rows
from tillwork.llm import chat, merkle, whitening
from tillwork.llm.common import lower_ascii
from tillwork.llm.queries import CONTROL_TURN


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- Merkle manifest -------------------------------------------------------


def framed(*values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def grown(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top of a tree, and for each leaf its (left, right) siblings upwards."""
    if len(nodes) < 2:
        return (nodes[0] if nodes else None), [[] for _ in nodes]
    runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
    top, above = grown([sha("".join(r)) for r in runs])
    return top, [[("".join(r[:k]), "".join(r[k + 1 :])), *above[i]] for i, r in enumerate(runs) for k in range(len(r))]


def by_hand(docs: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof, folded root of the lower-cased text where 3 divides the crc32)."""
    first = lambda v: (v is not None, v if v is None else v.encode() if isinstance(v, str) else v)
    leaves = sorted(((lang, doc, framed(doc, source, lang, n, text), (doc, source, lang, n, text)) for doc, text, lang, source, n in docs), key=lambda x: (first(x[0]), first(x[1]), x[2]))
    groups = [(k, list(g)) for k, g in groupby(leaves, key=lambda x: x[0])]
    trees = [grown([x[2] for x in g]) for _, g in groups]
    root, above = grown([t for t, _ in trees])
    out = []
    for (_, group), (top, paths), over in zip(groups, trees, above):
        for (_, doc, leaf, fields), path in zip(group, paths):
            steps = [*path, *over]
            node = leaf
            if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 and fields[4] is not None:
                node = framed(*fields[:4], re.sub("[A-Z]", lambda m: m[0].lower(), fields[4]))
            for a, b in steps:
                node = sha(a + node + b)
            out.append((doc, leaf, top, root, sha("".join(a + b for a, b in steps)), node))
    return out


def manifested(docs):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n")]
    made = docs.withColumns({"leaf": merkle.row_digest(*fields, F.col("text")), "altered": merkle.row_digest(*fields, lower_ascii("text"))})
    found = merkle.manifest(made, F.col("leaf"), F.col("lang"), "doc_id", keep=made.columns)
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    out = merkle.proofs(found, [c for c in made.columns if c != "leaf"])
    node = F.when(changed, F.col("altered")).otherwise(F.col("leaf"))
    return out.withColumns({"proof": merkle.proof_digest(F.col("steps")), "folded": merkle.folded(node, F.col("steps"))})


def rows_of(frame) -> list[tuple]:
    return sorted(map(tuple, frame.select("doc_id", "leaf", "subroot", "root", "proof", "folded").collect()), key=str)


@pytest.mark.parametrize("counts", [(1,), (8,), (9, 1, 64), (65, 0, 513, 7, 2, 3, 1, 1, 1, 1)])
def test_manifest_equals_brute_force(rows, counts):
    names = [None, "en", "EN", "é", "", "z", "a", "b", "c", "d"]
    rng = random.Random(len(counts))
    docs = [(rng.choice([None, rng.randrange(1000), 7]), rng.choice(["Ab Ü", None, "", "x" * 50, str(rng.random())]), lang, rng.choice(["s", None]), rng.choice([3, None])) for lang, n in zip(names, counts) for _ in range(n)]
    rng.shuffle(docs)
    frame = rows("doc_id bigint, text string, lang string, source string, n bigint", *docs).repartition(5)
    assert rows_of(manifested(frame)) == sorted(by_hand(docs), key=str)


def test_manifest_of_equal_rows(rows):
    """One row repeated is split over partitions and still one group of leaves."""
    docs = [(5, "same", "en", "s", 4)] * 300 + [(k, "t", "en", "s", 1) for k in range(30)]
    assert rows_of(manifested(rows("doc_id bigint, text string, lang string, source string, n bigint", *docs))) == sorted(by_hand(docs), key=str)


def test_manifest_edges(spark, messy, nothing):
    docs = messy.withColumn("n", F.length("text").cast("bigint"))
    extras = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in messy_rows()], SCHEMA + ", _at int, _group int, digest string, steps string")
    kept = extras.withColumn("n", F.length("text").cast("bigint"))
    want = sorted(by_hand([(r[0], r[1], r[2], r[3], None if r[1] is None else len(r[1])) for r in messy_rows()]), key=str)
    assert rows_of(manifested(docs)) == want
    found = merkle.manifest(kept, F.lit("a" * 64), F.col("lang"), "doc_id", keep=["_at", "_group", "digest", "_row"])
    for r in merkle.proofs(found, ["_at", "_group", "digest", "_row"]).collect():
        assert (r._at, r._group, r.digest, r._row) == (1, 2, "x", 3)
    empty = merkle.manifest(nothing, F.lit("a"), F.col("lang"), "doc_id")
    assert empty.root is None and merkle.proofs(empty, []).collect() == []


def test_manifest_windows_hold_single_runs(rows):
    frame = rows("doc_id bigint, lang string", *[(i, "en") for i in range(20)])
    found = merkle.manifest(frame, F.sha2(F.col("doc_id").cast("string"), 256), F.col("lang"), "doc_id")
    plan = found.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") <= 2 and "Python" not in plan and "Arrow" not in plan


# --- chat examples ---------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string"
HARD = [
    CONTROL_TURN, "</s>", "<s>", "[INST]", "\\", "\\\\", "<\\s>", "\\<s>", "[\\[INST]", "<<SYS>>x<</SYS>>", "<", "<</s>", "[", "[/INST", "[ROLE]x[/ROLE][END]",
    "[ROLE/]", "a\nb\r\n\t", "😀</s>😀", "[[INST]]", "<<s>>", "", "$1\\2", "é́\u0000",
]


def written(spark, turns, **size):
    path = chat.new_path(spark)
    chat.write(turns, path, "conv_id", "turn", "role", "text", **size)
    return chat.read(spark, path)


def test_escapes_are_reversible_and_hide_all_marks(rows):
    rng = random.Random(1)
    parts = [*"<>[]/\\s", "INST]", "<s>", "</s>", "SYS>>", "<<", "ROLE", "END]"]
    made = HARD + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    out = rows("text string", *[(t,) for t in made]).select("text", chat.escaped(F.col("text")).alias("e")).withColumn("back", chat.unescaped(F.col("e"))).collect()
    marks = [*[m for pair in chat.MARKS.values() for m in pair], chat.NAME, chat.NO_NAME, chat.TEXT, chat.END]
    for r in out:
        assert r.back == r.text
        assert not any(m in r.e for m in marks)


def conversations(rng, n):
    out = []
    for conv in range(n):
        roles = rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["user"], ["assistant"], ["tool", None, "assistant", "[END]", ""]])
        for turn in range(rng.randrange(1, 9)):
            out.append((conv if conv else None, turn, roles[turn % len(roles)], rng.choice([*HARD, None, "plain words here"])))
    return out


def check_conversations(spark, data, blocks):
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)
    found = {r.key: r for r in chat.digests(blocks).collect()}
    groups = {k: list(g) for k, g in groupby(sorted(data, key=order), key=lambda r: r[0])}
    assert set(found) == set(groups)
    texts: dict = {}
    for b in sorted(blocks.collect(), key=lambda b: b.at):
        texts.setdefault(b.key, []).append(b)
    targets: dict = {}
    for e in sorted(chat.examples(blocks).collect(), key=lambda e: (e["at"], e.example)):
        before = "".join(b.formatted for b in texts[e.key] if b.at < e["at"])
        targets.setdefault(e.key, []).append((before + e.context, e.reply))
    one = lambda r: (r[2], r[3] or "")
    for key, turns in groups.items():
        r = found[key]
        replies = [t or "" for _, _, role, t in turns if role == "assistant"]
        assert (r.n_turns, r.loss_chars) == (len(turns), sum(map(len, replies)))
        assert r.turns_sha256 == sha("".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in turns))
        assert r.loss_sha256 == sha("".join(replies))
        whole = "".join(b.formatted for b in texts[key])
        assert r.formatted_chars == len(whole)
        made = targets.get(key, [])
        assert len(made) == len(replies)
        contexts = spark.createDataFrame([(c,) for c, _ in made], "c string").select(chat.parsed(F.col("c")).alias("t")).collect() if made else []
        want = [[one(x) for x in turns[:i]] for i, t in enumerate(turns) if t[2] == "assistant"]
        assert [[(t.role, t.text) for t in c.t] for c in contexts] == want
        for context, reply in made:
            assert whole.startswith(context + reply)


def test_every_reply_is_an_example_with_all_turns_before(spark, rows):
    data = conversations(random.Random(4), 25)
    check_conversations(spark, data, written(spark, rows(TURNS, *data).repartition(3)))


def test_a_conversation_over_many_partitions_and_blocks(spark, rows):
    data = [(9, i, "assistant" if i % 2 else "user", f"{CONTROL_TURN} {i}") for i in range(60)] + [(k, 0, "user", "hello") for k in range(8)] + [(10, 0, "assistant", LONG)]
    blocks = written(spark, rows(TURNS, *data).repartition(4), block=40)
    assert blocks.filter("key = 9").count() > 10 and blocks.filter("key = 9 and whole").count() == 0
    check_conversations(spark, data, blocks)


@pytest.mark.parametrize("block", [40, 65_536])
def test_examples_follow_from_those_before(spark, rows, block):
    """Each context is what the examples before hold, then ``since``; no turn is read twice."""
    data = conversations(random.Random(6), 20) + [(99, i, "assistant" if i % 2 else "user", f"{CONTROL_TURN} {i}") for i in range(20)]
    blocks = written(spark, rows(TURNS, *data), block=block)
    made: dict = {}
    for e in chat.examples(blocks, rest=True).collect():
        made.setdefault(e["at"], []).append(e)
    for b in blocks.collect():
        text = ""
        for e in sorted(made[b.at], key=lambda e: e.example):
            text += e.since
            if e.reply is not None:
                assert e.context == text + "<s>"
                text += f"<s>{e.reply}</s>"
        assert text == b.formatted and e.reply is None and e.context is None and len(made[b.at]) == len(b.replies) + 1
    few = chat.examples(blocks).collect()
    assert len(few) == sum(r[2] == "assistant" for r in data) and all(e.reply is not None for e in few)


def test_digests_are_those_of_the_examples(spark, rows, monkeypatch):
    data = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (2, 0, "user", "e")]
    blocks = written(spark, rows(TURNS, *data))
    of = chat.examples
    monkeypatch.setattr(chat, "examples", lambda *a, **k: of(*a, **k).withColumn("reply", F.concat(F.lit("!"), "reply")))
    found = {r.key: r for r in chat.digests(blocks).collect()}
    assert (found[1].loss_chars, found[1].loss_sha256) == (4, sha("!b!d"))
    assert found[1].turns_sha256 == sha("user\na\nassistant\n!b\nuser\nc\nassistant\n!d\n")
    assert (found[2].n_turns, found[2].loss_chars, found[2].turns_sha256) == (1, 0, sha("user\ne\n"))


def test_chat_edges(spark, rows):
    data = [(None, None, None, None), (None, None, None, None), (1, None, "user", "a"), (1, 0, "assistant", None), (1, 0, "assistant", None), (2, 5, "", "")]
    check_conversations(spark, data, written(spark, rows(TURNS, *data)))
    tied = written(spark, rows(TURNS, (1, 0, "user", "b"), (1, 0, "assistant", "a"))).first()
    assert tied.formatted == "<s>a</s>[INST]b[/INST]"
    assert chat.digests(written(spark, rows(TURNS))).collect() == []
    extra = rows(TURNS + ", key int, piece string, target int, tie string", (1, 0, "assistant", "a", 7, "p", 8, "t"))
    assert written(spark, extra).first().formatted == "<s>a</s>"


# --- whitening -------------------------------------------------------------


def brute(vectors: list) -> tuple:
    x = np.array([[int(np.floor(np.float64(np.float32(c)) * 256)) for c in v] for v in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    return x, n, s, values[::-1], vecs[:, ::-1], ((n * x - s) ** 2).sum(axis=1)


def check_whitened(out, vectors, most=4, tolerance=1e-9):
    x, n, s, values, vecs, deviation = brute(vectors)
    by: dict = {}
    for r in out:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(by) == len(vectors)
    k = min(most, x.shape[1])
    got = np.array([[by[i][c + 1].whitened for c in range(k)] for i in range(len(vectors))])
    want = (x - s / n) @ vecs[:, :k] / np.sqrt(values[:k])
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < tolerance
    for i in range(len(vectors)):
        for c in range(k):
            r = by[i][c + 1]
            assert (r.n, r.deviation) == (n, deviation[i])
            assert abs(r.explained - values[c] / values.sum()) < 1e-12 and 0 <= r.identity_error < 1e-9


def run(frame, most=4, keep=("vec_id",)):
    fit, rows = whitening.fitted(frame, "embedding", most, keep=list(keep))
    return fit, whitening.whitened(rows, fit, list(keep)).collect()


def test_query_against_dense_eigenvectors(spark, folder):
    table = pq.read_table(f"{folder}/embeddings.parquet")
    fit, out = run(spark.read.parquet(f"{folder}/embeddings.parquet"))
    ids = table["vec_id"].to_pylist()
    place = {v: i for i, v in enumerate(ids)}
    check_whitened([Row(**(r.asDict() | {"vec_id": place[r.vec_id]})) for r in out], table["embedding"].to_pylist())
    assert fit.passes < 80


@pytest.mark.parametrize("shape", [(40, 3), (300, 20), (9, 30), (500, 64)])
def test_whitening_of_random_vectors(rows, shape):
    rng = np.random.default_rng(shape[0])
    vectors = (rng.standard_normal(shape) * rng.uniform(0.5, 3, shape[1]) + 5).astype(np.float32).tolist()
    vectors += [vectors[0]] * (shape[0] // 2)  # copies count once
    _, out = run(rows("vec_id int, embedding array<float>", *enumerate(vectors)).repartition(6))
    check_whitened(out, vectors)


def test_eigenvalues_close_to_each_other():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((120, 120)))
    values = np.concatenate([[5, 5 - 1e-6, 5 - 2e-6, 4.9, 4.9 - 1e-5], np.linspace(4.8, 0.1, 115)])
    a = (q * values) @ q.T
    found, vectors = whitening.jacobi_davidson(lambda v: a @ v, 120, 4)
    assert np.abs(found - values[:4]).max() < 1e-12
    assert np.abs(a @ vectors - vectors * found).max() < 1e-13 * 120 and np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-13


def test_minres_solves():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    b = rng.standard_normal(30)
    solver = whitening.minres(b, 1e-12, 60)
    v = next(solver)
    try:
        while True:
            v = solver.send(a @ v)
    except StopIteration as end:
        assert np.abs(a @ end.value - b).max() < 1e-8


def test_whitening_edges(rows):
    schema = "vec_id int, embedding array<float>, `_x` int, component int, `a.b` int"
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0], [1.0, None], [1.0, nan], [inf, 0.0], [-inf, 0.0]]
    good = [[0.0, 1.0], [-0.0, 1.0], [1.0, 3.0], [2.0, 5.5], [2.0, 5.5], [-4.0, 0.25]]
    frame = rows(schema, *[(100 + i, v, 1, 2, 3) for i, v in enumerate(bad)], *[(i, v, 1, 2, 3) for i, v in enumerate(good)])
    _, out = run(frame, keep=("vec_id", "_x", "a.b"))
    check_whitened(out, good)
    assert all((r._x, r["a.b"]) == (1, 3) for r in out)
    flat = rows(schema, (1, [2.0, 3.0], 0, 0, 0), (None, [2.0, 3.0], 0, 0, 0))
    _, out = run(flat)
    assert len(out) == 4 and all(r.whitened is None and r.deviation == 0 and r.n == 1 and r.explained == 0 for r in out)
    line = rows(schema, *[(i, [float(i), 2.0 * i], 0, 0, 0) for i in range(5)])
    _, out = run(line)
    assert {r.component: r.whitened is None for r in out} == {1: False, 2: True}
    huge = rows(schema, (1, [3e38, 1.0], 0, 0, 0), (2, [-3e38, 2.0], 0, 0, 0), (3, [0.0, 2.0], 0, 0, 0))
    _, out = run(huge)
    assert len(out) == 6 and any(r.deviation is None for r in out)
    for none in (flat.filter("false"), flat.select("vec_id", F.lit(None).cast("array<float>").alias("embedding"))):
        assert run(none)[1] == []


def test_products_are_sums_of_partials(spark, folder):
    """A pass sends one number for each entry of the product, summed by Spark."""
    fit, rows_ = whitening.fitted(spark.read.parquet(f"{folder}/embeddings.parquet"), "embedding", 2, keep=[])
    assert fit.components.shape[1] == 2 and len(fit.sums) == 64
    assert rows_.columns == ["_row", "_x"]
