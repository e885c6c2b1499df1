"""Each operator against its library, a brute-force version, an exact round trip or held-out figures."""

from __future__ import annotations

import hashlib
import json
import math
import pickle
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.compare import difference
from tillwork.llm import class_lm, components, decontaminate, grammar_files, interleave, language, minhash, near_dup, pieces
from tillwork.llm import quality, token_counts, url_rules, words
from tillwork.llm.queries import oracles, queries, tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_matches_sql(name, spark, folder, duck):
    assert difference(queries()[name](spark, folder), duck, oracles()[name]) is None


# --- words and signatures --------------------------------------------------


def test_words_equal_the_pattern(texts):
    some = ["Ab c\td", "", "x", "Ä ö", "c d ab", " a b ", *list(texts.values())[:50]]
    known: dict[str, int] = {}
    for block in words.blocks(pa.array(some), words.WHITE):
        found = [block.data[s:e].tobytes().decode() for s, e in zip(block.start, block.end)]
        want = [WORD.findall(t.translate(LOWER)) for t in some[block.first : block.last]]
        assert found == [w for ws in want for w in ws]
        for w, h in zip(found, block.hash.tolist()):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_short_texts_are_one_window():
    for block in words.blocks(pa.array(["a b", "a", "b", "", "a b c"]), words.WHITE):
        doc, h = words.windows(block, 3)
        assert doc.tolist() == [0, 1, 2, 4] and len(set(h.tolist())) == 4


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = words.mix(np.arange(1, 4001, dtype=np.uint64))
    errors = []
    for _ in range(60):
        n, k = int(rng.integers(5, 900)), int(rng.integers(0, 900))
        a, b = pool[: n + k], pool[k : 2 * k + n]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        both = minhash.signatures(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2)
        errors.append((both[0] == both[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.045


def test_signature_does_not_depend_on_blocks(monkeypatch):
    e = words.mix(np.arange(1, 3001, dtype=np.uint64))
    whole = minhash.signatures(e, np.zeros(3000, np.int64), 1)
    monkeypatch.setattr(minhash, "ELEMENTS", 128)
    assert (minhash.signatures(e, np.zeros(3000, np.int64), 1) == whole).all()


# --- near duplicates -------------------------------------------------------


def exact_groups(texts: dict, size: int) -> dict:
    sets = {}
    for k, t in texts.items():
        w = WORD.findall(t.translate(LOWER))
        sets[k] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    parent = components.UnionFind({k: k for k in sets})
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent.join(a, b)
    return {k: parent.find(k) for k in keys}


def family(rng, n, base_words, changes):
    """Copies of one text with some words replaced: many pairs close to the threshold."""
    base = [f"w{rng.randrange(5000)}" for _ in range(base_words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(changes + 1)):
            copy[rng.randrange(base_words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_groups_equal_brute_force(rows, size, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 7)  # several blocks a centre and a bucket
    monkeypatch.setattr(near_dup, "MEMBERS", 5)
    rng = random.Random(size)
    made = [t for n, w, c in ((60, 120, 9), (40, 60, 4), (30, 300, 16), (5, 3, 1)) for t in family(rng, n, w, c)]
    rng.shuffle(made)
    docs = dict(enumerate(made))
    out = near_dup.with_groups(rows("doc_id bigint, text string", *docs.items()), shingle=size).collect()
    assert {r.doc_id: r.component_id for r in out} == exact_groups(docs, size)


@pytest.mark.parametrize("held", [3, 10**6])
def test_components_of_random_links(rows, monkeypatch, held):
    monkeypatch.setattr(components, "FLUSH", held)
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(300)]
    want = components.UnionFind()
    for a, b in links:
        want.join(a, b)
    out = components.components(rows("a bigint, b bigint", *links).repartition(7)).collect()
    assert {r.id: r.component for r in out} == {x: want.find(x) for x in want if any(x != y for l in links if x in l for y in l)}


# --- tokens ----------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(tokenizer("piece_bpe_32k.model"))


def odd_texts(rng, alphabet, n=3000):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(n)]


def test_pieces_equal_the_library(model, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    mine = pieces.Encoder(model)
    rng = random.Random(5)
    alphabet = [*model["pieces"], " ", "  ", "   ", "\n", "ሴ", "😀", "\x00", "é"]
    some = [*list(texts.values())[:60], *odd_texts(rng, alphabet), *[" " * k + "x" + " " * (k // 2) for k in range(80)]]
    ids = [np.frombuffer(mine.encode(t), "<i4").tolist() for t in some]
    assert ids == library.encode(some, num_threads=1)
    back = pieces.decode(pa.array(ids, pa.list_(pa.int32())), model["surface"])
    assert back == [library.decode(i) for i in ids]


def test_sentencepiece_query(result, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = result("op2_sentencepiece")
    assert set(out) == set(texts)
    for k, t in texts.items():
        ids = library.encode(t)
        assert tuple(out[k][1:]) == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))


def test_token_counts_query(result, texts):
    library = token_counts.load(tokenizer("byte_bpe_50k.json"))
    for k, r in result("op6_token_counts").items():
        n = len(library.encode(texts[k], add_special_tokens=False))
        assert tuple(r[1:]) == (len(texts[k].encode()), n, n > 1024)


def test_agreed_characters_have_the_same_class():
    counter = token_counts.PretokenCounter(tokenizer("byte_bpe_50k.json"), {})
    spans = re.findall("(.)-(.)", token_counts.AGREED, re.DOTALL)
    for low, high in spans:
        for c in map(chr, range(ord(low), ord(high) + 1, 1 if ord(high) - ord(low) < 2000 else 37)):
            t = f"a{c}1{c}!{c} {c}\n{c}{c}"
            assert counter.cut.findall(t) == [t[x:y] for _, (x, y) in counter.library.pre_tokenizer.pre_tokenize_str(t)], hex(ord(c))


def test_counts_of_odd_texts():
    counter = token_counts.PretokenCounter(tokenizer("byte_bpe_50k.json"), {"the": 1})
    some = odd_texts(random.Random(7), [*"aB1 !'\n\té ſ", "'s", "'ll", "<|endoftext|>", "ሴ", "😀", "\xa0", "中", "\u2028", "\x1f", "ա"])
    assert counter.count(some) == [len(e) for e in counter.library.encode_batch_fast(some, add_special_tokens=False)]


def test_chunks_equal_the_library():
    mine = grammar_files.ChunkEncoder(tokenizer("word_bpe_49k.json"))
    alphabet = [*"aBß1 .,!'\n\téÉİΣ", "'s", "'LL", "<|endoftext|>", "ሴ", "😀", "\xa0", "中", "\x1f", "\u0301", "Über", "..."]
    some = odd_texts(random.Random(9), alphabet)
    want = [e.ids for e in mine.library.encode_batch_fast(some, add_special_tokens=False)]
    assert [np.frombuffer(mine.encode(t), "<u4").tolist() for t in some] == want


def test_grammar_files_query(result, texts):
    library = token_counts.load(tokenizer("word_bpe_49k.json"))
    out, at = result("op9_grammar_files"), 0
    for k in sorted(texts):
        ids = [*library.encode(texts[k], add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (out[k].start, out[k].n_tokens, out[k].ids_crc32) == (at, len(ids), crc)
        at += len(ids)


@pytest.mark.parametrize("base", [300, 49408, 100_000])
def test_grammar_round_trip_and_random_access(base, monkeypatch):
    monkeypatch.setattr(grammar_files, "LEAST", 3)
    rng = np.random.default_rng(base)
    phrases = [rng.integers(0, base, 6) for _ in range(40)]
    ids = np.concatenate([phrases[i] for i in rng.integers(0, 40, 900)] + [np.full(57, 5)]).astype(np.uint32)
    sizes = [1, 1, 2, 700, 0]
    sizes[-1] = len(ids) - sum(sizes)
    block = {n: v[0] for n, v in grammar_files._block(0, 0, [1, 2, 3, 4, 5], sizes, ids, base).to_pydict().items()}
    kind = f"<u{block['width']}"
    sequence, rules = np.frombuffer(block["sequence"], kind), np.frombuffer(block["rules"], kind).reshape(-1, 2)
    assert len(sequence) < len(ids) / 2 and len(rules)
    assert (grammar_files.expand(sequence, rules, base) == ids).all()
    # documents start at symbols
    symbols = np.frombuffer(block["symbols"], "<u4")
    assert symbols.sum() == len(sequence) and symbols[:2].tolist() == [1, 1]
    for first, stop in ((0, 1), (3, 9), (700, 1400), (len(ids) - 5, len(ids)), (10, 10)):
        assert (grammar_files.ids_between(block, first, stop) == ids[first:stop]).all()


@pytest.mark.parametrize("base", [1000, 70_000])
def test_grammar_goes_on_until_no_pair_is_frequent(base):
    """A text 2,000 times over becomes one symbol a copy, beside texts that repeat little."""
    rng = np.random.default_rng(4)
    copy = rng.integers(0, base - 1, 400, dtype=np.uint32)
    documents = [copy] * 2000 + [rng.integers(0, base - 1, 300, dtype=np.uint32) for _ in range(20)]
    ids, last = np.concatenate(documents), np.zeros(800_000 + 6000, dtype=bool)
    last[np.cumsum([len(d) for d in documents]) - 1] = True
    sequence, ends, rules = grammar_files.compress(ids, last.copy(), base)
    assert (grammar_files.expand(sequence, rules, base) == ids).all()
    assert len(sequence) <= 2000 + 6000 and ends.sum() == len(documents)
    pairs = np.stack([sequence[:-1], sequence[1:]], axis=1)[~ends[:-1]]
    assert np.unique(pairs, axis=0, return_counts=True)[1].max() < grammar_files.LEAST


def test_later_rounds_count_only_pairs_that_may_be_frequent(monkeypatch):
    rng, counted, sort = np.random.default_rng(5), [], np.sort
    phrase = rng.integers(0, 40_000, 8)
    ids = np.concatenate([np.append(phrase, rng.integers(0, 40_000, 92)) for _ in range(500)]).astype(np.uint32)
    monkeypatch.setattr(np, "sort", lambda a, *rest: counted.append(len(a)) or sort(a, *rest))
    last = np.zeros(len(ids), dtype=bool)
    last[-1] = True
    sequence, _, rules = grammar_files.compress(ids, last, 49_408)
    monkeypatch.undo()
    counted = [n for n in counted if n > 500]  # not the sorts of a few pairs
    assert counted[0] == len(ids) - 1 and max(counted[1:]) < len(ids) / 10
    assert (grammar_files.expand(sequence, rules, 49_408) == ids).all() and len(sequence) == 500 * 93


# --- language model --------------------------------------------------------


def test_class_lm_base_and_gain(result, texts):
    tokens = {k: [*WORD.findall(t.translate(LOWER)), None] for k, t in texts.items()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    c = Counter(w for k, ws in tokens.items() if not held[k] for w in ws)
    n, v = sum(c.values()), len(c)
    out = result("op3_class_lm")
    for k, ws in tokens.items():
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        r = out[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], len(ws), sum(w in c for w in ws), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    # better than the base on texts it has not seen
    unseen = [r for r in out.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_invented_words_cost_no_less_than_words_of_the_texts(spark, folder, texts):
    """Shuffled letters score below the text they come from, an unseen word no better than any, and known words gain over the base."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model, seen = class_lm.modelled(docs)
    rng = random.Random(9)
    held = {k: t for k, t in texts.items() if t and zlib.crc32(str(k).encode()) % 7 == 2 and len(t.split()) > 30}
    known = {w for k, t in texts.items() if zlib.crc32(str(k).encode()) % 7 != 2 for w in WORD.findall((t or "").translate(LOWER))}
    invented = {k: " ".join("".join(rng.sample(w, len(w))) + "q" for w in t.split()) for k, t in held.items()}
    only_known = {k: " ".join(w for w in WORD.findall(t.translate(LOWER)) if w in known) for k, t in held.items()}
    made = [(f"{kind}{k}", t) for kind, some in (("t", held), ("i", invented), ("k", only_known)) for k, t in some.items()]
    frame = spark.createDataFrame(made, "doc_id string, text string")
    out = {r.doc_id: r for r in class_lm.scored(frame, model, seen, "doc_id", "text").collect()}
    of_known_words = [k for k in held if out[f"t{k}"].n_known > 0.6 * out[f"t{k}"].n_tokens]
    assert len(of_known_words) > 10
    for k in of_known_words:
        assert out[f"i{k}"].perplexity > out[f"t{k}"].perplexity
    assert sum(out[f"k{k}"].score for k in held) > sum(out[f"k{k}"].base_score for k in held)
    # all words together, seen or estimated, have probability one in their class
    of, chances = model.group[:-2], 10**model.emit
    for k in set(of.tolist()):
        rest = seen.filter(f"k = {k}").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0] / model.tokens[k]
        assert chances[of == k].sum() + rest == pytest.approx(1)
    assert model.kept / (model.rare + 1) * (model.rare + model.unseen) == pytest.approx(1)
    fewest = seen.filter("k is not null").agg(F.min("c")).first()[0]
    least = min(chances.min(), fewest / max(model.tokens) if fewest else 1)
    assert model.kept / (model.rare + 1) * 10 ** model.step[:, class_lm.CLASSES].mean() < least


def test_a_hot_rare_word(rows, monkeypatch):
    """A word just past the frequent ones that fills a third of the texts keeps a bounded list."""
    monkeypatch.setattr(class_lm, "FREQUENT", 3)
    texts = [(i, " ".join(["hot" if j % 3 == 0 else f"w{(i * j) % 40}" for j in range(12)])) for i in range(300)]
    texts += [(1000 + i, "aa bb cc " * 700) for i in range(8)]
    model, seen = class_lm.modelled(rows("doc_id bigint, text string", *texts).repartition(4))
    assert len(model.hashes) == 3 and seen.filter("k is not null and c > 500").count() >= 1
    # every token but the ends has its class in the sums
    assert model.tokens.sum() == model.total


def test_probabilities_add_up(spark, rows):
    docs = rows("doc_id bigint, text string", *[(i, " ".join(f"w{(i * j) % 23}" for j in range(1, 9))) for i in range(60)])
    model, seen = class_lm.modelled(docs)
    assert np.allclose((10**model.step).sum(axis=1), 1)
    of = model.group[model.item]
    for k in set(of.tolist()):
        assert (10 ** model.emit[of == k]).sum() == pytest.approx(1)


def test_exchange_finds_classes():
    """Words that alternate between two kinds end up in two classes."""
    rng = random.Random(1)
    pairs = np.zeros((14, 14))
    for _ in range(4000):
        a, b = rng.randrange(6), 6 + rng.randrange(6)
        pairs[a, b] += 1
        pairs[b, rng.randrange(6)] += 1
    group = class_lm.exchanged(pairs, 2)
    assert len(set(group[:6])) == 1 and len(set(group[6:12])) == 1 and group[0] != group[6] and group[12:].tolist() == [2, 3]


def test_best_class_of_many_words_is_that_of_the_gains(monkeypatch):
    rng = np.random.default_rng(5)
    size, words = class_lm.CLASSES + 2, 200
    pairs = rng.poisson(0.05, (words, words)).astype(float)
    group = np.concatenate([rng.integers(0, class_lm.CLASSES, words - 2), [size - 2, size - 1]])
    onto = np.eye(size)[group]
    between, own = onto.T @ pairs @ onto, np.diagonal(pairs).copy()
    out, into, r = pairs @ onto, pairs.T @ onto, np.arange(words)
    out[r, group] -= own
    into[r, group] -= own
    best = class_lm._best(between, out, into, own, group)
    for w in range(words - 2):
        rest = onto.copy()
        rest[w] = 0
        gain = class_lm._gains(rest.T @ pairs @ rest, out[w], into[w], own[w])
        gain[class_lm.CLASSES :] = -np.inf
        assert gain[best[w]] == pytest.approx(gain.max())


def test_every_recurring_word_has_a_class(rows, monkeypatch):
    """Words past the frequent ones take the class that their own neighbours tell, and the sums stay those of the tokens."""
    monkeypatch.setattr(class_lm, "FREQUENT", 20)
    rng = random.Random(3)
    made = []
    for i in range(800):  # a word of one kind, then one of the other, few of them frequent
        made.append((i, " ".join(f"{'a' if j % 2 == 0 else 'b'}{min(int(rng.paretovariate(0.6)), 150)}" for j in range(10))))
    docs = rows("doc_id bigint, text string", *made)
    model, seen = class_lm.modelled(docs)
    kinds = {"a": Counter(), "b": Counter()}
    known = {r.h: r for r in seen.collect()}
    held = {r[0] for r in docs.filter(class_lm.held_out("doc_id")).select("doc_id").collect()}
    count = Counter(w for i, t in made if i not in held for w in t.split())
    group = {}
    for w, c in count.items():
        h = class_lm.W._block(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]), 0, 1, class_lm.W.WHITE, True).hash
        at = np.flatnonzero(model.hashes == h[0])
        r = known[int(h.view(np.int64)[0])]
        assert r.c == c and (r.k is not None) == (c >= 2 and not len(at))
        group[w] = int(model.group[at[0]]) if len(at) else class_lm.CLASSES if r.k is None else r.k
        if c >= 2:
            kinds[w[0]][group[w]] += 1
            assert group[w] < class_lm.CLASSES
    assert sum(len(at) > 0 for at in [model.hashes]) and len(model.hashes) == 20 and len(count) > 150
    # the matrix of classes behind the model is that of the texts
    size = class_lm.CLASSES + 2
    between = np.zeros((size, size))
    for i, t in made:
        if i not in held:
            ks = [size - 1, *[group[w] for w in t.split()], size - 1]
            np.add.at(between, (ks[:-1], ks[1:]), 1)
    assert (model.tokens == between.sum(axis=0)).all()
    share = (between.sum(axis=0) + 1) / (between.sum() + size)
    assert np.allclose(model.step, np.log10((between + class_lm.WIDER * share) / (between.sum(axis=1, keepdims=True) + class_lm.WIDER)))
    # a text's score is that of its words and classes
    for r in class_lm.scored(docs, model, seen, "doc_id", "text").collect():
        ks, score = [size - 1], 0.0
        for w in made[r.doc_id][1].split():
            k, c = group.get(w, class_lm.CLASSES), count.get(w, 0)
            e = c / model.tokens[k] if k < class_lm.CLASSES else model.kept / (model.rare + 1)
            score += model.step[ks[-1], k] + math.log10(e)
            ks.append(k)
        assert r.score == pytest.approx(score + model.step[ks[-1], size - 1])


def test_exchange_gain_is_the_change_of_likelihood():
    rng = np.random.default_rng(2)
    pairs = rng.integers(0, 9, (8, 8)).astype(float)

    def likelihood(group):
        onto = np.eye(5)[group]
        n = onto.T @ pairs @ onto
        e = class_lm._entropy
        return e(n).sum() - e(n.sum(axis=1)).sum() - e(n.sum(axis=0)).sum()

    group = np.array([0, 1, 2, 0, 1, 2, 3, 4])
    w, onto = 3, np.eye(5)[[0, 1, 2, 0, 1, 2, 3, 4]]
    out, into, own = pairs[w] @ onto, pairs[:, w] @ onto, pairs[w, w]
    out[0] -= own
    into[0] -= own
    rest = onto.copy()
    rest[w] = 0
    between = rest.T @ pairs @ rest
    gain = class_lm._gains(between, out, into, own)
    for k in range(5):
        moved = group.copy()
        moved[w] = k
        assert gain[k] - gain[0] == pytest.approx(likelihood(moved) - likelihood(group))


# --- shards ----------------------------------------------------------------


def test_shards_match_the_mixture(spark, rows, monkeypatch):
    monkeypatch.setattr(interleave, "ROWS_PER_BUCKET", 50)
    made = [(i, "hot" if i % 3 == 0 else f"s{i % 7}" if i % 3 == 1 else f"alone{i}") for i in range(2000)]
    out = interleave.interleaved(rows("doc_id bigint, source string", *made), "doc_id", "source", 8, seed=1).collect()
    assert len(out) == 2000
    for s in range(8):
        of = [r for r in out if r.shard == s]
        assert len(of) == 250 and sorted(r.slot for r in of) == list(range(250))
        assert abs(sum(r.source == "hot" for r in of) - 667 / 8) <= 1.5
        assert abs(sum(r.source.startswith("alone") for r in of) - 666 / 8) <= 1.5
    again = interleave.interleaved(rows("doc_id bigint, source string", *made[::-1]).repartition(9), "doc_id", "source", 8, seed=1)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out))
    other = interleave.interleaved(rows("doc_id bigint, source string", *made), "doc_id", "source", 8, seed=2).collect()
    assert sorted(map(tuple, other)) != sorted(map(tuple, out))


def test_shards_query(result, texts):
    out = result("op4_stratified_shards")
    sizes = Counter(r.shard for r in out.values())
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for k, r in out.items():
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(texts[k].encode()) + 1, zlib.crc32(texts[k].encode()), "rows", None)


def test_shards_equal_plain_ranks(spark, folder, result):
    """Every shard and slot of the query, by ranks taken in one list."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "text").collect()
    bits = lambda *parts: int(hashlib.md5("/".join(map(str, parts)).encode()).hexdigest()[:12], 16)
    groups: dict[str, list] = {}
    for d in docs:
        text = (d.text or "").encode()
        tie = (d.doc_id, zlib.crc32(text), len(text) + 1)
        groups.setdefault(d.source, []).append((bits(2, *tie), tie))
    small = [s for s, of in groups.items() if len(of) < 8]
    strata = {json.dumps({"_source": s, "_none": False}, separators=(",", ":")): of for s, of in groups.items() if s not in small}
    if small:
        strata[""] = [x for s in small for x in groups[s]]
    order = sorted(
        ((rank + bits(2, name) / 2**48) / len(of), name, *row) for name, of in strata.items() for rank, row in enumerate(sorted(of))
    )
    got, n = result("op4_stratified_shards"), len(docs)
    for place, (*_, tie) in enumerate(order):
        shard = place * 8 // n
        assert (got[tie[0]].shard, got[tie[0]].slot) == (shard, place - -(-shard * n // 8))
    assert len(got) == n


# --- language --------------------------------------------------------------


def test_language_on_rows_not_trained_on(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    half = F.col("doc_id") % 2 == 0
    profiles = language.trained(docs.filter(half))
    out = language.fused(docs.filter(~half), profiles, keep=["doc_id", "lang"]).collect()
    assert sum(r.language == r.lang for r in out) >= 0.98 * len(out)


def test_every_label_has_a_profile(spark):
    """Few rows beside many, more labels than 256, equal texts of several ids, and regional tags."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    few = [(a + b) for a in letters[:12] for b in letters if a + b not in ("en", "un")][:300]
    many = spark.range(40_000).select(F.lit("en-GB").alias("lang"), F.concat(F.lit("the and of with number "), "id").alias("text"))
    rare = spark.createDataFrame([(x, f"{x}{x} {x}q{x} z{x}z{x}") for x in few], "lang string, text string")
    copies = spark.range(40_000).select(F.lit("zz").alias("lang"), F.lit("one text of all").alias("text"))
    profiles = language.trained(many.union(rare).union(copies))
    assert profiles.languages == [*sorted([*few, "en", "zz"]), "und"]
    assert profiles.log.shape == (303, language.SLOTS)
    assert np.allclose(np.exp(profiles.log.astype(float)).sum(axis=1), 1, atol=1e-3)
    # all rows count: 40,000 times the trigrams of the text
    _, _, slot = next(language.trigrams(pa.array(["one text of all"])))
    best = np.bincount(slot, minlength=language.SLOTS) * 40_000 + 0.5
    assert np.allclose(profiles.log[profiles.languages.index("zz")], np.log(best / best.sum()), atol=1e-4)


def test_evidence_decides_where_the_text_does_not(rows, spark, folder):
    profiles = language.trained(spark.read.parquet(f"{folder}/documents.parquet"))
    en, fr = "the of and with that are for this was then " * 4, "le la des et pour dans que qui les une est " * 4
    made = [(i, t, d, "h1" if d == "en" else "h2") for i, (t, d) in enumerate([(en, "en"), (fr, "fr")] * 40)]
    docs = rows("doc_id int, text string, d string, h string", *made, (100, "ation", "fr", "h2"), (101, "ation", "en", "h1"), (102, "", "fr", "h2"), (103, "0 1 2", None, None))
    out = {r.doc_id: r for r in language.fused(docs, profiles, declared=F.col("d"), host=F.col("h"), domain=F.lit("x")).collect()}
    assert (out[100].language, out[101].language, out[102].language, out[103].language) == ("fr", "en", "und", "und")
    assert out[0].language == "en" and out[1].language == "fr"


def plain_posteriors(trained_on: list[tuple], made: list[tuple]) -> dict:
    """id -> (language, posterior) of rows (id, text, declared, suffix, host, domain), one row and one number at a time."""

    def slots(text):
        b = [c if 97 <= c <= 122 or c >= 128 else 32 for c in (text or "").translate(LOWER).encode()]
        return [(((x << 16 | y << 8 | z) * 2654435769) % 2**32) >> 18 for x, y, z in zip(b, b[1:], b[2:]) if y != 32]

    names = sorted({label for _, label in trained_on})
    seen = {x: Counter(s for text, label in trained_on if label == x for s in slots(text)) for x in names}
    log = {x: lambda s, c=c, n=sum(c.values()): math.log((c[s] + 0.5) / (n + 0.5 * 2**14)) for x, c in seen.items()}
    log["und"] = lambda s: -math.log(2**14)
    names.append("und")
    texts = {}
    for r in made:
        found = slots(r[1])
        texts[r[0]] = (len(found), [sum(map(log[x], found)) * min(1, 600 / max(len(found), 1)) / 3 for x in names])
    vote = {k: max(range(len(names)), key=lambda i: (t[i], -i)) if n else len(names) - 1 for k, (n, t) in texts.items()}
    every = Counter(vote.values())
    out = {}
    for r in made:
        key, (n, score) = r[0], texts[r[0]]
        score = list(score)
        for place in (2, 3):
            if r[place] is not None:
                with_it = Counter(vote[o[0]] for o in made if o[place] == r[place])
                score = [s + math.log((with_it[i] + 0.5) / (every[i] + len(names))) for i, s in enumerate(score)]
        prior = [(every[i] + 1) / (len(made) + len(names)) for i in range(len(names) - 1)] + [0.01]
        for place in ((5,), (5, 4)):
            if r[place[-1]] is not None:
                others = Counter(vote[o[0]] for o in made if o[0] != key and all(o[p] == r[p] for p in place))
                m = sum(others.values())
                prior = [(others[i] + 20 * p) / (m + 20) for i, p in enumerate(prior)]
        score = [s + math.log(p) for s, p in zip(score, prior)]
        most = max(score)
        posterior = 1 / sum(math.exp(s - most) for s in score)
        out[key] = (names[score.index(most)], posterior) if n else ("und", 1.0)
    return out


@pytest.mark.parametrize("labels", [2, 256])
def test_posteriors_equal_plain_ones(rows, labels, monkeypatch):
    """Numbers of all four kinds of evidence, with the profiles in one block and in several."""
    monkeypatch.setattr(language, "LABELS", labels)
    rng = random.Random(6)
    parts = {"en": "the and ing ion of", "de": "der und sch ein ung", "fr": "les que ais eau oux", "nl": "het een ijk oor van", "da": "øre åen ikk det"}
    text = lambda x, n: " ".join(rng.choice(parts[x].split()) + rng.choice("abcde") for _ in range(n))
    known = [(text(x, 30), x) for x in parts for _ in range(3)]
    made = []
    for i in range(80):
        x = rng.choice(list(parts))
        host = rng.choice([None, "a.x.de", "b.x.de", "c.y.com", "d.y.com"])
        made.append(
            (i, rng.choice([text(x, rng.randrange(1, 5)), text(x, 300), "", None, "0 1", "zqx jvk"]), rng.choice([None, x, "en"]),
             host and host.rsplit(".", 1)[1], host, host and host.split(".", 1)[1])
        )
    docs = rows("doc_id int, text string, d string, s string, h string, o string", *made)
    given = dict(declared=F.col("d"), suffix=F.col("s"), host=F.col("h"), domain=F.col("o"))
    out = language.fused(docs, language.trained(rows("text string, lang string", *known)), **given, keep=["doc_id"]).collect()
    want = plain_posteriors(known, made)
    assert len(out) == len(made) and len({r.language for r in out}) == 6
    for r in out:
        name, posterior = want[r.doc_id]
        assert r.language == name and r.posterior == pytest.approx(posterior, rel=1e-4), (r, want[r.doc_id])
        assert r.language_kept == (name != "und" and posterior >= 0.5)


def test_parts_of_addresses_and_markup(rows):
    df = rows("html string", ("<!DOCTYPE html><HTML class=x Lang='en-GB'><p>a&amp;b</p><script>x</script>",), ("<p>",), (None,))
    got = df.select(language.declared_in(F.col("html")), language.text_of(F.col("html"))).collect()
    assert got[0][0] == "en" and got[0][1].split() == ["a", "b"] and got[1][0] is None and got[2][0] is None
    host = rows("h string", ("a.b.example.de",), ("de",), ("",)).select(language.suffix_of(F.col("h")), language.domain_of(F.col("h"))).collect()
    assert [tuple(r) for r in host] == [("de", "example.de"), ("de", None), (None, None)]


# --- quality ---------------------------------------------------------------


def counts(text: str) -> tuple:
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    hit = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_quality_counts(result, texts):
    for k, r in result("op7_robust_quality").items():
        n, *rest = want = counts(texts[k])
        assert tuple(r[c] for c in quality.COUNTS) == tuple(want)
        assert r.base_failed == (n < 20 or 100 * rest[-1] > 30 * n)
        assert not (r.base_failed and r.kept)


def test_quality_counts_of_repeats(rows):
    rng = random.Random(4)
    made = [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) + rng.choice(["", "\n", " \n\x0b"]) * 2 for _ in range(200)]
    made += ["x\ny\nx\n\n \n x", "é|<😀>\u00a0z"]
    df = rows("doc_id int, text string", *enumerate(made))
    out = quality.judged(df.withColumns({"lang": F.lit("l"), "source": F.lit("s")}))
    for r in out.collect():
        assert tuple(r[c] for c in quality.COUNTS) == counts(made[r.doc_id])


def test_outliers_are_rejected_and_the_rest_stays(rows):
    rng = random.Random(8)
    prose = lambda n: " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    docs = [(i, prose(rng.randrange(30, 400)), "en", "a") for i in range(300)]
    docs += [(1000 + i, " ".join(w + "$%&" for w in prose(100).split()), "en", "a") for i in range(20)]
    docs += [(2000 + i, prose(60), "fr", "b") for i in range(2)]
    out = quality.judged(rows("doc_id bigint, text string, lang string, source string", *docs)).collect()
    kept = {r.doc_id: r.kept for r in out}
    assert all(kept[k] == (k < 1000 or k >= 2000) for k in kept)


def robust_distances(x: np.ndarray, group: np.ndarray, language: dict) -> np.ndarray:
    """Squared distances by dense matrices: starts, concentration steps, least determinant."""
    groups, n_dim, least = sorted(set(group)), x.shape[1], quality.LEAST_SPREAD**2
    rows_of = {g: x[group == g] for g in groups}

    def estimates(moments, scale):
        means = {g: (n, m, scale * (a - np.outer(m, m))) for g, (n, m, a) in moments.items()}
        out = {}
        for g, (n, m, c) in means.items():
            near = [means[h] for h in groups if language[h] == language[g]]
            weight = sum(k for k, _, _ in near)
            pooled = [sum(part[0] * part[i] for part in near) / weight for i in (1, 2)]
            lean = quality.LEAN
            m, c = [(own * n + wide * lean) / (n + lean) for own, wide in zip((m, c), pooled)]
            c = c + np.eye(n_dim) * least
            out[g] = m, np.linalg.inv(c), np.linalg.slogdet(c)[1]
        return out

    def distance(v, estimate):
        return np.einsum("ri,ij,rj->r", v - estimate[0], estimate[1], v - estimate[0])

    def step(found):
        moments = {}
        for g, v in rows_of.items():
            interval = np.rint(16 * np.log1p(np.maximum(0, distance(v, found[g]))))
            core = v[[(interval < k).sum() < quality.CORE * len(v) for k in interval]]
            moments[g] = len(core), core.mean(axis=0), core.T @ core / len(core)
        return estimates(moments, quality.CONSISTENT)

    starts = [{}, {}, {}]
    for g, v in rows_of.items():
        m, spread = np.zeros(n_dim), np.zeros(n_dim)
        for p in range(n_dim):
            cell = np.rint(v[:, p] * 16)
            upto, before = ((cell[:, None] >= cell).sum(axis=1)), ((cell[:, None] > cell).sum(axis=1))
            middle = v[(upto > 0.25 * len(v)) & (before < 0.75 * len(v)), p]
            m[p], spread[p] = middle.mean(), np.sqrt(7 * middle.var() + least)
        z = (v - m) / spread
        u, t = z / np.maximum(np.sqrt((z**2).sum(axis=1)), 1e-9)[:, None], np.tanh(z)
        t = t.T @ t / len(v)
        scale = np.sqrt(np.maximum(np.diag(t), 1e-9))
        for start, shape in zip(starts, (np.eye(n_dim), n_dim * u.T @ u / len(v), t / np.outer(scale, scale))):
            start[g] = 1.0, m, shape * np.outer(spread, spread) + np.outer(m, m)
    best = {}
    for start in starts:
        core = step(estimates(start, 1.0))
        while True:
            new = step(core)
            lower = {g for g in groups if new[g][2] < core[g][2] - quality.SETTLED}
            core = {g: new[g] if g in lower else core[g] for g in groups}
            if not lower:
                break
        for g in groups:
            if g not in best or np.rint(core[g][2] * 1e6) < np.rint(best[g][2] * 1e6):
                best[g] = core[g]
    return np.array([distance(v[None], best[g])[0] for v, g in zip(x, group)])


def test_distances_equal_dense_estimates(rows):
    """Correlated statistics, and a fifth of one source written alike and far off."""
    rng = random.Random(12)
    prose = lambda n, size: " ".join("".join(rng.choice("etaoinshr") for _ in range(max(1, int(rng.gauss(size, 2))))) for _ in range(n))
    docs = []
    for name, lang, n in (("a", "en", 160), ("b", "en", 90), ("c", "fr", 60), ("d", None, 3)):
        for _ in range(n):
            words = rng.randrange(25, 400)
            docs.append((len(docs), prose(words, 4 + words / 200) + " #" * rng.randrange(1 + words // 60), lang, name))
    docs += [(len(docs) + i, "\n".join(["aa $$ | bb " + prose(3, 11)] * 2 + [prose(2, 12) + " $%" for _ in range(30)]), "en", "a") for i in range(40)]
    df = rows("doc_id bigint, text string, lang string, source string", *docs)
    out = [r for r in quality.judged(df).collect() if not r.base_failed]
    numbers = np.array([[r[c] for c in quality.COUNTS] for r in out], dtype=float)
    n, chars, symbols, lines, repeats = numbers.T
    x = np.stack([np.log(n), 4 * np.log(chars / n), np.log1p(200 * symbols / chars), np.log1p(lines), np.log1p(8 * repeats / n)], axis=1)
    want = robust_distances(np.rint(x * 256) / 256, np.array([r.source for r in out]), {"a": "en", "b": "en", "c": "fr", "d": None})
    got = np.array([r.distance for r in out])
    assert len(out) > 330 and np.allclose(got, want, rtol=1e-6, atol=1e-6)
    assert [r.kept for r in out] == (want <= quality.LIMIT).tolist()
    ours = np.array([r.doc_id >= len(docs) - 40 for r in out])
    assert ours.sum() == 40 and (got[ours] > quality.LIMIT).all() and (got[~ours] <= quality.LIMIT).mean() > 0.99


# --- benchmark passages ----------------------------------------------------


def test_spans_equal_brute_force(rows):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(12)]
    items = {i: [rng.choice(vocabulary) for _ in range(rng.choice((0, 1, 2, 3, 5, 9)))] for i in range(14)}
    docs = {i: [rng.choice(vocabulary) for _ in range(rng.randrange(0, 700))] for i in range(30)}
    out = decontaminate.occurrences(
        rows("doc_id int, text string", *[(k, "; ".join(v).upper()) for k, v in docs.items()]),
        rows("item_id int, text string", *[(k, " ".join(v)) for k, v in items.items()]),
        size=4,
    )
    got = out.select("doc_id", "n_words", decontaminate.words_hit("spans").alias("n"), decontaminate.items_hit("spans").alias("i")).collect()
    for r in got:
        w, hit, found = docs[r.doc_id], set(), set()
        for k, item in items.items():
            n = min(4, len(item))
            for window in {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else ():
                for i in range(len(w) - n + 1):
                    if tuple(w[i : i + n]) == window:
                        hit.update(range(i, i + n))
                        found.add(str(k))
        assert (r.n_words, r.n, r.i) == (len(w), len(hit), sorted(found))


def test_search_skips_and_blocks_agree(rows, monkeypatch):
    """Items in several broadcast blocks give what one block gives."""
    docs = rows("doc_id int, text string", *[(i, " ".join(f"v{(i * j) % 40}" for j in range(200))) for i in range(20)])
    items = rows("item_id int, text string", *[(i, " ".join(f"v{(i * j) % 40}" for j in range(3, 30))) for i in range(20)])
    one = decontaminate.occurrences(docs, items).collect()
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 500)
    several = decontaminate.occurrences(docs, items).collect()
    key = lambda r: (r.doc_id, sorted(map(tuple, r.spans)))
    assert sorted(map(key, one)) == sorted(map(key, several)) and any(r.spans for r in one)


def test_one_item_in_several_blocks_has_whole_spans(rows, monkeypatch):
    """Texts of one id, and passages that all items share, in several blocks and repeated."""
    w = [f"u{i}" for i in range(60)]
    docs = rows("doc_id int, text string", (1, " ".join(w)), (2, " ".join(w[:9])), (3, " ".join([*w[20:40], *w[20:40]])))
    items = rows("item_id int, text string", *[(i % 2, " ".join(w[i : i + 20])) for i in range(0, 41, 2)] * 2, (7, "u59"), (8, " ".join(w[:9])))
    one = decontaminate.occurrences(docs, items).collect()
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 300)
    several = decontaminate.occurrences(docs, items).collect()
    by_id = lambda found: {r.doc_id: [tuple(s) for s in r.spans] for r in found}
    assert by_id(one) == by_id(several)
    assert by_id(one)[1] == [("0", 0, 60), ("7", 59, 1), ("8", 0, 9)]
    assert by_id(one)[2] == [("8", 0, 9)]
    assert by_id(one)[3] == [("0", 0, 40)]


def test_search_tables_of_a_large_block_stay_small():
    """Tables are arrays over the items' words, about ten times their text at most, with equal windows kept once."""
    rng = random.Random(4)
    texts = [" ".join(f"{rng.randrange(10**6):x}" for _ in range(200)) for _ in range(1_000)]
    texts += ["the same words " * 5_000] * 3
    items = pa.table({"item": [str(i) for i in range(len(texts))], "text": texts})
    (table,) = decontaminate.tables(items, 10)
    assert len(table.first) == 1_000 * 191 + 3 and len(table.items) == 1_000 * 191 + 9
    assert len(pickle.dumps(table, protocol=5)) < 10 * sum(map(len, texts)) + (4 << 20)


# --- rules -----------------------------------------------------------------


def test_rules_equal_brute_force(rows):
    rng = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "xa.com", "net", "a.net"]
    paths = ["", "/", "/e", "/en/", "/en/x", "/en/x/", "/enx/"]
    rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(14)]
    urls = [f"http://{h.upper() if i % 3 else h}{p}{q}" for i, (h, p, q) in enumerate((h, p, q) for h in hosts for p in paths for q in ("", "?/en/", "#x"))]
    pages = rows("page_id int, url string", *enumerate([*urls, "x", "://", "http://", "a://b://c/"]))
    out = url_rules.judged(pages, rows("host string, path string, action string", *rules)).collect()
    for r in out:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r.url)
        host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
        fit = [(len(h + p), a == "block", len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, key=lambda x: x[:3]) if fit else (0, 0, 0, None, "allow")
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[3], best[4]), r
