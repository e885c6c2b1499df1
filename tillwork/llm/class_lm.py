"""Scores of texts under a Brown class-based bigram model, learned from the corpus.

P(word | word before) = P(class | class before) * P(word | class). Each text is its words and then one
end token; the text before the first word counts as an end.

Every word that recurs in the training rows has a class of its own choice. Words that occur once share one fixed
class, as they tell how often unseen words come; the end is another.

Learning counts all words first; the counts stay a distributed table. The ``FREQUENT`` commonest words go to the tasks as one
broadcast, which decides only where their pairs are counted. A start comes from exchange clustering in the driver, over items: the ``CORE``
commonest words one by one, the other frequent words in blocks of neighbouring ranks, each item in turn moving to the class that
raises the likelihood of the pairs most, until a sweep moves none. Then the texts are written once as ranks, and words are exchanged in
distributed sweeps, in two steps. First the frequent words, by their sums over the neighbours' classes, while the rarer words stand together. Then
every rarer word that recurs: of it a table keeps how often it stands before and after each class of frequent words, and beside rarer
words, at most 68 numbers however often the word occurs; by these each chooses its best class against the matrix of classes by classes. The
pairs of two rarer words are another table, which meets the chosen classes once, so that the final matrix counts every pair of tokens
by its two classes. The sweeps over the frequent words, in each of which one half chooses, end when a sweep of each half together gains less than
``LEAST_GAIN`` a token.

Class transitions are smoothed by the classes' shares. Words of a class have their share of its
tokens. The class of the words that occur once also holds all words never seen. Their number and their mass follow from the counts of
words that occur once and twice (Good and Turing): ``2 * twice / once`` is what a word that occurred once is expected to
occur, the rest of its token goes to the words never seen, and these are estimated to be so many that each has the probability of one that
occurred once. So the probabilities of all words, seen or not, add up to one after any word, and an invented word costs no less than any word of the texts does.

Scoring adds up on the map side what frequent words and the transitions between them give, and joins only the rarer words of
each text, and pairs of them, with the counts and classes, by their hash. None of them is frequent enough to make a hot key. Words are
identified by 64-bit hashes, which collide with a chance of about 2^-60 a pair.

Defined cases: null, empty and wordless texts are the end token alone; without training rows every word is unseen and
the scores are those of a uniform model; repeated rows are scored each; ties in frequency go by hash; only the
key passes through.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import discard, stored

FREQUENT = 65_536
LEAST = 2  # words that occur once are rare ones at any size: they tell how often unseen words come
CORE = 960
BLOCK = 1_024  # ranks of the frequent words beyond the core that share an item
CLASSES = 32
LEAST_GAIN = 0.005  # nats a token
WORDS_AT_ONCE = 4_096
WIDTH = 2 * (CLASSES + 2) + 1  # sums of a frequent word
KEPT = (0.05, 0.95)  # bounds of what a word that occurred once is expected to occur
WIDER = 20.0  # weight of the classes' shares in a transition
HELD_TOKENS = 1 << 23  # tokens that a task counts before it hands on the sums
END = np.uint64(0x456E64206F662074)  # stands for the end in the counts


class Lookup:
    """Rank of each frequent word by its hash; -1 for others."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes, kind="stable")
        self.sorted = np.append(hashes[self.order], W.NONE_ABOVE) if len(hashes) else np.array([W.NONE_ABOVE])
        self.first = np.searchsorted(self.sorted, np.arange((1 << 18) + 1, dtype=W.U) << W.U(46))
        self.deepest = int(np.diff(self.first).max(initial=0)) + 1

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = self.first[(h >> W.U(46)).astype(np.int64)]
        out = np.full(len(h), -1, dtype=np.int64)
        for _ in range(self.deepest):
            hit = self.sorted[at] == h
            hit &= at < len(self.order)
            out[hit] = self.order[at[hit]]
            at = np.minimum(at + 1, len(self.sorted) - 1)
        return out


def _tokens(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of all tokens of a block, each text's end after its words."""
    n = block.counts() + 1
    ends = np.cumsum(n) - 1
    h = np.empty(int(n.sum()), dtype=W.U)
    word = np.ones(len(h), dtype=bool)
    word[ends] = False
    h[word], h[ends] = block.hash, END
    return np.repeat(np.arange(block.docs), n), h


def counted(texts: DataFrame) -> DataFrame:
    """(h, c): how often each token occurs in the texts (one column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def sums() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

        for batch in batches:
            for block in W.blocks(batch.column(0), W.WHITE):
                held.append(_tokens(block)[1])
                n += len(held[-1])
                if n >= HELD_TOKENS:
                    yield sums()
                    held, n = [], 0
        if held:
            yield sums()

    return texts.mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    hashes: np.ndarray  # of the frequent words, by rank
    counts: np.ndarray
    item: np.ndarray  # of the frequent words, by rank: each is one
    group: np.ndarray  # class of each item; the last two items are the rare words and the end
    tokens: np.ndarray  # of each class
    total: int  # N
    distinct: int  # V, the end included
    ends: int  # how often the end occurs
    step: np.ndarray  # log10 P(class | class before)
    emit: np.ndarray  # log10 P(word | class) of the frequent words, by rank
    rare: float  # words that occur once, and their tokens
    kept: float  # what such a word is expected to occur
    unseen: float  # estimated number of words never seen

    @property
    def items(self) -> int:
        return len(self.group)


def learned(texts: DataFrame, seen: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the texts, and (h, k): the classes of the recurring words that are not frequent. ``seen``: the texts' token counts."""
    spark = texts.sparkSession
    end = np.int64(END.view(np.int64))
    total, distinct, ends, once, twice = seen.agg(
        F.coalesce(F.sum("c"), F.lit(0)),
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.when(F.col("h") == int(end), F.col("c"))), F.lit(0)),
        F.count(F.when((F.col("h") != int(end)) & (F.col("c") < LEAST), 1)),
        F.count(F.when((F.col("h") != int(end)) & (F.col("c") == LEAST), 1)),
    ).first()
    top = seen.filter((F.col("h") != int(end)) & (F.col("c") >= LEAST)).orderBy(F.desc("c"), "h").limit(FREQUENT).toArrow()
    hashes, counts = top.column("h").to_numpy().astype(np.int64).view(W.U), top.column("c").to_numpy().astype(np.int64)
    rank = np.arange(len(hashes))
    item = np.where(rank < CORE, rank, min(CORE, len(rank)) + (rank - CORE) // BLOCK)
    items = (int(item.max()) + 1 if len(item) else 0) + 2
    packed = spark.sparkContext.broadcast(pickle.dumps(hashes))
    coded = stored(texts.mapInArrow(_coded(packed), "codes array<int>, rare array<bigint>"), "coded")
    packed.destroy()
    of_codes = np.concatenate([item, [items - 2, items - 1]]).astype(np.int64)
    kinds = spark.sparkContext.broadcast(pickle.dumps((of_codes, items)))
    sums = coded.select("codes").mapInArrow(_pair_counts(kinds), "pair bigint, c bigint").groupBy("pair").agg(F.sum("c").alias("c"))
    start = exchanged(_filled(sums, items * items, "pair").reshape(items, items), CLASSES)
    kinds.destroy()
    group = np.concatenate([start[item] if len(item) else np.zeros(0, np.int64), [CLASSES, CLASSES + 1]]).astype(np.int64)
    group, classes, between = _swept(coded, hashes, group, seen)
    discard(coded)
    return _model(between, group, hashes, counts, total, distinct, ends, float(once), float(twice)), classes


def _filled(sums: DataFrame, size: int, key: str) -> np.ndarray:
    table, out = sums.toArrow(), np.zeros(size)
    out[table.column(key).to_numpy().astype(np.int64)] = table.column("c").to_numpy()
    return out


def _pair_counts(packed):
    """(pair, c): how often the item of one code comes before that of another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, items = pickle.loads(packed.value)
        total = np.zeros(items * items, dtype=np.int64)
        for batch in batches:
            before, code = _after_ends(batch, len(item) - 2)
            total += np.bincount(item[before] * items + item[code], minlength=items * items)
        yield _nonzero(total).rename_columns(["pair", "c"])

    return run


def _entropy(n: np.ndarray) -> np.ndarray:
    return n * np.log(np.maximum(n, 1))


def exchanged(pairs: np.ndarray, classes: int) -> np.ndarray:
    """The class of each item. The last two items are classes of their own: ``classes`` and ``classes + 1``."""
    items = len(pairs)
    free = items - 2
    group = np.concatenate([np.arange(free) % classes, [classes, classes + 1]])
    size = classes + 2
    onto = np.zeros((items, size))
    onto[np.arange(items), group] = 1
    between = onto.T @ pairs @ onto
    moved = 1
    while moved:
        moved = 0
        for w in range(free):
            old, own = group[w], pairs[w, w]
            out, into = pairs[w] @ onto, pairs[:, w] @ onto  # by class of the other item, w itself included
            out[old] -= own
            into[old] -= own
            # without w
            between[old] -= out
            between[:, old] -= into
            between[old, old] -= own
            gain = _gains(between, out, into, own)
            gain[classes:] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            between[new] += out
            between[:, new] += into
            between[new, new] += own
            if new != old:
                onto[w, old], onto[w, new] = 0, 1
                group[w] = new
                moved += 1
    return group


def _gains(between: np.ndarray, out: np.ndarray, into: np.ndarray, own: float) -> np.ndarray:
    """By class, what the likelihood of the pairs gains when the item joins it."""
    # whatever class the item joins, each class has its pairs with the item
    rows, columns = between.sum(axis=1) + into, between.sum(axis=0) + out
    joined_row = _entropy(between + out) - _entropy(between)  # row k with the item's pairs added
    joined_column = _entropy(between + into[:, None]) - _entropy(between)
    corner = np.diagonal(between)
    both = _entropy(corner + out + into + own) - _entropy(corner)
    gain = joined_row.sum(axis=1) - np.diagonal(joined_row) + joined_column.sum(axis=0) - np.diagonal(joined_column) + both
    gain -= _entropy(rows + out.sum() + own) - _entropy(rows)
    gain -= _entropy(columns + into.sum() + own) - _entropy(columns)
    return gain


def _code(rank: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """The rank of frequent words, ``n`` for rarer words, ``n + 1`` for the end."""
    code = np.where(rank >= 0, rank, n)
    code[h == END] = n + 1
    return code


def _coded(packed):
    """One row for each block of texts: the codes of its tokens, and the hashes of the rarer words among them in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(hashes := pickle.loads(packed.value))
        for batch in batches:
            for block in W.blocks(batch.column(0), W.WHITE):
                _, h = _tokens(block)
                code = _code(lookup(h), h, len(hashes))
                rare = h[code == len(hashes)].view(np.int64)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (pa.array(code.astype(np.int32)), pa.array(rare))]
                yield pa.RecordBatch.from_arrays(lists, names=["codes", "rare"])

    return run


def _after_ends(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a batch's tokens, and of the token before each; all blocks end with an end."""
    code = batch.column("codes").flatten().to_numpy().astype(np.int64)
    return np.concatenate(([n + 1], code[:-1])) if len(code) else code, code


def _beside(packed):
    """(h, slot, c): how often rarer words stand beside each class, rarer words being one; doubled, and one more where that comes before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pickle.loads(packed.value)
        n, held, size = len(group) - 2, [], 0

        def sums() -> pa.RecordBatch:
            word, slot = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((slot, word))
            word, slot = word[order], slot[order]
            first = np.flatnonzero(np.concatenate(([True], (word[1:] != word[:-1]) | (slot[1:] != slot[:-1])))) if len(word) else np.zeros(0, np.int64)
            c = np.diff(np.append(first, len(word)))
            return pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(slot[first].astype(np.int32)), pa.array(c)], names=["h", "slot", "c"])

        for batch in batches:
            before, code = _after_ends(batch, n)
            at, h = np.flatnonzero(code == n), batch.column("rare").flatten().to_numpy()
            for near, side in ((before[at], 1), (code[at + 1], 0)):  # every block ends with an end
                held.append((h, group[near] * 2 + side))
                size += len(h)
            if size >= HELD_TOKENS:
                yield sums()
                held, size = [], 0
        if held:
            yield sums()

    return run


def _rare_pairs(n: int):
    """(a, b) of neighbours that are both rarer words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, code = _after_ends(batch, n)
            second = (before == n)[code == n]  # of the rarer words, those after another
            h, at = batch.column("rare").flatten().to_numpy(), np.flatnonzero(second)
            yield pa.RecordBatch.from_arrays([pa.array(h[at - 1]), pa.array(h[at])], names=["a", "b"])

    return run


def _by_class(packed):
    """(part, sums): for ``WORDS_AT_ONCE`` codes a part, the pairs of each code by the class of its neighbour, that after it, then that
    before it; last its pairs with itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pickle.loads(packed.value)
        size, n = CLASSES + 2, len(group) - 2
        total = np.zeros(WIDTH * len(group), dtype=np.int64)
        for batch in batches:
            before, code = _after_ends(batch, n)
            places = before * WIDTH + group[code], code * WIDTH + size + group[before], code[before == code] * WIDTH + 2 * size
            total += np.bincount(np.concatenate(places), minlength=len(total))
        width = WIDTH * WORDS_AT_ONCE
        yield from _parts({i: total[i * width : (i + 1) * width] for i in range(-(-len(total) // width))})

    return run


PART = "part bigint, kind string, sums binary"


def _parts(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The parts that are not all zero, each in the smallest numbers that hold it."""
    for part, sums in found.items():
        if most := int(sums.max(initial=0)):
            kind = "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<i8"
            columns = [pa.array([part], pa.int64()), pa.array([kind]), pa.array([sums.astype(kind).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "kind", "sums"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        for part, kind, sums in zip(batch.column("part").to_pylist(), batch.column("kind").to_pylist(), batch.column("sums")):
            yield part, np.frombuffer(sums.as_buffer(), dtype=kind)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts that come, one after another, added up; each is of a bounded size."""
    held: dict[int, np.ndarray] = {}
    for part, sums in _unpacked(batches):
        held[part] = held[part] + sums if part in held else sums.astype(np.int64)
    yield from _parts(held)


def _sums_by_class(coded: DataFrame, group: np.ndarray) -> DataFrame:
    """The sums of ``_by_class`` over all texts, as a written table of parts."""
    ours = coded.sparkSession.sparkContext.broadcast(pickle.dumps(group))
    parts = -(-len(group) // WORDS_AT_ONCE)
    summed = stored(coded.mapInArrow(_by_class(ours), PART).repartition(parts, "part").mapInArrow(_added, PART), "sums")
    ours.destroy()
    return summed


def _pairs_by_class(summed: DataFrame, group: np.ndarray) -> np.ndarray:
    """The matrix of classes by classes that the sums add up to."""
    size = CLASSES + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = np.zeros((size, size), dtype=np.int64)
        for part, sums in _unpacked(batches):
            sums = sums.reshape(-1, WIDTH)[:, :size].astype(np.int64)
            np.add.at(between, group[part * WORDS_AT_ONCE :][: len(sums)], sums)
        yield _nonzero(between.ravel())

    rows = summed.mapInArrow(run, "slot bigint, c bigint").groupBy("slot").agg(F.sum("c").alias("c"))
    return _filled(rows, size * size, "slot").reshape(size, size)


def _nonzero(total: np.ndarray) -> pa.RecordBatch:
    slot = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])], names=["slot", "c"])


def _placed_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, c): rarer words' tokens by their class and by what they stand beside."""
    size = CLASSES + 2
    total = np.zeros(size * 2 * size, dtype=np.int64)
    for batch in batches:
        slots, counts = (batch.column(x).flatten().to_numpy().astype(np.int64) for x in ("slots", "counts"))
        k = np.repeat(batch.column("k").to_numpy().astype(np.int64), batch.column("slots").value_lengths().to_numpy())
        np.add.at(total, k * 2 * size + slots, counts)
    yield _nonzero(total)


def _best(between: np.ndarray, out: np.ndarray, into: np.ndarray, own: np.ndarray, old: np.ndarray) -> np.ndarray:
    """The best class of each of many words: the gains of ``_gains``, each word taken out of its class ``old``, by its pairs only."""
    r, size = np.arange(len(old)), len(between)
    gain = np.zeros((len(old), size))
    for b, x, y in ((between, out, into), (between.T, into, out)):
        w, k = np.nonzero(x)
        n, was = x[w, k], old[w]
        base = b[:, k].T.copy()  # pairs of each class with k, without the word's
        e = np.arange(len(w))
        base[e, was] -= n
        same = k == was
        base[same] -= y[w[same]]
        base[e[same], was[same]] -= own[w[same]]
        more = _entropy(base + n[:, None]) - _entropy(base)
        more[e, k] = 0
        if len(w):
            first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            gain[w[first]] += np.add.reduceat(more, first, axis=0)
        sums = np.repeat(b.sum(axis=1)[None], len(old), axis=0)
        all_of = x.sum(axis=1) + own
        sums[r, old] -= all_of
        gain -= _entropy(sums + all_of[:, None]) - _entropy(sums)
    corner = np.repeat(np.diagonal(between)[None], len(old), axis=0)
    corner[r, old] -= out[r, old] + into[r, old] + own
    gain += _entropy(corner + out + into + own[:, None]) - _entropy(corner)
    gain[:, CLASSES:] = -np.inf
    best = gain.argmax(axis=1)
    return np.where(gain[r, best] > gain[r, old] + 1e-9, best, old)


def _chosen(packed, half: int):
    """(code, k): the new classes of the frequent words of one half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between, group = pickle.loads(packed.value)
        size = CLASSES + 2
        for part, sums in _unpacked(batches):
            sums = sums.reshape(-1, WIDTH)
            code = part * WORDS_AT_ONCE + np.arange(len(sums))
            ours = (code % 2 == half) & (code < len(group) - 2)
            code, sums = code[ours], sums[ours].astype(float)
            out, into, own = sums[:, :size].copy(), sums[:, size : 2 * size].copy(), sums[:, 2 * size]
            r, old = np.arange(len(code)), group[code]
            out[r, old] -= own
            into[r, old] -= own
            k = _best(between, out, into, own, old)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(k)], names=["code", "k"])

    return run


def _chosen_rare(packed):
    """The rarer words with the classes that they choose."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = pickle.loads(packed.value)
        size = CLASSES + 2
        for whole in batches:
            for first in range(0, whole.num_rows, WORDS_AT_ONCE):
                batch = whole.slice(first, WORDS_AT_ONCE)
                h, lists = batch.column("h").to_numpy(), batch.column("slots")
                word = np.repeat(np.arange(len(h)), lists.value_lengths().to_numpy())
                slot, c = lists.flatten().to_numpy().astype(np.int64), batch.column("counts").flatten().to_numpy()
                sums = np.zeros((len(h), 2, size))
                np.add.at(sums, (word, slot & 1, slot >> 1), c)
                k = _best(between, sums[:, 0], sums[:, 1], np.zeros(len(h)), np.full(len(h), CLASSES))
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(k), lists, batch.column("counts")], names=["h", "k", "slots", "counts"])

    return run


WORDS = "h bigint, k bigint, slots array<int>, counts array<bigint>"


def _lists(rows: DataFrame) -> DataFrame:
    """(h, slot, c) as two lists a word, one entry for each slot."""
    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(_listed, "h bigint, slots array<int>, counts array<bigint>")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come by word; what is held of a word that goes on in the next batch is one row for each slot."""
    held = tuple(np.zeros(0, np.int64) for _ in range(3))

    def summed(h: np.ndarray, slot: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((slot, h))
        h, slot, c = h[order], slot[order], c[order]
        first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (slot[1:] != slot[:-1]))))
        return h[first], slot[first], np.add.reduceat(c, first)

    def out(h: np.ndarray, slot: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        at = pa.array(np.append(first, len(h)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (slot.astype(np.int32), c)]
        return pa.RecordBatch.from_arrays([pa.array(h[first]), *lists], names=["h", "slots", "counts"])

    for batch in batches:
        rows = [np.concatenate([x, batch.column(i).to_numpy().astype(np.int64)]) for i, x in enumerate(held)]
        if not len(rows[0]):
            continue
        rows = summed(*rows)
        cut = int(np.searchsorted(rows[0], rows[0][-1]))
        held = tuple(x[cut:] for x in rows)
        if cut:
            yield out(*[x[:cut] for x in rows])
    if len(held[0]):
        yield out(*held)


def _swept(coded: DataFrame, hashes: np.ndarray, group: np.ndarray, seen: DataFrame) -> tuple[np.ndarray, DataFrame, np.ndarray]:
    """The classes of the codes, (h, k) of the rarer words that recur, and the pairs by classes, after sweeps over all words."""
    spark, n = coded.sparkSession, len(hashes)
    group, between = _frequent_swept(coded.select("codes"), group)
    ours = spark.sparkContext.broadcast(pickle.dumps(group))
    beside = _lists(coded.mapInArrow(_beside(ours), "h bigint, slot int, c bigint"))
    recurring = seen.filter((F.col("c") >= LEAST) & (F.col("h") != int(END.view(np.int64)))).select("h")
    state = spark.sparkContext.broadcast(pickle.dumps(between))
    # frequent words have no lists: texts hold them by their rank
    words = stored(beside.join(recurring, "h", "left_semi").mapInArrow(_chosen_rare(state), WORDS), "rarer")
    for sent in (ours, state):
        sent.destroy()
    pairs = coded.mapInArrow(_rare_pairs(n), "a bigint, b bigint").groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
    return group, words.select("h", "k"), _all_pairs_by_class(words, pairs, between)


def _all_pairs_by_class(words: DataFrame, pairs: DataFrame, lumped: np.ndarray) -> np.ndarray:
    """The matrix of classes by classes with every word in its own class. ``lumped``: the same while rarer words are one class."""
    size, once = CLASSES + 2, F.lit(CLASSES).cast("bigint")
    k = words.select("h", "k")
    classed = pairs.join(k.toDF("a", "ka"), "a", "left").join(k.toDF("b", "kb"), "b", "left")
    found = classed.groupBy(F.coalesce("ka", once).alias("ka"), F.coalesce("kb", once).alias("kb")).agg(F.sum("c").alias("c")).toArrow()
    ka, kb, c = (found.column(x).to_numpy().astype(np.int64) for x in ("ka", "kb", "c"))
    between = lumped.copy()
    between[CLASSES, CLASSES] -= c.sum()
    np.add.at(between, (ka, kb), c)
    beside = _filled(words.mapInArrow(_placed_sums, "slot bigint, c bigint").groupBy("slot").agg(F.sum("c").alias("c")), size * 2 * size, "slot")
    beside = beside.reshape(size, size, 2)  # own class, the other's, whether the other comes before
    beside[:, CLASSES] = 0  # pairs of two rarer words are counted above
    for matrix, moved in ((between, beside[:, :, 0]), (between.T, beside[:, :, 1])):
        matrix += moved
        matrix[CLASSES] -= moved.sum(axis=0)
    return between


def _likelihood(between: np.ndarray) -> float:
    return _entropy(between).sum() - _entropy(between.sum(axis=1)).sum() - _entropy(between.sum(axis=0)).sum()


def _settled(reached: list[float], tokens: float) -> bool:
    return len(reached) > 2 and reached[-1] - reached[-3] <= LEAST_GAIN * tokens


def _frequent_swept(coded: DataFrame, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes of the codes, and the pairs by classes, where all rarer words are one class."""
    spark, n = coded.sparkSession, len(group) - 2
    reached: list[float] = []
    while True:
        summed = _sums_by_class(coded, group)
        between = _pairs_by_class(summed, group)
        likelihood = _likelihood(between)
        worse = bool(reached) and likelihood < max(reached)
        if not worse:
            best = group, between
            reached.append(likelihood)
        if worse or not n or _settled(reached, between.sum()):
            discard(summed)
            return best
        state = spark.sparkContext.broadcast(pickle.dumps((between, group)))
        chosen = summed.mapInArrow(_chosen(state, len(reached) % 2), "code bigint, k bigint").toArrow()
        state.destroy()
        discard(summed)
        group = group.copy()
        group[chosen.column("code").to_numpy()] = chosen.column("k").to_numpy()


def _model(between, group, hashes, counts, total, distinct, ends, once, twice) -> Model:
    size = CLASSES + 2
    share = (between.sum(axis=0) + 1) / (between.sum() + size)
    step = np.log10((between + WIDER * share) / (between.sum(axis=1, keepdims=True) + WIDER))
    of, tokens = group[:-2], between.sum(axis=0)
    emit = np.log10(counts / tokens[of])
    kept = min(max(2 * twice / once, KEPT[0]), KEPT[1]) if once else KEPT[1]
    unseen = ((1 - kept) * once + 1) / kept  # one token more, so that they have a share without any text too
    return Model(hashes, counts, np.arange(len(hashes)), group, tokens, total, distinct, ends, step, emit, once, kept, unseen)


def scored(docs: DataFrame, model: Model, seen: DataFrame, key: str, text: str) -> DataFrame:
    """key, n_tokens, n_known, base_score, score and perplexity of every text."""
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    slots = float(model.total + model.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(packed.value)
        lookup, done = Lookup(m.hashes), 0
        base_of, base_of_end = np.log10((m.counts + 1) / slots), np.log10((m.ends + 1) / slots)
        for batch in batches:
            for block in W.blocks(batch.column(1), W.WHITE):
                doc, h = _tokens(block)
                rank = lookup(h)
                of = m.group[code := _code(rank, h, len(m.hashes))]
                before = np.concatenate(([m.group[-1]], of[:-1]))
                rare = code == len(m.hashes)
                after_rare = np.concatenate(([False], rare[:-1]))
                score, base = np.where(rare | after_rare, 0, m.step[before, of]), np.zeros(len(h))
                frequent = rank >= 0
                score[frequent] += m.emit[rank[frequent]]
                base[frequent] = base_of[rank[frequent]]
                closing = h == END
                base[closing] = base_of_end
                known = frequent | (closing & (m.ends > 0))
                # each rarer word of a text with the classes around it, -1 those of rarer words, and pairs of rarer words
                n = np.bincount(doc, minlength=block.docs)
                at, texts = np.flatnonzero(rare), np.arange(block.docs + 1)
                entries = pa.StructArray.from_arrays(
                    [
                        pa.array(h[at].view(np.int64)),
                        pa.array(np.where(after_rare[at], -1, before[at]).astype(np.int32)),
                        pa.array(np.where(rare[at + 1], -1, of[at + 1]).astype(np.int32)),
                    ],
                    names=["h", "before", "after"],
                )
                begin = np.searchsorted(doc[at], texts)
                second = np.flatnonzero(rare & after_rare)
                pairs = pa.StructArray.from_arrays([pa.array(h[second - 1].view(np.int64)), pa.array(h[second].view(np.int64))], names=["a", "b"])
                begin_pairs = np.searchsorted(doc[second], texts)
                row = (TaskContext.get().partitionId() << 33) + done + np.arange(block.docs)
                done += block.docs
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row),
                        batch.column(0).slice(block.first, block.docs),
                        pa.array(n.astype(np.int64)),
                        pa.array(np.bincount(doc, weights=known, minlength=block.docs).astype(np.int64)),
                        pa.array(np.bincount(doc, weights=base, minlength=block.docs)),
                        pa.array(np.bincount(doc, weights=score, minlength=block.docs)),
                        pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), entries),
                        pa.ListArray.from_arrays(pa.array(begin_pairs.astype(np.int32)), pairs),
                    ],
                    names=["row", "key", "n_tokens", "known", "base", "score", "rare", "pairs"],
                )

    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    sums = stored(
        slim.mapInArrow(
            run,
            f"row bigint, key {kind}, n_tokens bigint, known bigint, base double, score double, "
            "rare array<struct<h:bigint,before:int,after:int>>, pairs array<struct<a:bigint,b:bigint>>",
        ),
        "scores",
    )
    size, once = CLASSES + 2, F.lit(CLASSES)
    steps = F.array(*[F.lit(float(x)) for x in model.step.ravel()])
    step = lambda i, j: F.element_at(steps, (i * size + j + 1).cast("int"))
    tokens = F.array(*[F.lit(float(x)) for x in model.tokens])
    words = sums.select("row", F.explode("rare").alias("w")).select("row", "w.*")
    c, k = F.coalesce("c", F.lit(0)), F.coalesce("k", once)
    emission = F.when(F.col("k").isNotNull(), c / F.element_at(tokens, (k + 1).cast("int")))
    emission = emission.otherwise(F.lit(model.kept / (model.rare + 1)))
    steps_of = F.when(F.col("before") >= 0, step(F.col("before"), k)).otherwise(0) + F.when(F.col("after") >= 0, step(k, F.col("after"))).otherwise(0)
    of_words = words.join(seen, "h", "left").select("row", F.when(c > 0, 1).otherwise(0).alias("_known"), F.log10((c + 1) / F.lit(slots)).alias("_base"), (F.log10(emission) + steps_of).alias("_score"))
    classes = seen.filter("k is not null").select("h", "k")
    pairs = sums.select("row", F.explode("pairs").alias("p")).select("row", "p.*")
    pairs = pairs.join(classes.toDF("a", "ka"), "a", "left").join(classes.toDF("b", "kb"), "b", "left")
    of_pairs = pairs.select("row", F.lit(0), F.lit(0.0), step(F.coalesce("ka", once), F.coalesce("kb", once)))
    looked_up = of_words.union(of_pairs).groupBy("row").agg(F.sum("_known").alias("_known"), F.sum("_base").alias("_base"), F.sum("_score").alias("_score"))
    score = F.col("score") + F.coalesce("_score", F.lit(0.0))
    return sums.join(looked_up, "row", "left").select(
        F.col("key").alias(key),
        "n_tokens",
        (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )


def held_out(key: Column | str, of: int = 7, remainder: int = 2) -> Column:
    """Rows that are kept from training; a null key is not."""
    return F.crc32(F.coalesce(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), F.lit(""))) % of == remainder


def modelled(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[Model, DataFrame]:
    """(model, token counts) of the rows that are not held out; the counts come with the classes of rarer words."""
    training = docs.filter(~held_out(key)).select(text)
    seen = stored(counted(training), "words")
    model, classes = learned(training, seen)
    return model, stored(seen.join(classes, "h", "left"), "classed_words")
