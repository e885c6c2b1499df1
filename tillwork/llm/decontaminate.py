"""Benchmark passages in documents, by Wu-Manber search over words.

The patterns are the windows of ``size`` consecutive words of the benchmark items; an item of
fewer words, but not none, is one window. For patterns of one length, a table over blocks of two words
says how far the search may move on from a place whose last block is this one: as far as no
pattern could end in between. Where it may not move, the block picks a bucket of patterns that
end with it, the hash of the whole window picks the pattern in the bucket, and the words are
compared as bytes. Patterns are kept as places in the items' words, in arrays, not as texts of their own.

The search walks all texts of a block in step: each stretch of a text has a pointer, and each
round looks up one block per pointer. Documents are never shuffled; matches come back as spans.
The items are read in blocks of at most about ``ITEM_BYTES`` of text, whatever ids they have, each of which becomes one
broadcast search table and one pass over the rows of a task, so that no table grows with the benchmark. A worker loads a
table once, not for each task.

Defined cases: a null or wordless text has no words and no spans; items with null id, null text or
no words are no patterns; equal windows of several items count for each; an empty item table
finds nothing; repeated rows stay; other columns pass through, but ``n_words`` and ``spans`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import content, extended, own_columns, plus, stored, unboxed, with_content

ITEM_BYTES = 8 * 1024 * 1024
STRETCH = 256  # window ends that one pointer walks over
COMPARED = 1 << 15  # windows that are compared with their patterns at a time
SPAN = "array<struct<item:string,first:int,words:int>>"


@dataclass
class Words:
    """The words of a block of items as bytes, with the items' names."""

    data: np.ndarray
    start: np.ndarray  # byte place of each word
    length: np.ndarray
    names: list[str]


class Table:
    """Shift table and buckets for the patterns of one length: stretches of the items' words, each kept as its first word's place."""

    def __init__(self, words: Words, h: np.ndarray, item: np.ndarray, firsts: np.ndarray, size: int):
        self.words, self.size = words, size
        self.block = min(2, size)
        whole = self.rolled(h, firsts)
        order = np.lexsort((item[firsts], whole))  # equal windows side by side, by item
        firsts, whole = firsts[order], whole[order]
        equal = whole[1:] == whole[:-1]
        for k in range(size):
            equal &= h[firsts[1:] + k] == h[firsts[:-1] + k]
        fresh = np.concatenate([[True], ~equal])
        of = item[firsts]
        other = fresh | np.concatenate([[True], of[1:] != of[:-1]])
        firsts, whole, n = firsts[fresh], whole[fresh], int(fresh.sum())
        self.items = of[other].astype(np.int32)
        self.owned = np.searchsorted((np.cumsum(fresh) - 1)[other], np.arange(n + 1))  # a pattern's first of the items
        bits = max(12, min(20, (n * size).bit_length() + 2))
        self.mask = W.U((1 << bits) - 1)
        self.shift = np.full(1 << bits, size - self.block + 1, dtype=np.int16)
        for end in range(self.block, size + 1):  # the block that ends at this word; the least shift is written last
            self.shift[(self.key(h, firsts + end - 1) & self.mask).astype(np.int64)] = size - end
        bucket = self.key(h, firsts + size - 1) ^ W.mix(whole)
        order = np.argsort(bucket, kind="stable")
        self.bucket, self.order, self.first = bucket[order], order.astype(np.int32), firsts

    def key(self, h: np.ndarray, last: np.ndarray) -> np.ndarray:
        return h[last] if self.block == 1 else W.mix(h[last - 1] * W.U(W.BASE) + h[last])

    def rolled(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first), dtype=W.U)
        for k in range(self.size):
            out = W.mix(out * W.U(W.BASE) + h[first + k])
        return out

    def search(self, block: W.Block) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of every window that is a pattern, before the words are compared."""
        none = np.zeros(0, dtype=np.int64)
        begin, end = block.begins[:-1] + self.size - 1, block.begins[1:]
        n = np.maximum(0, -(-(end - begin) // STRETCH))
        lane = np.repeat(begin, n) + STRETCH * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        stop = np.minimum(lane + STRETCH, np.repeat(end, n))
        h, stopped = block.hash, []
        while len(lane):
            move = self.shift[(self.key(h, lane) & self.mask).astype(np.int64)]
            stopped.append(lane[move == 0])
            lane = lane + np.maximum(move, 1)
            on = lane < stop
            lane, stop = lane[on], stop[on]
        at = np.sort(np.concatenate(stopped)) if stopped else none
        if not len(at):
            return none, none
        first = at - self.size + 1
        wanted = self.key(h, at) ^ W.mix(self.rolled(h, first))
        low, high = np.searchsorted(self.bucket, wanted), np.searchsorted(self.bucket, wanted, side="right")
        n = high - low
        where = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(first, n), self.order[where]

    def equal(self, block: W.Block, first: np.ndarray, pattern: np.ndarray) -> np.ndarray:
        """Whether the words from each first word on are those of its pattern, byte by byte."""
        run = np.arange(self.size)
        here, there = first[:, None] + run, self.first[pattern][:, None] + run
        length = block.end[here] - block.start[here]
        same = (length == self.words.length[there]).all(axis=1)
        if not same.any():
            return same
        length = length[same].ravel()
        ramp = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        mine = block.data[np.repeat(block.start[here[same]].ravel(), length) + ramp]
        theirs = self.words.data[np.repeat(self.words.start[there[same]].ravel(), length) + ramp]
        windows = np.concatenate([[0], np.cumsum(length.reshape(-1, self.size).sum(axis=1))[:-1]])
        same[same] = np.logical_and.reduceat(mine == theirs, windows)
        return same

    def confirmed(self, block: W.Block) -> Iterator[tuple[int, int, list[str]]]:
        """(text, first word in it, items) of every window whose words equal a pattern's."""
        firsts, patterns = self.search(block)
        for low in range(0, len(firsts), COMPARED):
            first, pattern = firsts[low : low + COMPARED], patterns[low : low + COMPARED]
            same = self.equal(block, first, pattern)
            first, pattern = first[same], pattern[same]
            doc = block.doc[first]
            found = zip(doc.tolist(), (first - block.begins[doc]).tolist(), self.owned[pattern].tolist(), self.owned[pattern + 1].tolist())
            for text, at, begin, end in found:
                yield text, at, [self.words.names[i] for i in self.items[begin:end]]


def tables(items: pa.Table, size: int) -> list[Table]:
    """Search tables of the items (columns ``item``, ``text``), one for each length of window."""
    names = items.column("item").to_pylist()
    data, start, end, h, item = [], [], [], [], []
    upto = 0
    for block in W.blocks(items.column("text"), W.NOT_ALNUM):
        data.append(block.data)
        start.append(block.start + upto)
        end.append(block.end + upto)
        h.append(block.hash)
        item.append(block.doc + block.first)
        upto += len(block.data)
    if not sum(map(len, h)):
        return []
    start, h, item = np.concatenate(start), np.concatenate(h), np.concatenate(item)
    words = Words(np.concatenate(data), start, (np.concatenate(end) - start).astype(np.int32), names)
    counts = np.bincount(item, minlength=len(names))
    begins = np.cumsum(counts) - counts
    out = []
    for n in np.unique(np.minimum(counts, size)).tolist():
        if n == size:
            at = np.arange(len(h) - size + 1)
            firsts = at[item[at] == item[at + size - 1]]
        else:
            firsts = begins[counts == n]
        if n:
            out.append(Table(words, h, item, firsts, n))
    return out


def spans_in(texts: pa.Array, searched: list[Table], before: list[list[dict]] | None = None) -> tuple[list[int], list[list[dict]]]:
    """For each text its number of words, and its spans, with those found ``before``: stretches of words that windows of one item cover."""
    counts: list[int] = []
    spans: list[list[dict]] = []
    for block in W.blocks(texts, W.NOT_ALNUM):
        counts += block.counts().tolist()
        found: list[dict[str, set[tuple[int, int]]]] = [{} for _ in range(block.docs)]
        for doc, known in enumerate(before[block.first : block.last] if before else ()):
            for span in known:
                found[doc].setdefault(span["item"], set()).add((span["first"], span["first"] + span["words"]))
        for table in searched:
            for doc, first, items in table.confirmed(block):
                for item in items:
                    found[doc].setdefault(item, set()).add((first, first + table.size))
        spans += [merged(of) for of in found]
    return counts, spans


def merged(found: dict[str, set[tuple[int, int]]]) -> list[dict]:
    out = []
    for item in sorted(found):
        upto = None
        for first, end in sorted(found[item]):
            if upto is not None and first <= upto:
                upto = max(upto, end)
                out[-1]["words"] = upto - out[-1]["first"]
            else:
                out.append({"item": item, "first": first, "words": end - first})
                upto = end
    return out


def occurrences(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = 10,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all by default) with ``n_words`` (bigint) and ``spans``: (item, first word from 0, number of words)."""
    spark = docs.sparkSession
    known = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")).dropna().distinct()
    known = stored(known, "items")
    total = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-int(total) // ITEM_BYTES))
    own = own_columns(docs, keep, ["n_words", "spans"])
    rows = with_content(docs, own, text, _words=F.lit(0).cast("bigint"), _spans=F.array().cast(SPAN))
    for part in range(parts):
        block = known.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).toArrow()
        packed = spark.sparkContext.broadcast(tables(block, size))
        rows = rows.mapInArrow(_pass(packed, own, text, last=part == parts - 1), plus(rows) if part == parts - 1 else rows.schema)
    return unboxed(rows, own, F.col("_words").alias("n_words"), F.col("_spans").alias("spans"))


def _pass(packed, own: list[str], text: str, last: bool):
    """Adds what one table finds; the text beside the rows goes with the last pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = packed.value  # loaded once by each worker
        for batch in batches:
            counts, spans = spans_in(content(batch, own, text), searched, batch.column("_spans").to_pylist())
            found = {"_words": pa.array(counts, pa.int64()), "_spans": pa.array(spans, batch.schema.field("_spans").type)}
            beside = {} if last or text in own else {"_content": batch.column("_content")}
            yield extended(batch, **found, **beside).select([n for n in batch.schema.names if n in found or n in beside or n == "_row"])

    return run


def words_hit(spans: Column | str) -> Column:
    """Number of different words that the spans cover."""
    spans = F.array_sort(F.transform(spans, lambda s: F.struct(s["first"].alias("first"), (s["first"] + s["words"]).alias("end"))))
    nothing = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("n"))

    def add(state, span):
        new = F.greatest(F.lit(0), span["end"] - F.greatest(state["upto"], span["first"]))
        return F.struct(F.greatest(state["upto"], span["end"]).alias("upto"), (state["n"] + new).alias("n"))

    return F.aggregate(spans, nothing, add, lambda s: s["n"])


def items_hit(spans: Column | str) -> Column:
    """The ids of the items in the spans, sorted as strings."""
    return F.sort_array(F.array_distinct(F.transform(spans, lambda s: s["item"])))
