"""Connected components of links between ids, by union-find and alternating star contractions.

Each task first joins its own links with union-find and keeps a spanning forest, which has no more links than
ids. The forests are then contracted: every id is linked to the least id among its neighbours, from the larger
side and from the smaller side in turn, until all links of a component meet in its least id. So it goes at every
size; no task holds more than ``FLUSH`` ids. An id with very many links is reduced by partial aggregation, and
its least neighbour is written before the join that brings it back, so that adaptive execution can split the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized
from .common import stored

FLUSH = 200_000  # ids that a task's union-find holds at once


class UnionFind(dict):
    def find(self, x):
        root = x
        while self.get(root, root) != root:
            root = self[root]
        while self.get(x, x) != root:
            self[x], x = root, self[x]
        return root

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)
        self.setdefault(min(a, b), min(a, b))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = UnionFind()

    def out() -> pa.RecordBatch:
        pairs = [(x, held.find(x)) for x in held]
        pairs = [(x, r) for x, r in pairs if x != r]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.join(a, b)
        if len(held) > FLUSH:
            yield out()
            held = UnionFind()
    yield out()


def components(links: DataFrame) -> DataFrame:
    """(id, component): each id that has a link, with the least id it is connected to. ``links``: a, b bigint."""
    edges = stored(links.select("a", "b").mapInArrow(_forest, "a bigint, b bigint"), "forest")
    edges = _contracted(edges, _digest(edges))
    roots = edges.select(F.col("b").alias("a"), "b").distinct()
    return edges.union(roots).select(F.col("a").alias("id"), F.col("b").alias("component"))


def _contracted(edges: DataFrame, size: tuple) -> DataFrame:
    """(id, least id of its component), for all ids but the least ones."""
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sized(stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least"), "least")
        larger = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = stored(larger.union(least.filter("m < a").select("a", F.col("m").alias("b"))).distinct(), "large")
        least = sized(stored(larger.groupBy("a").agg(F.min("b").alias("m")), "least"), "least")
        smaller = larger.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(smaller.union(least.select("a", F.col("m").alias("b"))).distinct(), "small")
        size, before = _digest(edges), size
        if size == before:
            return edges


def _digest(edges: DataFrame) -> tuple:
    """Number of links and a sum over them that changes with any of them."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
