"""Near duplicates: SuperMinHash bands, verification on full sets, union-find groups.

A document's set holds the hashes of its distinct runs of ``shingle`` words; with fewer words, its whole
sequence is the one element. Two documents are linked if 100 * |intersection| >= 100 * similarity * |union|.

1. Equal sets form classes by digest; only the document with the least key of each class goes on.
2. Documents that share a band of their signatures share a bucket. With 32 bands of 4 places a pair of
   similarity 0.8 shares none once in 20 million pairs.
   What is joined with buckets, centres or documents is written first: a small table is broadcast by its measured size, and
   beside a large one Spark can split a hot bucket.
3. In each bucket a centre is compared with all others: stars, not pairs. Pairs are verified on the
   full sets, dealt out by centre and by blocks of its partners, so that a centre's set travels once per block.
   Linked documents form components.
4. What is still undecided are members of different components in one bucket. Blocks of members meet, each pair in
   the first of its common buckets only, and a signature whose estimate is clearly below the threshold rules a pair out. Members
   with any pair left meet again with their full sets, and similar pairs are joined there; pairs that are joined by
   then are not looked at. So every pair in a bucket is connected, verified, or far below the threshold by its
   signature; no bucket is capped, and no task hands on pairs but those that join components.

Defined cases: null, empty and wordless texts have no set and are linked with nothing; a null key is linked with
nothing and has no component; rows of one key are one document with several texts: a link of any of them links it;
repeated rows stay, each with the same component; an empty table gives an empty result; other columns pass
through, but columns with the names of the results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import keep_first, sized
from . import minhash, words
from .common import stored
from .components import UnionFind, components

BLOCK = 256  # partners of a centre that are compared with it at once
MEMBERS, ELEMENTS = 2_048, 1 << 21  # members of a bucket, and elements of their sets, that make a block
# five standard deviations of the estimate at a similarity of 0.8
SLACK = 0.17


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first text, sorted distinct element hashes of each text) in blocks."""
    for block in words.blocks(texts, words.WHITE):
        doc, h = words.windows(block, size)
        cut = np.searchsorted(doc, np.arange(block.docs + 1)).tolist()
        yield block.first, [np.unique(h[a:b]) for a, b in zip(cut, cut[1:])]


def sketches(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, n_shingles, digest of the set, signature, bands); without words the last three are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column(1), size):
                n = np.array([len(s) for s in sets], dtype=np.int64)
                signature = minhash.signatures(np.concatenate(sets), np.repeat(np.arange(len(sets)), n), len(sets))
                short = (signature & words.U(0xFFFF)).astype("<u2")
                buckets = minhash.bands(signature)
                some = n > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        pa.array(n),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([x.tobytes() if ok else None for x, ok in zip(short, some)], pa.binary()),
                        pa.array([x if ok else None for x, ok in zip(buckets, some)], pa.list_(pa.int64())),
                    ],
                    names=["key", "n_shingles", "digest", "signature", "bands"],
                )

    slim = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(run, "key bigint, n_shingles bigint, digest binary, signature binary, bands array<bigint>")


def full_sets(docs: DataFrame, key: str, text: str, size: int, ids: DataFrame) -> DataFrame:
    """(key, elements) of the documents in ``ids``, which a measured broadcast keeps from shuffling the texts if they are few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column(1), size):
                packed = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), packed], names=["key", "elements"])

    slim = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return slim.join(sized(stored(ids, "ids"), "ids"), "key", "left_semi").mapInArrow(run, "key bigint, elements binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, centres = None, []
        for batch in batches:
            a, b = [], []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for centre, part, member, elements in zip(*columns):
                s = np.frombuffer(elements, dtype=words.U)
                if (centre, part) != group:
                    group, centres = (centre, part), []
                if member is None:
                    centres.append(s)
                elif any(similar(c, s, percent) for c in centres):
                    a.append(centre)
                    b.append(member)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    counts = stored(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts")).filter("parts > 1"), "parts")
    of = pairs.join(sized(counts, "parts"), "a", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = of.select("a", F.pmod(F.xxhash64("b"), "parts").alias("part"), "b")
    members = dealt.join(sets, dealt.b == sets.key).select("a", "part", "b", "elements")
    heads = dealt.select("a", "part").distinct().join(sets, F.col("a") == sets.key)
    heads = heads.select("a", "part", F.lit(None).cast("bigint").alias("b"), "elements")
    # the centre's rows come first in each group
    ordered = members.union(heads).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return ordered.mapInArrow(run, "a bigint, b bigint").distinct()


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * |intersection| >= percent * |union| of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < percent * len(y):
        return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int(np.count_nonzero(y[at] == x))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _sizes_fit(n: str, m: str, percent: int):
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _open(members: DataFrame, linked: DataFrame) -> DataFrame:
    """Members of buckets that hold several groups, with their group."""
    groups = sized(components(linked), "groups")
    labelled = members.join(groups, members.node == groups.id, "left").drop("id")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    sums = [F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("elements")]
    # a bucket of two has been compared as a star
    mixed = labelled.groupBy("bucket").agg(*sums).filter("x <> y and size > 2").select("bucket", "size", "elements")
    return labelled.join(sized(stored(mixed, "mixed"), "mixed"), "bucket")


KEYS = ("bucket", "p", "q")


def _spread(open_members: DataFrame) -> DataFrame:
    """Members of a bucket in blocks, and each pair of blocks as a group: (bucket, p, q), ``second`` for those of block q."""
    parts = F.greatest(F.ceil(F.col("size") / MEMBERS), F.ceil(F.col("elements") / ELEMENTS)).cast("int")
    placed = open_members.withColumns({"_parts": parts, "_own": F.pmod(F.xxhash64("node"), parts).cast("int")})
    other = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    return placed.withColumn("_other", other).select(
        "bucket",
        F.least("_own", "_other").alias("p"),
        F.greatest("_own", "_other").alias("q"),
        (F.col("_own") > F.col("_other")).alias("second"),
        "node",
        "n",
        "component",
        "signature",
        "bands",
    )


def _arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray | list]:
    """The columns of a batch as arrays, signatures and bands as matrices."""
    out = {name: np.asarray(batch.column(name)) for name in (*KEYS, "second", "node", "n", "component") if name in batch.schema.names}
    out["signature"] = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype="<u2").reshape(batch.num_rows, -1)
    out["bands"] = np.asarray(batch.column("bands").flatten()).reshape(batch.num_rows, -1)
    if "elements" in batch.schema.names:
        out["elements"] = [np.frombuffer(e, dtype=words.U) for e in batch.column("elements").to_pylist()]
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Runs of rows with equal (bucket, p, q); a run may go over several batches."""
    held, of = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _arrays(batch)
        key = np.stack([rows[k].astype(np.int64) for k in KEYS])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            part, at = {k: v[start:end] for k, v in rows.items()}, tuple(key[:, start].tolist())
            if at == of:
                held = {k: held[k] + v if isinstance(v, list) else np.concatenate([held[k], v]) for k, v in part.items()}
            else:
                if held is not None:
                    yield held
                held, of = part, at
    if held is not None:
        yield held


def _candidates(rows: dict, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(member, partners, estimates): pairs of a group that may be similar and belong to no common component.

    A pair is looked at in the first of its common buckets only.
    """
    n, group, second = rows["n"], rows["component"], rows["second"]
    across = rows["p"][0] != rows["q"][0]
    place = np.arange(len(n))
    for i in range(len(n)):
        if across and second[i]:
            continue
        with_i = (group != group[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
        with_i &= second if across else place > i
        at = np.flatnonzero(with_i)
        if not len(at):
            continue
        common = rows["bands"][at] == rows["bands"][i]
        first = rows["bands"][i][common.argmax(axis=1)] == rows["bucket"][0]
        at = at[first]
        estimate = (rows["signature"][at] == rows["signature"][i]).mean(axis=1) if len(at) else np.zeros(0)
        near = estimate >= percent / 100 - SLACK
        if near.any():
            yield i, at[near], estimate[near]


def _undecided(open_members: DataFrame, percent: int) -> DataFrame:
    """The members of each group that have a candidate in it; pairs are not handed on."""
    spread = _spread(open_members)
    names = spread.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            wanted = np.zeros(len(rows["node"]), dtype=bool)
            for i, at, _ in _candidates(rows, percent):
                wanted[i] = wanted[at] = True
            keep = np.flatnonzero(wanted)
            if len(keep):
                columns = [pa.array(rows[k][keep]) for k in (*KEYS, "second", "node", "n", "component")]
                signature = pa.array([rows["signature"][i].tobytes() for i in keep], pa.binary())
                flat = pa.array(rows["bands"][keep].ravel())
                size = rows["bands"].shape[1]
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, size, dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays([*columns, signature, bands], names=names)

    ordered = spread.repartition(*KEYS).sortWithinPartitions(*KEYS)
    return ordered.mapInArrow(run, spread.schema)


def _settled(undecided: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join what similar members of each group belong to: a forest, not all similar pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            joined, a, b = UnionFind(), [], []
            for i, at, estimate in _candidates(rows, percent):
                for j in at[np.argsort(-estimate, kind="stable")].tolist():
                    x, y = int(rows["component"][i]), int(rows["component"][j])
                    if joined.find(x) != joined.find(y) and similar(rows["elements"][i], rows["elements"][j], percent):
                        joined.join(x, y)
                        a.append(int(rows["node"][i]))
                        b.append(int(rows["node"][j]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    whole = undecided.join(sets.withColumnRenamed("key", "node"), "node").select(*undecided.columns, "elements")
    ordered = whole.repartition(*KEYS).sortWithinPartitions(*KEYS, "node")
    return ordered.mapInArrow(run, "a bigint, b bigint")


def grouped(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): ``rows`` has key, n_shingles, digest for every row; ``groups`` has digest, component for every set."""
    sketch = stored(sketches(docs, key, text, shingle), "sketches")
    nodes = stored(keep_first(sketch.filter("digest is not null and key is not null"), ["digest"], ["key"]), "nodes")
    signed = nodes.select(F.col("key").alias("node"), F.col("n_shingles").alias("n"), "signature", "bands")
    buckets = nodes.select(F.explode("bands").alias("bucket"), F.col("key").alias("node"), F.col("n_shingles").alias("n"))
    # any member can be the first centre; a hash picks others in other bands
    first = F.min(F.struct(F.xxhash64("node", "bucket").alias("h"), F.col("node").alias("centre"), F.col("n").alias("m")))
    heads = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("_size"), first.alias("_head")).filter("_size > 1")
    heads = sized(stored(heads, "heads"), "heads")
    members = stored(buckets.join(heads, "bucket").select("bucket", "node", "n", "_head.centre", "_head.m"), "members")
    sets = stored(full_sets(docs, key, text, shingle, members.select(F.col("node").alias("key")).distinct()), "sets")

    star = members.filter((F.col("node") != F.col("centre")) & _sizes_fit("n", "m", percent))
    pairs = star.select(F.col("centre").alias("a"), F.col("node").alias("b"))
    linked = stored(verified(stored(pairs.distinct(), "pairs"), sets, percent), "linked")

    undecided = stored(_undecided(_open(members, linked).join(signed, ["node", "n"]), percent), "undecided")
    linked = linked.union(stored(_settled(undecided, sets, percent), "settled"))

    # a key that stands for several sets brings their classes together
    classes = nodes.select("digest", F.col("key").alias("node"))
    of_key = sketch.filter("digest is not null and key is not null").select("digest", "key").distinct()
    several = of_key.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    same = of_key.join(several, "key").join(classes, "digest").select(F.col("key").alias("a"), F.col("node").alias("b"))
    final = stored(components(linked.union(same.filter("a <> b"))), "components")
    groups = classes.join(final, classes.node == final.id, "left").select("digest", F.coalesce("component", "node").alias("component"))
    return sketch.select("key", "n_shingles", "digest"), groups


def with_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row."""
    rows, groups = grouped(docs, key, text, shingle, percent)
    out = rows.join(groups, "digest", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return out.select(
        F.col("key").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(True)).alias("kept")
    )
