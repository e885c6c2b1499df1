"""A Merkle manifest of a dataset: leaves by group, a subroot for each group, one root, and a proof for every row.

Rows of a group are ordered by key; every ``FAN`` consecutive nodes become their hash, until one is left, the
group's subroot. Subroots, ordered by group, become the root in the same way. A node is ``_at``-th of ``_of`` in its
group, so its run is ``_at div FAN``, its slot ``_at % FAN``, and the run's length follows from ``_of``. Per level,
``lag`` and ``lead`` columns of the fixed offsets 1 to FAN - 1, masked by slot and run length, hold a node's
siblings; the row of each run's first child hashes the parent. On the way back down each level's siblings are put
before the steps of the parent. Only digests and ids are shuffled; each level has an eighth of the rows of the one below, and
of a level only the rows of one run ever meet. The window's partitions are single runs, so that its
exchange also serves the join with the parents.

Places are exact without a sort in one task: rows are range-partitioned by group and key and written in order; a row's
place is its number in its own partition plus the rows of its group in earlier ones. Equal rows end by a row number, so that even
a row that fills a third of the table is split over partitions.

Defined cases: null columns hash as ``-`` and null keys come first; the null group is a group of its own and comes before
all others; rows of equal key go by leaf, and equal rows have equal proofs as far as they share siblings; a lone leaf is its
group's subroot; an empty table has no root and gives an empty result. Kept columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import sized
from .common import boxed, stored, unboxed

FAN = 8


def framed(column: Column) -> Column:
    """``-`` for null, else the value's UTF-8 bytes with their count and a colon before: no two rows frame alike."""
    text = column.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def row_digest(*columns: Column) -> Column:
    return digest(*[framed(c) for c in columns])


def proof_digest(steps: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(steps, leaf, lambda node, s: digest(s["left"], node, s["right"]))


@dataclass
class Manifest:
    rows: DataFrame  # _row (the kept columns), _group, leaf, steps (array of left and right siblings, upwards)
    subroots: DataFrame  # _group, subroot
    root: str | None


def _placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Nodes with ``_at``, the place in their group from 0, and ``_of``, the group's rows."""
    spread = nodes.repartitionByRange("_group", *order).sortWithinPartitions("_group", *order)
    spread = stored(spread.withColumn("_id", F.monotonically_increasing_id()), "ordered")
    spread = spread.withColumn("_part", F.shiftright("_id", 33))  # the id is the partition, then the row in it
    found = spread.groupBy("_group", "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    group = W.partitionBy("_group")
    offsets = found.select(
        "_group",
        "_part",
        (F.sum("_rows").over(group.orderBy("_part")) - F.col("_rows") - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(group).alias("_of"),
    )
    joined = spread.join(sized(stored(offsets, "offsets"), "offsets"), ["_group", "_part"])
    return joined.withColumn("_at", F.col("_id") + F.col("_shift")).drop("_id", "_part", "_shift")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """``_run``, ``_slot``, and the siblings before and after a node as hex text."""
    nodes = nodes.withColumns({"_run": F.expr(f"_at div {FAN}"), "_slot": F.col("_at") % FAN})
    run, slot = W.partitionBy("_group", "_run").orderBy("_at"), F.col("_slot")
    length = F.least(F.lit(FAN), F.col("_of") - F.col("_run") * FAN)
    before = [F.when(slot >= k, F.lag("digest", k).over(run)) for k in range(FAN - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("digest", k).over(run)) for k in range(1, FAN)]
    return nodes.withColumns({"left": F.concat_ws("", *before), "right": F.concat_ws("", *after)})


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """All levels, leaves first; a group is in each up to that where it has one node."""
    most = nodes.agg(F.max("_of")).first()[0] or 0
    levels = [nodes]
    while most > 1:
        first = _with_siblings(levels[-1].filter("_of > 1").select("_group", "_at", "_of", "digest")).filter("_slot = 0")
        parents = first.select(
            "_group", F.col("_run").alias("_at"), F.expr(f"(_of + {FAN - 1}) div {FAN}").alias("_of"), digest(F.col("digest"), F.col("right")).alias("digest")
        )
        levels.append(stored(parents, "level"))
        most = -(-most // FAN)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    tops = [level.filter("_of = 1").select("_group", "digest") for level in levels]
    out = tops[0]
    for top in tops[1:]:
        out = out.union(top)
    return out


def _with_steps(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest level with the steps from each node to the root. ``above``: _group, steps of its top."""
    above, known = sized(above, "above"), None
    for k, level in reversed(list(enumerate(levels))):
        nodes = level.filter("_of = 1").join(above, "_group")
        if known is not None:
            parents = known.select("_group", F.col("_at").alias("_run"), F.col("steps").alias("_up"))
            lower = _with_siblings(level.filter("_of > 1")).join(parents, ["_group", "_run"])
            steps = F.concat(F.array(F.struct("left", "right")), "_up")
            nodes = nodes.unionByName(lower.withColumn("steps", steps).select(*nodes.columns))
        known = stored(nodes, "steps") if k else nodes
    return known


def manifest(rows: DataFrame, leaf: Column, group: Column, key: str, keep: Sequence[str] = ()) -> Manifest:
    """The manifest of ``rows``; ``leaf`` is each row's digest, ``group`` a string. Columns in ``keep`` pass through."""
    name = F.when(group.isNull(), "0").otherwise(F.concat(F.lit("1"), group.cast("string")))
    leaves = boxed(rows, keep, _group=name, _key=F.col(f"`{key}`"), digest=leaf)
    leaves = stored(leaves.withColumn("_number", F.monotonically_increasing_id()), "leaves")
    levels = _levels(stored(_placed(leaves, ["_key", "digest", "_number"]).drop("_key", "_number"), "level"))
    subroots = stored(_tops(levels), "subroots")
    upper = _levels(stored(_placed(subroots.select(F.lit("").alias("_group"), F.col("_group").alias("_name"), "digest"), ["_name"]), "level"))
    root = _tops(upper).first()
    top = rows.sparkSession.createDataFrame([("", [])], "_group string, steps array<struct<left: string, right: string>>")
    above = stored(_with_steps(upper, top).select(F.col("_name").alias("_group"), "steps"), "above")
    placed = _with_steps(levels, above).withColumnRenamed("digest", "leaf")
    return Manifest(placed, subroots.withColumnRenamed("digest", "subroot"), root.digest if root else None)


def proofs(found: Manifest, keep: Sequence[str]) -> DataFrame:
    """Every row's kept columns, leaf, subroot, root and steps."""
    joined = found.rows.join(sized(found.subroots, "subroots"), "_group")
    return unboxed(joined, keep, "leaf", "subroot", F.lit(found.root).cast("string").alias("root"), "steps")
