"""Dimension joins with a uniqueness contract, semi and anti joins, emptiness probes.

A dimension is unique by its key, so it has at most as many rows as the sheet it
comes from. It is broadcast when the files it is read from are small
(``BROADCAST_SOURCE_BYTES``). Otherwise the finished dimension is written and its own size decides;
a written dimension beyond the limit is joined without a hint, and as both sides of that join come straight from
an exchange, Spark can split a hot key of the facts over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import source_bytes, stored


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first by ``order``.

    The rank filter is applied before the exchange too, so each task ships at
    most one row per key whatever a key's share of the rows.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def sortable(df: DataFrame) -> list[str]:
    """The columns that rows can be ordered by."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]


def unique_dimension(dim: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """A dimension with non-missing, unique keys; the first by ``order``, ties by all other columns."""
    present = dim
    for k in keys:
        present = present.filter(F.col(k).isNotNull())
    return keep_first(present, keys, [*order, *[F.asc_nulls_last(c) for c in sortable(dim) if c not in keys]])


def dimension_conflicts(dim: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Keys that appear with more than one combination of attributes."""
    return (
        dim.select(*keys, *attributes)
        .distinct()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("variants"))
        .filter("variants > 1")
    )


# A sheet of this size holds at most a few hundred thousand stores or items.
BROADCAST_SOURCE_BYTES = 16 * 1024 * 1024


def with_dimension(fact: DataFrame, dim: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Fact rows with the attributes of their dimension row; ``inner`` keeps known keys only."""
    return fact.join(sized(dim, "dimension"), on, how)


def sized(side: DataFrame, label: str) -> DataFrame:
    """The small side of a join with a broadcast hint if its measured size allows it; written first if its sources do not tell."""
    if source_bytes(side) > BROADCAST_SOURCE_BYTES:
        side = stored(side, label)
    return F.broadcast(side) if source_bytes(side) <= BROADCAST_SOURCE_BYTES else side


def only_new(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """EXCEPT by key; a key that repeats in ``seen`` is reduced before the exchange."""
    return df.join(seen.select(key).distinct(), key, "left_anti")


def only_listed(df: DataFrame, listed: DataFrame, key: str, all_when_empty: bool = False) -> DataFrame:
    """Rows whose key is listed; with ``all_when_empty`` an empty list restricts nothing.

    The list is written once: the join and the test for emptiness read the written one, and a hot key of ``df`` can be split.
    """
    hits = stored(listed.select(key).distinct(), "listed")
    kept = F.broadcast(hits) if source_bytes(hits) <= BROADCAST_SOURCE_BYTES else hits
    if not all_when_empty:
        return df.join(kept, key, "left_semi")
    return df.join(kept.withColumn("_hit", F.lit(True)), key, "left").filter(F.col("_hit") | is_empty(hits)).drop("_hit")


def is_empty(df: DataFrame) -> Column:
    """True in every row when ``df`` has none; evaluated on the cluster as a scalar subquery."""
    return df.limit(1).agg(F.count(F.lit(1)) == 0).scalar()


def with_status_row(result: DataFrame, status: DataFrame) -> DataFrame:
    """``result``, or the one-row ``status`` frame of the same columns when there is none.

    ``result`` is read once more to see whether it has a row: pass a scan or a written result, not an aggregation.
    """
    return result.unionByName(status.select(*result.columns).filter(is_empty(result)))


def in_windows(df: DataFrame, ts: str, windows: DataFrame, name: str = "period") -> DataFrame:
    """Rows once for every window that holds their time. ``windows``: the name, ``start`` and ``end``, ends included.

    Windows may overlap and come as data. Both sides meet by day, each window once for every day it touches, and the
    time decides within the day; so a row meets the windows of its own day and no others. A window without name, start or end, or whose
    end comes first, holds nothing. The windows are broadcast if their measured size allows it.
    """
    real = windows.filter(F.col(name).isNotNull() & (F.col("start") <= F.col("end"))).select(
        F.col(name).alias("_name"), F.col("start").alias("_start"), F.col("end").alias("_end")
    )
    days = real.withColumn("_day", F.explode(F.sequence(F.to_date("_start"), F.to_date("_end"))))
    dated = df.withColumn("_on", F.to_date(ts))
    inside = (F.col("_on") == F.col("_day")) & F.col(ts).between(F.col("_start"), F.col("_end"))
    return dated.join(sized(days, "windows"), inside).select(*[F.col(f"`{c}`") for c in df.columns], F.col("_name").alias(name))
