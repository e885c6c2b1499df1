"""Proportional stratified interleaving of rows into shards, in DataFrame operations only.

Rows of a source are put in a seeded random order; the row of rank r (from 0) among n has the
fractional rank (r + u) / n, with one u in [0, 1) drawn for each source. Sorted by fractional rank,
every stretch of rows holds the sources in their overall mixture, so cutting the order into equal
stretches gives shards of equal row counts (at most one apart) that each match the mixture.
Sources with fewer rows than there are shards are ranked together as one stratum, as none of them
can be in every shard.

Ranks are exact without ever bringing a source together: rows are dealt out by a bucket
of their random key, buckets are counted, and a row's rank is the rows in earlier buckets
plus its rank inside its own. The number of buckets follows from the number of rows, so a
bucket holds about ``ROWS_PER_BUCKET`` rows whatever a source's share. The same is done
for the order over all sources, by stretches of the fractional rank.

Defined cases: null sources are a source of their own; null texts have size 1; repeated rows each
get a slot; an empty table gives an empty result; other columns pass through, but columns named
``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import boxed, own_columns, stored, unboxed

ROWS_PER_BUCKET = 2_000


def _ranked(df: DataFrame, group: list[str], bucket: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with the 0-based rank of each row in its group, by bucket and then ``order``."""
    counts = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*group, bucket, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy(*group, bucket).orderBy(*order)) - 1
    joined = df.withColumn("_inside", inside).join(offsets, [*group, bucket])
    return joined.withColumn(name, F.col("_inside") + F.col("_before")).drop("_inside", "_before")


def random_bits(*parts: Column) -> Column:
    """48 bits that follow from the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 12), 16, 10).cast("bigint")


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows as written, each with a number that stays."""
    return stored(rows.withColumn("_number", F.monotonically_increasing_id()), "drawn")


def _salted(base: DataFrame, salt: Column) -> DataFrame:
    """Rows that are drawn alike more often than a bucket holds, as only equal rows are, draw again by their number."""
    many = base.groupBy("_drawn").agg(F.count(F.lit(1)).alias("_alike")).filter(F.col("_alike") > ROWS_PER_BUCKET)
    joined = base.join(F.broadcast(many), "_drawn", "left")  # one row for each 2,000 of the table, at most
    again = random_bits(salt, F.col("_drawn").cast("string"), F.col("_number").cast("string"))
    return joined.withColumn("_drawn", F.when(F.col("_alike").isNotNull(), again).otherwise(F.col("_drawn"))).drop("_alike", "_number")


def interleaved(rows: DataFrame, key: str, strata: str, shards: int, seed: int = 0, ties: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... in each shard).

    The random order follows from ``seed``, ``key`` and ``ties``; rows alike in these are dealt out by their place once they are very many.
    """
    own = own_columns(rows, None, ["shard", "slot"])
    salt = F.lit(str(seed))
    base = _numbered(
        boxed(
            rows,
            own,
            _drawn=random_bits(salt, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, *ties)]),
            _source=F.coalesce(F.col(strata).cast("string"), F.lit("")),
            _none=F.col(strata).isNull(),
            _tie=F.struct(key, *ties),
        ),
    )
    base = _salted(base, salt)
    total = base.count()
    buckets = max(1, -(-total // ROWS_PER_BUCKET))
    source, order = ["_source", "_none"], ["_drawn", "_tie"]
    base = base.withColumn("_bucket", F.floor(F.col("_drawn") / F.lit((1 << 48) / buckets)))
    sizes = base.groupBy(*source).agg(F.count(F.lit(1)).alias("_rows"))
    small = F.col("_rows") < shards
    name = F.when(~small, F.to_json(F.struct("_source", "_none")))
    strata = stored(sizes.select(*source, F.coalesce(name, F.lit("")).alias("_stratum"), "_rows"), "strata")
    of = strata.groupBy("_stratum").agg(F.sum("_rows").alias("_of"))
    offset = random_bits(salt, F.col("_stratum")) / F.lit(float(1 << 48))
    placed = stored(
        _ranked(base.join(strata.drop("_rows"), source), ["_stratum"], "_bucket", order, "_rank")
        .join(of, "_stratum")
        .withColumn("_at", (F.col("_rank") + offset) / F.col("_of"))
        .select("_row", "_drawn", "_tie", "_stratum", "_at"),
        "placed",
    )
    stretched = placed.withColumns({"_stretch": F.floor(F.col("_at") * buckets), "_all": F.lit(0)})
    final = _ranked(stretched, ["_all"], "_stretch", ["_at", "_stratum", *order], "_position")
    # whole numbers throughout: shard s begins at position ceil(s * total / shards)
    shard = F.expr(f"int((_position * {shards}) div {max(total, 1)})")
    first = F.expr(f"(_shard * bigint({total}) + {shards - 1}) div {shards}")
    dealt = final.withColumn("_shard", shard).withColumn("_slot", (F.col("_position") - first).cast("bigint"))
    return unboxed(dealt, own, F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))
