"""Exact distinct counts that merge: bitmaps over dense numbers instead of the values themselves.

Every distinct value of a day gets a number, dense within the day. Per key, day and range of 32,768 numbers one
bitmap of 4 KB says which of them occur. Bitmaps of finer keys or of more days merge by OR and by addition, so that counts of
any level of the keys follow from the written bitmaps; the values are read once, when their day lands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stored
from .joins import sized

SPREAD = 64  # stretches that a day's values are numbered in, so that one day is no single task


def numbered(df: DataFrame, value: str, day: str, name: str = "number") -> DataFrame:
    """(day, value, number): distinct values, numbered from 1 within their day without a gap.

    Values are dealt out by a hash, numbered inside their stretch, and shifted by the stretches before; the counts of
    the stretches are a few numbers a day. A missing value gets no number, a missing day is a day of its own.
    """
    distinct = stored(
        df.filter(F.col(value).isNotNull()).select(day, value).distinct().withColumn("_stretch", F.pmod(F.xxhash64(value), F.lit(SPREAD))),
        "values",
    )
    sizes = distinct.groupBy(day, "_stretch").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.partitionBy(day).orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select(F.col(day).alias("_day"), F.col("_stretch").alias("_of"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"))
    inside = distinct.withColumn("_at", F.row_number().over(W.partitionBy(day, "_stretch").orderBy(value)))
    same = F.col(day).eqNullSafe(F.col("_day")) & (F.col("_stretch") == F.col("_of"))
    return inside.join(sized(shifts, "shifts"), same).select(day, value, (F.col("_at") + F.col("_shift")).alias(name))


def day_bitmaps(df: DataFrame, keys: Sequence[str], day: str, number: str) -> DataFrame:
    """keys, day, bucket, bits: which of the day's numbers occur per key; built map-side, so a hot key ships its bitmaps."""
    known = df.filter(F.col(number).isNotNull())
    return known.groupBy(*keys, day, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )


def merged(bitmaps: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """The bitmaps of coarser ``keys``."""
    return bitmaps.groupBy(*keys, day, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_count(bitmaps: DataFrame, keys: Sequence[str], day: str, name: str) -> DataFrame:
    """Distinct values per key over all days of the bitmaps; days do not share values."""
    return merged(bitmaps, keys, day).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
