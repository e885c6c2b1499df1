"""The log of sent alert keys, laid out by business day, and its compaction.

Each writer (a stream's batch, or a run) owns one folder a day and replaces it when it is repeated. ``compact`` merges the
folders of a day into one, in a version under ``_merged`` that comes into use by a pointer swapped last; merged rows keep the
name of their writer. A folder counts only while its writer has no rows in the merged part of its day, so a log reads the same
before, during and after a compaction, and when any writer is repeated after it. ``drop_merged`` deletes what no longer counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions

DAY = "business_date"
MERGED = "_merged"  # scans of the log pass over this name


def of_days(column: str, days: Iterable[date | None]) -> Column:
    """True for rows of the days; None stands for rows without a day. On a partition column this prunes folders."""
    days = list(days)
    known = [F.lit(d) for d in days if d is not None]
    hit = F.col(column).isin(known) if known else F.lit(False)
    return hit | F.col(column).isNull() if None in days else F.col(column).isNotNull() & hit


def days_of(df: DataFrame, column: str) -> list[date | None]:
    """The distinct days of the rows, missing ones as None: as many as the calendar has, at most."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _folders(spark: SparkSession, log: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(log)


def read(spark: SparkSession, log: str, schema: str, owner: str, days: Iterable[date | None] | None = None) -> DataFrame:
    """The rows of the log, of some days if asked, with the columns of ``schema``, which names the day and the ``owner``."""
    if not versions.children(spark, log):
        return spark.createDataFrame([], schema)
    days = None if days is None else list(days)
    raw = _folders(spark, log, schema)
    raw = raw if days is None else raw.filter(of_days(DAY, days))
    merged_path = f"{log}/{MERGED}"
    if not any(v is not None for v in versions.pointer(spark, merged_path).parts.values()):
        return raw
    merged = versions.published_days(spark, merged_path, schema, DAY, days)
    covered = merged.select(F.col(DAY).alias("_day"), F.col(owner).alias("_owner")).distinct()
    live = raw.join(covered, raw[DAY].eqNullSafe(covered["_day"]) & (raw[owner] == covered["_owner"]), "left_anti")
    return live.unionByName(merged)


def _writers(spark: SparkSession, log: str, schema: str, owner: str) -> list[tuple]:
    """(day, writer) of every folder that holds rows: one short row a folder."""
    return [tuple(r) for r in _folders(spark, log, schema).select(DAY, owner).distinct().collect()]


def compact(spark: SparkSession, log: str, schema: str, owner: str, least: int = 2) -> list[date | None]:
    """Merge every day that has at least ``least`` folders not merged yet; returns the days. Nothing is deleted."""
    if not versions.children(spark, log):
        return []
    merged_path = f"{log}/{MERGED}"
    folders = _writers(spark, log, schema, owner)
    covered = {tuple(r) for r in versions.published_days(spark, merged_path, schema, DAY).select(DAY, owner).distinct().collect()}
    found = Counter(day for day, writer in folders if (day, writer) not in covered)
    days = [day for day, n in found.items() if n >= least]
    if days:
        versions.publish_days(read(spark, log, schema, owner, days), merged_path, DAY, days)
    return days


def drop_merged(spark: SparkSession, log: str, schema: str, owner: str, layout: tuple[str, str]) -> int:
    """Delete merged folders and versions out of use; call it when no reader or writer of the log is at work. ``layout``: outer and inner folder."""
    if not versions.children(spark, log):
        return 0
    merged_path = f"{log}/{MERGED}"
    merged = versions.published_days(spark, merged_path, schema, DAY).select(DAY, owner).distinct()
    gone = [dict(zip((DAY, owner), r)) for r in merged.collect()]
    for folder in gone:
        outer, inner = (versions.folder_name(spark, c, folder[c]) for c in layout)
        versions.remove(spark, f"{log}/{outer}/{inner}")
    versions.drop_unused(spark, merged_path)
    return len(gone)
