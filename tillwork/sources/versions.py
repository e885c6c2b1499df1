"""Folders under a pointer: a table's parts are written beside the ones in use and come into use all at once.

A table's folder holds ``version=<id>`` folders and numbered pointer files. The pointer with the highest number says in which
version each part (a day, or the whole table) lies. A write that fails leaves a version that no pointer names; readers go on with
the old one. Two writers that started from the same pointer cannot both succeed: a number is taken once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTERS = "_pointers"  # a name that scans of the folder pass over
WHOLE = ""  # the part of a table that is replaced as a whole


@dataclass(frozen=True)
class Pointer:
    number: int = 0
    parts: Mapping[str, str | None] = field(default_factory=dict)  # part -> version, None for a part without rows


class Superseded(RuntimeError):
    """Another writer moved the pointer first; read again and repeat."""


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    files, place = _place(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Bring the files of one landing into a folder that a stream watches, one after another, with the folders they are in."""
    if not children(spark, source):
        return
    files, place = _place(spark, source)
    listed = files.listFiles(place, True)
    while listed.hasNext():
        file = listed.next().getPath()
        inner = file.toUri().getPath().split(place.toUri().getPath().rstrip("/") + "/", 1)[1]
        if not any(name.startswith(("_", ".")) for name in inner.split("/")):
            _, goal = _place(spark, f"{target}/{inner}")
            files.mkdirs(goal.getParent())
            files.rename(file, goal)
    remove(spark, source)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in children(spark, f"{path}/{POINTERS}") if n.endswith(".json"))


def pointer(spark: SparkSession, path: str, number: int | None = None) -> Pointer:
    """The pointer in use, or an older one by its number."""
    numbers = _numbers(spark, path)
    if not numbers:
        return Pointer()
    number = numbers[-1] if number is None else number
    files, place = _place(spark, f"{path}/{POINTERS}/{number:09d}.json")
    source = files.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    return Pointer(number, json.loads(text))


def swap(spark: SparkSession, path: str, seen: Pointer, parts: Mapping[str, str | None]) -> Pointer:
    """Put ``parts`` in use beside the other parts of ``seen``, which must still be the pointer in use."""
    after = Pointer(seen.number + 1, {**seen.parts, **parts})
    folder = f"{path}/{POINTERS}"
    files, draft = _place(spark, f"{folder}/.{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(after.parts).encode()))
    out.close()
    _, target = _place(spark, f"{folder}/{after.number:09d}.json")
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise Superseded(f"pointer {after.number} of {path} is taken")
    return after


def part_name(day: date | str | None) -> str:
    return "null" if day is None else str(day)


def write_version(df: DataFrame, path: str, by: str | None = None) -> str:
    """The rows as a version that no pointer names yet; with ``by``, a folder for each of its values."""
    version = uuid.uuid4().hex
    writer = df.write if by is None else df.hint("rebalance", F.col(by)).write.partitionBy(by)
    writer.parquet(f"{path}/version={version}")
    return version


def publish(df: DataFrame, path: str) -> Pointer:
    """Replace the table; readers see the old rows or the new ones, whole."""
    spark = df.sparkSession
    seen = pointer(spark, path)
    return swap(spark, path, seen, {WHOLE: write_version(df, path)})


def publish_days(df: DataFrame, path: str, by: str, days: Iterable[date | None]) -> Pointer:
    """Replace the days: ``df`` holds all their rows, and a day without any is empty from now on. Other days stay as they are."""
    spark = df.sparkSession
    seen, days = pointer(spark, path), list(days)
    version = write_version(df, path, by)
    with_rows = set(children(spark, f"{path}/version={version}"))
    return swap(spark, path, seen, {part_name(d): version if folder_name(spark, by, d) in with_rows else None for d in days})


def folder_name(spark: SparkSession, column: str, value) -> str:
    """The partition folder that Spark writes for a value."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(column, None if value is None else str(value))


def published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table in use; empty before the first ``publish``."""
    version = pointer(spark, path).parts.get(WHOLE)
    return spark.createDataFrame([], schema) if version is None else spark.read.schema(schema).parquet(f"{path}/version={version}")


def published_days(spark: SparkSession, path: str, schema: str, by: str, days: Iterable[date | None] | None = None) -> DataFrame:
    """The days in use, or those asked for; only their folders are opened. ``schema`` includes ``by``."""
    parts = pointer(spark, path).parts
    names = list(parts) if days is None else [part_name(d) for d in days]
    folders = [
        f"{path}/version={parts[n]}/{folder_name(spark, by, None if n == 'null' else n)}" for n in names if parts.get(n) is not None
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    empty = spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*empty.columns)


def drop_unused(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete versions that none of the last ``keep`` pointers names; call it when no reader or writer is at work on older ones."""
    kept = {v for n in _numbers(spark, path)[-keep:] for v in pointer(spark, path, n).parts.values()}
    gone = [c for c in children(spark, path) if c.startswith("version=") and c.removeprefix("version=") not in kept]
    for name in gone:
        remove(spark, f"{path}/{name}")
    return gone
