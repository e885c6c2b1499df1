"""What the operators share: written intermediate tables and digest columns."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Sequence
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the shared scratch folder; lineage ends there.

    A table survives lost executors and is read again without computing it again. All tables of an
    application lie in one folder, which can go when the application has ended.
    Parquet rather than ``checkpoint()`` where rows are many: it is compressed and prunes columns.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _recording is not None:
        _recording.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that ``stored`` returned; nothing may read them any more."""
    for frame in frames:
        _remove(frame.sparkSession, frame._stored_at)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


_recording: list[str] | None = None
_left: list[str] = []


def stage(fn: Callable) -> Callable:
    """A stage ``fn(spark, docs, ...)`` of a pipeline that writes each stage's result before it calls the next one.

    The tables that a stage wrote on its way are dropped when the next stage begins, so that a pipeline
    needs room for one stage's tables only. Tables of others, and results, are not touched.
    """

    @wraps(fn)
    def run(spark: SparkSession, *args):
        global _recording
        for path in _left:
            _remove(spark, path)
        _left.clear()
        _recording = []
        try:
            return fn(spark, *args)
        finally:
            _left.extend(_recording)
            _recording = None

    return run


def lower_ascii(text: Column | str) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8_size(text: Column | str) -> Column:
    """Bytes of the text in UTF-8; null counts none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once for each application; their Python need not have it installed.

    The archive lies in the shared scratch folder.
    """
    context = spark.sparkContext
    # texts can be long: few rows at a time in a Python worker
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        target = f"{scratch_dir(spark)}/llm/{context.applicationId}/{package.name}.zip"
        path = context._jvm.org.apache.hadoop.fs.Path(target)
        out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(packed.getvalue()))
        out.close()
        context.addPyFile(target)
        _shipped.add(context.applicationId)
    return spark


def own_columns(df: DataFrame, keep: Sequence[str] | None, results: Sequence[str]) -> list[str]:
    """The caller's columns that pass through an operator: ``keep``, or all, but those with a result's name."""
    taken = {r.lower() for r in results}
    return [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]


def boxed(df: DataFrame, own: Sequence[str], **inputs: Column) -> DataFrame:
    """The caller's columns in one struct ``_row``, beside what an operator computes from them.

    Inside the struct no name can clash with those that the operator uses.
    """
    fields = [F.col(f"`{c}`") for c in own] or [F.lit(0).alias("_none")]
    return df.select(F.struct(*fields).alias("_row"), *[c.alias(name) for name, c in inputs.items()])


def unboxed(df: DataFrame, own: Sequence[str], *results: Column | str) -> DataFrame:
    """The caller's columns as they were, and the results."""
    return df.select(*[F.col("_row").getField(c).alias(c) for c in own], *results)


def content(batch: pa.RecordBatch, own: Sequence[str], text: str) -> pa.Array:
    """The text column of a batch of boxed rows."""
    return batch.column("_row").field(text) if text in own else batch.column("_content")


def with_content(df: DataFrame, own: Sequence[str], text: str, **inputs: Column) -> DataFrame:
    """Boxed rows; the text travels in the struct if it is kept, else beside it."""
    if text not in own:
        inputs = {"_content": F.col(f"`{text}`"), **inputs}
    return boxed(df, own, **inputs)


def extended(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch without its text beside the rows, and with more columns."""
    kept = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "_content"} | columns
    return pa.RecordBatch.from_arrays(list(kept.values()), names=list(kept))


def plus(df: DataFrame, **types: str) -> StructType:
    """The schema of ``extended`` batches."""
    schema = StructType([f for f in df.schema.fields if f.name != "_content"])
    for name, kind in types.items():
        schema = schema.add(name, DataType.fromDDL(kind))
    return schema
