"""Pivots with known columns, unpivots, and bounded column discovery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_pivot(
    df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str], counted: str | None = None
) -> DataFrame:
    """Counts of non-missing ``counted`` (or of rows); every listed column exists, zero-filled."""
    for r in rows:
        df = df.filter(F.col(r).isNotNull())
    unit = F.col(counted).isNotNull() if counted else F.lit(True)
    return df.groupBy(*rows).agg(
        *[F.count_if((F.col(column) == v) & unit).alias(str(v)) for v in values]
    )


def count_long(df: DataFrame, rows: Sequence[str], counted: str | None = None) -> DataFrame:
    """The long form of a count pivot: one row per non-empty cell."""
    for r in rows:
        df = df.filter(F.col(r).isNotNull())
    count = F.count(F.col(counted)) if counted else F.count(F.lit(1))
    return df.groupBy(*rows).agg(count.alias("rows"))


def value_pivot(
    df: DataFrame, rows: Sequence[str], column: str, values: Sequence[object], value: str, labels: Sequence[str]
) -> DataFrame:
    """One column per known value holding that cell's ``value``, zero where there is none."""
    return df.groupBy(*rows).agg(
        *[
            F.coalesce(F.max(F.when(F.col(column) == F.lit(v), F.col(value))), F.lit(0.0)).alias(label)
            for v, label in zip(values, labels)
        ]
    )


def unpivot(df: DataFrame, keys: Sequence[str], columns: dict[str, Column], name: str, value: str) -> DataFrame:
    """One row per key and labelled expression."""
    cells = F.array(*[F.struct(F.lit(k).alias(name), v.alias(value)) for k, v in columns.items()])
    return df.select(*keys, F.inline(cells))


def transpose(
    df: DataFrame, key: str, values: Sequence[str], measures: dict[str, Column], name: str
) -> DataFrame:
    """Measures down, one column per known key value."""
    long = unpivot(df, [key], measures, name, "_value")
    return long.groupBy(name).agg(*[F.max(F.when(F.col(key) == v, F.col("_value"))).alias(v) for v in values])
