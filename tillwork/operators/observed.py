"""Counts of a run that ride on its own scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **tests: Column) -> tuple[DataFrame, Observation]:
    """The frame, and how many of its rows pass by and pass each test, known once an action has run over it.

    Only rows that reach this place are counted; what an action does not read, as after a limit, is not.
    """
    seen = Observation(name)
    counts = [F.count(F.when(test, 1)).alias(label) for label, test in tests.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen
