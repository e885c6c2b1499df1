"""SLA histograms kept one for each business day, and the month to date as their sum.

A day's histogram holds, per region, store, aggregator and metric, how often each tenth of a minute occurred. It is
written once; a rerun computes the days named to it and no others, and replaces them under a pointer, so readers see the
days of before or of after. Means, medians, percentiles and breaches of any run of days follow exactly from the summed counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import month_days
from ..operators.metrics import metric_histogram
from ..sources import versions
from ..sources.keylog import of_days
from .sla import METRICS, aggregator, enrich

DAY = "invoice_day"
KEYS = ("region", "store_name", "aggregator")
SCHEMA = "region string, store_name string, aggregator string, metric string, tenths bigint, n bigint, invoice_day date"


def enrich_days(orders: DataFrame, stores: DataFrame, channels: Sequence[str] | None, days: Iterable[date]) -> DataFrame:
    """Orders of the days only, as ``sla.enrich`` conforms them; no day is the reported one yet."""
    return enrich(orders, stores, channels, of_days(DAY, days), F.lit(False))


def day_histograms(sla: DataFrame) -> DataFrame:
    """Enriched orders -> the columns of ``SCHEMA``; counted map-side, so that a store with a third of all rows ships its distinct tenths."""
    tagged = sla.withColumn("aggregator", aggregator("channel"))
    return metric_histogram(tagged, [*KEYS, DAY], METRICS).select("region", "store_name", "aggregator", "metric", "tenths", "n", DAY)


def refresh_days(sla: DataFrame, path: str, days: Iterable[date]) -> versions.Pointer:
    """Write the histograms of ``days`` from their enriched orders; the other days stay. A day without orders becomes empty."""
    return versions.publish_days(day_histograms(sla), path, DAY, days)


def between_days(spark: SparkSession, path: str, days: Iterable[date], reported: Column) -> DataFrame:
    """The days summed, in the form that every dashboard of ``plans.sla`` takes: counts with the flag of the reported day."""
    rows = versions.published_days(spark, path, SCHEMA, DAY, days)
    flagged = rows.withColumn("is_ftd", F.coalesce(reported, F.lit(False)))
    return flagged.groupBy(*KEYS, "is_ftd", "metric", "tenths").agg(F.sum("n").alias("n"))


def month_to_date(spark: SparkSession, path: str, day: date) -> DataFrame:
    """The month up to ``day``, which is the reported one."""
    return between_days(spark, path, month_days(day), F.col(DAY) == F.lit(day))
