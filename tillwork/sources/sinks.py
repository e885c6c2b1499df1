"""Result tables: full refresh, partition refresh, month CSV, alert log, stacked sections."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import with_status_row
from ..operators.shape import json_text, lead, tag, union_all
from . import keylog
from .landed import ALERT_LOG


def refresh(df: DataFrame, path: str, as_of: date | None = None, fmt: str = "parquet") -> None:
    """Replace the table, or only the ``as_of`` partition of it; an empty result clears it.

    The partition is written as its own folder: a dynamic overwrite would keep the old rows
    of a day that has none now.
    """
    folder = path if as_of is None else f"{path}/as_of={as_of.isoformat()}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt).save(folder)


def by_folder(df: DataFrame, key: str) -> DataFrame:
    """Rows of one output folder together, so it gets few files; a large folder is still split over tasks."""
    return df.hint("rebalance", F.col(key))


def ledger_csv(df: DataFrame, path: str, day: str = "activity_date") -> None:
    """CSV of the ledger, one folder per month; a rerun replaces only its months."""
    text = json_text(df.withColumn("month", F.date_format(day, "yyyy-MM")))
    (
        by_folder(text, "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", "true")
        .partitionBy("month")
        .csv(path)
    )


def append_alerts(keys: DataFrame, path: str, run: str) -> None:
    """Append a run's alert keys with the time they were sent, by business day; repeating the run replaces its own keys."""
    sent = keys.select("alert_key", F.current_timestamp().alias("sent_time"), "business_date")
    by_folder(sent, "business_date").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "business_date"
    ).parquet(f"{path}/run={run}")


def compact_alerts(spark: SparkSession, path: str, least: int = 2) -> list:
    """Merge the log's folders of each business day that has at least ``least`` new ones."""
    return keylog.compact(spark, path, ALERT_LOG, "run", least)


def drop_merged_alerts(spark: SparkSession, path: str) -> int:
    """Delete the folders that ``compact_alerts`` merged; when no run is at work."""
    return keylog.drop_merged(spark, path, ALERT_LOG, "run", ("run", "business_date"))


def raw_landing(df: DataFrame, table: str) -> DataFrame:
    """A raw table ready to publish: complex values as JSON, a status row when nothing landed."""
    text = json_text(df)
    message = f"No data returned for {table} on the target date."
    status = df.sparkSession.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in text.schema.fields], F.lit(message).alias("landing_status")
    )
    return with_status_row(text.withColumn("landing_status", F.lit(None).cast("string")), status)


def stacked(sections: Mapping[str, DataFrame], key: str = "section") -> DataFrame:
    """Several result frames as one long table; a frame's columns absent elsewhere are missing there."""
    return lead(union_all(*[tag(df, **{key: name}) for name, df in sections.items()]), [key])


def write_sections(df: DataFrame, path: str, key: str = "section") -> None:
    by_folder(df, key).write.mode("overwrite").partitionBy(key).parquet(path)
