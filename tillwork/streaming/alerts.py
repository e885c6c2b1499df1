"""Sold-out alerts as a stream: each (store, item, business day) leaves once, across runs, however late its event lands.

The log of what was sent is the only state. It is laid out by business day, and a batch reads
the days of its own events alone, whichever they are, so neither the stream nor a batch ever forgets a key or
reads the whole log. Events without a business day are a day of their own. ``compact_log`` keeps the number of files small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import keep_first, only_new
from ..plans.soldout import alert_order, soldout_base, with_alert_key
from ..sources import keylog

LOG_SCHEMA = "alert_key string, store_name string, item_name string, event_time timestamp_ntz, business_date date, batch_id bigint"


def landed_stream(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """A Parquet table as a stream, be it one file or a folder of part files that grows.

    A stream cannot be opened on a file, but on a pattern; in braces the last name is a pattern of itself.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}}}")


def alert_stream(events: DataFrame, stores: DataFrame) -> DataFrame:
    """Streaming events -> every alert candidate with its key; repeats are dropped where the batch is written."""
    return with_alert_key(soldout_base(events, stores)).filter(F.col("store_name").isNotNull())


def write_batch(batch: DataFrame, batch_id: int, log: str) -> None:
    """Append a batch's unsent alerts to the log: per key the earliest event, as in the batch form.

    Repeats within the batch go first, at most one row per key and task reaching the
    exchange. A batch owns the folders ``batch_id=N`` and overwrites them, and compares itself
    with the other batches only, so a batch replayed after a failure writes the same rows.
    """
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        days = keylog.days_of(batch, "business_date")
        if not days:
            return
        earlier = keylog.read(spark, log, LOG_SCHEMA, "batch_id", days).filter(F.col("batch_id") != batch_id)
        fresh = only_new(keep_first(batch, ["alert_key"], alert_order()), earlier, "alert_key")
        sent = fresh.select("alert_key", "store_name", "item_name", "event_time", "business_date", F.lit(batch_id).alias("batch_id"))
        (
            sent.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("business_date", "batch_id")
            .parquet(log)
        )
    finally:
        batch.unpersist()


def run_available(alerts: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Process everything that has landed and stop; restart from ``checkpoint`` for the next run."""
    query = (
        alerts.writeStream.foreachBatch(lambda df, i: write_batch(df, i, log))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def sent_log(spark: SparkSession, log: str) -> DataFrame:
    """Every alert sent so far; an empty table before the first."""
    return keylog.read(spark, log, LOG_SCHEMA, "batch_id")


def compact_log(spark: SparkSession, log: str, least: int = 2) -> list:
    """Merge the folders of each day with at least ``least`` new ones; between two batches, or while readers and a batch are at work."""
    return keylog.compact(spark, log, LOG_SCHEMA, "batch_id", least)


def drop_merged(spark: SparkSession, log: str) -> int:
    """Delete what ``compact_log`` merged; when neither readers nor a batch are at work."""
    return keylog.drop_merged(spark, log, LOG_SCHEMA, "batch_id", ("business_date", "batch_id"))
