"""Landed pages as they arrive, each record once, into a table laid out by business day.

The file source with its checkpoint reads every file once; a batch writes the folders ``business_date=D/batch_id=N`` of its own
and replaces them when it is replayed. A record that another batch has landed already, be it under another file name, is
left out: a batch compares itself with the days of its own records. The table's layout is that of ``sources.keylog``, so it is
read and compacted there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import keylog
from ..sources.landed import one_per_key


def write_batch(batch: DataFrame, batch_id: int, table: str, schema: str, keys: Sequence[str], newest: str) -> list:
    """Append a batch's new records, of several copies of one the newest; returns the days that got any, for what is computed by day.

    ``schema`` names ``keys``, ``newest``, ``business_date`` and ``batch_id``. Records are told apart by their keys within a business day.
    """
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        days = keylog.days_of(batch, keylog.DAY)
        if not days:
            return []
        fresh = one_per_key(batch, [keylog.DAY, *keys], newest)
        earlier = keylog.read(spark, table, schema, "batch_id", days).filter(F.col("batch_id") != batch_id)
        seen = earlier.select(*[F.col(k).alias(f"_{k}") for k in (keylog.DAY, *keys)]).distinct()
        same = F.lit(True)
        for k in (keylog.DAY, *keys):
            same = same & fresh[k].eqNullSafe(seen[f"_{k}"])
        new = fresh.join(seen, same, "left_anti").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        columns = spark.createDataFrame([], schema).columns
        (
            new.select(*columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(keylog.DAY, "batch_id")
            .parquet(table)
        )
        return days
    finally:
        batch.unpersist()


def land_available(records: DataFrame, table: str, checkpoint: str, schema: str, keys: Sequence[str], newest: str) -> tuple[StreamingQuery, list]:
    """Land every file that has arrived since the last run and stop; returns the query and the days that were touched."""
    touched: set = set()
    query = (
        records.writeStream.foreachBatch(lambda df, i: touched.update(write_batch(df, i, table, schema, keys, newest)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query, sorted(touched, key=lambda d: (d is not None, d))


def landed_table(spark: SparkSession, table: str, schema: str, days: Sequence | None = None) -> DataFrame:
    return keylog.read(spark, table, schema, "batch_id", days)
