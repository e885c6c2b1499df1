"""Sold-out reports and the alert-once feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import composite_key, dash_if_zero, same_text, split_list
from ..operators.joins import keep_first, only_new, with_dimension
from ..operators.metrics import first_known
from ..operators.pivot import count_long, count_pivot
from ..session import scratch_dir
from ..sources.keylog import days_of
from ..sources.landed import sent_alerts
from ..sources.sinks import append_alerts

# The regions every pivot shows.
REGIONS = ("KA", "MH", "TN", "KL")
CONTACTS = ("am_email", "rm_email", "am_name", "cc_mail")
BASE_COLUMNS = (
    "business_date",
    "branch_code",
    "store_name",
    "region",
    "item_type",
    "category_name",
    "item_name",
    "event_time",
    "user_name",
    "status_type",
    "event_type",
    *CONTACTS,
)


def is_soldout() -> Column:
    """A direct OUT event."""
    return same_text("event_type", "OUT") & same_text("status_type", "DIRECT")


def soldout_base(events: DataFrame, stores: DataFrame) -> DataFrame:
    """Direct sold-out events of the stores in ``stores``; no other store's event is reported."""
    kept = events.filter(is_soldout()).withColumn("business_date", F.col("event_day"))
    dim = stores.select("branch_code", "store_name", "region", *CONTACTS)
    return with_dimension(kept, dim, "branch_code", "inner").select(*BASE_COLUMNS)


def of_type(base: DataFrame, kind: str) -> DataFrame:
    return base.filter(same_text("item_type", kind))


def material_by_region(base: DataFrame, regions: Sequence[str] = REGIONS) -> DataFrame:
    return count_pivot(of_type(base, "MATERIAL"), ["item_name"], "region", regions, "branch_code")


def category_by_region(base: DataFrame, regions: Sequence[str] = REGIONS) -> DataFrame:
    return count_pivot(of_type(base, "PRODUCT"), ["category_name"], "region", regions, "item_name")


def material_by_store(base: DataFrame) -> DataFrame:
    """Long form: the materials are as many as the data has."""
    return count_long(of_type(base, "MATERIAL"), ["store_name", "item_name"], "branch_code")


def category_by_store(base: DataFrame) -> DataFrame:
    return count_long(base, ["store_name", "category_name"], "item_name")


def wide(long: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Wide view of a long count table for columns the caller knows."""
    return long.groupBy("store_name").agg(
        *[F.coalesce(F.sum(F.when(F.col(column) == v, F.col("rows"))), F.lit(0)).alias(v) for v in values]
    )


def dashed(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Display view: zero shows as a dash."""
    return table.withColumns({c: dash_if_zero(c) for c in columns})


def with_alert_key(base: DataFrame) -> DataFrame:
    return base.withColumn("alert_key", composite_key("store_name", "item_name", "business_date"))


def alert_order() -> list[Column]:
    """Which of a key's events leaves: the earliest, ties by the other columns."""
    return [F.asc_nulls_last(c) for c in ("event_time", "user_name", "category_name", "item_type", "branch_code")]


def new_alerts(base: DataFrame, sent: DataFrame) -> DataFrame:
    """One event per unsent (store, item, business day): the earliest, ties by user then type.

    Repeats within the batch go first, at most one row per key and task reaching
    the exchange; what is left is compared with the log by key.
    """
    keyed = with_alert_key(base.filter(F.col("store_name").isNotNull()))
    return only_new(keep_first(keyed, ["alert_key"], alert_order()), sent, "alert_key")


def alert_headers(alerts: DataFrame) -> DataFrame:
    """Per store: first known contacts, distinct recipients, item count; stores without recipients get no mail."""
    contacts = first_known(
        alerts, ["store_name"], ["am_email", "rm_email", "am_name"], "alert_key", F.count(F.lit(1)).alias("n_items")
    )
    both = F.concat_ws(",", "am_email", "rm_email")
    out = contacts.withColumn("recipients", F.array_sort(split_list(both)))
    return out.filter(F.size("recipients") > 0).select("store_name", "am_name", "recipients", "n_items")


def alert_packets(alerts: DataFrame, part_rows: int = 500, headers: DataFrame | None = None) -> DataFrame:
    """What one mail needs: store, part, contact, recipients and its items.

    A store's items come in parts of about ``part_rows`` lines. The part of an item follows from a
    digest of its key and is the same in every run. Items are first grouped by store and part: the part number
    comes from the store's header, which a join brings to the items where they are, so no task gathers a
    whole store. Pass written alerts and written headers: both are read twice.
    """
    headers = alert_headers(alerts) if headers is None else headers
    digest = F.conv(F.substring(F.md5("alert_key"), 1, 8), 16, 10).cast("bigint")
    parts = F.ceil(F.col("n_items") / F.lit(part_rows))
    item = F.struct("alert_key", "item_type", "category_name", "item_name", "event_time", "user_name")
    lines = alerts.select("store_name", item.alias("item"), digest.alias("digest"))
    return (
        with_dimension(lines, headers, "store_name", "inner")
        .withColumn("part", F.pmod("digest", parts) + 1)
        .groupBy("store_name", "part", "am_name", "recipients", "n_items")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )


def sent_keys(alerts: DataFrame, packets: DataFrame) -> DataFrame:
    """Alert keys and days of the stores that were mailed, for the log."""
    mailed = packets.select("store_name").distinct().withColumn("_mailed", F.lit(True))
    return with_dimension(alerts, mailed, "store_name", "inner").select("alert_key", "business_date")


def alert_run(events: DataFrame, stores: DataFrame, log: str, out: str, run: str) -> DataFrame:
    """One alerting run: new alerts -> packets written under ``out`` -> their keys in the log.

    The alerts are written once to the shared scratch folder and read from there, and so are the headers. Of the log
    only the days of the events are read. Packets leave before their keys are logged, so a crash in between repeats
    mails rather than losing them; repeating a run by its name gives the same packets.
    """
    spark = events.sparkSession
    staged = f"{scratch_dir(spark)}/alerts/{run}"
    candidates = soldout_base(events, stores)
    sent = sent_alerts(spark, log, except_run=run, days=days_of(events.filter(is_soldout()), "event_day"))
    new_alerts(candidates, sent).write.mode("overwrite").parquet(f"{staged}/alerts")
    alerts = spark.read.parquet(f"{staged}/alerts")
    alert_headers(alerts).write.mode("overwrite").parquet(f"{staged}/headers")
    headers = spark.read.parquet(f"{staged}/headers")
    alert_packets(alerts, headers=headers).write.mode("overwrite").parquet(f"{out}/run={run}")
    append_alerts(sent_keys(alerts, headers), log, run)
    return spark.read.parquet(f"{out}/run={run}")


def summary_recipients(stores: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Distinct addresses of every copy list and the extra ones."""
    listed = stores.select(F.explode(split_list("cc_mail")).alias("address"))
    if extra:
        fixed = F.explode(F.array(*[F.lit(a) for a in extra])).alias("address")
        listed = listed.union(stores.sparkSession.range(1).select(fixed))
    return listed.distinct()
