"""The raw landing tables of one day: every dataset as it came, flat enough to publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators.joins import only_listed
from ..operators.shape import explode_objects, first_present, flatten_structs
from ..sources import landed
from ..sources.sinks import raw_landing, refresh

# Table -> landed dataset, with its declared schema where one is known.
DATASETS: dict[str, tuple[str, T.StructType | None]] = {
    "availability_current": ("soldout_current", None),
    "availability_history": ("soldout_events", S.SOLDOUT_EVENT),
    "inventory_store_items": ("store_items", None),
    "inventory_activity": ("item_activity", S.ITEM_ACTIVITY),
    "consumption_sales": ("sales_orders", S.SALES_ORDER),
    "consumption_shrinkage": ("shrinkage", None),
    "analytics_coupons": ("coupon_transactions", None),
    "outlet_timings": ("outlet_timings", None),
}


def raw_table(
    spark: SparkSession,
    root: str,
    table: str,
    day: date,
    stores: DataFrame | None = None,
    schemas: Mapping[str, T.StructType] | None = None,
) -> DataFrame:
    """One landing table: nested objects flattened, order items one per row, lists as JSON.

    A dataset without a declared schema keeps each record as JSON text beside its branch code; pass a
    schema to have its fields as columns. No schema is ever inferred from the files.
    """
    dataset, known = DATASETS[table]
    schema = (schemas or {}).get(table, known)
    path = f"{root}/{dataset}"
    if schema is None:
        df = landed.snapshot(spark, path, days=[day])
    else:
        df = landed.scan_records(spark, path, schema, days=[day])
        df = df.withColumn("branchCode", first_present(df, [n for n in S.CODE_NAMES if n in df.columns] or ["branchCode"]))
        df = df.drop(*[n for n in S.CODE_NAMES if n != "branchCode"])
    if "items" in df.columns:
        df = explode_objects(df, "items", "item_")
    df = flatten_structs(df).withColumn("branchCode", F.trim("branchCode"))
    if stores is not None:
        df = only_listed(df, stores.select(F.col("branch_code").alias("branchCode")), "branchCode")
    return raw_landing(df, table)


def publish(
    spark: SparkSession, root: str, out: str, day: date, stores: DataFrame | None = None, tables: Sequence[str] = ()
) -> None:
    """Refresh the day's partition of every landing table."""
    for table in tables or DATASETS:
        refresh(raw_table(spark, root, table, day, stores), f"{out}/{table}", as_of=day)
