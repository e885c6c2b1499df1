"""Stock ledger: item-day balances, activities, stock-on-hand ratios, movement union."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pct, round_he, sum0
from ..functions.text import percent_text, same_text
from ..functions.time import run_stamp
from ..operators.joins import only_listed, with_dimension
from ..operators.pivot import transpose, value_pivot
from ..operators.shape import explode_objects, lead, tag, union_all

BALANCES = ("opening_cost", "opening_qty", "closing_cost", "closing_qty")
KPIS = {
    "Opening Cost": "opening_cost",
    "Opening Qty": "opening_qty",
    "Closing Cost": "closing_cost",
    "Closing Qty": "closing_qty",
    "Stock on Hand Cost %": "soh_cost_pct",
    "Stock on Hand Qty %": "soh_qty_pct",
}
AMOUNT = "decimal(18,4)"


def amount(x: Column | str) -> Column:
    """Lenient exact number, zero when missing."""
    x = F.col(x) if isinstance(x, str) else x
    return F.coalesce(x.try_cast(AMOUNT), F.lit(0).cast(AMOUNT))


def item_days(activity: DataFrame, stores: DataFrame) -> DataFrame:
    """Ledger rows at item-day grain with their store; rows without an activity list are not in the ledger."""
    kept = activity.filter(F.col("activities").isNotNull())
    clean = kept.withColumns({b: amount(b) for b in BALANCES})
    return with_dimension(clean, stores.select("branch_code", "store_name", "region"), "branch_code", "inner")


def ledger_master(days: DataFrame) -> DataFrame:
    """One row per activity (an item-day with an empty list keeps one), amounts absolute.

    Balances repeat on every activity of their item-day here: sum them from ``item_days`` only.
    """
    rows = explode_objects(days, "activities", "activity_", outer=True)
    out = rows.withColumns(
        {
            "activity_quantity": F.abs(amount("activity_quantity")),
            "activity_cost": F.abs(amount("activity_cost")),
        }
    )
    return lead(out, ["branch_code", "store_name", "region", "activity_date"])


def day_amounts(days: DataFrame) -> DataFrame:
    """Balances and sales of one item-day on one row: the sales are summed inside its own list.

    Keeping the item-day grain lets one aggregation serve the semi-additive
    balances and the additive sales; nothing is exploded or joined back.
    """
    sales = F.filter("activities", lambda a: same_text(a["type"], "SALES"))

    def total(field: str) -> Column:
        zero = F.lit(0).cast("decimal(38,4)")
        return F.aggregate(sales, zero, lambda acc, a: (acc + F.abs(amount(a[field]))).cast("decimal(38,4)"))

    return days.withColumns(
        {"sales_cost": total("cost"), "sales_qty": total("quantity"), "has_sales": F.size(sales) > 0}
    ).drop("activities")


def stock_ratio(
    days: DataFrame, keys: Sequence[str], first: date, last: date, places: int | None = None
) -> DataFrame:
    """Per key: opening of the first day, closing of the last, sales between, and sales / closing %."""
    base = day_amounts(days).filter(F.col("activity_date").between(F.lit(first), F.lit(last)))
    for k in keys:
        base = base.filter(F.col(k).isNotNull())
    at_first, at_last = F.col("activity_date") == F.lit(first), F.col("activity_date") == F.lit(last)
    out = base.groupBy(*keys).agg(
        sum0(F.when(at_first, F.col("opening_cost"))).cast("double").alias("opening_cost"),
        sum0(F.when(at_first, F.col("opening_qty"))).cast("double").alias("opening_qty"),
        sum0(F.when(at_last, F.col("closing_cost"))).cast("double").alias("closing_cost"),
        sum0(F.when(at_last, F.col("closing_qty"))).cast("double").alias("closing_qty"),
        sum0("sales_cost").cast("double").alias("sales_cost"),
        sum0("sales_qty").cast("double").alias("sales_qty"),
        F.count_if(at_first | at_last | F.col("has_sales")).alias("_seen"),
    )
    # a key with neither an opening, a closing nor a sale is not reported
    return out.filter("_seen > 0").drop("_seen").withColumns(
        {
            "soh_cost_pct": pct("sales_cost", "closing_cost", places),
            "soh_qty_pct": pct("sales_qty", "closing_qty", places),
        }
    )


def store_summary(days: DataFrame, first: date, last: date) -> DataFrame:
    return stock_ratio(days, ["region", "store_name"], first, last)


def region_summary(days: DataFrame, first: date, last: date) -> DataFrame:
    """Region sums over known stores, ratios recomputed from the sums, not averaged over stores."""
    return stock_ratio(days.filter(F.col("store_name").isNotNull()), ["region"], first, last)


def region_transposed(summary: DataFrame, regions: Sequence[str]) -> DataFrame:
    """KPI rows, one column per region, rounded to 2 places."""
    cells = {label: round_he(c, 2) for label, c in KPIS.items()}
    return transpose(summary, "region", regions, cells, "kpi")


def store_display(summary: DataFrame) -> DataFrame:
    """The published store table: ratios as percent text, sorted by region and store."""
    return (
        summary.withColumns(
            {"soh_cost_pct": percent_text("soh_cost_pct"), "soh_qty_pct": percent_text("soh_qty_pct")}
        )
        .drop("sales_cost", "sales_qty")
        .orderBy("region", "store_name")
    )


def daily_ratio(days: DataFrame) -> DataFrame:
    """Region, store, day: closing cost, sales cost and their ratio."""
    base = day_amounts(days)
    for k in ("region", "store_name", "activity_date"):
        base = base.filter(F.col(k).isNotNull())
    out = base.groupBy("region", "store_name", "activity_date").agg(
        sum0("closing_cost").cast("double").alias("closing_cost"),
        sum0("sales_cost").cast("double").alias("sales_cost"),
    )
    return out.withColumn("soh_cost_pct", pct("sales_cost", "closing_cost"))


def daily_matrix(days: DataFrame, dates: Sequence[date]) -> DataFrame:
    """Region, store, and one ratio column per known day, zero where a store has no ledger."""
    long = daily_ratio(days).withColumn("soh_cost_pct", round_he("soh_cost_pct", 2))
    labels = [d.isoformat() for d in dates]
    window = long.filter(F.col("activity_date").between(F.lit(dates[0]), F.lit(dates[-1])))
    return value_pivot(window, ["region", "store_name"], "activity_date", list(dates), "soh_cost_pct", labels)


def moved_skus(*movements: DataFrame) -> DataFrame:
    """Codes mentioned by transfers and receipts: the record's own, else those of its items; may repeat."""
    seen = []
    for m in movements:
        listed = F.transform(F.col("items"), lambda i: i["skuCode"])
        own = F.when(F.col("skuCode").isNotNull(), F.array("skuCode")).otherwise(listed)
        seen.append(m.select(F.explode(own).alias("skuCode")).filter(F.col("skuCode").isNotNull()))
    return union_all(*seen)


def movement_union(
    transfers: DataFrame, receipts: DataFrame, stock: DataFrame, source: str, stamp: Column | None = None
) -> DataFrame:
    """Transfers, receipts and the stock of the codes they mention (all stock when they mention none)."""
    kept = only_listed(stock, moved_skus(transfers, receipts), "skuCode", all_when_empty=True)
    parts = {"transfer": transfers, "receipt": receipts, "stock": kept}
    tagged = [tag(df, kind=kind) for kind, df in parts.items()]
    return tag(union_all(*tagged), source=source, fetched_at=run_stamp() if stamp is None else stamp)
