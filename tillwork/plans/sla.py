"""Preparation time (KPT) and order-to-delivery (O2D) dashboards, reported day against month to date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions.text import has_text, scope_label
from ..functions.time import in_month_to, minutes_between
from ..operators.filters import p80_breach, valid_metric
from ..operators.joins import with_dimension, with_status_row
from ..operators.metrics import ORDERS, metric_histogram, sla_columns, sla_finish
from ..operators.pivot import unpivot
from ..session import stored

# Limits, names and labels of the published tables.
METRICS = ("kpt", "o2d")
LIMITS = {"kpt": 12.0, "o2d": 30.0}
AGGREGATORS = ("Swiggy", "Zomato")
OVERALL = "Overall"
PARAMETERS = (
    "Orders",
    "KPT",
    "O2D",
    "KPT P80",
    "O2D P80",
    "KPT Median",
    "O2D Median",
    "Breached Orders KPT",
    "Breached Orders O2D",
)


def enrich(
    orders: DataFrame, stores: DataFrame, channels: Sequence[str] | None, month: Column, reported: Column
) -> DataFrame:
    """Orders (or lines) of the month with store, kpt, o2d and the is_ftd flag.

    Both clocks start at the order time; negative spans count as zero, missing
    ones stay missing, and a row without a preparation time is dropped.
    """
    kept = orders.filter(month)
    if channels is not None:
        kept = kept.filter(F.col("channel").isin(*channels))
    timed = kept.withColumns(
        {
            "kpt": N.round_he(N.clip_zero(minutes_between("order_time", "ready_time")), 1),
            "o2d": N.round_he(N.clip_zero(minutes_between("order_time", "delivered_time")), 1),
            # both halves so that a filter on the flag reaches the scan
            "is_ftd": reported.isNotNull() & reported,
        }
    )
    return with_dimension(timed.filter(valid_metric("kpt")), stores, "branch_code", "inner")


def allowed_channels(brands: Sequence[str], names: Sequence[str] = AGGREGATORS) -> list[str]:
    """The channels that the SLA reports admit: each aggregator's channel of each brand."""
    return [f"{name} {brand}" for name in names for brand in brands]


def enrich_day(orders: DataFrame, stores: DataFrame, channels: Sequence[str] | None, day: date) -> DataFrame:
    """Production form: month to date up to ``day``, reported day = ``day``."""
    return enrich(
        orders, stores, channels, in_month_to("invoice_day", day), F.col("invoice_day") == F.lit(day)
    )


def aggregator(channel: Column | str, names: Sequence[str] = AGGREGATORS) -> Column:
    """Which aggregator a channel text names (case-sensitive), else missing."""
    chain = None
    for name in names:
        hit = has_text(channel, name, ignore_case=False)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain


def histogram(sla: DataFrame, keys: Sequence[str] = ("region", "store_name")) -> DataFrame:
    """The month reduced to counts per (keys, aggregator, is_ftd, metric, tenth of a minute).

    Every order-grain dashboard below takes the enriched orders or, to scan them
    once for all dashboards, this table (written with ``session.written``).
    """
    if "tenths" in sla.columns:
        return sla
    tagged = sla.withColumn("aggregator", aggregator("channel"))
    return metric_histogram(tagged, [*keys, "aggregator", "is_ftd"], METRICS)


def headline(sla: DataFrame, names: Sequence[str] = AGGREGATORS) -> DataFrame:
    """metric, value: mean KPT per aggregator and overall, mean O2D, order count of the reported day."""
    day = histogram(sla.filter("is_ftd"), [])
    raw = day.agg(
        *[c for a in names for c in sla_columns(a.lower(), "kpt", F.col("aggregator") == a)[:2]],
        *sla_columns("kpt", "kpt")[:2],
        *sla_columns("o2d", "o2d")[:2],
    )

    def mean(prefix: str) -> Column:
        tenths = F.col(f"{prefix}_sum").cast("double") / F.col(f"{prefix}_n").cast("double")
        return F.rint(tenths) / 10.0

    cells = {f"{a} Avg KPT": mean(a.lower()) for a in names}
    cells["Overall Avg KPT"] = mean("kpt")
    cells["Overall Avg O2D"] = mean("o2d")
    cells["Total Orders"] = F.coalesce(F.col("kpt_n"), F.lit(0)).cast("double")
    return unpivot(raw, [], cells, "metric", "value")


def segments(names: Sequence[str] = AGGREGATORS) -> list[str]:
    return [f"{period} {name}" for period in ("FTD", "MTD") for name in (*names, OVERALL)]


def _in_segments(hist: DataFrame) -> DataFrame:
    """Histogram rows once per segment they belong to; the fan-out is on counts, not on orders."""
    who = F.array_compact(F.array(F.lit(OVERALL), F.col("aggregator")))
    when = F.array_compact(F.array(F.lit("MTD"), F.when(F.col("is_ftd"), F.lit("FTD"))))
    rows = hist.withColumn("_who", F.explode(who)).withColumn("_when", F.explode(when))
    return rows.withColumn("segment", F.concat_ws(" ", "_when", "_who"))


def matrix(
    sla: DataFrame, keys: Sequence[str] = (), names: Sequence[str] = AGGREGATORS, reported_only: bool = False
) -> DataFrame:
    """keys, parameter, and one column per segment: 9 parameters x {FTD, MTD} x {aggregators, overall}.

    ``reported_only`` keeps the keys with orders on the reported day, as the reduced table tells.
    """
    keys = list(keys)
    hist = histogram(sla, keys)
    for k in keys:
        hist = hist.filter(F.col(k).isNotNull())
    raw = _in_segments(hist).groupBy(*keys, "segment").agg(
        *sla_columns("kpt", "kpt", limit=LIMITS["kpt"]), *sla_columns("o2d", "o2d", limit=LIMITS["o2d"])
    )
    if reported_only:
        day = F.max(F.when(F.col("segment") == f"FTD {OVERALL}", F.col("kpt_n"))).over(W.partitionBy(*keys))
        raw = raw.withColumn("_day", day).filter("_day > 0").drop("_day")
    kpt, o2d = sla_finish("kpt", 1), sla_finish("o2d", 1)
    values = (
        F.coalesce(F.col("kpt_n"), F.lit(0)).cast("double"),
        kpt["mean"],
        o2d["mean"],
        kpt["p80"],
        o2d["p80"],
        kpt["median"],
        o2d["median"],
        F.col("kpt_breach").cast("double"),
        F.col("o2d_breach").cast("double"),
    )
    long = unpivot(raw, [*keys, "segment"], dict(zip(PARAMETERS, values)), "parameter", "value")
    counts = F.col("parameter").isin("Orders", "Breached Orders KPT", "Breached Orders O2D")
    cells = []
    for s in segments(names):
        cell = F.max(F.when(F.col("segment") == s, F.col("value")))
        # a segment without orders counts zero of them and has no times
        cells.append(F.coalesce(cell, F.when(counts, F.lit(0.0))).alias(s))
    return long.groupBy(*keys, "parameter").agg(*cells)


def region_matrix(sla: DataFrame, names: Sequence[str] = AGGREGATORS) -> DataFrame:
    """``matrix`` per region, for regions with orders on the reported day."""
    return matrix(sla, ["region"], names, reported_only=True)


def _two_periods(places: int, fill: float | None) -> tuple[list[Column], list[Column]]:
    raw, done = [], []
    for period, where in (("ftd", F.col("is_ftd")), ("mtd", F.lit(True))):
        for m in METRICS:
            raw += sla_columns(f"{period}_{m}", m, where)
    for period in ("ftd", "mtd"):
        for m in METRICS:
            parts = sla_finish(f"{period}_{m}", places, fill)
            done += [
                parts["mean"].alias(f"{period}_{m}"),
                parts["p80"].alias(f"{period}_{m}_p80"),
                parts["median"].alias(f"{period}_{m}_median"),
            ]
    return raw, done


def store_table(sla: DataFrame) -> DataFrame:
    """Region, aggregator, store: orders, mean, P80 and median of both clocks; stores of the reported day."""
    keys = ["region", "aggregator", "store_name"]
    hist = histogram(sla, ["region", "store_name"])
    for k in keys:
        hist = hist.filter(F.col(k).isNotNull())
    raw, done = _two_periods(2, 0.0)
    wide = hist.groupBy(*keys).agg(*raw)
    count = lambda p: F.coalesce(F.col(f"{p}_kpt_n"), F.lit(0)).cast("bigint").alias(f"{p}_orders")
    return wide.filter(F.col("ftd_kpt_n") > 0).select(*keys, count("ftd"), count("mtd"), *done)


def _scope_list() -> Column:
    """The scopes of a row: overall, and its region if it has one."""
    return F.array_compact(F.array(F.lit(OVERALL), scope_label("region")))


# How an element counts its orders: categories by invoice, items by sold line.
KINDS = {"Category": ("category_name", "distinct"), "Item": ("item_name", "count")}


def element_tables(lines: DataFrame, kinds: Sequence[str], by_region: bool = False, reported_only: bool = False) -> DataFrame:
    """kind, (scope,) element: orders and both clocks, reported day and month.

    One pass over the lines reduces them to counts per value and to distinct
    invoices; percentiles are taken on that table only. Values fan out to their scopes
    on the reduced table; distinct invoices must do so before.
    ``reported_only`` keeps the scopes with lines on the reported day, and the overall scope, as the
    reduced table tells; lines without an element count there, too.
    """
    distinct = [k for k in kinds if KINDS[k][1] == "distinct"]
    cells = []
    for kind in kinds:
        order = F.col("invoice") if kind in distinct else F.lit(None).cast(lines.schema["invoice"].dataType)
        cells.append(
            F.struct(F.lit(kind).alias("kind"), F.col(KINDS[kind][0]).alias("element"), order.alias("_invoice"))
        )
    region = ["region"] if by_region else []
    rows = lines.select(*region, "is_ftd", *METRICS, F.inline(F.array(*cells)))
    rows = rows if reported_only else rows.filter(F.col("element").isNotNull())
    base = [*region, "kind", "element", "is_ftd"]
    # without an invoice there is no cell to spread
    spread = F.when(F.col("_invoice").isNotNull(), _scope_list()).otherwise(F.array().cast("array<string>")) if by_region else None
    hist = metric_histogram(rows, base, METRICS, "_invoice" if distinct else None, spread if distinct else None)
    keys = ["kind", "scope", "element"] if by_region else ["kind", "element"]
    if by_region:
        own = F.array("scope") if distinct else F.array()
        fan = F.when(F.col("scope").isNotNull(), own).otherwise(_scope_list()) if distinct else _scope_list()
        hist = hist.withColumn("_scopes", fan).withColumn("scope", F.explode("_scopes")).drop("_scopes", "region")
    # a line always has a preparation time, so counting lines is counting kpt values
    unit = F.col("metric") == F.when(F.col("kind").isin(*distinct), ORDERS).otherwise("kpt")
    total = lambda test: F.coalesce(F.sum(F.when(unit & test, F.col("n"))), F.lit(0)).cast("bigint")
    raw, done = _two_periods(2, 0.0)
    wide = hist.groupBy(*keys).agg(
        total(F.col("is_ftd")).alias("ftd_orders"), total(F.lit(True)).alias("mtd_orders"), *raw
    )
    if reported_only:
        day = F.max("ftd_kpt_n").over(W.partitionBy("scope"))
        wide = wide.withColumn("_day", day).filter((F.col("_day") > 0) | (F.col("scope") == OVERALL))
        wide = wide.filter(F.col("element").isNotNull())
    return wide.select(*keys, "ftd_orders", "mtd_orders", *done)


def category_table(lines: DataFrame, by_region: bool = False, reported_only: bool = False) -> DataFrame:
    table = element_tables(lines, ["Category"], by_region, reported_only)
    return table.drop("kind").withColumnRenamed("element", "category_name")


def item_table(lines: DataFrame, by_region: bool = False, reported_only: bool = False) -> DataFrame:
    table = element_tables(lines, ["Item"], by_region, reported_only)
    return table.drop("kind").withColumnRenamed("element", "item_name")


# The texts of the published flags.
ISSUE_REGION = "Target Dropped in Region"
ISSUE_KPT = "High Prep Time (KPT)"
ISSUE_O2D = "Logistics Delay (O2D)"
CLEAR_TYPE, CLEAR_ELEMENT = "Status Log", "All Categories & Items"
CLEAR_TEXT = "All metrics within targeted SLA parameters"
FLAG_COLUMNS = ("scope", "type", "element", "orders", "kpt_p80", "o2d_p80", "issue")


def root_causes(lines: DataFrame, min_overall: int = 5, min_region: int = 3) -> DataFrame:
    """Categories and items whose reported-day P80 breaks a limit, overall and per region."""
    tables = element_tables(lines.filter("is_ftd"), list(KINDS), by_region=True)
    overall = F.col("scope") == OVERALL
    least = F.when(F.col("kind") == "Category", 0).when(overall, min_overall).otherwise(min_region)
    kpt, o2d = F.col("ftd_kpt_p80"), F.col("ftd_o2d_p80")
    issue = F.when(~overall, ISSUE_REGION).when(kpt > 12.0, ISSUE_KPT).otherwise(ISSUE_O2D)
    return tables.filter(p80_breach(kpt, o2d, F.col("ftd_orders"), least)).select(
        "scope",
        F.col("kind").alias("type"),
        "element",
        F.col("ftd_orders").alias("orders"),
        kpt.alias("kpt_p80"),
        o2d.alias("o2d_p80"),
        issue.alias("issue"),
    )


def in_report_order(flags: DataFrame) -> DataFrame:
    """Overall first, then regions by name; categories before items; most orders first."""
    return flags.orderBy(
        F.when(F.col("scope") == OVERALL, 0).otherwise(1),
        "scope",
        F.when(F.col("type") == "Category", 0).otherwise(1),
        F.desc("orders"),
        "element",
    )


def with_all_clear(flags: DataFrame) -> DataFrame:
    """The flags, or one status row of the same columns when nothing is flagged."""
    row = flags.sparkSession.range(1).select(
        F.lit(OVERALL).alias("scope"),
        F.lit(CLEAR_TYPE).alias("type"),
        F.lit(CLEAR_ELEMENT).alias("element"),
        F.lit(0).cast("bigint").alias("orders"),
        F.lit(0.0).alias("kpt_p80"),
        F.lit(0.0).alias("o2d_p80"),
        F.lit(CLEAR_TEXT).alias("issue"),
    )
    return with_status_row(stored(flags, "flags"), row)


def with_bands(table: DataFrame) -> DataFrame:
    """The colour band of every mean clock column present."""
    bands = {}
    for period in ("ftd", "mtd"):
        bands[f"{period}_kpt_band"] = N.kpt_band(f"{period}_kpt")
        bands[f"{period}_o2d_band"] = N.o2d_band(f"{period}_o2d")
    return table.withColumns(bands)
