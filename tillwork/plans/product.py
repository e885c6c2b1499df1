"""Product dashboards: today against last week and the week before.

Input lines (one row per order line): branch_code, brand, invoice, channel,
status, order_time (local), item_name, quantity, gross, discount, net,
discounts and item_discounts (arrays of struct<name>).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.numeric import change_pct, growth_pct, pct, round_he, safe_div
from ..functions.time import Period, tag_period, utc_to_zone
from ..operators.filters import not_addon
from ..operators.joins import with_dimension
from ..operators.metrics import period_compare, top_k
from ..operators.shape import explode_objects

CUR, LW, L2W = "CURRENT", "LW", "L2W"
SOURCES = ("In Store", "Swiggy", "Zomato")
MONEY = "decimal(18,4)"


def order_lines(orders: DataFrame, zone: str | None = None) -> DataFrame:
    """Nested orders to lines; orders without items have no line here."""
    rows = explode_objects(orders, "items", "item_", outer=False)
    created = utc_to_zone("created_utc", zone) if zone else utc_to_zone("created_utc")
    return rows.select(
        "branch_code",
        "brand",
        "invoice",
        "channel",
        "status",
        created.alias("order_time"),
        F.col("item_shortName").alias("item_name"),
        F.col("item_categoryName").alias("category_name"),
        # exact, so that sums do not depend on the order of the rows
        *[
            F.coalesce(F.col(src).try_cast(MONEY), F.lit(0).cast(MONEY)).alias(dst)
            for src, dst in (
                ("item_quantity", "quantity"),
                ("item_baseGrossAmount", "gross"),
                ("item_baseNetDiscountAmount", "discount"),
                ("item_baseNetAmount", "net"),
            )
        ],
        "discounts",
        F.col("item_discounts").alias("item_discounts"),
    )


def line_base(
    lines: DataFrame,
    stores: DataFrame,
    items: DataFrame,
    periods: Sequence[Period],
    channel_rules: Sequence[tuple[str, Sequence[str]]] = X.CHANNEL_RULES,
) -> DataFrame:
    """Lines of known stores inside the windows, with period, dimensions and channel group; any status."""
    tagged = tag_period(lines, "order_time", periods)
    priced = tagged.withColumns(
        {
            "discount": F.abs("discount"),
            "item_key": X.key_of("item_name"),
            "channel_group": X.channel_group("channel", channel_rules),
        }
    )
    stored = with_dimension(priced, stores, "branch_code", "inner")
    return with_dimension(stored, items, "item_key").filter(not_addon("product_mix"))


def sales_line_mart(
    lines: DataFrame,
    stores: DataFrame,
    items: DataFrame,
    periods: Sequence[Period],
    channel_rules: Sequence[tuple[str, Sequence[str]]] = X.CHANNEL_RULES,
    closed: str = "CLOSED",
) -> DataFrame:
    """Closed lines with both offer codes: what every dashboard below reads."""
    kept = lines.filter(X.same_text("status", closed))
    base = line_base(kept, stores, items, periods, channel_rules)
    return base.withColumns(
        {"bracket_code": X.bracket_code("item_discounts"), "voucher_code": X.voucher_code("discounts")}
    ).drop("discounts", "item_discounts")


# What any dashboard groups or filters by, and what it sums.
MART_KEYS = (
    "region", "brand", "channel", "channel_group", "product_mix", "category_group", "item_group",
    "bracket_code", "voucher_code", "period", "invoice",
)
MART_SUMS = ("quantity", "gross", "discount", "net")


def invoice_mart(mart: DataFrame) -> DataFrame:
    """The mart for a whole set of dashboards: one row per invoice and its attributes.

    Write it once bucketed by invoice (``with session.written_by(.., "invoice") as mart``) and
    build all dashboards on that: counting distinct orders then exchanges no lines.
    Lines are summed first, so an invoice with very many lines is short by the
    time its rows meet in a bucket.
    """
    return mart.groupBy(*MART_KEYS).agg(F.count(F.lit(1)).alias("lines"), *[F.sum(m).alias(m) for m in MART_SUMS])


def _lines_column(mart: DataFrame) -> str | None:
    return "lines" if "lines" in mart.columns else None


COUNTED = ("OPEN", "VOIDED")


def status_lines(lines: DataFrame, periods: Sequence[Period], names: Sequence[str] = (CUR, LW)) -> tuple[DataFrame, list[Period]]:
    """The lines that ``order_status_counts`` counts, and their windows: the others need not be joined with dimensions."""
    return lines.filter(F.upper(F.trim("status")).isin(*COUNTED)), [p for p in periods if p.name in names]


def order_status_counts(base: DataFrame, periods: Sequence[str] = (CUR, LW)) -> DataFrame:
    """One row: distinct open and distinct voided orders, counted after one reduction per invoice."""
    seen = base.filter(F.col("period").isin(*periods)).select(F.upper("status").alias("status"), "invoice").distinct()
    known = F.col("invoice").isNotNull()
    return seen.agg(
        F.count_if((F.col("status") == "OPEN") & known).alias("open_orders"),
        F.count_if((F.col("status") == "VOIDED") & known).alias("voided_orders"),
    )


def mix_compare(mart: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per brand and product mix of today's sales: orders, gross, discount, discount % today and last week."""
    group = [*keys, "brand", "product_mix"]
    wide = period_compare(
        mart, group, {CUR: ["gross", "discount"], LW: ["gross", "discount"], L2W: []}, how="left", fill=False
    )
    return wide.select(
        *group,
        F.col("current_orders").alias("today_orders"),
        F.col("current_gross").alias("today_gross"),
        F.col("current_discount").alias("today_discount"),
        pct("current_discount", "current_gross", 1).alias("today_dis_pct"),
        "lw_orders",
        "lw_gross",
        "lw_discount",
        F.when(F.col("lw_orders").isNotNull(), pct("lw_discount", "lw_gross", 1)).alias("lw_dis_pct"),
        "l2w_orders",
    )


def mix_by_source(mart: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    return mix_compare(mart.filter(F.col("channel_group").isin(*sources)), ["channel_group"])


def region_source_mix(mart: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    return mix_compare(mart.filter(F.col("channel_group").isin(*sources)), ["region", "channel_group"])


def _growth_table(mart: DataFrame, group: Sequence[str], orders: str, live: str | None = None) -> DataFrame:
    wide = period_compare(
        mart, group, {CUR: ["gross", "discount"], LW: ["gross", "discount"], L2W: []}, how="full", orders=orders,
        rows=_lines_column(mart), live=live,
    )
    return wide.select(
        *group,
        F.col("current_orders").alias("today_orders"),
        "lw_orders",
        "l2w_orders",
        pct("current_discount", "current_gross", 1).alias("today_dis_pct"),
        pct("lw_discount", "lw_gross", 1).alias("lw_dis_pct"),
        growth_pct("current_orders", "lw_orders").alias("today_growth_pct"),
        growth_pct("lw_orders", "l2w_orders").alias("lw_growth_pct"),
    )


def category_compare(mart: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per brand and category of any period: distinct orders of three weeks, discount %, order growth."""
    return _growth_table(mart, [*keys, "brand", "category_group"], "distinct")


def category_by_source(mart: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    return category_compare(mart.filter(F.col("channel_group").isin(*sources)), ["channel_group"])


def region_category(mart: DataFrame) -> DataFrame:
    """As ``category_compare`` per region; only regions that sold today."""
    return _growth_table(mart, ["region", "brand", "category_group"], "distinct", live="region")


def item_compare(mart: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per brand and item group; an order here is a sold line."""
    return _growth_table(mart, [*keys, "brand", "item_group"], "count")


def item_by_source(mart: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    return item_compare(mart.filter(F.col("channel_group").isin(*sources)), ["channel_group"])


def category_channel_growth(mart: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    """Per channel group and category, all brands: volumes of today and last week, net revenue growth."""
    measures = ["quantity", "net", "gross", "discount"]
    wide = period_compare(
        mart.filter(F.col("channel_group").isin(*sources)),
        ["channel_group", "category_group"],
        {CUR: measures, LW: measures},
        how="left",
    )
    return wide.select(
        "channel_group",
        "category_group",
        F.col("current_orders").alias("orders"),
        F.col("current_quantity").alias("qty_sold"),
        F.col("current_net").alias("net_rev"),
        F.col("current_gross").alias("gross_rev"),
        F.col("current_discount").alias("discount"),
        pct("current_discount", "current_gross", 1).alias("dis_pct"),
        F.col("lw_net").alias("lw_net_rev"),
        F.col("lw_gross").alias("lw_gross_rev"),
        F.col("lw_quantity").alias("lw_qty"),
        "lw_orders",
        "lw_discount",
        pct("lw_discount", "lw_gross", 1).alias("lw_dis_pct"),
        change_pct("current_net", "lw_net").alias("growth_pct"),
    )


def by_revenue(df: DataFrame) -> DataFrame:
    """Report order of a channel table: net revenue falling, category as tie-break."""
    return df.orderBy("channel_group", F.desc("net_rev"), "category_group")


def offer_performance(
    mart: DataFrame, code: str, aggregator: str, k: int | None = 15, denominator: str = "gross"
) -> DataFrame:
    """Per brand, the k offer codes with most orders on one aggregator, with last week's twins."""
    measures = ["quantity", "net", "gross", "discount"]
    wide = period_compare(
        mart.filter(X.has_text("channel", aggregator)).withColumn("code", F.col(code)),
        ["brand", "code"],
        {CUR: measures, LW: measures},
        how="left",
    )
    out = wide.select(
        "brand",
        "code",
        F.col("current_orders").alias("orders"),
        F.col("current_quantity").alias("qty_sold"),
        F.col("current_net").alias("net_rev"),
        F.col("current_discount").alias("discount_given"),
        pct("current_discount", f"current_{denominator}", 1).alias("dis_pct"),
        round_he(safe_div("current_net", "current_orders"), 1).alias("aov"),
        "lw_orders",
        F.col("lw_quantity").alias("lw_qty"),
        F.col("lw_net").alias("lw_net_rev"),
        "lw_discount",
        pct("lw_discount", f"lw_{denominator}", 1).alias("lw_dis_pct"),
        round_he(safe_div("lw_net", "lw_orders"), 1).alias("lw_aov"),
    )
    return out if k is None else top_k(out, ["brand"], [F.desc("orders"), F.asc("code")], k)


def top_items(item_table: DataFrame, k: int = 10) -> DataFrame:
    """The k items with most orders today per brand."""
    return top_k(item_table, ["brand"], [F.desc("today_orders"), F.asc("item_group")], k)


def growth_bands(table: DataFrame) -> DataFrame:
    from ..functions.numeric import sign_band

    return table.withColumns(
        {"today_band": sign_band("today_growth_pct"), "lw_band": sign_band("lw_growth_pct")}
    )
