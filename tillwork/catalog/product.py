"""Product dashboards on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import product as P
from ..session import stored, written_by
from ..sources.sinks import stacked
from . import roles as R
from .registry import query


def mart(spark, folder):
    return P.sales_line_mart(
        R.sales_lines(spark, folder), R.stores(spark, folder), R.items(spark, folder), R.PERIODS
    )


def dis(disc: str, den: str) -> str:
    """SQL: guarded discount percent to one place."""
    return (
        f"CASE WHEN {den} > 0 THEN round_even(CAST({disc} AS DOUBLE) / CAST({den} AS DOUBLE) * 100.0 * 10.0, 0) / 10.0"
        " ELSE 0.0 END"
    )


def grow(cur: str, prev: str) -> str:
    return (
        f"CASE WHEN {prev} > 0 THEN round_even((CAST({cur} AS DOUBLE) / {prev} - 1.0) * 100.0 * 10.0, 0) / 10.0 + 0.0"
        " ELSE 0.0 END"
    )


def mix_sql(extra: str = "", where: str = "") -> str:
    keys = f"{extra}brand, product_mix"
    using = f"USING ({keys})"

    def side(period: str, p: str) -> str:
        return (
            f"SELECT {keys}, count(DISTINCT invoice) AS {p}_orders, CAST(sum(gross) AS DOUBLE) AS {p}_gross,"
            f" CAST(abs(sum(discount)) AS DOUBLE) AS {p}_discount FROM mart"
            f" WHERE period = '{period}' AND product_mix IS NOT NULL {where} GROUP BY {keys}"
        )

    return f"""WITH {R.LINES_SQL},
cur AS ({side('CURRENT', 'today')}), lw AS ({side('LW', 'lw')}),
l2w AS (SELECT {keys}, count(DISTINCT invoice) AS l2w_orders FROM mart
        WHERE period = 'L2W' AND product_mix IS NOT NULL {where} GROUP BY {keys})
SELECT {keys}, today_orders, today_gross, today_discount, {dis('today_discount', 'today_gross')} AS today_dis_pct,
       lw_orders, lw_gross, lw_discount,
       CASE WHEN lw_orders IS NOT NULL THEN {dis('lw_discount', 'lw_gross')} END AS lw_dis_pct, l2w_orders
FROM cur LEFT JOIN lw {using} LEFT JOIN l2w {using}"""


SOURCES_SQL = "AND channel_group IN ('In Store', 'Swiggy', 'Zomato')"


def growth_sql(key: str, count: str, extra: str = "", where: str = "", having: str = "") -> str:
    keys = f"{extra}brand, {key}"
    using = f"USING ({keys})"

    def side(period: str, p: str) -> str:
        return (
            f"SELECT {keys}, {count} AS {p}_orders, sum(gross) AS {p}_gross, abs(sum(discount)) AS {p}_discount"
            f" FROM mart WHERE period = '{period}' AND {key} IS NOT NULL {where} GROUP BY {keys}"
        )

    return f"""WITH {R.LINES_SQL},
cur AS ({side('CURRENT', 'today')}), lw AS ({side('LW', 'lw')}), l2w AS ({side('L2W', 'l2w')}),
wide AS (
  SELECT {keys}, coalesce(today_orders, 0) AS today_orders, coalesce(lw_orders, 0) AS lw_orders,
         coalesce(l2w_orders, 0) AS l2w_orders, today_gross, today_discount, lw_gross, lw_discount
  FROM cur FULL JOIN lw {using} FULL JOIN l2w {using})
SELECT {keys}, today_orders, lw_orders, l2w_orders,
       {dis('today_discount', 'today_gross')} AS today_dis_pct, {dis('lw_discount', 'lw_gross')} AS lw_dis_pct,
       {grow('today_orders', 'lw_orders')} AS today_growth_pct, {grow('lw_orders', 'l2w_orders')} AS lw_growth_pct
FROM wide {having}"""


DISTINCT, COUNTED = "count(DISTINCT invoice)", "count(invoice)"

query("mix_compare", mix_sql())(lambda s, d: P.mix_compare(mart(s, d)))
query("mix_by_channel", mix_sql("channel_group, ", SOURCES_SQL))(lambda s, d: P.mix_by_source(mart(s, d)))
query("region_channel_mix", mix_sql("region, channel_group, ", SOURCES_SQL))(lambda s, d: P.region_source_mix(mart(s, d)))
query("category_compare", growth_sql("category_group", DISTINCT))(lambda s, d: P.category_compare(mart(s, d)))
query("category_by_channel", growth_sql("category_group", DISTINCT, "channel_group, ", SOURCES_SQL))(
    lambda s, d: P.category_by_source(mart(s, d))
)
query(
    "region_category_compare",
    growth_sql(
        "category_group",
        DISTINCT,
        "region, ",
        "",
        "WHERE region IN (SELECT region FROM mart WHERE period = 'CURRENT')",
    ),
)(lambda s, d: P.region_category(mart(s, d)))
query("item_compare", growth_sql("item_group", COUNTED))(lambda s, d: P.item_compare(mart(s, d)))
query("item_by_channel", growth_sql("item_group", COUNTED, "channel_group, ", SOURCES_SQL))(
    lambda s, d: P.item_by_source(mart(s, d))
)
query(
    "top_items_by_brand",
    growth_sql(
        "item_group",
        COUNTED,
        having="QUALIFY row_number() OVER (PARTITION BY brand ORDER BY today_orders DESC, item_group) <= 3",
    ),
)(lambda s, d: P.top_items(P.item_compare(mart(s, d)), 3))


@query(
    "category_channel_growth",
    f"""WITH {R.LINES_SQL},
cur AS (SELECT channel_group, category_group, count(DISTINCT invoice) AS orders, sum(quantity) AS qty_sold,
               sum(net) AS net_rev, sum(gross) AS gross_rev, abs(sum(discount)) AS discount
        FROM mart WHERE period = 'CURRENT' AND category_group IS NOT NULL {SOURCES_SQL} GROUP BY ALL),
lw AS (SELECT channel_group, category_group, count(DISTINCT invoice) AS lw_orders, sum(quantity) AS lw_qty,
              sum(net) AS lw_net_rev, sum(gross) AS lw_gross_rev, abs(sum(discount)) AS lw_discount
       FROM mart WHERE period = 'LW' AND category_group IS NOT NULL {SOURCES_SQL} GROUP BY ALL)
SELECT channel_group, category_group, orders, CAST(qty_sold AS DOUBLE) AS qty_sold, CAST(net_rev AS DOUBLE) AS net_rev,
       CAST(gross_rev AS DOUBLE) AS gross_rev, CAST(discount AS DOUBLE) AS discount,
       {dis('discount', 'gross_rev')} AS dis_pct,
       coalesce(CAST(lw_net_rev AS DOUBLE), 0.0) AS lw_net_rev, coalesce(CAST(lw_gross_rev AS DOUBLE), 0.0) AS lw_gross_rev,
       coalesce(CAST(lw_qty AS DOUBLE), 0.0) AS lw_qty, coalesce(lw_orders, 0) AS lw_orders,
       coalesce(CAST(lw_discount AS DOUBLE), 0.0) AS lw_discount, {dis('lw_discount', 'lw_gross_rev')} AS lw_dis_pct,
       CASE WHEN lw_net_rev > 0 THEN round_even((CAST(net_rev AS DOUBLE) - CAST(lw_net_rev AS DOUBLE))
            / CAST(lw_net_rev AS DOUBLE) * 100.0 * 10.0, 0) / 10.0 + 0.0 ELSE 0.0 END AS growth_pct
FROM cur LEFT JOIN lw USING (channel_group, category_group)""",
)
def category_channel_growth(spark, folder):
    return P.by_revenue(P.category_channel_growth(mart(spark, folder)))


def offer_sql(code: str, group: str) -> str:
    def side(period: str, o: str, q: str, n: str, x: str, g: str) -> str:
        return f"""SELECT brand, {code} AS code, count(DISTINCT invoice) AS {o}, CAST(sum(quantity) AS DOUBLE) AS {q},
       CAST(sum(net) AS DOUBLE) AS {n}, CAST(abs(sum(discount)) AS DOUBLE) AS {x}, CAST(sum(gross) AS DOUBLE) AS {g}
FROM mart WHERE period = '{period}' AND channel_group = '{group}' GROUP BY ALL"""

    return f"""WITH {R.LINES_SQL},
cur AS ({side('CURRENT', 'orders', 'qty_sold', 'net_rev', 'discount_given', 'gross')}),
lw AS ({side('LW', 'lw_orders', 'lw_qty', 'lw_net_rev', 'lw_discount', 'lw_gross')})
SELECT brand, code, orders, qty_sold, net_rev, discount_given, {dis('discount_given', 'gross')} AS dis_pct,
       round_even(net_rev / orders * 10.0, 0) / 10.0 AS aov,
       coalesce(lw_orders, 0) AS lw_orders, coalesce(lw_qty, 0.0) AS lw_qty, coalesce(lw_net_rev, 0.0) AS lw_net_rev,
       coalesce(lw_discount, 0.0) AS lw_discount, {dis('lw_discount', 'lw_gross')} AS lw_dis_pct,
       CASE WHEN lw_orders > 0 THEN round_even(lw_net_rev / lw_orders * 10.0, 0) / 10.0 ELSE 0.0 END AS lw_aov
FROM cur LEFT JOIN lw USING (brand, code)
QUALIFY row_number() OVER (PARTITION BY brand ORDER BY orders DESC, code) <= 3"""


query("offer_topk_bracket", offer_sql("bracket_code", "Swiggy"))(
    lambda s, d: P.offer_performance(mart(s, d), "bracket_code", "Swiggy", k=3)
)
query("offer_topk_voucher", offer_sql("voucher_code", "Zomato"))(
    lambda s, d: P.offer_performance(mart(s, d), "voucher_code", "Zomato", k=3)
)


def _section(name: str, sql: str, element: str, extra: str = "") -> str:
    scope = "channel_group" if extra else "'all'"
    return (
        f"SELECT '{name}' AS section, {scope} AS scope, brand, {element} AS element, today_orders,"
        f" coalesce(lw_orders, 0) AS lw_orders, coalesce(l2w_orders, 0) AS l2w_orders FROM ({sql})"
    )


@query(
    "dashboard_set",
    "\nUNION ALL ".join(
        [
            _section("mix", mix_sql(), "product_mix"),
            _section("category", growth_sql("category_group", DISTINCT), "category_group"),
            _section("item", growth_sql("item_group", COUNTED), "item_group"),
            _section("category by source", growth_sql("category_group", DISTINCT, "channel_group, ", SOURCES_SQL), "category_group", "x"),
        ]
    ),
)
def dashboard_set(spark, folder):
    """Four dashboards on one written mart, bucketed by invoice."""

    def section(df, element, scope="all"):
        return df.select(
            F.lit("all").alias("scope") if scope == "all" else F.col(scope).alias("scope"),
            "brand",
            F.col(element).alias("element"),
            "today_orders",
            *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("lw_orders", "l2w_orders")],
        )

    # the small result is written before the shared table goes
    with written_by(P.invoice_mart(mart(spark, folder)), "invoice") as shared:
        sections = {
            "mix": section(P.mix_compare(shared), "product_mix"),
            "category": section(P.category_compare(shared), "category_group"),
            "item": section(P.item_compare(shared), "item_group"),
            "category by source": section(P.category_by_source(shared), "category_group", "channel_group"),
        }
        return stored(stacked(sections), "dashboards")


@query(
    "order_status_counts",
    f"""WITH {R.LINES_SQL}
SELECT count(DISTINCT CASE WHEN status = 'OPEN' THEN invoice END) AS open_orders,
       count(DISTINCT CASE WHEN status = 'VOIDED' THEN invoice END) AS voided_orders
FROM base WHERE period IN ('CURRENT', 'LW')""",
)
def order_status_counts(spark, folder):
    lines, periods = P.status_lines(R.sales_lines(spark, folder), R.PERIODS)
    base = P.line_base(lines, R.stores(spark, folder), R.items(spark, folder), periods)
    return P.order_status_counts(base)


@query(
    "sales_line_mart",
    f"""WITH {R.LINES_SQL}
SELECT period, invoice, CAST(l_suppkey AS VARCHAR) AS branch_code, store_name, region, brand, item_key, item_group,
       product_mix, category_group, channel_group, voucher_code, bracket_code, CAST(quantity AS DOUBLE) AS quantity,
       CAST(gross AS DOUBLE) AS gross, CAST(discount AS DOUBLE) AS discount, CAST(net AS DOUBLE) AS net
FROM mart""",
)
def sales_line_mart(spark, folder):
    amounts = [F.col(c).cast("double").alias(c) for c in ("quantity", "gross", "discount", "net")]
    return mart(spark, folder).select(
        "period", "invoice", "branch_code", "store_name", "region", "brand", "item_key", "item_group", "product_mix",
        "category_group", "channel_group", "voucher_code", "bracket_code", *amounts,
    )


@query(
    "growth_bands",
    growth_sql("category_group", DISTINCT).replace(
        "FROM wide",
        f""", CASE WHEN {grow('today_orders', 'lw_orders')} >= 0 THEN 'positive' ELSE 'negative' END AS today_band,
       CASE WHEN {grow('lw_orders', 'l2w_orders')} >= 0 THEN 'positive' ELSE 'negative' END AS lw_band
FROM wide""",
    ),
)
def growth_bands(spark, folder):
    return P.growth_bands(P.category_compare(mart(spark, folder)))

