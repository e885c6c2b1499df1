"""SLA dashboards on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.metrics import sla_metrics
from ..plans import sla as P
from ..session import written
from ..sources.sinks import stacked
from . import roles as R
from .registry import query


def lines(spark, folder):
    month = F.col("order_time").between(
        F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"), F.lit("1998-06-30 23:59:59").cast("timestamp_ntz")
    )
    reported = F.col("invoice_day").between(F.lit(R.FTD[0]), F.lit(R.FTD[1]))
    return P.enrich(R.sla_lines(spark, folder), R.stores(spark, folder), R.SLA_CHANNELS, month, reported)


def p(metric: str, q: float, places: int, cond: str = "TRUE") -> str:
    """SQL: percentile in minutes from tenths, half-even."""
    scale = f"{10.0 ** (places - 1)}"
    return f"round_even(quantile_cont({metric}, {q}) FILTER ({cond}) * {scale}, 0) / ({scale} * 10.0)"


def mean(metric: str, places: int, cond: str = "TRUE") -> str:
    scale = f"{10.0 ** (places - 1)}"
    return (
        f"round_even(CAST(sum(CAST({metric} AS BIGINT)) FILTER ({cond}) AS DOUBLE)"
        f" / CAST(count({metric}) FILTER ({cond}) AS DOUBLE) * {scale}, 0) / ({scale} * 10.0)"
    )


@query(
    "sla_enrich",
    f"""WITH {R.SLA_SQL}
SELECT invoice, branch_code, store_name, region, category_name, item_name, kpt / 10.0 AS kpt, o2d / 10.0 AS o2d,
       CAST(is_ftd AS INTEGER) AS is_ftd
FROM (SELECT *, CAST(l_suppkey AS VARCHAR) AS branch_code FROM sla)""",
)
def sla_enrich(spark, folder):
    return lines(spark, folder).select(
        "invoice", "branch_code", "store_name", "region", "category_name", "item_name", "kpt", "o2d",
        F.col("is_ftd").cast("int").alias("is_ftd"),
    )


@query(
    "sla_headline",
    f"""WITH {R.SLA_SQL}, ftd AS (SELECT * FROM sla WHERE is_ftd),
one AS (SELECT {mean('kpt', 1, "aggregator = 'Swiggy'")} AS a, {mean('kpt', 1, "aggregator = 'Zomato'")} AS b,
               {mean('kpt', 1)} AS k, {mean('o2d', 1)} AS o, CAST(count(*) AS DOUBLE) AS n FROM ftd)
SELECT 'Swiggy Avg KPT' AS metric, a AS value FROM one UNION ALL SELECT 'Zomato Avg KPT', b FROM one
UNION ALL SELECT 'Overall Avg KPT', k FROM one UNION ALL SELECT 'Overall Avg O2D', o FROM one
UNION ALL SELECT 'Total Orders', n FROM one""",
)
def sla_headline(spark, folder):
    return P.headline(lines(spark, folder))


def matrix_sql(region: str = "", having: str = "") -> str:
    segs = []
    for period, ftd in (("FTD", "is_ftd"), ("MTD", "TRUE")):
        for who, cond in (
            ("Swiggy", "coalesce(aggregator = 'Swiggy', FALSE)"),
            ("Zomato", "coalesce(aggregator = 'Zomato', FALSE)"),
            ("Overall", "TRUE"),
        ):
            segs.append((f"{period} {who}", f"{ftd} AND {cond}"))
    params = {
        "Orders": lambda c: f"CAST(count(*) FILTER ({c}) AS DOUBLE)",
        "KPT": lambda c: mean("kpt", 1, c),
        "O2D": lambda c: mean("o2d", 1, c),
        "KPT P80": lambda c: p("kpt", 0.8, 1, c),
        "O2D P80": lambda c: p("o2d", 0.8, 1, c),
        "KPT Median": lambda c: p("kpt", 0.5, 1, c),
        "O2D Median": lambda c: p("o2d", 0.5, 1, c),
        "Breached Orders KPT": lambda c: f"CAST(count(*) FILTER (kpt > 120 AND {c}) AS DOUBLE)",
        "Breached Orders O2D": lambda c: f"CAST(count(*) FILTER (o2d > 300 AND {c}) AS DOUBLE)",
    }
    key = f"{region}, " if region else ""
    group = f"WHERE {region} IS NOT NULL GROUP BY {region} {having}" if region else ""
    parts = []
    for label, expr in params.items():
        cells = ", ".join(f'{expr(c)} AS "{name}"' for name, c in segs)
        parts.append(f"SELECT {key}'{label}' AS parameter, {cells} FROM sla {group}")
    return f"WITH {R.SLA_SQL} " + "\nUNION ALL ".join(parts)


query("sla_matrix", matrix_sql())(lambda s, d: P.matrix(lines(s, d)))
query("sla_region_matrix", matrix_sql("region", "HAVING bool_or(is_ftd)"))(lambda s, d: P.region_matrix(lines(s, d)))


@query(
    "sla_dashboard_set",
    f"""WITH {R.SLA_SQL}
SELECT 'overall' AS section, parameter AS element, "FTD Overall" AS ftd, "MTD Overall" AS mtd FROM ({matrix_sql()})
UNION ALL SELECT 'region', region || ' ' || parameter, "FTD Overall", "MTD Overall"
FROM ({matrix_sql("region", "HAVING bool_or(is_ftd)")})
UNION ALL SELECT 'store', region || ' ' || aggregator || ' ' || store_name, CAST(count(*) FILTER (is_ftd) AS DOUBLE), CAST(count(*) AS DOUBLE)
FROM sla WHERE aggregator IS NOT NULL AND region IS NOT NULL GROUP BY region, aggregator, store_name HAVING bool_or(is_ftd)
UNION ALL SELECT 'headline', 'Total Orders', CAST(count(*) AS DOUBLE), NULL FROM sla WHERE is_ftd""",
)
def sla_dashboard_set(spark, folder):
    """All order-grain dashboards from one written histogram: the orders are scanned once."""
    hist = written(P.histogram(lines(spark, folder)))
    cells = lambda df, *names: df.select(
        F.concat_ws(" ", *names).alias("element"), F.col("FTD Overall").alias("ftd"), F.col("MTD Overall").alias("mtd")
    )
    stores = P.store_table(hist).select(
        F.concat_ws(" ", "region", "aggregator", "store_name").alias("element"),
        F.col("ftd_orders").cast("double").alias("ftd"),
        F.col("mtd_orders").cast("double").alias("mtd"),
    )
    total = P.headline(hist).filter("metric = 'Total Orders'")
    return stacked(
        {
            "overall": cells(P.matrix(hist), "parameter"),
            "region": cells(P.region_matrix(hist), "region", "parameter"),
            "store": stores,
            "headline": total.select(F.col("metric").alias("element"), F.col("value").alias("ftd")),
        }
    )


def two_periods(orders: str, mtd_orders: str) -> str:
    cells = [f"{orders} AS ftd_orders", f"{mtd_orders} AS mtd_orders"]
    for period, cond in (("ftd", "is_ftd"), ("mtd", "TRUE")):
        for m in ("kpt", "o2d"):
            cells += [
                f"coalesce({mean(m, 2, cond)}, 0.0) AS {period}_{m}",
                f"coalesce({p(m, 0.8, 2, cond)}, 0.0) AS {period}_{m}_p80",
                f"coalesce({p(m, 0.5, 2, cond)}, 0.0) AS {period}_{m}_median",
            ]
    return ",\n       ".join(cells)


LINES = "count(*) FILTER (is_ftd)", "count(*)"
INVOICES = "count(DISTINCT invoice) FILTER (is_ftd)", "count(DISTINCT invoice)"


@query(
    "sla_store",
    f"""WITH {R.SLA_SQL}
SELECT region, aggregator, store_name, {two_periods(*LINES)}
FROM sla WHERE aggregator IS NOT NULL AND region IS NOT NULL GROUP BY ALL HAVING bool_or(is_ftd)""",
)
def sla_store(spark, folder):
    return P.store_table(lines(spark, folder))


def element_sql(element: str, counts: tuple[str, str]) -> str:
    return f"WITH {R.SLA_SQL} SELECT {element}, {two_periods(*counts)} FROM sla GROUP BY {element}"


def scoped_sql(element: str, counts: tuple[str, str]) -> str:
    return f"""SELECT 'Overall' AS scope, {element}, {two_periods(*counts)} FROM sla GROUP BY {element}
UNION ALL SELECT 'Region: ' || region, {element}, {two_periods(*counts)} FROM sla
WHERE region IN (SELECT region FROM sla WHERE is_ftd) GROUP BY region, {element}"""


query("sla_category", element_sql("category_name", INVOICES))(lambda s, d: P.category_table(lines(s, d)))
query("sla_item", element_sql("item_name", LINES))(lambda s, d: P.item_table(lines(s, d)))
query("sla_category_by_region", f"WITH {R.SLA_SQL} {scoped_sql('category_name', INVOICES)}")(
    lambda s, d: P.category_table(lines(s, d), by_region=True, reported_only=True)
)
query("sla_item_by_region", f"WITH {R.SLA_SQL} {scoped_sql('item_name', LINES)}")(
    lambda s, d: P.item_table(lines(s, d), by_region=True, reported_only=True)
)

FLAGS_SQL = f"""WITH {R.SLA_SQL}, cats AS ({scoped_sql('category_name', INVOICES)}),
its AS ({scoped_sql('item_name', LINES)}),
both_kinds AS (
  SELECT scope, 'Category' AS type, category_name AS element, ftd_orders AS orders, ftd_kpt_p80 AS kpt_p80,
         ftd_o2d_p80 AS o2d_p80 FROM cats
  UNION ALL
  SELECT scope, 'Item', item_name, ftd_orders, ftd_kpt_p80, ftd_o2d_p80 FROM its
  WHERE ftd_orders >= CASE WHEN scope = 'Overall' THEN 5 ELSE 3 END),
flags AS (SELECT *, CASE WHEN scope <> 'Overall' THEN 'Target Dropped in Region'
                         WHEN kpt_p80 > 12 THEN 'High Prep Time (KPT)' ELSE 'Logistics Delay (O2D)' END AS issue
          FROM both_kinds WHERE kpt_p80 > 12 OR o2d_p80 > 35)
"""


@query("rca_flags", f"{FLAGS_SQL} SELECT * FROM flags")
def rca_flags(spark, folder):
    return P.in_report_order(P.root_causes(lines(spark, folder)))


@query(
    "sla_metrics_by_store",
    f"""WITH {R.SLA_SQL},
long AS (SELECT region, store_name, 'kpt' AS metric, kpt AS v, 120 AS lim FROM sla
         UNION ALL SELECT region, store_name, 'o2d', o2d, 300 FROM sla WHERE o2d IS NOT NULL)
SELECT region, store_name, metric, count(*) AS orders, {mean('v', 1)} AS avg, {p('v', 0.5, 1)} AS median,
       {p('v', 0.8, 1)} AS p80, count(*) FILTER (v > lim) AS breach,
       round_even(CAST(count(*) FILTER (v > lim) AS DOUBLE) / count(*) * 100.0 * 10.0, 0) / 10.0 AS breach_pct
FROM long WHERE region IS NOT NULL GROUP BY ALL""",
)
def sla_metrics_by_store(spark, folder):
    return sla_metrics(lines(spark, folder), ["region", "store_name"], P.LIMITS)


def band(x: str, lo: float, hi: float) -> str:
    return f"CASE WHEN {x} < {lo} THEN 'green' WHEN {x} <= {hi} THEN 'yellow' ELSE 'red' END"


@query(
    "sla_bands",
    f"""WITH {R.SLA_SQL}, t AS (SELECT category_name, {two_periods(*INVOICES)} FROM sla GROUP BY category_name)
SELECT category_name, ftd_kpt, ftd_o2d, mtd_kpt, mtd_o2d, {band('ftd_kpt', 12, 15)} AS ftd_kpt_band,
       {band('ftd_o2d', 30, 35)} AS ftd_o2d_band, {band('mtd_kpt', 12, 15)} AS mtd_kpt_band,
       {band('mtd_o2d', 30, 35)} AS mtd_o2d_band FROM t""",
)
def sla_bands(spark, folder):
    out = P.with_bands(P.category_table(lines(spark, folder)))
    return out.select(
        "category_name", "ftd_kpt", "ftd_o2d", "mtd_kpt", "mtd_o2d",
        "ftd_kpt_band", "ftd_o2d_band", "mtd_kpt_band", "mtd_o2d_band",
    )


@query(
    "rca_all_clear",
    f"""{FLAGS_SQL}, none AS (SELECT * FROM flags WHERE kpt_p80 > 100000)
SELECT * FROM none UNION ALL
SELECT 'Overall', 'Status Log', 'All Categories & Items', 0, 0.0, 0.0, 'All metrics within targeted SLA parameters'
WHERE NOT EXISTS (SELECT 1 FROM none)""",
)
def rca_all_clear(spark, folder):
    return P.with_all_clear(P.root_causes(lines(spark, folder)).filter("kpt_p80 > 100000"))
