"""Stock ledger reports on the driver's tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..operators.shape import lead, relabel
from ..plans import stock as P
from ..sources.landed import missing_landings
from . import roles as R
from .registry import query

DATES = [R.STOCK_FIRST + timedelta(days=i) for i in range((R.STOCK_LAST - R.STOCK_FIRST).days + 1)]


def days(spark, folder):
    return P.item_days(R.ledger_month(spark, folder), R.stores(spark, folder))


@query(
    "ledger_master",
    f"""WITH {R.LEDGER_SQL},
acts AS (
  SELECT *, 'Sales' AS kind, qty AS q, gross * rate AS c FROM item_days WHERE rate > 0
  UNION ALL SELECT *, 'SHRINKAGE', 1, gross * tax FROM item_days WHERE l_returnflag = 'R'
  UNION ALL SELECT *, 'TRANSFER', 2, gross FROM item_days WHERE l_linestatus = 'O'
  UNION ALL SELECT *, NULL, 0, 0 FROM item_days WHERE NOT (rate > 0) AND l_returnflag <> 'R' AND l_linestatus <> 'O')
SELECT branch_code, store_name, region, CAST(activity_date AS VARCHAR) AS activity_date, sku_code, kind AS activity_type,
       CAST(q AS DOUBLE) AS activity_quantity, CAST(c AS DOUBLE) AS activity_cost, CAST(qty * 2 AS DOUBLE) AS opening_qty,
       CAST(gross AS DOUBLE) AS opening_cost, CAST(qty AS DOUBLE) AS closing_qty,
       CAST(gross - gross * rate AS DOUBLE) AS closing_cost
FROM acts""",
)
def ledger_master(spark, folder):
    out = P.ledger_master(days(spark, folder))
    numbers = ["activity_quantity", "activity_cost", "opening_qty", "opening_cost", "closing_qty", "closing_cost"]
    return out.withColumns(
        {
            "activity_date": F.col("activity_date").cast("string"),
            "activity_type": F.trim("activity_type"),
            **{c: F.col(c).cast("double") for c in numbers},
        }
    )


def summary_sql(keys: str) -> str:
    return f"""opening AS (SELECT {keys}, sum(gross) AS oc, sum(qty * 2) AS oq FROM item_days
             WHERE activity_date = DATE '1998-06-01' GROUP BY ALL),
closing AS (SELECT {keys}, sum(gross - gross * rate) AS cc, sum(qty) AS cq FROM item_days
             WHERE activity_date = DATE '1998-06-30' GROUP BY ALL),
sold AS (SELECT {keys}, sum(sales_cost) AS sc, sum(qty) AS sq FROM sales GROUP BY ALL),
summary AS (
  SELECT {keys}, CAST(coalesce(oc, 0) AS DOUBLE) AS opening_cost, CAST(coalesce(oq, 0) AS DOUBLE) AS opening_qty,
         CAST(coalesce(cc, 0) AS DOUBLE) AS closing_cost, CAST(coalesce(cq, 0) AS DOUBLE) AS closing_qty,
         CAST(coalesce(sc, 0) AS DOUBLE) AS sales_cost, CAST(coalesce(sq, 0) AS DOUBLE) AS sales_qty
  FROM opening FULL JOIN closing USING ({keys}) FULL JOIN sold USING ({keys})),
ratios AS (
  SELECT *, CASE WHEN closing_cost > 0 THEN sales_cost / closing_cost * 100.0 ELSE 0.0 END AS soh_cost_pct,
         CASE WHEN closing_qty > 0 THEN sales_qty / closing_qty * 100.0 ELSE 0.0 END AS soh_qty_pct
  FROM summary WHERE region IS NOT NULL)"""


query("stock_store", f"WITH {R.LEDGER_SQL}, {summary_sql('region, store_name')} SELECT * FROM ratios")(
    lambda s, d: P.store_summary(days(s, d), R.STOCK_FIRST, R.STOCK_LAST)
)
query("stock_region", f"WITH {R.LEDGER_SQL}, {summary_sql('region')} SELECT * FROM ratios")(
    lambda s, d: P.region_summary(days(s, d), R.STOCK_FIRST, R.STOCK_LAST)
)


def _percent(x: str) -> str:
    return f"regexp_replace(CAST(CAST(round_even({x} * 100.0, 0) / 100.0 AS DECIMAL(38,2)) AS VARCHAR), '0$', '') || '%'"


@query(
    "stock_store_display",
    f"""WITH {R.LEDGER_SQL}, {summary_sql('region, store_name')}
SELECT region, store_name, opening_cost, opening_qty, closing_cost, closing_qty,
       {_percent('soh_cost_pct')} AS soh_cost_pct, {_percent('soh_qty_pct')} AS soh_qty_pct FROM ratios""",
)
def stock_store_display(spark, folder):
    return P.store_display(P.store_summary(days(spark, folder), R.STOCK_FIRST, R.STOCK_LAST))


LABELS = {"region": "Region", "store_name": "Store Name", **{c: label for label, c in P.KPIS.items()}}


@query(
    "stock_store_report",
    f"WITH {R.LEDGER_SQL}, {summary_sql('region, store_name')} SELECT "
    + ", ".join(f'{c} AS "{label}"' for c, label in LABELS.items())
    + " FROM ratios",
)
def stock_store_report(spark, folder):
    """The store table under its report labels, keys first."""
    summary = P.store_summary(days(spark, folder), R.STOCK_FIRST, R.STOCK_LAST).drop("sales_cost", "sales_qty")
    return relabel(lead(summary, ["region", "store_name"]), LABELS)


def _transposed() -> str:
    rows = []
    for label, column in P.KPIS.items():
        cells = ", ".join(
            f"max(CASE WHEN region = '{r}' THEN round_even({column} * 100.0, 0) / 100.0 END) AS \"{r}\"" for r in R.REGIONS
        )
        rows.append(f"SELECT '{label}' AS kpi, {cells} FROM ratios")
    return "\nUNION ALL ".join(rows)


@query("stock_region_transposed", f"WITH {R.LEDGER_SQL}, {summary_sql('region')} {_transposed()}")
def stock_region_transposed(spark, folder):
    return P.region_transposed(P.region_summary(days(spark, folder), R.STOCK_FIRST, R.STOCK_LAST), R.REGIONS)


DAILY_SQL = f"""WITH {R.LEDGER_SQL},
closing AS (SELECT region, store_name, activity_date, CAST(sum(gross - gross * rate) AS DOUBLE) AS closing_cost
            FROM item_days WHERE region IS NOT NULL GROUP BY ALL),
sold AS (SELECT region, store_name, activity_date, CAST(sum(sales_cost) AS DOUBLE) AS sales_cost
         FROM sales GROUP BY ALL),
daily AS (SELECT region, store_name, activity_date, closing_cost, coalesce(sales_cost, 0.0) AS sales_cost
          FROM closing LEFT JOIN sold USING (region, store_name, activity_date))"""


@query(
    "stock_daily",
    f"""{DAILY_SQL}
SELECT region, store_name, CAST(activity_date AS VARCHAR) AS activity_date, closing_cost, sales_cost,
       CASE WHEN closing_cost > 0 THEN sales_cost / closing_cost * 100.0 ELSE 0.0 END AS soh_cost_pct FROM daily""",
)
def stock_daily(spark, folder):
    return P.daily_ratio(days(spark, folder)).withColumn("activity_date", F.col("activity_date").cast("string"))


@query(
    "stock_daily_matrix",
    DAILY_SQL
    + " SELECT region, store_name, "
    + ", ".join(
        f"coalesce(max(CASE WHEN activity_date = DATE '{d}' THEN CASE WHEN closing_cost > 0 THEN"
        f" round_even(sales_cost / closing_cost * 100.0 * 100.0, 0) / 100.0 ELSE 0.0 END END), 0.0) AS \"{d}\""
        for d in DATES
    )
    + " FROM daily GROUP BY region, store_name",
)
def stock_daily_matrix(spark, folder):
    return P.daily_matrix(days(spark, folder), DATES)


@query(
    "movement_union",
    """WITH skus AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS sku FROM lineitem WHERE l_returnflag IN ('R', 'A'))
SELECT 'transfer' AS kind, CAST(l_suppkey AS VARCHAR) AS "branchCode", CAST(l_partkey AS VARCHAR) AS "skuCode",
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity, NULL AS items, 'landed' AS source
FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'receipt', CAST(l_suppkey AS VARCHAR), NULL, NULL,
       '[{"skuCode":"' || l_partkey || '","quantity":"' || CAST(l_quantity AS BIGINT) || '"}]', 'landed'
FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT 'stock', NULL, CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR), NULL, 'landed'
FROM part WHERE CAST(p_partkey AS VARCHAR) IN (SELECT sku FROM skus)""",
)
def movement_union(spark, folder):
    lines = R.table(spark, folder, "lineitem")
    code, qty = F.col("l_partkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string")
    branch = F.col("l_suppkey").cast("string").alias("branchCode")
    no_items = F.lit(None).cast("array<struct<skuCode:string,quantity:string>>").alias("items")
    transfers = lines.filter("l_returnflag = 'R'").select(branch, code.alias("skuCode"), qty.alias("quantity"), no_items)
    receipts = lines.filter("l_returnflag = 'A'").select(
        branch,
        F.lit(None).cast("string").alias("skuCode"),
        F.lit(None).cast("string").alias("quantity"),
        F.array(F.struct(code.alias("skuCode"), qty.alias("quantity"))).alias("items"),
    )
    stock = R.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("skuCode"), F.col("p_size").cast("string").alias("quantity")
    )
    out = P.movement_union(transfers, receipts, stock, "landed", F.lit(None).cast("timestamp")).drop("fetched_at")
    return out.withColumn("items", F.to_json("items"))


@query(
    "missing_landings",
    f"""WITH {R.LEDGER_SQL},
expected AS (SELECT branch_code, CAST(day AS DATE) AS day FROM stores,
             generate_series(DATE '1998-06-01', DATE '1998-06-30', INTERVAL 1 DAY) g(day))
SELECT branch_code, CAST(day AS VARCHAR) AS business_day FROM expected
WHERE (branch_code, day) NOT IN (SELECT CAST(l_suppkey AS VARCHAR), CAST(l_shipdate AS DATE) FROM lineitem)""",
)
def missing(spark, folder):
    landed = R.ledger_month(spark, folder).select("branch_code", F.col("activity_date").alias("business_day"))
    out = missing_landings(R.stores(spark, folder), landed, R.STOCK_FIRST, R.STOCK_LAST)
    return out.withColumn("business_day", F.col("business_day").cast("string"))
