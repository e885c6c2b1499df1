"""The driver's tables in the roles of the reports' inputs, and the same roles as SQL.

store = supplier with its nation and region (company-owned: balance >= 0);
order = orders; sales line = lineitem; item = part name; channel = order priority;
sold-out event = an ``error`` event; listing page = pages.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import Period
from ..sources.dimensions import clean_items, company_stores

REGION_MAP = {"AFRICA": "AF", "AMERICA": "AM", "ASIA": "AS", "EUROPE": "EU"}
REGIONS = ["AF", "AM", "AS", "EU", "MIDDLE EAST"]
CHANNELS = {
    "1-URGENT": "Swiggy Express",
    "2-HIGH": "Zomato Online",
    "3-MEDIUM": "POS Counter",
    "4-NOT SPECIFIED": "Brand Website",
    "5-LOW": "Phone",
}
SLA_CHANNELS = ["Swiggy Express", "Zomato Online", "POS Counter"]
STATUSES = {"F": "CLOSED", "O": "OPEN", "P": "VOIDED"}

PERIODS = [
    Period("CURRENT", datetime(1998, 4, 1), datetime(1998, 6, 30, 23, 59, 59)),
    Period("LW", datetime(1998, 1, 1), datetime(1998, 3, 31, 23, 59, 59)),
    Period("L2W", datetime(1997, 10, 1), datetime(1997, 12, 31, 23, 59, 59)),
]
FTD = (date(1998, 6, 1), date(1998, 6, 30))
MTD = (date(1998, 1, 1), date(1998, 6, 30))
STOCK_FIRST, STOCK_LAST = date(1998, 6, 1), date(1998, 6, 30)


# Declared, so reading a table opens no file while the plan is built.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def decode(column: str, mapping: dict[str, str]):
    chain = None
    for value, label in mapping.items():
        hit = F.col(column) == value
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain


def store_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """All stores as a sheet would list them, before cleaning."""
    s, n, r = (table(spark, folder, t) for t in ("supplier", "nation", "region"))
    joined = s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    return joined.select(
        F.col("s_suppkey").cast("string").alias("branch_code"),
        F.col("s_name").alias("store_name"),
        F.concat(F.lit(" "), F.initcap("r_name")).alias("region"),
        F.when(F.col("s_acctbal") >= 0, " coco ").otherwise("Fofo").alias("ownership"),
        F.concat(F.lower(F.regexp_replace("s_name", "#", ".")), F.lit("@example.com")).alias("am_email"),
        F.concat(F.lit("rm."), F.lower("n_name"), F.lit("@example.com, area@example.com ,")).alias("rm_email"),
        F.col("n_name").alias("am_name"),
        F.concat(F.lit("ops@example.com, "), F.lower("n_name"), F.lit("@example.com, ,ops@example.com")).alias("cc_mail"),
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    return company_stores(store_sheet(spark, folder), REGION_MAP)


STORES_SQL = """
sheet AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS branch_code, s_name AS store_name,
         CASE r_name WHEN 'AFRICA' THEN 'AF' WHEN 'AMERICA' THEN 'AM' WHEN 'ASIA' THEN 'AS'
                     WHEN 'EUROPE' THEN 'EU' ELSE r_name END AS region,
         s_acctbal,
         lower(replace(s_name, '#', '.')) || '@example.com' AS am_email,
         'rm.' || lower(n_name) || '@example.com' AS rm_first,
         n_name AS am_name
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
stores AS (SELECT * FROM sheet WHERE s_acctbal >= 0)
"""


def item_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part: names repeat, so the sheet is not unique by name."""
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        F.col("p_name").alias("item_key"),
        F.element_at(F.split("p_name", " "), -1).alias("item_group"),
        F.concat_ws("-", "p_brand", F.col("p_partkey").cast("string")).alias("variant"),
        F.when(size <= 20, "CORE")
        .when(size <= 35, "COMBO")
        .when(size <= 42, F.lit(None))
        .otherwise("Addons")
        .alias("product_mix"),
        F.col("p_type").alias("category_group"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return clean_items(item_sheet(spark, folder))


ITEMS_SQL = """
item_sheet AS (
  SELECT upper(trim(p_name)) AS item_key, string_split(p_name, ' ')[-1] AS item_group,
         p_brand || '-' || p_partkey AS variant,
         CASE WHEN p_size <= 20 THEN 'CORE' WHEN p_size <= 35 THEN 'COMBO'
              WHEN p_size <= 42 THEN NULL ELSE 'Addons' END AS product_mix,
         p_type AS category_group
  FROM part),
items AS (
  SELECT * FROM item_sheet
  QUALIFY row_number() OVER (PARTITION BY item_key
                             ORDER BY item_group, variant, product_mix NULLS LAST, category_group) = 1)
"""


def sales_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as the product reports read them; discounts are landed negative."""
    o, l, p = (table(spark, folder, t) for t in ("orders", "lineitem", "part"))
    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    rate = F.col("l_discount").cast("decimal(4,2)")
    named = lambda text: F.struct(text.alias("name"))
    voucher = named(F.concat(F.lit("Merchant Voucher Code ("), "l_returnflag", "l_linestatus", F.lit(")")))
    offer = named(F.concat(F.lit("Restaurant Discount ("), (rate * 100).cast("int").cast("string"), F.lit("% off)")))
    empty = F.array().cast("array<struct<name:string>>")
    joined = l.join(o, l.l_orderkey == o.o_orderkey).join(p, l.l_partkey == p.p_partkey)
    return joined.select(
        F.col("l_suppkey").cast("string").alias("branch_code"),
        F.col("p_brand").alias("brand"),
        F.col("l_orderkey").alias("invoice"),
        decode("o_orderpriority", CHANNELS).alias("channel"),
        decode("o_orderstatus", STATUSES).alias("status"),
        F.col("o_orderdate").alias("order_time"),
        F.concat(F.lit(" "), "p_name").alias("item_name"),
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        gross.alias("gross"),
        (-(gross * rate)).alias("discount"),
        (gross - gross * rate).alias("net"),
        F.when(rate == 0, empty)
        .when(rate == F.lit("0.01").cast("decimal(4,2)"), F.array(named(F.lit("Flat off"))))
        .when(rate >= F.lit("0.08").cast("decimal(4,2)"), F.array(voucher, named(F.lit("Loyalty"))))
        .otherwise(F.array(voucher))
        .alias("discounts"),
        F.when(F.col("l_returnflag") != "N", F.array(offer)).alias("item_discounts"),
    )


LINES_SQL = (
    STORES_SQL
    + ","
    + ITEMS_SQL
    + """,
tagged AS (
  SELECT l.*, o_orderkey AS invoice, p_brand AS brand, upper(trim(p_name)) AS item_key, o_orderdate,
         CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' ELSE 'VOIDED' END AS status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Swiggy' WHEN '2-HIGH' THEN 'Zomato'
              WHEN '3-MEDIUM' THEN 'In Store' WHEN '4-NOT SPECIFIED' THEN 'Ownly' ELSE 'Others' END AS channel_group,
         CASE WHEN o_orderdate >= TIMESTAMP '1998-04-01' AND o_orderdate < TIMESTAMP '1998-07-01' THEN 'CURRENT'
              WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-04-01' THEN 'LW'
              WHEN o_orderdate >= TIMESTAMP '1997-10-01' AND o_orderdate < TIMESTAMP '1998-01-01' THEN 'L2W' END AS period,
         CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS gross,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS discount,
         CASE WHEN CAST(l_discount AS DECIMAL(4,2)) = 0.00 THEN 'No Offer'
              WHEN CAST(l_discount AS DECIMAL(4,2)) = 0.01 THEN 'Flat off'
              ELSE l_returnflag || l_linestatus END AS voucher_code,
         CASE WHEN l_returnflag = 'N' THEN 'No Offer'
              ELSE CAST(CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS INTEGER) AS VARCHAR) || '% off' END AS bracket_code
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
base AS (
  SELECT t.*, gross - discount AS net, s.store_name, s.region, i.item_group, i.product_mix, i.category_group
  FROM tagged t JOIN stores s ON CAST(t.l_suppkey AS VARCHAR) = s.branch_code LEFT JOIN items i USING (item_key)
  WHERE period IS NOT NULL AND upper(i.product_mix) IS DISTINCT FROM 'ADDONS'),
mart AS (SELECT * FROM base WHERE status = 'CLOSED')
"""
)


def sla_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as the SLA reports read them.

    The clocks are scaled from order-to-ship days so their P80 straddles the limits;
    lines with one tax rate were never marked ready, with another never delivered.
    """
    o, l, p = (table(spark, folder, t) for t in ("orders", "lineitem", "part"))
    days = F.datediff("l_shipdate", "o_orderdate").cast("bigint")
    tax = F.col("l_tax")
    after = lambda micros: F.timestamp_add("MICROSECOND", days * micros, F.col("o_orderdate"))
    joined = l.join(o, l.l_orderkey == o.o_orderkey).join(p, l.l_partkey == p.p_partkey)
    return joined.select(
        F.col("l_suppkey").cast("string").alias("branch_code"),
        F.col("l_orderkey").alias("invoice"),
        decode("o_orderpriority", CHANNELS).alias("channel"),
        F.col("o_orderdate").alias("order_time"),
        F.to_date("o_orderdate").alias("invoice_day"),
        F.when(tax != 0.08, after(800_000)).alias("ready_time"),
        F.when(tax != 0.05, after(2_400_000)).alias("delivered_time"),
        F.col("p_type").alias("category_name"),
        F.col("p_name").alias("item_name"),
    )


SLA_SQL = (
    STORES_SQL
    + """,
spans AS (
  SELECT o_orderkey AS invoice, p_type AS category_name, p_name AS item_name, l_suppkey, o_orderdate,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Swiggy' WHEN '2-HIGH' THEN 'Zomato' END AS aggregator,
         date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days, CAST(l_tax AS DECIMAL(4,2)) AS tax,
         o_orderdate >= TIMESTAMP '1998-06-01' AS is_ftd
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'
    AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')),
sla AS (
  SELECT sp.*, st.store_name, st.region,
         -- whole tenths of a minute, so every aggregate below is exact
         round_even(greatest(days * 800000 / 1e6 / 60.0, 0.0) * 10.0, 0) AS kpt,
         CASE WHEN tax <> 0.05 THEN round_even(greatest(days * 2400000 / 1e6 / 60.0, 0.0) * 10.0, 0) END AS o2d
  FROM spans sp JOIN stores st ON CAST(sp.l_suppkey AS VARCHAR) = st.branch_code
  WHERE tax <> 0.08)
"""
)


def soldout_events(spark: SparkSession, folder: str) -> DataFrame:
    return as_soldout(table(spark, folder, "events"))


def as_soldout(events: DataFrame) -> DataFrame:
    """Events (batch or stream) as sold-out events."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.col("user_id").cast("string").alias("branch_code"),
        F.when(F.col("event_type") == "error", "out").otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("value") < 40, "Direct").otherwise("Scheduled").alias("status_type"),
        F.to_date("ts").alias("event_day"),
        F.col("ts").alias("event_time"),
        F.when(k % 2 == 0, "material").otherwise("product").alias("item_type"),
        F.concat(F.lit("CAT_"), (k % 7).cast("string")).alias("category_name"),
        F.concat(F.lit("ITEM_"), k.cast("string")).alias("item_name"),
        F.concat(F.lit("user_"), (F.col("event_id") % 5).cast("string")).alias("user_name"),
    )


SOLDOUT_SQL = (
    STORES_SQL
    + """,
soldout AS (
  SELECT CAST(ts AS DATE) AS business_date, CAST(user_id AS VARCHAR) AS branch_code, store_name, region,
         CASE WHEN k % 2 = 0 THEN 'material' ELSE 'product' END AS item_type,
         'CAT_' || (k % 7) AS category_name, 'ITEM_' || k AS item_name, ts AS event_time,
         'user_' || (event_id % 5) AS user_name, am_email, rm_first, am_name
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
  JOIN stores ON CAST(e.user_id AS VARCHAR) = branch_code
  WHERE event_type = 'error' AND value < 40)
"""
)


def _ledger_of(lines: DataFrame) -> DataFrame:
    """Item-day ledger rows, one per line, with 0 to 3 activities or no list at all."""
    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    qty = F.col("l_quantity").cast("decimal(12,2)")
    rate, tax = F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)")
    entry = lambda kind, q, c: F.struct(
        F.lit(kind).alias("type"), q.cast("decimal(18,4)").alias("quantity"), c.cast("decimal(18,4)").alias("cost")
    )
    activities = F.array_compact(
        F.array(
            F.when(rate > 0, entry(" Sales", -qty, gross * rate)),
            F.when(F.col("l_returnflag") == "R", entry("SHRINKAGE", F.lit(1), -(gross * tax))),
            F.when(F.col("l_linestatus") == "O", entry("TRANSFER", F.lit(2), gross)),
        )
    )
    return lines.select(
        F.col("l_suppkey").cast("string").alias("branch_code"),
        F.to_date("l_shipdate").alias("activity_date"),
        F.col("l_partkey").cast("string").alias("sku_code"),
        (qty * 2).alias("opening_qty"),
        gross.alias("opening_cost"),
        qty.alias("closing_qty"),
        (gross - gross * rate).alias("closing_cost"),
        F.when(tax != F.lit("0.08").cast("decimal(4,2)"), activities).alias("activities"),
    )


def ledger_month(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of the reported month; the range is a filter on the ship time, so it reaches the scan."""
    window = Period("", datetime(1998, 6, 1), datetime(1998, 6, 30, 23, 59, 59))
    df = table(spark, folder, "lineitem").filter(window.contains("l_shipdate"))
    return _ledger_of(df)


LEDGER_SQL = (
    STORES_SQL
    + """,
item_days AS (
  SELECT s.branch_code, s.store_name, s.region, CAST(l_shipdate AS DATE) AS activity_date,
         CAST(l_partkey AS VARCHAR) AS sku_code,
         CAST(l_quantity AS DECIMAL(12,2)) AS qty, CAST(l_extendedprice AS DECIMAL(12,2)) AS gross,
         CAST(l_discount AS DECIMAL(4,2)) AS rate, CAST(l_tax AS DECIMAL(4,2)) AS tax, l_returnflag, l_linestatus
  FROM lineitem JOIN stores s ON CAST(l_suppkey AS VARCHAR) = s.branch_code
  WHERE l_shipdate >= TIMESTAMP '1998-06-01' AND l_shipdate < TIMESTAMP '1998-07-01'
    AND CAST(l_tax AS DECIMAL(4,2)) <> 0.08),
sales AS (SELECT *, gross * rate AS sales_cost FROM item_days WHERE rate > 0)
"""
)
