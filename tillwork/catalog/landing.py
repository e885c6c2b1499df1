"""Round trips: the driver's tables written as landed files, sheets and logs, read back by the readers."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from ..plans import landing
from ..session import scratch_dir
from ..sources import dimensions, landed, sinks
from . import roles as R
from .registry import query


def place(spark, name: str) -> str:
    return f"{scratch_dir(spark)}/landing/{name}-{uuid.uuid4().hex}"


def land(records, day, path: str, lists: bool = True) -> None:
    """Records of a frame as JSON lines in day folders, in every form that a response takes.

    A third lies in responses under one of the known names, a third in bare lists; with ``lists=False`` all are bare records.
    """
    record = F.struct(*[F.col(c) for c in records.columns])
    kind = F.pmod(F.xxhash64(record), F.lit(4))
    some = F.array(record)
    text = F.to_json(record)
    if lists:
        text = (
            F.when(kind == 0, F.to_json(F.struct(some.alias("data"))))
            .when(kind == 1, F.to_json(F.struct(F.array().cast("array<int>").alias("data"), some.alias("transactions"))))
            .when(kind == 2, F.to_json(F.struct(some.alias("timings"))))
            .otherwise(F.to_json(some))
        )
    records.select(text.alias("value"), day.alias(landed.DAY)).write.partitionBy(landed.DAY).text(path)


def named_code(code, number):
    """The branch code under one of the names that records use for it."""
    names = ("branchCode", "branch", "storeCode", "Store Code")
    return [F.when(F.pmod(number, F.lit(4)) == i, code).alias(n) for i, n in enumerate(names)]


def year_of(day):
    return F.make_date(F.year(day), F.lit(1), F.lit(1))


@query(
    "landed_sales_orders",
    """SELECT CAST(o_custkey AS VARCHAR) AS branch_code, CAST(o_orderkey AS VARCHAR) AS invoice,
       CAST(date_trunc('year', o_orderdate) AS DATE)::VARCHAR AS invoice_day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_time,
       o_orderpriority AS channel, upper(o_orderstatus) AS status, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS material_cost,
       CAST(count(l_orderkey) AS BIGINT) AS n_items
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def landed_sales_orders(spark, folder):
    o, l = R.table(spark, folder, "orders"), R.table(spark, folder, "lineitem")
    item = F.struct(F.col("l_partkey").cast("string").alias("shortName"), F.col("l_quantity").alias("quantity"))
    items = l.groupBy("l_orderkey").agg(F.collect_list(item).alias("items"))
    even = F.col("o_orderkey") % 2 == 0
    records = o.join(items, o.o_orderkey == items.l_orderkey, "left").select(
        *named_code(F.concat(F.lit(" "), F.col("o_custkey").cast("string")), F.col("o_orderkey")),
        F.col("o_orderkey").cast("string").alias("invoiceNumber"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("invoiceDate"),
        # the label goes before the plain name
        F.when(even, F.col("o_orderpriority")).alias("channel"),
        F.lower("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("totalMaterialCost"),
        "items",
        "o_orderdate",
        F.when(~even, F.col("o_orderpriority")).alias("label"),
    )
    path = place(spark, "orders")
    # a frame cannot hold two names that differ in case only: this one is renamed in the text
    record = F.struct(*[F.col(f"`{c}`") for c in records.columns if c != "o_orderdate"])
    text = F.regexp_replace(F.to_json(F.struct(F.array(record).alias("data"))), '"label":', '"Channel":')
    records.select(text.alias("value"), year_of("o_orderdate").alias(landed.DAY)).write.partitionBy(landed.DAY).text(path)
    out = landed.sales_orders(spark, path, enveloped=True)
    return out.select(
        "branch_code",
        "invoice",
        F.col("invoice_day").cast("string").alias("invoice_day"),
        F.date_format("order_time", "yyyy-MM-dd HH:mm:ss").alias("order_time"),
        "channel",
        "status",
        F.col("material_cost").cast("double").alias("material_cost"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
    ).withColumn("n_items", F.greatest("n_items", F.lit(0)))


@query(
    "landed_soldout_events",
    """SELECT CAST(user_id AS VARCHAR) AS branch_code, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time,
       CAST(event_id AS VARCHAR) AS item_name, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_day FROM events""",
)
def landed_soldout_events(spark, folder):
    e = R.table(spark, folder, "events")
    records = e.select(
        *named_code(F.col("user_id").cast("string"), F.col("event_id")),
        F.col("event_type").alias("eventType"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("eventDate"),
        F.col("event_id").cast("string").alias("itemName"),
    )
    path = place(spark, "events")
    land(records, F.to_date(F.col("eventDate")), path)
    out = landed.soldout_events(spark, path, enveloped=True)
    return out.select(
        "branch_code",
        "event_type",
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        "item_name",
        F.col("event_day").cast("string").alias("event_day"),
    )


@query(
    "landed_item_activity",
    """SELECT CAST(l_suppkey AS VARCHAR) AS branch_code, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS activity_date,
       CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS sku_code, CAST(l_quantity AS BIGINT) AS closing_qty,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS n_activities FROM lineitem""",
)
def landed_item_activity(spark, folder):
    l = R.table(spark, folder, "lineitem")
    entry = F.array(F.struct(F.lit("SALES").alias("type"), F.col("l_quantity").alias("quantity")))
    records = l.select(
        *named_code(F.col("l_suppkey").cast("string"), F.col("l_partkey")),
        F.to_date("l_shipdate").cast("string").alias("activityDate"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("skuCode"),
        F.col("l_quantity").cast("bigint").cast("string").alias("closingBalance"),
        F.when(F.col("l_returnflag") == "R", entry).otherwise(F.array().cast("array<struct<type:string,quantity:double>>")).alias("activities"),
    )
    path = place(spark, "activity")
    land(records, F.make_date(F.substring("activityDate", 1, 4).cast("int"), F.lit(1), F.lit(1)), path, lists=False)
    out = landed.item_activity(spark, path)
    return out.select(
        "branch_code",
        F.col("activity_date").cast("string").alias("activity_date"),
        "sku_code",
        F.col("closing_qty").cast("bigint").alias("closing_qty"),
        F.size("activities").alias("n_activities"),
    )


@query(
    "landed_movements",
    """SELECT CAST(l_suppkey AS VARCHAR) AS "branchCode", CASE WHEN l_linenumber = 1 THEN CAST(l_partkey AS VARCHAR) END AS "skuCode",
       CASE WHEN l_linenumber <> 1 THEN CAST(l_partkey AS VARCHAR) END AS item_sku FROM lineitem WHERE l_returnflag = 'A'""",
)
def landed_movements(spark, folder):
    l = R.table(spark, folder, "lineitem").filter("l_returnflag = 'A'")
    code, own = F.col("l_partkey").cast("string"), F.col("l_linenumber") == 1
    records = l.select(
        F.col("l_suppkey").cast("string").alias("branchCode"),
        F.when(own, code).alias("skuCode"),
        F.when(~own, F.array(F.struct(code.alias("skuCode")))).alias("items"),
        F.to_date("l_shipdate").alias("shipped"),
    )
    path = place(spark, "movements")
    land(records, year_of("shipped"), path)
    out = landed.stock_movements(spark, path, enveloped=True)
    return out.select("branchCode", "skuCode", F.get("items", F.lit(0))["skuCode"].alias("item_sku"))


@query(
    "landed_rejects",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events WHERE event_id % 5 = 0",
)
def landed_rejects(spark, folder):
    """Responses with their records under a name nobody knows."""
    e = R.table(spark, folder, "events")
    some = F.array(F.struct(F.col("user_id").cast("string").alias("branchCode"), "event_type", "event_id"))
    odd = F.to_json(F.struct(some.alias("payload")))
    text = F.when(F.col("event_id") % 5 == 0, odd).otherwise(F.to_json(F.struct(some.alias("data"))))
    path = place(spark, "odd")
    e.select(text.alias("value"), F.to_date("ts").alias(landed.DAY)).write.partitionBy(landed.DAY).text(path)
    cell = lambda name: F.get_json_object("value", f"$.payload[0].{name}").alias(name)
    return landed.rejected(spark, path).select(cell("event_id"), cell("event_type"))


def sheet(df, path: str) -> str:
    """A frame as a folder of CSV files, each with the headers."""
    df.write.option("header", True).csv(path)
    return path


def store_rows(spark, folder):
    """The store sheet with every code listed twice, the second time with another name or other contacts."""
    s = R.store_sheet(spark, folder)
    again = s.withColumns(
        {
            "store_name": F.when(F.col("branch_code").cast("int") % 2 == 0, F.concat("store_name", F.lit(" (old)"))).otherwise(F.col("store_name")),
            "am_email": F.concat(F.lit("zz."), F.col("am_email")),
        }
    )
    labels = {"branch_code": "Branch Code", "store_name": "Store Name", "region": "Region", "ownership": "Ownership",
              "am_email": "AM Email", "rm_email": "RM Email", "am_name": "AM Name", "cc_mail": "CC Mail"}
    return s.union(again).withColumnsRenamed(labels)


@query(
    "sheet_stores",
    f"""WITH {R.STORES_SQL}
SELECT branch_code, store_name, upper(region) AS region, am_email FROM (
  SELECT branch_code, store_name, (SELECT r_name FROM region JOIN nation ON r_regionkey = n_regionkey WHERE n_name = am_name) AS region, am_email
  FROM stores)""",
)
def sheet_stores(spark, folder):
    """Of two rows of a code the smaller name, then the smaller contacts."""
    out = dimensions.store_dim(spark, sheet(store_rows(spark, folder), place(spark, "stores")))
    return out.select("branch_code", "store_name", "region", "am_email")


@query("sheet_store_conflicts", f"WITH {R.STORES_SQL} SELECT branch_code, CAST(2 AS BIGINT) AS variants FROM stores")
def sheet_store_conflicts(spark, folder):
    return dimensions.store_conflicts(spark, sheet(store_rows(spark, folder), place(spark, "stores")))


@query(
    "sheet_items",
    f"WITH x AS (SELECT 1), {R.ITEMS_SQL} SELECT item_key, item_group, variant, product_mix, category_group FROM items",
)
def sheet_items(spark, folder):
    labels = {"item_key": "Item Name", "item_group": "Item Group Name", "variant": "Variant(s)",
              "product_mix": "Product Mix", "category_group": "Category Group"}
    path = sheet(R.item_sheet(spark, folder).withColumnsRenamed(labels), place(spark, "items"))
    return dimensions.item_dim(spark, path)


@query(
    "alert_log",
    """SELECT CAST(event_id AS VARCHAR) AS alert_key, CAST(CAST(ts AS DATE) AS VARCHAR) AS business_date
FROM events WHERE event_id % 3 = 1 AND CAST(ts AS DATE) BETWEEN
  (SELECT CAST(min(ts) AS DATE) + 2 FROM events) AND (SELECT CAST(min(ts) AS DATE) + 6 FROM events)""",
)
def alert_log(spark, folder):
    """Two runs append to the log, one of them twice; the days of five are read, without the other run's keys."""
    e = R.table(spark, folder, "events")
    keys = e.select(F.col("event_id").cast("string").alias("alert_key"), F.to_date("ts").alias("business_date"), "event_id")
    path = place(spark, "log")
    sinks.append_alerts(keys.filter("event_id % 3 = 0"), path, "noon")
    sinks.append_alerts(keys, path, "evening")
    sinks.append_alerts(keys.filter("event_id % 3 = 1"), path, "evening")
    first = e.agg(F.min(F.to_date("ts"))).first()[0]
    days = (date.fromordinal(first.toordinal() + 2), date.fromordinal(first.toordinal() + 6))
    sent = landed.sent_alerts(spark, path, except_run="noon", between=days)
    return sent.filter("sent_time is not null").select("alert_key").join(keys, "alert_key").select(
        "alert_key", F.col("business_date").cast("string").alias("business_date")
    )


@query(
    "refreshed_days",
    "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, '1998-06-02' AS as_of FROM part WHERE p_size > 20",
)
def refreshed_days(spark, folder):
    """Two days are published; the first is refreshed with nothing, the second with other rows."""
    p, path = R.table(spark, folder, "part").select("p_partkey", "p_size"), place(spark, "published")
    one, two = date(1998, 6, 1), date(1998, 6, 2)
    sinks.refresh(p, path, one)
    sinks.refresh(p, path, two)
    sinks.refresh(p.filter("p_size < 0"), path, one)
    sinks.refresh(p.filter("p_size > 20"), path, two)
    return spark.read.schema("p_partkey bigint, as_of string").parquet(path)


@query(
    "ledger_files",
    """SELECT strftime(l_shipdate, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem GROUP BY 1""",
)
def ledger_files(spark, folder):
    """The ledger as CSV by month, written twice."""
    l, path = R.table(spark, folder, "lineitem"), place(spark, "ledger")
    rows = l.select(F.to_date("l_shipdate").alias("activity_date"), F.col("l_quantity").cast("bigint").alias("quantity"), F.array("l_tax").alias("taxes"))
    for _ in range(2):
        sinks.ledger_csv(rows, path)
    back = spark.read.schema("activity_date string, quantity bigint, taxes string, month string").option("header", True).csv(path)
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.sum("quantity").alias("quantity"))


@query(
    "raw_snapshot",
    f"""WITH {R.STORES_SQL}
SELECT CAST(user_id AS VARCHAR) AS "branchCode", CAST(event_id AS VARCHAR) AS event_id, CAST(NULL AS VARCHAR) AS landing_status
FROM events WHERE CAST(user_id AS VARCHAR) IN (SELECT branch_code FROM stores)
  AND CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM events)""",
)
def raw_snapshot(spark, folder):
    """A landing table without a declared schema, for the stores of the sheet, published and read back."""
    e = R.table(spark, folder, "events")
    records = e.select(
        *named_code(F.concat(F.col("user_id").cast("string"), F.lit(" ")), F.col("event_id")), "event_id", F.struct("event_type", "props").alias("detail"),
        F.to_date("ts").alias("landed_on"),
    )
    root, out = place(spark, "raw"), place(spark, "published")
    land(records, F.col("landed_on"), f"{root}/store_items")
    day = e.agg(F.min(F.to_date("ts"))).first()[0]
    landing.publish(spark, root, out, day, R.stores(spark, folder), ["inventory_store_items"])
    back = spark.read.schema("branchCode string, record string, landing_status string, as_of date").parquet(f"{out}/inventory_store_items")
    return back.select("branchCode", F.get_json_object("record", "$.event_id").alias("event_id"), "landing_status")


@query(
    "written_sections",
    """SELECT 'part' AS section, CAST(count(*) AS BIGINT) AS rows FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier""",
)
def written_sections(spark, folder):
    path = place(spark, "sections")
    frames = {"part": R.table(spark, folder, "part").select("p_name"), "supplier": R.table(spark, folder, "supplier").select("s_name")}
    sinks.write_sections(sinks.stacked(frames), path)
    back = spark.read.schema("p_name string, s_name string, section string").parquet(path)
    return back.groupBy("section").agg(F.count(F.lit(1)).alias("rows"))
