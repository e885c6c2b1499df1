"""Nested ingest, conforming, dimension and set operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import channel_group, key_of, null_if_missing, recode
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import shape as S
from ..operators.filters import company_owned, ledger_store, not_addon, usable_code
from ..sources.landed import one_per_key
from ..sources.sinks import raw_landing, stacked
from . import roles as R
from .registry import query


def nested_orders(spark, folder):
    """Orders with their lines as an array; an order without lines has no array."""
    o, l = R.table(spark, folder, "orders"), R.table(spark, folder, "lineitem")
    line = l.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    header = o.select("o_orderkey", F.struct("o_orderstatus", "o_orderpriority").alias("head"))
    return header.join(S.nest(line, ["o_orderkey"], "items"), "o_orderkey", "left")


LINE_SQL = """SELECT o_orderkey, o_orderstatus AS head_o_orderstatus, o_orderpriority AS head_o_orderpriority,
       l_partkey AS item_partkey, l_suppkey AS item_suppkey, CAST(l_quantity AS BIGINT) AS item_quantity"""

query("explode_outer_lines", f"{LINE_SQL} FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")(
    lambda s, d: S.flatten_structs(S.explode_objects(nested_orders(s, d), "items", "item_", outer=True))
)
query("explode_inner_lines", f"{LINE_SQL} FROM orders JOIN lineitem ON o_orderkey = l_orderkey")(
    lambda s, d: S.flatten_structs(S.explode_objects(nested_orders(s, d), "items", "item_", outer=False))
)


@query(
    "json_text",
    """SELECT c_custkey, '{"name":"' || c_name || '","segment":' ||
       CASE WHEN c_acctbal < 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}' AS profile,
       '[' || c_nationkey || ',' || c_custkey || ']' AS keys FROM customer""",
)
def json_text(spark, folder):
    c = R.table(spark, folder, "customer")
    return S.json_text(
        c.select(
            "c_custkey",
            F.struct(
                F.col("c_name").alias("name"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment")
            ).alias("profile"),
            F.array(F.col("c_nationkey").cast("bigint"), "c_custkey").alias("keys"),
        )
    )


@query(
    "envelope_unwrap",
    "SELECT event_id, user_id, event_type FROM events",
)
def envelope_unwrap(spark, folder):
    """Each response carries its records under one of three names; the others are empty or missing."""
    e = R.table(spark, folder, "events")
    record = F.array(F.struct("event_id", "user_id", "event_type"))
    none = F.lit(None).cast("array<struct<event_id:bigint,user_id:bigint,event_type:string>>")
    blank = F.array().cast("array<struct<event_id:bigint,user_id:bigint,event_type:string>>")
    kind = F.col("event_type")
    return S.unwrap_envelope(
        e.select(
            F.when(kind.isin("click", "view"), record).otherwise(blank).alias("data"),
            F.when(kind == "purchase", record).otherwise(none).alias("transactions"),
            F.when(kind.isin("error", "signup"), record).alias("timings"),
        )
    )


@query(
    "page_union_dedupe",
    """SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST) = 1""",
)
def page_union_dedupe(spark, folder):
    """Two overlapping pages united, one record per key kept, the newest."""
    e = R.table(spark, folder, "events").select("user_id", "event_type", "event_id", "ts")
    both = S.union_all(e.filter(F.col("value") < 60), e.filter(F.col("value") >= 30))
    kept = one_per_key(both, ["user_id", "event_type"], "ts")
    return kept.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "union_by_name",
    """SELECT 'supplier' AS dataset, CAST(s_suppkey AS VARCHAR) AS code, s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), c_name, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), p_name, NULL, NULL FROM part""",
)
def union_by_name(spark, folder):
    s, c, p = (R.table(spark, folder, t) for t in ("supplier", "customer", "part"))
    return S.union_all(
        S.tag(s.select(F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")), dataset="supplier"),
        S.tag(
            c.select(
                F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("name"),
                F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
            ),
            dataset="customer",
        ),
        S.tag(p.select(F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("name")), dataset="part"),
    )


@query(
    "conform_schema",
    """SELECT CAST(c_custkey AS VARCHAR) AS branch_code, c_mktsegment AS region, 0.0 AS quantity,
       TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) AS number, TRY_CAST(c_mktsegment AS DOUBLE) AS amount,
       '{"c_acctbal_sign":"' || CASE WHEN c_acctbal < 0 THEN 'neg' ELSE 'pos' END || '"}' AS _extra FROM customer""",
)
def conform_schema(spark, folder):
    landed = R.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("branch_code"),
        F.col("c_mktsegment").alias("region"),
        F.element_at(F.split("c_name", "#"), 2).alias("number"),
        F.col("c_mktsegment").alias("amount"),
        F.when(F.col("c_acctbal") < 0, "neg").otherwise("pos").alias("c_acctbal_sign"),
    )
    schema = T.StructType(
        [
            T.StructField("branch_code", T.StringType()),
            T.StructField("region", T.StringType()),
            T.StructField("quantity", T.DoubleType()),
            T.StructField("number", T.LongType()),
            T.StructField("amount", T.DoubleType()),
        ]
    )
    return S.conform(landed, schema, {"quantity": 0.0}, keep_extra=True)


@query(
    "ragged_rows",
    """SELECT p_partkey, string_split(p_name, ' ')[1] AS itemname,
       CASE WHEN p_size % 4 >= 2 THEN p_brand ELSE '' END AS blank_col_1,
       CASE WHEN p_size % 4 >= 3 THEN p_type ELSE '' END AS itemname_2 FROM part""",
)
def ragged_rows(spark, folder):
    """Rows of 1 to 4 cells under three headers, one blank and one repeated."""
    p = R.table(spark, folder, "part")
    width = F.greatest(F.col("p_size") % 4, F.lit(1)) + F.when(F.col("p_size") % 4 == 3, 1).otherwise(0)
    cells = F.array(F.element_at(F.split("p_name", " "), 1), "p_brand", "p_type", F.lit("surplus"))
    rows = p.select("p_partkey", F.slice(cells, F.lit(1), width).alias("cells"))
    return S.pad_ragged(rows, "cells", S.safe_headers([" Item Name", "", "ITEMNAME"]))


@query(
    "merge_twins",
    """SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE r_name END AS label, r_name AS region
FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def merge_twins(spark, folder):
    n, r = R.table(spark, folder, "nation"), R.table(spark, folder, "region")
    left = n.select("n_nationkey", "n_regionkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("label_x"))
    right = r.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("label_y"), F.col("r_name").alias("region"))
    return S.merge_twins(left.join(right, "n_regionkey")).drop("n_regionkey")


@query(
    "fallback_columns",
    """SELECT event_id, coalesce(CASE WHEN value < 30 THEN event_type END, props) AS channel FROM events""",
)
def fallback_columns(spark, folder):
    e = R.table(spark, folder, "events").select(
        "event_id", F.when(F.col("value") < 30, F.col("event_type")).alias("Source"), F.col("props").alias("channel")
    )
    return e.select("event_id", S.first_present(e, ["Help Channel", "Source", "Channel", "channel"]).alias("channel"))


@query(
    "latest_lookup",
    "SELECT user_id, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id",
)
def latest_lookup(spark, folder):
    return S.latest_lookup(R.table(spark, folder, "events"), "user_id", "event_type", "ts")


@query(
    "first_known",
    """SELECT user_id, arg_min(event_type, ts) AS event_type,
       arg_min(event_id, ts) FILTER (value >= 80) AS big_event FROM events GROUP BY user_id""",
)
def first_known(spark, folder):
    e = R.table(spark, folder, "events").withColumn("big_event", F.when(F.col("value") >= 80, F.col("event_id")))
    return M.first_known(e, ["user_id"], ["event_type", "big_event"], "ts")


@query(
    "dim_dedupe_join",
    f"""WITH {R.ITEMS_SQL}
SELECT item_group, product_mix, count(*) AS rows, count(DISTINCT l_orderkey) AS orders
FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN items ON upper(trim(p_name)) = item_key
WHERE upper(product_mix) IS DISTINCT FROM 'ADDONS' GROUP BY ALL""",
)
def dim_dedupe_join(spark, folder):
    """Lines against a sheet whose names repeat: no line is multiplied."""
    l, p = R.table(spark, folder, "lineitem"), R.table(spark, folder, "part")
    lines = l.join(p, l.l_partkey == p.p_partkey).select("l_orderkey", key_of("p_name").alias("item_key"))
    joined = J.with_dimension(lines, R.items(spark, folder), "item_key").filter(not_addon("product_mix"))
    per_order = joined.groupBy("item_group", "product_mix", "l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return per_order.groupBy("item_group", "product_mix").agg(F.sum("n").alias("rows"), F.count("l_orderkey").alias("orders"))


@query(
    "dim_conflicts",
    f"""WITH {R.ITEMS_SQL}
SELECT item_key, count(*) AS variants FROM (SELECT DISTINCT item_key, product_mix, category_group FROM item_sheet)
GROUP BY item_key HAVING count(*) > 1""",
)
def dim_conflicts(spark, folder):
    sheet = R.item_sheet(spark, folder).withColumn("item_key", key_of("item_key"))
    return J.dimension_conflicts(sheet, ["item_key"], ["product_mix", "category_group"])


@query(
    "ownership_filters",
    """SELECT CAST(s_suppkey AS VARCHAR) AS branch_code, CAST(s_acctbal >= 0 AS INTEGER) AS company,
       CAST(s_acctbal >= 0 OR s_nationkey IN (3, 4) OR s_suppkey IN (1, 2) AS INTEGER) AS ledger,
       CAST(s_nationkey NOT IN (0, 1) AS INTEGER) AS usable FROM supplier""",
)
def ownership_filters(spark, folder):
    s = R.table(spark, folder, "supplier")
    owner = F.when(F.col("s_acctbal") >= 0, " coco ").when(F.col("s_nationkey") == 3, "Warehouse").when(
        F.col("s_nationkey") == 4, "city wh"
    )
    code = F.col("s_suppkey").cast("string")
    landed = F.when(F.col("s_nationkey") == 0, " ").when(F.col("s_nationkey") == 1, "#N/A").otherwise(code)
    return s.select(
        code.alias("branch_code"),
        F.coalesce(company_owned(owner), F.lit(False)).cast("int").alias("company"),
        ledger_store(owner, code, ["1", "2"]).cast("int").alias("ledger"),
        usable_code(landed).cast("int").alias("usable"),
    )


@query(
    "semi_listed",
    """SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)""",
)
def semi_listed(spark, folder):
    big = R.table(spark, folder, "lineitem").filter("l_quantity >= 50").select(F.col("l_partkey").alias("p_partkey"))
    return J.only_listed(R.table(spark, folder, "part").select("p_partkey", "p_name"), big, "p_partkey")


@query("semi_all_when_empty", "SELECT p_partkey, p_name FROM part")
def semi_all_when_empty(spark, folder):
    none = R.table(spark, folder, "lineitem").filter("l_quantity < 0").select(F.col("l_partkey").alias("p_partkey"))
    return J.only_listed(R.table(spark, folder, "part").select("p_partkey", "p_name"), none, "p_partkey", all_when_empty=True)


@query(
    "anti_by_key",
    """SELECT c_custkey FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000)""",
)
def anti_by_key(spark, folder):
    large = R.table(spark, folder, "orders").filter("o_orderstatus = 'F' AND o_totalprice > 200000")
    seen = large.select(F.col("o_custkey").alias("c_custkey"))
    return J.only_new(R.table(spark, folder, "customer").select("c_custkey"), seen, "c_custkey")


@query(
    "channel_frequency",
    """SELECT channel_group, status, count(*) AS rows FROM (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Swiggy' WHEN '2-HIGH' THEN 'Zomato' WHEN '3-MEDIUM' THEN 'In Store'
              WHEN '4-NOT SPECIFIED' THEN 'Ownly' ELSE 'Others' END AS channel_group,
         CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' END AS status FROM orders) GROUP BY ALL""",
)
def channel_frequency(spark, folder):
    o = R.table(spark, folder, "orders").select(
        channel_group(R.decode("o_orderpriority", R.CHANNELS)).alias("channel_group"),
        R.decode("o_orderstatus", {"F": "CLOSED", "O": "OPEN"}).alias("status"),
    )
    return M.frequency(o, "channel_group", "status")


@query(
    "region_list",
    f"WITH {R.STORES_SQL} SELECT DISTINCT region FROM stores",
)
def region_list(spark, folder):
    return R.stores(spark, folder).select("region").distinct().orderBy("region")


@query(
    "text_keys",
    """SELECT n_nationkey, upper(trim('  ' || n_name || ' ')) AS key,
       CASE r_name WHEN 'AFRICA' THEN 'AF' WHEN 'AMERICA' THEN 'AM' WHEN 'ASIA' THEN 'AS' WHEN 'EUROPE' THEN 'EU' ELSE r_name END AS code,
       CASE WHEN n_nationkey % 4 = 3 THEN n_name END AS known
FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def text_keys(spark, folder):
    n, r = R.table(spark, folder, "nation"), R.table(spark, folder, "region")
    which = F.col("n_nationkey") % 4
    landed = F.when(which == 0, "").when(which == 1, " #N/A ").when(which == 2, "nan").otherwise(F.col("n_name"))
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey",
        key_of(F.concat(F.lit("  "), "n_name", F.lit(" "))).alias("key"),
        recode(F.initcap("r_name"), R.REGION_MAP).alias("code"),
        null_if_missing(landed).alias("known"),
    )


@query(
    "raw_landing",
    """SELECT s_suppkey, s_name, '{"nation":' || s_nationkey || '}' AS place, NULL AS landing_status FROM supplier""",
)
def raw_supplier(spark, folder):
    s = R.table(spark, folder, "supplier").select(
        "s_suppkey", "s_name", F.struct(F.col("s_nationkey").alias("nation")).alias("place")
    )
    return raw_landing(s, "suppliers")


@query(
    "raw_landing_empty",
    """WITH landed AS (SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey < 0)
SELECT s_suppkey, s_name, NULL AS landing_status FROM landed
UNION ALL SELECT NULL, NULL, 'No data returned for suppliers on the target date.' WHERE NOT EXISTS (SELECT 1 FROM landed)""",
)
def raw_empty(spark, folder):
    return raw_landing(R.table(spark, folder, "supplier").filter("s_suppkey < 0").select("s_suppkey", "s_name"), "suppliers")


@query(
    "stacked_sections",
    """SELECT 'Status' AS section, o_orderstatus AS element, count(*) AS orders, NULL AS spent FROM orders GROUP BY ALL
UNION ALL SELECT 'Priority', o_orderpriority, count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE)
FROM orders GROUP BY ALL""",
)
def stacked_sections(spark, folder):
    o = R.table(spark, folder, "orders")
    spent = F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("spent")
    count = F.count(F.lit(1)).alias("orders")
    return stacked(
        {
            "Status": o.groupBy(F.col("o_orderstatus").alias("element")).agg(count),
            "Priority": o.groupBy(F.col("o_orderpriority").alias("element")).agg(count, spent),
        }
    )


@query(
    "order_span",
    """SELECT o_orderstatus, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_order,
       CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_order FROM orders GROUP BY o_orderstatus""",
)
def order_span(spark, folder):
    return R.table(spark, folder, "orders").groupBy("o_orderstatus").agg(
        F.to_date(F.min("o_orderdate")).cast("string").alias("first_order"),
        F.to_date(F.max("o_orderdate")).cast("string").alias("last_order"),
    )


@query(
    "top_items_by_revenue",
    """SELECT p_brand, l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, l_partkey
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY sum(CAST(l_extendedprice AS DECIMAL(12,2))) DESC, l_partkey) <= 15""",
)
def top_items_by_revenue(spark, folder):
    l, p = R.table(spark, folder, "lineitem"), R.table(spark, folder, "part")
    spent = l.groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("double").alias("revenue"))
    branded = spent.join(p, spent.l_partkey == p.p_partkey).select("p_brand", "l_partkey", "revenue")
    return M.top_k(branded, ["p_brand"], [F.desc("revenue"), F.asc("l_partkey")], 15)
