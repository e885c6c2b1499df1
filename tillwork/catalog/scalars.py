"""Text, time and number functions on the driver's tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as X
from ..functions import time as D
from . import roles as R
from .registry import query


@query(
    "offer_codes",
    """WITH t AS (SELECT l_returnflag, l_linestatus, CAST(l_discount AS DECIMAL(4,2)) AS rate FROM lineitem)
SELECT CASE WHEN rate >= 0.08 THEN l_returnflag || l_linestatus WHEN rate >= 0.05 THEN 'Happy Hour' ELSE 'No Offer' END AS voucher,
       CASE WHEN rate >= 0.02 AND rate < 0.05 THEN l_returnflag || ' off' ELSE 'No Offer' END AS restaurant,
       count(*) AS rows FROM t GROUP BY ALL""",
)
def offer_codes(spark, folder):
    rate = F.col("l_discount").cast("decimal(4,2)")
    at_least = lambda x: rate >= F.lit(x).cast("decimal(4,2)")
    text = (
        F.when(at_least("0.08"), F.concat(F.lit("[{'name': 'Merchant Voucher Code ("), "l_returnflag", "l_linestatus", F.lit(")'}]")))
        .when(at_least("0.05"), F.lit("[{'name': 'Happy Hour', 'rate': 5}]"))
        .when(at_least("0.02"), F.concat(F.lit("Restaurant Discount  ("), "l_returnflag", F.lit(" off)")))
    )
    codes = R.table(spark, folder, "lineitem").select(
        X.voucher_offer(text).alias("voucher"), X.restaurant_offer(text).alias("restaurant")
    )
    return codes.groupBy("voucher", "restaurant").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "listed_offer_codes",
    """WITH t AS (SELECT l_returnflag, CAST(l_discount AS DECIMAL(4,2)) AS rate FROM lineitem)
SELECT CASE WHEN rate >= 0.08 THEN l_returnflag || '10' WHEN rate >= 0.05 THEN 'Flat' ELSE 'No Offer' END AS bracket,
       CASE WHEN rate >= 0.08 THEN 'Deal (' || l_returnflag || '10)' WHEN rate >= 0.05 THEN 'Flat' ELSE 'No Offer' END AS voucher,
       count(*) AS rows FROM t GROUP BY ALL""",
)
def listed_offer_codes(spark, folder):
    """No list, an empty list, one element without a bracket, two elements."""
    rate = F.col("l_discount").cast("decimal(4,2)")
    at_least = lambda x: rate >= F.lit(x).cast("decimal(4,2)")
    named = lambda c: F.struct(c.alias("name"))
    deal = F.concat(F.lit("Deal ("), "l_returnflag", F.lit("10)"))
    listed = (
        F.when(at_least("0.08"), F.array(named(deal), named(F.lit("Other (X)"))))
        .when(at_least("0.05"), F.array(named(F.lit("Flat"))))
        .when(at_least("0.02"), F.array().cast("array<struct<name:string>>"))
    )
    codes = R.table(spark, folder, "lineitem").select(
        X.bracket_code(listed).alias("bracket"), X.voucher_code(listed).alias("voucher")
    )
    return codes.groupBy("bracket", "voucher").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "composite_keys",
    """SELECT DISTINCT coalesce(CASE WHEN user_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END, '') || '|' || event_type || '|' ||
       CAST(CAST(ts AS DATE) AS VARCHAR) AS alert_key FROM events""",
)
def composite_keys(spark, folder):
    known = F.when(F.col("user_id") % 10 != 0, F.col("user_id"))
    return R.table(spark, folder, "events").select(X.composite_key(known, "event_type", F.to_date("ts")).alias("alert_key")).distinct()


@query(
    "split_lists",
    """SELECT c_custkey, unnest(list_sort(list_distinct([c_mktsegment, 'N' || c_nationkey, 'HOUSEHOLD']))) AS entry FROM customer""",
)
def split_lists(spark, folder):
    text = F.concat("c_mktsegment", F.lit(" , ,N"), F.col("c_nationkey").cast("string"), F.lit(",, HOUSEHOLD"))
    return R.table(spark, folder, "customer").select("c_custkey", F.explode(X.split_list(text)).alias("entry"))


@query(
    "display_text",
    """SELECT p_partkey, regexp_replace(CAST(CAST(round_even(p_retailprice / 7 * 100.0, 0) / 100.0 AS DECIMAL(38,2)) AS VARCHAR), '0$', '') || '%' AS percent,
       CASE WHEN p_size % 5 = 0 THEN '-' ELSE CAST(p_size % 5 AS VARCHAR) END AS dashed,
       'Region: ' || p_type AS scope FROM part""",
)
def display_text(spark, folder):
    return R.table(spark, folder, "part").select(
        "p_partkey",
        X.percent_text(F.col("p_retailprice") / 7).alias("percent"),
        X.dash_if_zero(F.col("p_size") % 5).alias("dashed"),
        X.scope_label("p_type").alias("scope"),
    )


@query(
    "number_functions",
    """SELECT p_partkey, round_even(p_retailprice / 8, 0) AS r0, round_even(p_retailprice / 8 * 10.0, 0) / 10.0 AS r1,
       round_even(p_retailprice / 8 * 100.0, 0) / 100.0 AS r2, round_even((p_size - 25) / 2.0, 0) + 0.0 AS half,
       CASE WHEN p_size < 25 THEN 0.0 ELSE CAST(p_size - 25 AS DOUBLE) END AS clipped,
       CASE WHEN p_size - 25 >= 0 THEN 'positive' ELSE 'negative' END AS sign,
       CASE WHEN p_size < 12 THEN 'green' WHEN p_size <= 15 THEN 'yellow' ELSE 'red' END AS kpt,
       CASE WHEN p_size < 30 THEN 'green' WHEN p_size <= 35 THEN 'yellow' ELSE 'red' END AS o2d,
       CASE WHEN p_size - 20 > 0 THEN CAST(p_size AS DOUBLE) / (p_size - 20) ELSE 0.0 END AS ratio,
       coalesce(TRY_CAST(CASE WHEN p_size < 10 THEN 'x' || p_size ELSE CAST(p_size AS VARCHAR) END AS DOUBLE), 0.0) AS parsed
FROM part""",
)
def number_functions(spark, folder):
    size = F.col("p_size")
    text = F.when(size < 10, F.concat(F.lit("x"), size.cast("string"))).otherwise(size.cast("string"))
    eighth = F.col("p_retailprice") / 8
    return R.table(spark, folder, "part").select(
        "p_partkey",
        N.round_he(eighth, 0).alias("r0"),
        N.round_he(eighth, 1).alias("r1"),
        N.round_he(eighth, 2).alias("r2"),
        N.round_he((size - 25) / 2.0, 0).alias("half"),
        N.clip_zero((size - 25).cast("double")).alias("clipped"),
        N.sign_band(size - 25).alias("sign"),
        N.kpt_band(size).alias("kpt"),
        N.o2d_band(size).alias("o2d"),
        N.safe_div(size, size - 20).alias("ratio"),
        N.to_number(text).alias("parsed"),
    )


@query(
    "abs_of_sum",
    """SELECT s_nationkey, CAST(abs(sum(CAST(s_acctbal AS DECIMAL(12,2)))) AS DOUBLE) AS abs_sum,
       CAST(sum(abs(CAST(s_acctbal AS DECIMAL(12,2)))) AS DOUBLE) AS sum_abs FROM supplier GROUP BY s_nationkey""",
)
def abs_of_sum(spark, folder):
    balance = F.col("s_acctbal").cast("decimal(12,2)")
    return R.table(spark, folder, "supplier").groupBy("s_nationkey").agg(
        N.abs_sum(balance).cast("double").alias("abs_sum"), N.sum0(F.abs(balance)).cast("double").alias("sum_abs")
    )


@query(
    "business_day",
    """SELECT CAST(CAST(ts + INTERVAL 330 MINUTE - INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS business_day,
       CAST(CAST(ts - INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS utc_business_day, count(*) AS rows FROM events GROUP BY ALL""",
)
def business_day(spark, folder):
    days = R.table(spark, folder, "events").select(
        D.business_day(D.utc_to_zone("ts")).cast("string").alias("business_day"),
        D.business_day("ts").cast("string").alias("utc_business_day"),
    )
    return days.groupBy("business_day", "utc_business_day").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "month_sequence",
    """WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT CAST(day AS VARCHAR) AS day, CAST(CAST(d AS DATE) AS VARCHAR) AS month_day
FROM days, LATERAL (SELECT unnest(generate_series(date_trunc('month', day), day, INTERVAL 1 DAY)) AS d)""",
)
def month_sequence(spark, folder):
    days = R.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    spread = days.select("day", F.explode(D.month_sequence("day")).alias("month_day"))
    return spread.select(F.col("day").cast("string").alias("day"), F.col("month_day").cast("string").alias("month_day"))


@query(
    "reported_day",
    """SELECT '1998-06-29' AS day, count(*) AS orders, TRUE AS stamped FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-06-29'""",
)
def reported_day(spark, folder):
    """Orders of the day before the run, and whether the run was stamped."""
    day = D.report_day(date(1998, 6, 30))
    orders = R.table(spark, folder, "orders").filter(F.to_date("o_orderdate") == F.lit(day))
    stamped = D.run_stamp().isNotNull()
    return orders.agg(F.lit(day.isoformat()).alias("day"), F.count(F.lit(1)).alias("orders"), stamped.alias("stamped"))


@query(
    "lenient_times",
    """SELECT o_orderpriority, count(*) FILTER (o_orderpriority <> '5-LOW') AS parsed,
       CAST(min(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END) AS VARCHAR) AS first_time,
       sum(CASE WHEN o_orderpriority <> '5-LOW' THEN date_diff('minute', TIMESTAMP '1995-01-01', o_orderdate) END) AS minutes
FROM orders GROUP BY o_orderpriority""",
)
def lenient_times(spark, folder):
    text = F.when(F.col("o_orderpriority") == "5-LOW", "yesterday-ish").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    o = R.table(spark, folder, "orders").select("o_orderpriority", D.parse_ts(text).alias("t"))
    start = F.expr("TIMESTAMP_NTZ '1995-01-01'")
    return o.groupBy("o_orderpriority").agg(
        F.count("t").alias("parsed"),
        F.date_format(F.min("t"), "yyyy-MM-dd HH:mm:ss").alias("first_time"),
        F.sum(D.minutes_between(start, "t").cast("bigint")).alias("minutes"),
    )


@query(
    "utc_parse",
    """SELECT event_id, strftime(CASE WHEN event_type = 'click' THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
       ELSE date_trunc('second', ts) END + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS local_time FROM events""",
)
def utc_parse(spark, folder):
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    offset = F.when(F.col("event_type") == "click", "+05:30").when(F.col("event_type") == "view", "Z").otherwise("")
    local = D.utc_to_zone(D.parse_utc(F.concat(plain, offset)))
    return R.table(spark, folder, "events").select(
        "event_id", F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_time")
    )


@query(
    "date_labels",
    """SELECT event_id, strftime(ts, '%Y-%m') AS month, strftime(ts, '%d-%m-%Y') AS day,
       '09:00 AM - ' || strftime(ts, '%I:%M %p') AS span FROM events""",
)
def date_labels(spark, folder):
    opening = F.expr("TIMESTAMP_NTZ '2024-01-01 09:00:00'")
    return R.table(spark, folder, "events").select(
        "event_id",
        D.month_label("ts").alias("month"),
        D.day_label("ts").alias("day"),
        D.window_label(opening, "ts").alias("span"),
    )


@query(
    "period_windows",
    """SELECT o_orderkey, period FROM (
  SELECT o_orderkey, unnest([CASE WHEN o_orderdate BETWEEN TIMESTAMP '1998-06-01' AND TIMESTAMP '1998-06-14 12:00:00' THEN 'CURRENT' END,
                             CASE WHEN o_orderdate BETWEEN TIMESTAMP '1998-05-25' AND TIMESTAMP '1998-06-07 12:00:00' THEN 'LW' END,
                             CASE WHEN o_orderdate BETWEEN TIMESTAMP '1998-05-18' AND TIMESTAMP '1998-05-31 12:00:00' THEN 'L2W' END]) AS period
  FROM orders) WHERE period IS NOT NULL""",
)
def period_windows(spark, folder):
    """Two-week windows shifted by one and two weeks overlap: a row belongs to each window it is in."""
    from datetime import datetime

    current = D.Period("CURRENT", datetime(1998, 6, 1), datetime(1998, 6, 14, 12))
    windows = [current, current.shifted("LW", 7), current.shifted("L2W", 14)]
    return D.tag_period(R.table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", windows).drop(
        "o_orderdate"
    )
