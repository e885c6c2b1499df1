"""What is kept between runs: the compacted alert log, versioned tables, histograms by day, mergeable distinct counts, windows and scopes."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..functions.text import embedded_json, embedded_value
from ..functions.time import business_periods, period_days, tag_period
from ..operators.distinct import day_bitmaps, distinct_count, numbered
from ..operators.joins import in_windows, sized
from ..operators.observed import observed
from ..operators.metrics import metric_histogram, scoped_totals, sla_columns, sla_finish
from ..plans import sla as P
from ..plans import sla_days as D
from ..plans.soldout import with_alert_key
from ..sources import dimensions, keylog, landed, sinks, versions
from ..streaming import alerts as A
from ..streaming import landing as L
from . import roles as R
from .landing import land, named_code, place
from .registry import query
from .sla import lines as sla_lines
from .sla import matrix_sql, mean, p
from .soldout import base, coarse

# three batches by the hour of the event: what a batch sends, later ones do not
BATCHES_SQL = f"""WITH {R.SOLDOUT_SQL},
keyed AS (SELECT store_name || '|' || CAST(substr(item_name, 6) AS INTEGER) % 2 || '|' || CAST(business_date AS VARCHAR) AS alert_key,
                 hour(event_time) // 8 AS batch, event_time, business_date, CAST(event_time AS DATE) AS day
          FROM soldout WHERE store_name IS NOT NULL)"""


@query(
    "alert_log_compacted",
    f"""{BATCHES_SQL}
SELECT alert_key, CAST(business_date AS VARCHAR) AS business_date, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, CAST(batch AS BIGINT) AS batch_id
FROM keyed QUALIFY row_number() OVER (PARTITION BY alert_key ORDER BY batch, event_time) = 1""",
)
def alert_log_compacted(spark, folder):
    """Three batches with a compaction between them, a merged batch replayed, and the merged folders dropped."""
    log = place(spark, "batches")
    keyed = with_alert_key(coarse(base(spark, folder)).filter("store_name is not null"))
    batch = lambda k: keyed.filter(F.floor(F.hour("event_time") / 8) == k)
    A.write_batch(batch(0), 0, log)
    A.write_batch(batch(1), 1, log)
    A.compact_log(spark, log)
    A.write_batch(batch(1), 1, log)
    A.write_batch(batch(2), 2, log)
    A.compact_log(spark, log)
    A.drop_merged(spark, log)
    A.write_batch(batch(0), 0, log)
    sent = A.sent_log(spark, log)
    return sent.select(
        "alert_key", F.col("business_date").cast("string").alias("business_date"), F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"), "batch_id"
    )


@query(
    "alert_runs_compacted",
    """SELECT CAST(event_id AS VARCHAR) AS alert_key, CASE event_id % 3 WHEN 0 THEN 'morning' WHEN 1 THEN 'noon' ELSE 'evening' END AS run,
       CASE WHEN event_type <> 'view' THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS business_date FROM events""",
)
def alert_runs_compacted(spark, folder):
    """Runs of the alert log, some keys without a day; merged, then one run repeated."""
    e, path = R.table(spark, folder, "events"), place(spark, "runs")
    keys = e.select(
        F.col("event_id").cast("string").alias("alert_key"), F.when(F.col("event_type") != "view", F.to_date("ts")).alias("business_date"), "event_id"
    )
    for k, run in enumerate(("morning", "noon", "evening")):
        sinks.append_alerts(keys.filter(F.col("event_id") % 3 == k), path, run)
    sinks.compact_alerts(spark, path)
    sinks.append_alerts(keys.filter("event_id % 3 = 1"), path, "noon")
    days = keylog.days_of(keys, "business_date")
    return keylog.read(spark, path, landed.ALERT_LOG, "run", days).select("alert_key", "run", F.col("business_date").cast("string").alias("business_date"))


@query(
    "published_table",
    "SELECT CAST(p_size AS INTEGER) AS p_size, CAST(count(*) AS BIGINT) AS parts FROM part WHERE p_size > 10 GROUP BY 1",
)
def published_table(spark, folder):
    """A table published twice, a third refresh that fails before its pointer, and versions out of use dropped."""
    path, schema = place(spark, "versions"), "p_size int, parts bigint"
    parts = R.table(spark, folder, "part").groupBy("p_size").agg(F.count(F.lit(1)).alias("parts"))
    versions.publish(parts, path)
    versions.publish(parts.filter("p_size > 10"), path)
    versions.write_version(parts.filter("p_size > 40"), path)
    versions.drop_unused(spark, path)
    return versions.published(spark, path, schema)


# --- histograms by day -----------------------------------------------------

DROPS_SQL = f"{R.SLA_SQL}, landed AS (SELECT * FROM sla WHERE is_ftd OR invoice % 2 = 0)"


REGIONS_SQL = matrix_sql("region", "HAVING bool_or(is_ftd)").removeprefix(f"WITH {R.SLA_SQL}")


@query("sla_by_days", f"WITH {DROPS_SQL} {REGIONS_SQL.replace('FROM sla ', 'FROM landed ')}")
def sla_by_days(spark, folder):
    """Half of the orders land first; the last month's days are computed again when the rest of theirs has landed."""
    path = place(spark, "histograms")
    all_lines = sla_lines(spark, folder)
    spans = [date.fromordinal(i) for i in range(R.MTD[0].toordinal(), R.MTD[1].toordinal() + 1)]
    late = [d for d in spans if R.FTD[0] <= d <= R.FTD[1]]
    D.refresh_days(all_lines.filter("invoice % 2 = 0"), path, spans)
    D.refresh_days(all_lines.filter(keylog.of_days(D.DAY, late)), path, late)
    return P.region_matrix(D.between_days(spark, path, spans, F.col(D.DAY).between(F.lit(R.FTD[0]), F.lit(R.FTD[1]))))


# --- distinct counts that merge --------------------------------------------


def level_sql(level: str, keys: str) -> str:
    cells = ", ".join(k if k in keys.split(", ") else f"NULL AS {k}" for k in ("region", "brand"))
    group = f"GROUP BY {keys}" if keys else ""
    return f"SELECT '{level}' AS level, {cells}, CAST(count(DISTINCT invoice) AS BIGINT) AS orders FROM sold {group}"


@query(
    "distinct_orders",
    f"""WITH {R.STORES_SQL}, sold AS (SELECT o_orderkey AS invoice, region, p_brand AS brand FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey LEFT JOIN stores ON CAST(l_suppkey AS VARCHAR) = branch_code
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-07-01')
{level_sql('brand', 'region, brand')} UNION ALL {level_sql('region', 'region')} UNION ALL {level_sql('all', '')}""",
)
def distinct_orders(spark, folder):
    """Distinct orders of half a year per region and brand, per region, and of all, from one table of bitmaps by day."""
    path = place(spark, "bitmaps")
    sold = R.sales_lines(spark, folder).withColumn("day", F.to_date("order_time")).filter(F.col("day").between(F.lit(R.MTD[0]), F.lit(R.MTD[1])))
    regions = R.stores(spark, folder).select("branch_code", "region")
    sold = sold.select("branch_code", "brand", "invoice", "day").join(sized(regions, "regions"), "branch_code", "left")
    sold = sold.join(numbered(sold, "invoice", "day"), ["day", "invoice"])
    day_bitmaps(sold, ["region", "brand"], "day", "number").write.partitionBy("day").parquet(path)
    bits = spark.read.schema("region string, brand string, bucket bigint, bits binary, day date").parquet(path)
    levels = {"brand": ["region", "brand"], "region": ["region"], "all": []}
    return sinks.stacked({k: distinct_count(bits, keys, "day", "orders") for k, keys in levels.items()}, "level").select("level", "region", "brand", "orders")


# --- scopes and windows ----------------------------------------------------


def scope_sql(scope: str, keys: str) -> str:
    cells = ", ".join(k if k in keys.split(", ") else f"NULL AS {k}" for k in ("region", "category_name"))
    group = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT '{scope}' AS scope, {cells}, CAST(count(kpt) AS BIGINT) AS orders, {mean('kpt', 1)} AS kpt, {p('kpt', 0.8, 1)} AS kpt_p80,
  CAST(count(*) FILTER (kpt > 120) AS BIGINT) AS breaches FROM known {group}"""


@query(
    "sla_scopes",
    f"""WITH {R.SLA_SQL}, known AS (SELECT * REPLACE (nullif(region, 'AS') AS region, nullif(category_name, 'PROMO') AS category_name) FROM sla)
{scope_sql('region+category_name', 'region, category_name')} UNION ALL {scope_sql('region', 'region')}
UNION ALL {scope_sql('category_name', 'category_name')} UNION ALL {scope_sql('all', '')}""",
)
def sla_scopes(spark, folder):
    """Preparation times of regions by categories, of each, and of all, where one region and one category are missing in the data."""
    unknown = sla_lines(spark, folder).withColumns(
        {"region": F.nullif("region", F.lit("AS")), "category_name": F.nullif("category_name", F.lit("PROMO"))}
    )
    keys = ["region", "category_name"]
    hist = metric_histogram(unknown, keys, ["kpt"])
    sets = [keys, ["region"], ["category_name"], []]
    raw = scoped_totals(hist, keys, sets, *sla_columns("kpt", "kpt", limit=P.LIMITS["kpt"]))
    done = sla_finish("kpt", 1)
    return raw.select("scope", *keys, F.col("kpt_n").alias("orders"), done["mean"].alias("kpt"), done["p80"].alias("kpt_p80"), F.col("kpt_breach").alias("breaches"))


# campaigns overlap; one has no end and one ends before it starts
CAMPAIGNS = [
    ("spring", datetime(1998, 3, 1, 9), datetime(1998, 5, 15, 23, 30)),
    ("april", datetime(1998, 4, 1), datetime(1998, 4, 30, 23, 59, 59)),
    ("one day", datetime(1998, 4, 15), datetime(1998, 4, 15)),
    ("quarter", datetime(1998, 4, 1), datetime(1998, 6, 30, 23, 59, 59)),
    ("open", datetime(1998, 4, 1), None),
    ("reversed", datetime(1998, 5, 1), datetime(1998, 4, 1)),
]


@query(
    "campaign_sales",
    f"""WITH w(period, a, b) AS (VALUES {", ".join(f"('{n}', TIMESTAMP '{a}', {f"TIMESTAMP '{b}'" if b else 'NULL'})" for n, a, b in CAMPAIGNS)})
SELECT period, o_orderstatus AS status, CAST(count(*) AS BIGINT) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN w ON o_orderdate BETWEEN a AND b GROUP BY ALL""",
)
def campaign_sales(spark, folder):
    """Orders in campaigns that overlap, so that one order counts in several."""
    windows = spark.createDataFrame(CAMPAIGNS, "period string, start timestamp_ntz, end timestamp_ntz")
    orders = R.table(spark, folder, "orders").select("o_orderdate", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    hit = in_windows(orders, "o_orderdate", windows)
    return hit.groupBy("period", F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("orders"), F.sum("price").cast("double").alias("total"))


RUN = datetime(1998, 6, 16, 3, 30)  # before the cutoff: the business day is still the fifteenth


@query(
    "running_hour",
    """WITH w(period, shift) AS (VALUES ('CURRENT', 0), ('LW', 7), ('L2W', 14))
SELECT period, CAST(CAST(o_orderdate - INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS business_day, CAST(count(*) AS BIGINT) AS orders
FROM orders JOIN w ON o_orderdate BETWEEN TIMESTAMP '1998-06-15 09:00:00' - to_days(shift) AND TIMESTAMP '1998-06-16 03:30:00' - to_days(shift) GROUP BY ALL""",
)
def running_hour(spark, folder):
    """The windows of a running hour: from the business day's cutoff to now, and the same a week and two weeks before."""
    periods = business_periods(RUN)
    orders = R.table(spark, folder, "orders").withColumn("business_day", F.to_date(F.col("o_orderdate") - F.expr("INTERVAL 9 HOUR")))
    kept = tag_period(orders.filter(keylog.of_days("business_day", period_days(periods))), "o_orderdate", periods)
    return kept.groupBy("period", F.col("business_day").cast("string").alias("business_day")).agg(F.count(F.lit(1)).alias("orders"))



# --- what lands -------------------------------------------------------------

EVENTS = "branch_code string, event_type string, item_name string, event_time timestamp_ntz, business_date date, batch_id bigint"


@query(
    "landed_once",
    """SELECT CAST(user_id AS VARCHAR) AS branch_code, event_type, CAST(event_id AS VARCHAR) AS item_name,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, CAST(CAST(ts AS DATE) AS VARCHAR) AS business_date FROM events""",
)
def landed_once(spark, folder):
    """Two drops of pages, the second with a third of the first's records again; then the days are compacted and nothing has arrived."""
    root, table, checkpoint = place(spark, "drops"), place(spark, "landed"), place(spark, "checkpoint")
    e = R.table(spark, folder, "events")
    pages = e.select(
        *named_code(F.col("user_id").cast("string"), F.col("event_id")),
        F.col("event_type").alias("eventType"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("eventDate"),
        F.col("event_id").cast("string").alias("itemName"),
    )
    number = F.col("itemName").cast("bigint")
    for drop in (number % 2 == 0, (number % 2 == 1) | (number % 3 == 0), F.lit(False)):
        land(pages.filter(drop), F.to_date("eventDate"), f"{root}/next")
        versions.move_files(spark, f"{root}/next", f"{root}/in")
        arrived = landed.soldout_events(spark, f"{root}/in", enveloped=True, stream=True)
        records = arrived.select("branch_code", "event_type", "item_name", "event_time", F.col("event_day").alias("business_date"))
        L.land_available(records, table, checkpoint, EVENTS, ["item_name"], "event_time")
    keylog.compact(spark, table, EVENTS, "batch_id")
    out = L.landed_table(spark, table, EVENTS)
    return out.select(
        "branch_code", "event_type", "item_name", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        F.col("business_date").cast("string").alias("business_date"),
    )


def variants(spark, folder):
    """Events as snapshot records: on odd days the value is text, and later ones carry a field more."""
    e = R.table(spark, folder, "events")
    odd = F.dayofmonth("ts") % 2 == 1
    common = [F.col("user_id").cast("string").alias("branchCode"), F.col("event_id")]
    plain = F.to_json(F.struct(*common, F.col("value")))
    text = F.to_json(F.struct(*common, F.col("value").cast("string").alias("value"), F.col("event_type").alias("kind")))
    path = place(spark, "variants")
    e.select(F.when(odd, text).otherwise(plain).alias("value"), F.to_date("ts").alias(landed.DAY)).write.partitionBy(landed.DAY).text(path)
    return landed.snapshot_variants(spark, path)


@query(
    "variant_snapshot",
    """SELECT CAST(user_id AS VARCHAR) AS "branchCode", event_id, CAST(value AS DOUBLE) AS value,
       CASE WHEN day(ts) % 2 = 1 THEN event_type END AS kind FROM events""",
)
def variant_snapshot(spark, folder):
    """Two fields read by path and typed, whatever type they were landed with."""
    rows = variants(spark, folder)
    return rows.select(
        "branchCode",
        F.variant_get("record", "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get("record", "$.value", "double").alias("value"),
        F.variant_get("record", "$.kind", "string").alias("kind"),
    )


@query(
    "variant_drift",
    """WITH d AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS business_day FROM events WHERE day(ts) % 2 = 1)
SELECT business_day, 'value' AS field, 'STRING' AS type, 'DOUBLE' AS declared FROM d UNION ALL SELECT business_day, 'kind', 'STRING', NULL FROM d""",
)
def variant_drift(spark, folder):
    """Per day, the fields whose type is not the declared one, and fields nobody declared; numbers of any width are one type."""
    types = landed.field_types(variants(spark, folder), [landed.DAY])
    numeric = F.when(F.col("type").rlike("^(DECIMAL|DOUBLE)") & (F.col("field") == "value"), "DOUBLE").otherwise(F.col("type"))
    declared = {"branchCode": "STRING", "event_id": "BIGINT", "value": "DOUBLE"}
    drift = landed.drifted(types.withColumn("type", numeric), [landed.DAY], declared)
    return drift.select(F.col(landed.DAY).cast("string").alias("business_day"), "field", "type", "declared")


@query(
    "observed_run",
    f"""WITH {R.STORES_SQL}, {R.ITEMS_SQL}, l AS (SELECT *, upper(trim(p_name)) AS item_key FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
j AS (SELECT s.branch_code, i.product_mix FROM l LEFT JOIN stores s ON CAST(l_suppkey AS VARCHAR) = s.branch_code LEFT JOIN items i USING (item_key))
SELECT 'rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM j UNION ALL SELECT 'without_store', count(*) FILTER (branch_code IS NULL) FROM j
UNION ALL SELECT 'without_mix', count(*) FILTER (product_mix IS NULL) FROM j
UNION ALL SELECT 'reported', count(*) FILTER (branch_code IS NOT NULL AND product_mix IS NOT NULL) FROM j""",
)
def observed_run(spark, folder):
    """Rows read, without store, without product mix, and reported: counted while the report is written, by the same scan."""
    lines = R.sales_lines(spark, folder).select("branch_code", F.upper(F.trim("item_name")).alias("item_key"), "net")
    stores = R.stores(spark, folder).select("branch_code", "region", F.lit(True).alias("_store"))
    items = R.items(spark, folder).select("item_key", "product_mix")
    joined = lines.join(sized(stores, "stores"), "branch_code", "left").join(sized(items, "items"), "item_key", "left")
    seen, read = observed(joined, "read", without_store=F.col("_store").isNull(), without_mix=F.col("product_mix").isNull())
    kept, reported = observed(seen.filter("_store and product_mix is not null"), "reported")
    kept.groupBy("region", "product_mix").agg(F.sum("net").alias("net")).write.parquet(place(spark, "observed"))
    counts = [(k, read.get[k]) for k in ("rows", "without_store", "without_mix")] + [("reported", reported.get["rows"])]
    return spark.createDataFrame(counts, "metric string, value bigint")


@query(
    "embedded_pages",
    """SELECT CAST(p_partkey AS BIGINT) AS page_id, p_name || ' "' || p_brand || '" </script>' AS name, CAST(p_size AS DOUBLE) / 10 AS rating,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_partkey * 3 AS VARCHAR) END AS reviews FROM part""",
)
def embedded_pages(spark, folder):
    """Fields of the pages' embedded JSON, in either order, with quotes and a closing tag inside; a fifth of the pages has the rating as text only."""
    p = R.table(spark, folder, "part")
    name = F.concat("p_name", F.lit(' "'), "p_brand", F.lit('" </script>')).alias("name")
    rating = F.struct((F.col("p_size") / 10).cast("string").alias("ratingValue"), (F.col("p_partkey") * 3).alias("reviewCount"))
    first, second = F.to_json(F.struct(name, rating.alias("aggregateRating"))), F.to_json(F.struct(rating.alias("aggregateRating"), name))
    text = F.when(F.col("p_partkey") % 2 == 0, first).otherwise(second)
    text = F.when(F.col("p_partkey") % 5 == 0, F.to_json(F.struct(name))).otherwise(text)
    block = F.concat(F.lit('<script>var x = {"name": 1};</script><script type="application/ld+json">'), F.replace(text, F.lit("</"), F.lit("<\\/")), F.lit("</script>"))
    html = F.concat(block, F.lit("<b>rating: "), (F.col("p_size") / 10).cast("string"), F.lit("</b>"))
    pages = p.select(F.col("p_partkey").alias("page_id"), html.alias("html")).withColumn("_json", embedded_json("html"))
    return pages.select(
        "page_id",
        F.get_json_object("_json", "$.name").alias("name"),
        embedded_value("_json", "$.aggregateRating.ratingValue", "html", r"rating: ([\d.]+)").cast("double").alias("rating"),
        F.get_json_object("_json", "$.aggregateRating.reviewCount").alias("reviews"),
    )


@query(
    "listing_sheet",
    f"""WITH {R.STORES_SQL} SELECT 'B' || branch_code AS listing_a, CAST(CAST(branch_code AS BIGINT) * 3 AS VARCHAR) AS listing_b, store_name, upper(r) AS region
FROM (SELECT *, (SELECT r_name FROM region JOIN nation ON r_regionkey = n_regionkey WHERE n_name = am_name) AS r FROM stores)""",
)
def listing_sheet(spark, folder):
    """The listings of company-owned stores from their sheet."""
    s = R.store_sheet(spark, folder)
    rows = s.select(
        F.concat(F.lit(" B"), "branch_code", F.lit(" ")).alias("S_RID"),
        (F.col("branch_code").cast("bigint") * 3).cast("string").alias("Z_RID"),
        F.col("am_name").alias("Brand Name"),
        F.col("store_name").alias("Store Name"),
        F.col("region").alias("Region"),
        F.col("ownership").alias("Store Type"),
    )
    path = place(spark, "listings")
    rows.write.option("header", True).csv(path)
    out = dimensions.listing_dim(spark, path)
    return out.select("listing_a", "listing_b", "store_name", F.upper(F.trim("region")).alias("region"))
