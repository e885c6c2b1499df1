"""Sold-out reports, alerts and ratings on the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..plans import ratings as G
from ..plans import soldout as P
from ..session import scratch_dir, stored
from ..streaming.alerts import alert_stream, landed_stream, run_available, sent_log
from . import roles as R
from .registry import query

REGIONS = ["AF", "AM", "AS", "EU", "ANTARCTICA"]
PART_ROWS = 5


def base(spark, folder):
    return P.soldout_base(R.soldout_events(spark, folder), R.stores(spark, folder))


def texts(df):
    return df.withColumns(
        {"business_date": F.col("business_date").cast("string"), "event_time": F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")}
    )


@query(
    "soldout_base",
    f"""WITH {R.SOLDOUT_SQL}
SELECT CAST(business_date AS VARCHAR) AS business_date, branch_code, store_name, region, item_type, category_name, item_name,
       strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, user_name, am_name FROM soldout""",
)
def soldout_base(spark, folder):
    return texts(base(spark, folder)).drop("status_type", "event_type", "am_email", "rm_email", "cc_mail")


def pivot_sql(row: str, kind: str, counted: str) -> str:
    cells = ", ".join(f"count({counted}) FILTER (region = '{r}') AS \"{r}\"" for r in REGIONS)
    return f"WITH {R.SOLDOUT_SQL} SELECT {row}, {cells} FROM soldout WHERE item_type = '{kind}' GROUP BY {row}"


query("soldout_material_region", pivot_sql("item_name", "material", "branch_code"))(
    lambda s, d: P.material_by_region(base(s, d), REGIONS)
)
query("soldout_category_region", pivot_sql("category_name", "product", "item_name"))(
    lambda s, d: P.category_by_region(base(s, d), REGIONS)
)
query(
    "soldout_store_material",
    f"""WITH {R.SOLDOUT_SQL} SELECT store_name, item_name, count(branch_code) AS rows FROM soldout
WHERE item_type = 'material' AND store_name IS NOT NULL GROUP BY ALL""",
)(lambda s, d: P.material_by_store(base(s, d)))
query(
    "soldout_store_category",
    f"""WITH {R.SOLDOUT_SQL} SELECT store_name, category_name, count(item_name) AS rows FROM soldout
WHERE store_name IS NOT NULL GROUP BY ALL""",
)(lambda s, d: P.category_by_store(base(s, d)))

CATEGORIES = [f"CAT_{i}" for i in range(8)]


@query(
    "soldout_store_category_wide",
    f"WITH {R.SOLDOUT_SQL} SELECT store_name, "
    + ", ".join(
        f"CASE count(*) FILTER (category_name = '{c}') WHEN 0 THEN '-'"
        f" ELSE CAST(count(*) FILTER (category_name = '{c}') AS VARCHAR) END AS \"{c}\""
        for c in CATEGORIES
    )
    + " FROM soldout WHERE store_name IS NOT NULL GROUP BY store_name",
)
def soldout_store_category_wide(spark, folder):
    return P.dashed(P.wide(P.category_by_store(base(spark, folder)), "category_name", CATEGORIES), CATEGORIES)


DETAIL = ("business_date", "store_name", "category_name", "item_name", "event_time", "user_name")


def detail_sql(where: str) -> str:
    return f"""WITH {R.SOLDOUT_SQL}
SELECT CAST(business_date AS VARCHAR) AS business_date, store_name, category_name, item_name,
       strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, user_name FROM soldout {where}"""


query("soldout_detail_material", detail_sql("WHERE item_type = 'material'"))(
    lambda s, d: texts(P.of_type(base(s, d), "material")).select(*DETAIL)
)
query("soldout_detail_product", detail_sql("WHERE item_type = 'product'"))(
    lambda s, d: texts(P.of_type(base(s, d), "product")).select(*DETAIL)
)
query("soldout_detail_store", detail_sql(""))(lambda s, d: texts(base(s, d)).select(*DETAIL))

# the noon run has sent what happened before noon; the evening run alerts the rest;
# items are told apart coarsely here, so that a store runs out of one item several times a day
ALERTS_SQL = f"""WITH {R.SOLDOUT_SQL},
keyed AS (SELECT * REPLACE (CAST(substr(item_name, 6) AS INTEGER) % 2 || '' AS item_name),
                 store_name || '|' || CAST(substr(item_name, 6) AS INTEGER) % 2 || '|' || CAST(business_date AS VARCHAR) AS alert_key
          FROM soldout WHERE store_name IS NOT NULL),
sent AS (SELECT DISTINCT alert_key FROM keyed WHERE hour(event_time) < 12),
fresh AS (SELECT * FROM keyed WHERE alert_key NOT IN (SELECT alert_key FROM sent)
          QUALIFY row_number() OVER (PARTITION BY alert_key
                  ORDER BY event_time, user_name, category_name, item_type, branch_code) = 1)"""


def coarse(events):
    return events.withColumn("item_name", (F.substring("item_name", 6, 9).cast("int") % 2).cast("string"))


def alerts(spark, folder):
    events = coarse(base(spark, folder))
    noon = P.with_alert_key(events.filter(F.hour("event_time") < 12)).select("alert_key")
    return stored(P.new_alerts(events, noon), "alerts")


@query(
    "alerts_new",
    f"""{ALERTS_SQL} SELECT alert_key, store_name, item_name, CAST(business_date AS VARCHAR) AS business_date,
       strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, user_name FROM fresh""",
)
def alerts_new(spark, folder):
    return texts(alerts(spark, folder)).select(
        "alert_key", "store_name", "item_name", "business_date", "event_time", "user_name"
    )


HEADERS_SQL = """headers AS (
  SELECT store_name, any_value(am_name) AS am_name, any_value(am_email) AS e1, any_value(rm_first) AS e2,
         count(*) AS n_items FROM fresh GROUP BY store_name),
mails AS (SELECT *, array_to_string(list_sort([e1, e2, 'area@example.com']), ',') AS recipients FROM headers)"""


@query("alert_headers", f"{ALERTS_SQL}, {HEADERS_SQL} SELECT store_name, am_name, recipients, n_items FROM mails")
def alert_headers(spark, folder):
    out = P.alert_headers(alerts(spark, folder))
    return out.withColumn("recipients", F.array_join("recipients", ","))


@query(
    "alert_packets",
    f"""{ALERTS_SQL}, {HEADERS_SQL},
lines AS (SELECT f.*, m.recipients, m.n_items,
                 CAST('0x' || substr(md5(alert_key), 1, 8) AS BIGINT) % CAST(ceil(n_items / {PART_ROWS}.0) AS BIGINT) + 1 AS part
          FROM fresh f JOIN mails m USING (store_name))
SELECT store_name, part, any_value(am_name) AS am_name, any_value(recipients) AS recipients, any_value(n_items) AS n_items,
       string_agg(alert_key, ';' ORDER BY alert_key) AS items FROM lines GROUP BY store_name, part""",
)
def alert_packets(spark, folder):
    fresh = alerts(spark, folder)
    out = P.alert_packets(fresh, PART_ROWS, stored(P.alert_headers(fresh), "headers"))
    return out.withColumns(
        {
            "recipients": F.array_join("recipients", ","),
            "items": F.array_join(F.transform("items", lambda i: i["alert_key"]), ";"),
        }
    )


@query(
    "sent_log_keys",
    f"{ALERTS_SQL} SELECT alert_key FROM fresh",
)
def sent_log_keys(spark, folder):
    fresh = alerts(spark, folder)
    return P.sent_keys(fresh, P.alert_headers(fresh)).select("alert_key")


@query(
    "summary_recipients",
    f"""WITH {R.STORES_SQL}
SELECT DISTINCT lower(am_name) || '@example.com' AS address FROM stores
UNION SELECT 'ops@example.com' UNION SELECT 'summary@example.com'""",
)
def summary_recipients(spark, folder):
    return P.summary_recipients(R.stores(spark, folder), ["summary@example.com", "ops@example.com"])


@query(
    "alert_stream",
    f"""{ALERTS_SQL} SELECT alert_key, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS event_time FROM keyed GROUP BY alert_key""",
)
def streamed_alerts(spark, folder):
    raw = landed_stream(spark, R.SCHEMAS["events"], f"{folder}/events.parquet")
    run = f"{scratch_dir(spark)}/alert_stream_{uuid.uuid4().hex}"
    stream = alert_stream(coarse(R.as_soldout(raw)), R.stores(spark, folder))
    run_available(stream, f"{run}/log", f"{run}/checkpoint")
    sent = sent_log(spark, f"{run}/log")
    return sent.select("alert_key", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"))


# --- listing pages ---------------------------------------------------------

# pages of one host suffix are one platform's, the number in the path is the listing; page ids rise with time
PATH_A, PATH_B = r"example\.com/\w+/(\d+)", r"example\.net/\w+/(\d+)"
TRACKED = G.Platform(PATH_A, r"track\((\d+)\)", r"<title>(.+?)</title>", ("NICHT", "aulich für"))
SHOWN = G.Platform(PATH_B, r"<!-- ad (\d+) -->", r'<html lang="(\w+)"', ("thanks",))


def side_sql(p: G.Platform, suffix: str) -> str:
    """The newest page of each of the platform's listings."""
    closed = " OR ".join(f"contains(lower(html), '{phrase.lower()}')" for phrase in p.closed)
    return f"""{suffix} AS (
  SELECT regexp_extract(url, '{p.listing}', 1) AS listing_{suffix},
         TRY_CAST(nullif(regexp_extract(html, '{p.rating}', 1), '') AS DOUBLE) AS rating_{suffix},
         nullif(regexp_extract(html, '{p.reviews}', 1), '') AS reviews_{suffix},
         CASE WHEN {closed} THEN 'Offline' ELSE 'Online' END AS status_{suffix}
  FROM pages WHERE regexp_matches(url, '{p.listing}')
  QUALIFY row_number() OVER (PARTITION BY listing_{suffix} ORDER BY page_id DESC) = 1)"""


@query("page_ratings", f"WITH {side_sql(TRACKED, 'a')} SELECT * FROM a")
def page_ratings(spark, folder):
    return G.read_pages(R.table(spark, folder, "pages"), TRACKED, "a", newest="page_id")


@query(
    "listing_ratings",
    f"""WITH {R.STORES_SQL}, {side_sql(TRACKED, "a")}, {side_sql(SHOWN, "b")}
SELECT am_name AS brand, store_name, region, rating_a, rating_b, reviews_a, reviews_b, status_a, status_b
FROM stores LEFT JOIN a ON listing_a = branch_code LEFT JOIN b ON listing_b = CAST(CAST(branch_code AS BIGINT) * 3 AS VARCHAR)""",
)
def listing_ratings(spark, folder):
    listings = R.stores(spark, folder).select(
        F.col("am_name").alias("brand"),
        "store_name",
        "region",
        F.col("branch_code").alias("listing_a"),
        (F.col("branch_code").cast("bigint") * 3).cast("string").alias("listing_b"),
    )
    return G.listing_ratings(listings, R.table(spark, folder, "pages"), TRACKED, SHOWN, newest="page_id")
