"""Batch scans of landed files with declared schemas.

Layout: ``<root>/<dataset>/business_day=YYYY-MM-DD/*.json`` (JSON lines, one
envelope or one record per line). A day filter becomes partition pruning.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.time import parse_ts, parse_utc
from ..operators.joins import keep_first, sortable
from ..operators.shape import first_present, unwrap_envelope
from . import keylog

DAY = "business_day"
ENVELOPES = ("data", "transactions", "timings")
ALERT_LOG = S.SENT_ALERT.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", run string, business_date date"


def scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    days: Sequence[date] | None = None,
    between: tuple[date, date] | None = None,
    lineage: bool = False,
    stream: bool = False,
) -> DataFrame:
    """Files under ``path`` read with ``schema``; only the wanted day partitions are opened. With ``stream`` each file is read once, as it lands."""
    day_field = T.StructField(DAY, T.DateType())
    df = (spark.readStream if stream else spark.read).schema(T.StructType([*schema.fields, day_field])).format(fmt).load(path)
    if days is not None:
        df = df.filter(F.col(DAY).isin([F.lit(d) for d in days]))
    if between is not None:
        df = df.filter(F.col(DAY).between(F.lit(between[0]), F.lit(between[1])))
    return df.withColumn("landed_file", F.input_file_name()) if lineage else df


def _lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """The files' lines as text, one JSON value each."""
    return scan(spark, path, T.StructType([T.StructField("value", T.StringType())]), fmt="text", **options)


def _spelled(schema: T.StructType) -> T.StructType:
    """The schema with every name as it is landed, whose names may differ in case only."""
    landed_as = {twin: name for name, twin in S.CASE_TWINS.items()}
    return T.StructType([T.StructField(landed_as.get(f.name, f.name), f.dataType) for f in schema.fields])


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines -> the line and ``_json``: the envelope's lists, ``_list`` for a bare list, and the fields of a bare record.

    A line is parsed once, whatever its form: a bare list becomes the one field of an object. Names are matched with their
    case; the cast then gives those that Spark could not tell apart their own names, by position.
    """

    def whole(record: T.StructType) -> T.StructType:
        lists = [T.StructField(n, T.ArrayType(record)) for n in (*ENVELOPES, "_list")]
        return T.StructType([*lists, *record.fields])

    rest = [c for c in lines.columns if c != "value"]
    bare = F.ltrim("value").startswith("[")
    text = F.when(bare, F.concat(F.lit('{"_list":'), "value", F.lit("}"))).otherwise(F.col("value"))
    return lines.select(*rest, "value", F.from_json(text, whole(_spelled(schema))).cast(whole(schema)).alias("_json"))


def _lists(parsed: DataFrame) -> DataFrame:
    return parsed.select(*[c for c in parsed.columns if c != "_json"], *[F.col(f"_json.{n}") for n in (*ENVELOPES, "_list")])


def scan_enveloped(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Like ``scan_records`` for responses landed whole: records under data, transactions or timings, or a bare list."""
    return unwrap_envelope(_lists(_parsed(_lines(spark, path, **options), schema)).drop("value"), ENVELOPES)


def scan_records(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Files of one record a line."""
    if options.get("fmt", "json") != "json":
        return scan(spark, path, schema, **options)
    options.pop("fmt", None)
    parsed = _parsed(_lines(spark, path, **options), schema)
    fields = [F.col(f"_json.`{f.name}`") for f in schema.fields]
    return parsed.select(*[c for c in parsed.columns if c not in ("value", "_json")], *fields)


def rejected(spark: SparkSession, path: str, **options) -> DataFrame:
    """Response lines that none of the readers gets records from: no JSON, or no list under a known name. Keep them with the run."""
    parsed = _lists(_parsed(_lines(spark, path, **options), T.StructType([T.StructField("branchCode", T.StringType())])))
    lists = F.coalesce(*[F.col(n) for n in (*ENVELOPES, "_list")])
    return parsed.filter(lists.isNull() & (F.trim("value") != "")).select(*[c for c in parsed.columns if c not in (*ENVELOPES, "_list")])


def _read(spark: SparkSession, path: str, schema: T.StructType, enveloped: bool, options: dict) -> DataFrame:
    return (scan_enveloped if enveloped else scan_records)(spark, path, schema, **options)


def one_per_key(df: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """Optional: drop repeats of a record that two pages both carry, newest kept; ties go by all other columns."""
    rest = [F.asc_nulls_last(c) for c in sortable(df) if c not in (*keys, newest)]
    return keep_first(df, keys, [F.desc_nulls_last(newest), *rest])


def _code(df: DataFrame) -> Column:
    return F.trim(first_present(df, S.CODE_NAMES)).alias("branch_code")


def _channel(df: DataFrame) -> Column:
    return first_present(df, [S.CASE_TWINS.get(n, n) for n in S.CHANNEL_NAMES]).alias("channel")


def sales_orders(spark: SparkSession, path: str, enveloped: bool = False, **options) -> DataFrame:
    """One row per order, items still nested."""
    df = _read(spark, path, S.SALES_ORDER, enveloped, options)
    return df.select(
        _code(df),
        F.col("brandName").alias("brand"),
        F.col("invoiceNumber").alias("invoice"),
        F.coalesce(F.col("invoiceDay").try_cast("date"), F.col(DAY)).alias("invoice_day"),
        parse_ts("invoiceDate").alias("order_time"),
        parse_ts("orderReadyTimestamp").alias("ready_time"),
        parse_ts("modifiedDate").alias("delivered_time"),
        parse_utc("createdDate").alias("created_utc"),
        _channel(df),
        F.upper(F.trim("status")).alias("status"),
        F.col("totalMaterialCost").try_cast("decimal(18,2)").alias("material_cost"),
        "discounts",
        "items",
        DAY,
    )


def soldout_events(spark: SparkSession, path: str, enveloped: bool = False, **options) -> DataFrame:
    df = _read(spark, path, S.SOLDOUT_EVENT, enveloped, options)
    return df.select(
        _code(df),
        F.col("eventType").alias("event_type"),
        F.col("statusType").alias("status_type"),
        F.coalesce(F.col("eventBusinessDay").try_cast("date"), F.col(DAY)).alias("event_day"),
        parse_ts("eventDate").alias("event_time"),
        F.col("itemType").alias("item_type"),
        F.col("categoryName").alias("category_name"),
        F.col("itemName").alias("item_name"),
        F.col("userName").alias("user_name"),
    )


def item_activity(spark: SparkSession, path: str, enveloped: bool = False, **options) -> DataFrame:
    """One row per branch, day and item, activities still nested."""
    df = _read(spark, path, S.ITEM_ACTIVITY, enveloped, options)
    return df.select(
        _code(df),
        F.coalesce(F.col("activityDate").try_cast("date"), F.col(DAY)).alias("activity_date"),
        F.col("skuCode").alias("sku_code"),
        F.col("openingBalance").alias("opening_qty"),
        F.col("openingCost").alias("opening_cost"),
        F.col("closingBalance").alias("closing_qty"),
        F.col("closingCost").alias("closing_cost"),
        "activities",
    )


def stock_movements(spark: SparkSession, path: str, enveloped: bool = False, **options) -> DataFrame:
    """Transfers, receipts or stock; the code sits on the record or on its items."""
    return _read(spark, path, S.STOCK_MOVEMENT, enveloped, options)


def snapshot(
    spark: SparkSession, path: str, days: Sequence[date] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A snapshot kept as landed: current sold-out, store items, shrinkage, coupons, timings.

    Without a schema nothing is inferred: each record is its branch code and its own JSON text, whatever fields the
    day's records have. Records come one a line, in a list, or under a known name of a response.
    """
    if schema is not None:
        return scan_records(spark, path, schema, days=days)
    lines = _lines(spark, path, days=days)
    texts = T.ArrayType(T.StringType())
    envelope = T.StructType([T.StructField(n, texts) for n in ENVELOPES])
    bare = F.ltrim("value").startswith("[")
    under = F.from_json("value", envelope)
    filled = [F.when(F.size(under[n]) > 0, under[n]) for n in ENVELOPES]
    # a response whose lists are all empty has no record
    response = F.coalesce(*[under[n] for n in ENVELOPES])
    records = F.when(bare, F.from_json("value", texts)).otherwise(
        F.coalesce(*filled, F.when(response.isNull(), F.array("value")), F.array().cast(texts))
    )
    rows = lines.filter(F.trim("value") != "").select(DAY, F.explode(records).alias("record"))
    code = F.coalesce(*[F.get_json_object("record", f"$['{n}']") for n in S.CODE_NAMES])
    return rows.select(code.alias("branchCode"), "record", DAY)


def snapshot_variants(spark: SparkSession, path: str, days: Sequence[date] | None = None) -> DataFrame:
    """A snapshot's records as VARIANT: fields keep the types they were landed with, and are read by path. A record that is no JSON is null."""
    rows = snapshot(spark, path, days)
    return rows.withColumn("record", F.try_parse_json("record"))


def field_types(records: DataFrame, by: Sequence[str], column: str = "record") -> DataFrame:
    """The types under which each field occurs, per key: what drifts between days shows as another row."""
    merged = records.groupBy(*by).agg(F.schema_of_variant_agg(column).alias("_schema"))
    fields = F.regexp_extract_all(F.regexp_extract("_schema", r"(?s)^OBJECT<(.*)>$", 1), F.lit(r"(?:^|, )(\w+): ((?:[A-Z]+(?:\([^)]*\))?)(?:<.*?>)?)"), F.lit(0))
    each = merged.select(*by, F.explode(fields).alias("_field"))
    bare = F.regexp_replace("_field", "^, ", "")
    return each.select(*by, F.substring_index(bare, ": ", 1).alias("field"), F.regexp_extract(bare, ": (.*)$", 1).alias("type"))


def drifted(types: DataFrame, by: Sequence[str], declared: dict[str, str]) -> DataFrame:
    """Fields of other types than declared, and fields not declared."""
    known = types.sparkSession.createDataFrame(list(declared.items()), "field string, declared string")
    return types.join(F.broadcast(known), "field", "left").filter(~F.col("type").eqNullSafe(F.col("declared"))).select(*by, "field", "type", "declared")


def pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(S.PAGE).format(fmt).load(path)


def sent_alerts(
    spark: SparkSession,
    path: str,
    except_run: str | None = None,
    days: Sequence[date | None] | None = None,
    between: tuple[date, date] | None = None,
) -> DataFrame:
    """The alert log, without one run's own keys if asked; an empty table before the first run.

    ``days`` reads the folders of those business days only, None among them standing for rows without a day;
    ``between`` those from the first to the last.
    """
    if between is not None:
        first, last = between
        days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    log = keylog.read(spark, path, ALERT_LOG, "run", days)
    if except_run is not None:
        log = log.filter(F.col("run") != except_run)
    return log.select("alert_key", "sent_time")


def missing_landings(stores: DataFrame, landed: DataFrame, first: date, last: date) -> DataFrame:
    """Expected branch x day without any landed row; the day list is per store, no cross join."""
    days = F.sequence(F.lit(first), F.lit(last))
    expected = stores.select("branch_code", F.explode(days).alias(DAY))
    seen = landed.select("branch_code", DAY).distinct()
    return expected.join(seen, ["branch_code", DAY], "left_anti")


__all__ = [
    "item_activity",
    "missing_landings",
    "one_per_key",
    "pages",
    "rejected",
    "sales_orders",
    "scan",
    "scan_enveloped",
    "scan_records",
    "sent_alerts",
    "snapshot",
    "snapshot_variants",
    "soldout_events",
    "stock_movements",
]
