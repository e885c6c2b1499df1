"""Store, item and listing dimensions from ragged sheets exported as CSV."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import key_of, null_if_missing, region_code
from ..operators.filters import company_owned, ledger_store, usable_code
from ..operators.joins import dimension_conflicts, unique_dimension
from ..operators.shape import MissingColumns, detect_column, safe_headers


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A CSV sheet with unique normalised headers; short rows are padded, long rows cut, all text."""
    header = spark.read.option("header", "false").csv(path).first()
    cells = ", ".join(f"`{h}` string" for h in safe_headers(list(header)))
    return spark.read.schema(cells).option("header", "true").option("enforceSchema", "true").csv(path)


def _rename(df: DataFrame, labels: Mapping[str, str], required: Sequence[str]) -> DataFrame:
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise MissingColumns(f"missing columns {absent}; available {df.columns}")
    return df.select(
        *[(F.col(f"`{src}`") if src in df.columns else F.lit(None).cast("string")).alias(dst) for src, dst in labels.items()]
    )


def clean_stores(df: DataFrame, regions: Mapping[str, str] | None = None) -> DataFrame:
    """Canonical text, region codes, sentinels to NULL; nothing filtered yet."""
    out = df.withColumns(
        {
            "branch_code": null_if_missing("branch_code"),
            "store_name": null_if_missing("store_name"),
            "ownership": key_of("ownership"),
            "region": region_code(null_if_missing("region"), regions),
        }
    )
    return out.filter(usable_code("branch_code"))


def company_stores(df: DataFrame, regions: Mapping[str, str] | None = None) -> DataFrame:
    """Company-owned stores, unique by code."""
    kept = clean_stores(df, regions).filter(company_owned("ownership"))
    return unique_dimension(kept, ["branch_code"], [F.asc_nulls_last("store_name"), F.asc_nulls_last("region")])


def ledger_stores(df: DataFrame, explicit: Sequence[str] = (), regions: Mapping[str, str] | None = None) -> DataFrame:
    """Stores of the stock ledger: company-owned, warehouses, and listed codes; unique by code."""
    rule: Column = ledger_store(F.col("ownership"), F.col("branch_code"), explicit)
    kept = clean_stores(df, regions).filter(rule)
    return unique_dimension(kept, ["branch_code"], [F.asc_nulls_last("store_name"), F.asc_nulls_last("region")])


def store_dim(spark: SparkSession, path: str) -> DataFrame:
    sheet = read_sheet(spark, path)
    return company_stores(_rename(sheet, S.STORE_COLUMNS, ["branchcode", "ownership", "storename", "region"]))


def store_conflicts(spark: SparkSession, path: str) -> DataFrame:
    """Codes of company-owned stores that the sheet lists with different attributes: what ``store_dim`` had to pick from."""
    rows = _rename(read_sheet(spark, path), S.STORE_COLUMNS, ["branchcode", "ownership", "storename", "region"])
    kept = clean_stores(rows).filter(company_owned("ownership"))
    return dimension_conflicts(kept, ["branch_code"], [c for c in kept.columns if c != "branch_code"])


def item_conflicts(spark: SparkSession, path: str) -> DataFrame:
    """Item names that the sheet lists with different attributes."""
    rows = _rename(read_sheet(spark, path), S.ITEM_COLUMNS, ["itemname"])
    keyed = rows.withColumn("item_key", key_of("item_key")).filter(F.col("item_key") != "")
    return dimension_conflicts(keyed, ["item_key"], [c for c in keyed.columns if c != "item_key"])


def ledger_store_dim(spark: SparkSession, path: str, explicit: Sequence[str] = ()) -> DataFrame:
    """Columns are found by part of their name, as this sheet's headers vary."""
    sheet = read_sheet(spark, path)
    found = {
        "branch_code": detect_column(sheet.columns, "branchcode"),
        "store_name": detect_column(sheet.columns, "storename", "store"),
        "region": detect_column(sheet.columns, "region"),
        "ownership": detect_column(sheet.columns, "ownership"),
    }
    if found["branch_code"] is None:
        raise MissingColumns(f"no branch code column; available {sheet.columns}")
    cells = [(F.col(f"`{src}`") if src else F.lit(None).cast("string")).alias(dst) for dst, src in found.items()]
    return ledger_stores(sheet.select(*cells), explicit)


def clean_items(df: DataFrame) -> DataFrame:
    """Unique by upper-cased trimmed item name."""
    keyed = df.withColumn("item_key", key_of("item_key")).filter(F.col("item_key") != "")
    order = [F.asc_nulls_last(c) for c in keyed.columns if c != "item_key"]
    return unique_dimension(keyed, ["item_key"], order)


def item_dim(spark: SparkSession, path: str) -> DataFrame:
    return clean_items(_rename(read_sheet(spark, path), S.ITEM_COLUMNS, ["itemname"]))


def listing_dim(spark: SparkSession, path: str) -> DataFrame:
    """Company-owned listings with both platforms' page ids."""
    listings = _rename(read_sheet(spark, path), S.LISTING_COLUMNS, ["s_rid", "z_rid", "storetype"])
    ids = {"listing_a": F.trim("listing_a"), "listing_b": F.trim("listing_b")}
    return listings.filter(company_owned("ownership")).withColumns(ids)
