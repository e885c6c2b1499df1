"""Landed schemas (field names as landed) and the canonical columns the reports use."""

from __future__ import annotations

from pyspark.sql import types as T


TEXT = T.StringType()


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, TEXT) for n in names]


def _objects(*fields: T.StructField) -> T.ArrayType:
    return T.ArrayType(T.StructType(list(fields)))


# Field names as landed, and names that other records use for the same field.
# A record has its branch code under the first of these names that it fills.
CODE_NAMES = ("branchCode", "branch", "storeCode", "Store Code")
CHANNEL_NAMES = ("Channel", "channel")
# Spark compares names without case, so the reader takes this one in under another name.
CASE_TWINS = {"Channel": "channelLabel"}

# Times and amounts are landed as text and parsed leniently: a malformed one is missing, not fatal.
DISCOUNTS = T.StructField("discounts", _objects(*_text("name")))
ORDER_ITEMS = _objects(
    *_text(
        "shortName",
        "categoryName",
        "quantity",
        "baseGrossAmount",
        "baseNetDiscountAmount",
        "baseNetAmount",
        "createdTime",
    ),
    DISCOUNTS,
)
SALES_ORDER = T.StructType(
    [
        *_text(
            *CODE_NAMES,
            "branchName",
            "brandName",
            "invoiceNumber",
            "invoiceDay",
            "invoiceDate",
            "orderReadyTimestamp",
            "modifiedDate",
            "createdDate",
            "channel",
            CASE_TWINS["Channel"],
            "status",
            "totalMaterialCost",
        ),
        DISCOUNTS,
        T.StructField("items", ORDER_ITEMS),
    ]
)
SOLDOUT_EVENT = T.StructType(
    _text(
        *CODE_NAMES,
        "eventType",
        "statusType",
        "eventBusinessDay",
        "eventDate",
        "itemType",
        "categoryName",
        "itemName",
        "userName",
    )
)
ITEM_ACTIVITY = T.StructType(
    [
        *_text(
            *CODE_NAMES,
            "activityDate",
            "skuCode",
            "openingBalance",
            "openingCost",
            "closingBalance",
            "closingCost",
        ),
        T.StructField("activities", _objects(*_text("type", "quantity", "cost"))),
    ]
)
STOCK_MOVEMENT = T.StructType(
    [*_text("branchCode", "skuCode", "quantity"), T.StructField("items", _objects(*_text("skuCode", "quantity")))]
)
SENT_ALERT = T.StructType([*_text("alert_key"), T.StructField("sent_time", T.TimestampType())])
PAGE = T.StructType([*_text("url", "html"), T.StructField("fetched_at", T.TimestampType())])

STORE_COLUMNS = {
    "branchcode": "branch_code",
    "storename": "store_name",
    "region": "region",
    "ownership": "ownership",
    "amemail": "am_email",
    "rmemail": "rm_email",
    "amname": "am_name",
    "ccmail": "cc_mail",
    "channel": "store_channel",
    "source": "store_source",
}
ITEM_COLUMNS = {
    "itemname": "item_key",
    "itemgroupname": "item_group",
    "variant(s)": "variant",
    "productmix": "product_mix",
    "categorygroup": "category_group",
}
LISTING_COLUMNS = {
    "s_rid": "listing_a",
    "z_rid": "listing_b",
    "brandname": "brand",
    "storename": "store_name",
    "region": "region",
    "storetype": "ownership",
}
