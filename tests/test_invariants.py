"""Relations that must hold between reports on the test tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillwork.catalog import product, sla, soldout, stock
from tillwork.catalog import roles as R
from tillwork.functions.text import channel_group
from tillwork.plans import product as P
from tillwork.plans import sla as S
from tillwork.plans import soldout as O
from tillwork.plans import stock as K


@pytest.fixture(scope="module")
def lines(spark, folder):
    return sla.lines(spark, folder)


def test_segments_partition_the_overall(lines):
    got = {r.parameter: r for r in S.matrix(lines).collect()}
    for parameter in ("Orders", "Breached Orders KPT", "Breached Orders O2D"):
        r = got[parameter]
        for period in ("FTD", "MTD"):
            named = r[f"{period} Swiggy"] + r[f"{period} Zomato"]
            assert named <= r[f"{period} Overall"]
        assert all(r[f"FTD {who}"] <= r[f"MTD {who}"] for who in ("Swiggy", "Zomato", "Overall"))


def test_items_add_up_to_all_lines(lines):
    total = lines.count()
    table = S.item_table(lines)
    assert table.agg(F.sum("mtd_orders")).first()[0] == total
    assert table.filter("ftd_orders > mtd_orders").count() == 0


def test_regions_and_overall_agree(lines):
    both = S.item_table(lines, by_region=True)
    by_region = both.filter("scope <> 'Overall'").groupBy("item_name").agg(F.sum("mtd_orders").alias("n"))
    overall = both.filter("scope = 'Overall'").select("item_name", F.col("mtd_orders").alias("n"))
    assert by_region.exceptAll(overall).count() == 0 and overall.exceptAll(by_region).count() == 0


def test_distinct_orders_never_exceed_lines(spark, folder):
    mart = product.mart(spark, folder)
    by_invoice = P.category_compare(mart).agg(F.sum("today_orders")).first()[0]
    by_line = mart.filter("period = 'CURRENT' and category_group is not null").count()
    assert 0 < by_invoice <= by_line


def test_no_line_is_multiplied_by_the_dimensions(spark, folder):
    raw = R.sales_lines(spark, folder)
    known = raw.join(R.stores(spark, folder).select("branch_code"), "branch_code", "left_semi")
    base = P.line_base(raw, R.stores(spark, folder), R.items(spark, folder).withColumn("product_mix", F.lit("x")), R.PERIODS)
    inside = known.filter(" or ".join(f"order_time between timestamp_ntz'{p.start}' and timestamp_ntz'{p.end}'" for p in R.PERIODS))
    assert base.count() == inside.count()


def test_region_ratio_is_ratio_of_store_sums(spark, folder):
    days = stock.days(spark, folder)
    stores = K.store_summary(days, R.STOCK_FIRST, R.STOCK_LAST).groupBy("region").agg(
        F.sum("sales_cost").alias("s"), F.sum("closing_cost").alias("c")
    )
    for r in K.region_summary(days, R.STOCK_FIRST, R.STOCK_LAST).join(stores, "region").collect():
        assert r.soh_cost_pct == pytest.approx(r.s / r.c * 100 if r.c > 0 else 0.0)


def test_second_alert_run_is_empty(spark, folder):
    first = O.new_alerts(soldout.base(spark, folder), spark.createDataFrame([], "alert_key string"))
    assert first.count() > 0
    assert O.new_alerts(soldout.base(spark, folder), first.select("alert_key")).count() == 0


def test_pivot_totals_equal_events(spark, folder):
    base = soldout.base(spark, folder)
    long = O.category_by_store(base).agg(F.sum("rows")).first()[0]
    assert long == base.filter("store_name is not null").count()


def test_channel_groups_cover_every_order(spark, folder):
    orders = R.table(spark, folder, "orders")
    assert orders.filter(channel_group("o_orderpriority").isNull()).count() == 0
