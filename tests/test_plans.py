"""What the physical plans must look like."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_module
from tillwork.operators import joins
from tillwork.operators.joins import keep_first, source_bytes, with_dimension

QUERIES = entry_module.queries()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["category_compare", "sla_store", "stock_store", "soldout_material_region", "page_ratings", "alert_headers"])
def test_no_python_worker_and_no_cross_join(name, spark, folder):
    plan = plan_of(QUERIES[name](spark, folder))
    for banned in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan


def test_period_filter_and_columns_reach_the_scan(spark, folder):
    plan = plan_of(QUERIES["category_compare"](spark, folder))
    scan = next(s for s in re.findall(r"FileScan parquet \[[^\n]*", plan) if "orders.parquet" in s)
    assert "GreaterThanOrEqual(o_orderdate" in scan
    assert re.findall(r"ReadSchema: (\S+)", scan)[0].count(":") == 3
    line = next(s for s in re.findall(r"FileScan parquet \[[^\n]*", plan) if "lineitem.parquet" in s)
    assert "l_tax" not in line and "l_shipdate" not in line


def test_stock_reads_one_month(spark, folder):
    plan = plan_of(QUERIES["stock_store"](spark, folder))
    assert "GreaterThanOrEqual(l_shipdate,1998-06-01" in plan


def test_page_text_is_not_shuffled(spark, folder):
    plan = plan_of(QUERIES["listing_ratings"](spark, folder))
    assert not [line for line in plan.splitlines() if "Exchange" in line and "html" in line]


def test_dimension_is_broadcast_only_under_the_size_limit(spark, folder, monkeypatch):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    customers = spark.read.parquet(f"{folder}/customer.parquet").withColumnRenamed("c_custkey", "o_custkey")
    assert 0 < source_bytes(customers) < joins.BROADCAST_SOURCE_BYTES
    assert "BroadcastHashJoin" in plan_of(with_dimension(orders, customers, "o_custkey"))
    monkeypatch.setattr(joins, "BROADCAST_SOURCE_BYTES", 10)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "SortMergeJoin" in plan_of(with_dimension(orders, customers, "o_custkey"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_keep_first_cuts_before_the_exchange(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    plan = plan_of(keep_first(orders, ["o_custkey"], ["o_orderkey"]))
    partial, exchange = plan.index("Partial"), plan.index("Exchange hashpartitioning")
    assert partial > exchange  # printed top-down: the partial cut is below the exchange


def test_period_compare_shuffles_by_invoice_then_by_key(spark, folder):
    plan = plan_of(QUERIES["category_compare"](spark, folder))
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert any("invoice" in k and "period" in k for k in keys)
    assert "Expand" not in plan


def test_shared_mart_needs_no_exchange_of_lines(spark, folder):
    from tillwork.catalog import product as catalog
    from tillwork.plans import product
    from tillwork.session import written_by

    before = len(spark.catalog.listTables())
    with written_by(product.invoice_mart(catalog.mart(spark, folder)), "invoice") as shared:
        for dashboard in (product.category_compare, product.mix_by_source, product.region_source_mix):
            keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan_of(dashboard(shared)))
            assert len(keys) == 1 and "invoice" not in keys[0]
    assert len(spark.catalog.listTables()) == before


def test_buckets_follow_from_the_days_read(spark, tmp_path, monkeypatch):
    """Rows are written once, and days that the filter rules out do not count."""
    from tillwork import session

    spark.range(40_000).selectExpr("id", "id % 10 AS day").write.partitionBy("day").parquet(f"{tmp_path}/t")
    days = spark.read.parquet(f"{tmp_path}/t")
    one, every = session.scanned_bytes(days.filter("day = 3")), session.scanned_bytes(days)
    assert 0 < 5 * one < every
    monkeypatch.setattr(session, "BUCKET_BYTES", one // 20)
    with session.written_by(days.filter("day = 3"), "id") as shared:
        assert 20 <= len(shared.inputFiles()) <= 21 and shared.count() == 4000


@pytest.mark.parametrize(
    "name", ["region_category_compare", "sla_region_matrix", "sla_category_by_region", "sla_item_by_region", "rca_flags", "order_status_counts"]
)
def test_one_scan_of_each_fact(name, spark, folder):
    plan = plan_of(QUERIES[name](spark, folder))
    for fact in ("lineitem", "orders"):
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line and f"{fact}.parquet" in line]
        assert len(scans) == 1, name


def test_written_dimension_of_a_large_source_is_broadcast(spark, folder, monkeypatch):
    """The files of a dimension may be large while the dimension is small."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    few = orders.groupBy("o_orderpriority").agg({"o_orderkey": "min"}).withColumnRenamed("min(o_orderkey)", "l_orderkey")
    monkeypatch.setattr(joins, "BROADCAST_SOURCE_BYTES", 20_000)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert source_bytes(few) > 20_000
        small = plan_of(with_dimension(lines, few, "l_orderkey"))
        assert "BroadcastHashJoin" in small and "hashpartitioning(l_orderkey" not in small
        # a large one is read from its own table: both sides of the join come straight from an exchange
        large = plan_of(with_dimension(lines, orders.withColumnRenamed("o_orderkey", "l_orderkey").distinct(), "l_orderkey"))
        assert "SortMergeJoin" in large and "HashAggregate" not in large
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_order_dashboards_share_one_scan(spark, folder):
    from tillwork.catalog import sla as catalog
    from tillwork.plans import sla
    from tillwork.session import written

    hist = written(sla.histogram(catalog.lines(spark, folder)))
    for df in (sla.matrix(hist), sla.region_matrix(hist), sla.store_table(hist), sla.headline(hist)):
        assert "FileScan" not in plan_of(df)
    assert sorted(sla.matrix(hist).collect()) == sorted(sla.matrix(catalog.lines(spark, folder)).collect())
