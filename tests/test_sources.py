"""Landed files, sheets and sinks, through real files."""

from __future__ import annotations

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillwork.operators.shape import MissingColumns
from tillwork.plans import product, sla, stock
from tillwork.sources import dimensions, landed, sinks


def write_lines(path: Path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in records) + "\n")


def an_order(invoice, day, items, **more):
    return {
        "branchCode": " S1 ",
        "brandName": "B",
        "invoiceNumber": invoice,
        "invoiceDay": day,
        "invoiceDate": f"{day}T10:00:00",
        "orderReadyTimestamp": f"{day}T10:12:00",
        "modifiedDate": "soon",
        "createdDate": f"{day}T04:30:00Z",
        "channel": "Zomato",
        "status": "closed",
        "items": items,
        "ignored": {"deep": 1},
        **more,
    }


CAKE = {"shortName": "Cake", "categoryName": "Sweet", "quantity": 2, "baseGrossAmount": 10.5, "baseNetDiscountAmount": -1,
        "baseNetAmount": "9.50", "discounts": [{"name": "Deal (X)"}]}


@pytest.fixture
def orders_path(tmp_path):
    root = tmp_path / "orders"
    write_lines(root / "business_day=2024-05-14" / "p1.json", [an_order("1", "2024-05-14", [CAKE, CAKE])])
    write_lines(
        root / "business_day=2024-05-15" / "p1.json",
        [an_order("2", "2024-05-15", [CAKE]), an_order("3", "2024-05-15", []), an_order("4", "2024-05-15", None)],
    )
    write_lines(root / "business_day=2024-05-15" / "p2.json", [an_order("2", "2024-05-15", [CAKE], modifiedDate="2024-05-15 10:40:00")])
    return str(root)


def test_sales_orders_all_pages(spark, orders_path):
    df = landed.sales_orders(spark, orders_path)
    assert sorted(r.invoice for r in df.collect()) == ["1", "2", "2", "3", "4"]
    first = df.filter("invoice = '1'").first()
    assert first.branch_code == "S1" and first.status == "CLOSED"
    assert first.delivered_time is None and first.order_time == datetime(2024, 5, 14, 10)
    newest = landed.one_per_key(df, ["invoice"], "delivered_time")
    assert newest.count() == 4 and newest.filter("invoice = '2'").first().delivered_time is not None


def test_day_filter_prunes_partitions(spark, orders_path):
    df = landed.sales_orders(spark, orders_path, days=[date(2024, 5, 14)])
    assert [r.invoice for r in df.collect()] == ["1"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(business_day" in plan and "2024-05-14" in plan
    month = landed.sales_orders(spark, orders_path, between=(date(2024, 5, 15), date(2024, 5, 31)))
    assert month.count() == 4


def test_lines_from_landed_orders(spark, orders_path):
    lines = product.order_lines(landed.sales_orders(spark, orders_path))
    assert lines.count() == 4
    r = lines.filter("invoice = '1'").first()
    assert (r.quantity, float(r.gross), float(r.discount), float(r.net)) == (2.0, 10.5, -1.0, 9.5)
    assert r.order_time == datetime(2024, 5, 14, 10) and r.item_discounts[0].name == "Deal (X)"


def test_sla_from_landed_orders(spark, orders_path, rows):
    stores = rows("branch_code string, store_name string, region string", ("S1", "Store", "KL"))
    df = sla.enrich_day(landed.sales_orders(spark, orders_path), stores, None, date(2024, 5, 15))
    assert {(r.invoice, r.kpt) for r in df.filter("is_ftd").collect()} == {("2", 12.0), ("3", 12.0), ("4", 12.0)}


def test_enveloped_pages(spark, tmp_path):
    root = tmp_path / "events"
    event = {"branchCode": "S1", "eventType": "OUT", "statusType": "DIRECT", "eventDate": "2024-05-15 10:00:00", "itemName": "milk"}
    write_lines(root / "business_day=2024-05-15" / "a.json", [{"data": [event, event]}, {"data": [], "transactions": [event]}])
    write_lines(root / "business_day=2024-05-16" / "b.json", [{"timings": [event]}, {"data": []}])
    df = landed.soldout_events(spark, str(root), enveloped=True)
    assert df.count() == 4
    assert {r.event_day for r in df.collect()} == {date(2024, 5, 15), date(2024, 5, 16)}


def test_no_record_is_lost(spark, tmp_path):
    """Bare lists, other names of a field, and what no reader understands."""
    root = tmp_path / "sales"
    order = lambda n, **names: {k: v for k, v in an_order(str(n), "2024-05-15", []).items() if k not in ("branchCode", "channel")} | names
    write_lines(
        root / "business_day=2024-05-15" / "a.json",
        [
            [order(1, branch="S1", Channel="Zomato"), order(2, storeCode="S2", channel="Swiggy")],
            {"data": [{**order(3), "Store Code": " S3 ", "Channel": "POS", "channel": "other"}]},
            {"payload": [order(4)]},
            {"data": []},
        ],
    )
    (root / "business_day=2024-05-15" / "b.json").write_text("not json\n")
    got = sorted((r.invoice, r.branch_code, r.channel) for r in landed.sales_orders(spark, str(root), enveloped=True).collect())
    assert got == [("1", "S1", "Zomato"), ("2", "S2", "Swiggy"), ("3", "S3", "POS")]
    bad = landed.rejected(spark, str(root)).collect()
    assert sorted(r.value[:9] for r in bad) == ["not json", '{"payload']
    write_lines(tmp_path / "plain" / "business_day=2024-05-15" / "a.json", [order(1, branch="S1"), order(2, branchCode="S2", branch="S9")])
    plain = landed.sales_orders(spark, str(tmp_path / "plain")).collect()
    assert sorted((r.invoice, r.branch_code) for r in plain) == [("1", "S1"), ("2", "S2")]


def test_conflicting_sheet_rows(spark, tmp_path):
    """The pick among rows of one code does not depend on their order, and the code is reported."""
    head, a, b = "Branch Code,Store Name,Region,Ownership,AM Email\n", "S1,Store,KA,COCO,a@x\n", "S1,Store,KA,COCO,b@x\n"
    for i, text in enumerate((head + a + b, head + b + a)):
        path = tmp_path / f"s{i}.csv"
        path.write_text(text)
        assert [r.am_email for r in dimensions.store_dim(spark, str(path)).collect()] == ["a@x"]
        assert [tuple(r) for r in dimensions.store_conflicts(spark, str(path)).collect()] == [("S1", 2)]
    items = tmp_path / "items.csv"
    items.write_text("Item Name,Item Group Name\ncake,Cakes\nCAKE,Other\ntea,Tea\n")
    assert [r.item_key for r in dimensions.item_conflicts(spark, str(items)).collect()] == ["CAKE"]


def test_ledger_from_files(spark, tmp_path, rows):
    root = tmp_path / "ledger"
    item = {"skuCode": "A", "openingBalance": "10", "openingCost": 100, "closingBalance": 8, "closingCost": "80",
            "activities": [{"type": "SALES", "quantity": -2, "cost": -20}, {"type": "Waste", "quantity": 1, "cost": 10}]}
    write_lines(root / "business_day=2024-05-01" / "p.json", [{"branchCode": "S1", **item}])
    stores = rows("branch_code string, store_name string, region string", ("S1", "Store", "KL"))
    days = stock.item_days(landed.item_activity(spark, str(root)), stores)
    r = stock.store_summary(days, date(2024, 5, 1), date(2024, 5, 1)).first()
    assert (r.opening_cost, r.closing_cost, r.sales_cost, r.soh_cost_pct) == (100.0, 80.0, 20.0, 25.0)
    out = str(tmp_path / "csv")
    sinks.ledger_csv(stock.ledger_master(days), out)
    sinks.ledger_csv(stock.ledger_master(days), out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 2 and {r.month for r in back.collect()} == {"2024-05"}


def test_missing_landings(rows):
    stores = rows("branch_code string", ("S1",), ("S2",))
    seen = rows("branch_code string, business_day date", ("S1", date(2024, 5, 1)), ("S2", date(2024, 5, 2)))
    got = sorted(tuple(r) for r in landed.missing_landings(stores, seen, date(2024, 5, 1), date(2024, 5, 2)).collect())
    assert got == [("S1", date(2024, 5, 2)), ("S2", date(2024, 5, 1))]


SHEET = """Branch Code,Store Name,Region,Ownership,AM Email,RM Email,AM Name,CC Mail,,Region
S1,Store 1,Kerala,coco,a@x,b@x,Asha,"c@x, d@x",note,other
S2,Store 2,KA,COCO
S3,Store 3,KA,FOFO,e@x,f@x,Cy,e@x,note,other,surplus,cells
,Blank,KA,COCO,,,,,,
"""


def test_store_sheet(spark, tmp_path):
    path = tmp_path / "stores.csv"
    path.write_text(SHEET)
    assert dimensions.read_sheet(spark, str(path)).columns[8:] == ["blank_col_8", "region_9"]
    got = {r.branch_code: r for r in dimensions.store_dim(spark, str(path)).collect()}
    assert set(got) == {"S1", "S2"}
    assert got["S1"].region == "KL" and got["S1"].cc_mail == "c@x, d@x" and got["S2"].am_email is None
    wide = dimensions.ledger_store_dim(spark, str(path), explicit=["S3"])
    assert sorted(r.branch_code for r in wide.collect()) == ["S1", "S2", "S3"]


def test_sheet_without_required_column(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("Store Name,Region\nS,KA\n")
    with pytest.raises(MissingColumns):
        dimensions.store_dim(spark, str(path))


def test_item_and_listing_sheets(spark, tmp_path):
    items = tmp_path / "items.csv"
    items.write_text("Item Name,Item Group Name,Variant(s),Product Mix,Category Group\n cake ,Cakes,v,Core,Sweet\nCAKE,Cakes,w,Core,Sweet\n")
    assert [r.item_key for r in dimensions.item_dim(spark, str(items)).collect()] == ["CAKE"]
    listings = tmp_path / "listings.csv"
    listings.write_text("S_RID,Z_RID,Brand Name,Store Name,Region,Store Type\n 1 ,2,B,S,KA,Coco\n3,4,B,T,KA,FOFO\n")
    got = dimensions.listing_dim(spark, str(listings)).collect()
    assert [(r.listing_a, r.listing_b, r.store_name) for r in got] == [("1", "2", "S")]


def test_refresh_replaces_only_its_partition(spark, tmp_path, rows):
    path = str(tmp_path / "result")
    sinks.refresh(rows("k int", (1,), (2,)), path, date(2024, 5, 1))
    sinks.refresh(rows("k int", (3,)), path, date(2024, 5, 2))
    sinks.refresh(rows("k int", (9,)), path, date(2024, 5, 1))
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [3, 9]
    sinks.refresh(rows("k int"), path, date(2024, 5, 1))
    assert [r.k for r in spark.read.schema("k int, as_of date").parquet(path).collect()] == [3]
    sinks.refresh(rows("k int", (7,)), str(tmp_path / "plain"))
    sinks.refresh(rows("k int", (8,)), str(tmp_path / "plain"))
    assert [r.k for r in spark.read.parquet(str(tmp_path / "plain")).collect()] == [8]


def test_alert_log(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    assert landed.sent_alerts(spark, path).count() == 0
    key = lambda k, day=1: rows("alert_key string, business_date date", (k, date(2024, 5, day)))
    sinks.append_alerts(key("a", 3), path, "noon")
    sinks.append_alerts(key("b"), path, "evening")
    sinks.append_alerts(key("b"), path, "evening")
    log = landed.sent_alerts(spark, path)
    assert sorted(r.alert_key for r in log.collect()) == ["a", "b"] and log.filter("sent_time is null").count() == 0
    assert [r.alert_key for r in landed.sent_alerts(spark, path, except_run="evening").collect()] == ["a"]
    days = landed.sent_alerts(spark, path, between=(date(2024, 5, 1), date(2024, 5, 2)))
    assert [r.alert_key for r in days.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(business_date" in days._jdf.queryExecution().executedPlan().toString()


def test_sections(spark, tmp_path, rows):
    both = sinks.stacked({"A": rows("x int", (1,)), "B": rows("x int, y string", (2, "t"))})
    assert both.columns == ["section", "x", "y"]
    sinks.write_sections(both.union(both), str(tmp_path / "s"))
    assert len(list((tmp_path / "s").glob("section=A/*.parquet"))) == 1
    assert sorted(p.name for p in (tmp_path / "s").glob("section=*")) == ["section=A", "section=B"]


def test_raw_landing_status(spark, tmp_path, rows):
    one = {"branchCode": "S1", "item": {"n": 1}, "tags": ["x"]}
    odd = [one, [one, {"storeCode": "S2"}], {"data": [], "timings": [{"Store Code": "S3"}]}, {"data": []}]
    write_lines(tmp_path / "snap" / "business_day=2024-05-01" / "a.json", odd)
    snap = landed.snapshot(spark, str(tmp_path / "snap"))
    assert sorted(r.branchCode for r in snap.collect()) == ["S1", "S1", "S2", "S3"]
    r = sinks.raw_landing(snap.filter("branchCode = 'S1'"), "Raw_Snapshot").first()
    assert (json.loads(r.record), r.landing_status) == (one, None)
    empty = sinks.raw_landing(snap.filter(F.lit(False)), "Raw_Snapshot").collect()
    assert len(empty) == 1 and "Raw_Snapshot" in empty[0].landing_status


def test_raw_landing_tables(spark, tmp_path, rows):
    from tillwork.plans import landing

    root, day = tmp_path / "landed", date(2024, 5, 15)
    for table, (dataset, _) in landing.DATASETS.items():
        record = {"branchCode": "S1 ", "itemName": table, "detail": {"n": 1}, "tags": ["a"]}
        if table == "consumption_sales":
            record = an_order("1", "2024-05-15", [CAKE, CAKE])
        write_lines(root / dataset / "business_day=2024-05-15" / "p.json", [record, {**record, "branchCode": "S9"}])
    stores = rows("branch_code string", ("S1",))
    sales = landing.raw_table(spark, str(root), "consumption_sales", day, stores)
    assert sales.count() == 2 and sales.first()["item_discounts"] == '[{"name":"Deal (X)"}]'
    snap = landing.raw_table(spark, str(root), "inventory_store_items", day, stores).first()
    assert (snap.branchCode, json.loads(snap.record)["detail"], snap.landing_status) == ("S1", {"n": 1}, None)
    out = str(tmp_path / "out")
    landing.publish(spark, str(root), out, day, stores, ["outlet_timings", "availability_history"])
    landing.publish(spark, str(root), out, day, stores, ["outlet_timings"])
    assert spark.read.parquet(f"{out}/outlet_timings").count() == 1
