"""Reports on hand-made rows that hold the edge cases."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillwork.functions.time import Period
from tillwork.plans import product, ratings, sla, soldout, stock
from tillwork.sources.dimensions import clean_items, company_stores, ledger_stores

SHEET = (
    "branch_code string, store_name string, region string, ownership string, am_email string, rm_email string, "
    "am_name string, cc_mail string"
)


@pytest.fixture
def sheet(rows):
    return rows(
        SHEET,
        ("S1", "Store 1", "Kerala", " coco ", "a@x, b@x", "b@x,, ", "Asha", "c@x, ,d@x"),
        ("S1", "Store 1 again", "Kerala", "COCO", "a@x", "b@x", "Asha", "c@x"),
        ("S2", "Store 2", "ka", "Coco", None, " ", "Bo", "d@x"),
        ("S3", "Store 3", "KARNATAKA", "FOFO", "e@x", "f@x", "Cy", "e@x"),
        ("#N/A", "Ghost", "KA", "COCO", None, None, None, None),
        ("", "Blank", "KA", "COCO", None, None, None, None),
        ("W1", "Depot", "TN", "Warehouse", None, None, None, None),
        ("DW", "Dark", "MH", None, None, None, None, None),
    )


@pytest.fixture
def stores(sheet):
    return company_stores(sheet)


def test_company_stores(stores):
    got = sorted((r.branch_code, r.store_name, r.region) for r in stores.collect())
    assert got == [("S1", "Store 1", "KL"), ("S2", "Store 2", "KA")]


def test_ledger_stores(sheet):
    assert sorted(r.branch_code for r in ledger_stores(sheet, ["DW"]).collect()) == ["DW", "S1", "S2", "W1"]


# --- product ---------------------------------------------------------------

DAY = datetime(2024, 5, 15)
PERIODS = [
    Period("CURRENT", DAY.replace(hour=9), DAY.replace(hour=18)),
    Period("LW", datetime(2024, 5, 8, 9), datetime(2024, 5, 8, 18)),
    Period("L2W", datetime(2024, 5, 1, 9), datetime(2024, 5, 1, 18)),
]
LINE = (
    "branch_code string, brand string, invoice string, channel string, status string, order_time timestamp_ntz, "
    "item_name string, quantity double, gross double, discount double, net double, "
    "discounts array<struct<name:string>>, item_discounts array<struct<name:string>>"
)


def line(invoice, day=15, hour=10, item="cake", status="Closed", gross=100.0, disc=-10.0, branch="S1", minute=0, channel="Zomato X"):
    codes = [("Merchant Voucher Code (NEW)",), ("Second (X)",)]
    return (
        branch, "B", invoice, channel, status, datetime(2024, 5, day, hour, minute), item, 1.0, gross, disc,
        gross + disc, codes, None,
    )


@pytest.fixture
def items(rows):
    dim = rows(
        "item_key string, item_group string, variant string, product_mix string, category_group string",
        (" Cake", "Cakes", "v", "Core", "Sweet"),
        ("CAKE ", "Cakes", "w", "Core", "Other"),
        ("dip", "Dips", "v", "addons", "Sauce"),
        ("pie", "Pies", "v", None, "Sweet"),
    )
    return clean_items(dim)


@pytest.fixture
def mart(rows, stores, items):
    data = rows(
        LINE,
        line("1"),
        line("1", item=" cake "),
        line("2", item="pie", gross=0.0, disc=0.0),
        line("3", item="dip"),
        line("4", item="unknown"),
        line("5", status="OPEN"),
        line("6", status="voided"),
        line("7", hour=8, minute=59),
        line("8", hour=18),
        line("9", hour=18, minute=1),
        line("10", day=8),
        line("11", day=1),
        line("12", day=1, status="open"),
        line("13", branch="S3"),
        line("14", day=1, item="dip"),
    )
    return product.sales_line_mart(data, stores, items, PERIODS)


def test_mart_filters_every_period_alike(mart):
    got = sorted((r.period, r.invoice, r.item_group) for r in mart.collect())
    assert got == [
        ("CURRENT", "1", "Cakes"),
        ("CURRENT", "1", "Cakes"),
        ("CURRENT", "2", "Pies"),
        ("CURRENT", "4", None),
        ("CURRENT", "8", "Cakes"),
        ("L2W", "11", "Cakes"),
        ("LW", "10", "Cakes"),
    ]
    first = mart.filter("invoice = '1'").first()
    assert (first.discount, first.voucher_code, first.bracket_code, first.region) == (10.0, "NEW", "No Offer", "KL")


def test_category_compare(mart):
    got = {r.category_group: r for r in product.category_compare(mart).collect()}
    assert set(got) == {"Sweet"}
    r = got["Sweet"]
    assert (r.today_orders, r.lw_orders, r.l2w_orders) == (3, 1, 1)
    assert (r.today_dis_pct, r.today_growth_pct, r.lw_growth_pct) == (10.0, 200.0, 0.0)


def test_offer_performance(mart):
    got = product.offer_performance(mart, "voucher_code", "zomato").collect()
    assert [(r.code, r.orders, r.lw_orders, r.dis_pct) for r in got] == [("NEW", 4, 1, 10.0)]
    assert product.offer_performance(mart, "bracket_code", "Swiggy").count() == 0
    by_net = product.offer_performance(mart, "voucher_code", "zomato", denominator="net").first()
    assert by_net.dis_pct == 11.1


def test_order_status_counts(rows, stores, items):
    data = rows(LINE, line("1", status="open"), line("1", status="OPEN"), line("2", status="Voided"), line("3"))
    base = product.line_base(data, stores, items, PERIODS)
    assert tuple(product.order_status_counts(base).first()) == (1, 1)


# --- SLA -------------------------------------------------------------------

SLA = (
    "branch_code string, invoice string, channel string, invoice_day date, order_time timestamp_ntz, "
    "ready_time timestamp_ntz, delivered_time timestamp_ntz, category_name string, item_name string"
)


def order(invoice, ready, delivered, day=15, channel="Zomato A", branch="S1", cat="C", item="I"):
    t = datetime(2024, 5, day, 12)
    at = lambda m: None if m is None else datetime.fromtimestamp(t.timestamp() + m * 60)
    return (branch, invoice, channel, date(2024, 5, day), t, at(ready), at(delivered), cat, item)


@pytest.fixture
def enriched(rows, stores):
    data = rows(
        SLA,
        order("1", 12, 30),
        order("2", -5, None),
        order("3", None, 40),
        order("4", 20, 50, channel="Swiggy B"),
        order("5", 10, 20, channel="Phone"),
        order("6", 15, 35, day=2),
        order("7", 15, 35, branch="S3"),
        order("8", 99, 99, day=16),
        order("9", 11, 36, branch="S2", day=3),
    )
    return sla.enrich_day(data, stores, ["Zomato A", "Swiggy B"], date(2024, 5, 15))


def test_enrich_clips_and_drops(enriched):
    got = {r.invoice: (r.kpt, r.o2d, r.is_ftd) for r in enriched.collect()}
    assert got == {
        "1": (12.0, 30.0, True),
        "2": (0.0, None, True),
        "4": (20.0, 50.0, True),
        "6": (15.0, 35.0, False),
        "9": (11.0, 36.0, False),
    }


def test_matrix(enriched):
    got = {r.parameter: r for r in sla.matrix(enriched).collect()}
    assert len(got) == 9
    assert (got["Orders"]["FTD Zomato"], got["Orders"]["FTD Overall"], got["Orders"]["MTD Overall"]) == (2.0, 3.0, 5.0)
    assert got["Breached Orders KPT"]["FTD Overall"] == 1.0
    assert got["Breached Orders O2D"]["MTD Zomato"] == 2.0
    assert got["KPT"]["FTD Overall"] == 10.7


def test_region_matrix_needs_reported_orders(enriched):
    assert {r.region for r in sla.region_matrix(enriched).collect()} == {"KL"}


def test_headline(enriched):
    got = {r.metric: r.value for r in sla.headline(enriched).collect()}
    assert got == {
        "Swiggy Avg KPT": 20.0,
        "Zomato Avg KPT": 6.0,
        "Overall Avg KPT": 10.7,
        "Overall Avg O2D": 40.0,
        "Total Orders": 3.0,
    }


def test_store_table(enriched):
    got = {(r.region, r.aggregator): (r.store_name, r.ftd_orders, r.mtd_orders) for r in sla.store_table(enriched).collect()}
    assert got == {("KL", "Zomato"): ("Store 1", 2, 3), ("KL", "Swiggy"): ("Store 1", 1, 1)}


def test_category_table_counts_invoices_item_table_lines(rows, stores):
    data = rows(SLA, order("1", 10, 20, item="a"), order("1", 10, 20, item="b"), order("2", 14, None, item="a"), order("3", 5, 5, day=1, cat=None))
    lines = sla.enrich_day(data, stores, None, date(2024, 5, 15))
    cat = sla.category_table(lines).collect()
    assert [(r.category_name, r.ftd_orders, r.mtd_orders, r.ftd_o2d_p80) for r in cat] == [("C", 2, 2, 20.0)]
    item = {r.item_name: r.ftd_orders for r in sla.item_table(lines).filter("ftd_orders > 0").collect()}
    assert item == {"a": 2, "b": 1}


def test_root_causes_and_all_clear(rows, stores):
    slow = [order(str(i), 20, 20, item="slow") for i in range(4)]
    late = [order(str(10 + i), 5, 60, item="late", cat="L") for i in range(5)]
    few = [order("20", 50, 50, item="few", cat="F", day=15)]
    lines = sla.enrich_day(rows(SLA, *slow, *late, *few), stores, None, date(2024, 5, 15))
    flags = sla.in_report_order(sla.root_causes(lines)).collect()
    assert [(r.scope, r.type, r.element, r.issue) for r in flags if r.scope == "Overall"] == [
        ("Overall", "Category", "L", "Logistics Delay (O2D)"),
        ("Overall", "Category", "C", "High Prep Time (KPT)"),
        ("Overall", "Category", "F", "High Prep Time (KPT)"),
        ("Overall", "Item", "late", "Logistics Delay (O2D)"),
    ]
    assert {(r.type, r.element) for r in flags if r.scope == "Region: KL"} == {
        ("Category", "L"), ("Category", "C"), ("Category", "F"), ("Item", "late"), ("Item", "slow"),
    }
    clear = sla.with_all_clear(sla.root_causes(lines).filter("orders > 1000"))
    assert clear.columns == list(sla.FLAG_COLUMNS) and [r.type for r in clear.collect()] == ["Status Log"]
    assert sla.with_all_clear(sla.root_causes(lines)).count() == len(flags)


# --- stock -----------------------------------------------------------------

LEDGER = (
    "branch_code string, activity_date date, sku_code string, opening_qty string, opening_cost string, "
    "closing_qty string, closing_cost string, activities array<struct<type:string,quantity:string,cost:string>>"
)
FIRST, LAST = date(2024, 5, 1), date(2024, 5, 3)


@pytest.fixture
def days(rows, stores):
    data = rows(
        LEDGER,
        ("S1", FIRST, "A", "10", "100", "8", "80", [("Sales", "-2", "-20"), ("SALES", "1", "10"), ("Waste", "5", "50")]),
        ("S1", FIRST, "B", "bad", None, "1", "10", []),
        ("S1", FIRST, "C", "999", "999", "999", "999", None),
        ("S1", LAST, "A", "8", "80", "4", "40", [("sales ", "-4", "-40")]),
        ("S2", date(2024, 5, 2), "A", "5", "50", "0", "0", [("Waste", "1", "10")]),
        ("S3", LAST, "A", "1", "1", "1", "1", [("Sales", "1", "1")]),
    )
    return stock.item_days(data, stores)


def test_ledger_master(days):
    out = stock.ledger_master(days)
    assert out.columns[:4] == ["branch_code", "store_name", "region", "activity_date"]
    got = sorted((r.branch_code, r.sku_code, r.activity_type or "", float(r.activity_quantity)) for r in out.collect())
    assert got == [
        ("S1", "A", "SALES", 1.0),
        ("S1", "A", "Sales", 2.0),
        ("S1", "A", "Waste", 5.0),
        ("S1", "A", "sales ", 4.0),
        ("S1", "B", "", 0.0),
        ("S2", "A", "Waste", 1.0),
    ]


def test_balances_are_summed_once_per_item_day(days):
    got = {r.store_name: r for r in stock.store_summary(days, FIRST, LAST).collect()}
    assert set(got) == {"Store 1"}
    r = got["Store 1"]
    assert (r.opening_cost, r.opening_qty, r.closing_cost, r.closing_qty) == (100.0, 10.0, 40.0, 4.0)
    assert (r.sales_cost, r.soh_cost_pct, r.soh_qty_pct) == (70.0, 175.0, 175.0)
    shown = stock.store_display(stock.store_summary(days, FIRST, LAST)).first()
    assert shown.soh_cost_pct == "175.0%"


def test_region_ratio_is_ratio_of_sums(days):
    r = stock.region_summary(days, FIRST, LAST).filter("region = 'KL'").first()
    assert r.soh_cost_pct == r.sales_cost / r.closing_cost * 100


def test_daily_matrix(days):
    dates = [FIRST, date(2024, 5, 2), LAST]
    got = {r.store_name: tuple(r)[2:] for r in stock.daily_matrix(days, dates).collect()}
    assert got == {"Store 1": (33.33, 0.0, 100.0), "Store 2": (0.0, 0.0, 0.0)}


def test_movement_union(rows):
    schema = "branchCode string, skuCode string, quantity string, items array<struct<skuCode:string,quantity:string>>"
    transfers = rows(schema, ("S1", "A", "1", None), ("S1", None, None, [("B", "2"), (None, "3")]))
    receipts = rows(schema, ("S1", "C", "1", [("Z", "1")]))
    held = rows("skuCode string, quantity string", ("A", "5"), ("B", "6"), ("Z", "7"))
    out = stock.movement_union(transfers, receipts, held, "feed")
    assert sorted(r.skuCode for r in out.filter("kind = 'stock'").collect()) == ["A", "B"]
    assert out.filter("source = 'feed' and fetched_at is not null").count() == 5
    none = transfers.filter("quantity = 'x'")
    assert stock.movement_union(none, none, held, "feed").count() == 3


# --- sold out --------------------------------------------------------------

EVENT = (
    "branch_code string, event_type string, status_type string, event_day date, event_time timestamp_ntz, "
    "item_type string, category_name string, item_name string, user_name string"
)


def event(branch="S1", item="milk", day=2, hour=10, kind="Material", etype="out", status="direct", cat="Dairy"):
    return (branch, etype, status, date(2024, 5, day), datetime(2024, 5, day, hour), kind, cat, item, "u")


@pytest.fixture
def base(rows, stores):
    data = rows(
        EVENT,
        event(),
        event(hour=9),
        event(day=3),
        event("S2", "tea", kind="PRODUCT"),
        event("S9", "oil"),
        event(etype="IN"),
        event(status="Timed"),
    )
    return soldout.soldout_base(data, stores)


def test_soldout_base(base):
    # no row without a store: S9 is not on the sheet
    assert base.columns == list(soldout.BASE_COLUMNS) and base.count() == 4
    assert base.filter("store_name is null").count() == 0


def test_pivots(base):
    got = sorted(tuple(r) for r in soldout.material_by_region(base).collect())
    assert got == [("milk", 0, 0, 0, 3)]
    shown = soldout.dashed(soldout.material_by_region(base), soldout.REGIONS)
    assert sorted(tuple(r) for r in shown.collect())[0] == ("milk", "-", "-", "-", "3")
    assert [tuple(r) for r in soldout.category_by_region(base).collect()] == [("Dairy", 1, 0, 0, 0)]
    assert {tuple(r) for r in soldout.category_by_store(base).collect()} == {("Store 1", "Dairy", 3), ("Store 2", "Dairy", 1)}


def test_alerts_once(base, rows):
    sent = rows("alert_key string", ("Store 1|milk|2024-05-03",))
    alerts = soldout.new_alerts(base, sent)
    got = sorted((r.alert_key, r.event_time.hour) for r in alerts.collect())
    assert got == [("Store 1|milk|2024-05-02", 9), ("Store 2|tea|2024-05-02", 10)]
    packets = soldout.alert_packets(alerts)
    assert [(r.store_name, r.part, r.recipients, len(r["items"])) for r in packets.collect()] == [("Store 1", 1, ["a@x", "b@x"], 1)]
    logged = soldout.sent_keys(alerts, packets)
    assert [r.alert_key for r in logged.collect()] == ["Store 1|milk|2024-05-02"]
    assert [str(r.business_date) for r in logged.collect()] == ["2024-05-02"]
    again = soldout.new_alerts(base, sent.unionByName(logged.select("alert_key")))
    assert [r.alert_key for r in again.collect()] == ["Store 2|tea|2024-05-02"]


def test_alert_run_can_be_repeated(rows, stores, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    noon = rows(EVENT, event(), event(item="tea"))
    first = sorted(p["items"][0].item_name for p in soldout.alert_run(noon, stores, log, out, "noon").collect())
    assert first == ["milk"]
    again = soldout.alert_run(noon, stores, log, out, "noon").collect()
    assert [len(p["items"]) for p in again] == [2]
    evening = rows(EVENT, event(), event(item="tea"), event(item="oil"))
    late = soldout.alert_run(evening, stores, log, out, "evening").collect()
    assert [[i.item_name for i in p["items"]] for p in late] == [["oil"]]


def test_packets_of_a_hot_store_are_split(rows, stores):
    data = rows(EVENT, *[event(item=f"i{n}") for n in range(300)])
    alerts = soldout.new_alerts(soldout.soldout_base(data, stores), rows("alert_key string", ("x",)))
    packets = soldout.alert_packets(alerts, part_rows=20).collect()
    sizes = [len(p["items"]) for p in packets]
    assert sum(sizes) == 300 and len(sizes) == 15 and max(sizes) < 60
    assert {p.n_items for p in packets} == {300}


def test_summary_recipients(stores):
    got = {r.address for r in soldout.summary_recipients(stores, ["z@x", "d@x"]).collect()}
    assert got == {"c@x", "d@x", "z@x"}


# --- ratings ---------------------------------------------------------------


def test_one_row_per_listing(rows):
    listings = rows(
        "listing_a string, listing_b string, brand string, store_name string, region string",
        ("1", "11", "B", "S1", "KA"),
        ("2", "", "B", "S2", "KA"),
    )
    at = lambda day: datetime(2024, 5, day)
    pages = rows(
        "url string, html string, fetched_at timestamp",
        ("https://www.swiggy.com/restaurants/1?x", '"avgRating":"4.2" "totalRatingsString":"2K"', at(2)),
        ("https://www.swiggy.com/restaurants/1", '"avgRating":"1.0" "totalRatingsString":"1K"', at(1)),
        ("https://www.swiggy.com/restaurants/1", '"avgRating":"9.9"', None),
        ("https://www.zomato.com/r/11", '"ratingV2":"3.5","reviewCount":"77" Temporarily CLOSED', at(1)),
        ("https://www.zomato.com/r/1", '"ratingV2":"0.5"', at(3)),
        ("https://elsewhere.example/r/2", '"avgRating":"0.1"', at(3)),
        (None, None, None),
    )
    got = {r.store_name: tuple(r)[3:] for r in ratings.listing_ratings(listings, pages).collect()}
    assert got == {
        "S1": (4.2, 3.5, "2K", "77", "Online", "Offline"),
        "S2": (None, None, None, None, None, None),
    }


def test_stacked_growth_bands(mart):
    bands = product.growth_bands(product.category_compare(mart))
    assert [(r.today_band, r.lw_band) for r in bands.collect()] == [("positive", "positive")]
    assert product.top_items(product.item_compare(mart), 1).select(F.col("item_group")).first()[0] == "Cakes"


def test_allowed_channels_are_aggregators_of_the_brands():
    assert sla.allowed_channels(["B1", "B2"]) == ["Swiggy B1", "Swiggy B2", "Zomato B1", "Zomato B2"]
