"""Landing: one parse a line, each page once, VARIANT snapshots, counts of a run, data embedded in pages."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillwork import schemas as S
from tillwork.functions.text import embedded_json, embedded_value
from tillwork.operators.observed import observed
from tillwork.sources import keylog, landed, versions
from tillwork.streaming import landing as L

SCHEMA = "k string, v string, at timestamp_ntz, business_date date, batch_id bigint"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def lines(folder, *values):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"p{len(list(folder.iterdir()))}.json").write_text("".join((v if isinstance(v, str) else json.dumps(v)) + "\n" for v in values))


# --- one parse -------------------------------------------------------------


def test_every_form_of_a_line_is_parsed_once(spark, tmp_path):
    day = tmp_path / "o" / "business_day=2024-05-15"
    order = lambda n, **more: {"branchCode": "S1", "invoiceNumber": str(n), **more}
    lines(day, {"data": [order(1, channel="a")]}, [order(2, Channel="b")], {"data": [], "timings": [order(3, Channel="c", channel="d")]}, order(4), "not json", "", "  [", [])
    out = landed.sales_orders(spark, str(tmp_path / "o"), enveloped=True)
    assert {r.invoice: r.channel for r in out.collect()} == {"1": "a", "2": "b", "3": "c"}
    records = landed.sales_orders(spark, str(tmp_path / "o"))
    assert "4" in {r.invoice for r in records.collect()}
    for df in (out, records, landed.soldout_events(spark, str(tmp_path / "o"), enveloped=True)):
        assert plan_of(df).count("from_json") == 1 and "regexp_replace" not in plan_of(df)
    # an empty list is a response without records
    assert sorted(r.value for r in landed.rejected(spark, str(tmp_path / "o")).collect()) == sorted(["  [", "not json", json.dumps(order(4))])


def test_names_that_differ_in_case_stay_apart():
    names = [f.name for f in landed._spelled(S.SALES_ORDER).fields]
    assert "Channel" in names and "channel" in names and len(names) == len(S.SALES_ORDER.fields)


# --- each page once --------------------------------------------------------


def row(k, v="x", day=2, at=10):
    return (k, v, datetime(2024, 5, 2, at), None if day is None else date(2024, 5, day))


def land(rows, table, batch_id, *data):
    return L.write_batch(rows("k string, v string, at timestamp_ntz, business_date date", *data), batch_id, table, SCHEMA, ["k"], "at")


def table_of(spark, table):
    return sorted(((r.k, r.v, r.batch_id) for r in L.landed_table(spark, table, SCHEMA).collect()), key=str)


def test_records_land_once_under_replays_and_compactions(spark, rows, tmp_path):
    table = str(tmp_path / "t")
    assert set(land(rows, table, 0, row("a", "old", at=9), row("a", "new"), row("n", day=None), row(None))) == {date(2024, 5, 2), None}
    first = table_of(spark, table)
    assert first == sorted([("a", "new", 0), ("n", "x", 0), (None, "x", 0)], key=str)
    land(rows, table, 1, row("a", "again", at=12), row("b"), row("n", day=None), row("a", "other day", day=3), row(None))
    second = table_of(spark, table)
    assert second == sorted([*first, ("b", "x", 1), ("a", "other day", 1)], key=str)
    keylog.compact(spark, table, SCHEMA, "batch_id")
    for batch, data in ((1, [row("a", "again", at=12), row("b"), row("n", day=None), row("a", "other day", day=3), row(None)]), (0, [row("a", "new"), row("n", day=None), row(None)])):
        land(rows, table, batch, *data)
        assert table_of(spark, table) == second
    assert land(rows, table, 2) == [] and table_of(spark, table) == second
    only = L.landed_table(spark, table, SCHEMA, [date(2024, 5, 3)])
    assert [r.v for r in only.collect()] == ["other day"]


def test_a_stream_reads_each_file_once(spark, tmp_path):
    root, table, check = (str(tmp_path / p) for p in ("in", "t", "c"))
    event = lambda k: {"branchCode": "S1", "itemName": k, "eventDate": "2024-05-02 10:00:00"}
    day = tmp_path / "in" / "business_day=2024-05-02"
    schema = "item_name string, event_time timestamp_ntz, business_date date, batch_id bigint"

    def run():
        arrived = landed.soldout_events(spark, root, enveloped=True, stream=True)
        records = arrived.select("item_name", "event_time", F.col("event_day").alias("business_date"))
        days = L.land_available(records, table, check, schema, ["item_name"], "event_time")[1]
        return days, sorted((r.item_name, r.batch_id) for r in L.landed_table(spark, table, schema).collect())

    lines(day, {"data": [event("a"), event("b")]}, [event("a")])
    assert run() == ([date(2024, 5, 2)], [("a", 0), ("b", 0)])
    assert run() == ([], [("a", 0), ("b", 0)])
    lines(day, {"data": [event("a"), event("b")]}, [event("c")])
    assert run() == ([date(2024, 5, 2)], [("a", 0), ("b", 0), ("c", 1)])


def test_files_move_with_their_folders(spark, tmp_path):
    lines(tmp_path / "next" / "business_day=2024-05-02", {"data": []})
    lines(tmp_path / "next", "x")
    versions.move_files(spark, str(tmp_path / "next"), str(tmp_path / "in"))
    versions.move_files(spark, str(tmp_path / "next"), str(tmp_path / "in"))
    assert (tmp_path / "in" / "business_day=2024-05-02" / "p0.json").exists() and not (tmp_path / "next").exists()


# --- VARIANT ---------------------------------------------------------------


def test_variants_keep_types_and_show_drift(spark, tmp_path):
    one, two = (tmp_path / "v" / f"business_day=2024-05-0{d}" for d in (1, 2))
    lines(one, {"branchCode": "S1", "qty": 5, "name": "x, y: z", "tags": [1, 2]}, {"branchCode": "S2", "qty": 7})
    lines(two, {"branchCode": "S1", "qty": "5", "nested": {"a": 1, "b": "t"}}, "not json")
    rows = landed.snapshot_variants(spark, str(tmp_path / "v"))
    got = {(str(r.business_day), r.branchCode): r.q for r in rows.select("business_day", "branchCode", F.try_variant_get("record", "$.qty", "bigint").alias("q")).collect()}
    assert got == {("2024-05-01", "S1"): 5, ("2024-05-01", "S2"): 7, ("2024-05-02", "S1"): 5, ("2024-05-02", None): None}
    types = {(r.business_day.day, r.field): r.type for r in landed.field_types(rows, ["business_day"]).collect()}
    assert types[1, "qty"] == "BIGINT" and types[2, "qty"] == "STRING" and types[1, "tags"] == "ARRAY<BIGINT>" and types[2, "nested"].startswith("OBJECT<")
    assert set(types) == {(1, "branchCode"), (1, "name"), (1, "qty"), (1, "tags"), (2, "branchCode"), (2, "qty"), (2, "nested")}
    declared = {"branchCode": "STRING", "qty": "BIGINT", "name": "STRING", "tags": "ARRAY<BIGINT>"}
    drift = landed.drifted(landed.field_types(rows, ["business_day"]), ["business_day"], declared).collect()
    assert sorted((r.business_day.day, r.field, r.declared) for r in drift) == [(2, "nested", None), (2, "qty", "BIGINT")]


# --- counts of a run -------------------------------------------------------


def test_counts_ride_on_the_scan(spark, rows, tmp_path):
    path = str(tmp_path / "x")
    rows("k int, v int", *[(i, i % 3 or None) for i in range(30)]).write.parquet(path)
    df, seen = observed(spark.read.parquet(path), "seen", without_v=F.col("v").isNull(), big=F.col("k") > 27)
    report = df.filter("v is not null").groupBy("v").count()
    assert plan_of(report).count("FileScan") == 1
    report.write.parquet(str(tmp_path / "y"))
    assert seen.get == {"rows": 30, "without_v": 10, "big": 2}
    none, empty = observed(spark.read.parquet(path).filter("k < 0"), "none", any=F.col("k") > 0)
    none.collect()
    assert empty.get == {"rows": 0, "any": 0}


# --- data embedded in pages ------------------------------------------------


@pytest.mark.parametrize(
    ("html", "rating", "name"),
    [
        ('<script type="application/ld+json">{"name":"a \\"b\\" <\\/script>","r":{"v":"4.1"}}</script>', "4.1", 'a "b" </script>'),
        ("<SCRIPT id=x TYPE='application/ld+json' >\n {\"r\": {\"v\": 4.2}, \"name\": \"z\"} </script>", "4.2", "z"),
        ('<script>{"r":{"v":9}}</script> rating 3.5', "3.5", None),
        ('<script type="application/ld+json">{broken</script> rating 3.6', "3.6", None),
        ('<script type="application/ld+json"></script>', None, None),
        (None, None, None),
        ("", None, None),
    ],
)
def test_page_data_by_path_wherever_it_stands(rows, html, rating, name):
    df = rows("html string", (html,)).withColumn("j", embedded_json("html"))
    got = df.select(embedded_value("j", "$.r.v", "html", r"rating ([\d.]+)").alias("r"), F.get_json_object("j", "$.name").alias("n")).first()
    assert (got.r, got.n) == (rating, name)
