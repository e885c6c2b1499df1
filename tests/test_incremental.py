"""What is kept between runs: versions under a pointer, the compacted log, histograms by day, bitmaps, windows and scopes."""

from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillwork.catalog import incremental as C
from tillwork.operators.distinct import day_bitmaps, distinct_count, merged, numbered
from tillwork.operators.joins import in_windows
from tillwork.operators.metrics import scoped_totals
from tillwork.plans import sla as P
from tillwork.plans import sla_days as D
from tillwork.sources import keylog, landed, sinks, versions
from tillwork.streaming import alerts as A

KV = "k int, v string"
ALERT = (
    "alert_key string, store_name string, item_name string, business_date date, event_time timestamp_ntz, "
    "user_name string, category_name string, item_type string, branch_code string"
)


def data_files(path: str) -> int:
    return sum(f.startswith("part-") for _, _, files in os.walk(path) for f in files)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- versions under a pointer ----------------------------------------------


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_readers_see_the_old_table_while_a_refresh_fails(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert versions.published(spark, path, KV).collect() == []
    versions.publish(rows(KV, (1, "a"), (2, "b")), path)
    before = versions.published(spark, path, KV)
    broken = rows(KV, (3, "c")).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        versions.publish(broken, path)
    assert values(versions.published(spark, path, KV)) == values(before) == [(1, "a"), (2, "b")]
    versions.publish(rows(KV, (4, "d")), path)
    # a reader that began before goes on with its version until that is dropped
    assert values(before) == [(1, "a"), (2, "b")] and values(versions.published(spark, path, KV)) == [(4, "d")]
    assert len(versions.drop_unused(spark, path)) == 2
    assert values(versions.published(spark, path, KV)) == [(4, "d")]
    versions.publish(rows(KV), path)
    assert versions.published(spark, path, KV).collect() == []


def test_of_two_writers_one_wins(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    seen = versions.pointer(spark, path)
    mine, other = (versions.write_version(rows(KV, (k, "x")), path) for k in (1, 2))
    versions.swap(spark, path, seen, {versions.WHOLE: mine})
    with pytest.raises(versions.Superseded):
        versions.swap(spark, path, seen, {versions.WHOLE: other})
    assert values(versions.published(spark, path, KV)) == [(1, "x")]
    assert not [f for f in os.listdir(f"{path}/_pointers") if "json" not in f]


def test_days_are_replaced_apart(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, day date"
    one, two = date(2024, 5, 1), date(2024, 5, 2)
    versions.publish_days(rows(schema, (1, one), (2, two), (3, None)), path, "day", [one, two, None])
    versions.publish_days(rows(schema, (4, two)), path, "day", [two])
    assert values(versions.published_days(spark, path, schema, "day")) == [(1, one), (3, None), (4, two)]
    versions.publish_days(rows(schema), path, "day", [one])
    assert values(versions.published_days(spark, path, schema, "day")) == [(3, None), (4, two)]
    assert values(versions.published_days(spark, path, schema, "day", [one, None])) == [(3, None)]
    versions.drop_unused(spark, path)
    assert values(versions.published_days(spark, path, schema, "day", [two])) == [(4, two)]


# --- the log ---------------------------------------------------------------


def alert(key, day=2):
    when = None if day is None else date(2024, 5, day)
    return (key, "S", "i", when, datetime(2024, 5, 2), "u", "c", "t", "b")


def keys_of(spark, log):
    return sorted((r.alert_key, r.batch_id) for r in A.sent_log(spark, log).collect())


def test_compaction_lessens_files_and_no_key(spark, rows, tmp_path):
    log = str(tmp_path / "log")
    for k in range(6):
        A.write_batch(rows(ALERT, alert(f"k{k}"), alert("k0"), alert(f"n{k}", None), alert(f"d{k}", 3 + k)), k, log)
    before, files = keys_of(spark, log), data_files(log)
    assert set(A.compact_log(spark, log)) == {date(2024, 5, 2), None}
    assert keys_of(spark, log) == before
    assert A.drop_merged(spark, log) == 12
    assert keys_of(spark, log) == before and data_files(log) <= files - 10
    assert A.compact_log(spark, log) == []


@pytest.mark.parametrize("dropped", [False, True])
def test_replays_after_a_compaction_change_nothing(spark, rows, tmp_path, dropped):
    log = str(tmp_path / "log")
    batches = [[alert("a"), alert("b", None)], [alert("a"), alert("c"), alert("b", None), alert("e", None)], [alert("c"), alert("d")]]
    for k, batch in enumerate(batches[:2]):
        A.write_batch(rows(ALERT, *batch), k, log)
    A.compact_log(spark, log)
    if dropped:
        A.drop_merged(spark, log)
    want = [("a", 0), ("b", 0), ("c", 1), ("e", 1)]
    for k in (0, 1, 0):
        A.write_batch(rows(ALERT, *batches[k]), k, log)
        assert keys_of(spark, log) == want
    A.write_batch(rows(ALERT, *batches[2]), 2, log)
    A.compact_log(spark, log, least=1)
    A.write_batch(rows(ALERT, *batches[2]), 2, log)
    assert keys_of(spark, log) == [*want[:3], ("d", 2), want[3]]


def test_a_failed_compaction_leaves_the_log(spark, rows, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    for k in range(3):
        A.write_batch(rows(ALERT, alert(f"k{k}")), k, log)
    monkeypatch.setattr(versions, "swap", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        A.compact_log(spark, log)
    monkeypatch.undo()
    assert keys_of(spark, log) == [(f"k{k}", k) for k in range(3)]
    A.compact_log(spark, log)
    A.drop_merged(spark, log)
    assert keys_of(spark, log) == [(f"k{k}", k) for k in range(3)]


def test_a_batch_of_null_and_old_days_alerts_once(spark, rows, tmp_path):
    """Events without a business day are sent once; one year-old event opens one old day, not the year between."""
    log = str(tmp_path / "log")
    A.write_batch(rows(ALERT, alert("n", None)), 0, log)
    A.write_batch(rows(ALERT, alert("n", None), alert("m", None)), 1, log)
    assert keys_of(spark, log) == [("m", 1), ("n", 0)]
    old = ("o", "S", "i", date(2023, 5, 2), datetime(2023, 5, 2), "u", "c", "t", "b")
    A.write_batch(rows(ALERT, old, alert("p", 9)), 2, log)
    A.write_batch(rows(ALERT, alert("q", 5)), 3, log)
    days = keylog.days_of(rows(ALERT, old, alert("p", 9)), "business_date")
    read = keylog.read(spark, log, A.LOG_SCHEMA, "batch_id", days)
    assert {r.alert_key for r in read.collect()} == {"o", "p"}
    assert "2023-05-02" in plan_of(read) and "PartitionFilters" in plan_of(read)
    A.write_batch(rows(ALERT), 4, log)
    assert len(keys_of(spark, log)) == 5


def test_run_log_with_names_that_need_escapes(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    key = lambda k, day: rows("alert_key string, business_date date", (k, day))
    for run, k in (("noon 12:00", "a"), ("eve=1", "b"), ("x", "c")):
        sinks.append_alerts(key(k, None if k == "c" else date(2024, 5, 1)), path, run.replace(":", "%3A").replace("=", "%3D"))
    assert sinks.compact_alerts(spark, path) == [date(2024, 5, 1)]
    sinks.drop_merged_alerts(spark, path)
    assert sorted(r.alert_key for r in landed.sent_alerts(spark, path).collect()) == ["a", "b", "c"]
    assert [r.alert_key for r in landed.sent_alerts(spark, path, days=[None]).collect()] == ["c"]
    assert [r.alert_key for r in landed.sent_alerts(spark, path, except_run="x", days=[None, date(2024, 5, 1)]).orderBy("alert_key").collect()] == ["a", "b"]


# --- histograms by day -----------------------------------------------------

ORDER = "branch_code string, invoice int, channel string, invoice_day date, order_time timestamp_ntz, ready_time timestamp_ntz, delivered_time timestamp_ntz"


def order(invoice, day, minutes, branch="1"):
    at = datetime(2024, 5, day, 12)
    return (branch, invoice, "Swiggy A", at.date(), at, at.replace(minute=minutes), at.replace(minute=minutes + 9))


@pytest.fixture
def shops(rows):
    return rows("branch_code string, store_name string, region string", ("1", "one", "KA"), ("2", "two", None))


def test_days_apart_give_the_month(spark, rows, shops, tmp_path):
    path = str(tmp_path / "h")
    data = [order(i, 1 + i % 7, (i * 7) % 40, "12"[i % 2]) for i in range(90)]
    orders = rows(ORDER, *data)
    day, days = date(2024, 5, 7), [date(2024, 5, d) for d in range(1, 8)]
    D.refresh_days(D.enrich_days(orders.filter("invoice < 50"), shops, None, days), path, days)
    late = [date(2024, 5, 3), day]
    for d in days:
        rest = orders if d in late else orders.filter("invoice < 50")
        D.refresh_days(D.enrich_days(rest, shops, None, [d]), path, [d])
    kept = orders.filter((F.col("invoice") < 50) | F.col("invoice_day").isin(late))
    whole = P.enrich_day(kept, shops, None, day)
    merged_days = D.month_to_date(spark, path, day)
    for report in (P.matrix, P.region_matrix, P.store_table, P.headline):
        assert values(report(merged_days)) == values(report(whole)), report
    # the sixth day loses all its orders
    D.refresh_days(D.enrich_days(orders.filter("false"), shops, None, [days[5]]), path, [days[5]])
    assert values(P.matrix(D.month_to_date(spark, path, day))) == values(P.matrix(P.enrich_day(kept.filter(F.col("invoice_day") != days[5]), shops, None, day)))


def test_a_rerun_scans_its_days_only(spark, rows, shops, tmp_path):
    source, path = str(tmp_path / "orders"), str(tmp_path / "h")
    rows(ORDER, *[order(i, 1 + i % 7, i % 40) for i in range(40)]).write.partitionBy("invoice_day").parquet(source)
    one = [date(2024, 5, 4)]
    sla = D.enrich_days(spark.read.schema(ORDER).parquet(source), shops, None, one)
    text = plan_of(D.day_histograms(sla))
    assert "PartitionFilters: [isnotnull(invoice_day" in text and "2024-05-04" in text and "2024-05-05" not in text
    D.refresh_days(sla, path, one)
    D.refresh_days(sla, path, [date(2024, 5, 9)])  # no such rows: the day is empty
    assert D.between_days(spark, path, one, F.lit(True)).inputFiles() == versions.published_days(spark, path, D.SCHEMA, D.DAY).inputFiles()


# --- distinct counts that merge --------------------------------------------


def test_numbers_are_dense_within_a_day(rows):
    data = [(d, i % 300) for d in (1, 2, None) for i in range(1000)] + [(3, None)]
    out = numbered(rows("day int, v int", *data).repartition(5), "v", "day").collect()
    for d in (1, 2, None):
        assert sorted(r.number for r in out if r.day == d) == list(range(1, 301))
    assert len(out) == 900


def test_bitmaps_merge_over_days_and_keys(rows):
    data = [("ab"[i % 2], "xyz"[i % 3], i % 5, (i * i) % 70_000) for i in range(4000)]
    df = rows("a string, b string, day int, v int", *data)
    bits = day_bitmaps(df.withColumn("n", F.col("v") + 1), ["a", "b"], "day", "n")
    assert bits.filter("bucket > 1").count() > 0  # beyond one bitmap
    count = lambda *keys: {tuple(r)[:-1]: r[-1] for r in distinct_count(bits, keys, "day", "c").collect()}
    for keys in ((), ("a",), ("a", "b")):
        want: dict = {}
        for a, b, day, v in data:
            want.setdefault(tuple({"a": a, "b": b}[k] for k in keys), set()).add((day, v))
        assert count(*keys) == {k: len(s) for k, s in want.items()}
    again = merged(merged(bits, ["a"], "day"), [], "day")
    assert distinct_count(again, [], "day", "c").first().c == len({x[2:] for x in data})
    assert "partial_bitmap_construct_agg" in plan_of(bits)


# --- scopes and windows ----------------------------------------------------


def test_scopes_tell_missing_keys_from_totals(rows):
    df = rows("r string, c string, n int", ("KA", "x", 1), (None, "x", 2), ("KA", None, 4), (None, None, 8))
    out = {(r.scope, r.r, r.c): r.n for r in scoped_totals(df, ["r", "c"], [["r", "c"], ["r"], []], F.sum("n").alias("n")).collect()}
    assert out == {
        ("r+c", "KA", "x"): 1, ("r+c", None, "x"): 2, ("r+c", "KA", None): 4, ("r+c", None, None): 8,
        ("r", "KA", None): 5, ("r", None, None): 10, ("all", None, None): 15,
    }
    assert scoped_totals(df.filter("false"), ["r"], [["r"]], F.sum("n").alias("n")).collect() == []


def test_overlapping_windows(rows):
    at = lambda d, h=0, m=0: datetime(2024, 5, d, h, m)
    orders = rows("k int, ts timestamp_ntz, start int, `a.b` int", *[(i, at(1 + i // 4, (i % 4) * 6), 7, 8) for i in range(40)], (99, None, 7, 8))
    spans = [("a", at(2, 6), at(4, 6)), ("b", at(3), at(3)), ("c", at(4, 6), at(4, 5)), (None, at(1), at(9)), ("d", at(1), None), ("e", at(1), at(11)), ("e", at(2), at(2, 1))]
    windows = rows("period string, start timestamp_ntz, end timestamp_ntz", *spans)
    hit = in_windows(orders, "ts", windows)
    got = sorted((r.k, r.period) for r in hit.collect())
    want = sorted((i, n) for i in range(40) for n, a, b in spans if n and a and b and a <= at(1 + i // 4, (i % 4) * 6) <= b)
    assert got == want and set(hit.columns) == {"k", "ts", "start", "a.b", "period"}
    text = plan_of(hit)
    assert "Cartesian" not in text and "NestedLoop" not in text and "HashJoin" in text


def test_windows_that_are_many_are_not_broadcast(rows, monkeypatch):
    from tillwork.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_SOURCE_BYTES", 1)
    windows = rows("period string, start timestamp_ntz, end timestamp_ntz", ("a", datetime(2024, 5, 1), datetime(2024, 5, 3)))
    orders = rows("k int, ts timestamp_ntz", (1, datetime(2024, 5, 2)), (2, datetime(2024, 5, 4)))
    hit = in_windows(orders, "ts", windows)
    assert [r.k for r in hit.collect()] == [1]


def test_running_hour_has_three_windows(spark):
    assert {r.period for r in C.running_hour(spark, "/root/testdata/sf0.01").collect()} == {"CURRENT", "LW", "L2W"}
