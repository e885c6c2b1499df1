"""The alert stream over several drops, with repeats, late rows, a restart and a replayed batch."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillwork.session import scratch_dir
from tillwork.sources.dimensions import company_stores
from tillwork.streaming import alerts as A

EVENT = (
    "branch_code string, event_type string, status_type string, event_day date, event_time timestamp_ntz, "
    "item_type string, category_name string, item_name string, user_name string"
)


def event(item, day, hour=10, branch="S1", status="DIRECT"):
    return (branch, "OUT", status, date(2024, 5, day), datetime(2024, 5, day, hour), "MATERIAL", "C", item, "u")


@pytest.fixture
def stores(rows):
    schema = (
        "branch_code string, store_name string, region string, ownership string, am_email string, rm_email string, "
        "am_name string, cc_mail string"
    )
    return company_stores(rows(schema, ("S1", "Store 1", "KA", "COCO", "a@x", "b@x", "Asha", "c@x")))


@pytest.mark.parametrize("as_folder", [False, True])
def test_stream_of_a_file_and_of_part_files(spark, stores, tmp_path, as_folder):
    path, log = str(tmp_path / "events.parquet"), str(tmp_path / "log")
    df = spark.createDataFrame([event("milk", 2), event("tea", 3), event("milk", 2, 8)], EVENT)
    if as_folder:
        df.repartition(3).write.parquet(path)
    else:
        df.toPandas().to_parquet(path, coerce_timestamps="us")
    A.run_available(A.alert_stream(A.landed_stream(spark, EVENT, path), stores), log, str(tmp_path / "check"))
    sent = {r.alert_key: r.event_time for r in A.sent_log(spark, log).collect()}
    assert sent == {"Store 1|milk|2024-05-02": datetime(2024, 5, 2, 8), "Store 1|tea|2024-05-03": datetime(2024, 5, 3, 10)}


def test_a_late_file_still_alerts(spark, stores, tmp_path):
    """An event that lands after one of eight days later, and a repeat of a key sent long ago."""
    source, log, checkpoint = (str(tmp_path / p) for p in ("in", "log", "check"))
    for events in ([event("milk", 2), event("oil", 10)], [event("tea", 5), event("milk", 2, 23)]):
        spark.createDataFrame(events, EVENT).write.mode("append").parquet(source)
        A.run_available(A.alert_stream(spark.readStream.schema(EVENT).parquet(source), stores), log, checkpoint)
    keys = sorted(r.alert_key for r in A.sent_log(spark, log).collect())
    assert keys == ["Store 1|milk|2024-05-02", "Store 1|oil|2024-05-10", "Store 1|tea|2024-05-05"]


def test_each_key_alerts_once_across_runs(spark, stores, tmp_path):
    source, log, checkpoint = (str(tmp_path / p) for p in ("in", "log", "check"))

    def drop(*events):
        spark.createDataFrame(list(events), EVENT).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(EVENT).parquet(source)
        A.run_available(A.alert_stream(stream, stores), log, checkpoint)
        return sorted(r.alert_key for r in A.sent_log(spark, log).collect())

    drop(event("milk", 2), event("milk", 2, 11), event("tea", 2, status="TIMED"), event("oil", 2, branch="S9"))
    assert run() == ["Store 1|milk|2024-05-02"]
    drop(event("milk", 2, 12), event("tea", 3), event("milk", 3))
    assert run() == ["Store 1|milk|2024-05-02", "Store 1|milk|2024-05-03", "Store 1|tea|2024-05-03"]
    drop(event("late", 2, 23), event("far", 20))
    assert "Store 1|late|2024-05-02" in run()
    drop(event("milk", 3, 20), event("end", 21))
    keys = run()
    assert keys.count("Store 1|milk|2024-05-03") == 1 and "Store 1|end|2024-05-21" in keys
    assert run() == keys


def test_replayed_batch_writes_the_same_rows(spark, rows, tmp_path):
    log = str(tmp_path / "log")
    schema = (
        "alert_key string, store_name string, item_name string, business_date date, event_time timestamp_ntz, "
        "user_name string, category_name string, item_type string, branch_code string"
    )
    row = lambda k: (k, "S", "i", date(2024, 5, 2), datetime(2024, 5, 2), "u", "c", "t", "b")
    A.write_batch(rows(schema, row("a"), row("a"), row("b")), 0, log)
    A.write_batch(rows(schema, row("b"), row("c")), 1, log)
    A.write_batch(rows(schema, row("b"), row("c")), 1, log)
    assert sorted(r.alert_key for r in A.sent_log(spark, log).collect()) == ["a", "b", "c"]


class _Session:
    """Just enough of a session to ask for its scratch folder."""

    def __init__(self, master, **settings):
        self.conf = self
        self.sparkContext = self
        self.master, self.settings = master, settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_dir_follows_the_session():
    named = {"spark.checkpoint.dir": "/shared/place/"}
    assert scratch_dir(_Session("spark://host:7077", **named)) == "/shared/place"
    assert scratch_dir(_Session("local[4]", **named)) == "/shared/place"
    assert scratch_dir(_Session("local[4]")) == scratch_dir(_Session("local[2]"))
    with pytest.raises(RuntimeError):
        scratch_dir(_Session("spark://host:7077"))


def test_stream_uses_no_python_worker(spark, stores, folder):
    static = spark.createDataFrame([event("milk", 2)], EVENT)
    plan = A.soldout_base(static, stores).withColumn("x", F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
