"""Shape, join, metric and pivot operators on a few hand rows."""

from __future__ import annotations

import random
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.operators import joins as J
from tillwork.operators import metrics as M
from tillwork.operators import pivot as P
from tillwork.operators import shape as S

ITEMS = "id int, items array<struct<name:string,qty:int>>"


def test_explode_outer_and_inner(rows):
    df = rows(ITEMS, (1, [("a", 1), ("b", 2)]), (2, []), (3, None), (4, [None, ("c", 3)]))
    outer = sorted(tuple(r) for r in S.explode_objects(df, "items", "item_").fillna("").fillna(0).collect())
    assert outer == [(1, "a", 1), (1, "b", 2), (2, "", 0), (3, "", 0), (4, "", 0), (4, "c", 3)]
    inner = sorted(tuple(r) for r in S.explode_objects(df, "items", "item_", outer=False).collect())
    assert inner == [(1, "a", 1), (1, "b", 2), (4, "c", 3)]
    dropped = S.explode_objects(df, "items", "item_", drop_null=True)
    assert dropped.filter("id = 3").count() == 0 and dropped.filter("id = 2").count() == 1


def test_flatten_and_json(rows):
    df = rows("id int, a struct<b:struct<c:int>,d:array<int>>", (1, ((5,), [1, 2])))
    flat = S.flatten_structs(df)
    assert flat.columns == ["id", "a_b_c", "a_d"]
    assert S.json_text(flat).first()["a_d"] == "[1,2]"


def test_safe_headers():
    assert S.safe_headers([" Store Name", "", "storename", None, "Region"]) == [
        "storename",
        "blank_col_1",
        "storename_2",
        "blank_col_3",
        "region",
    ]
    assert S.safe_headers([" A b", "A b"], normalise=False) == ["A b", "A b_1"]


def test_pad_ragged(rows):
    df = rows("c array<string>", (["x"],), (["x", "y", "z"],))
    assert [tuple(r) for r in S.pad_ragged(df, "c", ["h1", "h2"]).collect()] == [("x", ""), ("x", "y")]


def test_conform_defaults_and_extra(rows):
    schema = T.StructType([T.StructField("q", T.DoubleType()), T.StructField("m", T.LongType())])
    df = rows("q string, z string", ("abc", "keep"), ("2.5", "keep"))
    got = [tuple(r) for r in S.conform(df, schema, {"q": 0.0}, keep_extra=True).collect()]
    assert got == [(0.0, None, '{"z":"keep"}'), (2.5, None, '{"z":"keep"}')]


def test_require_raises_before_any_job(rows):
    with pytest.raises(S.MissingColumns):
        S.require(rows("a int", (1,)), ["a", "b"])
    with pytest.raises(S.MissingColumns):
        S.first_present(rows("a int", (1,)), ["x", "y"])


def test_lead_union_twins_lookup(rows):
    a, b = rows("k int, x int", (1, 10)), rows("k int, y string", (2, "t"))
    both = S.union_all(a, b)
    assert sorted((r.k, r.x, r.y) for r in both.collect()) == [(1, 10, None), (2, None, "t")]
    assert S.lead(both, ["y", "missing"]).columns == ["y", "k", "x"]
    twins = S.merge_twins(rows("v_x int, k int, v_y int", (None, 1, 7), (3, 2, 9)))
    assert twins.columns == ["v", "k"] and sorted(tuple(r) for r in twins.collect()) == [(3, 2), (7, 1)]
    looked = S.latest_lookup(rows("k string, v string, o int", ("a", "old", 1), ("a", "new", 2), (None, "x", 3)), "k", "v", "o")
    assert [tuple(r) for r in looked.collect()] == [("a", "new")]


def test_unwrap_takes_first_non_empty(rows):
    df = rows(
        "p int, data array<struct<i:int>>, transactions array<struct<i:int>>, timings array<struct<i:int>>",
        (1, [(1,), (2,)], [(9,)], None),
        (2, [], [(3,)], None),
        (3, None, None, [(4,)]),
        (4, None, [], None),
    )
    assert sorted((r.p, r.i) for r in S.unwrap_envelope(df).collect()) == [(1, 1), (1, 2), (2, 3), (3, 4)]


def test_ties_do_not_depend_on_row_order(rows):
    data = [("a", 1, "x", "m"), ("a", 1, "b", None), ("a", 1, "b", "c"), ("z", None, "q", "q")]
    for order in (data, data[::-1]):
        df = rows("k string, t int, v string, w string", *order)
        first = {r.k: r for r in M.first_known(df, ["k"], ["v", "w"], "t").collect()}
        assert (first["a"].v, first["a"].w, first["z"].v) == ("b", "c", "q")
        assert J.unique_dimension(df, ["k"], ["t"]).filter("k = 'a'").first().w == "c"


def test_missing_fields_stay_in_json(rows):
    df = rows("o struct<a:int,b:string>", ((1, None),))
    assert S.json_text(df).first().o == '{"a":1,"b":null}'


def test_nest_and_explode_are_inverse(rows):
    df = rows("k int, part int, v int", *[(i % 3, i % 7, i) for i in range(100)])
    docs = S.nest(df, ["k", "part"], "vs")
    assert docs.count() == 21
    back = S.explode_objects(docs, "vs", "", outer=False)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_unique_dimension_and_conflicts(rows):
    dim = rows("k string, v string", ("a", "2"), ("a", "1"), ("b", "1"), ("b", "1"), (None, "z"))
    assert sorted(tuple(r) for r in J.unique_dimension(dim, ["k"], ["v"]).collect()) == [("a", "1"), ("b", "1")]
    assert [tuple(r) for r in J.dimension_conflicts(dim.filter("k is not null"), ["k"], ["v"]).collect()] == [("a", 2)]


def test_left_join_keeps_every_fact_once(rows):
    fact = rows("k string, n int", ("a", 1), ("a", 2), ("x", 3), (None, 4))
    dim = J.unique_dimension(rows("k string, v string", ("a", "1"), ("a", "2")), ["k"], ["v"])
    assert J.with_dimension(fact, dim, "k").count() == 4
    assert J.with_dimension(fact, dim, "k", "inner").count() == 2


def test_only_listed_and_status_row(rows):
    df, none = rows("k int", (1,), (2,)), rows("k int", (9,)).filter("k < 0")
    assert J.only_listed(df, rows("k int", (2,), (2,)), "k").count() == 1
    assert J.only_listed(df, rows("k int", (2,), (2,)), "k", all_when_empty=True).count() == 1
    assert J.only_listed(df, none, "k", all_when_empty=True).count() == 2
    assert J.only_listed(df, none, "k").count() == 0
    status = rows("k int", (0,))
    assert J.with_status_row(df, status).count() == 2
    assert [r.k for r in J.with_status_row(none, status).collect()] == [0]


def test_sla_metrics_against_pandas(spark):
    rng = random.Random(5)
    data = [(rng.choice("abc"), round(rng.uniform(0, 30), 1), rng.choice([None, round(rng.uniform(0, 60), 1)])) for _ in range(400)]
    df = spark.createDataFrame(data, "k string, kpt double, o2d double")
    got = {(r.k, r.metric): r for r in M.sla_metrics(df, ["k"], {"kpt": 12, "o2d": 30}).collect()}
    pdf = pd.DataFrame(data, columns=["k", "kpt", "o2d"]).astype({"o2d": float})
    for k, g in pdf.groupby("k"):
        for metric, limit in (("kpt", 12), ("o2d", 30)):
            x, r = g[metric], got[k, metric]
            assert r.orders == x.count()
            assert r.avg == pytest.approx(x.mean(), abs=0.05001)
            assert r.median == pytest.approx(x.median(), abs=0.05001)
            assert r.p80 == pytest.approx(x.quantile(0.8), abs=0.05001)
            assert r.breach == (x > limit).sum()
            assert r.breach_pct == pytest.approx(r.breach / r.orders * 100, abs=0.05001)


def test_limit_itself_is_no_breach(rows):
    df = rows("k string, kpt double", ("a", 12.0), ("a", 12.1), ("a", None), (None, 99.0))
    r = M.sla_metrics(df, ["k"], {"kpt": 12}).collect()
    assert [(x.k, x.orders, x.breach, x.breach_pct) for x in r] == [("a", 2, 1, 50.0)]


LINES = "brand string, cat string, period string, invoice int, gross double, discount double"


@pytest.fixture
def lines(rows):
    return rows(
        LINES,
        ("b", "both", "CURRENT", 1, 100.0, 10.0),
        ("b", "both", "CURRENT", 1, 50.0, 5.0),
        ("b", "both", "CURRENT", 2, 50.0, 5.0),
        ("b", "both", "LW", 3, 80.0, 0.0),
        ("b", "now", "CURRENT", 4, 0.0, 0.0),
        ("b", "then", "LW", 5, 10.0, 1.0),
        ("b", "older", "L2W", 6, 10.0, 1.0),
        ("b", None, "CURRENT", 7, 10.0, 1.0),
    )


MEASURES = {"CURRENT": ["gross", "discount"], "LW": ["gross"], "L2W": []}


def test_period_compare_full(lines):
    got = {r.cat: r for r in M.period_compare(lines, ["brand", "cat"], MEASURES).collect()}
    assert set(got) == {"both", "now", "then", "older"}
    assert (got["both"].current_orders, got["both"].current_gross, got["both"].lw_orders) == (2, 200.0, 1)
    assert (got["then"].current_orders, got["then"].current_gross, got["then"].lw_orders) == (0, 0.0, 1)
    assert (got["older"].lw_orders, got["older"].l2w_orders) == (0, 1)


def test_period_compare_left_and_unfilled(lines):
    got = {r.cat: r for r in M.period_compare(lines, ["brand", "cat"], MEASURES, how="left", fill=False).collect()}
    assert set(got) == {"both", "now"}
    assert (got["now"].lw_orders, got["now"].lw_gross, got["now"].l2w_orders) == (None, None, None)


def test_period_compare_counts_lines(lines):
    got = {r.cat: r.current_orders for r in M.period_compare(lines, ["brand", "cat"], MEASURES, orders="count").collect()}
    assert got == {"both": 3, "now": 1, "then": 0, "older": 0}


def test_top_k_breaks_ties(rows):
    df = rows("g string, c string, n int", ("x", "b", 5), ("x", "a", 5), ("x", "c", 9), ("y", "z", 1))
    got = sorted(tuple(r) for r in M.top_k(df, ["g"], [F.desc("n"), F.asc("c")], 2).collect())
    assert got == [("x", "a", 5), ("x", "c", 9), ("y", "z", 1)]


def test_first_known_skips_missing(rows):
    df = rows("k string, a string, o int", ("s", None, 1), ("s", "second", 2), ("s", "third", 3))
    assert [tuple(r) for r in M.first_known(df, ["k"], ["a"], "o").collect()] == [("s", "second")]


def test_frequency_keeps_missing(rows):
    df = rows("a string", ("x",), (None,), (None,))
    assert {r.a: r.rows for r in M.frequency(df, "a").collect()} == {"x": 1, None: 2}


def test_count_pivot_always_has_its_columns(rows):
    df = rows("item string, region string", ("m", "KA"), ("m", "KA"), ("n", None), (None, "KA"))
    got = sorted(tuple(r) for r in P.count_pivot(df, ["item"], "region", ["KA", "TN"]).collect())
    assert got == [("m", 2, 0), ("n", 0, 0)]


def test_value_pivot_and_transpose(rows):
    df = rows("s string, d int, v double", ("s1", 1, 5.0), ("s1", 2, 6.0), ("s2", 2, 7.0))
    wide = P.value_pivot(df, ["s"], "d", [1, 2, 3], "v", ["d1", "d2", "d3"])
    assert sorted(tuple(r) for r in wide.collect()) == [("s1", 5.0, 6.0, 0.0), ("s2", 0.0, 7.0, 0.0)]
    reg = rows("region string, a double, b double", ("X", 1.0, 2.0), ("Y", 3.0, 4.0))
    out = P.transpose(reg, "region", ["X", "Y"], {"A": F.col("a"), "B": F.col("b")}, "kpi")
    assert sorted(tuple(r) for r in out.collect()) == [("A", 1.0, 3.0), ("B", 2.0, 4.0)]


def test_results_do_not_depend_on_row_order(lines):
    shuffled = lines.orderBy(F.rand(3))
    a = sorted(M.period_compare(lines, ["brand", "cat"], MEASURES).collect())
    assert a == sorted(M.period_compare(shuffled, ["brand", "cat"], MEASURES).collect())


def test_keep_first_is_deterministic(rows):
    df = rows("k string, t timestamp, v int", ("a", datetime(2024, 1, 2), 1), ("a", datetime(2024, 1, 1), 2))
    assert [r.v for r in J.keep_first(df, ["k"], ["t"]).collect()] == [2]
