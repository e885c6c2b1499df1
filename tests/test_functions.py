"""Value semantics: rounding, missing values, guards, text and time functions."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillwork.functions import numeric as N
from tillwork.functions import text as X
from tillwork.functions import time as D


@pytest.fixture
def one(spark):
    """Value of an expression."""
    frame = spark.range(1)
    return lambda column: frame.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "x,places,want",
    [(0.25, 1, 0.2), (0.35, 1, 0.4), (2.5, 0, 2.0), (3.5, 0, 4.0), (0.125, 2, 0.12), (-0.04, 1, 0.0), (12.345, 2, 12.34)],
)
def test_round_half_even(one, x, places, want):
    got = one(N.round_he(F.lit(x), places))
    assert got == want and str(got)[0] != "-"


def test_rounding_keeps_missing(one):
    assert one(N.round_he(F.lit(None).cast("double"), 1)) is None


def test_clip_keeps_missing(one):
    assert one(N.clip_zero(F.lit(-3.0))) == 0.0
    assert one(N.clip_zero(F.lit(4.0))) == 4.0
    assert one(N.clip_zero(F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("num,den,want", [(5, 0, 0.0), (5, None, 0.0), (None, 5, None), (5, -1, 0.0), (1, 4, 25.0)])
def test_guarded_percent(one, num, den, want):
    assert one(N.pct(F.lit(num).cast("double"), F.lit(den).cast("double"))) == want


def test_growth(one):
    assert one(N.growth_pct(F.lit(15), F.lit(10))) == 50.0
    assert one(N.growth_pct(F.lit(15), F.lit(0))) == 0.0
    assert one(N.change_pct(F.lit(5.0), F.lit(20.0))) == -75.0


def test_lenient_numbers(one):
    assert one(N.to_number(F.lit("abc"))) == 0.0
    assert one(N.to_number(F.lit(" 1.5 "))) == 1.5
    assert one(N.to_number(F.lit("abc"), None)) is None


def test_abs_of_sum_is_not_sum_of_abs(rows):
    df = rows("k string, x double", ("a", -3.0), ("a", 1.0), ("b", None))
    got = {r.k: r.v for r in df.groupBy("k").agg(N.abs_sum("x").alias("v")).collect()}
    assert got == {"a": 2.0, "b": 0.0}


@pytest.mark.parametrize("minutes,band", [(11.9, "green"), (12.0, "yellow"), (15.0, "yellow"), (15.1, "red"), (None, None)])
def test_kpt_band(one, minutes, band):
    assert one(N.kpt_band(F.lit(minutes).cast("double"))) == band


@pytest.mark.parametrize("minutes,band", [(29.9, "green"), (30.0, "yellow"), (35.0, "yellow"), (35.1, "red")])
def test_o2d_band(one, minutes, band):
    assert one(N.o2d_band(F.lit(minutes))) == band


@pytest.mark.parametrize(
    "channel,group",
    [
        ("Swiggy Express", "Swiggy"),
        ("ZOMATO gold", "Zomato"),
        ("swiggy at zomato", "Swiggy"),
        ("pos 3", "In Store"),
        ("Dine-in", "In Store"),
        ("My Website", "Ownly"),
        ("ownly", "Ownly"),
        ("phone", "Others"),
        (None, "Others"),
    ],
)
def test_channel_group(one, channel, group):
    assert one(X.channel_group(F.lit(channel).cast("string"))) == group


@pytest.mark.parametrize(
    "names,bracket,voucher",
    [
        (None, "No Offer", "No Offer"),
        ([], "No Offer", "No Offer"),
        (["Restaurant Discount (15% off)"], "15% off", "Restaurant Discount (15% off)"),
        (["Merchant Voucher Code  (TRYNEW)", "Other (X)"], "TRYNEW", "TRYNEW"),
        (["Flat deal"], "Flat deal", "Flat deal"),
        ([None], "No Offer", "No Offer"),
    ],
)
def test_structured_offers(rows, names, bracket, voucher):
    listed = None if names is None else [(n,) for n in names]
    got = rows("d array<struct<name:string>>", (listed,)).select(X.bracket_code("d"), X.voucher_code("d")).first()
    assert tuple(got) == (bracket, voucher)


def test_offer_text(one):
    assert one(X.voucher_offer(F.lit("[{'name': 'Merchant Voucher Code (AB)'}]"))) == "AB"
    assert one(X.voucher_offer(F.lit("[{'name': 'Happy'}, {'name': 'Sad'}]"))) == "Happy"
    assert one(X.voucher_offer(F.lit(None).cast("string"))) == "No Offer"
    assert one(X.restaurant_offer(F.lit("x Restaurant Discount (20%) y"))) == "20%"


def test_recode_and_sentinels(one):
    assert one(X.region_code(F.lit(" Kerala"))) == "KL"
    assert one(X.region_code(F.lit("Goa "))) == "GOA"
    assert one(X.null_if_missing(F.lit(" #N/A "))) is None
    assert one(X.null_if_missing(F.lit(" x "))) == "x"


def test_composite_key_keeps_places(one):
    assert one(X.composite_key(F.lit("S"), F.lit(None).cast("string"), F.lit(date(2024, 1, 2)))) == "S||2024-01-02"


def test_split_list(one):
    assert one(X.split_list(F.lit(" a@x , ,b@x,a@x,"))) == ["a@x", "b@x"]
    assert one(X.split_list(F.lit(None).cast("string"))) == []


@pytest.mark.parametrize("x,text", [(12.5, "12.5%"), (0.0, "0.0%"), (12.346, "12.35%"), (100.0, "100.0%"), (12345678.9, "12345678.9%")])
def test_percent_text(one, x, text):
    assert one(X.percent_text(F.lit(x))) == text


def test_dash(one):
    assert [one(X.dash_if_zero(F.lit(v).cast("int"))) for v in (0, None, 3)] == ["-", "-", "3"]


A_PAGE = '{"avgRating":"4.3","totalRatingsString":"1K+ ratings"} Restaurant UNAVAILABLE now'
B_PAGE = '{"ratingV2":"3.9","reviewCount":"512"} open'


def test_page_fields(one):
    assert one(X.page_number(F.lit(A_PAGE), X.RATING_PATTERN_A)) == 4.3
    assert one(X.page_number(F.lit('"avgRating":4.1,'), X.RATING_PATTERN_A)) == 4.1
    assert one(X.first_match(F.lit(A_PAGE), X.REVIEWS_PATTERN_A)) == "1K+ ratings"
    assert one(X.page_status(F.lit(A_PAGE), X.CLOSED_PHRASES_A)) == "Offline"
    assert one(X.page_number(F.lit(B_PAGE), X.RATING_PATTERN_B)) == 3.9
    assert one(X.first_match(F.lit(B_PAGE), X.REVIEWS_PATTERN_B)) == "512"
    assert one(X.page_status(F.lit(B_PAGE), X.CLOSED_PHRASES_B)) == "Online"
    assert one(X.page_status(F.lit("TEMPORARILY closed"), X.CLOSED_PHRASES_B)) == "Offline"
    assert one(X.page_number(F.lit("nothing"), X.RATING_PATTERN_A)) is None


@pytest.mark.parametrize(
    "local,day",
    [
        (datetime(2024, 5, 2, 8, 59, 59), date(2024, 5, 1)),
        (datetime(2024, 5, 2, 9, 0), date(2024, 5, 2)),
        (datetime(2024, 5, 3, 0, 30), date(2024, 5, 2)),
    ],
)
def test_business_day(one, local, day):
    assert one(D.business_day(D.ntz(local))) == day


def test_business_periods_shift_together():
    current, lw, l2w = D.business_periods(datetime(2024, 5, 3, 1, 30))
    assert (current.start, current.end) == (datetime(2024, 5, 2, 9), datetime(2024, 5, 3, 1, 30))
    assert (lw.start, lw.end) == (datetime(2024, 4, 25, 9), datetime(2024, 4, 26, 1, 30))
    assert l2w.end == datetime(2024, 4, 19, 1, 30)


def test_period_days_are_the_partitions_to_read():
    days = D.period_days(D.business_periods(datetime(2024, 5, 3, 1, 30)))
    assert days == [date(2024, 4, 18), date(2024, 4, 25), date(2024, 5, 2)]


def test_month_of_the_first_is_one_day():
    assert D.month_days(date(2024, 5, 1)) == [date(2024, 5, 1)]
    assert len(D.month_days(D.report_day(date(2024, 6, 1)))) == 31


def test_parsing(one):
    assert one(D.parse_ts(F.lit("not a time"))) is None
    assert one(D.parse_ts(F.lit("2024-01-01T05:00:00"))) == datetime(2024, 1, 1, 5)
    assert one(D.parse_utc(F.lit("2024-01-01T05:30:00+05:30"))) == datetime(2024, 1, 1)
    assert one(D.parse_utc(F.lit("2024-01-01 05:30:00"))) == datetime(2024, 1, 1, 5, 30)
    assert one(D.parse_utc(F.lit("2024-01-01T05:30:00.250Z"))) == datetime(2024, 1, 1, 5, 30, 0, 250000)
    assert one(D.parse_utc(F.lit("2024-01-01"))) == datetime(2024, 1, 1)
    assert one(D.utc_to_zone(D.parse_utc(F.lit("2024-01-01 20:00:00")))) == datetime(2024, 1, 2, 1, 30)


def test_minutes_ignore_session_zone(spark, one):
    column = D.minutes_between(D.ntz(datetime(2024, 3, 10, 1)), D.ntz(datetime(2024, 3, 10, 4, 0, 30)))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(column) == 180.5
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_labels(one):
    t = D.ntz(datetime(2024, 5, 2, 17, 5))
    assert one(D.month_label(t)) == "2024-05"
    assert one(D.day_label(t)) == "02-05-2024"
    assert one(D.window_label(D.ntz(datetime(2024, 5, 2, 9)), t)) == "09:00 AM - 05:05 PM"
