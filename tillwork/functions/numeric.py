"""Rounding, guarded ratios, growth and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def as_col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_he(x: Column | str, places: int = 0) -> Column:
    """Round half to even in binary floating point; missing stays missing."""
    scale = float(10**places)
    # "+ 0.0" turns a negative zero into zero
    return F.rint(as_col(x).cast("double") * scale) / scale + F.lit(0.0)


def to_number(x: Column | str, default: float | None = 0.0) -> Column:
    """Lenient number: unreadable or missing text becomes ``default``."""
    number = as_col(x).try_cast("double")
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def to_money(x: Column | str) -> Column:
    return as_col(x).try_cast(MONEY)


def clip_zero(x: Column | str) -> Column:
    """Negative becomes zero, missing stays missing (``greatest`` would invent a zero)."""
    x = as_col(x)
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def safe_div(num: Column | str, den: Column | str) -> Column:
    num, den = as_col(num).cast("double"), as_col(den).cast("double")
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def pct(num: Column | str, den: Column | str, places: int | None = None) -> Column:
    """num / den * 100, zero unless the denominator is positive."""
    num, den = as_col(num).cast("double"), as_col(den).cast("double")
    value = F.when(den > 0, num / den * 100.0).otherwise(F.lit(0.0))
    return value if places is None else round_he(value, places)


def growth_pct(cur: Column | str, prev: Column | str, places: int = 1) -> Column:
    """(cur / prev - 1) * 100, zero unless prev is positive."""
    cur, prev = as_col(cur).cast("double"), as_col(prev).cast("double")
    return round_he(F.when(prev > 0, (cur / prev - 1.0) * 100.0).otherwise(F.lit(0.0)), places)


def change_pct(cur: Column | str, prev: Column | str, places: int = 1) -> Column:
    """(cur - prev) / prev * 100, zero unless prev is positive."""
    cur, prev = as_col(cur).cast("double"), as_col(prev).cast("double")
    return round_he(F.when(prev > 0, (cur - prev) / prev * 100.0).otherwise(F.lit(0.0)), places)


def abs_sum(x: Column | str) -> Column:
    """|sum(x)|, zero for a group with nothing to sum; not sum(|x|)."""
    return F.abs(F.coalesce(F.sum(as_col(x)), F.lit(0)))


def sum0(x: Column | str) -> Column:
    return F.coalesce(F.sum(as_col(x)), F.lit(0))


def sla_band(minutes: Column | str, green_below: float, yellow_to: float) -> Column:
    """green under the target, yellow up to and including the tolerance, else red."""
    m = as_col(minutes)
    return (
        F.when(m.isNull(), F.lit(None).cast("string"))
        .when(m < green_below, "green")
        .when(m <= yellow_to, "yellow")
        .otherwise("red")
    )


def sign_band(growth: Column | str) -> Column:
    return F.when(as_col(growth) >= 0, "positive").otherwise("negative")


# SLA targets in minutes (green below, yellow up to).
KPT_BAND = (12.0, 15.0)
O2D_BAND = (30.0, 35.0)


def kpt_band(minutes: Column | str) -> Column:
    return sla_band(minutes, *KPT_BAND)


def o2d_band(minutes: Column | str) -> Column:
    return sla_band(minutes, *O2D_BAND)
