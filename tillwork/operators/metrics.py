"""SLA metrics over histograms, period comparison, stock ratios, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import round_he, sum0

RESOLUTION = 10  # minutes are kept to 0.1, so a tenth is one histogram step


def not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups with a missing key are dropped before aggregation."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


ORDERS = "orders"


def metric_histogram(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    invoice: str | None = None,
    scopes: Column | None = None,
    within: str = "region",
) -> DataFrame:
    """keys, metric, tenths, n: how often each value (in whole tenths) occurs per key.

    Exact for values rounded to 0.1. The count is combined map-side and spread
    by value, so a key with a third of all rows ships only its distinct values;
    mean, median, percentiles and breaches all follow from this table.

    With ``invoice`` the same pass also yields the key's distinct invoices: rows of
    metric ``orders`` with the invoice and n = 1, spread by invoice. With ``scopes``, an array column, the
    invoices are distinct in each of its values: rows then have a ``scope``, and the key ``within`` only where
    that is missing, so that values fan out after the reduction and only the invoices before.
    """
    none_t, none_i = F.lit(None).cast("bigint"), None
    if invoice is not None:
        none_i = F.lit(None).cast(df.schema[invoice].dataType)
    split = [] if scopes is None else [F.lit(None).cast("string").alias("scope")]

    def cell(metric: str, tenths: Column, order: Column | None, scope: Sequence[Column] = split) -> Column:
        fields = [F.lit(metric).alias("metric"), tenths.alias("tenths")]
        return F.struct(*fields, *([] if order is None else [order.alias("order")]), *scope)

    cells = F.array(*[cell(m, F.rint(F.col(m) * RESOLUTION).cast("bigint"), none_i) for m in metrics])
    known = F.col("tenths").isNotNull()
    steps = ["metric", "tenths"]
    if invoice is not None:
        if scopes is None:
            cells = F.concat(cells, F.array(cell(ORDERS, none_t, F.col(invoice))))
        else:
            spread = F.transform(scopes, lambda s: cell(ORDERS, none_t, F.col(invoice), [s.alias("scope")]))
            cells = F.concat(cells, spread)
            steps.append("scope")
        known = known | F.col("order").isNotNull()
        steps.append("order")
    count = F.count(F.lit(1))
    n = count if invoice is None else F.when(F.col("metric") == ORDERS, F.lit(1).cast("bigint")).otherwise(count)
    rows = df.select(*keys, F.inline(cells)).filter(known)
    if scopes is not None:
        rows = rows.withColumn(within, F.when(F.col("scope").isNull(), F.col(within)))
    return rows.groupBy(*keys, *steps).agg(n.alias("n"))


def _percentiles(of: Column) -> Column:
    return F.percentile(of, F.array(F.lit(0.5), F.lit(0.8)), F.col("n"))


def sla_columns(prefix: str, metric: str, where: Column | None = None, limit: float | None = None) -> list[Column]:
    """Raw aggregates of one metric over histogram rows; finish with ``sla_finish``."""
    hit = F.col("metric") == metric
    if where is not None:
        hit = hit & where
    n, tenths = F.when(hit, F.col("n")), F.when(hit, F.col("tenths"))
    out = [
        F.sum(n).alias(f"{prefix}_n"),
        F.sum(tenths * F.col("n")).alias(f"{prefix}_sum"),
        _percentiles(tenths).alias(f"{prefix}_pct"),
    ]
    if limit is not None:
        over = F.when(hit & (F.col("tenths") > limit * RESOLUTION), F.col("n"))
        out.append(F.coalesce(F.sum(over), F.lit(0)).alias(f"{prefix}_breach"))
    return out


def sla_finish(prefix: str, places: int, fill: float | None = None) -> dict[str, Column]:
    """mean, p80 and median in minutes from the raw aggregates; all of them exact in tenths."""

    def out(tenths: Column) -> Column:
        scale = float(10 ** (places - 1))
        minutes = F.rint(tenths * scale) / (scale * RESOLUTION)
        return minutes if fill is None else F.coalesce(minutes, F.lit(float(fill)))

    mean = F.col(f"{prefix}_sum").cast("double") / F.col(f"{prefix}_n").cast("double")
    return {
        "mean": out(mean),
        "p80": out(F.get(f"{prefix}_pct", F.lit(1))),
        "median": out(F.get(f"{prefix}_pct", F.lit(0))),
    }


def sla_metrics(df: DataFrame, keys: Sequence[str], limits: Mapping[str, float], places: int = 1) -> DataFrame:
    """Per key and metric: orders, avg, median, p80, breach, breach_pct."""
    hist = metric_histogram(not_null(df, keys), keys, list(limits))
    breach_limit = None
    for metric, limit in limits.items():
        test = F.col("metric") == metric
        value = F.lit(float(limit) * RESOLUTION)
        breach_limit = F.when(test, value) if breach_limit is None else breach_limit.when(test, value)
    over = F.when(F.col("tenths") > breach_limit, F.col("n"))
    raw = hist.groupBy(*keys, "metric").agg(
        F.sum("n").alias("m_n"),
        F.sum(F.col("tenths") * F.col("n")).alias("m_sum"),
        _percentiles(F.col("tenths")).alias("m_pct"),
        F.coalesce(F.sum(over), F.lit(0)).alias("breach"),
    )
    done = sla_finish("m", places)
    return raw.select(
        *keys,
        "metric",
        F.col("m_n").alias("orders"),
        done["mean"].alias("avg"),
        done["median"].alias("median"),
        done["p80"].alias("p80"),
        "breach",
        round_he(F.col("breach").cast("double") / F.col("m_n").cast("double") * 100.0, 1).alias("breach_pct"),
    )


def period_compare(
    lines: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Sequence[str]],
    current: str = "CURRENT",
    how: str = "full",
    orders: str = "distinct",
    fill: bool = True,
    absolute: Sequence[str] = ("discount",),
    invoice: str = "invoice",
    rows: str | None = None,
    live: str | None = None,
) -> DataFrame:
    """One row per key, every period's order count and sums side by side.

    ``measures`` maps a period to its summed columns; output columns are
    ``<period>_orders`` and ``<period>_<measure>`` in lower case.
    ``how="left"`` keeps keys that occur in ``current``; ``"full"`` in any period.
    ``orders="distinct"`` counts invoices: rows are first reduced per
    (key, period, invoice), which spreads a hot key over its invoices, and the
    second, map-side combined aggregation only counts what is left.
    ``fill=False`` leaves the measures of an absent period missing. ``rows`` names a
    column with the number of lines a row stands for, when lines were reduced before.
    ``live`` names a key: only its values with any line in ``current`` are reported, which the reduced
    table tells, so the lines are read once.
    """
    wanted = sorted({m for cols in measures.values() for m in cols})
    base = not_null(lines, [live] if live else keys).filter(F.col("period").isin(*measures))
    if orders == "distinct":
        base = base.groupBy(*keys, "period", invoice).agg(
            F.count(F.lit(1)).alias("_rows"), *[F.sum(m).alias(m) for m in wanted]
        )
        unit = F.col(invoice).isNotNull().cast("int")
    elif orders == "count":
        unit = F.when(F.col(invoice).isNotNull(), F.lit(1) if rows is None else F.col(rows)).otherwise(0)
    else:
        raise ValueError("orders is 'distinct' or 'count'")
    aggregates, names = [], []
    for period, columns in measures.items():
        here, p = F.col("period") == period, period.lower()
        aggregates += [
            F.count(F.when(here, F.lit(1))).alias(f"_{p}_rows"),
            F.coalesce(F.sum(F.when(here, unit)), F.lit(0)).cast("bigint").alias(f"{p}_orders"),
        ]
        names.append((p, f"{p}_orders"))
        for m in columns:
            total = sum0(F.when(here, F.col(m)))
            total = F.abs(total) if m in absolute else total
            aggregates.append(total.cast("double").alias(f"{p}_{m}"))
            names.append((p, f"{p}_{m}"))
    wide = base.groupBy(*keys).agg(*aggregates)
    if live:
        here = F.sum(f"_{current.lower()}_rows").over(W.partitionBy(live))
        wide = not_null(wide.withColumn("_live", here).filter("_live > 0"), keys)
    if how == "left":
        wide = wide.filter(F.col(f"_{current.lower()}_rows") > 0)
    elif how != "full":
        raise ValueError("how is 'left' or 'full'")
    if fill:
        return wide.select(*keys, *[c for _, c in names])
    return wide.select(*keys, *[F.when(F.col(f"_{p}_rows") > 0, F.col(c)).alias(c) for p, c in names])


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int, rank: str | None = None) -> DataFrame:
    """First k rows per key by a total order; cut to k per task before the exchange."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= k)
    return out if rank else out.drop(name)


def frequency(df: DataFrame, *columns: str) -> DataFrame:
    """Row count per value; missing is a value here."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def scoped_totals(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], *aggregates: Column) -> DataFrame:
    """Totals of every set of keys in one pass, with ``scope``: the names of the keys that the row is a total of, joined by ``+``.

    A key that is missing in the data and a key that is summed over are both null; ``scope`` tells them apart. Rows fan
    out before the exchange, and are combined map-side: reduce large tables to the finest keys first.
    """
    bit = {k: 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)}
    names = None
    for kept in sets:
        summed = sum(bit[k] for k in keys if k not in kept)
        label = "+".join(k for k in keys if k in kept) or "all"
        hit = F.col("_grouping") == summed
        names = F.when(hit, label) if names is None else names.when(hit, label)
    grouped = df.groupingSets([[F.col(k) for k in kept] for kept in sets], *[F.col(k) for k in keys])
    return grouped.agg(F.grouping_id().alias("_grouping"), *aggregates).withColumn("scope", names).drop("_grouping")


def first_known(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: str, *more: Column) -> DataFrame:
    """Per key, each column's first non-missing value by ``order``, ties by the smaller value; ``more`` aggregates ride along."""
    at = lambda v: F.when(F.col(v).isNotNull(), F.struct(F.col(order), F.col(v)))
    picks = [F.min(at(v)).getField(v).alias(v) for v in values]
    return not_null(df, keys).groupBy(*keys).agg(*picks, *more)
