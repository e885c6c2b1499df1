"""Quality rules: text statistics and robust multivariate outliers, in DataFrame operations only.

The statistics of a text are computed inside its row. A text fails the base rule if it has few words or if
too many of its words lie in windows that the text repeats.

The others are judged by a vector of transformed statistics. For each language and source, the minimum
covariance determinant estimate of location and scatter is found by concentration steps from several fixed
starts: the middle of each statistic alone, the directions of the rows from that middle, and the rows' bounded deviations
from it, which tell how statistics go together. In a step the rows nearest to an estimate (``CORE`` of them)
give the next one; a start whose determinant falls no more keeps its estimate, and steps end when all have settled. Of a
group's starts that of the least determinant is taken. A row whose squared Mahalanobis distance from it is
above ``LIMIT`` is rejected.

A step is one aggregation: rows are summed up by group and by interval of distance, map-side first,
and the sums of a group's nearest intervals make its estimate, so no group is ever brought together or
sorted. Statistics are rounded to 1/256, so their sums do not depend on the order of the rows.

Small groups lean on their language (``LEAN`` rows' weight), and each statistic has a least spread, as many
are zero in most texts.

Defined cases: null and empty texts have all statistics 0 and fail the base rule; null languages and
sources are groups of their own; a group of one row, or of equal rows, rejects none of them; repeated rows are
judged alike; other columns pass through, but columns with the names of the results are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import source_bytes
from .common import boxed, own_columns, stored, unboxed

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
WINDOW = 8

CORE = 0.75  # share of a group's rows that the estimate rests on
# Fixed value: makes the scatter of the nearest 75 % of normal rows in 5 dimensions that of all of them:
# 0.75 / P(chi2(7) <= 6.626), 6.626 being the 75 % point of chi2(5).
CONSISTENT = 1.41
LIMIT = 60.0
SETTLED = 0.01  # a fall of the log determinant by no more than this ends a start's steps
LEAN = 50.0
LEAST_SPREAD = 0.25
PARAMETER_BYTES = 32 * 1024 * 1024  # estimates are broadcast up to this measured size
DIMENSIONS = 5


def words_of(text: Column) -> Column:
    """The runs of characters between white space."""
    inner = F.btrim(text, F.lit(WHITE))
    return F.when(F.length(inner) > 0, F.split(inner, r"[\x20\x09-\x0D]+", -1)).otherwise(F.array().cast("array<string>"))


def with_counts(rows: DataFrame) -> DataFrame:
    """Boxed rows with a ``_content``, which the five counts as bigint columns and ``base_failed`` replace."""
    own = [c for c in rows.columns if c != "_content"]
    t = F.coalesce("_content", F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(WHITE))) > 0)
    cut = rows.select(
        *own,
        words_of(t).alias("_words"),
        F.length(F.translate(t, WHITE, "")).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"),
    )
    n = F.size("_words")
    places = F.when(n >= WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    base = [*own, "word_chars", "n_symbols"]
    windows = cut.select(
        *base,
        n.cast("bigint").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform(places, lambda i: F.xxhash64(F.slice("_words", i, WINDOW))).alias("_windows"),
    )
    base += ["n_words", "n_dup_lines"]
    # only texts with a window found twice sort their windows, each with its place
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ordered = windows.select(*base, F.when(repeats, F.sort_array(placed)).alias("_ordered"))
    hashes = F.col("_ordered.h")
    nothing = F.array(F.lit(None).cast("bigint"))
    beside = ordered.select(
        *base,
        F.when(
            F.col("_ordered").isNotNull(),
            F.arrays_zip(
                F.col("_ordered.i").alias("i"),
                hashes.alias("h"),
                F.concat(nothing, hashes).alias("before"),
                F.concat(F.slice(hashes, F.lit(2), F.size(hashes)), nothing).alias("after"),
            ),
        ).alias("_beside"),
    )
    again = F.filter("_beside", lambda x: (x["h"] == x["before"]) | (x["h"] == x["after"]))
    starts = beside.select(*base, F.sort_array(F.transform(again, lambda x: x["i"])).alias("_starts"))
    none = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "_starts",
        none,
        lambda s, i: F.struct((i + WINDOW).alias("upto"), (s["n"] + WINDOW - F.greatest(F.lit(0), s["upto"] - i)).alias("n")),
        lambda s: s["n"],
    )
    counted = starts.select(*base, F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.select(*own, *COUNTS, failed.alias("base_failed"))


def vector() -> list[Column]:
    """The transformed statistics of a row with words, rounded to 1/256."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    parts = (
        F.log(n),
        4 * F.log(chars / n),
        F.log1p(200 * F.col("n_symbols") / chars),
        F.log1p(F.col("n_dup_lines").cast("double")),
        F.log1p(8 * F.col("n_repeat_words") / n),
    )
    return [F.rint(p * 256) / 256 for p in parts]


X = [f"_x{i}" for i in range(DIMENSIONS)]
M = [f"_m{i}" for i in range(DIMENSIONS)]


def _a(i: int, j: int) -> str:
    return f"_a{min(i, j)}{max(i, j)}"


PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]


def _sums(columns: list[str]) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def _moments() -> list[Column]:
    squares = [F.sum(F.col(X[i]) * F.col(X[j])).alias(_a(i, j)) for i, j in PAIRS]
    return [F.sum(F.lit(1.0)).alias("_n"), *[F.sum(x).alias(m) for x, m in zip(X, M)], *squares]


SUMMED = ["_n", *M, *[_a(i, j) for i, j in PAIRS]]


def _inverted(table: DataFrame, names: list[str]) -> DataFrame:
    """The symmetric matrices in the columns ``_aij`` replaced by their inverses, one pivot after the other, and ``_logdet``."""
    k = range(DIMENSIONS)
    full = table.select(*names, F.lit(0.0).alias("_logdet"), *[F.col(_a(i, j)).alias(f"_f{i}{j}") for i in k for j in k])

    def pivoted(at: DataFrame, p: int) -> DataFrame:
        f = lambda i, j: F.col(f"_f{i}{j}")
        new = []
        for i in k:
            for j in k:
                if i == p and j == p:
                    value = 1 / f(p, p)
                elif i == p:
                    value = f(p, j) / f(p, p)
                elif j == p:
                    value = -f(i, p) / f(p, p)
                else:
                    value = f(i, j) - f(i, p) * f(p, j) / f(p, p)
                new.append(value.alias(f"_f{i}{j}"))
        return at.select(*names, (F.col("_logdet") + F.log(f(p, p))).alias("_logdet"), *new)

    done = reduce(pivoted, k, full)
    return done.select(*names, "_logdet", *[F.col(f"_f{i}{j}").alias(_a(i, j)) for i, j in PAIRS])


KEYS = ["_group", "_language", "_start"]
ESTIMATE = ["_logdet", *M, *[_a(i, j) for i, j in PAIRS]]


def _estimates(sums: DataFrame, scale: float) -> DataFrame:
    """Location, inverse scatter and log determinant of each group and start from its sums (KEYS, SUMMED)."""
    n = F.col("_n")
    means = sums.select(*KEYS, "_n", *[(F.col(m) / n).alias(m) for m in M], *[
        (scale * (F.col(_a(i, j)) / n - F.col(M[i]) * F.col(M[j]) / (n * n))).alias(_a(i, j)) for i, j in PAIRS
    ])
    pooled = means.groupBy("_language", "_start").agg(
        *[(F.sum(F.col(c) * F.col("_n")) / F.sum("_n")).alias(f"{c}_l") for c in (*M, *[_a(i, j) for i, j in PAIRS])]
    )
    lean = lambda c: (F.col(c) * n + F.col(f"{c}_l") * LEAN) / (n + LEAN)
    least = lambda i, j: F.lit(LEAST_SPREAD**2 if i == j else 0.0)
    # the small joins of a step are merged: a broadcast keeps a page of memory on every executor until it is cleaned up
    leaning = means.join(pooled.hint("merge"), ["_language", "_start"]).select(
        *KEYS, *[lean(m).alias(m) for m in M], *[(lean(_a(i, j)) + least(i, j)).alias(_a(i, j)) for i, j in PAIRS]
    )
    return _inverted(leaning, [*KEYS, *M])


def _distance() -> Column:
    """Squared Mahalanobis distance of a row joined with its group's estimate."""
    d = [F.col(x) - F.col(m) for x, m in zip(X, M)]
    return reduce(lambda a, b: a + b, [(1 if i == j else 2) * F.col(_a(i, j)) * d[i] * d[j] for i, j in PAIRS])


def _with_estimate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with the estimates of their group: once for each start that these are of."""
    if source_bytes(estimates) <= PARAMETER_BYTES:
        estimates = F.broadcast(estimates)
    return rows.join(estimates.drop("_language"), "_group", "left")


SPREAD = [f"_s{i}" for i in range(DIMENSIONS)]


def _middles(rows: DataFrame) -> DataFrame:
    """Location ``_mi`` and spread ``_si`` of each statistic alone, from its middle half, by group."""
    cells = rows.select("_group", "_language", F.posexplode(F.array(*X)).alias("_p", "_v"))
    cells = cells.groupBy("_group", "_language", "_p", F.rint(F.col("_v") * 16).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("_v").alias("_s"), F.sum(F.col("_v") * F.col("_v")).alias("_ss")
    )
    every = W.partitionBy("_group", "_p")
    upto = every.orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    cells = cells.withColumns({"_upto": F.sum("_rows").over(upto), "_all": F.sum("_rows").over(every)})
    middle = (F.col("_upto") > 0.25 * F.col("_all")) & (F.col("_upto") - F.col("_rows") < 0.75 * F.col("_all"))
    parts = cells.filter(middle).groupBy("_group", "_language", "_p").agg(*_sums(["_rows", "_s", "_ss"]))
    pick = lambda p, c: F.sum(F.when(F.col("_p") == p, F.col(c)))
    wide = parts.groupBy("_group", "_language").agg(
        *[(pick(p, "_s") / pick(p, "_rows")).alias(M[p]) for p in range(DIMENSIONS)],
        *[F.greatest(F.lit(0.0), pick(p, "_ss") / pick(p, "_rows") - F.pow(pick(p, "_s") / pick(p, "_rows"), F.lit(2))).alias(f"_v{p}") for p in range(DIMENSIONS)],
    )
    # the middle half of a normal statistic has 1/7 of its variance
    return stored(
        wide.select("_group", "_language", *M, *[F.sqrt(7 * F.col(f"_v{p}") + LEAST_SPREAD**2).alias(SPREAD[p]) for p in range(DIMENSIONS)]),
        "middles",
    )


def _starts(rows: DataFrame) -> DataFrame:
    """Sums (KEYS, SUMMED) as of one row for each start: 0 with independent statistics, 1 by directions, 2 by bounded deviations."""
    middles = _middles(rows)
    near = _with_estimate(rows, middles)
    k = range(DIMENSIONS)
    near = near.withColumns({f"_z{i}": (F.col(X[i]) - F.col(M[i])) / F.col(SPREAD[i]) for i in k})
    length = F.sqrt(reduce(lambda a, b: a + b, [F.col(f"_z{i}") * F.col(f"_z{i}") for i in k]))
    near = near.withColumn("_length", F.greatest(length, F.lit(1e-9)))
    near = near.withColumns(
        {f"_u{i}": F.col(f"_z{i}") / F.col("_length") for i in k} | {f"_t{i}": F.tanh(f"_z{i}") for i in k}
    )
    # rounded, so that the sums do not depend on the order of the rows
    mean = lambda c, i, j: (F.sum(F.rint(F.col(f"_{c}{i}") * F.col(f"_{c}{j}") * 2**20)) / 2**20 / F.count(F.lit(1))).alias(f"_{c}{i}{j}")
    shapes = stored(
        near.groupBy("_group", "_language", *M, *SPREAD).agg(*[mean(c, i, j) for c in "ut" for i, j in PAIRS]), "shapes"
    )

    def start(number: int, shape) -> DataFrame:
        square = lambda i, j: shape(i, j) * F.col(SPREAD[i]) * F.col(SPREAD[j]) + F.col(M[i]) * F.col(M[j])
        return shapes.select(
            "_group", "_language", F.lit(number).alias("_start"), F.lit(1.0).alias("_n"), *M, *[square(i, j).alias(_a(i, j)) for i, j in PAIRS]
        )

    diagonal = lambda i: F.sqrt(F.greatest(F.col(f"_t{i}{i}"), F.lit(1e-9)))
    return reduce(
        DataFrame.union,
        [
            start(0, lambda i, j: F.lit(1.0 if i == j else 0.0)),
            start(1, lambda i, j: DIMENSIONS * F.col(f"_u{i}{j}")),
            start(2, lambda i, j: F.col(f"_t{i}{j}") / (diagonal(i) * diagonal(j))),
        ],
    )


def _step(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Sums over the nearest ``CORE`` of each group's rows by each start, in whole intervals of distance."""
    interval = F.rint(16 * F.log1p(F.greatest(F.lit(0.0), _distance()))).cast("int")
    near = _with_estimate(rows, estimates).groupBy(*KEYS, interval.alias("_interval")).agg(*_moments())
    every = W.partitionBy("_group", "_start")
    upto = every.orderBy("_interval").rowsBetween(W.unboundedPreceding, -1)
    near = near.withColumns({"_before": F.coalesce(F.sum("_n").over(upto), F.lit(0.0)), "_all": F.sum("_n").over(every)})
    return near.filter(F.col("_before") < CORE * F.col("_all")).groupBy(*KEYS).agg(*_sums(SUMMED))


def _least_determinant(rows: DataFrame) -> DataFrame:
    """The settled estimate of least determinant of each group (_group, _language, M, inverse scatter)."""
    core = stored(_estimates(_starts(rows), 1.0), "estimates")
    core = stored(_estimates(_step(rows, core), CONSISTENT), "estimates")
    while True:
        new = _estimates(_step(rows, core), CONSISTENT).select(*KEYS, F.struct(*ESTIMATE).alias("_new"))
        both = core.select(*KEYS, F.struct(*ESTIMATE).alias("_old")).join(new.hint("merge"), KEYS)
        falls = F.col("_new._logdet") < F.col("_old._logdet") - SETTLED
        both = stored(both.select(*KEYS, falls.alias("_falls"), F.when(falls, F.col("_new")).otherwise(F.col("_old")).alias("_e")), "estimates")
        core = both.select(*KEYS, "_e.*")
        if not both.agg(F.max("_falls")).first()[0]:
            break
    # starts that met in one core differ by rounding only: the first of them stands for it
    order = F.struct(F.rint(F.col("_logdet") * 1e6), "_start")
    least = core.groupBy("_group", "_language").agg(F.min_by(F.struct(*ESTIMATE), order).alias("_e"))
    return stored(least.select("_group", "_language", "_e.*").drop("_logdet"), "least")


def judged(docs: DataFrame, text: str = "text", language: str = "lang", source: str = "source", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with the counts, ``base_failed``, ``distance`` and ``kept``."""
    own = own_columns(docs, keep, [*COUNTS, "base_failed", "distance", "kept"])
    group = F.to_json(F.struct(F.col(language).alias("l"), F.col(source).alias("s")))
    within = F.to_json(F.struct(F.col(language).alias("l")))
    keyed = boxed(docs, own, _content=F.col(text), _group=group, _language=within)
    rows = stored(with_counts(keyed), "counts")
    rows = rows.withColumns(dict(zip(X, vector())))
    judged_rows = rows.filter(~F.col("base_failed")).select("_group", "_language", *X)
    far = _with_estimate(rows, _least_determinant(judged_rows))
    far = far.withColumn("_far", F.when(~F.col("base_failed"), F.greatest(F.lit(0.0), _distance())))
    kept = ~F.col("base_failed") & (F.coalesce("_far", F.lit(0.0)) <= LIMIT)
    return unboxed(far, own, *COUNTS, "base_failed", F.col("_far").alias("distance"), kept.alias("kept"))
