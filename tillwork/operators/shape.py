"""Flatten, explode, union, conform and reorder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingColumns(ValueError):
    """A source lacks columns a report cannot do without."""


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise before any job starts when a required column is absent."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise MissingColumns(f"missing columns {absent}; available {df.columns}")
    return df


KEEP_NULLS = {"ignoreNullFields": "false"}


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every nested object becomes columns named by its path; arrays stay as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, here)
            else:
                column = reduce(lambda c, part: c.getField(part), here[1:], F.col(f"`{here[0]}`"))
                out.append(column.alias(sep.join(here)))
        return out

    return df.select(*leaves(df.schema, ()))


def explode_objects(
    df: DataFrame, array: str, prefix: str, outer: bool = True, drop_null: bool = False
) -> DataFrame:
    """One row per element of an array of objects, its fields prefixed.

    ``outer`` keeps a row without elements once, with missing element fields;
    ``drop_null`` first removes rows whose array itself is missing.
    """
    if drop_null:
        df = df.filter(F.col(array).isNotNull())
    element = df.schema[array].dataType.elementType
    rest = [c for c in df.columns if c != array]
    explode = F.explode_outer if outer else F.explode
    rows = df.select(*rest, explode(array).alias("_element"))
    if not outer:
        rows = rows.filter(F.col("_element").isNotNull())
    fields = [F.col("_element").getField(f.name).alias(f"{prefix}{f.name}") for f in element.fields]
    return rows.select(*rest, *fields)


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column absent on one side is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tag(df: DataFrame, **constants: object) -> DataFrame:
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in constants.items()})


def safe_headers(names: Sequence[object], normalise: bool = True) -> list[str]:
    """Trimmed (lower-case, without spaces) unique headers; blanks and repeats are numbered by position."""
    out: list[str] = []
    for i, raw in enumerate(names):
        name = str(raw if raw is not None else "").strip()
        if normalise:
            name = name.lower().replace(" ", "")
        name = name or f"blank_col_{i}"
        out.append(f"{name}_{i}" if name in out else name)
    return out


def pad_ragged(df: DataFrame, cells: str, headers: Sequence[str], fill: str = "") -> DataFrame:
    """An array of cells to one column per header: short rows are filled, long rows cut."""
    rest = [c for c in df.columns if c != cells]
    return df.select(
        *rest, *[F.coalesce(F.get(F.col(cells), F.lit(i)), F.lit(fill)).alias(h) for i, h in enumerate(headers)]
    )


def conform(
    df: DataFrame,
    schema: T.StructType,
    defaults: Mapping[str, object] | None = None,
    keep_extra: bool = False,
) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    An absent column is its default (NULL without one); a value that does not
    cast is missing. Unknown columns are dropped, or kept as JSON in ``_extra``.
    """
    defaults = defaults or {}
    columns = []
    for f in schema.fields:
        if f.name not in df.columns:
            column = F.lit(defaults.get(f.name)).cast(f.dataType)
        else:
            column = F.col(f"`{f.name}`")
            if df.schema[f.name].dataType != f.dataType:
                column = column.try_cast(f.dataType)
            if f.name in defaults:
                column = F.coalesce(column, F.lit(defaults[f.name]).cast(f.dataType))
        columns.append(column.alias(f.name))
    if keep_extra:
        unknown = [c for c in df.columns if c not in schema.fieldNames()]
        extra = F.to_json(F.struct(*[F.col(f"`{c}`") for c in unknown]), KEEP_NULLS) if unknown else F.lit(None).cast("string")
        columns.append(extra.alias("_extra"))
    return df.select(*columns)


def lead(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns that exist first, the rest in their order."""
    first = [c for c in columns if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def relabel(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(labels))


def first_present(df: DataFrame, names: Sequence[str]) -> Column:
    """First non-missing value among those of ``names`` the frame has."""
    have = [F.col(f"`{n}`") for n in names if n in df.columns]
    if not have:
        raise MissingColumns(f"none of {list(names)}; available {df.columns}")
    return F.coalesce(*have) if len(have) > 1 else have[0]


def detect_column(columns: Sequence[str], *needles: str) -> str | None:
    """First column whose name contains one of the needles."""
    return next((c for c in columns if any(n in c for n in needles)), None)


def json_text(df: DataFrame) -> DataFrame:
    """Arrays, maps and objects become JSON text, missing fields as null; other columns are untouched."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(f"`{f.name}`", KEEP_NULLS).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def merge_twins(df: DataFrame, left: str = "_x", right: str = "_y") -> DataFrame:
    """name_x / name_y left by a collision become one ``name``: left value, else right."""
    twins = {c[: -len(left)] for c in df.columns if c.endswith(left) and c[: -len(left)] + right in df.columns}
    out, done = [], set()
    for c in df.columns:
        base = c[: -len(left)] if c.endswith(left) else c[: -len(right)] if c.endswith(right) else None
        if base in twins:
            if base not in done:
                out.append(F.coalesce(F.col(base + left), F.col(base + right)).alias(base))
                done.add(base)
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def unwrap_envelope(df: DataFrame, names: Sequence[str] = ("data", "transactions", "timings")) -> DataFrame:
    """Payload rows of a response: the first non-empty list among ``names``, one row per element.

    Each page of a branch-day is its own envelope row, so pages unite by themselves.
    An array column named ``_list`` holds the records of a response that is a bare list.
    """
    lists = [F.when(F.size(n) > 0, F.col(n)) for n in (*names, "_list") if n in df.columns]
    rest = [c for c in df.columns if c not in (*names, "_list")]
    return df.select(*rest, F.inline(F.coalesce(*lists)))


def latest_lookup(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """key -> value of the last row by ``order``; ties by the larger value."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(order, value)).getField(value).alias(value))
    )


def nest(df: DataFrame, keys: Sequence[str], array: str) -> DataFrame:
    """Rows to documents: one per key, its rows as an array of objects.

    A document holds all rows of its key, so make the keys fine enough: where one could have very many
    rows, add a key of the data that splits it (a page or line range), and a document is one such part.
    """
    fields = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.collect_list(F.struct(*fields)).alias(array))
