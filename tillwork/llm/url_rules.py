"""URL filter lists: host-suffix and path-prefix expressions, short digests, rule precedence.

Every URL is expanded into the expressions a rule could be written as: each suffix of
its host at a label boundary with each prefix of its path that ends in ``/``, and the empty prefix.
Expressions meet the rules in an equi-join on the first bytes of their digest, the
full digest confirms, and the longest fitting rule decides.

Paths are expanded no deeper than the deepest rule and hosts no longer than the rule
with the most labels: other expressions cannot equal a rule's. Only distinct
(host, path) pairs are expanded and judged, so a URL that fills a third of the table is
judged once, and the verdicts join back by pair.

Defined cases: a null URL or one without ``://`` has empty host and path and fits no rule;
rules without host or action are void; of several rules that fit with equal length, ``block``
wins, then the smaller text; repeated rows stay; other columns of the pages pass through;
an empty rule table lets the default decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized, source_bytes
from .common import boxed, lower_ascii, own_columns, stored, unboxed

SHORT = 8  # hex digits of the digest that are joined on
RULE_BYTES = 32 * 1024 * 1024  # rules are broadcast up to this measured size


def host_of(url: Column | str) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(rest), F.lit(""))


def path_of(url: Column | str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def folder_of(path: Column) -> Column:
    """The part of a rule's path up to its last ``/``: the prefix its URLs are expanded to."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), folder), 256)


def prepared(rules: DataFrame) -> DataFrame:
    """(host, path, action) as the joinable rule table."""
    known = rules.filter(F.col("host").isNotNull() & (F.col("host") != "") & F.col("action").isNotNull())
    host, path = lower_ascii("host"), F.coalesce("path", F.lit(""))
    digest = _digest(F.col("rule_host"), folder_of(F.col("rule_path")))
    return (
        known.select(host.alias("rule_host"), path.alias("rule_path"), F.lower("action").alias("action"))
        .distinct()
        .withColumn("full", digest)
        .withColumn("short", F.substring("full", 1, SHORT))
    )


def host_suffixes(host: Column, labels: Column) -> Column:
    """``a.b.c`` -> [a.b.c, b.c, c], those of at most ``labels`` labels."""
    parts = F.split(host, r"\.", -1)
    n = F.size(parts)
    first = F.greatest(F.lit(1), n - labels + 1)
    return F.transform(F.sequence(first, n), lambda i: F.array_join(F.slice(parts, i, n), "."))


def path_prefixes(path: Column, depth: Column) -> Column:
    """``/en/7/x`` -> ["", /, /en/, /en/7/], of at most ``depth`` slashes."""
    parts = F.split(path, "/", -1)
    most = F.least(F.size(parts) - 1, depth)
    return F.transform(
        F.sequence(F.lit(0), most),
        lambda i: F.when(i > 0, F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))).otherwise(F.lit("")),
    )


def candidates(spread: DataFrame, rules: DataFrame) -> DataFrame:
    """Expressions of URLs with the rules that fit: met by the short digest, then confirmed by the full one and the whole path.

    The confirmation is no equality to the optimizer, which would join on the full digest instead.
    """
    confirmed = F.col("_full").startswith(F.col("full")) & F.col("_path").startswith(F.col("rule_path"))
    return spread.join(rules, "short").filter(confirmed)


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    ``rules``: host, path, action. Columns of these four names in ``pages`` are replaced.
    """
    rules = stored(prepared(rules), "rules")  # written, so that their size is known
    reach = rules.agg(
        F.coalesce(F.max(F.size(F.split("rule_host", r"\.", -1))), F.lit(0)).alias("labels"),
        F.coalesce(F.max(F.size(F.split(folder_of(F.col("rule_path")), "/", -1)) - 1), F.lit(0)).alias("depth"),
    ).first()
    own = own_columns(pages, None, ["host", "path", "rule", "verdict"])
    pages = boxed(pages, own, _host=host_of(f"`{url}`"), _path=path_of(f"`{url}`"))
    pairs = pages.select("_host", "_path").filter("_host <> ''").distinct()
    spread = (
        pairs.withColumn("_suffix", F.explode(host_suffixes(F.col("_host"), F.lit(reach["labels"]))))
        .withColumn("_prefix", F.explode(path_prefixes(F.col("_path"), F.lit(reach["depth"]))))
        .withColumn("_full", _digest(F.col("_suffix"), F.col("_prefix")))
        .withColumn("short", F.substring("_full", 1, SHORT))
    )
    if source_bytes(rules) <= RULE_BYTES:
        rules = F.broadcast(rules)
    text = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(text), (F.col("action") == "block").cast("int"), F.length("rule_host"))
    fitting = (
        candidates(spread, rules)
        .groupBy("_host", "_path")
        .agg(F.max(F.struct(rank, text.alias("rule"), "action")).alias("best"))
        .select("_host", "_path", "best.rule", F.col("best.action").alias("_action"))
    )
    # written, so that it is broadcast or met row by row as its measured size says; pages without a host meet nothing
    fitting = sized(stored(fitting, "fitting"), "fitting")
    nameless = pages.filter("_host = ''").withColumns({"rule": F.lit(None).cast("string"), "_action": F.lit(None).cast("string")})
    met = pages.filter("_host <> ''").join(fitting, ["_host", "_path"], "left")
    return unboxed(
        met.unionByName(nameless),
        own,
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        "rule",
        F.coalesce("_action", F.lit(default)).alias("verdict"),
    )
