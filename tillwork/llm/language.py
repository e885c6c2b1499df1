"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence about the language of a row are combined as log probabilities: the
likelihood of its text, the language its markup declares, the suffix of its address, and a prior
from its host.

- Text: hashed byte trigrams of lower-cased letters against a profile of each language, learned from
  all labelled rows. Neighbouring trigrams are not independent, so the
  likelihood is tempered: ``1 / SHARED`` of it counts, and no more than that of ``MOST`` trigrams. All bytes are read.
- Declared language and suffix: how often a value goes with a language, as the text alone decides,
  over all rows.
- Host: the languages of the host's other rows, smoothed by those of its domain, and these by those
  of all rows. A row's own vote is taken out of each.

``und`` is a class of its own: texts that no profile explains better than even odds for all trigrams.

The text is read once; what follows works on a slim written table, grouped aggregations of it, and joins
with those. Rows of one host or value are summed up map-side and never brought together. Profiles are a written table of
counts; ``LABELS`` languages at a time become one broadcast and one pass over a task's rows, so neither the driver nor a
pass holds more of them, and the plan does not grow with their number. A row of the slim table has one number for each language.

Defined cases: null and empty texts have no text evidence, and without trigrams the language is ``und``;
null evidence counts for nothing; ties go to the language that sorts first; every label has a profile, by its primary
tag (``en`` of ``en-GB``) if it is one, and if any of its rows has a trigram;
without labelled rows every row is ``und``; repeated rows are judged alike; other columns pass
through, but columns with the names of the results are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import source_bytes
from .common import content, extended, own_columns, plus, stored, unboxed, with_content
from .words import BLOCK_BYTES, LOWERED, buffers

HELD_LABELS = 128  # labels whose counts a task holds before it hands them on
LABELS = 256  # languages whose profiles are in memory at a time, 64 KB each
SLOTS = 1 << 14
SHARED, MOST = 3.0, 600
NEAR = 20.0  # rows' weight of the wider group in a host's prior
TABLE_BYTES = 32 * 1024 * 1024  # evidence tables are broadcast up to this measured size
LEAST_POSTERIOR = 0.5
UNKNOWN = "und"
UNKNOWN_PRIOR = 0.01

LETTER = np.full(256, 0x20, dtype=np.uint8)  # what is no letter is a space
LETTER[97:123] = np.arange(97, 123)
LETTER[128:] = np.arange(128, 256)


def trigrams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, text of each trigram, its slot) in blocks of texts; trigrams with two spaces at one side are left out."""
    data, offsets = buffers(texts)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1)
        last = min(last, n)
        b = LETTER[LOWERED[data[offsets[first] : offsets[last]]]].astype(np.uint32)
        at = offsets[first : last + 1] - offsets[first]
        doc = np.repeat(np.arange(last - first), np.diff(at))
        if len(b) >= 3:
            code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
            full = (doc[:-2] == doc[2:]) & (b[1:-1] != 32)
            code, doc = code[full], doc[:-2][full]
            yield first, doc, ((code * np.uint32(2654435769)) >> np.uint32(18)).astype(np.int64)
        else:
            yield first, doc[:0], np.zeros(0, dtype=np.int64)
        first = last


@dataclass
class Profiles:
    """Languages in order, the last being ``und``, and the table of counts (label, slot, n) of all others."""

    languages: list[str]
    counts: DataFrame

    def blocks(self) -> Iterator[np.ndarray]:
        """Log probability of each slot, a row for each language, ``LABELS`` languages at a time."""
        for first in range(0, len(self.languages), LABELS):
            names = [x for x in self.languages[first : first + LABELS] if x != UNKNOWN]
            total = np.zeros((len(names), SLOTS))
            if names:
                found = self.counts.filter(F.col("label").between(names[0], names[-1])).toArrow()
                of = pc.index_in(found.column("label"), value_set=pa.array(names, pa.string())).to_numpy()
                total[of, found.column("slot").to_numpy()] = found.column("n").to_numpy()
            log = np.log((total + 0.5) / (total.sum(axis=1, keepdims=True) + 0.5 * SLOTS)).astype(np.float32)
            if first + LABELS >= len(self.languages):
                log = np.vstack([log, np.full((1, SLOTS), -np.log(SLOTS), dtype=np.float32)])
            yield log

    @property
    def log(self) -> np.ndarray:
        """All blocks in one, for few languages."""
        return np.vstack(list(self.blocks()))


def trained(labelled: DataFrame, text: str = "text", label: str = "lang") -> Profiles:
    """A profile of every label, from all rows with a label; the counts are summed by label and slot in Spark."""
    tag = F.col(label).cast("string")
    name = F.coalesce(primary(tag), F.nullif(F.lower(F.trim(tag)), F.lit("")))  # a label that is no tag stands for itself
    known = labelled.select(name.alias("label"), F.col(text).alias("text")).dropna().filter(F.col("label") != UNKNOWN)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def sums() -> Iterator[pa.RecordBatch]:
            for name, n in held.items():
                slot = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({"label": pa.array([name] * len(slot), pa.string()), "slot": pa.array(slot), "n": pa.array(n[slot])})
            held.clear()

        for batch in batches:
            names, of_row = np.unique(np.array(batch.column(0).to_pylist(), dtype=object), return_inverse=True)
            for first, doc, slot in trigrams(batch.column(1)):
                of = of_row[first + doc]
                order = np.argsort(of, kind="stable")
                of, slot = of[order], slot[order]
                for k in np.unique(of):
                    if names[k] not in held and len(held) == HELD_LABELS:
                        yield from sums()
                    n = held.setdefault(names[k], np.zeros(SLOTS, np.int64))
                    n += np.bincount(slot[np.searchsorted(of, k) : np.searchsorted(of, k, side="right")], minlength=SLOTS)
        yield from sums()

    counts = stored(known.mapInArrow(count, "label string, slot bigint, n bigint").groupBy("label", "slot").agg(F.sum("n").alias("n")), "profiles")
    names = sorted(r[0] for r in counts.select("label").distinct().collect())
    return Profiles([*names, UNKNOWN], counts)


def likelihoods(rows: DataFrame, profiles: Profiles, text: str, own: list[str]) -> DataFrame:
    """Boxed rows with ``_n`` (trigrams) and ``_text``: the tempered log likelihood by language, one pass for each block of them."""
    rows = rows.withColumns({"_n": F.lit(0).cast("bigint"), "_text": F.array().cast("array<double>")})
    for first, log in zip(range(0, len(profiles.languages), LABELS), profiles.blocks()):
        last = first + len(log) == len(profiles.languages)
        packed = rows.sparkSession.sparkContext.broadcast(log)
        rows = rows.mapInArrow(_pass(packed, own, text, first, last), plus(rows) if last else rows.schema)
    return rows


def _pass(packed, own: list[str], text: str, known: int, last: bool):
    """Adds the likelihoods of a block of languages to those ``known``; the text beside the rows goes with the last pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log = packed.value
        for batch in batches:
            total, n = np.zeros((batch.num_rows, len(log))), np.zeros(batch.num_rows, dtype=np.int64)
            for first, doc, slot in trigrams(content(batch, own, text)):
                if len(doc):
                    here = int(doc[-1]) + 1
                    n[first : first + here] = np.bincount(doc, minlength=here)
                    for k in range(len(log)):
                        total[first : first + here, k] = np.bincount(doc, weights=log[k][slot], minlength=here)
            total *= (np.minimum(1.0, MOST / np.maximum(n, 1)) / SHARED)[:, None]
            if known:
                total = np.hstack([batch.column("_text").flatten().to_numpy().reshape(-1, known), total])
            values = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), known + len(log)).cast(pa.list_(pa.float64()))
            found = {"_n": pa.array(n), "_text": values}
            if not last and text not in own:
                found["_content"] = batch.column("_content")
            out = extended(batch, **found)
            yield out.select([c for c in batch.schema.names if c in out.schema.names])

    return run


def _votes(rows: DataFrame, by: str, size: int) -> DataFrame:
    """For each value of ``by`` the number of rows whose text alone speaks for each language."""
    cells = rows.groupBy(by, "_vote").agg(F.count(F.lit(1)).cast("double").alias("_rows"))
    found = cells.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("_vote", "_rows"))).alias("_found"))
    return found.select(by, F.transform(_every(size), lambda k: F.coalesce(F.try_element_at("_found", k), F.lit(0.0))).alias("_counts"))


def _every(size: int) -> Column:
    return F.sequence(F.lit(0), F.lit(size - 1))


def _fixed(values: list, kind: str) -> Column:
    """The values as one literal of the plan, however many they are."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def _joined(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    table = stored(table, "evidence")
    return rows.join(F.broadcast(table) if source_bytes(table) <= TABLE_BYTES else table, on, "left")


def fused(
    docs: DataFrame,
    profiles: Profiles,
    text: str = "text",
    declared: Column | None = None,
    suffix: Column | None = None,
    host: Column | None = None,
    domain: Column | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all by default) with ``language``, ``posterior`` and ``language_kept``."""
    names = ("language", "posterior", "language_kept")
    own = own_columns(docs, keep, names)
    size = len(profiles.languages)
    nothing = F.lit(None).cast("string")
    evidence = {"_declared": declared, "_suffix": suffix, "_host": host, "_domain": domain}
    given = with_content(docs, own, text, **{k: nothing if v is None else v.cast("string") for k, v in evidence.items()})
    rows = stored(likelihoods(given, profiles, text, own), "likelihoods")
    best = F.array_position("_text", F.array_max("_text")).cast("int") - 1
    rows = rows.withColumn("_vote", F.when(F.col("_n") > 0, best).otherwise(size - 1))

    found = dict(rows.groupBy("_vote").agg(F.count(F.lit(1))).collect())  # a number for each language
    every = [float(found.get(k, 0)) for k in range(size)]
    total = sum(every)
    odds = [UNKNOWN_PRIOR if k == size - 1 else (every[k] + 1) / (total + size) for k in range(size)]
    overall = _fixed(odds, "double")
    none = F.array_repeat(F.lit(0.0), size)

    # how a declared language or suffix is spread over its rows' languages, against all rows
    logs = [F.col("_text")]
    for name in ("_declared", "_suffix"):
        table = _votes(rows.filter(F.col(name).isNotNull()), name, size)
        of = _fixed([c + size for c in every], "double")
        chance = F.zip_with(F.col("_counts"), of, lambda c, n: F.log((c + 0.5) / n))
        rows = _joined(rows, table.select(name, chance.alias(f"{name}_log")), [name])
        logs.append(F.coalesce(f"{name}_log", none))

    # host within domain within all rows, each without the row's own vote
    prior = overall
    for by in (["_domain"], ["_domain", "_host"]):
        key = F.to_json(F.struct(*by)).alias("_key")
        known = rows.withColumn("_key", F.when(F.col(by[-1]).isNotNull(), key))
        table = _votes(known.filter(F.col("_key").isNotNull()), "_key", size)
        counts = f"_votes{by[-1]}"
        rows = _joined(known, table.withColumnRenamed("_counts", counts), ["_key"]).drop("_key")
        others = F.coalesce(F.transform(counts, lambda c, k: c - F.when(k == F.col("_vote"), 1.0).otherwise(0.0)), none)
        n = F.aggregate(others, F.lit(0.0), lambda a, b: a + b)
        rows = rows.withColumns({f"{counts}_others": others, f"{counts}_n": n})
        prior = F.zip_with(F.col(f"{counts}_others"), prior, _smoothed(F.col(f"{counts}_n")))
        rows = rows.withColumn(f"{counts}_prior", prior)
        prior = F.col(f"{counts}_prior")
    logs.append(F.transform(prior, lambda p: F.log(p)))

    score = logs[0]
    for more in logs[1:]:
        score = F.zip_with(score, more, lambda a, b: a + b)
    rows = rows.withColumn("_score", score).withColumn("_most", F.array_max("_score"))
    at = F.array_position("_score", F.col("_most")).cast("int")
    spread = F.aggregate("_score", F.lit(0.0), lambda a, s: a + F.exp(s - F.col("_most")))
    named = F.element_at(_fixed(profiles.languages, "string"), at)
    language = F.when(F.col("_n") > 0, named).otherwise(F.lit(UNKNOWN))
    posterior = F.when(F.col("_n") > 0, 1 / spread).otherwise(1.0)
    out = rows.select("_row", language.alias("_language"), posterior.alias("_posterior"))
    kept = (F.col("_language") != UNKNOWN) & (F.col("_posterior") >= LEAST_POSTERIOR)
    return unboxed(out, own, F.col("_language").alias("language"), F.col("_posterior").alias("posterior"), kept.alias("language_kept"))


def _smoothed(n: Column):
    return lambda votes, wider: (votes + NEAR * wider) / (n + NEAR)


def primary(tag: Column) -> Column:
    """``en`` of ``en-GB``."""
    return F.nullif(F.lower(F.regexp_extract(tag, r"^\s*([A-Za-z]{2,3})", 1)), F.lit(""))


def declared_in(html: Column) -> Column:
    """The language that the ``html`` element declares."""
    return primary(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1))


def text_of(html: Column) -> Column:
    """Markup, scripts and character references as spaces."""
    return F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&#?\w+;", " ")


def suffix_of(host: Column) -> Column:
    """The last label of a host."""
    return F.nullif(F.regexp_extract(host, r"([^.]+)$", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit(""))
