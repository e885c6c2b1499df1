"""Token counts by a two-tier lookup on the map side.

A byte-level BPE tokenizer first cuts a text into pre-tokens, and the tokens of a text are
those of its pre-tokens. The lengths of the most frequent pre-tokens go to every task as one
broadcast table of at most ``ENTRIES`` entries; a worker encodes the others with the library and
remembers them. Only the counts that choose the table are shuffled, a number for each pre-token and task.

The frequent pre-tokens are counted over all texts, in one job: every task of the scan counts those of its
share, Spark adds them up, and at most the ``ENTRIES`` commonest reach the driver. Only those of more than ``LONGEST`` characters are
left to the workers, so that the table is bounded in bytes too. The table only saves time: the counts are the same with
any table, or none.

The library's character classes are older than those of the ``regex`` module; they agree on the
characters in ``AGREED``, and texts of these are cut with their classes written out. A text with any other character is
encoded whole by the library, and needs no table.

Defined cases: a null or empty text has no bytes and no tokens; the special token's string inside a text
is one token, as by the library's default; texts of any length count whole; repeated rows stay; other columns
pass through, but a column with the name of the result is replaced.
"""

from __future__ import annotations

import os
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .caches import Recent, groups
from .common import content, discard, extended, own_columns, plus, stored, unboxed, with_content

ENTRIES = 65_536
LONGEST = 64  # characters of a pre-token that is kept in the table or by a worker
HELD = 8 * ENTRIES  # pre-tokens that a task counts before it hands them on
# Characters whose class is the same in old and new versions of Unicode.
AGREED = "\u0000-ԯ -⁤₠-₰←-⏿─-⟿　-〩ぁ-ゖ゠-ヿ一-龥가-힣！-～"
SPECIAL = "<|endoftext|>"


@cache
def _cutter() -> re.Pattern:
    """The pattern that splits a text of agreed characters into pre-tokens, by the library's rule."""
    agreed = re.compile(f"[{AGREED}]")
    characters = [c for c in map(chr, range(0x10000)) if agreed.match(c)]

    def of(kind: str) -> str:
        fits = regex.compile(kind).match
        return "".join(f"\\u{ord(c):04x}" for c in characters if fits(c))

    letter, number, space = of(r"\p{L}"), of(r"\p{N}"), of(r"\s")
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


class PretokenCounter:
    """Counts the tokens of texts; ``table``: lengths of frequent pre-tokens."""

    foreign = re.compile(f"[^{AGREED}]")

    def __init__(self, tokenizer: str, table: dict[str, int]):
        self.library = load(tokenizer)
        self.cut = _cutter()
        self.lengths = Recent(self.length, table, longest=LONGEST)

    def length(self, pretoken: str) -> int:
        return len(self.library.encode(pretoken, add_special_tokens=False))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; pre-tokens not yet known are encoded together."""
        cut: list[list[str] | int] = []
        for t in texts:
            if self.foreign.search(t):
                cut.append(len(self.library.encode(t, add_special_tokens=False)))
            elif SPECIAL in t:
                parts = t.split(SPECIAL)
                cut.append([x for p in parts for x in self.cut.findall(p)] + [SPECIAL] * (len(parts) - 1))
            else:
                cut.append(self.cut.findall(t))
        new = set().union(*[c for c in cut if not isinstance(c, int)]).difference(self.lengths)
        if new:
            short = [x for x in new if len(x) <= self.lengths.longest]
            fresh = dict(zip(short, map(len, self.library.encode_batch_fast(short, add_special_tokens=False))))
            for x, n in fresh.items():
                if len(self.lengths) < self.lengths.most:
                    self.lengths[x] = n
            lookup = Recent(self.length, fresh, most=0)
            known = self.lengths
            return [c if isinstance(c, int) else sum(known[x] if x in known else lookup[x] for x in c) for c in cut]
        return [c if isinstance(c, int) else sum(map(self.lengths.__getitem__, c)) for c in cut]


def load(tokenizer: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use every core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)


def _pretoken_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pre-tokens of the texts that are cut, and how often each occurs; one that is met again later has more rows."""
    cut, seen = _cutter(), Counter()

    def out() -> Iterator[pa.RecordBatch]:
        names, counts = list(seen), list(seen.values())
        for i in range(0, len(names), ENTRIES):
            columns = [pa.array(names[i : i + ENTRIES], pa.string()), pa.array(counts[i : i + ENTRIES], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "n"])
        seen.clear()

    for batch in batches:
        for text in batch.column(0):
            t = text.as_py()
            if t and not PretokenCounter.foreign.search(t):
                for part in t.split(SPECIAL):
                    seen.update(cut.findall(part))
            if len(seen) > HELD:
                yield from out()
    if seen:
        yield from out()


def frequent_lengths(docs: DataFrame, tokenizer: str, text: str = "text") -> dict[str, int]:
    """Lengths of the commonest pre-tokens of all texts; all tasks of the scan count their share at once.

    They are those found more often than a number that leaves at most ``ENTRIES``. It is read off a histogram, so that no
    more than these reach the driver; counts beyond 4,095 are rounded down to 12 binary digits for it.
    """
    parts = docs.select(text).mapInArrow(_pretoken_counts, "name string, n bigint").filter(F.length("name") <= LONGEST)
    zeros = "greatest(length(bin(n)) - 12, 0)"
    total = parts.groupBy("name").agg(F.sum("n").alias("n")).withColumn("n", F.expr(f"shiftleft(shiftright(n, {zeros}), {zeros})"))
    total = stored(total, "pretokens")
    least, kept = 1, 0
    for n, names in sorted(total.groupBy("n").count().collect(), reverse=True):
        kept += names
        if kept > ENTRIES:
            least = n + 1
            break
    found = sorted((-r.n, r.name) for r in total.filter(F.col("n") >= least).collect())
    discard(total)
    names = [name for _, name in found]
    library = load(tokenizer)
    return dict(zip(names, map(len, library.encode_batch_fast(names, add_special_tokens=False))))


def counted(
    docs: DataFrame, tokenizer: str, table: dict[str, int], text: str = "text", to: str = "n_tokens", keep: Sequence[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (all by default) with the number of tokens of each whole text."""
    packed = docs.sparkSession.sparkContext.broadcast(zlib.compress(pickle.dumps(table)))
    own = own_columns(docs, keep, [to])
    rows = with_content(docs, own, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer, packed.value)
        for batch in batches:
            counter.lengths.trim()
            texts = (t.as_py() for t in content(batch, own, text))
            n = [x for group in groups(texts) for x in counter.count(group)]
            yield extended(batch, _count=pa.array(n, pa.int64()))

    return unboxed(rows.mapInArrow(run, plus(rows, _count="bigint")), own, F.col("_count").alias(to))


_COUNTERS: dict[tuple, PretokenCounter] = {}


def _counter(tokenizer: str, packed: bytes) -> PretokenCounter:
    """One counter for each worker, tokenizer and table, whatever the number of tasks."""
    key = (tokenizer, hash(packed))
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PretokenCounter(tokenizer, pickle.loads(zlib.decompress(packed)))
    return _COUNTERS[key]
