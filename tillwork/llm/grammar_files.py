"""Token ids in files compressed by Re-Pair, with random access.

Ids of documents are written in ascending order of a key, in blocks of about ``BLOCK_IDS`` ids. In each
block the frequent pairs of neighbouring symbols are replaced by new symbols, round by round, until no
pair occurs ``LEAST`` times or no symbols are left: a round counts all pairs, takes the most frequent
ones and replaces their occurrences from left to right. After the first round only pairs that
were frequent and those with a new symbol are counted, as others can't become frequent. Each round makes the block shorter, and a pair that
a round leaves for want of a slot is met by the next one. No pair spans two documents, so a document
starts at a symbol.

A block is one row of a Parquet table: a task that is run again writes the same rows, and the blocks
can lie in any store that Spark writes to. Its columns:

    part, seq    order of the blocks
    docs, ids    number of documents and ids in it
    keys         the documents' keys, little-endian int64
    sizes        ids of each document, little-endian uint32
    symbols      symbols of each document after compression, little-endian uint32
    base         the first new symbol; smaller ones are ids
    rules        two symbols for each new one, in ``width`` bytes each
    lengths      ids that each new symbol stands for, little-endian uint32
    sequence     the compressed symbols, in ``width`` bytes each

``ids_between`` decodes any range of a block's ids: the expansion lengths tell which symbols to
expand. Defined cases: null and empty texts have the end id alone; rows without key come first; rows of
equal key are ordered by a hash of their text and then by the text; an empty table writes no block.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_dir
from .caches import Recent
from .token_counts import load

BLOCK_IDS = 1 << 21
LEAST = 24  # occurrences that make a pair worth a rule
PER_ROUND = 4096
SLOTS = 1 << 18
FILE = (
    "part int, seq int, docs int, ids bigint, keys binary, sizes binary, symbols binary, "
    "base int, width int, rules binary, lengths binary, sequence binary"
)


# --- grammar ---------------------------------------------------------------


def compress(ids: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, whether a symbol ends a document, rules) of ids below ``base``."""
    narrow = base + PER_ROUND <= 1 << 16  # symbols fit into 16 bits, with room for rules
    room = (1 << 16) - base if narrow else 1 << 20
    seq, rules, begun = ids.astype(np.uint32), [], 0
    # places whose pair may be frequent; the others' pairs are not, and can only become rarer
    open_ = np.flatnonzero(~last[:-1])
    while room > 0 and len(open_):
        if narrow:
            code = (seq[open_] << np.uint32(16)) | seq[open_ + 1]
        else:
            code = (seq[open_].astype(np.uint64) << np.uint64(32)) | seq[open_ + 1]
        ordered = np.sort(code)
        edge = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        times = np.diff(np.append(edge, len(ordered)))
        often = times >= LEAST
        frequent, times = ordered[edge[often]], times[often]
        if not len(frequent):
            break
        take = np.argsort(-times, kind="stable")[: min(room, PER_ROUND)]
        # a table by hash finds the rule of a pair; of pairs that share a slot the more frequent one keeps it
        _, first = np.unique(_slot(frequent[take]), return_index=True)
        take = take[np.sort(first)]
        pairs = frequent[take]
        table = np.full(SLOTS, -1, dtype=np.int32)
        table[_slot(pairs)] = np.arange(len(pairs))
        place = _slot(code)
        rule = table[place]
        found = np.flatnonzero(rule >= 0)
        found = found[pairs[rule[found]] == code[found]]
        # of overlapping occurrences, every second one from the left
        hit = open_[found]
        starts = np.concatenate(([True], np.diff(hit) > 1))
        nth = np.arange(len(hit))
        second = (nth - np.maximum.accumulate(np.where(starts, nth, 0))) % 2 == 0
        found, hit = found[second], hit[second]
        seq[hit] = (base + begun + rule[found]).astype(np.uint32)
        last[hit] = last[hit + 1]
        # next are the pairs that were left, and those of new symbols with their neighbours
        left = np.zeros(SLOTS, dtype=bool)
        left[_slot(np.delete(frequent, take))] = True
        new, kept, again = np.zeros((3, len(seq)), dtype=bool)
        new[hit] = True
        again[open_[left[place]]] = True
        kept[:] = True
        kept[hit + 1] = False
        seq, last, new, again = seq[kept], last[kept], new[kept], again[kept]
        again |= new
        again[:-1] |= new[1:]
        open_ = np.flatnonzero(again[:-1] & ~last[:-1])
        half = np.uint32(16) if narrow else np.uint64(32)
        mask = code.dtype.type((1 << int(half)) - 1)
        rules.append(np.stack([pairs >> half, pairs & mask], axis=1).astype(np.uint32))
        begun += len(pairs)
        room -= len(pairs)
    return seq, last, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def _slot(code: np.ndarray) -> np.ndarray:
    if code.dtype == np.uint32:
        return (code * np.uint32(0x9E3779B1)) >> np.uint32(14)
    return (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)


def expansions(rules: np.ndarray, base: int) -> list[np.ndarray]:
    """The ids that each new symbol stands for."""
    out: list[np.ndarray] = []
    for left, right in rules.tolist():
        out.append(
            np.concatenate(
                [out[s - base] if s >= base else np.array([s], dtype=np.uint32) for s in (left, right)]
            )
        )
    return out


def expand(sequence: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids of a sequence of symbols."""
    new = expansions(rules, base)
    pool = np.concatenate([np.arange(base, dtype=np.uint32), *new])
    size = np.concatenate([np.ones(base, dtype=np.int64), np.array([len(x) for x in new], dtype=np.int64)])
    begin = np.cumsum(size) - size
    n = size[sequence]
    return pool[np.repeat(begin[sequence] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def ids_between(block: dict, first: int, stop: int) -> np.ndarray:
    """Ids ``first`` to ``stop`` (excluded) of a block, expanding only the symbols that cover them."""
    base, kind = block["base"], f"<u{block['width']}"
    sequence = np.frombuffer(block["sequence"], dtype=kind).astype(np.int64)
    rules = np.frombuffer(block["rules"], dtype=kind).reshape(-1, 2)
    size = np.ones(len(sequence), dtype=np.int64)
    new = sequence >= base
    size[new] = np.frombuffer(block["lengths"], dtype="<u4")[sequence[new] - base]
    end = np.cumsum(size)
    low, high = np.searchsorted(end, first, side="right"), np.searchsorted(end, stop, side="left") + 1
    out: list[int] = []
    stack = sequence[low:high][::-1].tolist()
    while stack:
        s = stack.pop()
        if s < base:
            out.append(s)
        else:
            stack += [int(rules[s - base, 1]), int(rules[s - base, 0])]
    skip = first - (int(end[low - 1]) if low else 0)
    return np.array(out[skip : skip + stop - first], dtype=np.uint32)


# --- encoding --------------------------------------------------------------


class ChunkEncoder:
    """Ids of texts from those of their chunks, for tokenizers that drop white space before splitting into words.

    A text is cut at spaces and line feeds only. Chunks of Latin letters and closing punctuation are what the
    library's normalizer and pattern would make one word and one sign of, so they go to the library's merges
    directly, lower-cased; other chunks go through the whole library.
    """

    # Latin letters whose lower case and normal form are simple.
    LATIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)\Z")

    def __init__(self, tokenizer: str):
        self.library = load(tokenizer)
        self.merges = self.library.model
        # the tokenizer writes each byte as a letter; these are of two bytes each
        written = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        other = [b for b in range(256) if b not in written]
        letter = {b: chr(b) for b in written} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.letters = {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
        self.known = Recent(self.make, most=800_000)

    def make(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha() and chunk.islower():
            return self.word(chunk)
        simple = self.LATIN.match(chunk)
        if not simple:
            return array("I", self.library.encode(chunk, add_special_tokens=False).ids).tobytes()
        word, sign = simple.groups()
        core = word.lower()
        if core == chunk:
            return self.word(core)
        ids = self.known.get(core)
        if ids is None:
            ids = self.known.keep(core, self.word(core))
        return ids + self.known[sign] if sign else ids

    def word(self, core: str) -> bytes:
        written = core if core.isascii() else core.translate(self.letters)
        return array("I", [token.id for token in self.merges.tokenize(written)]).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, text.replace("\n", " ").split(" ")))


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(tokenizer: str) -> ChunkEncoder:
    if tokenizer not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer] = ChunkEncoder(tokenizer)
    return _ENCODERS[tokenizer]


# --- files -----------------------------------------------------------------


def _block(part: int, seq: int, keys: list[int], sizes: list[int], ids: np.ndarray, vocabulary: int) -> pa.RecordBatch:
    ends = np.cumsum(np.array(sizes, dtype=np.int64))
    last = np.zeros(len(ids), dtype=bool)
    last[ends - 1] = True
    sequence, last, rules = compress(ids, last, vocabulary)
    width = 2 if vocabulary + len(rules) <= 1 << 16 else 4
    kind = f"<u{width}"
    symbols = np.diff(np.concatenate(([-1], np.flatnonzero(last))))
    length = np.ones(vocabulary + len(rules), dtype=np.uint32)
    for i, (left, right) in enumerate(rules.tolist()):
        length[vocabulary + i] = length[left] + length[right]
    row = {
        "part": part,
        "seq": seq,
        "docs": len(keys),
        "ids": len(ids),
        "keys": np.array(keys, dtype="<i8").tobytes(),
        "sizes": np.array(sizes, dtype="<u4").tobytes(),
        "symbols": symbols.astype("<u4").tobytes(),
        "base": vocabulary,
        "width": width,
        "rules": rules.astype(kind).tobytes(),
        "lengths": length[vocabulary:].astype("<u4").tobytes(),
        "sequence": sequence.astype(kind).tobytes(),
    }
    return pa.RecordBatch.from_pylist([row], schema=_ARROW)


_ARROW = pa.schema(
    [(n, pa.int32()) for n in ("part", "seq", "docs")]
    + [("ids", pa.int64())]
    + [(n, pa.binary()) for n in ("keys", "sizes", "symbols")]
    + [(n, pa.int32()) for n in ("base", "width")]
    + [(n, pa.binary()) for n in ("rules", "lengths", "sequence")]
)


def write(docs: DataFrame, path: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode whole texts, append the id ``end`` to each, and write them to ``path`` in ascending order of ``key``."""
    vocabulary = load(tokenizer).get_vocab_size(with_added_tokens=True)
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    # by key and then by a hash of the text, so that a key with very many rows can be cut
    order = ["key", F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    closing = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        part, seq, held = TaskContext.get().partitionId(), 0, 0
        keys, sizes, parts = [], [], []
        for batch in batches:
            encoder.known.trim()
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(t.as_py()) + closing
                keys.append(-(1 << 63) if k is None else k)
                sizes.append(len(ids) // 4)
                parts.append(ids)
                held += sizes[-1]
                if held >= BLOCK_IDS:
                    yield _block(part, seq, keys, sizes, np.frombuffer(b"".join(parts), dtype="<u4"), vocabulary)
                    seq, held = seq + 1, 0
                    keys, sizes, parts = [], [], []
        if keys:
            yield _block(part, seq, keys, sizes, np.frombuffer(b"".join(parts), dtype="<u4"), vocabulary)

    # the blocks are compressed already, and each is too large for Parquet's dictionaries and statistics to help
    ordered.mapInArrow(run, FILE).write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: key, start, n_tokens and the ids' unsigned CRC-32 as uint32."""
    files = spark.read.schema(FILE).parquet(path)
    sums = files.select("part", "seq", "ids")
    earlier = lambda *by: W.partitionBy(*by).rowsBetween(W.unboundedPreceding, -1)
    parts = sums.groupBy("part").agg(F.sum("ids").alias("_of"))
    parts = parts.select("part", F.coalesce(F.sum("_of").over(earlier(F.lit(0)).orderBy("part")), F.lit(0)).alias("_parts"))
    inside = F.coalesce(F.sum("ids").over(earlier("part").orderBy("seq")), F.lit(0))
    offsets = sums.withColumn("_inside", inside).join(parts, "part").select("part", "seq", (F.col("_inside") + F.col("_parts")).alias("_first"))
    docs = files.mapInArrow(_documents, "part int, seq int, key bigint, at bigint, n_tokens bigint, ids_crc32 bigint")
    return docs.join(offsets, ["part", "seq"]).select(
        F.when(F.col("key") != -(1 << 63), F.col("key")).alias("key"), (F.col("_first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            block = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            kind = f"<u{block['width']}"
            rules = np.frombuffer(block["rules"], dtype=kind).reshape(-1, 2)
            ids = expand(np.frombuffer(block["sequence"], dtype=kind), rules, block["base"]).astype("<u4")
            sizes = np.frombuffer(block["sizes"], dtype="<u4").astype(np.int64)
            starts = np.cumsum(sizes) - sizes
            data = memoryview(ids.tobytes())
            crc = [zlib.crc32(data[4 * s : 4 * (s + n)]) for s, n in zip(starts.tolist(), sizes.tolist())]
            n = len(sizes)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([block["part"]] * n, pa.int32()),
                    "seq": pa.array([block["seq"]] * n, pa.int32()),
                    "key": pa.array(np.frombuffer(block["keys"], dtype="<i8")),
                    "at": pa.array(starts),
                    "n_tokens": pa.array(sizes),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )


def new_path(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/llm/{spark.sparkContext.applicationId}/ids-{uuid.uuid4().hex}"
