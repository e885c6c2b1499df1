"""SentencePiece BPE by prefix tables, and decoding.

For merges ranked by the merged piece, the encoding of a text is fixed by one number for each
prefix: the last token of the prefix's own encoding, which is unique. An automaton finds all pieces that
end at a place; the last token there is the one piece whose predecessor (the last token of the
prefix before it) is compatible with it, that is, encoding the two together gives just
the two. The ids of the text follow from its last prefix backwards.

Two tokens are compatible if, undoing their merges from the latest on, the two pieces that meet at
the border never form a piece that ranks before the merge that was undone last.

No piece of the models handled here holds a space mark after another character, so texts fall
apart into words with the space marks before them. Workers remember the ids of words. Runs of several
space marks are merged last, as their pieces all share the lowest score; ties go to the left.
Characters without a piece become their UTF-8 bytes.

Defined cases: null and empty texts have no ids; texts of any length are encoded whole; repeated rows
stay; other columns pass through, but a column with the name of the result is replaced. Decoding
gives null ids an empty text; control pieces decode to nothing and unknown ones to `` ⁇ ``;
bytes that are no UTF-8 become U+FFFD.
"""

from __future__ import annotations

import heapq
import pickle
import re
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .caches import Recent
from .common import content, extended, own_columns, plus, unboxed, with_content

MARK = "▁"
PAIRS = 300_000  # pairs of tokens whose compatibility a worker remembers
WORDS = 300_000  # words whose ids it remembers


def read_model(path: str) -> dict:
    """What encoding needs of a SentencePiece BPE model, as plain tables."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    text = [model.id_to_piece(i) for i in range(n)]
    byte = {int(text[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
    plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    if len(byte) < 256 or any(MARK in text[i].lstrip(MARK) for i in plain):
        raise ValueError("a model with byte pieces and with space marks only at the front of pieces is needed")
    runs = {len(text[i]): i for i in plain if len(text[i]) > 1 and not text[i].strip(MARK)}
    ranked = sorted((i for i in plain if i not in set(runs.values())), key=lambda i: -model.get_score(i))
    rank = {text[i]: r for r, i in enumerate(ranked)}
    pieces = [text[i] for i in ranked]
    split: list[tuple[int, int] | None] = []
    for p in pieces:
        split.append(last_merge(p, rank) if len(p) > 1 else (-1, -1))
    surface = [b"" if model.is_control(i) else text[i].replace(MARK, " ").encode() for i in range(n)]
    for value, i in byte.items():
        surface[i] = bytes([value])
    surface[model.unk_id()] = " ⁇ ".encode()
    return {"ids": ranked, "pieces": pieces, "split": split, "bytes": [byte[b] for b in range(256)], "runs": runs, "surface": surface}


def last_merge(piece: str, rank: dict[str, int]) -> tuple[int, int] | None:
    """The two pieces whose merge completes the encoding of ``piece``; None if it never becomes one token."""
    parts = list(piece)
    while len(parts) > 1:
        best = min((rank.get(a + b, len(rank)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best[0] == len(rank):
            return None
        if len(parts) == 2:
            return (rank[parts[0]], rank[parts[1]]) if parts[0] in rank and parts[1] in rank else None
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return None


class Encoder:
    def __init__(self, tables: dict):
        self.ids, self.pieces, self.split = tables["ids"], tables["pieces"], tables["split"]
        self.bytes, self.runs, self.surface = tables["bytes"], tables["runs"], tables["surface"]
        self.rank = {p: r for r, p in enumerate(self.pieces)}
        self.length = [len(p) for p in self.pieces]
        self.found = ahocorasick.Automaton()
        for r, p in enumerate(self.pieces):
            if self.split[r] is not None:
                self.found.add_word(p, (r, len(p)))
        self.found.make_automaton()
        single = "".join(re.escape(p) for p in self.pieces if len(p) == 1)
        self.known = re.compile(f"[{single}]+|[^{single}]+", re.DOTALL)
        self.fits: dict[int, bool] = {}
        self.words = Recent(lambda key: np.array(self.encode_segment(key), dtype="<i4").tobytes(), most=WORDS)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of the two tokens' text is just the two."""
        latest = len(self.pieces)
        while True:
            joined = self.rank.get(self.pieces[a] + self.pieces[b])
            if joined is not None and joined < latest:
                return False
            left, right = self.length[a] > 1, self.length[b] > 1
            if left and (not right or a > b):  # the later merge is undone first
                latest, a = a, self.split[a][1]
            elif right:
                latest, b = b + 1, self.split[b][0]  # a merge further left goes first among equals
            else:
                return True

    def encode_known(self, text: str) -> list[int]:
        """Ranks of the tokens of a text whose characters all have a piece."""
        last = [-1] * (len(text) + 1)  # by the end of the prefix; the empty prefix has none
        fits = self.fits
        for end, (r, n) in self.found.iter(text):
            if last[end + 1] < 0:
                if end + 1 == n:
                    last[n] = r
                else:
                    before = last[end + 1 - n]
                    pair = before << 32 | r
                    ok = fits.get(pair)
                    if ok is None:
                        ok = fits[pair] = self.compatible(before, r)
                    if ok:
                        last[end + 1] = r
        out, at = [], len(text)
        while at:
            r = last[at]
            out.append(r)
            at -= self.length[r]
        out.reverse()
        return out

    def encode_word(self, text: str) -> list[int]:
        if len(self.fits) > PAIRS:
            self.fits.clear()
        out: list[int] = []
        for part in self.known.findall(text):
            if part[0] in self.rank:
                out += [self.ids[r] for r in self.encode_known(part)]
            else:
                out += [self.bytes[b] for b in part.encode("utf-8", "replace")]
        return out

    def encode_run(self, n: int) -> list[int]:
        """Ids of n space marks alone: the leftmost pair that forms a piece is merged, again and again."""
        size, after = [1] * n, list(range(1, n + 1))
        before = list(range(-1, n - 1))
        open_pairs = [i for i in range(n - 1) if 2 in self.runs]
        while open_pairs:
            i = heapq.heappop(open_pairs)
            j = after[i]
            if not size[i] or j >= n or size[i] + size[j] not in self.runs:
                continue
            size[i], size[j], after[i] = size[i] + size[j], 0, after[j]
            if after[i] < n:
                before[after[i]] = i
                heapq.heappush(open_pairs, i)
            if before[i] >= 0:
                heapq.heappush(open_pairs, before[i])
        mark = self.ids[self.rank[MARK]]
        return [mark if s == 1 else self.runs[s] for s in size if s]

    def encode_segment(self, key: str) -> list[int]:
        """``key``: a word with the space marks beyond the first written as spaces before it."""
        word = key.lstrip(" ")
        marks = len(key) - len(word) + 1
        if not word:
            return self.encode_run(marks) if marks > 1 else [self.ids[self.rank[MARK]]]
        ids = self.encode_word(MARK + word)
        if marks == 1:
            return ids
        loose = ids[0] == self.ids[self.rank[MARK]]
        rest = marks - 1 + loose
        return (self.encode_run(rest) if rest > 1 else [self.ids[self.rank[MARK]]]) + ids[loose:]

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian 32-bit numbers."""
        if not text:
            return b""
        keys = text.replace(MARK, " ").split(" ")
        if "" in keys:
            keys = _segments(keys)
        return b"".join(map(self.words.__getitem__, keys))


def _segments(keys: list[str]) -> Iterator[str]:
    spaces = 0
    for k in keys[:-1]:
        if k:
            yield " " * spaces + k
            spaces = 0
        else:
            spaces += 1
    yield " " * spaces + keys[-1]


def encoded(
    docs: DataFrame, tables: dict, text: str = "text", to: str = "ids", keep: Sequence[str] | None = None, back: str | None = None
) -> DataFrame:
    """The columns ``keep`` (all by default) with the ids of the whole text as an array; ``tables`` from ``read_model``.

    ``back`` names a column for the text that the ids decode to; both come from one pass of Python workers.
    """
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(tables))
    own = own_columns(docs, keep, [to] if back is None else [to, back])
    rows = with_content(docs, own, text)
    results = {"_ids": "array<int>"} if back is None else {"_ids": "array<int>", "_back": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(packed.value)
        for batch in batches:
            encoder.words.trim()
            ids = [encoder.encode(t.as_py() or "") for t in content(batch, own, text)]
            offsets = np.zeros(len(ids) + 1, dtype=np.int32)
            np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
            values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            lists = pa.ListArray.from_arrays(pa.array(offsets), values)
            if back is None:
                yield extended(batch, _ids=lists)
            else:
                yield extended(batch, _ids=lists, _back=pa.array(decode(lists, encoder.surface), pa.string()))

    named = [F.col("_ids").alias(to)] if back is None else [F.col("_ids").alias(to), F.col("_back").alias(back)]
    return unboxed(rows.mapInArrow(run, plus(rows, **results)), own, *named)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(packed: bytes) -> Encoder:
    """One encoder for each worker and model, whatever the number of tasks."""
    key = hash(packed)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(pickle.loads(packed))
    return _ENCODERS[key]


def decode(rows: pa.Array, surface: list[bytes]) -> list[str]:
    """Text of each row of ids."""
    pool = np.frombuffer(b"".join(surface), dtype=np.uint8)
    size = np.array([len(s) for s in surface], dtype=np.int64)
    begin = np.cumsum(size) - size
    spaced = np.array([s[:1] == b" " for s in surface])
    out = []
    for row in rows:
        ids = np.asarray(row.values) if row.is_valid else np.zeros(0, np.int32)
        n = size[ids]
        first = np.repeat(begin[ids] - (np.cumsum(n) - n), n)
        data = pool[first + np.arange(n.sum())].tobytes()
        out.append((data[1:] if len(ids) and spaced[ids[0]] else data).decode("utf-8", "replace"))
    return out


def decoded(rows: DataFrame, tables: dict, ids: str = "ids", to: str = "decoded", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with the text of an array of ids."""
    packed = rows.sparkSession.sparkContext.broadcast(pickle.dumps(tables["surface"]))
    own = own_columns(rows, keep, [to])
    boxes = with_content(rows, own, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surface = pickle.loads(packed.value)
        for batch in batches:
            yield extended(batch, _text=pa.array(decode(content(batch, own, ids), surface), pa.string()))

    return unboxed(boxes.mapInArrow(run, plus(boxes, _text="string")), own, F.col("_text").alias(to))
