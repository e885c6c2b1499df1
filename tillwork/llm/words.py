"""Words of many texts at once, as 64-bit hashes over the UTF-8 bytes of an Arrow column.

A word is a run of bytes that are no separators; separators are ASCII, so runs never cut
a character. The hash of a word is a polynomial over random numbers drawn for each byte value, taken
from one running sum over the whole buffer, and then mixed. It is the same on every machine.
Two different words collide with a chance of about 2^-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20  # texts are worked on in blocks of about this size; a longer text is its own block

U = np.uint64
# The odd base (3 modulo 4) of the polynomial and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C17
INVERSE = pow(BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finalizer)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


VALUE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the byte values in the ranges, ends included."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


NONE_ABOVE = U(0xFFFFFFFFFFFFFFFF)  # sorts after all hashes
WHITE = bytes_in((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = bytes_in((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


class _Powers:
    """Powers of the base and of its inverse, as many as have been needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(0, dtype=U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            ones = np.full(max(n, BLOCK_BYTES + 1), BASE, dtype=U)
            ones[0] = 1
            back = np.full(len(ones), INVERSE, dtype=U)
            back[0] = 1
            self.up, self.down = np.multiply.accumulate(ones), np.multiply.accumulate(back)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


@dataclass
class Block:
    """The words of texts ``first`` to ``last`` (excluded) of a batch, in order."""

    first: int
    last: int
    doc: np.ndarray  # for each word, its text's place in the batch minus ``first``
    hash: np.ndarray  # for each word
    start: np.ndarray  # byte places of each word in ``data``
    end: np.ndarray
    data: np.ndarray  # the bytes, lower-cased if asked for
    begins: np.ndarray  # for each text, its first word; one more at the end

    @property
    def docs(self) -> int:
        return self.last - self.first

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.begins)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, separators: np.ndarray, lower: bool = True) -> Iterator[Block]:
    data, offsets = buffers(texts)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1)
        last = min(last, n)
        yield _block(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first, last, separators, lower)
        first = last


def _block(data: np.ndarray, offsets: np.ndarray, first: int, last: int, separators: np.ndarray, lower: bool) -> Block:
    if lower:
        data = LOWERED[data]
    size = len(data)
    inside = np.zeros(size + 1, dtype=bool)
    inside[:size] = ~separators[data]
    fresh = np.zeros(size + 1, dtype=bool)  # places where a text begins: a word cannot go on over them
    fresh[offsets] = True
    before = np.empty(size + 1, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | fresh))
    end = np.flatnonzero(before & (~inside | fresh))
    up, down = _POWERS.get(size + 1)
    total = np.zeros(size + 1, dtype=U)
    np.cumsum(VALUE[data] * up[:size], out=total[1:])
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(U))
    begins = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(last - first), np.diff(begins))
    return Block(first, last, doc, h, start, end, data, begins)


def windows(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``size`` words; a text of fewer, but not none, is one run."""
    h, n = block.hash, len(block.hash)
    counts = block.counts()
    if n >= size:
        rolled = np.zeros(n - size + 1, dtype=U)
        for k in range(size):
            rolled = mix(rolled * U(BASE) + h[k : n - size + 1 + k])
        whole = block.doc[: n - size + 1] == block.doc[size - 1 :]
        doc, out = block.doc[: n - size + 1][whole], rolled[whole]
    else:
        doc, out = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return doc, out
    lone = counts[short].astype(U)
    for k in range(size - 1):
        has = counts[short] > k
        lone[has] = mix(lone[has] * U(BASE) + h[block.begins[short[has]] + k])
    doc, out = np.concatenate([doc, short]), np.concatenate([out, lone])
    order = np.argsort(doc, kind="stable")
    return doc[order], out[order]
