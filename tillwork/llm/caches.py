"""A worker's memory of what it has computed for recurring strings, bounded in entries."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice


class Recent(dict):
    """string -> value, computed by ``make`` where it isn't known yet.

    Only strings of at most ``longest`` characters are remembered, and no more than ``most`` beyond
    the seed. ``trim`` keeps the entries that came first: those that recur most come early.
    """

    def __init__(self, make: Callable | None = None, seed: dict | None = None, most: int = 400_000, longest: int = 64):
        super().__init__(seed or {})
        self.make, self.longest, self.fixed = make, longest, len(self)
        self.most = len(self) + most

    def __missing__(self, key: str):
        return self.keep(key, self.make(key))

    def keep(self, key: str, value):
        if len(key) <= self.longest and len(self) < self.most:
            self[key] = value
        return value

    def trim(self) -> None:
        """To be called between batches: a full memory forgets its younger half."""
        if len(self) >= self.most:
            kept = dict(islice(self.items(), (self.most + self.fixed) // 2))
            self.clear()
            self.update(kept)


def groups(texts: Iterable[str | None], chars: int = 1 << 20) -> Iterator[list[str]]:
    """Texts in order, null as empty, in groups of about so many characters; a longer text is its own group."""
    out: list[str] = []
    held = 0
    for t in texts:
        t = t or ""
        if out and held + len(t) > chars:
            yield out
            out, held = [], 0
        out.append(t)
        held += len(t)
    if out:
        yield out
