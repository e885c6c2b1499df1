"""SuperMinHash signatures of sets of 64-bit element hashes, and their bands.

Every element draws a random permutation of the signature's places, step by step, and a random fraction
for each step; at step j it offers the value j + fraction to the j-th place of its permutation. Each place
keeps the least value. As the permutation hits every place once, the places are not independent but
negatively correlated, and estimates vary less than those of plain MinHash. A set is done once its
largest kept value lies below the next step: most sets need a few steps only.
"""

from __future__ import annotations

import numpy as np

from .words import BASE, U, mix

BANDS, ROWS = 32, 4  # at a similarity of 0.8 all bands of a pair differ once in 2 * 10^7 pairs
PLACES = BANDS * ROWS
ELEMENTS = 1 << 16  # elements that are worked on at once
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def signatures(element: np.ndarray, owner: np.ndarray, sets: int, places: int = PLACES) -> np.ndarray:
    """(sets x places) kept values, of which the upper 32 bits are the step; ``owner``: the set of each element."""
    kept = np.full(sets * places, NONE, dtype=U)
    whole = kept.reshape(sets, places)
    for begin in range(0, len(element), ELEMENTS):
        e, o = element[begin : begin + ELEMENTS], owner[begin : begin + ELEMENTS].astype(np.int64)
        order = np.tile(np.arange(places, dtype=np.uint8), (len(e), 1))
        at = np.arange(len(e))
        low, high = int(o[0]), int(o[-1]) + 1
        for j in range(places):
            # a set goes on while a kept value could still be undercut by this step
            going = whole[low:high].max(axis=1) >= U(j << 32)
            still = going[o[at] - low]
            at = at[still]
            if not len(at):
                break
            drawn = mix(e[at] + U((j + 1) * BASE & 0xFFFFFFFFFFFFFFFF))
            k = (U(j) + (((drawn >> U(32)) * U(places - j)) >> U(32))).astype(np.int64)
            place = order[at, k]
            order[at, k] = order[at, j]
            np.minimum.at(kept, o[at] * places + place, U(j << 32) | (drawn & U(0xFFFFFFFF)))
    return whole


def bands(signature: np.ndarray, n: int = BANDS) -> np.ndarray:
    """(sets x n) bucket numbers; equal numbers mean equal rows in the same band."""
    sets, places = signature.shape
    rows = signature.reshape(sets, n, places // n)
    out = np.broadcast_to(np.arange(1, n + 1, dtype=U), (sets, n)).copy()
    for r in range(places // n):
        out = mix(out * U(BASE) + rows[:, :, r])
    return out.view(np.int64)
