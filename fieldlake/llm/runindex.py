"""A run-length index over strings: Burrows-Wheeler runs, samples at their ends, matching statistics.

The strings stand end to end, each closed by a sign of its own below all bytes. Where neighbours in
suffix order have the same byte before them, the longest match of one is the longest match of the
suffix one byte earlier, less one. So only at the ends of the runs of equal bytes in the transform is
a match measured; streaming over the text fills in the rest. In a repetitive collection the runs are
few.
"""

from __future__ import annotations

import numpy as np

#: Bytes compared at once before ranks are doubled, and the bits left beside them for a string's number.
PACK = 5
TIE_BITS = 64 - 9 * PACK


def suffix_ranks(symbols: np.ndarray, owner: np.ndarray, to_end: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The suffix array, and the ranks by the first 5, 10, 20... symbols that it was made from.

    A rank is the place of the first suffix of its kind; only suffixes that are not yet alone are
    sorted again.
    """
    n = len(symbols)
    if owner[-1] >= 1 << TIE_BITS:
        raise ValueError(f"an index holds at most {1 << TIE_BITS} strings")
    padded = np.concatenate([symbols, np.zeros(PACK, symbols.dtype)])
    key = np.zeros(n, np.uint64)
    for i in range(PACK):  # beyond the closing sign nothing counts
        inside = np.where(to_end >= i, padded[i : i + n], 0)
        key = (key << np.uint64(9)) | inside.astype(np.uint64)
    key = (key << np.uint64(TIE_BITS)) | np.where(to_end < PACK, owner, 0).astype(np.uint64)
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, width = [(PACK, rank.astype(np.int32))], PACK
    slots = np.flatnonzero(~(new & np.append(new[1:], True)))
    while slots.size:
        suffixes = order[slots]
        pair = rank[suffixes] * n + rank[suffixes + width]
        by = np.argsort(pair)
        pair, suffixes = pair[by], suffixes[by]
        order[slots] = suffixes
        new = np.ones(len(slots), bool)
        new[1:] = pair[1:] != pair[:-1]
        rank[suffixes] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        width *= 2
        levels.append((width, rank.astype(np.int32)))
        slots = slots[~(new & np.append(new[1:], True))]
    return order, levels


def _common(a: np.ndarray, b: np.ndarray, levels: list[tuple[int, np.ndarray]], symbols: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b."""
    n = len(symbols)
    a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for width, rank in reversed(levels):
        same = rank[a] == rank[b]
        step = np.where(same, width, 0)
        a, b, out = np.minimum(a + step, n - 1), np.minimum(b + step, n - 1), out + step
    alive = np.ones(len(a), bool)
    for _ in range(PACK):
        alive &= (symbols[a] == symbols[b]) & (symbols[a] != 0) & (a != b)
        out += alive
        a, b = np.minimum(a + alive, n - 1), np.minimum(b + alive, n - 1)
    return out


class RunIndex:
    """``runs``: how many runs the transform has; ``matches``: the longest match of every suffix elsewhere."""

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(x) for x in strings], np.int64)
        raw = np.frombuffer(b"\x00".join(strings) + b"\x00", np.uint8)
        self.ends = np.cumsum(lengths + 1) - 1  # where the closing signs stand
        self.starts = self.ends - lengths
        owner = np.repeat(np.arange(len(strings)), lengths + 1)
        at = np.arange(len(raw))
        self.to_end = self.ends[owner] - at
        symbols = raw.astype(np.int16) + 1
        symbols[self.ends] = 0
        order, levels = suffix_ranks(symbols, owner, self.to_end)
        before = symbols[order - 1].astype(np.int64)  # the transform; closing signs all differ
        closed = before == 0
        before[closed] = -1 - order[closed]
        ends = np.flatnonzero(before[1:] != before[:-1])  # suffixes that end a run; the next begins one
        self.runs = len(ends) + 1
        low, high = order[ends], order[ends + 1]
        common = _common(high, low, levels, symbols)
        self.matches = np.maximum(self._streamed(high, common, order[0]), self._streamed(low, common, order[-1]))

    def _streamed(self, sampled: np.ndarray, common: np.ndarray, alone: int) -> np.ndarray:
        """Matches with the neighbour on one side: measured at the sampled run ends, then streamed.

        ``alone`` is the suffix without a neighbour on that side.
        """
        n = len(self.to_end)
        held, mark = np.zeros(n, np.int64), np.zeros(n, bool)
        held[sampled] = common
        mark[sampled] = mark[0] = mark[alone] = True
        last = np.maximum.accumulate(np.where(mark, np.arange(n), 0))
        return np.maximum(held[last] - (np.arange(n) - last), 0)

    def long_matches(self, length: int) -> list[list[tuple[int, int]]]:
        """For each string the maximal stretches covered by matches of ``length`` that lie inside it."""
        good = (self.matches >= length) & (self.to_end >= length)
        return [covered(np.flatnonzero(good[s:e]), length) for s, e in zip(self.starts, self.ends, strict=True)]


def covered(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The union of ``[s, s + length)``, ``starts`` ascending."""
    if not starts.size:
        return []
    cuts = np.flatnonzero(starts[1:] > starts[:-1] + length) + 1
    return [(int(p[0]), int(p[-1]) + length) for p in np.split(starts, cuts)]
