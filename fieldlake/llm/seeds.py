"""Anchors of windows: the work that both exact-repeat operators share.

The anchor of a window is its leftmost k-gram of least hash. Windows of equal content have equal
anchors at equal places, so windows only need to be compared under the hash of their anchor.
Neighbouring windows with one anchor form a segment, and the segments of a text part its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Symbols handled at once; positions fit into the low bits of a packed key.
CHUNK = 1 << 20
_LOW = np.uint64(CHUNK - 1)
_HIGH = ~_LOW


def odd_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Spans:
    """Hashes of stretches of a symbol array in constant time, the same wherever a stretch lies."""

    BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
    _powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def powers(cls, which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        size = 1 << max(12, n.bit_length())
        if (which, size) not in cls._powers:
            base = cls.BASES[which]
            cls._powers[which, size] = (odd_powers(base, size), odd_powers(pow(base, -1, 1 << 64), size))
        return cls._powers[which, size]

    def __init__(self, codes: np.ndarray, which: int = 0):
        self.up, self.down = self.powers(which, len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * self.up[: len(codes)], out=self.sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    done, out = 1, values
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = np.minimum(out[: len(out) - (width - done)], out[width - done :])
    return out


def segments(codes: np.ndarray, ends: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, ...]:
    """``first, last, anchor, key, content`` of the segments of the texts that ``codes`` holds end to end.

    ``first`` and ``last`` are window starts, ``key`` is the anchor's hash, ``content`` that of the
    whole segment, from ``first`` to ``last + window``. ``ends`` says where each text ends.
    """
    n = len(codes)
    none = np.empty(0, np.int64)
    if n < window:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    spans = Spans(codes)
    at = np.arange(n - gram + 1)
    grams = spans.hash(at, at + gram)
    packed = (grams & _HIGH) | at.astype(np.uint64)
    anchors = (sliding_min(packed, window - gram + 1) & _LOW).astype(np.int64)
    starts = np.arange(len(anchors))
    limit = np.repeat(ends, np.diff(np.concatenate([[0], ends])))[: len(anchors)]
    whole = starts + window <= limit
    starts, anchors = starts[whole], anchors[whole]
    if not starts.size:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(starts)) - 1
    first, last, anchor = starts[heads], starts[tails], anchors[heads]
    content = spans.hash(first, last + window) ^ Spans(codes, 1).hash(first, last + window)
    return first, last, anchor, grams[anchor], content


def chunks(lengths: list[int], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Texts dealt into chunks of at most ``CHUNK`` symbols: lists of ``text, from, to``.

    Long texts are cut so that each of their windows lies in one chunk.
    """
    held, room = [], CHUNK
    for k, n in enumerate(lengths):
        at = 0
        while n - at >= window:
            if room < window or (room < n - at and held and n <= CHUNK):
                yield held
                held, room = [], CHUNK
            to = min(n, at + room)
            held.append((k, at, to))
            room -= to - at
            if to == n:
                break
            at = to - window + 1
    if held:
        yield held
