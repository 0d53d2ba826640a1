"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words that repeats itself with a period, is at least twice that period and at
least ``least`` words long, and cannot be made longer. At scale L a text is cut into blocks of L words
and periods from 2L to 4L - 1 are looked for (from 1 at the lowest scale, L = 2). A run with such a
period holds a whole block in its first period, and that block occurs again one period later. Where a
block occurs in the window after it is told by the sum of squared differences of word numbers at every
distance at once: sums of squares less twice a correlation, and the correlation is a number-theoretic
transform, exact modulo primes whose product exceeds any such sum. Zero is an occurrence. A block one
of whose words does not come again in its window has none, and is not transformed. Distances of
occurrences are seeds; they are extended over equal words both ways, which also proves them.

Documents of a slice are transformed together, so short ones cost no Python loop. A document is worked
on by itself in the task that reads it: nothing is shuffled, and memory follows the longest document.

Defined results: a null text is empty and has no runs; rows without an id and repeated rows are
documents like any other; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from fieldlake.llm.common import texts
from fieldlake.llm.repeats import slices

LEAST = 12
#: Primes with roots of unity of order 2**27 and 2**26, and a generator of each (fixed values).
PRIMES = ((2_013_265_921, 31), (469_762_049, 3))
#: Numbers that one transform holds at a time.
STEP = 1 << 19
#: Words of a block that are looked up before it is transformed, and words a seed is extended by in step with others.
PROBES = 16
IN_STEP = 64


@lru_cache(maxsize=64)
def _roots(size: int, prime: int, generator: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of order ``size``, half of them."""
    root = pow(generator, (prime - 1) // size, prime)
    root = pow(root, prime - 2, prime) if inverse else root
    out = np.ones(max(1, size // 2), np.int64)
    done = 1
    while done < out.size:
        out[done : 2 * done] = out[:done] * pow(root, done, prime) % prime
        done *= 2
    return out


def transform(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """The transform of every row, its numbers in bit-reversed order."""
    count, size = rows.shape
    roots = _roots(size, prime, generator, False)
    half = size // 2
    while half:
        parts = rows.reshape(count, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1]
        out = np.empty_like(parts)
        np.add(low, high, out=out[:, :, 0])
        np.multiply(low - high + prime, roots[:: size // (2 * half)][:half], out=out[:, :, 1])
        out %= prime
        rows = out.reshape(count, size)
        half //= 2
    return rows


def transform_back(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """The inverse of ``transform``."""
    count, size = rows.shape
    roots = _roots(size, prime, generator, True)
    half = 1
    while half < size:
        parts = rows.reshape(count, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1] * roots[:: size // (2 * half)][:half] % prime
        out = np.empty_like(parts)
        np.add(low, high, out=out[:, :, 0])
        np.add(low, prime - high, out=out[:, :, 1])
        out %= prime
        rows = out.reshape(count, size)
        half *= 2
    return rows * pow(size, prime - 2, prime) % prime


def occurrences(blocks: np.ndarray, windows: np.ndarray, primes: tuple) -> np.ndarray:
    """For every block and each place of its window, whether the block lies there without a mismatch."""
    count, length = blocks.shape
    width = windows.shape[1]
    size = 1 << (width - 1).bit_length()
    places = width - length + 1
    found = np.ones((count, places), bool)
    for prime, generator in primes:
        turned, held = np.zeros((2, count, size), np.int64)
        turned[:, 0] = blocks[:, 0] % prime
        turned[:, size - length + 1 :] = blocks[:, :0:-1] % prime
        held[:, :width] = windows % prime
        squares = np.zeros((count, width + 1), np.int64)
        np.cumsum(held[:, :width] * held[:, :width] % prime, axis=1, out=squares[:, 1:])
        own = (turned * turned % prime).sum(axis=1)
        both = transform(turned, prime, generator) * transform(held, prime, generator) % prime
        products = transform_back(both, prime, generator)[:, :places]
        gaps = own[:, None] + squares[:, length:][:, :places] - squares[:, :places] - 2 * products
        found &= gaps % prime == 0
    return found


def _equal_steps(words: np.ndarray, at: np.ndarray, gap: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
    """How many words from ``at`` on, going ``way``, equal the words ``gap`` later, ``room`` at most."""
    out = np.zeros(at.size, np.int64)
    going = np.flatnonzero(room > 0)
    for step in range(IN_STEP):
        here = at[going] + way * step
        same = words[here] == words[here + gap[going]]
        going = going[same]
        out[going] += 1
        going = going[out[going] < room[going]]
        if not going.size:
            return out
    for k in going.tolist():
        done, size, most, first, d = IN_STEP, 4 * IN_STEP, int(room[k]), int(at[k]), int(gap[k])
        while done < most:
            size = min(size, most - done)
            lo = first + done if way > 0 else first - done - size + 1
            other = np.flatnonzero(words[lo : lo + size] != words[lo + d : lo + d + size])
            if other.size:
                done += int(other[0]) if way > 0 else size - 1 - int(other[-1])
                break
            done, size = done + size, 4 * size
        out[k] = done
    return out


def _recurring(words: np.ndarray, keys: np.ndarray, blocks: np.ndarray, length: int, low: int, high: int) -> np.ndarray:
    """Blocks whose probed words all come again ``low`` to ``high`` words later."""
    span = words.size
    for j in range(0, length, max(1, length // PROBES)):
        if not blocks.size:
            break
        at = blocks + j
        base = words[at] * span + at
        place = np.searchsorted(keys, base + low)
        blocks = blocks[(place < keys.size) & (keys[np.minimum(place, keys.size - 1)] <= base + high)]
    return blocks


def _seeds(numbers, ends_at, blocks, length, low, high, primes) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and the distances at which they occur again inside their documents."""
    width = high - low + length
    rows = max(1, STEP // (1 << (width - 1).bit_length()))
    at, gap = [], []
    for first in range(0, blocks.size, rows):
        some = blocks[first : first + rows]
        window = some[:, None] + np.arange(low, low + width)
        found = occurrences(
            numbers[some[:, None] + np.arange(length)], numbers[np.minimum(window, numbers.size - 1)], primes
        )
        row, place = np.nonzero(found)
        inside = some[row] + low + place + length <= ends_at[some[row]]
        at.append(some[row[inside]])
        gap.append(low + place[inside])
    if not at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(at), np.concatenate(gap)


def find_runs(numbers: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """``document, start, length, period`` of all runs, by document, start and period.

    ``numbers`` are the word numbers of documents one after another, each counting its own from 0.
    """
    if least < 6:
        raise ValueError("runs of under 6 words may hold no whole block")
    numbers, sizes = np.asarray(numbers, np.int64), np.asarray(sizes, np.int64)
    none = np.empty(0, np.int64)
    if not numbers.size or sizes.max() < least:
        return none, none, none, none
    ends = np.cumsum(sizes)
    firsts = ends - sizes
    owner = np.repeat(np.arange(sizes.size), sizes)
    ends_at = ends[owner]
    span = numbers.size
    most = int(numbers.max()) + 1
    words = owner * most + numbers  # words of different documents differ
    keys = np.sort(words * span + np.arange(span))
    known = [none, none, none]  # start, end, period
    length = 2
    while True:
        low, high = (1 if length == 2 else 2 * length), 4 * length - 1
        docs = np.flatnonzero(sizes >= max(least, 2 * low))
        if not docs.size:
            break
        counts = (sizes[docs] - low) // length
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        blocks = np.repeat(firsts[docs], counts) + within * length
        blocks = _recurring(words, keys, blocks, length, low, high)
        exact = 1 if length * most * most < PRIMES[0][0] else 2
        at, gap = _seeds(numbers, ends_at, blocks, length, low, high, PRIMES[:exact])
        if at.size:  # of blocks in a row with one distance the first stands for all
            code = gap * span + at
            lead = ~np.isin(code, code + length)
            at, gap = at[lead], gap[lead]
        if at.size and known[0].size:  # seeds within one known run whose period divides the distance
            order = np.argsort(known[0], kind="stable")
            start, end, period = (x[order] for x in known)
            reach = np.maximum.accumulate(end)
            widest = np.maximum.accumulate(np.where(end == reach, np.arange(end.size), 0))
            last = np.searchsorted(start, at, "right") - 1
            run = widest[np.maximum(last, 0)]
            inside = (last >= 0) & (at + gap + length <= end[run]) & (gap % period[run] == 0)
            at, gap = at[~inside], gap[~inside]
        if at.size:
            ahead = _equal_steps(words, at, gap, ends_at[at] - gap - at, 1)
            back = _equal_steps(words, at - 1, gap, at - firsts[owner[at]], -1)
            start, end = at - back, at + ahead + gap
            good = (ahead >= length) & (end - start >= np.maximum(least, 2 * gap))
            merged = [np.concatenate([x, y[good]]) for x, y in zip(known, (start, end, gap), strict=True)]
            order = np.lexsort((merged[2], merged[1], merged[0]))  # of one stretch the least period
            start, end, period = (x[order] for x in merged)
            fresh = np.ones(start.size, bool)
            fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
            known = [start[fresh], end[fresh], period[fresh]]
        length *= 2
    start, end, period = known
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    document = owner[start]
    return document, start - firsts[document], end - start, period


def _number(words: list[bytes]) -> list[int]:
    seen: dict[bytes, int] = {}
    return [seen.setdefault(word, len(seen)) for word in words]


def _worker(least: int, schema: pa.Schema):
    run_type = schema.field("runs").type

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "data")):
            split = [data.split() for data in batch.column("data").to_pylist()]
            sizes = np.array([len(words) for words in split], np.int64)
            numbers = np.concatenate([np.array(_number(words), np.int64) for words in split] or [np.empty(0, np.int64)])
            document, start, length, period = find_runs(numbers, sizes, least)
            bounds = np.searchsorted(document, np.arange(len(split) + 1))
            collapsed = []
            for k, (a, b) in enumerate(pairwise(bounds.tolist())):
                words = split[k]
                if a < b:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, start[a:b] + period[a:b], 1)
                    np.add.at(change, start[a:b] + length[a:b], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
                collapsed.append(b" ".join(words).decode())
            found = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(run_type.value_type))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), found).cast(run_type),
                pa.array(collapsed, pa.string()),
            ], schema=schema)

    return work


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words``, its ``runs`` (start, length and smallest period in words,
    by start, then period) and ``collapsed``, the words but those that some run repeats, joined by blanks."""
    rows = texts(docs, id_col, text_col)
    data = rows.select("doc_id", rows["text"].cast("binary").alias("data"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    declared = f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    schema = pa.schema([
        ("doc_id", to_arrow_type(rows.schema["doc_id"].dataType)), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string()),
    ])
    return data.mapInArrow(_worker(least, schema), declared)
