"""Product codes of vectors: codebooks fitted by rounds of assignment with adaptive distance bounds.

A vector becomes integers and is cut into ``PARTS`` equal parts, each with a codebook of its own. Every
part keeps its ``b`` closest entries in order, an upper bound on the distance to the first, a lower bound
on the distance to each of the others and one outer lower bound for all entries it does not list. When
the entries move, the bounds move with them. If the upper bound stays below the second's lower bound,
nothing is computed; if it passes the bounds of some listed entries, these are measured in integers, and
all entries only if it passes the outer bound. A bound is rounded outwards and has to be strictly passed,
so ties are always measured and go to the lower index. How many listed entries were needed is counted over
all parts, and ``b`` shrinks to what all but a small share need.

A round is one pass: each task writes its vectors with their new bounds and, in rows of the same table,
the sums of the parts it gave to each entry, so the next codebooks (which alone reach the driver, with
that count; they are of fixed size) come from at most PARTS * ENTRIES rows a task.

Defined results: rows whose vector is null or empty, holds null or non-finite components or whose length
is not that of the first vector kept or not divisible by ``PARTS`` are dropped; equal ids are rows of their
own, seeded in order of their components; rows without an id come last; a component of 16,384 or more,
whose squares would not fit a long, stops the job; a null label is a label; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fieldlake.llm.common import saved

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1_024
#: A component beyond this (16,384 before scaling) would make squared distances too large for a long.
MOST = SCALE << 14
#: Share of parts, of those their lists sufficed for, that may need more than the lists to come hold.
BEYOND = 0.01
#: Rows whose distances are computed at once, and rows whose listed entries are.
STEP = 4_096
LISTED_STEP = 1_024


def integer_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``vec_id, label, q``: the rows kept, with their vectors in integers."""
    raw = vectors.select(
        vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"),
        vectors[vector_col].cast("array<double>").alias("v"),
    )
    infinite = F.lit(float("inf"))
    usable = (F.size("v") > 0) & (F.size("v") % PARTS == 0) & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)
    )
    too_large = F.raise_error(F.lit("a component is too large for integer distances"))
    whole = F.transform(
        "v", lambda x: F.when(F.abs(x) * SCALE < MOST, F.floor(x * SCALE).cast("int")).otherwise(too_large.cast("int"))
    )
    return raw.where(F.coalesce(usable, F.lit(False))).select("vec_id", "label", whole.alias("q"))


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def all_distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries, exact: as doubles where every sum fits them, else as longs."""
    peak = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * peak * peak * x.shape[1] < 1 << 53 else np.int64
    a, b = x.astype(kind), book.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)


def _listed_distances(x: np.ndarray, book: np.ndarray, near: np.ndarray) -> np.ndarray:
    out = np.empty(near.shape, np.int64)
    for at in range(0, len(x), LISTED_STEP):
        part = slice(at, at + LISTED_STEP)
        gap = book[near[part]] - x[part, None, :]
        out[part] = np.einsum("ijk,ijk->ij", gap, gap)
    return out


def assign_anew(x: np.ndarray, book: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` closest entries in order, and their bounds: upper, lower of the others, outer."""
    distances = all_distances(x, book)
    order = np.argsort(distances, axis=1, kind="stable")[:, : keep + 1]
    reach = np.sqrt(np.take_along_axis(distances, order, axis=1).astype(np.float64))
    bounds = np.full((len(x), keep + 1), np.inf, np.float32)
    bounds[:, 0] = _up(reach[:, 0])
    bounds[:, 1 : reach.shape[1]] = _down(reach[:, 1:])
    return order[:, :keep].astype(np.int16), bounds


def assign_again(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray, near: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Closest entries and bounds after the entries moved, and how many entries each row had measured (0: none)."""
    keep, k = near.shape[1], len(book)
    slack = moved * (1 + 1e-9) + 1e-9
    upper = bounds[:, 0].astype(np.float64) + slack[near[:, 0]]
    lower = bounds[:, 1:].astype(np.float64)
    lower[:, : keep - 1] -= slack[near[:, 1:]]
    lower[:, -1] -= slack.max(initial=0.0)
    lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]
    used = np.zeros(len(x), np.int64)
    near = near.copy()
    unsure = np.flatnonzero(upper >= lower[:, 0])
    if unsure.size:
        gap = book[near[unsure, 0]] - x[unsure]
        upper[unsure] = np.nextafter(np.sqrt((gap * gap).sum(1).astype(np.float64)), np.inf)
        used[unsure] = 1
        unsure = unsure[upper[unsure] >= lower[unsure, 0]]
    need = 1 + (upper[unsure, None] >= lower[unsure]).sum(1)  # entries that may be closest; beyond keep: all
    some, every = unsure[need <= keep], unsure[need > keep]
    if some.size:
        need = need[need <= keep]
        wide = int(need.max())
        listed = near[some, :wide]
        by_entry = np.argsort(listed, axis=1)
        listed = np.take_along_axis(listed, by_entry, axis=1)
        distances = _listed_distances(x[some], book, listed)
        hidden = by_entry >= need[:, None]
        order = np.argsort(np.where(hidden, np.iinfo(np.int64).max, distances), axis=1, kind="stable")
        placed = np.arange(wide) < need[:, None]
        found = np.take_along_axis(listed, order, axis=1)
        reach = np.sqrt(np.take_along_axis(distances, order, axis=1).astype(np.float64))
        near[some, :wide] = np.where(placed, found, near[some, :wide])
        upper[some] = reach[:, 0]
        lower[some, : wide - 1] = np.where(placed[:, 1:], reach[:, 1:], lower[some, : wide - 1])
        used[some] = need
    out = np.concatenate([_up(upper)[:, None], _down(lower)], axis=1)
    if every.size:
        near[every], out[every] = assign_anew(x[every], book, keep)
        used[every] = k
    return near, out, used


def _columns(batch: pa.RecordBatch, name: str, rows: int, kind) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(rows, -1)


STATE = "near array<smallint>, bound array<float>, part int, entry int, n long, total array<long>"


def _assigned(batch: pa.RecordBatch, books: np.ndarray, moved: np.ndarray | None, keep: int) -> tuple:
    """Integers, closest entries and bounds of a batch by row and part, and the entries that each part needed."""
    parts, k, width = books.shape
    rows = batch.num_rows
    q = _columns(batch, "q", rows, np.int64).reshape(rows, parts, width)
    near, bound = np.empty((rows, parts, keep), np.int16), np.empty((rows, parts, keep + 1), np.float32)
    needed = np.zeros(k + 1, np.int64)
    if moved is None:
        for p in range(parts):
            near[:, p], bound[:, p] = assign_anew(q[:, p], books[p], keep)
        return q, near, bound, needed
    old = _columns(batch, "near", rows, np.int64).reshape(rows, parts, -1)[:, :, :keep]
    held = _columns(batch, "bound", rows, np.float32).reshape(rows, parts, -1)
    outer = held[:, :, keep:].min(2, keepdims=True)  # entries no longer listed fall under the outer bound
    held = np.concatenate([held[:, :, :keep], outer], axis=2)
    for p in range(parts):
        near[:, p], bound[:, p], used = assign_again(q[:, p], books[p], moved[p], old[:, p], held[:, p])
        needed += np.bincount(used, minlength=k + 1)
    return q, near, bound, needed


def _pass(books: np.ndarray, moved: np.ndarray | None, keep: int, schema: pa.Schema):
    """One round over a task's vectors; afterwards the sums of its parts per entry and the counts of entries needed."""

    def listed(x: np.ndarray) -> pa.Array:
        ends = pa.array(np.arange(len(x) + 1) * (x.size // len(x)), pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, width = books.shape
        total, n = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        needed = np.zeros(k + 1, np.int64)
        for batch in (whole.slice(at, STEP) for whole in batches for at in range(0, whole.num_rows, STEP)):
            q, near, bound, used = _assigned(batch, books, moved, keep)
            needed += used
            for p in range(parts):
                first = near[:, p, 0].astype(np.int64)
                order = np.argsort(first, kind="stable")
                entries, starts, count = np.unique(first[order], return_index=True, return_counts=True)
                n[p, entries] += count
                total[p, entries] += np.add.reduceat(q[order, p], starts, axis=0)
            none = pa.nulls(batch.num_rows)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"), batch.column("q").cast(schema.field("q").type),
                listed(near), listed(bound), *[none.cast(schema.field(c).type) for c in ("part", "entry", "n", "total")],
            ], schema=schema)
        own = [(p, e, n[p, e], total[p, e].tolist()) for p, e in zip(*np.nonzero(n), strict=True)]
        own += [(-1, z, needed[z], None) for z in np.flatnonzero(needed)]
        if own:
            part, entry, count, sums = zip(*own, strict=True)
            none = pa.nulls(len(own))
            yield pa.RecordBatch.from_arrays([
                *[none.cast(schema.field(c).type) for c in ("vec_id", "label", "q", "near", "bound")],
                pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count, pa.int64()),
                pa.array(sums, pa.list_(pa.int64())),
            ], schema=schema)

    return work


def _last(books: np.ndarray, moved: np.ndarray | None, keep: int, schema: pa.Schema):
    """The last assignment: codes, and squared distances added up over the parts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, STEP) for whole in batches for at in range(0, whole.num_rows, STEP)):
            q, near, _, _ = _assigned(batch, books, moved, keep)
            first = near[:, :, 0].astype(np.int64)
            gap = q - books[np.arange(len(books)), first]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"),
                pa.array([row.tobytes().hex() for row in first.astype(np.uint8)], pa.string()),
                pa.array((gap * gap).sum((1, 2))),
            ], schema=schema)

    return work


def _moved_on(books: np.ndarray, sums: list) -> np.ndarray:
    """The entries after a round: floored means, unused ones as they were."""
    out = books.copy()
    for row in sums:
        if row.part >= 0:
            out[row.part, row.entry] = np.array(row.total, np.int64) // row.n
    return out


def _kept_next(keep: int, least: int, needed: dict[int, int], beyond: float) -> int:
    """The fewest entries, ``least`` at least, that suffice for all but a share ``beyond`` of the parts that
    the kept ones sufficed for; the others passed their outer bound and get new lists anyway."""
    listed = {entries: n for entries, n in needed.items() if entries <= keep}
    allowed, over = beyond * sum(listed.values()), 0
    for entries in sorted(listed, reverse=True):
        over += listed[entries]
        if over > allowed:
            return min(keep, max(least, entries))
    return least


def product_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    rounds: int = ROUNDS, entries: int = ENTRIES, beyond: float = BEYOND, trace: list | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` for every vector kept, and the codebooks by part, entry and position.

    ``trace`` collects, for each round, the entries kept, then how many entries parts needed: {entries: parts}.
    """
    kept = integer_vectors(vectors, id_col, vector_col, label_col)
    ordered = (F.col("vec_id").asc_nulls_last(), "q")
    kinds = {c: to_arrow_type(kept.schema[c].dataType) for c in ("vec_id", "label")}
    names = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in kinds)
    coded = f"{names}, code string, error long"
    first = kept.orderBy(*ordered).first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], coded), np.empty((PARTS, 0, 0), np.int64)
    kept = kept.where(F.size("q") == len(first.q))
    seeds = [row.q for row in kept.orderBy(*ordered).limit(entries).collect()]
    books = np.array(seeds, np.int64).reshape(len(seeds), PARTS, -1).transpose(1, 0, 2).copy()
    keep, least = max(1, len(seeds) // 4), max(1, len(seeds) // 8)
    state = pa.schema([
        *kinds.items(), ("q", pa.list_(pa.int32())), ("near", pa.list_(pa.int16())), ("bound", pa.list_(pa.float32())),
        ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64())),
    ])
    rows, moved = kept, None
    for _ in range(rounds):
        held = saved(rows.mapInArrow(_pass(books, moved, keep, state), f"{names}, q array<int>, {STATE}"), "codes")
        rows = held.where("part is null").select("vec_id", "label", "q", "near", "bound")
        sums = held.where("part is not null").groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(books.shape[2])]).alias("total")
        ).collect()
        needed = {row.entry: row.n for row in sums if row.part < 0}
        if trace is not None and needed:
            trace.append((keep, needed))
        if needed:
            keep = _kept_next(keep, least, needed, beyond)
        before, books = books, _moved_on(books, sums)
        moved = np.sqrt(((books - before) ** 2).sum(2).astype(np.float64))
    schema = pa.schema([*kinds.items(), ("code", pa.string()), ("error", pa.int64())])
    return saved(rows.mapInArrow(_last(books, moved, keep, schema), coded), "codes"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """The errors of a label added up, on each of its rows. The sums are a written table, so Spark knows how small they are."""
    sums = saved(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels").withColumnRenamed("label", "of")
    return coded.join(sums, coded["label"].eqNullSafe(sums["of"])).drop("of")


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
