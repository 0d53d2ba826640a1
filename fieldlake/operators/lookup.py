"""Lookups, membership and orphan checks between facts and reference tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.errors import ContractError
from fieldlake.functions.text import code
from fieldlake.operators.dedupe import dedupe

# A key with more than one part in this many of all rows is hot; there cannot be more such keys.
HOT_KEYS = 50_000
# The same for keys found by sketches, of which a task holds eight counters for each.
HEAVY_KEYS = 1_000
MOST_COUNTERS = 1 << 19
# Sketches are merged in so many parts before they meet.
SKETCH_PARTS = 64


def is_small(df: DataFrame, rows: int = 100_000, size: int = 64 * 1024 * 1024) -> bool:
    """True when ``df`` is measured to have at most ``rows`` rows and ``size`` bytes of values.

    Every task adds up its own part, so measuring moves one row per task.
    """
    width = F.lit(0)
    for name in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return found["n"] <= rows and (found["b"] or 0) <= size


def hot_keys(df: DataFrame, on: Sequence[str], limit: int = HOT_KEYS) -> DataFrame:
    """Keys that hold more than 1/limit of the rows that have a key: never more than ``limit``.

    The total is added up from the same per-key counts, so the frame is counted once.
    """
    per_key = df.dropna(subset=list(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    total = per_key.agg(F.sum("_rows").alias("_total"))
    return per_key.where(F.col("_rows") * limit > total.scalar()).select(*on)


def heavy_keys(df: DataFrame, on: Sequence[str], limit: int = HEAVY_KEYS) -> DataFrame:
    """The keys that ``hot_keys`` finds for the same ``limit``, without a shuffle of all keys.

    Every task keeps a bounded number of counters (a frequent item sketch of key hashes, which underrates a
    key by a known share of all rows at most), the sketches are merged in parts and then to one, and only
    the rows of the keys that may be heavy by it, at most ``2 * limit`` hashes, are counted exactly. The
    result, at most ``limit`` rows, is a local frame: using it runs nothing again.
    """
    # a key over 1/limit of n rows keeps over (1 - 3.5/8)/limit of them in its counter; under 2 * limit keys do
    counters = 1 << (8 * limit - 1).bit_length()
    if counters > MOST_COUNTERS:
        raise ContractError(f"limit {limit} needs over {MOST_COUNTERS} counters a task; hot_keys counts every key")
    keyed = df.dropna(subset=list(on)).select(*on).withColumn("_hash", F.xxhash64(*on))
    spark, kinds = df.sparkSession, df.select(*on).schema
    if keyed.isEmpty():  # there is no sketch of nothing
        return spark.createDataFrame([], kinds)
    part = F.pmod(F.spark_partition_id(), F.lit(SKETCH_PARTS)).alias("_part")
    sketched = keyed.groupBy(part).agg(
        F.expr(f"approx_top_k_accumulate(_hash, {counters})").alias("_sketch"), F.count(F.lit(1)).alias("_rows")
    )
    merged = sketched.agg(F.expr(f"approx_top_k_combine(_sketch, {counters})").alias("_sketch"), F.sum("_rows").alias("_rows"))
    found = merged.select(F.expr(f"approx_top_k_estimate(_sketch, {2 * limit})").alias("_top"), "_rows").first()
    maybe = spark.createDataFrame([(item["item"],) for item in found["_top"]], "_hash long")
    counted = keyed.join(F.broadcast(maybe), "_hash", "left_semi").groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    heavy = counted.where(F.col("_n") * limit > F.lit(found["_rows"])).select(*on).collect()
    return spark.createDataFrame(heavy, kinds)


def _join_unique(fact: DataFrame, ref: DataFrame, on: list[str], hot: DataFrame | None) -> DataFrame:
    """Left join on a reference with one row per key. Building it runs no job, and reads the fact once.

    Rows with a NULL key look for nothing, so they go through the shuffle spread evenly. Whether the
    reference is small enough to be broadcast, and which shuffled partitions are to be split, is
    decided while running, from measured sizes: both sides are plain shuffles on the key and the
    spread. Keys that the caller names as ``hot`` get their reference row by broadcast and their fact
    rows are spread as well; any such set gives the same result.
    """
    taken = [name for name in ref.columns if name not in on]
    nothing_to_find = F.lit(False)
    for name in on:
        nothing_to_find = nothing_to_find | F.col(name).isNull()
    row = F.xxhash64(F.spark_partition_id(), *[F.col(name) for name in fact.columns])
    if hot is not None:
        values = [F.col(name).alias(f"_hot{name}") for name in taken]
        known = hot.select(*on).dropna().distinct().join(ref, on, "left").select(*on, F.lit(True).alias("_hot"), *values)
        # what is broadcast is measured; of hot rows that are too many or too large none is kept apart
        if not is_small(known):
            return _join_unique(fact, ref, on, None)
        fact = fact.join(F.broadcast(known), on, "left")
        nothing_to_find = nothing_to_find | F.col("_hot").isNotNull()
    spread = F.when(nothing_to_find, F.pmod(row, F.lit(1 << 30)) + 1).otherwise(F.lit(0).cast("bigint"))
    # A computed zero: a literal would be folded out of the join keys, and the rows not be spread.
    zero = F.pmod(F.xxhash64(*on), F.lit(1).cast("bigint"))
    joined = fact.withColumn("_spread", spread).join(ref.withColumn("_spread", zero), [*on, "_spread"], "left")
    if hot is not None:
        is_hot = F.col("_hot").isNotNull()
        joined = joined.withColumns(
            {name: F.when(is_hot, F.col(f"_hot{name}")).otherwise(F.col(name)) for name in taken}
        )
    kept = [name for name in fact.columns if not name.startswith("_hot")]
    return joined.select(*kept, *taken)


def lookup(
    fact: DataFrame,
    ref: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, Any],
    order_by: Sequence[Column] = (),
    normalise: bool = False,
    unique: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add reference columns to every fact row, with a default where there is nothing to add.

    ``on`` maps fact columns to reference columns and ``take`` maps reference columns to their
    defaults. One reference row per key is used, the first by ``order_by``, so the fact never fans
    out; ``unique`` says that there is only one, as in a dimension, and saves looking for it.
    ``normalise`` compares text keys upper-cased and trimmed. ``hot`` names fact keys to be kept
    apart, as found by ``heavy_keys`` or ``hot_keys`` or known beforehand; only their own reference rows are
    measured, and broadcast where they are small (100,000 rows, 64 MB).
    """
    slots = {left: f"_key_{i}" for i, left in enumerate(on)}
    keys = list(slots.values())
    keyed = _keyed(fact, {slot: left for left, slot in slots.items()}, normalise)
    reference = _keyed(ref, {slots[left]: right for left, right in on.items()}, normalise).dropna(subset=keys)
    taken = {name: f"_take_{name}" for name in take}
    picked = [*keys, *[F.col(name).alias(slot) for name, slot in taken.items()]]
    if order_by and not unique:
        reference = dedupe(reference, keys, order_by)
    reference = reference.select(*picked)
    if not order_by and not unique:
        reference = dedupe(reference, keys)
    apart = None if hot is None else _keyed(hot, {slot: left for left, slot in slots.items()}, normalise)
    joined = _join_unique(keyed, reference, keys, apart)
    filled = {
        name: F.col(slot) if take[name] is None else F.coalesce(F.col(slot), F.lit(take[name]))
        for name, slot in taken.items()
    }
    kept = [name for name in fact.columns if name not in filled]
    return joined.select(*kept, *[column.alias(name) for name, column in filled.items()])


def _keyed(df: DataFrame, slots: Mapping[str, str], normalise: bool) -> DataFrame:
    """Add the key columns to be compared, text ones in their comparable form if wanted."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {
            slot: code(F.col(name)) if normalise and kinds[name] == "string" else F.col(name)
            for slot, name in slots.items()
        }
    )


def keep_members(
    df: DataFrame,
    members: DataFrame,
    on: Sequence[str],
    normalise: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``members``; as skew-proof as ``lookup``."""
    slots = {f"_key_{i}": name for i, name in enumerate(on)}
    keys = list(slots)
    listed = _keyed(members.select(*on), slots, normalise).select(*keys).dropna().distinct()
    listed = listed.withColumn("_member", F.lit(True))
    apart = None if hot is None else _keyed(hot, slots, normalise)
    found = _join_unique(_keyed(df, slots, normalise), listed, keys, apart)
    return found.where(F.col("_member")).select(*df.columns)


def orphan_keys(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with their number of rows; NULL keys are no orphans.

    Child rows are counted per key before the join, so a hot key is one row in it.
    """
    left = list(on)
    per_key = child.dropna(subset=left).groupBy(*left).agg(F.count(F.lit(1)).alias("child_rows"))
    known = parent.select(*[F.col(right).alias(name) for name, right in on.items()]).distinct()
    return per_key.join(known, left, "left_anti")


def orphan_summary(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """One row: child rows by what became of their key: orphan rows and keys, and NULL keys."""
    left = list(on)
    per_key = child.groupBy(*left).agg(F.count(F.lit(1)).alias("child_rows"))
    known = parent.select(*[F.col(right).alias(name) for name, right in on.items()]).distinct()
    known = known.withColumn("_known", F.lit(True))
    has_null = F.lit(False)
    for name in left:
        has_null = has_null | F.col(name).isNull()
    orphan = ~has_null & F.col("_known").isNull()
    return per_key.join(known, left, "left").agg(
        F.coalesce(F.sum("child_rows"), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.when(orphan, F.col("child_rows"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("child_rows"))), F.lit(0)).alias("null_key_rows"),
    )


def distinct_union(*frames: DataFrame) -> DataFrame:
    """The set of all rows of the frames, by column name. Tasks drop their own repeats before the
    one shuffle."""
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union.distinct()
