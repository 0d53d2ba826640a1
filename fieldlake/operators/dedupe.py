"""One row per key, and the counts that show whether a table already has that."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] = (),
    deterministic: bool = True,
) -> DataFrame:
    """Keep one row per key.

    The survivor is the first row by ``order_by`` and then by every other column, so it does not
    depend on how the input is split. The rank filter is applied before the shuffle as well: each
    task sends at most one row per key, and a key that holds much of the table stays cheap.
    """
    if not deterministic:
        return df.dropDuplicates(list(keys))
    rest = [F.col(name) for name in df.columns if name not in keys]
    order = [*order_by, *rest] or [F.lit(1)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def duplicate_counts(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, distinct keys and rows beyond the first of a key. NULL is a key value.

    Without ``keys`` whole rows are compared.
    """
    per_key = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )
