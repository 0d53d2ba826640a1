"""Dimensions and facts from cleaned sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fieldlake.contracts import ModelSpec
from fieldlake.operators.cleaning import drop_null_keys
from fieldlake.operators.dedupe import dedupe

MONTH = "event_month"


def _keeps_key(spec: ModelSpec, unique_by: Sequence[str]) -> bool:
    return bool(unique_by) and set(spec.key) == set(unique_by) and all(spec.columns.get(k) == k for k in spec.key)


def build_model(
    source: DataFrame, spec: ModelSpec, deterministic: bool = True, unique_by: Sequence[str] = ()
) -> DataFrame:
    """The table a spec describes: one row per key, rows without the required columns left out.

    Optional foreign keys may be NULL. The result is not ordered; files are laid out by month where
    they are written. ``unique_by`` is a key the source is known to be unique by, as a passed gate
    shows; a model with the same key then is a projection without a shuffle.
    """
    picked = [F.expr(expression).alias(name) for name, expression in spec.columns.items()]
    if spec.latest_by is None:
        rows = drop_null_keys(source.select(*picked), spec.required)
        if _keeps_key(spec, unique_by):
            return rows
        return dedupe(rows, spec.key, deterministic=deterministic)
    rows = source.select(*picked, F.col(spec.latest_by).alias("_latest"))
    rows = drop_null_keys(rows, spec.required)
    newest = [F.col("_latest").desc_nulls_last()]
    return dedupe(rows, spec.key, newest, deterministic).drop("_latest")


def with_month(fact: DataFrame, spec: ModelSpec) -> DataFrame:
    """Add the month of the event date, by which a fact's table is partitioned."""
    if spec.event_date is None:
        return fact
    return fact.withColumn(MONTH, F.date_format(F.col(spec.event_date), "yyyy-MM"))
