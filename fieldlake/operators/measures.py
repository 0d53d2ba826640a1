"""Totals, trends, breakdowns and top-k over facts, as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

# Bits of the lower of two longs that small values are added in; either holds over 10^11 rows.
LOW_BITS = 27


def filter_in(df: DataFrame, choices: Mapping[str, Iterable[Any]]) -> DataFrame:
    """Keep rows whose columns hold one of the chosen values; no choice means no filter."""
    for name, values in choices.items():
        if picked := list(values):
            df = df.where(F.col(name).isin(picked))
    return df


def is_not(column: str, *values: Any) -> Column:
    """True unless the column holds one of ``values``; NULL holds none of them."""
    keep = F.lit(True)
    for value in values:
        keep = keep & ~F.col(column).eqNullSafe(F.lit(value))
    return keep


def exact_sum(column: Column) -> Column:
    """A sum of doubles that does not depend on the order of rows where they can be told exactly with 10
    places, as measures can: such values are added as whole numbers of the last place. Those below 2^19 in
    size, nearly all as a rule, are told by a product and a quotient of doubles (below it no two such numbers
    are the same double) and added as two longs, so that no decimal is made for them; larger ones are added
    as decimals. Values that cannot be told so (infinite, not a number, very large or finer) are added as
    doubles and join the exact rest at the end; nothing is left out or rounded."""
    scaled = F.rint(column * F.lit(1e10))
    is_small = F.coalesce((F.abs(column) < float(1 << 19)) & (scaled / F.lit(1e10) == column), F.lit(False))
    small = F.when(is_small, scaled.cast("long"))
    high, low = F.sum(F.shiftright(small, LOW_BITS)), F.sum(small.bitwiseAND(F.lit((1 << LOW_BITS) - 1)))
    large = F.when(~is_small, column.try_cast("decimal(28,10)"))
    is_large = F.coalesce(large.cast("double") == column, F.lit(False))
    larger, odd = F.sum(F.when(is_large, large)), F.sum(F.when(~is_small & ~is_large, column))
    units = (high.cast("decimal(20,0)") * F.lit(Decimal(1 << LOW_BITS)) + low.cast("decimal(20,0)")).cast("decimal(27,0)")
    # of these widths no place after the point is lost
    shares = [(units * F.lit(Decimal("0.0000000001"))).cast("decimal(37,10)"), larger.cast("decimal(37,10)")]
    exact = F.coalesce(shares[0], F.lit(Decimal(0))) + F.coalesce(shares[1], F.lit(Decimal(0)))
    total = F.when(high.isNotNull() | larger.isNotNull(), exact.cast("double"))
    return F.when(odd.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + odd)


def _sum_of(df: DataFrame, measure: str) -> Column:
    if dict(df.dtypes)[measure] in ("double", "float"):
        return exact_sum(F.col(measure).cast("double"))
    return F.sum(F.col(measure))


def sums(df: DataFrame, measures: Mapping[str, str]) -> dict[str, Column]:
    """Sum expressions by output name; doubles are added exactly."""
    return {out: _sum_of(df, measure).alias(out) for out, measure in measures.items()}


def breakdown(
    df: DataFrame,
    by: str | Sequence[str],
    measures: Mapping[str, str],
    rows_as: str | None = None,
    drop_null_keys: bool = False,
) -> DataFrame:
    """Sums per group, and the number of rows when ``rows_as`` names it."""
    keys = [by] if isinstance(by, str) else list(by)
    if drop_null_keys:
        df = df.dropna(subset=keys)
    columns = list(sums(df, measures).values())
    if rows_as:
        columns.append(F.count(F.lit(1)).alias(rows_as))
    return df.groupBy(*keys).agg(*columns)


def count_by(
    df: DataFrame, by: str, of: str | None = None, name: str = "rows", drop_null_keys: bool = False
) -> DataFrame:
    """Rows per group, or non-NULL values of ``of`` per group."""
    if drop_null_keys:
        df = df.dropna(subset=[by])
    return df.groupBy(by).agg(F.count(F.col(of) if of else F.lit(1)).alias(name))


def largest_first(df: DataFrame, value: str, key: str) -> DataFrame:
    """Order a small result by value, ties by key."""
    return df.orderBy(F.col(value).desc_nulls_last(), F.col(key).asc_nulls_first())


def top_k(df: DataFrame, value: str, key: str, n: int = 10) -> DataFrame:
    """The ``n`` groups with the largest value; ties go by key, so the choice is fixed."""
    return largest_first(df, value, key).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def first_rows(df: DataFrame, by: Sequence[str], n: int = 5) -> DataFrame:
    """A few rows to look at, the first by ``by``."""
    return df.orderBy(*by).limit(n)
