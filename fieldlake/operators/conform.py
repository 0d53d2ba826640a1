"""Typed serving tables and typed views over files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from fieldlake.contracts import ServingContract
from fieldlake.errors import ContractError

# SQL type names of the serving layer and what they are in Spark (fixed values).
SPARK_TYPES = {"datetime2": "timestamp", "float": "double", "bit": "boolean"}


def _width(kind: str) -> int | None:
    match = re.fullmatch(r"varchar\((\d+)\)", kind)
    return int(match.group(1)) if match else None


def _require(df: DataFrame, contract: ServingContract) -> None:
    missing = [name for name in contract.columns if name not in df.columns]
    if missing:
        raise ContractError(f"{contract.name}: missing columns {missing}")


def spark_schema(contract: ServingContract) -> str:
    """The contract as a Spark DDL schema."""
    kinds = {
        name: "string" if _width(kind) else SPARK_TYPES.get(kind, kind)
        for name, kind in contract.columns.items()
    }
    return ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())


def apply_contract(df: DataFrame, contract: ServingContract) -> DataFrame:
    """Exactly the contract's columns, order and types. A text that is too long stops the job."""
    _require(df, contract)
    columns = []
    for name, kind in contract.columns.items():
        column, width = F.col(name), _width(kind)
        if width is None:
            column = column.cast(SPARK_TYPES.get(kind, kind))
        else:
            column = column.cast("string")
            problem = F.raise_error(F.lit(f"{contract.name}.{name} is longer than {width}"))
            column = F.when(F.length(column) > width, problem.cast("string")).otherwise(column)
        columns.append(column.alias(name))
    return df.select(*columns)


def text_widths(df: DataFrame, contract: ServingContract) -> DataFrame:
    """Longest text per bounded column against its width: (column_name, longest, allowed)."""
    _require(df, contract)
    widths = {name: _width(kind) for name, kind in contract.columns.items() if _width(kind)}
    longest = df.agg(*[F.max(F.length(F.col(name))).alias(name) for name in widths])
    allowed = F.create_map(*[F.lit(part) for pair in widths.items() for part in pair])
    return longest.unpivot([], list(widths), "column_name", "longest").withColumn(
        "allowed", allowed[F.col("column_name")]
    )
