"""Raw rows to cleaned rows, driven by a source contract. Works on batch frames and streams."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.contracts import SourceContract
from fieldlake.errors import ContractError
from fieldlake.functions.parsing import to_type
from fieldlake.functions.text import blank_to_null, code
from fieldlake.operators.dedupe import dedupe

INGESTED_AT = "_ingested_at"


def nullify_blanks(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Trim the listed columns and turn blanks into NULL; unknown columns are ignored."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: blank_to_null(F.col(name)) for name in present})


def standardize(df: DataFrame, codes: Iterable[str] = (), trims: Iterable[str] = ()) -> DataFrame:
    """Upper-case and trim ``codes``, trim ``trims``."""
    rules = {name: F.trim(F.col(name)) for name in trims}
    rules |= {name: code(F.col(name)) for name in codes}
    return df.withColumns(rules)


def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def _cleaned(
    contract: SourceContract, name: str, present: str, blank_key_is_null: bool, strict: bool
) -> Column:
    column = F.col(name)
    if present == "string" and contract.clean_types[name] == "string":
        if name in contract.codes:
            column = code(column)
        elif name in contract.trims:
            column = F.trim(column)
        is_key = name in contract.key or name in contract.required
        if name in contract.blanks or (is_key and blank_key_is_null):
            column = blank_to_null(column)
    return to_type(column, present, contract.clean_types[name], strict)


def clean_rows(
    df: DataFrame,
    contract: SourceContract,
    blank_key_is_null: bool = True,
    strict_parse: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Standardise, parse and drop rows without their required columns; duplicates stay.

    Columns in ``keep`` are passed on beside the contract's. One projection does all columns. The NULL filter is stated on the raw columns too, where it
    reaches the scan.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = [name for name in contract.column_names if name not in types]
    if missing:
        raise ContractError(f"{contract.name}: missing columns {missing}")
    cleaned = drop_null_keys(df, contract.required).select(
        *[
            _cleaned(contract, name, types[name], blank_key_is_null, strict_parse).alias(name)
            for name in contract.column_names
        ],
        *keep,
    )
    return drop_null_keys(cleaned, contract.required)


def clean(
    df: DataFrame,
    contract: SourceContract,
    run_ts: Column | None = None,
    blank_key_is_null: bool = True,
    strict_parse: bool = False,
    deterministic: bool = True,
) -> DataFrame:
    """The cleaned table of a batch source: one row per key, stamped with ``run_ts`` when given."""
    rows = clean_rows(df, contract, blank_key_is_null, strict_parse)
    unique = dedupe(rows, contract.key, deterministic=deterministic)
    return unique if run_ts is None else unique.withColumn(INGESTED_AT, run_ts)


def parse_losses(df: DataFrame, contract: SourceContract) -> DataFrame:
    """Per parsed column, how many non-blank texts did not parse: (column_name, lost_values)."""
    texts = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    columns = [name for name in contract.parsed_columns if name in texts]
    lost = [
        F.count_if(
            blank_to_null(F.col(name)).isNotNull()
            & to_type(F.col(name), "string", contract.clean_types[name]).isNull()
        ).alias(name)
        for name in columns
    ]
    if not lost:
        return df.sparkSession.createDataFrame([], "column_name string, lost_values bigint")
    return df.agg(*lost).unpivot([], columns, "column_name", "lost_values")
