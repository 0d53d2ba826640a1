"""Column expressions for codes and free text."""

from pyspark.sql import Column, functions as F


def blank_to_null(column: Column) -> Column:
    """Trim spaces; a value of spaces only becomes NULL."""
    return F.nullif(F.trim(column), F.lit(""))


def code(column: Column) -> Column:
    """The comparable form of an identifier."""
    return F.upper(F.trim(column))
