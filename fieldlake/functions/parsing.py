"""Text to typed values. Malformed text becomes NULL unless ``strict``, where it stops the job."""

from pyspark.sql import Column, functions as F

from fieldlake.functions.text import blank_to_null

DATE_PATTERN = "yyyy-MM-dd"


def to_type(column: Column, from_type: str, to_type: str, strict: bool = False) -> Column:
    """Cast ``column`` to ``to_type``; equal types pass through."""
    if from_type == to_type:
        return column
    if from_type != "string":
        return column.cast(to_type) if strict else column.try_cast(to_type)
    text = blank_to_null(column)
    if to_type == "timestamp":
        return F.to_timestamp(text) if strict else F.try_to_timestamp(text)
    if to_type == "date":
        parse = F.to_date if strict else F.try_to_date
        return parse(text, DATE_PATTERN)
    if to_type == "boolean":
        return _flag(text)
    return text.cast(to_type) if strict else text.try_cast(to_type)


def _flag(text: Column) -> Column:
    """Only the words true and false are flags; a cast would also take t, y and 1."""
    word = F.lower(text)
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))
