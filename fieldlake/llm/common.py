"""What several operators share: written intermediate tables, words, and sizes of groups."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fieldlake.session import scratch_folder, scratch_run, shuffles_removed

#: A word, for Java's, DuckDB's and Python's patterns alike: no blank and none of the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared scratch folder; what follows reads them instead of recomputing.

    Shuffle files go when they are written, not when the driver collects garbage."""
    path = scratch_folder(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_alone(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """The rows that ``make`` returns, written as ``saved`` does; the tables it saved on the way are removed."""
    path = scratch_folder(spark, label)
    with scratch_run(spark, label), shuffles_removed(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column can clash; a null text is empty."""
    return df.select(df[id_col].alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text"))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def parts_for(rows: int, rows_per_part: int) -> int:
    """So many parts that each holds about ``rows_per_part`` rows."""
    return max(1, -(-rows // rows_per_part))


def row_wise(function: Callable, returns: str) -> Callable[..., Column]:
    """A plain function of one text as an Arrow-batched column function; null counts as empty."""
    @F.pandas_udf(returns)
    def batch(values: pd.Series) -> pd.Series:
        return pd.Series([function("" if v is None else v) for v in values], dtype=object)

    return batch


def one_of_each(docs: DataFrame, rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component of ``rows`` (``doc_id, text_hash, component``) the document that comes first, with all its columns."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    chosen = rows.groupBy("component").agg(first).select("first.doc_id", "first.text_hash")
    plain = [c for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    whole = docs.select(
        F.struct("*").alias("row"), docs[id_col].alias("doc_id"),
        F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("text_hash"), F.xxhash64(*plain).alias("turn"),
    )
    kept = whole.join(
        chosen, whole.doc_id.eqNullSafe(chosen.doc_id) & (whole.text_hash == chosen.text_hash), "left_semi"
    )
    one = Window.partitionBy("doc_id", "text_hash").orderBy("turn")
    return kept.withColumn("copy", F.row_number().over(one)).where("copy = 1").select("row.*")
