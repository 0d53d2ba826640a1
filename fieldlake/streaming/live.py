"""Two restartable streams: incoming files to a raw table, raw table to a cleaned table."""

from __future__ import annotations

import posixpath
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldlake.contracts import SourceContract
from fieldlake.operators.cleaning import INGESTED_AT, clean_rows
from fieldlake.sources.batch import MALFORMED, SOURCE_FILE, csv_options, path_exists, read_table
from fieldlake.sources.layout import Layout
from fieldlake.streaming.once import OncePerKey, merge_partials

READING_DATE = "reading_date"


@dataclass(frozen=True)
class Drained:
    """Rows one run of a stream added, rows its table holds now, rows that came too late to be added."""

    added: int
    total: int
    late: int = 0


@dataclass(frozen=True)
class LiveRun:
    """What one run did to the two live tables: rows added, rows held now, rows dropped as late."""

    bronze_rows: int
    silver_rows: int
    bronze_total: int
    silver_total: int
    late_rows_dropped: int = 0


def read_stream(
    spark: SparkSession,
    contract: SourceContract,
    path: str,
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """New CSV files of a folder, as text, with the file each row came from."""
    reader = spark.readStream.schema(f"{contract.text_schema}, `{MALFORMED}` string")
    reader = reader.options(**csv_options(contract), multiLine=str(contract.free_text).lower())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def read_table_stream(
    spark: SparkSession, contract: SourceContract, path: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """New rows of a raw table. Rows of an append that did not complete are not seen."""
    reader = spark.readStream.format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt != "delta":
        reader = reader.schema(f"{contract.text_schema}, `{MALFORMED}` string, `{SOURCE_FILE}` string")
    return reader.load(path)


def table_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Rows of a live table, none before its first run. Parquet answers this from its footers."""
    return read_table(spark, path, fmt).count() if path_exists(spark, path) else 0


def drain(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> Drained:
    """Append all that is available to a table and stop.

    Added rows are the growth of the table, which has this stream as its only writer. A run that
    fails raises. The next run goes on from the checkpoint.
    """
    before = table_rows(df.sparkSession, path, fmt)
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(path).awaitTermination()
    total = table_rows(df.sparkSession, path, fmt)
    return Drained(total - before, total)


def first_per_key(
    rows: DataFrame, keys: tuple[str, ...], event_time: str | None = None, late_horizon: str | None = None
) -> DataFrame:
    """One row per key over the life of a stream that is written by a sink of its own; which copy arrives
    first is not specified.

    A key is one row of state, kept for ever unless ``late_horizon`` bounds it: then rows older than that,
    as seen by an earlier batch, are dropped. ``once.OncePerKey`` needs no such state.
    """
    if late_horizon:
        rows = rows.withWatermark(event_time, late_horizon)
        if event_time not in keys:
            keys = (*keys, event_time)
    return rows.dropDuplicates(list(keys))


def clean_stream(
    raw: DataFrame,
    contract: SourceContract,
    event_time: str = "timestamp",
    late_horizon: str | None = None,
    stamp: Column | None = None,
) -> DataFrame:
    """The batch cleaning rules on a stream, then one row per key, stamped with the batch time."""
    unique = first_per_key(clean_rows(raw, contract), contract.key, event_time, late_horizon)
    return unique.withColumn(INGESTED_AT, F.current_timestamp() if stamp is None else stamp)


def bronze_stream(
    spark: SparkSession, contract: SourceContract, layout: Layout, max_files: int | None = None
) -> Drained:
    """Incoming files to the raw live table."""
    raw = read_stream(spark, contract, layout.incoming(contract.name), max_files)
    return drain(
        raw,
        layout.live_bronze(contract.name),
        layout.checkpoint(f"{contract.name}_live_bronze"),
        layout.table_format,
    )


def silver_stream(
    spark: SparkSession,
    contract: SourceContract,
    layout: Layout,
    late_horizon: str | None = None,
    max_files: int | None = None,
    by_day: bool = False,
    event_time: str = "timestamp",
    partials: Callable[[DataFrame], DataFrame] | None = None,
    merge: Callable[[DataFrame], DataFrame] | None = None,
) -> Drained:
    """Raw live table to the cleaned live table, one row per key; of the copies in a batch the first by all columns.

    ``by_day`` partitions the cleaned table by the day of the reading, in ``reading_date``. ``partials`` makes
    figures of the rows each batch adds, kept at ``layout.live_partials`` and, with ``merge``, merged after
    every run, so that a status is read without the readings.
    """
    bronze, silver = layout.live_bronze(contract.name), layout.live_silver(contract.name)
    checkpoint = layout.checkpoint(f"{contract.name}_live_silver")
    raw = read_table_stream(spark, contract, bronze, layout.table_format, max_files)
    sink = OncePerKey(
        spark, silver, posixpath.join(checkpoint, "batches"), contract.key, event_time, layout.table_format,
        late_horizon, READING_DATE if by_day else None, INGESTED_AT, partials=partials,
        partials_path=layout.live_partials(contract.name) if partials else None,
    )
    writer = clean_rows(raw, contract).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    if partials and merge:
        merge_partials(spark, layout.live_partials(contract.name), merge, sink.log)
    return Drained(sink.added, table_rows(spark, silver, layout.table_format), sink.late)


def run_live(
    spark: SparkSession,
    contract: SourceContract,
    layout: Layout,
    late_horizon: str | None = None,
    max_files: int | None = None,
    by_day: bool = False,
) -> LiveRun:
    """Both streams in order, each until it is drained, in batches of ``max_files`` files at most."""
    bronze = bronze_stream(spark, contract, layout, max_files)
    silver = silver_stream(spark, contract, layout, late_horizon, max_files, by_day)
    return LiveRun(bronze.added, silver.added, bronze.total, silver.total, bronze.late + silver.late)
