"""What each file of a table holds, so that a read for certain values opens those files alone.

Beside a version of a table an index is kept with a row per file: rows, and for each indexed column the least
and greatest value and a bitmap of 32,768 bits in which the hash of every value sets one. A range skips the
files that lie outside it, a single value also those whose bitmap lacks its bit. The index is read by Spark
like any table; what reaches the driver is the list of files to open, and beyond ``MOST_FILES`` of them the
whole table is read with the same filter.
"""

from __future__ import annotations

import posixpath
from collections.abc import Mapping, Sequence
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldlake.errors import SourceError
from fieldlake.sources import versions

MOST_FILES = 20_000
BITS = 32_768
FILE = "_file"


def _bit(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(BITS))


def index_folder(folder: str) -> str:
    """Where the index of a version lies, by the folder of its data."""
    return posixpath.join(posixpath.dirname(posixpath.dirname(folder)), versions.INDEX, posixpath.basename(folder))


def write_index(spark: SparkSession, folder: str, columns: Sequence[str]) -> None:
    """Index the files of a written folder; only the indexed columns are read."""
    table = spark.read.parquet(folder)
    missing = [name for name in columns if name not in table.columns]
    if missing:
        raise SourceError(f"{folder}: no columns {missing} to index")
    told = [F.count(F.lit(1)).alias("rows")]
    for name in columns:
        told += [F.min(name).alias(f"low_{name}"), F.max(name).alias(f"high_{name}")]
        told.append(F.bitmap_construct_agg(F.when(F.col(name).isNotNull(), _bit(F.col(name)))).alias(f"bits_{name}"))
    file = F.col("_metadata.file_path").alias(FILE)
    table.groupBy(file).agg(*told).coalesce(1).write.parquet(index_folder(folder))


def _may_hold(name: str, kind: str, wanted: Any) -> Column:
    """Whether a file may hold a value, or one between two (None: open), by its row in the index."""
    low, high = wanted if isinstance(wanted, tuple) else (wanted, wanted)
    keep = F.lit(True)
    if low is not None:
        keep = keep & (F.col(f"high_{name}") >= F.lit(low).cast(kind))
    if high is not None:
        keep = keep & (F.col(f"low_{name}") <= F.lit(high).cast(kind))
    if not isinstance(wanted, tuple):
        bit = _bit(F.lit(wanted).cast(kind))
        byte = F.substring(F.col(f"bits_{name}"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
        keep = keep & (F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(bit, F.lit(8)).cast("int")) == 1)
    return keep


def _holds(name: str, kind: str, wanted: Any) -> Column:
    if not isinstance(wanted, tuple):
        return F.col(name) == F.lit(wanted).cast(kind)
    low, high = wanted
    keep = F.col(name).isNotNull()
    if low is not None:
        keep = keep & (F.col(name) >= F.lit(low).cast(kind))
    return keep if high is None else keep & (F.col(name) <= F.lit(high).cast(kind))


def files_with(spark: SparkSession, path: str, where: Mapping[str, Any], version: int | None = None) -> DataFrame | None:
    """``_file, rows`` of the files of a version that may hold what is wanted; None where it has no index for it."""
    folder = versions.folder_of(spark, path, version)
    if folder is None:
        raise SourceError(f"no versions of a table at {path}")
    place = index_folder(folder)
    if not versions.Files(spark, place).names(place):
        return None
    index = spark.read.parquet(place)
    kinds = {name[4:]: kind for name, kind in index.dtypes if name.startswith("low_")}
    if not set(where) & set(kinds):
        return None
    for name in where:
        if name in kinds:
            index = index.where(_may_hold(name, kinds[name], where[name]))
    return index.select(FILE, "rows")


def read_where(spark: SparkSession, path: str, where: Mapping[str, Any], version: int | None = None) -> DataFrame:
    """Rows of a table with versions that hold, by column, a value or one in a range ``(low, high)``, None being open."""
    folder = versions.folder_of(spark, path, version)
    found = files_with(spark, path, where, version)
    whole = spark.read.parquet(folder)
    table = whole
    if found is not None:
        files = [unquote(row[FILE]) for row in found.select(FILE).limit(MOST_FILES + 1).collect()]
        if not files:
            table = whole.where(F.lit(False))
        elif len(files) <= MOST_FILES:
            table = spark.read.schema(whole.schema).option("basePath", folder).parquet(*files)
    kinds = dict(whole.dtypes)
    for name, wanted in where.items():
        if name not in kinds:
            raise SourceError(f"{path}: no column {name}")
        table = table.where(_holds(name, kinds[name], wanted))
    return table
