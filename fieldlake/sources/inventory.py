"""Are two folders of files the same, and did every source land?"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fieldlake.contracts import SourceContract
from fieldlake.sources.batch import path_exists, qualified, read_raw
from fieldlake.sources.layout import Layout


# A local path has one slash or three after its scheme, as the reader of the files likes it.
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def _below(spark: SparkSession, root: str) -> Column:
    """The column ``path``, relative to ``root``."""
    folder = re.sub(_SCHEME, r"\1:/", qualified(spark, root)).rstrip("/") + "/"
    return F.substr(F.regexp_replace("path", _SCHEME, "$1:/"), F.lit(len(folder) + 1))


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` without their content: (file, length, uri)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(_below(spark, root).alias("file"), "length", F.col("_metadata.file_path").alias("uri"))


def file_inventory(spark: SparkSession, root: str, by_folder: bool = False) -> DataFrame:
    """Every file below ``root``: (file, files, length, lines, digest).

    The digest adds up a hash of each line with its number in the file, so that lines may be hashed
    by many tasks and a file of any length is read in splits; how it is split does not show. A line
    ends with a line feed alone, the rest of a file is taken as it is. Spark's readers pass over files
    without a byte, so those are not listed. With ``by_folder`` the files
    of a folder count as one, whatever their names, as a distributed writer gives new names each time.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(root).select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    # A split is read by one task from front to back, so only the lines before it are missing.
    splits = lines.groupBy("uri", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("uri").orderBy("block")
    starts = splits.select("uri", "block", (F.sum("n").over(earlier) - F.col("n") - F.col("first")).alias("start"))
    line = F.xxhash64(F.col("start") + F.col("at"), "value").cast("decimal(20,0)")
    digests = lines.join(starts, ["uri", "block"]).groupBy("uri").agg(
        F.count("*").alias("lines"), F.sum(line).cast("decimal(38,0)").alias("digest")
    )
    name = F.regexp_replace("file", "/?[^/]*$", "") if by_folder else F.col("file")
    files = _listed(spark, root).join(digests, "uri", "left")
    return files.groupBy(name.alias("file")).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("length"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
        F.coalesce(F.sum("digest"), F.lit(0)).alias("digest"),
    )


def compare_file_trees(spark: SparkSession, left: str, right: str, by_folder: bool = False) -> DataFrame:
    """Files of two folders side by side: (file, status, left_length, right_length, left_lines, right_lines).

    ``status`` is same, changed, left_only or right_only.
    """
    a = file_inventory(spark, left, by_folder).alias("a")
    b = file_inventory(spark, right, by_folder).alias("b")
    same = (F.col("a.length") == F.col("b.length")) & (F.col("a.digest") == F.col("b.digest"))
    status = (
        F.when(F.col("b.length").isNull(), "left_only")
        .when(F.col("a.length").isNull(), "right_only")
        .when(same & (F.col("a.lines") == F.col("b.lines")), "same")
        .otherwise("changed")
    )
    sides = [F.col(f"{side}.{of}").alias(f"{name}_{of}") for of in ("length", "lines")
             for side, name in (("a", "left"), ("b", "right"))]
    return a.join(b, "file", "full").select("file", status.alias("status"), *sides)


def landed_files(spark: SparkSession, layout: Layout, contracts: Mapping[str, SourceContract]) -> DataFrame:
    """One row per contract and per stranger below the landing folder: (name, status, files, rows).

    ``status`` is ok, missing, empty (no rows) or stranger (a folder or file no contract names).
    A source may land as one file or as a folder of its file's name. A file without a byte is no file.
    """
    owner = F.coalesce(*[
        F.when((F.col("file") == file) | F.startswith("file", F.lit(file + "/")), key)
        for key, file in ((key, f"{key}/{contract.file_name}") for key, contract in contracts.items())
    ])
    files = (
        _listed(spark, layout.landing(""))
        .groupBy(F.coalesce(owner, "file").alias("name"), owner.isNull().alias("stranger"))
        .agg(F.count("*").alias("files"))
    )
    rows = spark.createDataFrame([], "name string, rows bigint")
    for key, contract in contracts.items():
        path = layout.landing(key, contract.file_name)
        if path_exists(spark, path):
            rows = rows.unionByName(
                read_raw(spark, contract, path).agg(F.lit(key).alias("name"), F.count(F.lit(1)).alias("rows"))
            )
    wanted = spark.createDataFrame([(key,) for key in contracts], "name string")
    all_names = wanted.join(files, "name", "full").join(rows, "name", "left")
    status = (
        F.when(F.col("stranger"), "stranger")
        .when(F.col("files").isNull(), "missing")
        .when(F.col("rows") > 0, "ok")
        .otherwise("empty")
    )
    return all_names.select("name", status.alias("status"), F.coalesce("files", F.lit(0)).alias("files"), "rows")
