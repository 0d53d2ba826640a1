"""Records of CSV files with free text, cut by many tasks.

A quoted field may hold line breaks, so the lines of such a file are not its records, and a task that
starts in the middle of a file cannot tell from there whether it starts inside a field. Quotes tell: they
come in pairs, a quote within a field being doubled, so a place lies inside a field if the number of
quotes before it is odd. One pass counts the quotes of every split, added up over the splits of a file
that says how each of them starts, and then each split cuts its own records. Only the pieces of a record
that lies across splits, at most two a split, are shuffled. Where no line has an odd number of quotes the
lines are the records, and Spark's own reader takes the files, split as it likes.

The files must hold a quote only where a field is quoted, as writers do that quote fields with quotes in them.
Blank lines are no records.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fieldlake.errors import SourceError

#: Splits of one read; what is known of each (some 100 bytes) is broadcast. More need larger
#: splits: ``spark.sql.files.maxPartitionBytes``.
MOST_SPLITS = 200_000
#: What a piece is: a whole record, a piece that goes on with an earlier split's record, or the start of one.
WHOLE, FURTHER, START = 0, 1, 2


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, start``: lines, and the file and the start of the split that they lie in, in order within a task."""
    try:
        lines = spark.read.option("lineSep", "\n").text(path)
    except AnalysisException as problem:
        raise SourceError(f"nothing to read at {path}") from problem
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def _odd_lines(lines: DataFrame) -> list:
    """Per split of a file, how many lines have an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(F.pmod(quotes, F.lit(2))).alias("odd"))
    splits = counted.limit(MOST_SPLITS + 1).collect()
    if len(splits) > MOST_SPLITS:
        raise SourceError(f"over {MOST_SPLITS} splits; raise spark.sql.files.maxPartitionBytes")
    return sorted(splits, key=lambda s: (s.file, s.start))


def _started(splits: Sequence) -> list[tuple]:
    """``file, start, number, inside, torn`` of every split: whether it starts in a field, and whether it starts or ends in one."""
    out, file, odd = [], None, 0
    for number, split in enumerate(splits):
        odd = odd if split.file == file else 0
        after = odd + split.odd
        out.append((split.file, split.start, number, odd % 2 == 1, odd % 2 == 1 or after % 2 == 1))
        file, odd = split.file, after
    return out


def _cutter(columns: Sequence[str], torn: bool):
    """Cuts lines into records: the whole ones, or with ``torn`` the pieces of those that lie across splits."""

    def check(header: str) -> None:
        found = next(csv.reader([header.removeprefix("﻿").removesuffix("\r")]), [])
        if [name.strip().lower() for name in found] != [name.lower() for name in columns]:
            raise ValueError(f"header {found} is not that of the contract, {list(columns)}")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, is_open, further, held, header = -1, False, False, [], False

        def batch_of(number: int, kind: int, records) -> pa.RecordBatch:
            text = records if isinstance(records, pa.Array) else pa.array(records, pa.string())
            n = len(text)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, number, np.int32)), pa.array(np.full(n, kind, np.int32)), text.cast(pa.string())],
                names=["number", "kind", "record"],
            )

        def rest() -> Iterator[pa.RecordBatch]:
            if held and torn:
                yield batch_of(split, FURTHER if further else START, ["\n".join(held)])

        for batch in batches:
            number = batch.column("number").to_numpy(zero_copy_only=False)
            odd = pc.count_substring(batch.column("line"), '"').to_numpy(zero_copy_only=False) & 1
            turns = np.flatnonzero(np.diff(number)) + 1
            for a, b in pairwise([0, *turns.tolist(), batch.num_rows]):
                if number[a] != split:
                    yield from rest()
                    split, held = int(number[a]), []
                    is_open = further = batch.column("inside")[a].as_py()
                    header = batch.column("start")[a].as_py() == 0
                lines = batch.column("line").slice(a, b - a)
                inside = (int(is_open) + np.cumsum(odd[a:b])) & 1
                is_open = bool(inside[-1])
                ends = np.flatnonzero(inside == 0)
                if not ends.size:
                    held += lines.to_pylist()
                    continue
                starts = np.concatenate([[0], ends[:-1] + 1])
                single = starts == ends
                single[0] &= not held and not further and not header
                many = []
                for k in np.flatnonzero(~single).tolist():
                    text = "\n".join([*(held if k == 0 else []), *lines.slice(starts[k], ends[k] - starts[k] + 1).to_pylist()])
                    if k == 0 and further:
                        if torn:
                            yield batch_of(split, FURTHER, [text])
                    elif k == 0 and header:
                        check(text)
                    else:
                        many.append(text)
                further = header = False
                held = lines.slice(int(ends[-1]) + 1).to_pylist()
                if not torn:
                    yield batch_of(split, WHOLE, lines.take(pa.array(ends[single])))
                    if many:
                        yield batch_of(split, WHOLE, many)
        yield from rest()

    return cut


PIECE = "number int, kind int, record string"


def quoted_records(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame | None:
    """``file, record`` of CSV files with the header ``columns``, or None where every line is a record.

    Quotes are counted at once; the records are cut when the frame is used, and files or splits that
    changed meanwhile are an error.
    """
    lines = text_lines(spark, path)
    counted = _odd_lines(lines)
    if not any(split.odd for split in counted):
        return None
    splits = _started(counted)
    known = spark.createDataFrame(splits, "file string, start long, number int, inside boolean, torn boolean")
    changed = F.raise_error(F.lit("files or their splits are not those whose quotes were counted"))
    marked = lines.join(F.broadcast(known), ["file", "start"], "left").select(
        F.coalesce("number", changed.cast("int")).alias("number"), "inside", "start", "torn", F.col("value").alias("line")
    )
    pieces = marked.drop("torn").mapInArrow(_cutter(columns, False), PIECE).select("number", "record")
    if any(torn for *_, torn in splits):
        parts = marked.where("torn").drop("torn").mapInArrow(_cutter(columns, True), PIECE)
        files = F.broadcast(known.select("file", F.col("number")))
        order = Window.partitionBy("file").orderBy("number", "kind")
        told = parts.join(files, "number").withColumn("nth", F.sum(F.when(F.col("kind") == START, 1).otherwise(0)).over(order))
        whole = told.groupBy("file", "nth").agg(
            F.min("number").alias("number"), F.sort_array(F.collect_list(F.struct("number", "kind", "record"))).alias("parts")
        )
        joined = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
        pieces = pieces.unionByName(whole.select("number", joined.alias("record")))
    record = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    named = pieces.join(F.broadcast(known.select("file", "number")), "number")
    return named.select("file", record.alias("record")).where(F.trim("record") != "")
