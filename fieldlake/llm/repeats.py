"""Segments that need a look: those whose anchor occurs more than once in the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fieldlake.llm.common import saved

#: Bytes of text that a task turns into symbols at once.
SLICE = 4 << 20

def merged(spans) -> list[tuple[int, int]]:
    """Spans in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["from"], s["to"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeated_segments(found: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The segments under anchors that occur at least twice, and one row per different one of them.

    The latter holds ``h, sh, n, anchor, times, first, kinds, size``: ``times`` it occurs, ``first``
    (key, start) in order, how many ``kinds`` its anchor has and how many symbols they have together.
    Anchors and equal segments are counted where they lie before they are shuffled, so thousands of
    copies of a text travel as one; the counts are written, so that a hot anchor's side can be split.
    """
    anchors = saved(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), label)
    shared = saved(found.join(anchors, "h", "left_semi"), label)
    kinds = saved(
        shared.groupBy("h", "sh").agg(
            F.count("*").alias("times"), F.min("n").alias("n"), F.min("anchor").alias("anchor"),
            F.min(F.struct("doc_id", "text_hash", "start")).alias("first"),
        ),
        label,
    )
    each = saved(kinds.groupBy("h").agg(F.count("*").alias("kinds"), F.sum("n").alias("size")), label)
    looked = kinds.join(each, "h").select(
        "h", "sh", "n", "anchor", "times", "kinds", "size",
        F.struct(
            F.struct("first.doc_id", "first.text_hash").alias("key"), F.col("first.start").alias("start")
        ).alias("first"),
    )
    return shared.select(
        F.struct("doc_id", "text_hash").alias("key"), "h", "sh", "start", "n"
    ), saved(looked, label)


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``size`` bytes in a column, so that what a task makes of them stays small."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the key under which all rows of one id and text are found."""
    return docs.withColumn("key", F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash")))
