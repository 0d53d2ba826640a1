"""Appending the batches of a stream to a table, one row per key, without state beside the table.

A batch is first reduced to one row per key. Then rows whose key the table holds already are left out by an
anti join that reads keys only, and where the key holds the event time only between the times of the batch
(by day: only those days). What is left is appended, and the batch is entered in a log beside the stream's
checkpoint. So the table itself is the state, one row a key however often and in however many parts it came.
A batch that comes again writes nothing: if it is in the log, nothing is read either, and if it died before
that, its rows are found in the table.

With a horizon, rows older than that before the newest time of earlier batches are left out and counted;
the log carries the newest time on.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fieldlake.errors import SourceError
from fieldlake.operators.dedupe import dedupe
from fieldlake.sources import versions
from fieldlake.sources.batch import path_exists, read_table, write_counted
from fieldlake.sources.versions import Files

#: Entries of the log that stay; a stream repeats its last batch at most.
KEPT_BATCHES = 20
#: Beyond so many days in a batch the table is read from the first to the last of them.
MOST_DAYS = 100


def batch_folder(path: str, number: int) -> str:
    return posixpath.join(path, f"batch-{number:012d}")


def read_partials(spark: SparkSession, path: str) -> DataFrame | None:
    """The figures of all batches: those merged so far, and those of each batch since; None before the first."""
    files, merged = Files(spark, path), versions.manifest(spark, path)
    through = -1 if merged is None else merged["counts"]["through"]
    since = [n for n in map(_batch_number, files.names(path)) if n > through]
    parts = [batch_folder(path, n) for n in since if path_exists(spark, posixpath.join(batch_folder(path, n), "_SUCCESS"))]
    frames = [spark.read.parquet(*parts)] if parts else []
    if merged is not None:
        frames.append(versions.read_version(spark, path, merged["version"]))
    return None if not frames else frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def merge_partials(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], log: BatchLog) -> None:
    """Make one table of the figures of all finished batches, and remove theirs; readers see either."""
    through = max(log.entries, default=-1)
    known = [n for n in map(_batch_number, Files(spark, path).names(path)) if 0 <= n <= through]
    if not known:
        return
    number, folder = versions.next_folder(spark, path)
    merged = merge(read_partials(spark, path))
    merged.coalesce(1).write.parquet(folder)
    versions.publish(spark, path, number, folder, merged.dtypes, {"through": through})
    for n in known:
        Files(spark, path).remove(batch_folder(path, n))


def _batch_number(name: str) -> int:
    return int(name.removeprefix("batch-")) if name.startswith("batch-") else -1


@dataclass
class BatchLog:
    """What became of each batch: ``batch, added, late, newest`` and ``sure``, whether ``added`` is all it added."""

    spark: SparkSession
    folder: str
    entries: dict[int, dict] = field(default_factory=dict)

    def __post_init__(self):
        files = Files(self.spark, self.folder)
        for name in files.names(self.folder):
            if name.endswith(".json") and not name.startswith("."):
                text = files.read(posixpath.join(self.folder, name))
                if text:
                    entry = json.loads(text)
                    self.entries[entry["batch"]] = entry

    def _file(self, batch: int, kind: str) -> str:
        return posixpath.join(self.folder, f"{batch:012d}.{kind}")

    def begin(self, batch: int) -> bool:
        """Whether this is the first attempt at a batch."""
        return Files(self.spark, self.folder).create(self._file(batch, "begun"), "")

    def enter(self, entry: dict) -> None:
        files = Files(self.spark, self.folder)
        files.create(self._file(entry["batch"], "json"), json.dumps(entry))
        self.entries[entry["batch"]] = entry
        for batch in [b for b in self.entries if b <= entry["batch"] - KEPT_BATCHES]:
            for kind in ("json", "begun"):
                files.remove(self._file(batch, kind))
            del self.entries[batch]

    def newest(self) -> datetime | None:
        """The newest event time of all batches so far."""
        last = self.entries.get(max(self.entries, default=-1))
        return None if last is None or last["newest"] is None else datetime.fromisoformat(last["newest"])


@dataclass
class OncePerKey:
    """A ``foreachBatch`` sink: appends what a table does not hold yet.

    ``by_day`` names a date column that the table is partitioned by, made from ``event_time``; ``stamp`` is
    a column of the time of writing, named ``stamp_as``. ``partials`` makes mergeable figures of the rows that
    a batch adds, which go to a folder per batch before the rows do: a batch that died between the two
    keeps the figures it has, and adds the rows that are lacking.
    """

    spark: SparkSession
    path: str
    log_folder: str
    keys: Sequence[str]
    event_time: str
    fmt: str = "parquet"
    horizon: str | None = None
    by_day: str | None = None
    stamp_as: str | None = None
    stamp: Column | None = None
    partials: Callable[[DataFrame], DataFrame] | None = None
    partials_path: str | None = None
    added: int = 0
    late: int = 0
    sure: bool = True

    def __post_init__(self):
        self.log = BatchLog(self.spark, self.log_folder)
        if path_exists(self.spark, posixpath.join(self.path, "_spark_metadata")):
            raise SourceError(f"{self.path} was written by a stream's file sink, whose readers see no other rows; copy it first")

    def __call__(self, batch: DataFrame, number: int) -> None:
        if number in self.log.entries:
            return
        first = self.log.begin(number)
        before = self.log.newest()
        age = F.lit(before).cast("timestamp") - F.expr(f"interval {self.horizon}") if self.horizon and before else None
        is_late = F.lit(False) if age is None else F.coalesce(F.col(self.event_time) < age, F.lit(False))
        days = [F.collect_set(F.to_date(self.event_time)).alias("days")] if self.by_day else []
        seen = batch.select(F.col(self.event_time), is_late.alias("_late")).agg(
            F.max(self.event_time).alias("newest"), F.min(F.when(~F.col("_late"), F.col(self.event_time))).alias("oldest"),
            F.count_if("_late").alias("late"), *days,
        ).first()
        newest = max(filter(None, (before, seen.newest)), default=None)
        added = 0
        if seen.oldest is not None or self.event_time not in self.keys:
            added = self._append(batch if age is None else batch.where(~is_late), seen, number)
        self.added, self.late, self.sure = self.added + added, self.late + seen.late, self.sure and first
        self.log.enter({
            "batch": number, "added": added, "late": seen.late, "sure": first,
            "newest": None if newest is None else newest.isoformat(),
        })

    def _held(self, batch: DataFrame) -> DataFrame:
        """The keys of the table; their types are known, so no file is opened to learn them."""
        if self.fmt == "delta":
            return read_table(self.spark, self.path, self.fmt)
        named = dict.fromkeys([*self.keys, self.event_time])
        fields = [field for field in batch.schema.fields if field.name in named]
        if self.by_day:
            fields.append(T.StructField(self.by_day, T.DateType()))
        return self.spark.read.format(self.fmt).schema(T.StructType(fields)).load(self.path)

    def _append(self, batch: DataFrame, seen, number: int) -> int:
        rows = dedupe(batch, self.keys)
        if self.by_day:
            rows = rows.withColumn(self.by_day, F.to_date(self.event_time))
        if path_exists(self.spark, self.path):
            held = self._held(batch)
            if self.event_time in self.keys:
                held = held.where(F.col(self.event_time).between(F.lit(seen.oldest), F.lit(seen.newest)))
                if self.by_day and len(seen.days) <= MOST_DAYS:
                    held = held.where(F.col(self.by_day).isin(seen.days))
                elif self.by_day:
                    held = held.where(F.col(self.by_day).between(F.lit(min(seen.days)), F.lit(max(seen.days))))
            held = held.select(*[F.col(key).alias(f"_held_{key}") for key in self.keys])
            same = F.lit(True)
            for key in self.keys:
                same = same & F.col(key).eqNullSafe(F.col(f"_held_{key}"))
            rows = rows.join(held, same, "left_anti")
        if self.partials:
            own = batch_folder(self.partials_path, number)
            if not path_exists(self.spark, posixpath.join(own, "_SUCCESS")):
                self.partials(rows).coalesce(1).write.mode("overwrite").parquet(own)
        if self.stamp_as:
            rows = rows.withColumn(self.stamp_as, F.current_timestamp() if self.stamp is None else self.stamp)
        partition_by = (self.by_day,) if self.by_day else ()
        return write_counted(rows, self.path, self.fmt, mode="append", partition_by=partition_by)["rows"]
