"""Tables that are replaced as a whole, in folders by version, with manifests that say which one is current.

A write goes to a new folder that no reader knows. When it is complete, a manifest with the next number
is put beside the others by a rename that fails where the number is taken; a reader takes the folder that
the newest manifest names, once, and goes on reading it whatever is written meanwhile. So a reader sees one
version in full, a write that is killed leaves the table as it was, and of two writers at the same time the
second is told so. The newest ``kept`` versions stay; older ones, and what killed writes left under their
numbers, are removed after a write.

The rename must be atomic, as that of HDFS and of local files is.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from fieldlake.errors import SourceError

FORMAT = "versioned"
#: How the files of a version are compressed, unless the session names a codec.
CODEC = "zstd"
#: Versions that stay readable, the current one among them.
KEPT = 3
MANIFESTS, DATA, INDEX = "_versions", "_data", "_index"


class Files:
    """The file system of a path, for small files that the driver writes and reads."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """What lies in a folder, nothing where there is none."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(path))

    def read(self, path: str) -> str | None:
        """A small file, None where it is gone."""
        target = self._path(path)
        try:
            size = self._fs.getFileStatus(target).getLen()
            stream = self._fs.open(target)
        except Py4JJavaError as problem:
            if "FileNotFoundException" in str(problem.java_exception):
                return None
            raise
        try:
            reader = self._jvm.java.io.DataInputStream(stream)
            return bytes(reader.readNBytes(int(size))).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """A new small file, there in full or not at all; False where one of that name is there already."""
        folder, name = posixpath.split(path)
        partial, target = self._path(posixpath.join(folder, f".{name}.{uuid.uuid4().hex}")), self._path(path)
        stream = self._fs.create(partial, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        replace_nothing = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self._fs.makeQualified(partial), self._fs.makeQualified(target), replace_nothing)
        except Py4JJavaError as problem:
            self._fs.delete(partial, False)
            if "FileAlreadyExistsException" in str(problem.java_exception):
                return False
            raise
        return True

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _number(name: str) -> int:
    digits = name.split(".")[0].split("-")[0]
    return int(digits) if digits.isdigit() else -1


def codec(spark: SparkSession) -> str:
    """The codec of a table's files: the session's, if one is set there."""
    return spark.conf.get("spark.sql.parquet.compression.codec", CODEC)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    names = Files(spark, path).names(posixpath.join(path, MANIFESTS))
    return sorted(_number(name) for name in names if name.endswith(".json") and _number(name) >= 0)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict[str, Any] | None:
    """What is known of a version, of the current one by default; None where the table has no versions."""
    files = Files(spark, path)
    for _ in range(10):
        known = versions(spark, path)
        if not known:
            return None
        if version is not None and version not in known:
            raise SourceError(f"{path} holds the versions {known}, not {version}")
        text = files.read(posixpath.join(path, MANIFESTS, f"{known[-1] if version is None else version:012d}.json"))
        if text is not None:
            return json.loads(text)
    raise SourceError(f"{path} is replaced faster than it can be read")


def folder_of(spark: SparkSession, path: str, version: int | None = None) -> str | None:
    """The folder that holds a version, None where the table has no versions."""
    found = manifest(spark, path, version)
    return None if found is None else posixpath.join(path, DATA, found["folder"])


def next_folder(spark: SparkSession, path: str) -> tuple[int, str]:
    """The number of the version to come and a folder for its data."""
    number = max(versions(spark, path), default=0) + 1
    return number, posixpath.join(path, DATA, f"{number:012d}-{uuid.uuid4().hex}")


def publish(
    spark: SparkSession, path: str, number: int, folder: str, columns: Sequence[tuple[str, str]],
    counts: Mapping[str, int], kept: int = KEPT,
) -> None:
    """Make a written folder the current version, then remove those no longer kept."""
    told = {"version": number, "folder": posixpath.basename(folder), "columns": list(columns), "counts": dict(counts)}
    files = Files(spark, path)
    if not files.create(posixpath.join(path, MANIFESTS, f"{number:012d}.json"), json.dumps(told)):
        files.remove(folder)
        raise SourceError(f"{path}: another write made version {number} meanwhile")
    for part in (MANIFESTS, INDEX, DATA):
        for name in files.names(posixpath.join(path, part)):
            if 0 <= _number(name) <= number - kept:
                files.remove(posixpath.join(path, part, name))


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    folder = folder_of(spark, path, version)
    if folder is None:
        raise SourceError(f"no table at {path}")
    return spark.read.parquet(folder)
