"""Tables in versions: readers, killed writes, two writers, old versions."""

import pytest
from pyspark.sql import functions as F

from fieldlake.errors import SourceError
from fieldlake.sources import versions
from fieldlake.sources.batch import read_table, write_counted, write_table


def numbers(spark, n):
    return spark.range(n).select("id", (F.col("id") % 3).alias("part"))


def test_a_reader_keeps_its_version_while_the_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(numbers(spark, 10), path, "versioned") == 10
    before = read_table(spark, path)
    assert write_counted(spark.range(3).select(F.lit("x").alias("s")), path, "versioned", counts={"texts": "s"}) == {"rows": 3, "texts": 3}
    assert before.count() == 10 and sorted(before.columns) == ["id", "part"]
    after = read_table(spark, path, "versioned")
    assert after.columns == ["s"] and after.count() == 3
    assert versions.read_version(spark, path, 1).count() == 10
    assert versions.manifest(spark, path)["counts"] == {"rows": 3, "texts": 3}


def test_a_table_may_be_made_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(numbers(spark, 10), path, "versioned")
    kept = read_table(spark, path).where("part = 0")
    assert write_table(kept, path, "versioned", reads=[path], partition_by=("part",)) == 4
    assert {r.id for r in read_table(spark, path).collect()} == {0, 3, 6, 9}


def test_a_killed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(numbers(spark, 10), path, "versioned")
    broken = numbers(spark, 10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("killed"))).otherwise(F.lit(1)).alias("x"))
    with pytest.raises(Exception, match="killed"):
        write_table(broken, path, "versioned")
    _, left = versions.next_folder(spark, path)
    numbers(spark, 99).write.parquet(left)  # data without a manifest
    assert read_table(spark, path).count() == 10 and versions.versions(spark, path) == [1]
    assert write_table(numbers(spark, 5), path, "versioned") == 5
    assert read_table(spark, path).count() == 5


def test_of_two_writers_one_is_told(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    taken = versions.next_folder(spark, path)
    write_table(numbers(spark, 5), path, "versioned")
    monkeypatch.setattr(versions, "next_folder", lambda *_: taken)
    with pytest.raises(SourceError, match="version 1 meanwhile"):
        write_table(numbers(spark, 7), path, "versioned")
    assert read_table(spark, path).count() == 5
    assert not (tmp_path / "t" / "_data" / taken[1].rsplit("/", 1)[1]).exists()


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 7):
        write_table(numbers(spark, n), path, "versioned")
    assert versions.versions(spark, path) == [4, 5, 6]
    assert [versions.read_version(spark, path, v).count() for v in (4, 5, 6)] == [4, 5, 6]
    assert len(list((tmp_path / "t" / "_data").iterdir())) == 3
    with pytest.raises(SourceError, match=r"\[4, 5, 6\], not 2"):
        versions.read_version(spark, path, 2)


def test_plain_tables_and_missing_ones(spark, tmp_path):
    path = str(tmp_path / "plain")
    write_table(numbers(spark, 4), path)
    assert read_table(spark, path).count() == 4 and versions.versions(spark, path) == []
    with pytest.raises(SourceError, match="no table"):
        versions.read_version(spark, path)
    with pytest.raises(SourceError, match="no table"):
        read_table(spark, str(tmp_path / "none"), "versioned")
    with pytest.raises(SourceError, match="whole table"):
        write_table(numbers(spark, 4), str(tmp_path / "t"), "versioned", mode="append")
    with pytest.raises(Exception):
        spark.read.parquet(str(tmp_path)).count()


def test_small_files_are_whole_or_absent(spark, tmp_path):
    files = versions.Files(spark, str(tmp_path))
    assert files.names(str(tmp_path / "none")) == [] and files.read(str(tmp_path / "none")) is None
    assert files.create(str(tmp_path / "a" / "x.json"), "é1") and not files.create(str(tmp_path / "a" / "x.json"), "2")
    assert files.read(str(tmp_path / "a" / "x.json")) == "é1"
    assert [n for n in files.names(str(tmp_path / "a")) if not n.endswith(".crc")] == ["x.json"]
