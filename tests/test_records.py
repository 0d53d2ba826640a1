"""Quoted CSV with line breaks in its fields, cut by many tasks."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from fieldlake.errors import SourceError
from fieldlake.plans.estate import FERTILIZER
from fieldlake.sources import records
from fieldlake.sources.batch import MALFORMED, SOURCE_FILE, read_raw, read_source

NAMES = FERTILIZER.column_names
BITS = ["a", "b,c", ' "hi" ', "\n", "\r\n", '"', "\n\n", "é", "x" * 50, ",", ""]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def write(path, rows, end="\r\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(NAMES)
        out.writerows(rows)


def some_rows(rng, n, wild=0.3):
    for i in range(n):
        note = "".join(rng.choice(BITS) for _ in range(rng.randint(1, 8))) if rng.random() < wild else f"note {i}"
        yield [f"f{i}", "2024-01-01 00:00:00", *[f"v{i}"] * (len(NAMES) - 3), note]


def found(df):
    return sorted(tuple(r[c] or "" for c in (NAMES[0], NAMES[3], NAMES[-1])) for r in df.collect())


def wanted(rows):
    return sorted((r[0], r[3], r[-1]) for r in rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("wild", [0.0, 0.02, 0.5])
def test_records_of_several_files_in_many_tasks(spark, tmp_path, small_splits, end, wild):
    rng, rows = random.Random(7), []
    for k in range(3):
        own = [[f"{k}-{r[0]}", *r[1:]] for r in some_rows(rng, 150, wild)]
        write(tmp_path / f"{k}.csv", own, end)
        rows += own
    df = read_raw(spark, FERTILIZER, str(tmp_path))
    assert df.rdd.getNumPartitions() > 4
    assert found(df) == wanted(rows)
    assert not any(r[MALFORMED] for r in df.collect())
    files = {r[SOURCE_FILE].rsplit("/", 1)[1]: r.n for r in df.groupBy(SOURCE_FILE).agg(F.count("*").alias("n")).collect()}
    assert files == {"0.csv": 150, "1.csv": 150, "2.csv": 150}


def test_a_field_longer_than_many_splits(spark, tmp_path, small_splits):
    rows = [["f0", "2024-01-01 00:00:00", *["v"] * (len(NAMES) - 3), "first"], ["f1", "2024-01-01 00:00:00", *["v"] * (len(NAMES) - 3), "line\n" * 3_000],
            ["f2", "2024-01-01 00:00:00", *["v"] * (len(NAMES) - 3), 'say ""yes""\n']]
    write(tmp_path / "a.csv", rows, "\n")
    df = read_source(spark, FERTILIZER, str(tmp_path / "a.csv"))
    assert {r[0]: r[NAMES[-1]] for r in df.collect()} == {r[0]: r[-1] for r in rows}


def test_the_same_rows_as_a_whole_file_reader(spark, tmp_path, small_splits):
    rows = list(some_rows(random.Random(1), 200))
    write(tmp_path / "a.csv", rows, "\n")
    with open(tmp_path / "a.csv", "a", encoding="utf-8") as f:
        f.write('too,short\n\nf-last,soon,"two\nlines",open\n')
    schema = f"{FERTILIZER.columns}, `{MALFORMED}` string"
    whole = spark.read.schema(schema).csv(str(tmp_path), header=True, quote='"', escape='"', multiLine=True, columnNameOfCorruptRecord=MALFORMED)
    ours = read_source(spark, FERTILIZER, str(tmp_path))
    assert ours.dtypes == whole.dtypes
    shown = lambda df: sorted(map(str, df.drop(MALFORMED).collect()))
    assert shown(ours) == shown(whole)
    bad = lambda df: sum(r[MALFORMED] is not None for r in df.collect())
    assert bad(ours) == bad(whole) > 0


def test_lines_that_are_records_go_to_the_plain_reader(spark, tmp_path):
    write(tmp_path / "a.csv", [["f1", "", *["v"] * (len(NAMES) - 3), 'quoted "word", and comma']])
    assert records.quoted_records(spark, str(tmp_path), NAMES) is None
    assert found(read_raw(spark, FERTILIZER, str(tmp_path))) == [("f1", "v", 'quoted "word", and comma')]


def test_wrong_headers_and_open_quotes(spark, tmp_path):
    with open(tmp_path / "a.csv", "w", encoding="utf-8") as f:
        f.write(",".join(NAMES[::-1]) + '\nf1,"a\nb"\n')
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, FERTILIZER, str(tmp_path)).collect()
    with open(tmp_path / "a.csv", "w", encoding="utf-8") as f:
        f.write("﻿" + ",".join(NAMES) + '\nf1,ok\nf2,"never\nclosed\n')
    rows = read_raw(spark, FERTILIZER, str(tmp_path)).collect()
    assert [r[0] for r in sorted(rows, key=lambda r: r[0] or "")][0] == "f1" and len(rows) == 2
    assert all(r[MALFORMED] is not None for r in rows)


def test_splits_must_be_those_that_were_counted(spark, tmp_path):
    write(tmp_path / "a.csv", list(some_rows(random.Random(2), 300)))
    df = read_raw(spark, FERTILIZER, str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        with pytest.raises(Exception, match="quotes were counted"):
            df.select("*").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert df.count() == 300


def test_missing_files_and_too_many_splits(spark, tmp_path, monkeypatch):
    with pytest.raises(SourceError, match="nothing to read"):
        read_source(spark, FERTILIZER, str(tmp_path / "none.csv"))
    write(tmp_path / "a.csv", [["f1"]])
    write(tmp_path / "b.csv", [["f1"]])
    monkeypatch.setattr(records, "MOST_SPLITS", 1)
    with pytest.raises(SourceError, match="maxPartitionBytes"):
        read_source(spark, FERTILIZER, str(tmp_path))
