"""What a batch run holds on disk: compressed files, as many versions as the layout keeps, few tables at a time."""

import datetime
import os
import threading

import pytest
from pyspark.sql import functions as F

from catalogue import runs
from fieldlake.errors import SourceError
from fieldlake.plans import batch
from fieldlake.plans.estate import BATCH_SOURCES, MODELS
from fieldlake.session import SCRATCH
from fieldlake.sources.batch import read_raw, read_table, write_table
from fieldlake.sources.layout import Layout
from fieldlake.sources.versions import versions

STAMP = datetime.datetime(2024, 1, 2)


def land(spark, layout, name, rows, **options):
    contract = BATCH_SOURCES[name]
    empty = dict.fromkeys(contract.column_names)
    frame = spark.createDataFrame([{**empty, **row} for row in rows], contract.text_schema)
    runs.deliver(frame, layout.landing(name, contract.file_name), **options)


def land_two(spark, layout):
    day = "2024-01-01 00:00:00"
    land(spark, layout, "weather", [{"timestamp": day, "station_id": f"STN{i}"} for i in range(20)])
    land(spark, layout, "harvest", [{"timestamp": day, "harvest_id": f"HVT{i}"} for i in range(30)])


def names_under(folder):
    return {name for _, _, names in os.walk(folder) for name in names if not name.startswith((".", "_SUCCESS"))}


@pytest.mark.parametrize("kept", [1, 2])
def test_as_many_versions_stay_as_the_layout_keeps(spark, tmp_path, kept):
    layout = Layout(str(tmp_path), kept_versions=kept)
    land_two(spark, layout)
    for _ in range(3):
        run = batch.run_batch(spark, layout, STAMP, sources=["weather", "harvest"])
    paths = [layout.bronze("harvest"), layout.silver("harvest"), layout.gold("fact_harvest"), layout.quality("latest")]
    for path in paths:
        assert len(versions(spark, path)) == len(os.listdir(os.path.join(path, "_data"))) == kept
    assert len(os.listdir(os.path.join(layout.gold("fact_harvest"), "_index"))) == kept
    assert [read_table(spark, path).count() for path in paths] == [30, 30, 30, 12]
    assert run.gold == {"fact_harvest": 30}


def test_a_table_keeps_a_version(tmp_path):
    with pytest.raises(SourceError, match="one version at least"):
        Layout(str(tmp_path), kept_versions=0)


def test_files_of_a_version_are_zstd_unless_the_session_names_a_codec(spark, tmp_path):
    ours, theirs, setting = str(tmp_path / "a"), str(tmp_path / "b"), "spark.sql.parquet.compression.codec"
    write_table(spark.range(5), ours, "versioned")
    spark.conf.set(setting, "gzip")
    try:
        write_table(spark.range(5), theirs, "versioned")
    finally:
        spark.conf.unset(setting)
    assert all(n.endswith(".zstd.parquet") for n in names_under(os.path.join(ours, "_data")))
    assert all(n.endswith(".gz.parquet") for n in names_under(os.path.join(theirs, "_data")))
    assert read_table(spark, ours).count() == read_table(spark, theirs).count() == 5


def test_compressed_files_hold_the_same_records(spark, tmp_path):
    rows = [{"attendance_id": f"A{i}", "remarks": f'said "go",\nthen {i}\n' if i % 3 else None} for i in range(200)]
    found = []
    for kind, options in (("plain", {}), ("gz", {"compression": "gzip"})):
        layout = Layout(str(tmp_path / kind))
        land(spark, layout, "hr", rows, **options)
        path = layout.landing("hr", BATCH_SOURCES["hr"].file_name)
        assert any(name.endswith(".csv.gz") for name in names_under(path)) == (kind == "gz")
        found.append(sorted(map(str, read_raw(spark, BATCH_SOURCES["hr"], path).drop("_source_file").collect())))
    assert found[0] == found[1] and len(found[0]) == 200


@pytest.mark.parametrize("most", [1, 2])
def test_no_more_tables_are_built_at_a_time_than_told(spark, tmp_path, monkeypatch, most):
    layout, now, seen, lock = Layout(str(tmp_path)), [0], [], threading.Lock()
    land_two(spark, layout)

    def counted(build):
        def one(*args, **options):
            with lock:
                now[0] += 1
                seen.append(now[0])
            try:
                return build(*args, **options)
            finally:
                with lock:
                    now[0] -= 1

        return one

    for name in ("build_bronze", "build_silver", "build_gold", "quality_report"):
        monkeypatch.setattr(batch, name, counted(getattr(batch, name)))
    batch.run_batch(spark, layout, STAMP, sources=["weather", "harvest"], side_by_side=most)
    assert len(seen) == 7 and max(seen) <= most


def test_the_kept_report_is_that_of_all_sources(spark, tmp_path):
    layout = Layout(str(tmp_path))
    land_two(spark, layout)
    batch.run_batch(spark, layout, STAMP, sources=["weather", "harvest"])
    whole = batch.quality_report(spark, layout, [BATCH_SOURCES["weather"], BATCH_SOURCES["harvest"]], STAMP.date())
    kept = read_table(spark, layout.quality("latest"))
    assert kept.dtypes == whole.dtypes
    assert sorted(map(str, kept.collect())) == sorted(map(str, whole.collect()))


def test_a_rerun_holds_each_table_once_and_leaves_nothing(spark, tmp_path, monkeypatch):
    day = F.lit("1996-03-05").cast("timestamp_ntz")
    n = F.col("id") + 1
    tables = {
        "orders": spark.range(30).select(
            n.alias("o_orderkey"), n.alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(9.5).alias("o_totalprice"),
            day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
        ),
        "lineitem": spark.range(40).select(
            n.alias("l_orderkey"), n.alias("l_partkey"), n.alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
            F.lit(7.0).alias("l_quantity"), F.lit(9.5).alias("l_extendedprice"), F.lit(0.01).alias("l_discount"),
            F.lit(0.02).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate"),
        ),
        "events": spark.range(50).select(
            n.alias("event_id"), day.alias("ts"), n.alias("user_id"), F.lit("purchase").alias("event_type"), F.lit(2.5).alias("value"),
        ),
    }
    for name, rows in tables.items():
        rows.coalesce(1).write.parquet(str(tmp_path / "in" / f"{name}.parquet"))
    seen = []

    def watched(spark, layout, *args, **options):
        run = batch.run_batch(spark, layout, *args, **options)
        paths = [*map(layout.bronze, BATCH_SOURCES), *map(layout.silver, BATCH_SOURCES), *map(layout.gold, MODELS)]
        landed = {name for name in names_under(os.path.join(layout.root, "landing"))}
        seen.append(([len(os.listdir(os.path.join(p, "_data"))) for p in paths], all(n.endswith(".csv.gz") for n in landed)))
        return run

    monkeypatch.setattr(runs, "run_batch", watched)
    scratch = tmp_path / "scratch"
    spark.conf.set(SCRATCH, str(scratch))
    try:
        rows = runs.batch_rerun(spark, str(tmp_path / "in")).collect()
    finally:
        spark.conf.unset(SCRATCH)
    assert seen == [([1] * 18, True)] * 2
    assert not names_under(scratch)
    got = {(r.layer, r.table_name): r.first_rows for r in rows}
    assert got["bronze", "harvest"] == 80 and got["silver", "harvest"] == got["gold", "fact_harvest"] == 40
    assert len(rows) == 18 and all(r.first_rows == r.second_rows and r.same_contents for r in rows)
