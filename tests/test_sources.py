"""Files in, tables out."""

import csv
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fieldlake.errors import QualityError, SourceError
from fieldlake.operators.cleaning import clean
from fieldlake.plans.batch import run_batch
from fieldlake.plans.estate import BATCH_SOURCES, FERTILIZER, HARVEST, SERVING
from fieldlake.plans.reports import harvest_kpis, overview
from fieldlake.plans.serving import serving_views
from fieldlake.session import scratch_folder, scratch_run
from fieldlake.sources.batch import (
    MALFORMED,
    SOURCE_FILE,
    find_contract,
    ingest_raw,
    malformed_rows,
    read_raw,
    read_source,
    read_table,
    read_typed,
    write_counted,
    write_table,
)
from fieldlake.sources.inventory import compare_file_trees, file_inventory, landed_files
from fieldlake.sources.layout import Layout, choose_layout

STAMP = dt.datetime(2024, 2, 1)


def write_csv(path, contract, *rows, header=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header or contract.column_names)
        for row in rows:
            out.writerow([row.get(name, "") for name in contract.column_names])
    return str(path)


ROW = {"harvest_id": "hvt-1", "timestamp": "2024-01-01 08:00:00", "harvested_weight_kg": "12.5", "status": "completed",
       "collection_duration_minutes": "30", "block_id": "blk01", "crop_type": "Tea"}


def test_typed_read(spark, tmp_path):
    path = write_csv(tmp_path / "h.csv", HARVEST, ROW, {**ROW, "harvest_id": "x", "harvested_weight_kg": "oops"})
    rows = {r.harvest_id: r for r in read_source(spark, HARVEST, path).collect()}
    assert rows["hvt-1"].harvested_weight_kg == 12.5 and rows["hvt-1"].collection_duration_minutes == 30
    assert rows["x"].harvested_weight_kg is None and rows["x"].status == "completed"
    assert rows["x"][MALFORMED] is not None and rows["hvt-1"][MALFORMED] is None
    assert rows["hvt-1"].equipment_id is None


def test_header_in_another_order_is_an_error(spark, tmp_path):
    header = HARVEST.column_names[::-1]
    path = write_csv(tmp_path / "h.csv", HARVEST, ROW, header=header)
    with pytest.raises(Exception, match="(?i)header"):
        read_source(spark, HARVEST, path).collect()


def test_quotes_commas_and_line_breaks_stay_in_one_field(spark, tmp_path):
    note = 'he said "hi", ok\nthen left'
    path = write_csv(tmp_path / "f.csv", FERTILIZER, {"application_id": "f1", "timestamp": "2024-01-01 00:00:00", "notes": note})
    (row,) = clean(read_source(spark, FERTILIZER, path), FERTILIZER).collect()
    assert row.notes == note


def test_missing_and_unknown_sources(spark, tmp_path):
    with pytest.raises(SourceError, match="nothing to read"):
        read_source(spark, HARVEST, str(tmp_path / "none.csv"))
    with pytest.raises(SourceError, match="unknown source 'rain'"):
        find_contract(BATCH_SOURCES, "rain")
    with pytest.raises(SourceError):
        read_table(spark, str(tmp_path / "none"))


def test_layout():
    layout = Layout("s3a://lake/x")
    assert layout.silver("hr") == "s3a://lake/x/silver/hr"
    assert choose_layout(" Local ", {"local": layout}) is layout
    with pytest.raises(SourceError, match="staging"):
        choose_layout("staging", {"local": layout})


def test_raw_copy_leaves_the_source_alone(spark, tmp_path):
    path = write_csv(tmp_path / "in" / "h.csv", HARVEST, ROW, {**ROW, "harvest_id": " b "})
    with open(path, "a", encoding="utf-8") as f:
        f.write("too,short\n")
    before = (tmp_path / "in" / "h.csv").read_bytes()
    table = str(tmp_path / "bronze")
    for _ in range(2):
        assert ingest_raw(spark, HARVEST, path, table) == {"rows": 3, "malformed": 1}
    raw = read_table(spark, table)
    assert malformed_rows(raw).first().asDict() == {"rows": 3, "malformed": 1}
    assert {r.harvest_id for r in raw.collect()} == {"hvt-1", " b ", "too"}
    assert all(r[SOURCE_FILE].endswith("h.csv") for r in raw.collect())
    assert (tmp_path / "in" / "h.csv").read_bytes() == before
    assert read_raw(spark, HARVEST, path).count() == 3


def test_a_table_cannot_replace_its_input(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    with pytest.raises(SourceError, match="cannot replace"):
        write_table(spark.read.parquet(path), path, reads=[path])
    with pytest.raises(SourceError, match="cannot replace"):
        write_table(spark.read.parquet(path), path + "/inner", reads=["file:" + path])
    assert read_table(spark, path).count() == 3


def test_schema_may_change_on_refresh(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    counts = write_counted(spark.range(2).select(F.lit("x").alias("s")), path, counts={"texts": "s"})
    assert counts == {"rows": 2, "texts": 2}
    assert read_table(spark, path).columns == ["s"]
    assert write_table(spark.range(0), path) == 0


def test_typed_view_over_files(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.createDataFrame([("E1", "TRACTOR", 1)], "equipment_id string, equipment_type string, extra int").write.parquet(path)
    view = read_typed(spark, SERVING["dim_equipment"], path, view="machines")
    assert view.columns == ["equipment_id", "equipment_type"]
    assert spark.sql("select count(*) as n from machines").first().n == 1


def test_file_trees(spark, tmp_path):
    for side, files in (("a", {"same": "1", "x/changed": "1", "left": "1"}), ("b", {"same": "1", "x/changed": "2", "right": "1"})):
        for name, text in files.items():
            file = tmp_path / side / name
            file.parent.mkdir(parents=True, exist_ok=True)
            file.write_text(text)
    found = compare_file_trees(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert {r.file: r.status for r in found.collect()} == {
        "same": "same", "x/changed": "changed", "left": "left_only", "right": "right_only",
    }
    named = compare_file_trees(spark, f"file://{tmp_path / 'a'}", str(tmp_path / "b"))
    assert {r.file: r.status for r in named.collect()} == {r.file: r.status for r in found.collect()}


def test_inventory_does_not_depend_on_splits(spark, tmp_path):
    lines = [f"line {i} {'x' * (i % 50)}" for i in range(20_000)]
    (tmp_path / "empty").write_text("")
    (tmp_path / "a b").write_text("\n".join(lines) + "\n")
    swapped = [lines[1], lines[0], *lines[2:]]
    (tmp_path / "swapped").write_text("\n".join(swapped) + "\n")
    (tmp_path / "returns").write_text("\r\n".join(lines) + "\r\n")
    whole = {r.file: r for r in file_inventory(spark, str(tmp_path)).collect()}
    assert "empty" not in whole and whole["a b"].lines == 20_000
    assert len({whole[name].digest for name in ("a b", "swapped", "returns")}) == 3
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        split = file_inventory(spark, str(tmp_path))
        assert {r.file: r for r in split.collect()} == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_landed_files(spark, tmp_path):
    layout = Layout(str(tmp_path))
    chosen = {name: BATCH_SOURCES[name] for name in ("harvest", "equipment", "finance")}
    write_csv(tmp_path / "landing/harvest" / HARVEST.file_name, HARVEST, ROW, ROW)
    write_csv(tmp_path / "landing/equipment" / chosen["equipment"].file_name, chosen["equipment"])
    write_csv(tmp_path / "landing/harvest/copy.csv", HARVEST, ROW)
    found = {r.name: (r.status, r.files, r.rows) for r in landed_files(spark, layout, chosen).collect()}
    assert found == {
        "harvest": ("ok", 1, 2), "equipment": ("empty", 1, 0), "finance": ("missing", 0, None),
        "harvest/copy.csv": ("stranger", 1, None),
    }


def test_views_prune_days_and_keep_widths(spark, tmp_path):
    layout = Layout(str(tmp_path), facts_by_day=True)
    late = {**ROW, "harvest_id": "hvt-2", "timestamp": "2024-01-02 08:00:00"}
    write_csv(tmp_path / "landing/harvest" / HARVEST.file_name, HARVEST, ROW, late)
    run_batch(spark, layout, STAMP, sources=["harvest"])
    view = serving_views(spark, layout, {"fact_harvest": SERVING["fact_harvest"]})["fact_harvest"]
    day = view.where("harvest_date >= '2024-01-02'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "harvest_date" in filters and [r.harvest_id for r in day.collect()] == ["HVT-2"]
    write_csv(tmp_path / "landing/harvest" / HARVEST.file_name, HARVEST, {**ROW, "block_id": "b" * 51})
    run_batch(spark, layout, STAMP, sources=["harvest"])
    views = serving_views(spark, layout, {"fact_harvest": SERVING["fact_harvest"]})
    with pytest.raises(Exception, match="block_id is longer than 50"):
        views["fact_harvest"].collect()


def test_scratch_is_new_each_time(spark):
    assert scratch_folder(spark, "a") != scratch_folder(spark, "a")


def test_a_run_leaves_no_scratch(spark, tmp_path):
    with scratch_run(spark) as folder:
        inside = scratch_folder(spark, "t")
        assert inside.startswith(folder)
        with scratch_run(spark, "inner") as inner:
            assert inner.startswith(folder) and scratch_folder(spark, "u").startswith(inner)
        write_table(spark.range(5), inside)
        write_table(read_table(spark, inside), str(tmp_path / "out"))
        assert os.path.exists(inside)
    assert not os.path.exists(folder) and read_table(spark, str(tmp_path / "out")).count() == 5
    assert not scratch_folder(spark, "v").startswith(folder)
    with pytest.raises(ValueError), scratch_run(spark) as folder:
        write_table(spark.range(5), scratch_folder(spark, "t"))
        raise ValueError
    assert not os.path.exists(folder)


HARVESTS = [ROW, {**ROW, "harvest_id": "HVT-1"}, {**ROW, "harvest_id": "hvt-2", "timestamp": "2024-02-02 09:00:00",
            "harvested_weight_kg": "-1"}]
MACHINES = [{"operation_id": "op1", "timestamp": "2024-01-01 08:00:00", "equipment_id": "eq1", "equipment_type": "tractor",
             "maintenance_flag": "True"}]


@pytest.fixture
def landed(tmp_path):
    layout = Layout(str(tmp_path))
    write_csv(tmp_path / "landing/harvest" / HARVEST.file_name, HARVEST, *HARVESTS)
    equipment = BATCH_SOURCES["equipment"]
    write_csv(tmp_path / "landing/equipment" / equipment.file_name, equipment, *MACHINES)
    return layout


def test_batch_run_and_rerun(spark, landed):
    runs = [run_batch(spark, landed, STAMP, sources=["harvest", "equipment"]) for _ in range(2)]
    assert runs[0] == runs[1]
    assert runs[0].bronze == {"harvest": 3, "equipment": 1} and runs[0].malformed == {"harvest": 0, "equipment": 0}
    assert runs[0].silver == {"harvest": 2, "equipment": 1}
    assert runs[0].gold == {"dim_equipment": 1, "fact_harvest": 2, "fact_equipment": 1}
    assert runs[0].warnings == ["harvest.valid_ranges: 1 (expected 0) harvested_weight_kg=1"]
    fact = read_table(spark, landed.gold("fact_harvest"))
    months = [str(m) for m in fact.select("event_month").distinct().orderBy("event_month").toPandas()["event_month"]]
    assert months == ["2024-01", "2024-02"]
    assert harvest_kpis(fact).first().operations == 2
    checks = read_table(spark, landed.quality("latest"))
    assert checks.count() == 12


def test_gate_blocks_the_models(spark, landed, tmp_path):
    bad = {**ROW, "harvest_id": "hvt-3", "timestamp": "soon"}
    write_csv(tmp_path / "landing/harvest" / HARVEST.file_name, HARVEST, *HARVESTS, bad)
    with pytest.raises(QualityError, match="harvest.reconciliation"):
        run_batch(spark, landed, STAMP, sources=["harvest", "equipment"])
    assert not (tmp_path / "gold").exists()
    assert read_table(spark, landed.quality("latest")).where("not passed and critical").count() == 1


def test_run_names_the_source_that_fails(spark, landed):
    with pytest.raises(SourceError) as caught:
        run_batch(spark, landed, STAMP, sources=["harvest", "hr"])
    assert "while building source hr" in caught.value.__notes__


def test_all_sources_and_views(spark, tmp_path):
    layout = Layout(str(tmp_path))
    for name, contract in BATCH_SOURCES.items():
        row = {c: "1" for c in contract.column_names}
        row |= {c: "2024-01-01 08:00:00" for c, k in contract.clean_types.items() if k == "timestamp"}
        row |= {c: "2024-01-01" for c, k in contract.clean_types.items() if k == "date"}
        row |= {"pressure_hpa": "1000", "maintenance_flag": "TRUE"}
        write_csv(tmp_path / "landing" / name / contract.file_name, contract, row)
    run = run_batch(spark, layout, STAMP)
    assert run.warnings == [] and set(run.gold.values()) == {1} and len(run.gold) == 6
    assert read_table(spark, layout.quality("latest")).count() == 36
    views = serving_views(spark, layout)
    for name, contract in SERVING.items():
        assert views[name].columns == list(contract.columns)
        assert spark.sql(f"select count(*) as n from vw_{name}").first().n == 1
    row = overview(views).first()
    assert (row.operations, row.machines, row.people, float(row.amount)) == (1, 1, 1, 1.0)


def test_one_folder_has_many_names(spark, tmp_path):
    from fieldlake.sources.batch import _overlaps

    here = str(tmp_path)
    for other in (f"file:{here}", f"file://{here}", f"{here}/x/..", f"{here}/inside", here + "/"):
        assert _overlaps(spark, here, other) and _overlaps(spark, other, here)
    assert not _overlaps(spark, here, f"{here}2")
