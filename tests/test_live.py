"""Real streams: duplicates, reruns, late rows, failures."""

import csv
import datetime as dt
import shutil

import pytest
from pyspark.errors import StreamingQueryException

from fieldlake.operators.cleaning import INGESTED_AT
from fieldlake.plans.estate import SENSORS
from fieldlake.plans.serving import live_views
from fieldlake.sources.batch import read_table
from fieldlake.sources.layout import Layout
from fieldlake.errors import SourceError
from fieldlake.streaming.live import LiveRun, bronze_stream, clean_stream, drain, read_stream, run_live, silver_stream
from fieldlake.streaming.once import OncePerKey


def deliver(layout, name, rows):
    folder = layout.root + "/incoming/sensors"
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(SENSORS.column_names)
        for row in rows:
            out.writerow([row.get(c, "") for c in SENSORS.column_names])


def reading(sensor, ts, ph="6.5", status="ok"):
    return {"sensor_id": sensor, "timestamp": str(ts), "block_id": "blk01", "soil_ph": ph, "sensor_status": status,
            "battery_level_pct": "50"}


START = dt.datetime(2024, 1, 1)


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path))


def test_two_runs_and_a_rerun(spark, layout):
    first = [reading(f"s{i}", START) for i in range(5)] + [reading("s0", START), reading("  ", START), reading("s9", "soon")]
    deliver(layout, "one", first)
    assert run_live(spark, SENSORS, layout) == LiveRun(8, 5, 8, 5)
    second = [reading("S1 ", START), reading("s7", START, ph="oops", status="fault")]
    deliver(layout, "two", second)
    assert run_live(spark, SENSORS, layout) == LiveRun(2, 1, 10, 6)
    assert run_live(spark, SENSORS, layout) == LiveRun(0, 0, 10, 6)
    silver = read_table(spark, layout.live_silver("sensors"))
    assert silver.columns == [*SENSORS.column_names, INGESTED_AT]
    rows = {r.sensor_id: r for r in silver.collect()}
    assert set(rows) == {"S0", "S1", "S2", "S3", "S4", "S7"}
    assert rows["S7"].soil_ph is None and rows["S7"].sensor_status == "FAULT"
    bronze = read_table(spark, layout.live_bronze("sensors"))
    assert bronze.count() == 10 and {r.sensor_id for r in bronze.collect()} >= {"  ", "S1 "}
    views = live_views(spark, layout)
    assert views["kpi_sensor_status"].agg({"fault_count": "sum"}).first()[0] == 1
    assert spark.sql("select count(*) as n from vw_kpi_soil_moisture").first().n == 6


def test_conflicting_copies_leave_one_row(spark, layout):
    deliver(layout, "one", [reading("s1", START, ph=str(i % 14)) for i in range(200)])
    assert bronze_stream(spark, SENSORS, layout).added == 200
    assert silver_stream(spark, SENSORS, layout).added == 1
    deliver(layout, "two", [reading("s1", START, ph="3")])
    bronze_stream(spark, SENSORS, layout)
    assert silver_stream(spark, SENSORS, layout).added == 0
    (row,) = read_table(spark, layout.live_silver("sensors")).collect()
    assert row.soil_ph == 0.0  # the first of the batch by all columns


def test_late_rows(spark, layout):
    days = [START + dt.timedelta(days=d) for d in (20, 10, 0)]
    for i, day in enumerate(days):
        deliver(layout, str(i), [reading(f"s{j}", day) for j in range(3)])
        run = run_live(spark, SENSORS, layout, late_horizon="1 day")
    assert run.late_rows_dropped == 3 and run.silver_rows == 0 and run.bronze_total == 9
    kept = {r.timestamp for r in read_table(spark, layout.live_silver("sensors")).collect()}
    assert days[0] in kept and days[2] not in kept


def test_without_horizon_late_rows_are_kept(spark, layout):
    for i, back in enumerate((20, 10, 0)):
        deliver(layout, str(i), [reading("s", START + dt.timedelta(days=back))])
        run_live(spark, SENSORS, layout)
    assert read_table(spark, layout.live_silver("sensors")).count() == 3


def test_cleaned_table_by_day(spark, layout):
    deliver(layout, "one", [reading("s", START), reading("s", START + dt.timedelta(days=1))])
    bronze_stream(spark, SENSORS, layout, max_files=1)
    assert silver_stream(spark, SENSORS, layout, by_day=True, max_files=1).added == 2
    table = read_table(spark, layout.live_silver("sensors"))
    assert {str(r.reading_date) for r in table.collect()} == {"2024-01-01", "2024-01-02"}
    assert table.where("reading_date = '2024-01-02'").count() == 1


def test_failure_is_raised(spark, layout):
    deliver(layout, "one", [reading("s", START)])
    with open(layout.root + "/incoming/sensors/one.csv", "w", encoding="utf-8") as f:
        f.write("wrong,header\n1,2\n")
    with pytest.raises(StreamingQueryException):
        run_live(spark, SENSORS, layout)


def test_many_small_batches_are_all_counted(spark, layout):
    for i in range(12):
        deliver(layout, str(i), [reading("hot", START), reading(f"s{i}", START)])
    run = run_live(spark, SENSORS, layout, max_files=1)
    assert (run.bronze_rows, run.silver_rows, run.silver_total) == (24, 13, 13)


KINDS = "sensor_id string, timestamp timestamp, value int"


def readings(spark, *rows):
    return spark.createDataFrame([(s, START + dt.timedelta(days=d), v) for s, d, v in rows], KINDS)


def sink(spark, root, **options):
    options = {"by_day": "day"} | options
    return OncePerKey(spark, f"{root}/table", f"{root}/log", ("sensor_id", "timestamp"), "timestamp", **options)


def test_a_repeated_batch_writes_nothing(spark, tmp_path):
    one = sink(spark, tmp_path)
    one(readings(spark, ("a", 0, 1), ("b", 0, 1), ("a", 0, 2)), 0)
    files = sorted(str(f) for f in (tmp_path / "table").rglob("*.parquet"))
    again = sink(spark, tmp_path)  # as after a restart
    again(readings(spark, ("a", 0, 1), ("b", 0, 1), ("a", 0, 2)), 0)
    assert (one.added, again.added) == (2, 0)
    assert sorted(str(f) for f in (tmp_path / "table").rglob("*.parquet")) == files
    again(readings(spark, ("a", 1, 5), ("a", 0, 9)), 1)
    assert again.added == 1 and read_table(spark, f"{tmp_path}/table").count() == 3


def test_a_batch_that_died_after_its_append(spark, tmp_path):
    one = sink(spark, tmp_path)
    batch = readings(spark, ("a", 0, 1), ("b", 3, 1))
    one(batch, 0)
    (tmp_path / "log" / "000000000000.json").unlink()
    again = sink(spark, tmp_path)
    again(batch, 0)
    assert again.added == 0 and not again.sure and read_table(spark, f"{tmp_path}/table").count() == 2
    assert again.log.entries[0]["newest"] == "2024-01-04T00:00:00"


def test_the_table_is_the_only_state_and_only_the_days_of_a_batch_are_read(spark, tmp_path):
    one = sink(spark, tmp_path)
    for day in range(4):
        one(readings(spark, *[("hot", day, i) for i in range(50)]), day)
    assert one.added == 4 and read_table(spark, f"{tmp_path}/table").count() == 4
    shutil.rmtree(tmp_path / "table" / "day=2024-01-01")
    one(readings(spark, ("hot", 2, 7), ("hot", 3, 7)), 4)
    assert one.added == 4
    old = tmp_path / "table" / "day=2024-01-02"
    for file in old.glob("*.parquet"):
        file.write_bytes(b"not read")
    one(readings(spark, ("hot", 2, 7), ("cold", 3, 7)), 5)
    assert one.added == 5


def test_the_log_carries_the_horizon_over_restarts_and_stays_short(spark, tmp_path):
    sink(spark, tmp_path, horizon="2 days")(readings(spark, ("a", 10, 1)), 0)
    for number in range(1, 26):
        late = sink(spark, tmp_path, horizon="2 days")
        late(readings(spark, ("b", 7, 1), ("c", 8, number), ("d", 9, 1)), number)
        assert late.late == 1 and late.added == (2 if number == 1 else 0)
    assert len(late.log.entries) == 20
    late(readings(spark), 26)
    assert late.log.newest() == START + dt.timedelta(days=10)


def test_keys_without_time_and_null_keys(spark, tmp_path):
    one = OncePerKey(spark, f"{tmp_path}/table", f"{tmp_path}/log", ("sensor_id",), "timestamp")
    one(readings(spark, ("a", 0, 1), ("a", 5, 1), (None, 2, 1)), 0)
    one(readings(spark, ("a", 9, 1), (None, 3, 1), ("b", 1, 1)), 1)
    assert one.added == 3


def test_a_table_of_a_file_sink_is_refused(spark, tmp_path):
    (tmp_path / "table" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(SourceError, match="file sink"):
        sink(spark, tmp_path)


def test_a_stream_may_keep_state_of_its_own(spark, layout):
    deliver(layout, "one", [reading("s1", START, ph="3")] * 5 + [reading("s2", START)])
    cleaned = clean_stream(read_stream(spark, SENSORS, layout.incoming("sensors")), SENSORS, late_horizon="1 day")
    assert drain(cleaned, layout.root + "/own", layout.checkpoint("own")).added == 2


def test_status_from_the_figures_of_batches(spark, layout):
    from fieldlake.plans.reports import live_status, merge_status_partials, merged_status, status_partials
    from fieldlake.streaming.once import read_partials

    path = layout.live_partials("sensors")
    assert read_partials(spark, path) is None
    for day in range(3):
        rows = [reading(f"s{i % 4}", START + dt.timedelta(days=d), ph="6", status=("ok", "fault", "anomaly")[i % 3]) for i in range(9) for d in (0, day)]
        deliver(layout, str(day), rows)
        bronze_stream(spark, SENSORS, layout)
        silver_stream(spark, SENSORS, layout, partials=status_partials, merge=merge_status_partials if day != 1 else None)
        wanted = live_status(read_table(spark, layout.live_silver("sensors")), last_status=True)
        found = merged_status(read_partials(spark, path), last_status=True)
        assert found.dtypes == wanted.dtypes
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert read_partials(spark, path).count() == 4


def test_figures_of_a_batch_that_died(spark, tmp_path):
    """Figures are written before rows: whatever was reached, a second attempt makes both whole, once."""
    def figures(rows):
        return rows.groupBy("sensor_id").agg({"value": "count"}).withColumnRenamed("count(value)", "n")

    options = {"partials": figures, "partials_path": f"{tmp_path}/figures"}
    batch = readings(spark, ("a", 0, 1), ("b", 0, 1), ("a", 1, 2))
    one = sink(spark, tmp_path, **options)
    one(batch, 0)
    (tmp_path / "log" / "000000000000.json").unlink()
    shutil.rmtree(tmp_path / "table" / "day=2024-01-02")  # part of the rows never came
    again = sink(spark, tmp_path, **options)
    again(batch, 0)
    from fieldlake.streaming.once import read_partials

    assert again.added == 1 and read_table(spark, f"{tmp_path}/table").count() == 3
    assert {r.sensor_id: r.n for r in read_partials(spark, f"{tmp_path}/figures").collect()} == {"a": 2, "b": 1}
