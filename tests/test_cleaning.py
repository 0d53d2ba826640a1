"""Cleaning rules on rows of the shapes the sources have."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fieldlake.contracts import SourceContract
from fieldlake.errors import ContractError
from fieldlake.operators.cleaning import INGESTED_AT, clean, clean_rows, nullify_blanks, parse_losses, standardize
from fieldlake.operators.dedupe import dedupe, duplicate_counts
from fieldlake.plans.estate import BATCH_SOURCES, FINANCE, HARVEST, HR, MODELS, SENSORS, SERVING, WEATHER

STAMP = dt.datetime(2024, 2, 1)


def raw(spark, contract, *rows):
    """Raw text rows of a source; columns not named are NULL."""
    data = [[row.get(name) for name in contract.column_names] for row in rows]
    return spark.createDataFrame(data, contract.text_schema)


def test_weather_keys_meet_across_case(spark):
    df = raw(
        spark,
        WEATHER,
        {"station_id": " stn-north", "timestamp": "2024-01-01 00:00:00", "region_id": "reg-north"},
        {"station_id": "STN-NORTH", "timestamp": "2024-01-01 00:00:00", "region_id": "reg-north"},
        {"station_id": "STN-NORTH", "timestamp": "2024-01-01 01:00:00"},
        {"station_id": "STN-NORTH", "timestamp": None},
    )
    rows = clean(df, WEATHER, F.lit(STAMP)).collect()
    assert len(rows) == 2
    assert {r.station_id for r in rows} == {"STN-NORTH"}
    assert {r[INGESTED_AT] for r in rows} == {STAMP}


def test_harvest_blank_is_null(spark):
    df = raw(
        spark,
        HARVEST,
        {"harvest_id": "hvt-1", "timestamp": "2024-01-01 08:00:00", "equipment_id": "  ", "harvested_weight_kg": "2"},
        {"harvest_id": "HVT-1", "timestamp": "2024-01-01 08:00:00", "equipment_id": "EQ-1", "harvested_weight_kg": "1"},
        {"harvest_id": "HVT-2", "timestamp": "2024-01-01 08:00:00", "equipment_id": " eq-2 "},
    )
    rows = {r.harvest_id: r for r in clean(df, HARVEST).collect()}
    assert set(rows) == {"HVT-1", "HVT-2"}
    assert rows["HVT-1"].equipment_id is None
    assert rows["HVT-2"].equipment_id == "eq-2"


def test_hr_date(spark):
    df = raw(
        spark,
        HR,
        {"attendance_id": "att-1", "attendance_date": "2024-01-05", "employee_name": " A B "},
        {"attendance_id": "ATT-1 ", "attendance_date": "2024-01-05", "employee_name": "A B"},
    )
    (row,) = clean(df, HR).collect()
    assert (row.attendance_id, row.attendance_date, row.employee_name) == ("ATT-1", dt.date(2024, 1, 5), "A B")


def test_finance_amount_is_exact(spark):
    common = {"document_id": "doc-1", "posting_date": "2024-01-05", "amount": "1671.51", "fiscal_period": "01"}
    df = raw(
        spark,
        FINANCE,
        {**common, "gl_account": " 500100 ", "debit_credit_indicator": "s"},
        {**common, "gl_account": "200100", "debit_credit_indicator": "H"},
    )
    cleaned = clean(df, FINANCE)
    assert dict(cleaned.dtypes)["amount"] == "decimal(18,2)"
    rows = {r.debit_credit_indicator: r for r in cleaned.collect()}
    assert {s: r.amount for s, r in rows.items()} == {"S": Decimal("1671.51"), "H": Decimal("1671.51")}
    assert rows["S"].gl_account == "500100" and rows["S"].fiscal_period == 1


@pytest.mark.parametrize("text", ["bad", "2024-13-01", "", "   "])
def test_malformed_time_drops_the_row(spark, text):
    df = raw(spark, HARVEST, {"harvest_id": "A", "timestamp": text})
    assert clean(df, HARVEST).count() == 0


def test_malformed_time_can_stop_the_job(spark):
    df = raw(spark, HARVEST, {"harvest_id": "A", "timestamp": "bad"})
    with pytest.raises(Exception, match="(?i)timestamp"):
        clean(df, HARVEST, strict_parse=True).collect()


def test_blank_key_is_dropped_or_kept(spark):
    df = raw(spark, HARVEST, {"harvest_id": "   ", "timestamp": "2024-01-01 00:00:00"})
    assert clean(df, HARVEST).count() == 0
    assert [r.harvest_id for r in clean(df, HARVEST, blank_key_is_null=False).collect()] == [""]


def test_malformed_values_are_counted(spark):
    df = raw(
        spark,
        SENSORS,
        {"sensor_id": "a", "timestamp": "2024-01-01 00:00:00", "soil_ph": "oops", "humidity_pct": " "},
        {"sensor_id": "b", "timestamp": "soon", "soil_ph": "6.5"},
    )
    lost = {r.column_name: r.lost_values for r in parse_losses(df, SENSORS).collect()}
    assert lost["soil_ph"] == 1 and lost["timestamp"] == 1 and lost["humidity_pct"] == 0


def test_sensor_rows(spark):
    good = {"sensor_id": "sns1", "timestamp": "2024-01-01 00:00:00", "soil_ph": "6.5", "sensor_status": "ok "}
    df = raw(
        spark,
        SENSORS,
        good,
        good,
        {**good, "sensor_id": "sns2", "soil_ph": "  "},
        {**good, "sensor_id": "   "},
    )
    rows = {r.sensor_id: r for r in clean(df, SENSORS).collect()}
    assert set(rows) == {"SNS1", "SNS2"}
    assert rows["SNS1"].soil_ph == 6.5 and rows["SNS2"].soil_ph is None
    assert rows["SNS1"].sensor_status == "OK"


def test_survivor_does_not_depend_on_input_order(spark):
    rows = [(1, "b", 2.0), (1, "a", 3.0), (1, "a", 1.0), (2, "z", 0.0), (None, "n", 1.0), (None, "m", 9.0)]
    seen = set()
    for parts, order in ((1, rows), (4, rows[::-1]), (3, rows[2:] + rows[:2])):
        df = spark.createDataFrame(order, "k int, s string, v double").repartition(parts)
        seen.add(tuple(sorted(map(str, dedupe(df, ["k"]).collect()))))
    assert len(seen) == 1
    assert "Row(k=1, s='a', v=1.0)" in seen.pop()


def test_first_come_survivor(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, s string")
    assert dedupe(df, ["k"], deterministic=False).count() == 1


def test_null_key_parts_count_as_values(spark):
    df = spark.createDataFrame([("d", None), ("d", None), ("d", "1")], "doc string, account string")
    (row,) = duplicate_counts(df, ["doc", "account"]).collect()
    assert (row.total_rows, row.distinct_keys, row.duplicate_rows) == (3, 2, 1)


def test_empty_table_has_no_duplicates(spark):
    df = spark.createDataFrame([], "k int")
    assert duplicate_counts(df, ["k"]).first().asDict() == {"total_rows": 0, "distinct_keys": 0, "duplicate_rows": 0}


def test_helpers(spark):
    df = spark.createDataFrame([(" a ", "  ", " x")], "c string, b string, t string")
    row = standardize(nullify_blanks(df, ["b", "zzz"]), codes=["c"], trims=["t"]).first()
    assert (row.c, row.b, row.t) == ("A", None, "x")


def test_missing_column_is_an_error(spark):
    with pytest.raises(ContractError, match="timestamp"):
        clean_rows(spark.createDataFrame([("a",)], "harvest_id string"), HARVEST)


def test_contract_knows_its_columns():
    with pytest.raises(ContractError, match="nope"):
        SourceContract("x", "", "a string", ("a",), ("a",), blanks=("nope",))


def test_contracts_are_complete():
    assert list(BATCH_SOURCES) == ["weather", "harvest", "fertilizer", "equipment", "hr", "finance"]
    assert [len(c.column_names) for c in BATCH_SOURCES.values()] == [9, 12, 14, 16, 16, 17]
    assert len(SENSORS.column_names) == 11
    for name, contract in SERVING.items():
        assert list(contract.columns) == list(MODELS[name].columns)


def test_typed_input_is_cleaned_too(spark):
    rows = [("H1", dt.datetime(2024, 1, 1), 5.0)]
    typed = spark.createDataFrame(rows, "harvest_id string, timestamp timestamp, harvested_weight_kg double")
    for name, kind in HARVEST.edge_types.items():
        if name not in typed.columns:
            typed = typed.withColumn(name, F.lit(None).cast(kind))
    assert clean(typed, HARVEST).first().harvested_weight_kg == 5.0
