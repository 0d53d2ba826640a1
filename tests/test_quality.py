"""Checks, the gate, reconciliation and conformance."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldlake.contracts import Range, ServingContract, SourceContract
from fieldlake.errors import ContractError, QualityError
from fieldlake.operators.cleaning import INGESTED_AT, clean
from fieldlake.operators.conform import apply_contract, text_widths
from fieldlake.operators.quality import (
    compare_layers,
    dq_gate,
    dq_report,
    gate_status,
    implication_check,
    missing_keys,
    reconcile,
)

CONTRACT = SourceContract(
    name="weather",
    file_name="",
    columns="station_id string, timestamp string, humidity_pct double",
    key=("station_id", "timestamp"),
    required=("station_id", "timestamp"),
    retyped={"timestamp": "timestamp"},
    codes=("station_id",),
    ranges=(Range("humidity_pct", 0, 100),),
)
NOON = dt.datetime(2024, 1, 1, 12)
AS_OF = dt.date(2024, 2, 10)


def silver(spark, rows):
    return spark.createDataFrame(
        rows, f"station_id string, timestamp timestamp, humidity_pct double, {INGESTED_AT} timestamp"
    )


def checks(report):
    return {row.check: row for row in report.collect()}


GOOD = [("A", NOON, 50.0, dt.datetime(2024, 2, 1)), ("B", NOON, None, dt.datetime(2024, 2, 2))]


def test_good_table_passes(spark):
    report = checks(dq_report(silver(spark, GOOD), CONTRACT, as_of=AS_OF))
    assert set(report) == {"schema", "nulls", "duplicates", "valid_ranges", "freshness"}
    assert all(row.passed for row in report.values())
    assert report["freshness"].metric == 8


def test_duplicate_null_and_range_failures(spark):
    rows = [*GOOD, ("A", NOON, 101.0, None), (None, NOON, float("nan"), None)]
    report = checks(dq_report(silver(spark, rows), CONTRACT, as_of=AS_OF))
    assert not report["duplicates"].passed and report["duplicates"].metric == 1
    assert not report["nulls"].passed and report["nulls"].detail == "station_id=1"
    assert report["valid_ranges"].metric == 2 and not report["valid_ranges"].critical
    assert report["nulls"].critical and report["duplicates"].critical


def test_expected_count(spark):
    wanted = SourceContract(**{**CONTRACT.__dict__, "expected_rows": 6483})
    row = checks(dq_report(silver(spark, GOOD), wanted))["row_count"]
    assert (row.passed, row.critical, row.metric, row.expected) == (False, True, 2, 6483)


def test_freshness_of_newest_and_oldest(spark):
    rows = [("A", NOON, 1.0, dt.datetime(2024, 1, 10)), ("B", NOON, 1.0, dt.datetime(2024, 2, 9))]
    newest = checks(dq_report(silver(spark, rows), CONTRACT, as_of=AS_OF))["freshness"]
    oldest = checks(dq_report(silver(spark, rows), CONTRACT, as_of=AS_OF, freshness_mode="oldest"))["freshness"]
    assert (newest.metric, newest.passed) == (1, True)
    assert (oldest.metric, oldest.passed) == (31, False)


def test_missing_columns(spark):
    df = silver(spark, GOOD).drop("humidity_pct", INGESTED_AT)
    report = checks(dq_report(df, CONTRACT, as_of=AS_OF))
    assert not report["schema"].passed and report["schema"].detail == "missing: humidity_pct, _ingested_at"
    assert not report["freshness"].passed


def test_empty_table(spark):
    report = checks(dq_report(silver(spark, []), CONTRACT, as_of=AS_OF))
    assert report["duplicates"].metric == 0 and report["nulls"].metric == 0
    assert not report["freshness"].passed


def test_gate(spark):
    def report(passed, critical):
        return spark.createDataFrame(
            [("s", "c", passed, critical, 1, 0, "d")],
            "source string, check string, passed boolean, critical boolean, metric bigint, expected bigint, detail string",
        )

    with pytest.raises(QualityError, match="s.c"):
        dq_gate(report(False, True))
    assert dq_gate(report(False, False)) == ["s.c: 1 (expected 0) d"]
    assert dq_gate(report(True, True)) == []
    assert gate_status(report(False, True)).first()["open"] is False


def test_reconcile_compares_text(spark):
    raw = spark.createDataFrame(
        [("a ", "2024-01-01 00:00:00", 1.0), ("A", "2024-01-01T00:00:00", 1.0), (None, "2024-01-01 00:00:00", 1.0)],
        "station_id string, timestamp string, humidity_pct double",
    )
    cleaned = clean(raw, CONTRACT)
    row = reconcile(raw, cleaned, CONTRACT).first()
    assert (row.silver_rows, row.raw_keys, row.reconciled) == (1, 3, False)
    assert missing_keys(raw, cleaned, CONTRACT).count() == 0
    assert missing_keys(raw, cleaned.limit(0), CONTRACT).count() == 1
    report = checks(dq_report(cleaned, CONTRACT, raw=raw))
    assert not report["reconciliation"].passed


def test_implication(spark):
    df = spark.createDataFrame(
        [("CANCELLED", 0.0), ("CANCELLED", 5.0), ("CANCELLED", None), ("DONE", 3.0), (None, 1.0)], "status string, kg double"
    )
    row = implication_check(df, F.col("status") == "CANCELLED", {"weight": F.col("kg") == 0}).first()
    assert (row.rule, row.rows, row.broken) == ("weight", 3, 2)


def test_layers_side_by_side(spark):
    one = spark.range(3)
    rows = {r.table_name: r for r in compare_layers({"a": one, "b": one}, {"a": one}).collect()}
    assert rows["a"].same and not rows["b"].same and rows["b"].right_rows is None


def test_typed_contract(spark):
    contract = ServingContract("t", {"n": "int", "code": "varchar(3)"})
    df = spark.createDataFrame([("abc", "7"), (None, "8")], "code string, n string")
    typed = apply_contract(df, contract)
    assert typed.dtypes == [("n", "int"), ("code", "string")]
    assert typed.count() == 2
    assert text_widths(df, contract).first().asDict() == {"column_name": "code", "longest": 3, "allowed": 3}
    with pytest.raises(ContractError, match="n"):
        apply_contract(df.drop("n"), contract)
    long = spark.createDataFrame([("abcd", "7")], "code string, n string")
    with pytest.raises(Exception, match="longer than 3"):
        apply_contract(long, contract).collect()
