"""Enrichment, the active workforce and the ledger on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fieldlake.operators.ledger import document_balances, unbalanced_documents
from fieldlake.operators.models import build_model
from fieldlake.plans import derive as d
from fieldlake.plans.estate import DIM_EMPLOYEE, DIM_EQUIPMENT, FACT_HARVEST, MASTER_SCHEMAS

T = dt.datetime(2024, 1, 5, 10, 40)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


@pytest.fixture(scope="module")
def master(spark):
    return {
        "blocks": frame(spark, MASTER_SCHEMAS["blocks"], ("BLK01", "Tea", 1.0, "REG-NORTH"), ("BLK04", "Tea", 1.0, "REG-CENTRAL")),
        "cost_centers": frame(
            spark,
            MASTER_SCHEMAS["cost_centers"],
            ("CC101", "REG-NORTH", 0),
            ("CC102", "REG-CENTRAL", 1),
            ("CC103", "REG-SOUTH", 2),
            ("CC201", "REG-CENTRAL", 3),
        ),
        "materials": frame(spark, MASTER_SCHEMAS["materials"], ("MAT02", "Fertilizer", 3.40)),
        "stations": frame(spark, MASTER_SCHEMAS["stations"], ("STN-SOUTH", "REG-SOUTH", 1.0, 2.0)),
    }


HARVEST = (
    "harvest_id string, timestamp timestamp, block_id string, employee_id string, equipment_id string, "
    "harvested_weight_kg double, status string"
)
FERTILIZER = (
    "application_id string, timestamp timestamp, block_id string, employee_id string, equipment_id string, "
    "material_id string, quantity_kg double, application_status string"
)
EQUIPMENT = (
    "operation_id string, timestamp timestamp, operator_id string, equipment_id string, "
    "fuel_consumption_liters double, maintenance_flag boolean, status string"
)
HR = (
    "attendance_id string, attendance_date date, employee_id string, cost_center_id string, "
    "working_hours double, overtime_hours double, attendance_status string"
)


@pytest.fixture(scope="module")
def silver(spark):
    return {
        "harvest": frame(
            spark,
            HARVEST,
            ("H1", T, "BLK01", "E1", None, 100.5, "COMPLETED"),
            ("H2", T, "BLK04", "E2", "EQ1", 10.0, None),
            ("H3", T, "BLK99", "E3", None, 10.0, "DELAYED"),
            ("H4", T, "BLK01", "E4", None, 10.0, "CANCELLED"),
            ("H5", T, "BLK01", "E5", None, None, "COMPLETED"),
            ("H6", T, "BLK01", "E5", None, float("nan"), "COMPLETED"),
        ),
        "fertilizer": frame(
            spark,
            FERTILIZER,
            ("F1", T, "BLK04", "E1", None, "mat02 ", 2.0, "COMPLETED"),
            ("F2", T, "BLK01", "E1", None, "MAT99", 2.0, "COMPLETED"),
            ("F3", T, "BLK01", "E1", None, "MAT02", 0.0, "COMPLETED"),
        ),
        "equipment": frame(
            spark,
            EQUIPMENT,
            ("O1", T, "E7", "EQ1", 10.0, True, "COMPLETED"),
            ("O2", T, "E8", "EQ2", 0.0, False, "IDLE"),
            ("O3", T, "", "EQ2", None, None, "COMPLETED"),
        ),
        "hr": frame(
            spark,
            HR,
            ("A1", T.date(), "E1", "CC103", 8.0, 1.5, "PRESENT"),
            ("A2", T.date(), "E7", None, 8.0, 0.0, "ABSENT"),
            ("A3", T.date(), "E9", None, 4.0, 0.0, "LATE"),
        ),
    }


def test_ledger(spark, silver, master):
    book = d.ledger(silver, master, fee="5.00", maintenance_rate="300.00")
    rows = {(r.document_id, r.debit_credit_indicator): r for r in book.collect()}
    debits = {k[0].removeprefix("DOC-"): (r.amount, r.cost_center_id) for k, r in rows.items() if k[1] == "S"}
    assert debits == {
        "HARVEST_LABOR-H1": (Decimal("13.04"), "CC101"),
        "HARVEST_LABOR-H2": (Decimal("5.80"), "CC201"),
        "HARVEST_LABOR-H3": (Decimal("5.80"), "CC101"),
        "FERTILIZER_CONSUMPTION-F1": (Decimal("6.80"), "CC201"),
        "FERTILIZER_CONSUMPTION-F2": (Decimal("5.00"), "CC101"),
        "EQUIPMENT_FUEL-O1": (Decimal("12.00"), "CC201"),
        "EQUIPMENT_MAINTENANCE-O1": (Decimal("300.00"), "CC201"),
        "PAYROLL_WAGES-A1": (Decimal("100.00"), "CC103"),
        "OVERTIME_WAGES-A1": (Decimal("28.12"), "CC103"),
        "PAYROLL_WAGES-A3": (Decimal("50.00"), "CC101"),
    }
    fuel = rows[("DOC-EQUIPMENT_FUEL-O1", "H")]
    assert (fuel.gl_account, fuel.material_id, fuel.employee_id) == ("140100", "MAT04", "E7")
    assert fuel.description == "Credit: Equipment Fuel O1"
    assert (fuel.fiscal_year, fuel.fiscal_period, fuel.posting_date) == (2024, 1, T.date())
    wage = rows[("DOC-PAYROLL_WAGES-A1", "S")]
    assert wage.posting_timestamp == dt.datetime(2024, 1, 5, 17) and wage.company_code == "MY10"
    assert unbalanced_documents(book).count() == 0


def test_unbalanced_documents_are_found(spark):
    schema = "document_id string, debit_credit_indicator string, amount decimal(18,2)"
    one = Decimal("1.00")
    book = frame(
        spark, schema, ("ok", "S", one), ("ok", "H", one), ("two", "S", one), ("two", "S", one), ("off", "S", one),
        ("off", "H", Decimal("2.00")), ("odd", "S", one), ("odd", "H", one), ("odd", "X", one),
    )
    assert {r.document_id for r in unbalanced_documents(book).collect()} == {"two", "off", "odd"}
    assert document_balances(book).count() == 4


WEATHER = "timestamp timestamp, station_id string, region_id string, rainfall_mm double, weather_condition string"


def test_hourly_weather(spark, master):
    hour = T.replace(minute=0)
    weather = frame(
        spark,
        WEATHER,
        (hour, "STN-1", "REG-NORTH", 1.0, "LIGHT RAIN"),
        (hour, "STN-2", "REG-NORTH", 2.0, "RAIN"),
        (hour, "STN-3", "REG-SOUTH", None, "FOG"),
    )
    fact = frame(
        spark, "id int, timestamp timestamp, region_id string",
        (1, T, "REG-NORTH"), (2, T, "REG-SOUTH"), (3, T, "REG-X"), (4, None, "REG-NORTH"), (5, T + dt.timedelta(hours=1), "REG-SOUTH"),
    )
    rows = {r.id: (r.rainfall_mm, r.weather_condition) for r in d.enrich_hourly(fact, weather).collect()}
    assert rows == {1: (2.0, "RAIN"), 2: (0.0, "FOG"), 3: (0.0, "Clear"), 4: (0.0, "Clear"), 5: (0.0, "Clear")}
    stations = {r.id: r.station_id for r in d.with_station(fact, weather, master["stations"]).collect()}
    assert stations == {1: "STN-2", 2: "STN-3", 3: "STN-NORTH", 4: "STN-NORTH", 5: "STN-SOUTH"}


def test_weather_at_eight(spark):
    weather = frame(spark, WEATHER, (dt.datetime(2024, 1, 5, 8), "S", "R", 3.0, "RAIN"))
    days = frame(spark, "day date, region_id string", (T.date(), "R"), (T.date(), "Q"))
    rows = {r.region_id: r.rainfall_mm for r in d.enrich_fixed_hour(days, weather, "day").collect()}
    assert rows == {"R": 3.0, "Q": 0.0}


def test_active_workers(spark, silver):
    active = d.active_workers(silver["harvest"], silver["equipment"])
    assert {r.employee_id for r in active.collect()} == {"E1", "E2", "E3", "E5", "E7"}
    assert {r.attendance_id for r in d.active_attendance(silver["hr"], active).collect()} == {"A1", "A2"}
    assert {r.attendance_id for r in d.attendance_conflicts(silver["hr"], active).collect()} == {"A2"}


def test_dimensions_take_the_newest_row(spark):
    rows = frame(
        spark,
        "equipment_id string, equipment_type string, timestamp timestamp",
        ("EQ1", "OLD", T), ("EQ1", "NEW", T + dt.timedelta(days=1)), ("EQ2", "X", T), (None, "Y", T),
    )
    assert {r.equipment_id: r.equipment_type for r in build_model(rows, DIM_EQUIPMENT).collect()} == {"EQ1": "NEW", "EQ2": "X"}
    people = frame(
        spark,
        "employee_id string, employee_name string, role string, department string, cost_center_id string, attendance_date date",
        ("E1", "A", "r", "d", "c", T.date()), ("E1", "A", "r2", "d", "c", T.date() + dt.timedelta(days=1)), ("E2", "B", "r", "d", "c", T.date()),
    )
    assert {r.employee_id: r.role for r in build_model(people, DIM_EMPLOYEE).collect()} == {"E1": "r2", "E2": "r"}


def test_fact_keeps_null_foreign_keys(spark):
    columns = "harvest_id string, timestamp timestamp, block_id string, crop_type string, employee_id string, " \
        "equipment_id string, harvested_weight_kg double, quality_grade string, moisture_pct double, " \
        "collection_duration_minutes int, destination string, status string"
    rows = frame(spark, columns, ("H1", T, *[None] * 10), ("H2", T, *[None] * 10), (None, T, *[None] * 10))
    fact = build_model(rows, FACT_HARVEST)
    assert fact.columns == list(FACT_HARVEST.columns)
    assert {(r.harvest_id, r.harvest_date, r.equipment_id) for r in fact.collect()} == {
        ("H1", T.date(), None), ("H2", T.date(), None),
    }
    assert build_model(rows, FACT_HARVEST, unique_by=("harvest_id",)).count() == 2


def test_every_event_is_posted_or_listed(spark):
    from fieldlake.operators.ledger import post_pairs, unposted_events
    from fieldlake.plans.derive import fleet_costs

    rows = [("o1", 0.00004), ("o2", 1e25), ("o3", float("inf")), ("o4", None), ("o5", -1.0), ("o6", 10.0), ("o7", 9e13)]
    equipment = spark.createDataFrame(
        [(o, None, "p", "e", v, False) for o, v in rows],
        "operation_id string, timestamp timestamp, operator_id string, equipment_id string, "
        "fuel_consumption_liters double, maintenance_flag boolean",
    )
    fuel = fleet_costs(equipment).where("transaction_type = 'EQUIPMENT_FUEL'")
    reasons = {r.reference_document: r.reason for r in unposted_events(fuel).collect()}
    assert reasons == {"o2": "no amount", "o3": "no amount", "o4": "no amount", "o5": "not positive"}
    posted = post_pairs(fuel, F.lit("C"), F.lit("MYR"))
    assert {r.reference_document for r in posted.collect()} == {"o1", "o6", "o7"}
