"""Facts enriched with weather, the active workforce and the ledger that operations give rise to."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.functions.measures import at_hour, hour_of, measured, times_rate
from fieldlake.operators.ledger import EVENT_COLUMNS, post_pairs
from fieldlake.operators.lookup import distinct_union, keep_members, lookup
from fieldlake.operators.measures import is_not

# What a lookup that finds nothing gives.
NO_WEATHER = {"rainfall_mm": 0.0, "weather_condition": "Clear"}
DEFAULT_REGION = "REG-NORTH"
DEFAULT_STATION = "STN-NORTH"
DEFAULT_COST_CENTER = "CC101"
DEFAULT_UNIT_COST = 2.50

# Rates, accounts and centres of the postings.
LABOR_RATE_PER_KG = "0.08"
FUEL_PRICE_PER_LITER = "1.20"
WAGE_PER_HOUR = "12.50"
OVERTIME_PER_HOUR = "18.75"
FLEET_COST_CENTER = "CC201"
FUEL_MATERIAL = "MAT04"
COMPANY_CODE = "MY10"
CURRENCY = "MYR"
PAYDAY_HOUR = 17
ACCOUNTS = {
    "HARVEST_LABOR": ("500100", "200100"),
    "FERTILIZER_CONSUMPTION": ("501100", "140100"),
    "EQUIPMENT_FUEL": ("502100", "140100"),
    "EQUIPMENT_MAINTENANCE": ("502200", "200100"),
    "PAYROLL_WAGES": ("503100", "200100"),
    "OVERTIME_WAGES": ("503200", "200100"),
}

# Amounts the data does not hold; the caller may set them.
HARVEST_FEE = "0.00"
MAINTENANCE_RATE = "250.00"

WORKED = ("PRESENT", "LATE")


def enrich_hourly(
    fact: DataFrame,
    weather: DataFrame,
    timestamp: str = "timestamp",
    region: str = "region_id",
    take: Mapping[str, Any] = NO_WEATHER,
) -> DataFrame:
    """Add the weather of the full hour in the fact's region; every fact row is kept once."""
    return _at_moment(fact, hour_of(F.col(timestamp)), weather, region, take)


def enrich_fixed_hour(
    fact: DataFrame,
    weather: DataFrame,
    date: str,
    hour: int = 8,
    region: str = "region_id",
    take: Mapping[str, Any] = NO_WEATHER,
) -> DataFrame:
    """Add the weather at a fixed hour of the fact's date."""
    return _at_moment(fact, at_hour(F.col(date), hour), weather, region, take)


def _at_moment(
    fact: DataFrame, moment: Column, weather: DataFrame, region: str, take: Mapping[str, Any]
) -> DataFrame:
    placed = fact.withColumn("_moment", moment)
    keys = {"_moment": "timestamp", region: "region_id"}
    last_station = [F.col("station_id").desc_nulls_last()]
    return lookup(placed, weather, keys, take, order_by=last_station).drop("_moment")


def with_station(fact: DataFrame, weather: DataFrame, stations: DataFrame) -> DataFrame:
    """Hourly weather, and the station it was measured at or else the region's own station."""
    homed = lookup(
        fact, stations.withColumnRenamed("station_id", "_home"), {"region_id": "region_id"}, {"_home": DEFAULT_STATION}
    )
    found = enrich_hourly(homed, weather, take={**NO_WEATHER, "station_id": None})
    return found.withColumn("station_id", F.coalesce("station_id", "_home")).drop("_home")


def with_cost_center(fact: DataFrame, blocks: DataFrame, cost_centers: DataFrame) -> DataFrame:
    """Block to region to cost centre, each step with its default. Of several centres of a region
    the one in the last position counts."""
    regions = blocks.select(F.col("id").alias("_block"), "region_id")
    placed = lookup(fact, regions, {"block_id": "_block"}, {"region_id": DEFAULT_REGION}, normalise=True)
    centers = cost_centers.select(F.col("id").alias("cost_center_id"), F.col("region_id").alias("_region"), "position")
    return lookup(
        placed,
        centers,
        {"region_id": "_region"},
        {"cost_center_id": DEFAULT_COST_CENTER},
        order_by=[F.col("position").desc()],
    )


def with_unit_cost(fact: DataFrame, materials: DataFrame) -> DataFrame:
    costs = materials.select(F.col("id").alias("_material"), "standard_cost")
    take = {"standard_cost": DEFAULT_UNIT_COST}
    return lookup(fact, costs, {"material_id": "_material"}, take, normalise=True)


def active_workers(harvest: DataFrame, equipment: DataFrame) -> DataFrame:
    """The set of (work_date, employee_id) that harvested or ran a machine."""

    def worked(rows: DataFrame, worker: str) -> DataFrame:
        named = rows.where(F.length(F.col(worker)) > 0)
        return named.select(F.to_date("timestamp").alias("work_date"), F.col(worker).alias("employee_id"))

    return distinct_union(
        worked(harvest.where(is_not("status", "CANCELLED")), "employee_id"),
        worked(equipment.where(is_not("status", "BREAKDOWN", "IDLE")), "operator_id"),
    )


def active_attendance(attendance: DataFrame, active: DataFrame) -> DataFrame:
    """Attendance of people who were active on that day."""
    dated = attendance.withColumn("work_date", F.col("attendance_date"))
    return keep_members(dated, active, ["work_date", "employee_id"], normalise=True).drop("work_date")


def attendance_conflicts(attendance: DataFrame, active: DataFrame) -> DataFrame:
    """People marked absent or on leave on a day they were active; there should be none."""
    return active_attendance(attendance.where(is_not("attendance_status", *WORKED)), active)


def _event(kind: str, reference: str, text: str, **columns: Column) -> Column:
    debit, credit = ACCOUNTS[kind]
    nothing = F.lit(None).cast("string")
    values = {
        "cost_center_id": F.col("cost_center_id"),
        "debit_account": F.lit(debit),
        "credit_account": F.lit(credit),
        "transaction_type": F.lit(kind),
        "reference_document": F.col(reference),
        "employee_id": nothing,
        "equipment_id": nothing,
        "material_id": nothing,
        "description": F.concat(F.lit(f"{text} "), F.col(reference)),
        **columns,
    }
    values["amount"] = values["amount"].cast("decimal(38,8)")
    return F.struct(*[values[name].alias(name) for name in EVENT_COLUMNS])


def _events(rows: DataFrame, *events: Column) -> DataFrame:
    """The events of every row, one projection for all of them; a NULL is no event."""
    return rows.select(F.explode(F.array_compact(F.array(*events))).alias("_event")).select("_event.*")


def harvest_labor(
    harvest: DataFrame, blocks: DataFrame, cost_centers: DataFrame, fee: str = HARVEST_FEE
) -> DataFrame:
    done = with_cost_center(harvest.where(is_not("status", "CANCELLED")), blocks, cost_centers)
    return _events(
        done,
        _event(
            "HARVEST_LABOR",
            "harvest_id",
            "Harvest Labor Batch",
            posting_timestamp=F.col("timestamp"),
            employee_id=F.col("employee_id"),
            equipment_id=F.col("equipment_id"),
            amount=times_rate(F.col("harvested_weight_kg"), LABOR_RATE_PER_KG) + F.lit(fee).cast("decimal(18,2)"),
        ),
    )


def fertilizer_use(
    fertilizer: DataFrame, blocks: DataFrame, cost_centers: DataFrame, materials: DataFrame
) -> DataFrame:
    done = with_cost_center(fertilizer.where(is_not("application_status", "CANCELLED")), blocks, cost_centers)
    costed = with_unit_cost(done, materials)
    amount = measured(F.col("quantity_kg")) * F.col("standard_cost").try_cast("decimal(14,4)")
    return _events(
        costed,
        _event(
            "FERTILIZER_CONSUMPTION",
            "application_id",
            "Fertilizer Consumption",
            posting_timestamp=F.col("timestamp"),
            employee_id=F.col("employee_id"),
            equipment_id=F.col("equipment_id"),
            material_id=F.col("material_id"),
            amount=amount,
        ),
    )


def fleet_costs(equipment: DataFrame, maintenance_rate: str = MAINTENANCE_RATE) -> DataFrame:
    """Fuel of every operation, and a flat repair cost of the flagged ones."""
    rows = equipment.withColumn("cost_center_id", F.lit(FLEET_COST_CENTER))
    same = {
        "posting_timestamp": F.col("timestamp"),
        "employee_id": F.col("operator_id"),
        "equipment_id": F.col("equipment_id"),
    }
    cost = F.lit(maintenance_rate).cast("decimal(18,2)")
    return _events(
        rows,
        _event(
            "EQUIPMENT_FUEL",
            "operation_id",
            "Equipment Fuel",
            material_id=F.lit(FUEL_MATERIAL),
            amount=times_rate(F.col("fuel_consumption_liters"), FUEL_PRICE_PER_LITER),
            **same,
        ),
        F.when(
            F.col("maintenance_flag"),
            _event("EQUIPMENT_MAINTENANCE", "operation_id", "Equipment Repair", amount=cost, **same),
        ),
    )


def wages(attendance: DataFrame) -> DataFrame:
    """Wages and overtime of days worked, dated at the end of the working day."""
    rows = attendance.where(F.col("attendance_status").isin(*WORKED))
    center = F.coalesce(F.col("cost_center_id"), F.lit(DEFAULT_COST_CENTER))
    same = {
        "posting_timestamp": at_hour(F.col("attendance_date"), PAYDAY_HOUR),
        "cost_center_id": center,
        "employee_id": F.col("employee_id"),
    }
    regular = times_rate(F.col("working_hours"), WAGE_PER_HOUR)
    overtime = times_rate(F.col("overtime_hours"), OVERTIME_PER_HOUR)
    return _events(
        rows,
        _event("PAYROLL_WAGES", "attendance_id", "Daily Wage", amount=regular, **same),
        _event("OVERTIME_WAGES", "attendance_id", "Overtime Wages", amount=overtime, **same),
    )


def events(
    silver: Mapping[str, DataFrame],
    master: Mapping[str, DataFrame],
    fee: str = HARVEST_FEE,
    maintenance_rate: str = MAINTENANCE_RATE,
) -> DataFrame:
    """All events that operations give rise to, posted or not."""
    blocks, centers = master["blocks"], master["cost_centers"]
    return (
        harvest_labor(silver["harvest"], blocks, centers, fee)
        .unionByName(fertilizer_use(silver["fertilizer"], blocks, centers, master["materials"]))
        .unionByName(fleet_costs(silver["equipment"], maintenance_rate))
        .unionByName(wages(silver["hr"]))
    )


def ledger(
    silver: Mapping[str, DataFrame],
    master: Mapping[str, DataFrame],
    fee: str = HARVEST_FEE,
    maintenance_rate: str = MAINTENANCE_RATE,
    company_code: str = COMPANY_CODE,
    currency: str = CURRENCY,
) -> DataFrame:
    """All postings of the estate, two lines per event. Every event with a positive amount is posted;
    there is no cap, and ``unposted_events(events(...))`` lists the others."""
    return post_pairs(events(silver, master, fee, maintenance_rate), F.lit(company_code), F.lit(currency))
