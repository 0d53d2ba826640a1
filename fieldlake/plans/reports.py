"""The reports of every section: KPI rows, trends, breakdowns and top lists, as DataFrames.

KPI rows and small ordered lists are aggregated in Spark from the whole fact tables; nothing is
fetched to be summed elsewhere. Groups with a NULL key are dropped where a report is a picture of
known groups, and kept in the overview.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.functions.measures import percent
from fieldlake.operators.ledger import CREDIT, DEBIT
from fieldlake.operators.measures import (
    breakdown,
    count_by,
    distinct_values,
    exact_sum,
    filter_in,
    largest_first,
    sums,
    top_k,
)

KG = {"kg": "harvested_weight_kg"}
AMOUNT = {"amount": "amount"}
QUANTITY = {"kg": "quantity_kg"}
FUEL = {"liters": "fuel_consumption_liters"}
MINUTES = {"minutes": "duration_minutes"}


def _mean(column: str) -> Column:
    """A mean that does not depend on the order of rows, as far as ``exact_sum`` does not."""
    return F.try_divide(exact_sum(F.col(column)), F.count(column))


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _ranked(df: DataFrame, by: str, measures: Mapping[str, str]) -> DataFrame:
    value = next(iter(measures))
    return largest_first(breakdown(df, by, measures, drop_null_keys=True), value, by)


def _trend(df: DataFrame, date: str, measures: Mapping[str, str]) -> DataFrame:
    return breakdown(df, date, measures, drop_null_keys=True).orderBy(date)


# All sources


def status_mix(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per status of every source, given with the name of its status column."""
    mixes = [
        df.groupBy(F.lit(name).alias("source"), F.col(column).alias("status")).agg(_rows("rows"))
        for name, (df, column) in sources.items()
    ]
    union = mixes[0]
    for mix in mixes[1:]:
        union = union.unionByName(mix)
    return union


# Overview


def overview(gold: Mapping[str, DataFrame]) -> DataFrame:
    """One row: harvest operations and weight, ledger amount of both sides, machines and people."""
    harvest = gold["fact_harvest"]
    return (
        harvest.agg(_rows("operations"), *sums(harvest, KG).values())
        .withColumn("amount", gold["fact_revenue"].agg(F.sum("amount").alias("amount")).scalar())
        .withColumn("machines", gold["dim_equipment"].agg(_rows("n")).scalar())
        .withColumn("people", gold["dim_employee"].agg(_rows("n")).scalar())
    )


def overview_trend(harvest: DataFrame) -> DataFrame:
    return breakdown(harvest, "harvest_date", KG).orderBy("harvest_date")


def overview_by_crop(harvest: DataFrame) -> DataFrame:
    return largest_first(breakdown(harvest, "crop_type", KG), "kg", "crop_type")


def overview_top_blocks(harvest: DataFrame, n: int = 10) -> DataFrame:
    return top_k(breakdown(harvest, "block_id", KG, rows_as="operations"), "kg", "block_id", n)


# Harvest


def harvest_choices(harvest: DataFrame, column: str) -> DataFrame:
    """What can be chosen in a filter."""
    return distinct_values(harvest, column)


def harvest_selection(
    harvest: DataFrame, blocks: Iterable[str] = (), crops: Iterable[str] = ()
) -> DataFrame:
    return filter_in(harvest, {"block_id": blocks, "crop_type": crops})


def harvest_kpis(harvest: DataFrame) -> DataFrame:
    completed = F.count_if(F.col("status") == "COMPLETED")
    rows = F.count(F.lit(1))
    return harvest.agg(
        *sums(harvest, KG).values(),
        rows.alias("operations"),
        completed.alias("completed"),
        percent(completed, rows).alias("completion_rate"),
        _mean("moisture_pct").alias("avg_moisture"),
    )


def harvest_trend(harvest: DataFrame) -> DataFrame:
    return _trend(harvest, "harvest_date", KG)


def harvest_by(harvest: DataFrame, column: str) -> DataFrame:
    """Weight per crop_type, block_id or destination, largest first."""
    return _ranked(harvest, column, KG)


def harvest_by_grade(harvest: DataFrame) -> DataFrame:
    """Weighed operations per grade."""
    return count_by(harvest, "quality_grade", "harvested_weight_kg", "operations", drop_null_keys=True)


# Ledger


def ledger_kpis(ledger: DataFrame) -> DataFrame:
    """One row: gross of both sides, each side, lines, categories and the currencies in use, in order.

    The ledger is read once, into few groups, from which all figures follow. ``ledger_currencies`` has a row for each.
    """
    side, lines = F.col("debit_credit_indicator"), F.col("lines")
    groups = breakdown(ledger, ["debit_credit_indicator", "transaction_type", "currency"], AMOUNT, rows_as="lines")
    return groups.agg(
        F.sum("amount").alias("gross"),
        F.sum(F.when(side == DEBIT, F.col("amount"))).alias("debit"),
        F.sum(F.when(side == CREDIT, F.col("amount"))).alias("credit"),
        F.sum(lines).alias("lines"),
        F.sum(F.when(side == DEBIT, lines)).alias("debit_lines"),
        F.sum(F.when(side == CREDIT, lines)).alias("credit_lines"),
        F.count_distinct("transaction_type").alias("categories"),
        F.when(F.count("currency") > 0, F.array_join(F.array_sort(F.collect_set("currency")), ",")).alias("currencies"),
    )


def ledger_currencies(ledger: DataFrame) -> DataFrame:
    """The currencies in use, a row each, with lines and the gross amount in each."""
    return breakdown(ledger, "currency", AMOUNT, rows_as="lines", drop_null_keys=True)


def ledger_trend(ledger: DataFrame) -> DataFrame:
    return _trend(ledger, "posting_date", AMOUNT)


def ledger_by(ledger: DataFrame, column: str) -> DataFrame:
    """Amount per transaction_type or cost_center_id, largest first."""
    return _ranked(ledger, column, AMOUNT)


def ledger_by_period(ledger: DataFrame) -> DataFrame:
    return _trend(ledger, "fiscal_period", AMOUNT)


def ledger_top_accounts(ledger: DataFrame, n: int = 10) -> DataFrame:
    return top_k(breakdown(ledger, "gl_account", AMOUNT, drop_null_keys=True), "amount", "gl_account", n)


# Fertilizer


def fertilizer_kpis(fertilizer: DataFrame) -> DataFrame:
    """One row; the facts are first reduced to one row per material and block."""
    groups = fertilizer.groupBy("material_id", "block_id").agg(
        exact_sum(F.col("quantity_kg")).alias("kg"),
        F.count("quantity_kg").alias("weighed"),
        _rows("applications"),
    )
    return groups.agg(
        exact_sum(F.col("kg")).alias("kg"),
        F.sum("applications").alias("applications"),
        F.count_distinct("material_id").alias("materials"),
        F.count_distinct("block_id").alias("blocks"),
        F.try_divide(exact_sum(F.col("kg")), F.sum("weighed")).alias("avg_kg"),
    )


def fertilizer_trend(fertilizer: DataFrame) -> DataFrame:
    return _trend(fertilizer, "application_date", QUANTITY)


def fertilizer_by(fertilizer: DataFrame, column: str) -> DataFrame:
    """Quantity per material_id, application_method or crop_type, largest first."""
    return _ranked(fertilizer, column, QUANTITY)


def fertilizer_top_blocks(fertilizer: DataFrame, n: int = 10) -> DataFrame:
    return top_k(breakdown(fertilizer, "block_id", QUANTITY, drop_null_keys=True), "kg", "block_id", n)


# Equipment


def fleet_by_type(dim_equipment: DataFrame) -> DataFrame:
    return count_by(dim_equipment, "equipment_type", name="machines")


def equipment_kpis(operations: DataFrame, dim_equipment: DataFrame) -> DataFrame:
    fleet = fleet_by_type(dim_equipment).agg(F.sum("machines").alias("fleet"))
    return operations.agg(
        _rows("operations"),
        F.count_distinct("equipment_id").alias("machines_used"),
        *sums(operations, FUEL).values(),
        F.count_if(F.col("maintenance_flag")).alias("maintenance_operations"),
    ).withColumn("fleet", fleet.scalar())


def operations_by_status(operations: DataFrame) -> DataFrame:
    return count_by(operations, "status", "operation_type", "operations", drop_null_keys=True)


def fuel_trend(operations: DataFrame) -> DataFrame:
    return _trend(operations, "operation_date", FUEL)


def minutes_by_type(operations: DataFrame) -> DataFrame:
    return _ranked(operations, "equipment_type", MINUTES)


def top_machines(operations: DataFrame, n: int = 10) -> DataFrame:
    per_machine = breakdown(operations, "equipment_id", MINUTES, drop_null_keys=True)
    return top_k(per_machine, "minutes", "equipment_id", n)


# Workforce


def workforce(dim_employee: DataFrame) -> DataFrame:
    """People per role, department and cost centre."""
    return breakdown(dim_employee, ["role", "department", "cost_center_id"], {}, rows_as="people")


def workforce_kpis(dim_employee: DataFrame) -> DataFrame:
    return workforce(dim_employee).agg(
        F.sum("people").alias("people"),
        F.count_distinct("role").alias("roles"),
        F.count_distinct("department").alias("departments"),
        F.count_distinct("cost_center_id").alias("cost_centers"),
    )


def workforce_by(dim_employee: DataFrame, column: str) -> DataFrame:
    """People per role or department, largest first."""
    people = breakdown(workforce(dim_employee), column, {"people": "people"}, drop_null_keys=True)
    return largest_first(people, "people", column)


# Live sensors

# Sensor states and the measures of the live views.
SENSOR_STATES = {"ok": "OK", "anomaly": "ANOMALY", "fault": "FAULT"}
LIVE_VIEWS = {
    "kpi_temperature": ("air_temperature_c", "soil_temperature_c"),
    "kpi_humidity": ("humidity_pct",),
    "kpi_soil_moisture": ("soil_moisture_pct", "soil_ph"),
}


def live_measures(readings: DataFrame, view: str) -> DataFrame:
    """One row per reading with the measures of a live view."""
    return readings.select("block_id", "sensor_id", F.col("timestamp").alias("reading_ts"), *LIVE_VIEWS[view])


def _per_sensor(readings: DataFrame, *more: Column) -> DataFrame:
    state = F.col("sensor_status")
    return readings.groupBy("block_id", "sensor_id").agg(
        F.max("timestamp").alias("last_reading_ts"),
        _rows("reading_count"),
        *[F.count_if(state == value).alias(f"{name}_count") for name, value in SENSOR_STATES.items()],
        _mean("battery_level_pct").alias("avg_battery_pct"),
        *more,
    )


def live_status(readings: DataFrame, last_status: bool = False) -> DataFrame:
    """Readings per sensor and state, the last reading's time and the mean battery level.

    ``last_status`` adds the state of the newest reading; of two at one time the later by name.
    """
    newest = F.max(F.struct("timestamp", "sensor_status"))["sensor_status"].alias("last_status")
    return _per_sensor(readings, *([newest] if last_status else []))


def status_partials(readings: DataFrame) -> DataFrame:
    """Figures per sensor from which ``merged_status`` makes its status, of any part of the readings."""
    state = F.col("sensor_status")
    return readings.groupBy("block_id", "sensor_id").agg(
        F.max(F.struct(F.col("timestamp").alias("at"), state.alias("state"))).alias("newest"),
        _rows("reading_count"),
        *[F.count_if(state == value).alias(f"{name}_count") for name, value in SENSOR_STATES.items()],
        exact_sum(F.col("battery_level_pct")).alias("battery"),
        F.count("battery_level_pct").alias("batteries"),
    )


def merge_status_partials(partials: DataFrame) -> DataFrame:
    """The same figures of all parts together."""
    counts = ["reading_count", *[f"{name}_count" for name in SENSOR_STATES]]
    return partials.groupBy("block_id", "sensor_id").agg(
        F.max("newest").alias("newest"), *[F.sum(name).alias(name) for name in counts],
        exact_sum(F.col("battery")).alias("battery"), F.sum("batteries").alias("batteries"),
    )


def merged_status(partials: DataFrame, last_status: bool = False) -> DataFrame:
    """``live_status`` from the figures of parts of the readings; no reading is looked at."""
    merged = merge_status_partials(partials)
    last = [F.col("newest.state").alias("last_status")] if last_status else []
    return merged.select(
        "block_id", "sensor_id", F.col("newest.at").alias("last_reading_ts"), "reading_count",
        *[f"{name}_count" for name in SENSOR_STATES],
        F.try_divide("battery", "batteries").alias("avg_battery_pct"), *last,
    )


def live_kpis(readings: DataFrame) -> DataFrame:
    """One row over all sensors. ``mean_of_sensor_means`` gives every sensor the same weight,
    ``mean_of_readings`` every reading."""
    per_sensor = _per_sensor(
        readings, exact_sum(F.col("battery_level_pct")).alias("_sum"), F.count("battery_level_pct").alias("_n")
    )
    return per_sensor.agg(
        F.count_distinct("sensor_id").alias("sensors"),
        F.sum("reading_count").alias("readings"),
        *[F.sum(f"{name}_count").alias(name) for name in SENSOR_STATES],
        _mean("avg_battery_pct").alias("mean_of_sensor_means"),
        F.try_divide(exact_sum(F.col("_sum")), F.sum("_n")).alias("mean_of_readings"),
    )


def live_health(readings: DataFrame) -> DataFrame:
    """Readings per state as rows."""
    state = F.col("sensor_status")
    counted = readings.agg(*[F.count_if(state == value).alias(value) for value in SENSOR_STATES.values()])
    return counted.unpivot([], list(SENSOR_STATES.values()), "sensor_status", "readings")


def live_series(readings: DataFrame, measure: str) -> DataFrame:
    """A measure over time, per sensor, in no order: who shows a stretch of it sorts that stretch."""
    return readings.select(F.col("timestamp").alias("reading_ts"), "sensor_id", measure)


def reduced_series(readings: DataFrame, measure: str, start: datetime, end: datetime, buckets: int) -> DataFrame:
    """A measure over a stretch of time for a chart ``buckets`` wide: per sensor and bucket the first, the last,
    the least and the greatest reading, so at most four rows, and a line through them covers the same points
    of the chart as one through all. Of equal values the earliest counts.
    """
    step = (end - start).total_seconds() / buckets
    stretch = readings.where(F.col(measure).isNotNull() & (F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))
    since = (F.unix_micros("timestamp") - F.unix_micros(F.lit(start))) / F.lit(1e6)
    at = F.struct(F.col("timestamp").alias("reading_ts"), F.col(measure).alias(measure))
    low = F.struct(F.col(measure).alias("v"), F.unix_micros("timestamp").alias("t"))
    high = F.struct(F.col(measure).alias("v"), (-F.unix_micros("timestamp")).alias("t"))
    held = stretch.groupBy("sensor_id", F.floor(since / F.lit(step)).alias("bucket")).agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.min(low).alias("low"), F.max(high).alias("high")
    )

    def point(extreme: str, sign: int) -> Column:
        return F.struct(
            F.timestamp_micros(F.lit(sign) * F.col(f"{extreme}.t")).alias("reading_ts"), F.col(f"{extreme}.v").alias(measure)
        )

    points = F.array_distinct(F.array("first", "last", point("low", 1), point("high", -1)))
    return held.select("sensor_id", "bucket", F.explode(points).alias("p")).select("sensor_id", "bucket", "p.*")
