"""Typed views over the finished tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from fieldlake.contracts import ServingContract
from fieldlake.operators.conform import apply_contract
from fieldlake.plans.estate import SENSORS, SERVING
from fieldlake.plans.reports import LIVE_VIEWS, live_measures, live_status
from fieldlake.sources.batch import read_table, read_typed
from fieldlake.sources.layout import Layout
from fieldlake.sources.skipping import read_where


def serving_views(
    spark: SparkSession, layout: Layout, contracts: Mapping[str, ServingContract] = SERVING
) -> dict[str, DataFrame]:
    """``vw_<model>`` over every dimension and fact, with its serving columns, types and widths.

    A text that is too long for its column stops the query that reads it.
    """
    views = {}
    for name, contract in contracts.items():
        table = read_typed(spark, contract, layout.gold(name), layout.batch_format)
        views[name] = apply_contract(table, contract)
        views[name].createOrReplaceTempView(f"vw_{name}")
    return views


def serving_rows(
    spark: SparkSession, layout: Layout, name: str, where: Mapping[str, Any],
    contracts: Mapping[str, ServingContract] = SERVING,
) -> DataFrame:
    """Rows of a fact as its view gives them, for a value or a range ``(low, high)`` of its event date or key
    columns: only the files that may hold such rows are opened, whatever the layout."""
    return apply_contract(read_where(spark, layout.gold(name), where), contracts[name])


def live_views(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """``vw_kpi_*`` over the cleaned live table."""
    readings = read_table(spark, layout.live_silver(SENSORS.name), layout.table_format)
    views = {name: live_measures(readings, name) for name in LIVE_VIEWS}
    views["kpi_sensor_status"] = live_status(readings)
    for name, view in views.items():
        view.createOrReplaceTempView(f"vw_{name}")
    return views
