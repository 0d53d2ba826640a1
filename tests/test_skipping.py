"""Files that a read for certain values opens."""

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldlake.errors import SourceError
from fieldlake.plans.batch import build_gold
from fieldlake.plans.estate import FACT_HARVEST, SERVING
from fieldlake.plans.serving import serving_rows, serving_views
from fieldlake.sources.batch import read_table, write_table
from fieldlake.sources.layout import Layout
from fieldlake.sources.skipping import files_with, read_where

START = dt.date(2024, 1, 1)


CONFS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4000", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400"}


@contextlib.contextmanager
def many_files(spark):
    """Partitions of a few days, as a large table has them."""
    for name, value in CONFS.items():
        spark.conf.set(name, value)
    yield
    for name in CONFS:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """A year of rows, by month; a file holds few days."""
    path = str(tmp_path_factory.mktemp("year") / "t")
    day = F.date_add(F.lit(START), (F.col("id") % 366).cast("int"))
    rows = spark.range(20_000).select(
        F.concat(F.lit("k"), "id").alias("key"), F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(day).alias("day"), (F.col("id") * 1.5).alias("x"),
    ).withColumn("month", F.coalesce(F.date_format("day", "yyyy-MM"), F.lit("none")))
    with many_files(spark):
        write_table(rows, path, "versioned", partition_by=("month",), cluster_by=("day",), index=("day", "key"))
    return path



@pytest.mark.parametrize("where", [
    {"day": dt.date(2024, 3, 5)}, {"day": "2024-03-05"}, {"day": (dt.date(2024, 3, 5), dt.date(2024, 3, 9))}, {"day": (None, "2024-01-02")},
    {"day": ("2024-12-30", None), "x": (100.0, 9_000.0)}, {"key": "k777"}, {"key": "k777", "day": (None, None)}, {"day": "2031-01-01"}, {"key": "none"},
])
def test_the_rows_of_a_filter_from_few_files(spark, table, where):
    whole = read_table(spark, table)
    wanted = whole
    for name, value in where.items():
        low, high = value if isinstance(value, tuple) else (value, value)
        wanted = wanted.where(F.col(name).isNotNull())
        wanted = wanted if low is None else wanted.where(F.col(name) >= F.lit(low).cast(dict(whole.dtypes)[name]))
        wanted = wanted if high is None else wanted.where(F.col(name) <= F.lit(high).cast(dict(whole.dtypes)[name]))
    found = read_where(spark, table, where)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
    assert found.dtypes == whole.dtypes
    if wanted.count():
        assert len(found.inputFiles()) <= len(whole.inputFiles()) / 4
        if where == {"day": "2024-03-05"} or where == {"key": "k777"}:
            assert len(found.inputFiles()) <= 3


def test_an_index_tells_every_row(spark, table):
    assert files_with(spark, table, {"day": (None, None)}).agg(F.sum("rows")).first()[0] == 20_000
    assert files_with(spark, table, {"x": 1.0}) is None
    assert read_where(spark, table, {"x": 1.5}).count() == 1
    with pytest.raises(SourceError, match="no column"):
        read_where(spark, table, {"y": 1})


def test_many_files_are_read_as_a_whole(spark, table, monkeypatch):
    monkeypatch.setattr("fieldlake.sources.skipping.MOST_FILES", 2)
    found = read_where(spark, table, {"day": ("2024-01-01", "2024-06-30")})
    assert found.count() == read_table(spark, table).where("day <= '2024-06-30'").count()


def test_facts_by_month_open_the_files_of_a_day(spark, tmp_path):
    layout = Layout(str(tmp_path))
    silver = spark.range(3_000).select(*[
        F.lit(None).cast(kind).alias(name) for name, kind in {"timestamp": "timestamp", **FACT_HARVEST_SOURCE}.items()
    ], "id").withColumns({
        "harvest_id": F.concat(F.lit("H"), "id"), "timestamp": F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3_600),
    })
    with many_files(spark):
        write_table(silver, layout.silver("harvest"), layout.batch_format)
        assert build_gold(spark, layout, FACT_HARVEST) == 3_000
    view = serving_views(spark, layout, {"fact_harvest": SERVING["fact_harvest"]})["fact_harvest"]
    day = serving_rows(spark, layout, "fact_harvest", {"harvest_date": dt.date(2024, 2, 3)})
    assert day.columns == view.columns and day.count() == 24
    assert sorted(map(tuple, day.collect())) == sorted(map(tuple, view.where("harvest_date = '2024-02-03'").collect()))
    assert len(day.inputFiles()) <= 2 < len(view.inputFiles())
    one = serving_rows(spark, layout, "fact_harvest", {"harvest_id": "H77"})
    assert one.count() == 1 and len(one.inputFiles()) <= 2


FACT_HARVEST_SOURCE = {
    "harvest_id": "string", "block_id": "string", "crop_type": "string", "employee_id": "string", "equipment_id": "string",
    "harvested_weight_kg": "double", "quality_grade": "string", "moisture_pct": "double", "collection_duration_minutes": "int",
    "destination": "string", "status": "string",
}
