"""Shuffle files of a batch run go with each table, and the setting is as before afterwards."""

import datetime
import os

from pyspark.sql import functions as F

from fieldlake.plans import batch
from fieldlake.session import SHUFFLES_GO, shuffles_removed
from fieldlake.sources.layout import Layout
from fieldlake.plans.estate import BATCH_SOURCES


def shuffle_files(spark):
    jvm = spark.sparkContext._jvm
    folders = [str(d) for d in jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    def written(name):
        before = shuffle_files(spark)
        spark.range(1000).groupBy(F.pmod("id", F.lit(7)).alias("k")).count().write.parquet(str(tmp_path / name))
        return shuffle_files(spark) - before

    setting = spark.conf.get(SHUFFLES_GO, "false")
    assert written("kept")
    with shuffles_removed(spark):
        assert not written("gone")
    assert spark.conf.get(SHUFFLES_GO, "false") == setting


def test_a_batch_run_leaves_no_shuffle_files(spark, tmp_path):
    layout = Layout(str(tmp_path))
    contract = BATCH_SOURCES["weather"]
    rows = [("2024-01-01 00:00:00", f"STN{i}") + (None,) * (len(contract.column_names) - 2) for i in range(50)]
    frame = spark.createDataFrame([dict(zip(contract.column_names, r, strict=True)) for r in rows], contract.text_schema)
    frame.write.option("header", "true").csv(layout.landing("weather", contract.file_name))
    before = shuffle_files(spark)
    run = batch.run_batch(spark, layout, datetime.datetime(2024, 1, 2), sources=["weather"])
    assert run.silver == {"weather": 50} and not shuffle_files(spark) - before
