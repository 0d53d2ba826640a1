"""Rounds of an operator leave no shuffle files behind."""

import os
import re

from pyspark.sql import functions as F

from fieldlake.llm.common import saved
from fieldlake.llm.components import _star, components
from fieldlake.session import SHUFFLES_GO


def shuffle_files(spark):
    jvm = spark.sparkContext._jvm
    folders = [str(d) for d in jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def test_a_saved_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLES_GO, "false")
    rows = saved(spark.range(1000).groupBy(F.pmod("id", F.lit(7)).alias("k")).count(), "counts")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLES_GO, "false") == setting
    assert sorted(r["count"] for r in rows.collect()) == [142] + [143] * 6


def test_components_leave_no_shuffle_files(spark):
    chain = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    before = shuffle_files(spark)
    found = components(chain)
    assert not shuffle_files(spark) - before
    assert {tuple(r) for r in found.collect()} == {(n, 0) for n in range(41)}


def plain_round(edges):
    """A large and a small star in plain Python, of edges from a greater to a lesser node."""
    around = {n: {x for e in edges if n in e for x in e} for e in edges for n in e}
    large = {(a, min(around[b])) for a, b in edges}
    lesser = {a: {b for x, b in large if x == a} for a, _ in large}
    return {(x, min(found)) for a, found in lesser.items() for x in (a, *found) if x != min(found)}


def test_a_round_of_stars_has_seven_shuffles_at_most(spark):
    edges = [(3, 1), (3, 2), (5, 4), (5, 3), (7, 6), (9, 5), (9, 4), (9, 8)]
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in plain}
    now = saved(spark.createDataFrame(edges, "a long, b long"), "links")
    try:
        for name, value in plain.items():
            spark.conf.set(name, value)
        out = _star(_star(now, large=True), large=False).distinct()
        assert {tuple(r) for r in out.collect()} == plain_round(edges)
        assert len(re.findall(" Exchange hashpartitioning", out._jdf.queryExecution().executedPlan().toString())) <= 7
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
