"""Physical plans are the ones the operators are written for."""

import re

import pytest
from pyspark.sql import functions as F

from catalogue import all_cases
from fieldlake.operators.cleaning import clean
from fieldlake.operators.dedupe import dedupe
from fieldlake.operators.lookup import hot_keys, keep_members, lookup
from fieldlake.operators.measures import breakdown, filter_in, top_k
from fieldlake.operators.models import build_model
from fieldlake.operators.quality import dq_report
from fieldlake.plans.estate import FACT_HARVEST, HARVEST
from fieldlake.sources.batch import write_table

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet")


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "bronze")
    rows = [{"harvest_id": "h1", "timestamp": "2024-01-01 00:00:00"}]
    data = [[row.get(n) for n in HARVEST.column_names] for row in rows]
    write_table(spark.createDataFrame(data, HARVEST.text_schema), path)
    return spark.read.parquet(path)


def test_dedupe_filters_ranks_before_its_one_shuffle(lines):
    text = plan(dedupe(lines, ["l_orderkey", "l_linenumber"]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1


def test_fact_reuses_the_partitioning_of_the_cleaned_rows(bronze):
    text = plan(build_model(clean(bronze, HARVEST), FACT_HARVEST))
    assert text.count("Exchange hashpartitioning") == 1


def test_fact_of_a_proven_key_does_not_shuffle(bronze):
    assert "Exchange" not in plan(build_model(bronze, FACT_HARVEST, unique_by=("harvest_id",)))


def test_key_filters_reach_the_scan(bronze):
    text = plan(clean(bronze, HARVEST))
    assert "IsNotNull(harvest_id)" in text and "IsNotNull(timestamp)" in text


def test_chosen_values_and_columns_reach_the_scan(lines):
    text = plan(breakdown(filter_in(lines, {"l_returnflag": ["A", "N"]}), "l_linestatus", {"qty": "l_quantity"}))
    assert "In(l_returnflag, [A,N])" in text
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_linestatus:string>" in text


def test_report_counts_before_it_shuffles(bronze):
    text = plan(dq_report(bronze, HARVEST))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text
    assert text.count("FileScan") == 1


def test_top_list_is_not_a_sort(lines):
    assert "TakeOrderedAndProject" in plan(top_k(breakdown(lines, "l_partkey", {"q": "l_quantity"}), "q", "l_partkey"))


def test_small_reference_does_not_shuffle_the_fact(spark, lines):
    ref = spark.read.parquet(f"{SF_DIR}/supplier.parquet")
    text = plan(lookup(lines, ref, {"l_suppkey": "s_suppkey"}, {"s_name": "?"}))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_lookup_runs_no_job_and_reads_the_fact_once(spark, lines):
    ref = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("building", "lookups")
    try:
        found = lookup(lines, ref, {"l_orderkey": "o_orderkey"}, {"o_custkey": None})
        kept = keep_members(lines, ref.withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"])
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert plan(found).count("lineitem.parquet") == plan(kept).count("lineitem.parquet") == 1


def test_named_hot_keys_are_broadcast_and_spread(spark, lines):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ref = spark.read.parquet(f"{SF_DIR}/orders.parquet")
        text = plan(lookup(lines, ref, {"l_orderkey": "o_orderkey"}, {"o_custkey": None}, hot=hot_keys(lines, ["l_orderkey"])))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in text
    assert re.search(r"hashpartitioning\(_key_0#\w+, _spread#\w+", text)


@pytest.mark.parametrize("name", sorted(n for n, c in all_cases().items() if c.sql and not n.startswith(("live_", "batch_", "csv_", "raw_"))))
def test_no_query_crosses_tables_or_runs_python(spark, name):
    text = plan(all_cases()[name].run(spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert bad not in text
