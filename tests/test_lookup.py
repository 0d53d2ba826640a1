"""Lookups: defaults, no fan-out, hot keys, membership and orphans."""

import random

import pytest
from pyspark.sql import functions as F

from fieldlake.operators.lookup import (
    distinct_union,
    heavy_keys,
    hot_keys,
    is_small,
    keep_members,
    lookup,
    orphan_keys,
    orphan_summary,
)
from fieldlake.errors import ContractError
from fieldlake.operators import lookup as lookups
from fieldlake.operators.measures import breakdown, count_by, filter_in, is_not, top_k


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on one key, a tenth without a key."""
    random.seed(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{random.randrange(400)}"
        rows.append((i, key))
    return spark.createDataFrame(rows, "id int, k string").repartition(6), rows


@pytest.mark.parametrize("apart", [False, True])
@pytest.mark.parametrize("hot_known", [True, False])
def test_lookup_equals_brute_force(spark, skewed, apart, hot_known):
    fact, rows = skewed
    table = {f"k{i}": i for i in range(0, 400, 2)}
    if hot_known:
        table["hot"] = -7
    ref = spark.createDataFrame(list(table.items()), "code string, v int")
    found = lookup(fact, ref, {"k": "code"}, {"v": 99}, hot=hot_keys(fact, ["k"], 10) if apart else None)
    assert found.columns == ["id", "k", "v"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(i, k, table.get(k, 99)) for i, k in rows], key=str
    )


@pytest.mark.parametrize("apart", [False, True])
def test_last_reference_row_wins_without_fan_out(spark, apart):
    fact = spark.createDataFrame([(1, " reg-central "), (2, "REG-X")], "id int, region string")
    ref = spark.createDataFrame([("CC102", "REG-CENTRAL", 1), ("CC201", "REG-CENTRAL", 3)], "cc string, r string, p int")
    found = lookup(
        fact, ref, {"region": "r"}, {"cc": "CC101"}, order_by=[F.col("p").desc()], normalise=True,
        hot=fact.where("id = 1") if apart else None,
    )
    assert {r.id: r.cc for r in found.collect()} == {1: "CC201", 2: "CC101"}


def test_null_reference_value_takes_the_default(spark):
    fact = spark.createDataFrame([(1, "a")], "id int, k string")
    ref = spark.createDataFrame([("a", None)], "k string, rain double")
    assert lookup(fact, ref, {"k": "k"}, {"rain": 0.0}).first().rain == 0.0


def test_unique_reference_is_not_searched(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    ref = spark.createDataFrame([("a", 5)], "k string, v int")
    found = lookup(fact, ref, {"k": "k"}, {"v": 0}, unique=True)
    assert {r.id: r.v for r in found.collect()} == {1: 5, 2: 0}
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [2, 7, 40, 300])
def test_heavy_keys_are_the_hot_keys(spark, limit):
    rng = random.Random(limit)
    weights = [1 / (i + 1) for i in range(3_000)]
    rows = [(k, None if rng.random() < 0.05 else k % 3) for k in rng.choices(range(3_000), weights, k=20_000)]
    df = spark.createDataFrame(rows, "k int, part int").repartition(7)
    for on in (["k"], ["k", "part"]):
        found, wanted = heavy_keys(df, on, limit), hot_keys(df, on, limit)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
        assert found.count() <= limit


def test_heavy_keys_of_even_and_empty_frames(spark):
    assert heavy_keys(spark.range(50_000), ["id"], 100).count() == 0
    assert heavy_keys(spark.range(10).where("id > 10"), ["id"]).columns == ["id"]
    assert heavy_keys(spark.createDataFrame([(None,)] * 5, "k string"), ["k"], 3).count() == 0
    assert [r.id for r in heavy_keys(spark.range(1), ["id"], 2).collect()] == [0]
    with pytest.raises(ContractError, match="counters"):
        heavy_keys(spark.range(3), ["id"], 1_000_000)


def test_hot_rows_too_large_to_broadcast_are_looked_up_as_all_others(spark, skewed, monkeypatch):
    fact, rows = skewed
    ref = spark.createDataFrame([("hot", "x" * 200)], "code string, v string")
    monkeypatch.setattr(lookups, "is_small", lambda df: is_small(df, size=100))
    found = lookup(fact, ref, {"k": "code"}, {"v": "-"}, hot=heavy_keys(fact, ["k"], 10))
    assert "_hot" not in found._jdf.queryExecution().analyzed().toString()
    assert found.where("v <> '-'").count() == sum(k == "hot" for _, k in rows)


def test_hot_keys_are_bounded(spark, skewed):
    fact, _ = skewed
    assert [r.k for r in hot_keys(fact, ["k"], 5).collect()] == ["hot"]
    assert hot_keys(fact, ["k"], 50).count() <= 50


def test_size_is_measured(spark):
    df = spark.range(1000)
    assert is_small(df, 1000) and not is_small(df, 999) and not is_small(df, 1000, 10)


def test_hot_rows_are_spread(spark, skewed):
    """With the hot key apart, no shuffle partition of the lookup holds the hot third."""
    fact, _ = skewed
    ref = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(400)]], "code string, v int")

    def largest(joined):
        sizes = joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
        assert sum(r["n"] for r in sizes) == 3000
        return max(r["n"] for r in sizes)

    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        plain = fact.join(ref, fact["k"] == ref["code"], "left")
        assert largest(plain) > 1000
        for limit in (10, 100):
            assert largest(lookup(fact, ref, {"k": "code"}, {"v": None}, hot=hot_keys(fact, ["k"], limit))) < 700
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_members_and_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "id int, k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "p string")
    kept = keep_members(child, parent.withColumnRenamed("p", "k"), ["k"])
    assert [r.id for r in kept.collect()] == [1]
    assert [tuple(r) for r in orphan_keys(child, parent, {"k": "p"}).collect()] == [("b", 2)]
    assert tuple(orphan_summary(child, parent, {"k": "p"}).first()) == (4, 2, 1, 1)


def test_union_is_a_set(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "d int, e string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "e string, d int")
    assert sorted(map(tuple, distinct_union(a, b).collect())) == [(1, "x"), (2, "y")]


def test_no_value_is_left_out_of_a_sum(spark):
    import duckdb

    for values in ([0.00004, 0.00004, 1e25], [1.5, float("inf")], [float("nan"), 2.0], [0.00004, 0.00004], [1e-12, 3.0], [None, 0.1, 0.2], [None]):
        df = spark.createDataFrame([("g", v) for v in values], "k string, x double")
        found = breakdown(df, "k", {"s": "x"}).first().s
        said = duckdb.connect().execute("select sum(x) from (select unnest(?::double[]) as x)", [values]).fetchall()[0][0]
        assert found == pytest.approx(said, nan_ok=True) if said is not None else found is None


def test_measures(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "S"), ("a", None, None), (None, 5.0, "H"), ("b", 1.0, "S")], "k string, v double, s string"
    )
    assert {r.k: r.v for r in breakdown(df, "k", {"v": "v"}).collect()} == {"a": 1.0, None: 5.0, "b": 1.0}
    assert breakdown(df, "k", {"v": "v"}, drop_null_keys=True).count() == 2
    assert {r.k: r["rows"] for r in count_by(df, "k").collect()} == {"a": 2, None: 1, "b": 1}
    assert {r.k: r.n for r in count_by(df, "k", "v", "n").collect()} == {"a": 1, None: 1, "b": 1}
    totals = breakdown(df, "k", {"v": "v"}, drop_null_keys=True)
    assert [r.k for r in top_k(totals, "v", "k", 2).collect()] == ["a", "b"]
    assert filter_in(df, {"k": []}).count() == 4 and filter_in(df, {"k": ["b"]}).count() == 1
    assert df.where(is_not("s", "S")).count() == 2
    nothing = spark.createDataFrame([("g", None)], "k string, v double")
    assert breakdown(nothing, "k", {"v": "v"}).first().v is None
