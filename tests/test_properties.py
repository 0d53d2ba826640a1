"""Operators against brute force on random rows."""

from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fieldlake.operators.dedupe import dedupe, duplicate_counts
from fieldlake.operators.lookup import lookup, orphan_summary
from fieldlake.operators.measures import breakdown, exact_sum, top_k

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
KEY = st.one_of(st.none(), st.sampled_from(["a", "b", "B", " b", ""]))
VALUE = st.one_of(st.none(), st.integers(-3, 3))
ROWS = st.lists(st.tuples(KEY, VALUE, VALUE), min_size=1, max_size=30)


def _order(row):
    """NULL first, as Spark sorts."""
    return [(value is not None, value if value is not None else 0) for value in row]


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 5))
def test_dedupe_keeps_the_smallest_row(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, v int, w int").repartition(parts)
    groups = {}
    for k, v, w in rows:
        groups.setdefault(k, []).append((v, w))
    wanted = {(k, *min(found, key=_order)) for k, found in groups.items()}
    assert {tuple(r) for r in dedupe(df, ["k"]).collect()} == wanted
    counts = duplicate_counts(df, ["k"]).first()
    assert tuple(counts) == (len(rows), len(groups), len(rows) - len(groups))


@SETTINGS
@given(rows=ROWS, ref=st.dictionaries(st.sampled_from(["a", "b", "z"]), st.integers(0, 9), min_size=1), shuffled=st.booleans())
def test_lookup_and_orphans(spark, rows, ref, shuffled):
    fact = spark.createDataFrame(rows, "k string, v int, w int")
    table = spark.createDataFrame(list(ref.items()), "r string, x int")
    found = lookup(fact, table, {"k": "r"}, {"x": -1}, hot=fact.select("k") if shuffled else None)
    assert Counter(map(tuple, found.collect())) == Counter((*row, ref.get(row[0], -1)) for row in rows)
    orphans = [k for k, _, _ in rows if k is not None and k not in ref]
    nulls = sum(k is None for k, _, _ in rows)
    assert tuple(orphan_summary(fact, table, {"k": "r"}).first()) == (len(rows), len(orphans), len(set(orphans)), nulls)


@SETTINGS
@given(rows=ROWS, n=st.integers(1, 4))
def test_top_list(spark, rows, n):
    df = spark.createDataFrame(rows, "k string, v int, w int")
    sums = {}
    for k, v, _ in rows:
        if k is not None:
            sums.setdefault(k, []).append(v)
    totals = {k: sum(v for v in found if v is not None) if any(v is not None for v in found) else None for k, found in sums.items()}
    ranked = sorted(totals, key=lambda k: (totals[k] is None, -(totals[k] or 0), k))[:n]
    top = top_k(breakdown(df, "k", {"total": "v"}, drop_null_keys=True), "total", "k", n)
    assert [(r.k, r.total) for r in top.collect()] == [(k, totals[k]) for k in ranked]


NUMBER = st.one_of(
    st.integers(-10**9, 10**9).map(lambda n: n / 1000), st.floats(-1e6, 1e6), st.sampled_from([0.1, -0.0, 524288.0, 524287.9999999999, 1e17, 9e-10]),
    st.integers(-(10**15), 10**15).map(lambda n: n / 10**10), st.none(),
)


@settings(SETTINGS, max_examples=25)
@given(st.lists(NUMBER, max_size=30), st.randoms(use_true_random=False))
def test_sums_of_what_ten_places_can_tell_are_exact(spark, values, rng):
    def told(v):
        return float(round(Decimal(repr(v)), 10)) == v

    kept = [v for v in values if v is None or told(v)]
    want = [round(Decimal(repr(v)), 10) for v in kept if v is not None]
    rng.shuffle(kept)
    df = spark.createDataFrame([(v,) for v in kept], "v double")
    (row,) = df.agg(exact_sum(F.col("v")).alias("s")).collect()
    assert row.s == (float(sum(want)) if want else None)


def test_values_that_ten_places_cannot_tell_join_the_rest(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").repartition(3).agg(exact_sum(F.col("v")).alias("s")).first().s

    assert total(1e300, 1.5) == 1e300 and total(2.0**-60, 1.0, -1.0) == 2.0**-60
    assert total(float("inf"), 1.0) == float("inf") and total(float("nan"), 1.0) != total(float("nan"), 1.0)
    assert total(0.1, 0.2, 1 / 3) == 0.3 + 1 / 3 and total(None, None) is None and total(*[1e18] * 9, 1.0) == 9e18
