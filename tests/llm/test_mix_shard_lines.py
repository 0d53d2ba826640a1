import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from fieldlake.llm import boilerplate, mixing, sharding


def water_fill(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, total = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in target]
        left, all_ = total - sum(target.values()), sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / all_ > most * sizes[s]]
        if not full:
            return target | {s: left * weight[s] / all_ for s in open_}
        target |= {s: most * sizes[s] for s in full}


@pytest.mark.parametrize("chunk", [3, 20_000])
def test_mix_keeps_targets_and_bounds(docs, chunk):
    rows = mixing.mix(docs, chunk_rows=chunk, fan_in=2).collect()
    sizes, taken, target, largest = Counter(), Counter(), {}, Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
    want = water_fill(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.MOST_COPIES)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    again = mixing.mix(docs, chunk_rows=chunk, fan_in=2).collect()
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in rows)


def test_every_source_comes_near_its_target(spark):
    rows = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")
    ).collect()
    assert len(rows) == 20 and all(abs(r.taken - r.target) <= 0.01 * r.target for r in rows)


def test_one_chunk_against_the_rule_by_hand(spark):
    """A single source in one chunk: fractions meet largest first, then the last rounding is made up."""
    docs = spark.createDataFrame([(i, " ".join(["w"] * (1 + i * 7 % 31)), "s") for i in range(60)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("s", 333.0)], "source string, target double")
    rows = mixing.mix(docs, targets).collect()
    per = 333.0 / sum(r.size for r in rows)
    marks = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("mark"), F.xxhash64(F.lit(mixing.SEED), F.xxhash64("doc_id", "text"), F.length(F.replace("text", F.lit(" "))).cast("long")).alias("u")).collect()
    mark, unit = {r.doc_id: r.mark for r in marks}, {r.doc_id: r.u % (1 << 52) / float(1 << 52) for r in marks}
    order = sorted(rows, key=lambda r: (-r.size, mark[r.doc_id]))
    size, due = np.array([r.size for r in order], float), np.full(60, per)
    final = np.rint(mixing.settle(size, due, np.array([unit[r.doc_id] for r in order])))
    want = mixing.made_up(size, due, final)
    assert [r.copies for r in order] == want.tolist()
    assert abs((want * size).sum() - 333.0) <= abs((final * size).sum() - 333.0) and abs((want * size).sum() - 333.0) < 1


def test_a_row_repeated_over_and_over(spark):
    docs = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot row of five words")).otherwise(F.concat(F.lit("a b c "), F.col("id"))).alias("text"),
        F.lit("s").alias("source"), F.lit(0).alias("rows"),
    )
    targets = spark.createDataFrame([("s", 65_000.0)], "source string, target double")
    rows = mixing.mix(docs, targets)
    per = {r.doc_id == 0: r for r in rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("copies").alias("c"), F.max("copies").alias("most")).where("doc_id = 0 or n > 1").collect()}
    assert per[True].n == 10_000 and per[True].most == 1 and per[True].c == 5_000
    assert rows.agg(F.sum("taken")).first()[0] == 65_000
    mixed = mixing.mixed_documents(docs, targets)
    assert mixed.where("doc_id = 0").count() == 5_000 and mixed.agg(F.sum(F.size(F.split("text", " ")))).first()[0] == 65_000


def test_one_id_and_text_under_several_sources(spark):
    docs = spark.range(400).select("id").join(spark.createDataFrame([("big",), ("small",), (None,)], "source string")).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("six words in each of them "), F.col("id")).alias("text"), "source"
    )
    targets = spark.createDataFrame([("big", 0.0), ("small", 4_900.0), (None, 1_400.0)], "source string, target double")
    mixed = mixing.mixed_documents(docs, targets).groupBy("source").count().collect()
    assert {r.source: r["count"] for r in mixed} == {"small": 700, None: 200}


def test_settling_keeps_words_and_expected_copies():
    size = np.array([9, 8, 7, 5, 5, 4, 3, 2, 1, 1], float)
    rng, total = np.random.default_rng(0), np.zeros(10)
    for _ in range(3_000):
        due = mixing.settle(size, np.full(10, 0.3), rng.random(10))
        assert (due * size).sum() == pytest.approx(0.3 * size.sum())
        assert ((due > 0) & (due < 1)).sum() <= 1
        total += due
    assert np.allclose(total / 3_000, 0.3, atol=0.04)


def test_given_targets(spark, docs):
    targets = spark.createDataFrame([("src0", 40.0)], "source string, target double")
    rows = mixing.mix(docs, targets).where("source <> 'src0'").collect()
    assert rows and all(r.copies == 0 for r in rows)


def test_mix_of_odd_rows(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.size == 0 for r in rows if r.doc_id in (4, 5, 6))
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    want = Counter()
    for r in rows:
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +want
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def brute_shards(texts, shards, cells, nodes, route):
    """The rounds by hand, on counts per cell."""
    room = [len(texts) // shards + (s < len(texts) % shards) for s in range(shards)]
    left, placed = Counter(texts), defaultdict(int)
    for turn in range(shards):
        for cell in sorted(left):
            s = route[cell][turn]
            given = min(left[cell], room[s])
            room[s] -= given
            left[cell] -= given
            placed[cell, s] += given
    return {k: v for k, v in placed.items() if v}


@pytest.mark.parametrize(("cells", "nodes"), [(4_096, 128), (16, 4)])
def test_shards_against_rounds_by_hand(spark, docs, cells, nodes):
    rows = sharding.shard_documents(docs, virtual_nodes=nodes, cells=cells).collect()
    per = defaultdict(list)
    for r in rows:
        per[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in per.values())
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1 and len(per) == 8
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert (r.size, r.text_crc32) == (len(text[r.doc_id].encode()) + 1, zlib.crc32(text[r.doc_id].encode()))
    cell = {r.doc_id: r.c for r in docs.select("doc_id", F.pmod(F.xxhash64(F.lit(sharding.SEED), "text"), F.lit(cells)).alias("c")).collect()}
    route = {r.cell: r.route for r in sharding.ring(spark, 8, nodes, cells, sharding.SEED).collect()}
    assert all(sorted(x) == list(range(8)) for x in route.values())
    want = brute_shards([cell[r.doc_id] for r in rows], 8, cells, nodes, route)
    assert Counter((cell[r.doc_id], r.shard) for r in rows) == want


def test_a_further_shard_moves_few_rows(docs):
    one = {r.doc_id: r.shard for r in sharding.shard_documents(docs, 8, slack=0.5).collect()}
    two = {r.doc_id: r.shard for r in sharding.shard_documents(docs, 9, slack=0.5).collect()}
    assert np.mean([one[k] != two[k] for k in one]) < 0.35


def test_shards_of_odd_rows(odd, none):
    rows = sharding.shard_documents(odd, strands=2, cells=8, virtual_nodes=2).collect()
    assert len(rows) == odd.count() and max(Counter(r.shard for r in rows).values()) == 2
    assert {r.size for r in rows if r.doc_id in (4, 5)} == {1}
    assert sharding.shard_documents(none).count() == 0


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "task_pages": 3}])
def test_lists_meet_pages_alike_whatever_their_size(spark, limits):
    pages = [(i, f"h{i % 7}" if i % 3 else "hot", f"menu {i % 7 if i % 3 else 'hot'}\nown {i}\nfooter") for i in range(300)]
    pages += [(300 + i, None, f"none\nown {i}") for i in range(9)] + [(400, "hot", None)]
    df = spark.createDataFrame([(*p, 1, 2) for p in pages], "page_id long, host string, text string, tasks int, salt int")
    out = boilerplate.drop_boilerplate(df, F.col("host"), **limits)
    assert out.columns == df.columns
    assert {r.page_id: r.text for r in out.collect()} == {i: None if t is None else t.split("\n")[1] for i, _, t in pages}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert ("broadcast" in plan.lower()) == (not limits)


def test_lines_by_hand(spark):
    pages = [(i, "a", f"menu\nown {i}\n\nmenu ") for i in range(9)] + [(9, "a", "other"), (10, "b", "menu\nx"), (11, None, "menu")]
    pages += [(12, None, "menu"), (13, None, "menu\nkeep"), (14, None, None), (15, "c", "")]
    df = spark.createDataFrame([(*p, "q") for p in pages], "page_id long, host string, text string, lines string")
    out = boilerplate.drop_boilerplate(df, F.col("host"), counts_as="n")
    assert out.columns == [*df.columns, "n"]
    got = {r.page_id: (r.text, r.n.lines, r.n.dropped) for r in out.collect()}
    assert got[0] == ("own 0\n", 4, 2) and got[9] == ("other", 1, 0)
    assert got[10] == ("menu\nx", 2, 0)
    assert got[11] == ("", 1, 1) and got[13] == ("keep", 2, 1) and got[14] == (None, 0, 0) and got[15] == ("", 1, 0)


def test_lines_of_odd_rows(odd, none):
    out = boilerplate.drop_boilerplate(odd, odd["source"])
    assert out.columns == odd.columns and out.count() == odd.count()
    assert boilerplate.drop_boilerplate(none, none["source"]).count() == 0


def test_hosts(spark):
    urls = ["http://A.example.org/x?y", "ftp://h:80", "no address", None, "https:///p"]
    got = [r.h for r in spark.createDataFrame([(u,) for u in urls], "u string").select(boilerplate.url_host(F.col("u")).alias("h")).collect()]
    assert got == ["a.example.org", "h:80", None, None, None]


def test_line_dedup_takes_repeated_lines_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lines = lambda text: [x.strip(" \t\r") for x in text.split("\n")]
    given = {r.doc_id: r for r in docs.collect()}
    texts, holders = defaultdict(set), defaultdict(set)
    for r in given.values():
        texts[r.source].add(r.text)
        for x in lines(r.text):
            holders[r.source, x].add(r.text)
    common = {(s, x) for (s, x), held in holders.items() if x and len(held) >= 5 and len(held) > 0.05 * len(texts[s])}
    assert {s for s, _ in common} == set(texts) and len(common) < 2 * len(texts)
    gone = 0
    for r in corpus_pipeline.line_dedup(spark, docs, "").collect():
        want = [x for x in given[r.doc_id].text.split("\n") if (r.source, x.strip(" \t\r")) not in common]
        assert r.text == "\n".join(want) and r.n_chars == len(r.text)
        gone += r.text != given[r.doc_id].text
    assert gone > 500


def test_copies_of_a_text_are_one_page_and_few_texts_prove_nothing(spark):
    rows = [(i, "s", "copied line\nand another") for i in range(30)] + [(100 + i, "s", f"own {i}\nfooter") for i in range(6)]
    rows += [(200 + i, "small", f"mine {i}\nfooter") for i in range(4)] + [(300, "s", None)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, source string, text string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert got[0] == "copied line\nand another" and got[100] == "own 0" and got[200] == "mine 0\nfooter" and got[300] is None
