import hashlib
import random

import corpus_pipeline
import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F, types as T
from fieldlake.llm import embeddings, minhash, simhash, spotsigs
from fieldlake.llm.components import components


def closure(ids, close):
    label = list(range(len(ids)))
    while True:
        now = [min([label[i], *[label[j] for j in range(len(ids)) if close(i, j)]]) for i in range(len(ids))]
        if now == label:
            return [min((ids[j] for j in range(len(ids)) if label[j] == x and ids[j] is not None), default=None) for x in label]
        label = now


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, x) for x in range(101, 130)] + [(7, 7), (None, 3), (200, 199)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(31)) and all(got[i] == 100 for i in range(100, 130)) and got[200] == 199
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    votes = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if votes[b] * 2 > len(grams))


def test_hash_is_spark_xxhash64(spark):
    text = "the Quick brown"
    row = spark.sql("select xxhash64('the quick brown') as h").first()
    assert row.h == simhash._signed(xxhash.xxh64_intdigest(b"the quick brown", 42))
    assert simhash.fingerprint(text) == row.h


@pytest.mark.parametrize("crowd", [simhash.CROWD, 1])
def test_simhash_of_odd_rows_and_small_table(spark, odd, docs, none, crowd):
    for table in (odd.where("text is null or length(text) < 100000"), docs):
        rows = [(r.doc_id, r.text or "") for r in table.select("doc_id", "text").collect()]
        fps = [brute_fingerprint(t) for _, t in rows]
        want = closure([d for d, _ in rows], lambda i, j, fps=fps: (fps[i] ^ fps[j]).bit_count() <= 2)
        found = simhash.simhash_components(table, crowd=crowd).collect()
        key = lambda x: tuple(str(y) for y in x)
        assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in found], key=key) == sorted(
            [(d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, want, strict=True)], key=key
        )
    assert simhash.simhash_components(none).count() == 0


@pytest.mark.parametrize("crowd", [simhash.CROWD, 2])
def test_close_fingerprints_lose_no_link(spark, crowd):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:20]:
        for _ in range(6):
            fps.add(f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = sorted(fps)
    want = closure(fps, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    rows = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    got = dict(components(simhash.close_links(rows, crowd=crowd)).collect())
    classes = lambda x: len(set(x))
    mine = [got.get(simhash._signed(f), simhash._signed(f)) for f in fps]
    assert classes(zip(mine, want, strict=True)) == classes(mine) == classes(want)


def rows_text(df, doc_id):
    return df.where(F.col("doc_id") == doc_id).first().text


def test_one_row_of_each_component_with_all_columns(odd):
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.text == rows_text(odd, 1)) == [1]
    assert len([r for r in rows if not (r.text or "").strip()]) == 1


def vectors(spark, rows, kind=T.FloatType()):
    schema = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(kind)), T.StructField("label", T.IntegerType()),
        T.StructField("v", T.StringType()), T.StructField("links", T.StringType()),
    ])
    return spark.createDataFrame([(*r, "a", "b") for r in rows], schema)


@pytest.mark.parametrize(("kind", "block"), [(T.FloatType(), 7), (T.FloatType(), 2_048), (T.DoubleType(), 7)])
def test_embeddings_against_all_pairs(spark, kind, block):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(90):
        near = np.float32(rng.normal(size=12)) if i % 3 == 0 else np.float32(base + rng.normal(size=12) * rng.choice([0.05, 0.12, 0.4]))
        base = near if i % 3 == 0 else base
        rows.append((i, [float(x) for x in near], int(rng.integers(0, 2)) if i % 3 == 0 else rows[-1][2]))
    rows += [(90, rows[0][1], rows[0][2]), (91, rows[0][1], rows[0][2]), (92, rows[0][1], None)]
    x = np.array([r[1] for r in rows])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = (unit @ unit.T >= 0.93) & np.array([[a[2] is not None and a[2] == b[2] for b in rows] for a in rows])
    np.fill_diagonal(linked, False)
    want = closure([r[0] for r in rows], lambda i, j: linked[i, j])
    got = {r.vec_id: r for r in embeddings.embedding_components(vectors(spark, rows, kind), block_rows=block).collect()}
    assert [got[i].n_links for i in range(93)] == linked.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(93)] == want
    assert all(got[i].kept == (want[i] == i) for i in range(93))
    assert linked.sum() > 50


def test_odd_vectors_link_with_nothing(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 1), (2, [2.0, 4.0, 6.0], 1), (3, None, 1), (4, [0.0, -0.0, 0.0], 1), (5, [1.0, None, 3.0], 1),
        (6, [1.0, float("nan"), 3.0], 1), (7, [float("inf"), 2.0, 3.0], 1), (8, [], 1), (9, one, None), (None, one, 1),
        (10, [1.0, 2.0], 1), (11, [3e38, 3e38, 3e38], 2), (12, [3e38, 3e38, 3.0e38], 2),
    ]
    got = {r.vec_id: r for r in embeddings.embedding_components(vectors(spark, rows)).collect()}
    assert [got[i].n_links for i in range(1, 13)] == [1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 1, 1]
    assert got[2].component_id == 1 and not got[2].kept and got[12].component_id == 11
    assert got[None].n_links == 0 and got[None].kept
    assert embeddings.embedding_components(vectors(spark, [])).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(0)
    u = embeddings.unit(rng.normal(size=(200, 40)) * rng.lognormal(size=(200, 40)))
    q, s, e = embeddings.quantise(u)
    rough = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None]
    assert (np.abs(rough - u @ u.T) <= e[:, None] + (1 + e[:, None]) * e[None] + 1e-12).all()


def test_spots_are_common_words_and_two_content_words(spark):
    df = spark.createDataFrame([("The quick of brown fox",), ("quick Brown",), ("",), ("of the",)], "t string")
    got = [r.s for r in spotsigs.with_spots(df, F.col("t"), "s").collect()]
    chain = lambda *w: spark.sql(f"select xxhash64({', '.join(map(repr, w))})").first()[0]
    pair = lambda a, b, c: spark.sql(f"select xxhash64('{a}', xxhash64('{b}', '{c}'))").first()[0]
    assert got[0] == sorted([pair("the", "quick", "brown"), pair("of", "brown", "fox")])
    assert got[1] == sorted([chain("quick", "brown"), chain("brown", "")])
    assert got[2] == []


def test_edits_against_python(odd, docs, none):
    for table in (docs, odd):
        rows = [(r.doc_id, r.text or "") for r in table.select("doc_id", "text").collect()]
        got = spotsigs.edited_likeness(table).collect()
        assert len(got) == len(rows)
        if table is docs:
            rows.sort()
            for (d, a), (_, b) in zip(rows, rows[1:] + rows[:1], strict=True):
                n, q = len(a), len(a) // 4
                row = next(r for r in got if r.doc_id == d)
                assert (row.n_chars, row.edited_sha256) == (n, hashlib.sha256((a[: n - q] + b[:q]).encode()).hexdigest())
            assert np.mean([r.near_edited > r.near_next for r in got]) > 0.95
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
        prints = {}
        for r in got:
            prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[1] == prints[2] and len(prints[9]) == 2
    assert spotsigs.edited_likeness(none).count() == 0


def test_similar_documents_against_all_pairs(docs):
    rows = spotsigs.fingerprints(docs).where(F.size("spots") > 0).collect()
    classes = {}
    for r in rows:
        classes[r.fingerprint] = (min(r.doc_id, classes.get(r.fingerprint, (r.doc_id,))[0]), set(r.spots))
    each = sorted(classes.values(), key=lambda x: x[0])
    want = {(a, b) for i, (a, x) in enumerate(each) for b, y in each[i + 1 :] if len(x & y) / len(x | y) >= 0.5}
    assert {(r.a, r.b) for r in spotsigs.similar_documents(docs, 0.5).collect()} == want and want


def brute_shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def edited(rows, seed=7):
    """Each text of 100 to 600 words again with one to six words replaced, under ids of their own."""
    rng, out = random.Random(seed), []
    for d, t in rows:
        words = t.split()
        if 100 <= len(words) <= 600:
            for n in (1, 2, 4, 6):
                changed = list(words)
                for at in rng.sample(range(len(words)), n):
                    changed[at] = f"new{rng.randrange(10**6)}"
                out.append((1_000_000 + len(out), " ".join(changed)))
    return out


def test_near_dedup_finds_every_pair_alike_by_four_fifths(spark, docs, odd, none):
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    odd_rows = [(None if r.doc_id is None else r.doc_id + 10_000, r.text) for r in odd.select("doc_id", "text").collect()]
    given = [r for r in given if len(r[1].split()) <= 600][:70]
    rows = given + edited(given) + [r for r in odd_rows if len(r[1] or "") < 100_000]
    sets = [brute_shingles(t or "") for _, t in rows]
    like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
    close = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets) if like(x, y) >= 0.8}
    # recall over pairs of different sets, that of SimHash within two bits beside it
    pairs = [(i, j) for i, j in close if i < j and sets[i] != sets[j]]
    keys = [set(minhash.band_keys(minhash.shingle_set(t or "")).tolist()) for _, t in rows]
    prints = [simhash.fingerprint(t or "") for _, t in rows]
    recall = np.mean([bool(keys[i] & keys[j]) for i, j in pairs])
    by_bits = np.mean([((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= 2 for i, j in pairs])
    print(f"pairs {len(pairs)}, recall {recall:.4f}, of SimHash {by_bits:.4f}")
    assert len(pairs) > 300 and recall > 0.999 and by_bits < 0.5
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    seen, want = set(), []
    for k in order:
        if k in seen:
            continue
        want.append(rows[k][0])
        queue = [k]
        while queue:
            x = queue.pop()
            if x not in seen:
                seen.add(x)
                queue += [j for j in range(len(rows)) if (x, j) in close]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r.doc_id for r in corpus_pipeline.near_dedup(spark, table, "").collect()]
    key = lambda x: (x is None, x or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert minhash.jaccard_components(none).count() == 0


def test_pairs_beside_the_head_of_a_band_are_verified(spark):
    """A chain whose ends are less alike than its neighbours hangs together whichever node is the head."""
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        for at in range(7 * i % 290, 7 * i % 290 + 6):
            words[at] = f"w{rng.randrange(10**6)}"
    rows += [(100 + i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(50))) for i in range(5)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.jaccard_components(table).collect()}
    assert all(got[i] == 0 for i in range(40)) and all(got[100 + i] == 100 + i for i in range(5))


def test_parities_differ_in_no_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(3)
    for n, changed in ((5, 1), (140, 20), (140, 60), (3_000, 400), (0, 0)):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[changed // 2 :], rng.integers(0, 1 << 63, changed - changed // 2).astype(np.uint64)]))
        bits = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in minhash.parity(a) ^ minhash.parity(b))
        assert bits <= np.setxor1d(a, b).size
        assert changed == 0 or changed > 100 or bits > 0.8 * changed


def test_a_crowd_of_copies_with_edits_against_all_pairs(spark):
    """Copies with one to six words replaced: some alike to few others only, most not to the first."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(130)]
    texts = []
    for _ in range(260):
        words = list(base)
        for at in rng.sample(range(130), rng.randint(1, 6)):
            words[at] = f"x{rng.randrange(40)}"
        texts.append(" ".join(words))
    sets = [set(minhash.shingle_set(t).tolist()) for t in texts]
    least = list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-12:
                a, b = sorted((root(i), root(j)))
                least[b] = a
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.jaccard_components(docs).collect()}
    assert got == {i: root(i) for i in range(len(texts))}


def model_spots(text):
    """Spots in plain Python, as tuples: an anchor and the next two content words, empty where there is none."""
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    common = set(spotsigs.COMMON_WORDS)
    if not any(w in common for w in words):
        return {(w, n) for w, n in zip(words, [*words[1:], ""], strict=False)}
    spots = set()
    for i, w in enumerate(words):
        if w in common:
            chain = [x for x in words[i + 1 :] if x not in common][:2]
            spots.add((w, *chain, *[""] * (2 - len(chain))))
    return spots


def model_likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_fingerprints_and_likeness_against_a_plain_model(request, which):
    table = request.getfixturevalue(which)
    keys = sorted({(r.doc_id is not None, r.doc_id or 0, r.h, r.t) for r in table.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()})
    want = {}
    for k, (has_id, doc_id, _, text) in enumerate(keys):
        after = keys[(k + 1) % len(keys)][3]
        lent = len(text) // 4
        edited = text[: len(text) - lent] + after[:lent]
        own, changed, following = model_spots(text), model_spots(edited), model_spots(after)
        want[doc_id if has_id else None, hashlib.sha256(edited.encode()).hexdigest()] = (
            len(text), len(own), len(changed), model_likeness(own, changed), model_likeness(own, following)
        )
    rows = spotsigs.edited_likeness(table).collect()
    size = lambda fingerprint: len(set(fingerprint.split("."))) if fingerprint else 0
    for r in rows:
        assert (r.n_chars, size(r.fingerprint), size(r.edited_fingerprint), r.near_edited, r.near_next) == want[r.doc_id, r.edited_sha256]
    assert {(r.doc_id, r.edited_sha256) for r in rows} == set(want) and len(rows) == table.count()
