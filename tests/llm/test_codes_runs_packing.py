import hashlib
import math
import random
import zlib

import numpy as np
import oracle
import public_tokenizers
import pytest
from fieldlake.llm import codes, packing, queries, runs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

MODEL = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


# --- product codes ---


def lloyd(vectors, rounds=codes.ROUNDS, entries=codes.ENTRIES):
    """Plain rounds: every part against every entry."""
    q = np.array([[math.floor(1024 * x) for x in v] for v in vectors], np.int64).reshape(len(vectors), 4, -1)
    books = q[:entries].copy()
    for r in range(rounds + 1):
        far = ((q[:, None] - books[None]) ** 2).sum(3)
        code = far.argmin(1)
        if r < rounds:
            for e in range(len(books)):
                for p in range(4):
                    own = q[code[:, p] == e, p]
                    if len(own):
                        books[e, p] = own.sum(0) // len(own)
    error = np.take_along_axis(far, code[:, None], 1).sum((1, 2))
    return ["".join(f"{c:02x}" for c in row) for row in code], error.tolist(), books.transpose(1, 0, 2)


@pytest.mark.parametrize("spread", [1.0, 0.004])
def test_codes_equal_plain_rounds(spark, spread):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(700, 8)) * spread).astype(np.float32)  # the small spread makes ties
    vectors[40:60] = vectors[20:40]
    rows = [(i, v.tolist(), i % 3 or None) for i, v in enumerate(vectors)]
    trace = []
    out, books = codes.product_codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), trace=trace)
    code, error, want = lloyd(vectors.astype(float))
    assert (books == want).all()
    assert [(r.code, r.error) for r in out.orderBy("vec_id").collect()] == list(zip(code, error, strict=True))
    assert len(trace) == codes.ROUNDS - 1 and all(sum(seen.values()) == 2_800 for _, seen in trace)
    assert all(32 <= keep <= 64 for keep, _ in trace)


def test_bounds_hold_and_spare_work():
    rng = np.random.default_rng(9)
    x = rng.integers(-1000, 1000, (500, 16))
    book = x[:128].copy()
    near, bounds = codes.assign_anew(x, book, 32)
    for step in (3, 1, 0):
        after = book + rng.integers(-step, step + 1, book.shape)
        moved = np.sqrt(((after - book) ** 2).sum(1).astype(float))
        near, bounds, used = codes.assign_again(x, after, moved, near.astype(np.int64), bounds)
        book = after
        far = codes.all_distances(x, book)
        assert (near[:, 0] == far.argmin(1)).all()
        reach = np.sqrt(far.astype(float))
        assert (bounds[:, 0] >= reach[np.arange(500), near[:, 0]]).all()
        assert (bounds[:, 1:32] <= np.take_along_axis(reach, near[:, 1:].astype(np.int64), 1) + 1e-9).all()
        hidden = reach.copy()
        np.put_along_axis(hidden, near.astype(np.int64), np.inf, 1)
        assert (bounds[:, 32] <= hidden.min(1)).all()
    assert (used < 128).mean() > 0.9


def test_distances_beyond_doubles_are_exact():
    x = np.array([[(1 << 24) - 1, -(1 << 24) + 1] * 8], np.int64)
    assert codes.all_distances(x, -x)[0, 0] == 16 * (2 * ((1 << 24) - 1)) ** 2


def test_codes_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (3, [0.5, 1.0, -0.0005, 2.0], 1, "a"), (3, [0.5, 1.0, -0.0005, 2.0], 1, "b"), (None, [9.0, 9.0, 9.0, 9.0], None, "c"),
        (1, [0.0, 0.0, 0.0, 0.0], None, "d"), (2, None, 1, "e"), (4, [1.0, nan, 1.0, 1.0], 1, "f"), (5, [inf, 1.0, 1.0, 1.0], 2, "g"),
        (6, [None, 1.0, 1.0, 1.0], 2, "h"), (7, [], 2, "i"), (8, [1.0, 2.0], 2, "j"), (9, [1.0] * 8, 2, "k"),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, near string").withColumn("q", F.lit(1))
    out, books = codes.product_codes(table)
    got = sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error, r.label_error) for r in codes.with_label_error(out).collect())
    assert [g[:2] for g in got] == [(False, 1), (False, 3), (False, 3), (True, 0)]
    assert [g[2] for g in got] == ["00000000", "01010101", "01010101", "03030303"] and {g[3] for g in got} == {0}
    assert books.shape == (4, 4, 1) and books[2, 1, 0] == -1
    nothing, none = codes.product_codes(table.where("false"))
    assert nothing.count() == 0 and codes.books_sha256(none) == hashlib.sha256(b"").hexdigest()
    with pytest.raises(Exception, match="too large"):
        codes.product_codes(spark.createDataFrame([(1, [1e9] * 4, 1)], "vec_id long, embedding array<double>, label int"))


def test_product_codes_agree_with_sql(spark):
    df = queries.op11_product_codes(spark, SF)
    assert oracle.compare(df, oracle.connect(SF), queries.oracle_sql()["op11_product_codes"]) is None


# --- periodic runs ---


def brute_runs(words, least=12):
    found, x = {}, np.array([hash(w) for w in words])
    for q in range(1, len(x) // 2 + 1):
        same = np.concatenate([[0], x[q:] == x[:-q], [0]]).astype(int)
        for a, b in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1), strict=True):
            if b - a + q >= max(least, 2 * q):
                found.setdefault((int(a), int(b + q)), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def some_words(rng):
    n, mode = rng.randint(0, 300), rng.randrange(6)
    if mode < 2:
        return [rng.randrange(2 + mode) for _ in range(n)]
    if mode == 2:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if mode == 3:
        return ([0] * rng.randint(1, 40) + [1]) * rng.randint(1, 8)
    out = [rng.randrange(50) for _ in range(n)]
    if n:
        a = rng.randrange(n)
        p = rng.randint(1, n - a)
        out = [out[i] if i < a else out[a + (i - a) % p] for i in range(n)]
    return out


@pytest.mark.parametrize("least", [6, 12])
def test_runs_against_all_periods(least):
    rng = random.Random(least)
    for _ in range(120):
        texts = [runs._number(some_words(rng)) for _ in range(rng.randint(1, 5))]
        found = runs.find_runs(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]), least)
        got = [[] for _ in texts]
        for doc, *run in zip(*[c.tolist() for c in found], strict=True):
            got[doc].append(tuple(run))
        assert got == [brute_runs(t, least) for t in texts]


@pytest.mark.parametrize("prime", runs.PRIMES)
def test_transform_gives_the_correlation(prime):
    rng = np.random.default_rng(1)
    for size in (1, 2, 4, 16, 64):
        a = rng.integers(0, prime[0], (3, size))
        assert (runs.transform_back(runs.transform(a, *prime), *prime) == a).all()
    text = rng.integers(0, 3, 80)
    blocks, windows = np.stack([text[i : i + 8] for i in range(4)]), np.stack([text[i : i + 31] for i in range(4)])
    want = [[(w[d : d + 8] == b).all() for d in range(24)] for b, w in zip(blocks, windows, strict=True)]
    assert (runs.occurrences(blocks, windows, (prime,)) == want).all()


def test_large_numbers_take_both_primes():
    words = (np.arange(300) * 7_919_111) % (1 << 30)
    text = np.concatenate([words, words, words[:100]])
    assert [c.tolist() for c in runs.find_runs(text, np.array([700]))] == [[0], [0], [700], [300]]


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_odd_documents(spark, odd, none):
    rows = odd.select("doc_id", "text").collect()
    out = runs.periodic_runs(odd).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words)
    words = {i: (r.text or "").encode().split() for i, r in enumerate(rows)}
    want = sorted(
        (r.doc_id is None, r.doc_id or 0, len(words[i]), brute_runs(words[i]) if len(words[i]) < 5_000 else None) for i, r in enumerate(rows)
    )
    got = sorted((*key(r), [tuple(x) for x in r.runs] if r.n_words < 5_000 else None) for r in out)
    assert got == want
    long = next(r for r in out if r.doc_id == 7)
    assert [tuple(x) for x in long.runs] == [(0, 60_000, 1_954)] and len(long.collapsed.split()) == 1_954
    assert runs.periodic_runs(none).count() == 0


def test_query_of_runs_against_the_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    planted = 0
    for r in docs.collect():
        words = (r.text or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute_runs(words)
        out = got.pop(r.doc_id)
        planted += h % 10 == 0 and bool(found)
        best = min(((-length, start, q) for start, length, q in found), default=None)
        want = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        assert (out.n_runs, out.start, out["length"], out.period, out.exponent_milli) == (len(found), *want)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        assert out.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert out.collapsed_sha256 == hashlib.sha256(collapsed([w.decode() for w in words], found).encode()).hexdigest()
    assert not got and planted > 3


def test_planted_period_of_odd_documents(spark, odd, none):
    out = queries.planted_period(odd).collect()
    assert len(out) == odd.count() and queries.planted_period(none).count() == 0
    assert {r.doc_id: r.text for r in out if r.doc_id in (4, 5)} == {4: "", 5: ""}


# --- packing ---


def check_packing(rows, docs, capacity):
    """Every id in one piece, sequences without gaps or overflow; padding by sequence."""
    tokenizer = Tokenizer.from_file(MODEL)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    want = {}
    for r in docs:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault((r.doc_id, len(ids)), []).append(ids)
    assert set(by_doc) == set(want)
    for key, pieces in by_doc.items():
        spans = sorted((r.start, r["length"]) for r in pieces)
        times = len(want[key])
        assert sum(length for _, length in spans) == key[1] * times
        if times == 1:
            assert [a for a, _ in spans] == [0, *np.cumsum([b for _, b in spans])[:-1].tolist()]
            for r in pieces:
                assert bytes(r.ids) == want[key][0][r.start : r.start + r["length"]].tobytes()
    padded = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        ends = np.cumsum([r["length"] for r in pieces])
        assert [r.offset for r in pieces] == [0, *ends[:-1].tolist()] and ends[-1] <= capacity
        padded += 0 if ends[-1] & (ends[-1] - 1) == 0 else capacity - int(ends[-1])
    return padded / sum(r["length"] for r in rows)


def test_packing_of_documents(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert check_packing(packing.pack_documents(docs, MODEL).collect(), docs.collect(), 4096) < 0.002
    assert check_packing(packing.pack_documents(docs.repartition(5), MODEL, capacity=512, smallest=16).collect(), docs.collect(), 512) < 0.02
    check_packing(packing.pack_documents(odd, MODEL).collect(), odd.select("doc_id", "text").collect(), 4096)
    assert packing.pack_documents(none, MODEL).count() == 0


def test_sequences_are_filled_by_count():
    packer = packing.Packer(4096, 0)
    for i in range(1000):
        packer.add(packing.Piece((i, 60), 0, np.zeros(60, "<u4")))
    full = {}
    for doc, *_, sequence, _ in packer.closed:
        full.setdefault(sequence, []).append(doc)
    assert {len(x) for x in full.values()} == {68} and len(full) == 1000 // 68
    packer.finish()
    assert len(packer.open) == 0


def test_sizes_of_pieces():
    for n in (*range(1, 400), 4095, 4096, 4097, 20_000):
        sizes = packing.cut_sizes(n)
        assert sum(sizes) == n and all(s >= 64 and 4096 % s == 0 for s in sizes[:-1]) and len(sizes) <= n // 4096 + 7


def test_ids_are_those_of_the_library(monkeypatch):
    monkeypatch.setattr(packing, "STRETCHES_BYTES", 10)
    monkeypatch.setattr(packing, "KNOWN_BYTES", 200)
    with open(MODEL, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    rng = random.Random(0)
    alphabet = ["a", "B's ", "9", " ", "  ", "\u0301", "e\u0301", " \u0301", "漢", "\n", "x y", "'ll", "<|endoftext|>", "< |endoftext|>", "!?",
                "\u3000", "\x1c", "\x85", "\xa0", "Σ", "ΑΣ ", "İ", "\u0344", "\u0327", "ß", "\r\n", "\x0b", "가", "\u1100", "\u1161", "Ab", "É", "ſ", "ŉ", ".", ",", "-", "@", "`", "~", ";", "[", "İ"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1_500)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode(["", " "], 2)[1].tolist() == [2]
