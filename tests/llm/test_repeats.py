import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from fieldlake.llm import substring_dedup, suffix_dedup
from fieldlake.llm.runindex import RunIndex
from fieldlake.llm.seeds import chunks, segments


def longest_elsewhere(strings, k, i):
    best = 0
    for other, x in enumerate(strings):
        for j in range(len(x)):
            if (other, j) != (k, i):
                m = 0
                while i + m < len(strings[k]) and j + m < len(x) and strings[k][i + m] == x[j + m]:
                    m += 1
                best = max(best, m)
    return best


def test_run_index_against_all_pairs():
    rng = random.Random(0)
    for _ in range(120):
        strings = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 5))]
        strings += strings[:1] * rng.randint(0, 1)
        index = RunIndex(strings)
        for k, start in enumerate(index.starts):
            for i in range(len(strings[k])):
                assert index.matches[start + i] == longest_elsewhere(strings, k, i)


def test_repetitive_text_has_few_runs():
    rng = random.Random(1)
    text = bytes(rng.randrange(97, 123) for _ in range(500))
    assert RunIndex([text] * 20).runs < 3 * RunIndex([text]).runs


def test_segments_part_the_windows_and_equal_windows_share_a_key():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 1 << 60, n, dtype=np.uint64) for n in (50, 7, 90, 30)]
    texts[2][10:50] = texts[0][5:45]
    seen = {}
    for held in chunks([len(t) for t in texts], 12):
        codes = np.concatenate([texts[k][a:b] for k, a, b in held])
        ends = np.cumsum([b - a for _, a, b in held])
        first, last, anchor, key, _ = segments(codes, ends, 4, 12)
        starts = [s for a, b in zip(first, last, strict=True) for s in range(a, b + 1)]
        assert starts == sorted(set(starts))
        for a, b, p, h in zip(first, last, anchor, key, strict=True):
            for s in range(a, b + 1):
                assert s <= p <= s + 8
                seen.setdefault(codes[s : s + 12].tobytes(), set()).add((int(h), int(p - s)))
    assert len(seen) == 39 + 79 + 19 - 29 and all(len(x) == 1 for x in seen.values())


def brute_bytes(texts, length):
    counts = Counter(x[i : i + length] for x in texts for i in range(len(x) - length + 1))
    out = []
    for x in texts:
        gone = np.zeros(len(x) + 2, int)
        for i in range(len(x) - length + 1):
            if counts[x[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = 1
        left = bytes(b for b, g in zip(x, gone[1:], strict=False) if not g)
        out.append((len(x), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def found_bytes(df):
    rows = df.collect()
    return sorted(
        (r.n_bytes, r.n_removed, len(r.spans or []), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows
    )


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_BYTES, 1_000])
def test_bytes_against_brute_force(docs, hot):
    texts = [r.text.encode() for r in docs.select("text").collect()]
    assert found_bytes(suffix_dedup.remove_repeats(docs, hot_bytes=hot)) == brute_bytes(texts, 400)


def test_bytes_of_odd_rows(odd, none):
    texts = [(r.text or "").encode() for r in odd.select("text").collect() if len(r.text or "") < 100_000]
    short = odd.where("text is null or length(text) < 100000")
    assert found_bytes(suffix_dedup.remove_repeats(short, length=60)) == brute_bytes(texts, 60)
    assert suffix_dedup.remove_repeats(odd).count() == odd.count()
    assert suffix_dedup.remove_repeats(none).count() == 0


def brute_words(rows, length):
    first, out = {}, []
    rows = [(d, t, t.encode().split()) for d, t in rows]
    for d, t, w in rows:
        for i in range(len(w) - length + 1):
            at = (d is not None, d or 0, t if False else "", i)
            k = tuple(w[i : i + length])
            first[k] = min(first.get(k, at), at)
    for d, _, w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < (d is not None, d or 0, "", i):
                gone[i : i + length] = [True] * length
        left = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((-1 if d is None else d, len(w), sum(gone), left.decode()))
    return sorted(out)


@pytest.mark.parametrize("crowd", [substring_dedup.CROWD, 1])
def test_words_against_brute_force(docs, crowd):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = substring_dedup.remove_repeats(docs, crowd=crowd).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found) == brute_words(rows, 20)


def test_words_of_odd_rows(odd, none):
    rows = [(r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()]
    found = substring_dedup.remove_repeats(odd).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept) for r in found)
    assert got == brute_words(rows, 20)
    assert substring_dedup.remove_repeats(none).count() == 0


def test_long_texts_are_cut_between_words():
    raw = (" ".join(f"w{i}" for i in range(2_000))).encode()
    old, substring_dedup.STRETCH = substring_dedup.STRETCH, 64
    try:
        cut = substring_dedup.word_codes([raw, b"", b" a  b ", raw + b" z"])
    finally:
        substring_dedup.STRETCH = old
    whole = substring_dedup.word_codes([raw, b"", b" a  b ", raw + b" z"])
    assert [x.tolist() for x in cut] == [x.tolist() for x in whole]
    assert [len(x) for x in whole] == [2_000, 0, 2, 2_001]


def test_equal_windows_of_different_segments_never_fill_an_index(spark, monkeypatch):
    rng = random.Random(4)
    draw = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = draw(150)
    rows = [(i, draw(80) + passage + draw(80)) for i in range(40)] + [(50, draw(300))]
    plain, hot = suffix_dedup._indexer, 2_000

    def bounded(length):
        index = plain(length)

        def looked(frame):
            held = frame["data"].str.len().groupby(frame["group"]).sum()
            if len(held) and held.max() > hot:
                raise ValueError(f"{held.max()} bytes of one group in an index")
            return index(frame)

        return looked

    monkeypatch.setattr(suffix_dedup, "_indexer", bounded)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = found_bytes(suffix_dedup.remove_repeats(table, length=100, hot_bytes=hot))
    assert found == brute_bytes([t.encode() for _, t in rows], 100)
    assert sum(x[1] for x in found) >= 40 * 150
