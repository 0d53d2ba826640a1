import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from fieldlake.llm import bpe, quality

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH), PATTERN)


def test_tree_gives_the_ids_of_the_whole(codec):
    rng = random.Random(2)
    alphabet = "ab'sre  \n\t\r é漢1 9!😀​\x1c　 \x85"
    for _ in range(800):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        want = codec.base.encode_ordinary(text)
        assert all(codec.encode(text, leaf).tolist() == want for leaf in (1, 2, 5, 13))
        assert codec.decode(np.array(want, "<u4")) == text.encode()


def test_joining_is_associative(codec):
    rng = random.Random(4)
    for _ in range(200):
        a, b, c = ("".join(rng.choice("ab '\n") for _ in range(rng.randint(0, 8))) for _ in range(3))
        p, q, r = (codec.piece(x) for x in (a, b, c))
        want = codec.base.encode_ordinary(a + b + c)
        assert codec.finish(codec.join(codec.join(p, q), r)).tolist() == want
        assert codec.finish(codec.join(p, codec.join(q, r))).tolist() == want


@pytest.mark.parametrize("chunk", [bpe.CHUNK_CHARS, 40])
def test_documents_round_trip(codec, odd, docs, none, chunk):
    for table in (docs, odd.where("text is null or length(text) < 20000") if chunk < 100 else odd):
        rows = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in table.collect()))
        out = bpe.encode_documents(table, PATH, PATTERN, chunk_chars=chunk, fan_in=3, outputs=bpe.OUTPUTS).collect()
        got = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.decoded).decode(), bytes(r.ids), r.n_tokens) for r in out)
        for r in out:
            assert r.ids_sha256 == hashlib.sha256(r.ids).hexdigest() and r.decoded_sha256 == hashlib.sha256(r.decoded).hexdigest()
        assert [x[:3] for x in got] == rows
        for *_, text, ids, n in got:
            assert np.frombuffer(ids, "<u4").tolist() == codec.base.encode_ordinary(text) and n == len(ids) // 4
    assert bpe.encode_documents(none, PATH, PATTERN).count() == 0
    again = bpe.decode_documents(bpe.encode_documents(odd, PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in again) == sorted((r.text or '').encode() for r in odd.collect())


def test_one_python_call_a_text(docs):
    plan = bpe.encode_documents(docs, PATH, PATTERN, outputs=bpe.OUTPUTS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "ArrowEvalPython" not in plan  # short texts, and the roots of long ones


def test_a_text_without_blanks_is_cut_too(codec):
    text = "漢字，かな。" * 3_000 + "abc,def;" * 2_000
    piece = codec.piece(text)
    assert len(piece.head) < 10 and len(piece.tail) < 10
    assert codec.finish(piece).tolist() == codec.base.encode_ordinary(text)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.score_documents(docs, labels)
    rows = scored.where("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.97
    for r in scored.limit(20).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3)


def test_held_out_labels_are_not_learned_from(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    other = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, other)
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_scores_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, None), (8, 0), (9, 7), (None, 1), (77, 0)], "doc_id long, quality int")
    rows = quality.score_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5)}) == 1
    nothing = quality.score_documents(odd, labels.where("false")).collect()
    assert {r.score for r in nothing} == {0.5}
    assert quality.score_documents(none, labels).count() == 0


def test_stretches_do_not_change_features():
    text = "some words and more words é漢 " * 40
    whole = np.sort(quality.features(text))
    old, quality.STRETCH = quality.STRETCH, 64
    try:
        cut = quality.features(text)
    finally:
        quality.STRETCH = old
    assert set(whole.tolist()) == set(cut.tolist())
