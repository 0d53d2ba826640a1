import hashlib

import corpus_pipeline
import oracle
import public_tokenizers
import pytest
from fieldlake.llm import bpe, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    df = queries.queries()[name](spark, SF_DIR)
    assert oracle.compare(df, oracle.connect(SF_DIR), queries.oracle_sql()[name]) is None


def test_entry_offers_each_operator_once():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_stages_keep_columns_and_the_last_round_trips(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.dtypes == docs.dtypes, name
            docs = out
        rows, texts = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect(), docs.select("doc_id", "text").collect()
        want = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in texts)
        assert sorted(r.decoded_sha256 for r in rows) == want


def test_run_against_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
    codec = bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    want = sorted((r.doc_id, len(codec.base.encode_ordinary(r.text))) for r in docs.collect())
    assert sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF_DIR).collect()) == want
