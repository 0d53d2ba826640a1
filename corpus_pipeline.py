"""A corpus made ready for training: STAGES over ``documents``, each one operator of ``fieldlake.llm``.

Every stage works on all documents its predecessor kept. A null text is empty, or stays null where a
stage does not change it; rows without an id, repeated rows and further columns pass through as the
operators say. Words and tokens are counted on what each stage gets.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldlake.llm.boilerplate import drop_boilerplate
from fieldlake.llm.bpe import encode_documents
from fieldlake.llm.common import saved, table
from fieldlake.llm.minhash import drop_near
from fieldlake.llm.mixing import mixed_documents
from fieldlake.llm.quality import ACCEPT, score_column, train

RANKS = "byte_bpe_50k.tiktoken"
#: A line that more than this share of a source's different texts hold is boilerplate, if so many texts do.
#: In sf0.1 the line that every source repeats is on 8.6 to 13.2 % of them, any other line on under 4.7 %.
LINE_RATIO = 0.05
LINE_TEXTS = 5
#: Words of a shingle, and the Jaccard index from which two documents are near-duplicates.
NEAR_WORDS = 5
NEAR_JACCARD = 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of this stage's own documents."""
    score = score_column(spark, train(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(docs["text"]) >= ACCEPT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, a document's source being its site and copies of a text one page; ``n_chars`` follows the text."""
    clean = drop_boilerplate(docs, docs["source"], max_ratio=LINE_RATIO, min_count=LINE_TEXTS, copies=False)
    n_chars = F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: pairs that SimHash links, as ``op8`` does, or that share a band
    of least hashes, verified as 5-word shingles with a Jaccard index of 0.8 or more."""
    return drop_near(docs, size=NEAR_WORDS, threshold=NEAR_JACCARD)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and proof that they decode to its text."""
    return encode_documents(
        docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, outputs=("ids_sha256", "decoded_sha256")
    )


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: SQL can express neither the training nor the random rounding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
