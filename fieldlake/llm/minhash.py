"""Near-duplicates by the Jaccard index of word shingles: MinHash bands find pairs, the sets themselves verify them.

A pair alike by t shares a band with probability ``1 - (1 - t^4)^24``, 0.999997 at 0.8; SimHash within
two bits links few of such pairs. Texts with equal sets are one node. Of the pairs of a band first those
with its least node are verified, then, in bands not connected by that, those with the node of the most
common shingles, then, of nodes in bands still not connected, those whose rarest shingles leave room for
the overlap they need and whose parities do not differ by more than it allows. So neither a crowd of copies
nor one of texts less alike is compared pair by pair, and no pair that shares a band is left out.

Defined results: a null text is empty; texts without words are alike; words are those of ``simhash``, a
text of fewer words than a shingle is one shingle; repeats of a shingle count once; a component whose
documents all lack an id has a null component id; other columns are never read.

Pairs that another method found may be ``given``: they are verified before those of the bands, which then
are asked only for what is not yet connected.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from fieldlake.llm.common import one_of_each, saved, saved_alone, texts
from fieldlake.llm.components import components
from fieldlake.llm.seeds import mix64
from fieldlake.llm.simhash import close_texts

SEED = 42
SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS = 24
BAND_ROWS = 4
#: Bits of a set's parity, a multiple of 64.
PARITY = 512
#: Shingles whose hashes under all permutations are held at once.
SLICE = 2_048


def shingle_set(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the different word shingles of the text with A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_digest
    codes = np.frombuffer(b"".join([digest(w, SEED) for w in words]), ">u8").astype(np.uint64)
    size = min(size, len(codes))
    n = len(codes) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n])
    return np.unique(out)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = np.intersect1d(a, b, assume_unique=True).size
    either = a.size + b.size - both
    return both / either if either else 1.0


def band_keys(found: np.ndarray, bands: int = BANDS, band_rows: int = BAND_ROWS) -> np.ndarray:
    """One hash for each band of least hashes; an empty set has none."""
    if not found.size:
        return np.empty(0, np.int64)
    draws = np.random.default_rng(SEED).integers(0, 1 << 64, (2, bands * band_rows, 1), dtype=np.uint64)
    by, plus = draws[0] | np.uint64(1), draws[1]
    least = np.full(bands * band_rows, ~np.uint64(0))
    for at in range(0, found.size, SLICE):
        least = np.minimum(least, (found[None, at : at + SLICE] * by + plus).min(axis=1))
    keys = np.arange(bands, dtype=np.uint64)
    for column in least.reshape(bands, band_rows).T:
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def _signer(size: int, bands: int, band_rows: int):
    @F.pandas_udf("node long, bands array<long>")
    def sign(values: pd.Series) -> pd.DataFrame:
        out = []
        for text in values:
            found = shingle_set(text, size)
            node = np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64)
            out.append((int(node), band_keys(found, bands, band_rows)))
        return pd.DataFrame(out, columns=["node", "bands"])

    return sign


def _alike(size: int, threshold: float):
    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        held = lru_cache(maxsize=64)(lambda text: shingle_set(text, size))
        return pd.Series([jaccard(held(x), held(y)) >= threshold for x, y in zip(a, b, strict=True)], dtype=bool)

    return alike


def parity(found: np.ndarray) -> np.ndarray:
    """``PARITY`` bits, each telling whether an odd number of the set's hashes fall on it.

    Two sets differ in at least as many hashes as their parities differ in bits.
    """
    odd = np.bincount((found >> np.uint64(7)) % PARITY, minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lister(size: int):
    @F.pandas_udf("shingles array<long>, parity array<long>")
    def listed(values: pd.Series) -> pd.DataFrame:
        sets = [shingle_set(text, size) for text in values]
        return pd.DataFrame({
            "shingles": pd.Series([x.view(np.int64) for x in sets], dtype=object),
            "parity": pd.Series([parity(x) for x in sets], dtype=object),
        })

    return listed


def _possible(sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a, b`` of nodes of different classes, every one alike by ``threshold`` among them.

    ``sets`` holds ``node, node_class, shingles, parity``. Shingles in order of their number, rarest first:
    the first that both sets hold lies so far ahead in each that what follows it can still make up the
    overlap they need; and their parities differ in no more bits than the sets may in shingles.
    """
    listed = sets.select("node", "node_class", F.explode("shingles").alias("shingle"))
    times = listed.groupBy("shingle").agg(F.count("*").alias("times"))
    by = Window.partitionBy("node")
    ranked = listed.join(times, "shingle").withColumn("rank", F.row_number().over(by.orderBy("times", "shingle"))).withColumn(
        "n", F.count("*").over(by)
    ).where("times > 1")

    def ahead(share: float, node: str) -> DataFrame:
        near = ranked.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1)
        near = near.join(sets.select("node", "parity"), "node")
        return near.select("shingle", *[F.col(c).alias(f"{c}_{node}") for c in ("node", "node_class", "rank", "n", "parity")])

    both = 2 * threshold / (1 + threshold)
    rest = F.least(F.col("n_a") - F.col("rank_a"), F.col("n_b") - F.col("rank_b")) + 1
    differ = F.lit(0)
    for i in range(PARITY // 64):
        differ = differ + F.bit_count(F.get("parity_a", F.lit(i)).bitwiseXOR(F.get("parity_b", F.lit(i))))
    return ahead(both, "a").join(ahead(threshold, "b"), "shingle").where(
        "node_class_a <> node_class_b and (n_a < n_b or n_a = n_b and node_a < node_b)"
    ).where(F.col("n_a") >= F.col("n_b") * threshold - 1e-9).where(
        rest >= (F.col("n_a") + F.col("n_b")) * (both / 2) - 1e-9
    ).where(differ <= (F.col("n_a") + F.col("n_b")) * (1 - both) + 1e-9).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _classes(links: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of each node of ``links`` and the least node it is connected to: the same classes with fewer links."""
    return saved(components(links).select(F.col("node").alias("a"), F.col("component").alias("b")), "classes")


def _classed(nodes: DataFrame, classes: DataFrame, *names: str) -> DataFrame:
    """``nodes`` with the class of each column ``name`` as ``name_class``, by the pairs of ``_classes``."""
    for name in names:
        own = classes.select(F.col("a").alias(name), F.col("b").alias("held"))
        nodes = nodes.join(own, name, "left").withColumn(f"{name}_class", F.coalesce("held", name)).drop("held")
    return nodes


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    given: DataFrame | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, component_id, component``.

    ``component_id`` is the least id reachable by pairs alike by ``threshold``, ``component`` the least node.
    ``given`` holds pairs ``a, b`` of text hashes to verify beside those that share a band.
    """
    whole = texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    rows = saved(
        whole.withColumn("s", _signer(size, bands, band_rows)("text")).select("doc_id", "text_hash", "s.node", "s.bands"),
        "minhash",
    )
    members = rows.select("node", "bands").dropDuplicates(["node"]).select("node", F.explode("bands").alias("key"))
    heads = members.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    buckets = saved(members.join(heads.drop("n"), "key"), "bands")

    asked = buckets.select("node")
    if given is not None:
        named = rows.select("text_hash", "node").distinct()
        for end in ("a", "b"):
            given = given.join(named.select(F.col("text_hash").alias(end), F.col("node").alias(f"node_{end}")), end)
        given = given.where("node_a <> node_b").select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b"))
        given = saved(given.distinct(), "given")
        asked = asked.union(given.select("a")).union(given.select("b"))

    # one text for each node that shares a band or is in a given pair
    own = rows.groupBy("node").agg(F.min("text_hash").alias("text_hash"))
    wanted = own.join(asked.distinct(), "node", "left_semi")
    held = saved(whole.select("text_hash", "text").join(wanted, "text_hash").dropDuplicates(["node"]).select("node", "text"), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        one = held.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        other = held.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(one, "a").join(other, "b")
        return saved(both.where(_alike(size, threshold)("text_a", "text_b")).select("a", "b"), "alike")

    # each node with the least of its bands' heads, then with those heads it is not connected to
    tied = buckets.where("node <> head").select("node", "head").distinct()
    links = None if given is None else _classes(verified(given))
    if links is not None:
        tied = _classed(tied, links, "node", "head").where("node_class <> head_class").select("node", "head")
        tied = saved(tied, "heads")
    least = saved(tied.groupBy("node").agg(F.min("head").alias("head")), "heads")
    more = verified(least.select(F.col("node").alias("a"), F.col("head").alias("b")))
    links = _classes(more if links is None else links.unionByName(more))
    apart = _classed(tied.join(least, ["node", "head"], "left_anti"), links, "node", "head")
    links = _classes(links.unionByName(
        verified(apart.where("node_class <> head_class").select(F.col("node").alias("a"), F.col("head").alias("b")))
    ))
    # then nodes of bands that are not connected throughout, with that node of the band whose shingles are the
    # most common among them: of copies with edits the one with the fewest
    def torn() -> DataFrame:
        named = saved(_classed(buckets, links, "node"), "bands")
        parted = named.groupBy("key").agg(F.min("node_class").alias("low"), F.max("node_class").alias("high")).where("low <> high")
        return named.join(parted, "key").select("key", "node", "node_class")

    apart = saved(torn(), "apart")
    sets = saved(
        held.join(apart.select("node").distinct(), "node").select("node", _lister(size)("text").alias("s")).select("node", "s.*"),
        "shingles",
    )
    listed = sets.select("node", F.explode("shingles").alias("shingle"))
    times = listed.groupBy("shingle").agg(F.count("*").alias("times"))
    common = listed.join(times, "shingle").groupBy("node").agg(F.avg("times").alias("common"))
    centres = apart.join(common, "node").groupBy("key").agg(F.max(F.struct("common", "node", "node_class")).alias("centre"))
    pairs = apart.join(saved(centres, "centres"), "key").where("node_class <> centre.node_class")
    links = _classes(links.unionByName(
        verified(pairs.select(F.col("node").alias("a"), F.col("centre.node").alias("b")).distinct())
    ))
    # at last those of bands still not connected, among themselves
    apart = saved(torn().select("node", "node_class").distinct(), "apart")
    links = _classes(links.unionByName(verified(_possible(saved(sets.join(apart, "node"), "shingles"), threshold))))

    classed = _classed(rows.groupBy("node").agg(F.min("doc_id").alias("least")), links, "node").withColumnRenamed(
        "node_class", "component"
    )
    ids = classed.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.drop("bands").join(classed.join(ids, "component").drop("least"), "node").select(
        "doc_id", "text_hash", "component_id", "component"
    )


def drop_alike(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Of each component the document with the least id, as ``simhash.drop_near_duplicates`` keeps it."""
    rows = saved_alone(docs.sparkSession, lambda: jaccard_components(docs, id_col, text_col, size, threshold), "alike")
    return one_of_each(docs, rows, id_col, text_col)


def drop_near(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """As ``drop_alike``, the pairs that SimHash links verified first; bands then find pairs alike that it does not link."""

    def rows() -> DataFrame:
        close = close_texts(docs, id_col, text_col)
        return jaccard_components(docs, id_col, text_col, size, threshold, given=close)

    return one_of_each(docs, saved_alone(docs.sparkSession, rows, "near"), id_col, text_col)
