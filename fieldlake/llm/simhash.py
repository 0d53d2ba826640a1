"""SimHash near-duplicates: pigeonhole blocks find close fingerprints, Hamming distance verifies them.

Defined results: a null text is empty; an empty text has fingerprint zero and is linked like any
other; repeated rows and rows with equal texts have equal fingerprints and one component; a component
whose documents all lack an id has a null component id; other columns are never read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from fieldlake.llm.common import one_of_each, parts_for, row_wise, saved, texts
from fieldlake.llm.components import components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
#: Four blocks of 16 bits; two or fewer differing bits leave two blocks equal.
BLOCKS = 4
#: Fingerprints that share a key and are compared with each other in one task; beyond it ``_crowded`` links them.
CROWD = 16_384
ROWS_PER_PART = 100_000


def shingles(text: str, size: int = SHINGLE_WORDS) -> list[bytes]:
    """Word shingles, repeats included, of the text with A-Z lower-cased; fewer words are one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    if len(words) <= size:
        return [b" ".join(words)]
    return [b" ".join(x) for x in zip(*[words[i:] for i in range(size)], strict=False)]


def fingerprint(text: str, size: int = SHINGLE_WORDS) -> int:
    """The 64 majority bits of the shingles' XXH64 as a signed long."""
    found = shingles(text, size)
    if not found:
        return 0
    digest, ones = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(found), 65_536):
        raw = b"".join([digest(x, SEED) for x in found[at : at + 65_536]])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(found)).tobytes(), "big", signed=True)


def block_masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> list[int]:
    """For each choice of ``blocks - max_bits`` blocks, their bits; a close pair agrees on one choice."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    each = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(each, blocks - max_bits)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _run_links(fps: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A spanning forest of the close pairs: each fingerprint is compared with those not reached yet."""
    heads, tails = [], []
    left = np.arange(len(fps))
    while left.size:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            x = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[x]) <= max_bits
            if near.any():
                found, left = left[near], left[~near]
                heads.append(np.full(found.size, fps[x]))
                tails.append(fps[found])
                queue.extend(found.tolist())
    return heads, tails


def _forest(max_bits: int):
    def links(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["choice", "key"], kind="stable")
        fps = frame["fp"].to_numpy(np.int64).view(np.uint64)
        choice, key = frame["choice"].to_numpy(), frame["key"].to_numpy()
        new = np.ones(len(fps), dtype=bool)
        new[1:] = (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(fps)))
        heads, tails = [], []
        for start, size in zip(starts[sizes > 1], sizes[sizes > 1], strict=True):
            h, t = _run_links(fps[start : start + size], max_bits)
            heads += h
            tails += t
        join = lambda x: np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64)
        return pd.DataFrame({"a": join(heads), "b": join(tails)})

    return links


def _crowded(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Links among fingerprints of a crowded key without comparing pairs.

    Two fingerprints at most two bits apart are equal once the right two of the key's free bits are
    blanked, and no more than four fingerprints are equal under one such blanking.
    """
    choices = []
    for i, mask in enumerate(masks):
        free = [b for b in range(64) if not mask >> b & 1]
        blanks = [_signed(~((1 << x) | (1 << y)) & ((1 << 64) - 1)) for x, y in combinations(free, 2)]
        choices.append(rows.where(F.col("choice") == i).select("fp", F.explode(F.array(*map(F.lit, blanks))).alias("blank")))
    every = choices[0]
    for more in choices[1:]:
        every = every.unionByName(more)
    groups = every.groupBy("blank", F.col("fp").bitwiseAND(F.col("blank")).alias("rest")).agg(
        F.collect_set("fp").alias("fps")
    ).where(F.size("fps") > 1)
    return groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")


def close_links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, crowd: int = CROWD) -> DataFrame:
    """Edges ``a, b`` that connect all fingerprints (distinct, column ``fp``) at most ``max_bits`` apart."""
    if max_bits != 2:
        raise ValueError("crowded keys are split by blanking two bits")
    masks = block_masks(blocks, max_bits)
    keyed = fps.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for i, m in enumerate(masks)
        ])).alias("k"),
    ).select("fp", "k.choice", "k.key")
    counts = saved(keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1"), "blocks")
    total = counts.agg(
        F.sum(F.when(F.col("n") <= crowd, F.col("n"))).alias("few"), F.max("n").alias("most")
    ).first()
    rows = keyed.join(counts, ["choice", "key"])
    parts = parts_for(total["few"] or 0, ROWS_PER_PART)
    links = (
        rows.where(F.col("n") <= crowd)
        .groupBy(F.pmod(F.xxhash64("choice", "key"), F.lit(parts)).alias("part"))
        .applyInPandas(_forest(max_bits), "a long, b long")
    )
    if (total["most"] or 0) > crowd:
        links = links.unionByName(_crowded(rows.where(F.col("n") > crowd), masks))
    return links


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id, text_hash, component``.

    ``component_id`` is the least id reachable by close links, ``component`` the least fingerprint.
    """
    rows = saved(
        texts(docs, id_col, text_col).select(
            "doc_id", row_wise(fingerprint, "long")("text").alias("fp"), F.xxhash64("text").alias("text_hash")
        ),
        "simhash",
    )
    fps = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash")
    found = components(close_links(fps, crowd=crowd)).withColumnRenamed("node", "fp")
    classed = fps.join(found, "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    ids = classed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classed.join(ids, "component").select("fp", "component", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash", "component"
    )


def close_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """Pairs ``a, b`` of text hashes that connect all texts whose fingerprints are linked, as ``simhash_components`` links them."""
    each = texts(docs, id_col, text_col).select(
        F.xxhash64("text").alias("text_hash"), row_wise(fingerprint, "long")("text").alias("fp")
    )
    rows = saved(each.distinct(), "simhash")
    heads = saved(rows.groupBy("fp").agg(F.min("text_hash").alias("head")), "simhash")
    equal = rows.join(heads, "fp").where("text_hash <> head").select(F.col("text_hash").alias("a"), F.col("head").alias("b"))
    near = close_links(heads.select("fp"), crowd=crowd)
    for end in ("a", "b"):
        near = near.join(heads.select(F.col("fp").alias(end), F.col("head").alias(f"head_{end}")), end)
    return equal.unionByName(near.select(F.col("head_a").alias("a"), F.col("head_b").alias("b")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the document with the least id, ties by text; all columns pass through.

    Rows without an id go before none that has one. Of rows that repeat an id and text one stays.
    """
    return one_of_each(docs, simhash_components(docs, id_col, text_col), id_col, text_col)
