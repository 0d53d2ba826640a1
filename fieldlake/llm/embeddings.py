"""Embedding near-duplicates: int8 tile products with an error bound for every vector.

A unit vector u is held as the int8 vector q and the scale s, with e = |u - s q| measured in double.
For two of them, |u.w - s_u s_w (q_u.q_w)| <= e_u + (1 + e_u) e_w. Pairs surely above the threshold
or surely below it need no more; only the others are computed again in double.

Defined results: vectors that are null, zero, empty, hold null or non-finite components, or have a
null label or a null id link with nothing; vectors are compared only within a label and a length;
equal vectors of a label are linked and counted without being compared; rows that share an id are
one node of the component; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from fieldlake.llm.common import saved
from fieldlake.llm.components import components

THRESHOLD = 0.93
#: Vectors of a block; a tile is two blocks.
BLOCK_ROWS = 2_048
STRIP_ROWS = 256
#: Above this length the int8 products of two vectors could leave the exact integers of a float32.
EXACT_FLOAT32 = (1 << 24) // (127 * 127)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double, first by their largest component so that nothing overflows."""
    big = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / big
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales and a bound on the length of what each lost."""
    scale = np.abs(units).max(axis=1) / 127
    q = np.rint(units / scale[:, None]).astype(np.int8)
    lost = units - q * scale[:, None]
    return q, scale, np.sqrt(np.einsum("ij,ij->i", lost, lost)) + 1e-12


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after joining i with j: the least label spreads until nothing changes."""
    while i.size:
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while not np.array_equal(label[label], label):
            label = label[label]
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    return label


def _tile(threshold: float, value_type: str):
    def links(frame: pd.DataFrame) -> pd.DataFrame:
        one = bool(frame["bi"].iloc[0] == frame["bj"].iloc[0])
        rows = frame.sort_values(["side", "rep"], kind="stable")
        n_left = int((rows["side"] == 0).sum())
        reps, weight = rows["rep"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        units = unit(np.stack([np.frombuffer(v, value_type) for v in rows["v"]]).astype(np.float64))
        q, scale, lost = quantise(units)
        q = q.astype(np.float32 if units.shape[1] <= EXACT_FLOAT32 else np.float64)
        first_right = 0 if one else n_left
        counts, label = np.zeros(len(rows), np.int64), np.arange(len(rows))
        right = slice(first_right, len(rows))
        for at in range(0, n_left, STRIP_ROWS):
            left = slice(at, min(at + STRIP_ROWS, n_left))
            rough = (q[left] @ q[right].T).astype(np.float64) * scale[left, None] * scale[None, right]
            slack = lost[left, None] + (1 + lost[left, None]) * lost[None, right]
            linked = rough - slack > threshold
            i, j = np.nonzero((rough + slack >= threshold) & ~linked)
            for k in range(0, i.size, 100_000):
                a, b = i[k : k + 100_000], j[k : k + 100_000]
                cosine = np.einsum("ij,ij->i", units[at + a], units[first_right + b])
                linked[a, b] = cosine >= threshold
            if one:  # each vector meets itself once, and both orders of a pair are seen
                linked[np.arange(left.stop - at), np.arange(at, left.stop)] = False
            counts[left] += linked @ weight[right]
            if not one:
                counts[right] += weight[left] @ linked
            i, j = np.nonzero(linked)
            label = _merge(label, i + at, j + first_right)
        hung = np.flatnonzero(label != np.arange(len(rows)))
        seen = np.flatnonzero(counts)
        return pd.DataFrame({
            "a": np.concatenate([reps[hung], reps[seen]]),
            "b": np.concatenate([reps[label[hung]], reps[seen]]),
            "label": np.concatenate([np.zeros(hung.size, np.int64), frame["label"].to_numpy()[[0] * seen.size]]),
            "v": np.concatenate([np.full(hung.size, None, object), rows["v"].to_numpy()[seen]]),
            "links": np.concatenate([np.zeros(hung.size, np.int64), counts[seen]]),
        })

    return links


def embedding_components(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and be at most 1")
    value_type = "<f4" if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else "<f8"
    kind = "float" if value_type == "<f4" else "double"

    @F.pandas_udf("binary")
    def packed(v: pd.Series) -> pd.Series:
        """The components as bytes, a zero without its sign."""
        return pd.Series([None if x is None else (np.asarray(x, value_type) + 0).tobytes() for x in v])

    whole = f"""embedding is not null and label is not null and vec_id is not null and size(embedding) > 0
        and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))
        and exists(embedding, x -> x <> 0)"""
    rows = vectors.select(
        vectors[id_col].cast("long").alias("vec_id"),
        vectors[label_col].cast("long").alias("label"),
        vectors[vector_col].cast(f"array<{kind}>").alias("embedding"),
    )
    rows = saved(rows.select("vec_id", "label", packed(F.when(F.expr(whole), F.col("embedding"))).alias("v")), "vectors")
    reps = saved(
        rows.where("v is not null").groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")),
        "vectors",
    )
    blocks = reps.groupBy("label", F.length("v").alias("dim")).agg(
        F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("blocks")
    )
    placed = reps.withColumn("dim", F.length("v")).join(blocks, ["label", "dim"]).withColumn(
        "own", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    )
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "dim", "rep", "n", "v",
        F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )
    found = saved(
        tiles.groupBy("label", "dim", "bi", "bj").applyInPandas(
            _tile(threshold, value_type), "a long, b long, label long, v binary, links long"
        ),
        "tiles",
    )
    linked = components(found.where("v is null").select("a", "b"))
    counts = found.where("v is not null").groupBy("label", "v").agg(F.sum("links").alias("links"))
    classed = reps.join(counts, ["label", "v"], "left").select(
        "label", "v", "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    classed = classed.join(linked, classed.rep == linked.node, "left").select(
        "label", "v", "n_links", F.coalesce("component", "rep").alias("component")
    )
    return rows.join(classed, ["label", "v"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
