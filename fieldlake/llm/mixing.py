"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source that is to give ``target`` of its ``source_size`` words is due
``target / source_size`` copies. The whole copies are certain; of the fractions, two meet at a time
and mass (words) moves from one to the other, in a random direction, until one is whole. The words
of a source and the expected copies of every document stay what they were. Chunks of a source settle
side by side and leave at most one fraction each; those meet level by level, up a tree, and the last
one of a source is rounded to the nearer number. What that rounding took too many or too few words is made
up by documents of the last chunk that were rounded, the largest that bring it nearer first, so a source of
few documents keeps its target as well. Rows that repeat id, text and source are counted and settle as one
item with their copies together, so a row repeated over and over is one row in its chunk.

Defined results: a null text has size 0; documents of size 0 and sources with target 0 carry no words
and take the whole part of their copies; a null source is a source of its own, last in order; rows
without an id count like any other; repeated rows are documents of their own; other columns are never
read. Random numbers come from the seed and the row, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from fieldlake.llm.common import saved, word_count

SEED = 20_241
CHUNK_ROWS = 4_000
FAN_IN = 64
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2.0
#: Repeated rows that one row is unfolded into, or ranked, at a time.
BLOCK_ROWS = 10_000


def target_words(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all words;
    none gets over ``most`` times its own, and what it leaves is shared by the others. One task sorts
    the sources by the share at which they are full; they are as many as weights must be given for.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    full = Window.orderBy("full_at", "place")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    onward = full.rowsBetween(0, Window.unboundedFollowing)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    placed = sizes.withColumn("place", F.row_number().over(ordered) - 1).withColumn(
        "weight", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("full_at", F.col("cap") / F.col("weight"))
    rated = placed.withColumn(
        "rate",
        (F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(onward),
    )
    rate = F.max(F.when(F.col("full_at") >= F.col("rate"), F.col("rate"))).over(every)
    return rated.withColumn("final", rate).select(
        "source", "source_size",
        F.coalesce(F.least("cap", F.col("final") * F.col("weight")), F.col("cap")).cast("double").alias("target"),
    )


def settle(size: np.ndarray, due: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Fractions ``due`` after each met the next one in order; at most one is left between 0 and 1."""
    due = due.copy()
    held = -1
    for j in range(len(size)):
        if not 0.0 < due[j] < 1.0:
            continue
        if held < 0:
            held = j
            continue
        si, sj, pi, pj = size[held], size[j], due[held], due[j]
        up_i, down_j = (1 - pi) * si, pj * sj
        down_i, up_j = pi * si, (1 - pj) * sj
        up, down = min(up_i, down_j), min(down_i, up_j)
        if chance[j] * (up + down) < down:  # the held one gains
            due[held] = 1.0 if up_i <= down_j else pi + up / si
            due[j] = 0.0 if down_j <= up_i else pj - up / sj
        else:
            due[held] = 0.0 if down_i <= up_j else pi - down / si
            due[j] = 1.0 if up_j <= down_i else pj + down / sj
        open_ = [k for k in (held, j) if 1e-12 < due[k] < 1 - 1e-12]
        for k in (held, j):
            if k not in open_:
                due[k] = float(round(due[k]))
        held = open_[0] if open_ else -1
    return due


def made_up(size: np.ndarray, due: np.ndarray, final: np.ndarray) -> np.ndarray:
    """``final`` with some of its roundings of ``due`` turned over, so that the words taken come near those due."""
    final = final.copy()
    over = float((size * (final - due)).sum())
    for j in np.argsort(-size, kind="stable"):
        if not 0.0 < due[j] < 1.0:
            continue
        turned = over + (size[j] if final[j] == 0 else -size[j])
        if abs(turned) < abs(over):
            final[j], over = 1.0 - final[j], turned
    return final


def _settle_group(last: bool):
    def settled(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "mark"], ascending=[False, True], kind="stable")
        size, due, chance = (frame[c].to_numpy(np.float64) for c in ("size", "due", "chance"))
        final = settle(size, due, chance)
        return frame.assign(due=made_up(size, due, np.rint(final)) if last else final)

    return settled


def mix(
    docs: DataFrame,
    targets: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
    chunk_rows: int = CHUNK_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document: ``doc_id, source, mark, size, source_size, target, copies, taken``.

    ``targets`` holds ``source, target`` in words; without it they come from ``target_words``. ``mark``
    is a hash of id and text by which the copies can be brought to the documents.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = saved(
        docs.select(
            docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
            F.xxhash64(docs[id_col], text).alias("mark"), word_count(text).alias("size"),
        ),
        "mix",
    )
    items = rows.groupBy("doc_id", "source", "mark", "size").agg(F.count("*").alias("rows"))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    if targets is None:
        targets = target_words(sources.select("source", "source_size"))
    aims = targets.select(F.col("source").alias("aimed"), F.col("target").cast("double").alias("target"))
    aims = saved(
        sources.join(aims, sources.source.eqNullSafe(aims.aimed), "left").select(
            F.col("source").alias("aimed"), "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
            F.ceil(F.col("docs") / F.lit(chunk_rows)).cast("long").alias("chunks"),
        ),
        "mix",
    )
    unit = F.pmod(F.xxhash64(F.lit(seed), "mark", "size"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    per_doc = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    all_due = per_doc * F.col("rows")
    now = items.join(aims, items.source.eqNullSafe(aims.aimed)).select(
        "doc_id", "source", "mark", "size", "rows", "source_size", "target",
        F.when(F.col("size") > 0, F.floor(all_due)).otherwise(F.floor(per_doc) * F.col("rows")).cast("long").alias("whole"),
        F.when(F.col("size") > 0, all_due - F.floor(all_due)).otherwise(0.0).alias("due"),
        unit.alias("chance"), F.pmod("mark", "chunks").alias("chunk"),
    )
    chunks = aims.agg(F.max("chunks")).first()[0] or 1
    settled = []
    while True:
        last = chunks == 1
        now = saved(
            now.groupBy("source", "chunk").applyInPandas(_settle_group(last), now.schema),
            "mix",
        )
        if last:
            settled.append(now)
            break
        left = (F.col("due") > 0) & (F.col("due") < 1)
        settled.append(now.where(~left))
        chunks = -(-chunks // fan_in)
        now = now.where(left).withColumn("chunk", F.floor(F.col("chunk") / F.lit(fan_in)).cast("long"))
    done = settled[0]
    for more in settled[1:]:
        done = done.unionByName(more)
    total = F.col("whole") + F.col("due").cast("long")
    named = ("doc_id", "source", "mark", "size", "source_size", "target")
    blocks = done.select(
        *named, "rows", total.alias("all"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(BLOCK_ROWS).cast("long"))).alias("at"),
    ).repartition("mark", "at")
    until = F.least("rows", F.col("at") + BLOCK_ROWS) - 1
    each = blocks.select(*named, "rows", "all", F.explode(F.sequence("at", until)).alias("turn"))
    copies = F.floor((F.col("all") + F.col("rows") - 1 - F.col("turn")) / F.col("rows")).cast("long").alias("copies")
    return each.select(*named, copies).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(
    docs: DataFrame, targets: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", seed: int = SEED,
) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns."""
    rows = mix(docs, targets, id_col, text_col, source_col, seed)
    aims = rows.groupBy("doc_id", "mark", "source").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).select(
        F.col("doc_id").alias("aim_id"), F.col("mark").alias("aim_mark"), F.col("source").alias("aim_source"), "copies", "rows"
    ).where("copies > 0")
    whole = docs.select(
        F.struct("*").alias("row"), docs[id_col].alias("id"), docs[source_col].alias("from"),
        F.xxhash64(docs[id_col], F.coalesce(docs[text_col], F.lit(""))).alias("mark"),
        F.monotonically_increasing_id().alias("place"),
    )
    same = (
        whole["id"].eqNullSafe(aims.aim_id) & (whole.mark == aims.aim_mark) & whole["from"].eqNullSafe(aims.aim_source)
    )
    # rows that repeat an id, text and source share their copies evenly; very many do so in strands
    strands = F.ceil(F.col("rows") / BLOCK_ROWS)
    dealt = whole.join(aims, same).withColumn("strand", F.pmod(F.xxhash64("place"), strands))
    strand = Window.partitionBy("id", "mark", "from", "strand")
    ranked = dealt.withColumn("turn", F.row_number().over(strand.orderBy("place"))).withColumn("held", F.count("*").over(strand))
    each = F.floor(F.col("copies") / F.col("rows"))
    more = F.round(F.pmod("copies", "rows") * F.col("held") / F.col("rows"))
    own = (each + F.when(F.col("turn") <= more, 1).otherwise(0)).cast("int")
    taken = ranked.withColumn("own", own).where("own > 0").select("row", F.explode(F.sequence(F.lit(1), "own")).alias("copy"))
    return taken.select("row.*")
