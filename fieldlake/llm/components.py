"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldlake.llm.common import saved
from fieldlake.session import shuffles_removed


def _stamp(edges: DataFrame) -> tuple:
    found = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"))
    with shuffles_removed(edges.sparkSession):
        return tuple(found.first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours are hung on the least of them; the hub's side of the join may be split.

    The hooks may repeat; a large star has one for each edge.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("hub"), "m")
    joined = both.join(least, both.a == least.hub)
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    hooks = [F.struct(F.col(c).alias("a"), F.col("m").alias("b")) for c in ("a", "b")]
    return joined.select(F.explode(F.array(*hooks)).alias("hook")).select("hook.*").where("a > b")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge, the component being its least node.

    Nodes are longs. Edges may repeat, point either way or be loops; an edge with a null is none.
    The hooks of a round are written to the shared folder, so a lost executor costs that round alone.
    """
    now = saved(edges.where("a is not null and b is not null").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a > b").distinct(), "links")
    stamp = _stamp(now)
    while stamp[0]:
        now = saved(_star(_star(now, large=True), large=False).distinct(), "stars")
        before, stamp = stamp, _stamp(now)
        if stamp == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
