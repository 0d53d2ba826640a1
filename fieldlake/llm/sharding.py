"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into cells. A shard owns the cells before its virtual nodes; a text belongs to the
cell of its hash, so equal texts meet. A shard takes the rows of its cells in ring order until it is
full; rows beyond go on clockwise to the next shard that has room. All of this is decided on counts
per cell, of which there are as many as the ring has, whatever the rows; a row finds its place by its
rank within its cell. A cell is ranked in strands, dealt by id, so that a third of all rows in one
cell is still split.

Defined results: a null text has size 1 and the hash of the empty text; rows without an id and
repeated rows are rows like any other; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fieldlake.llm.common import saved

SHARDS = 8
VIRTUAL_NODES = 128
CELLS = 4_096
STRANDS = 256
SEED = 11


def ring(spark, shards: int, virtual_nodes: int, cells: int, seed: int) -> DataFrame:
    """``cell, route``: for each cell the shards in the order their virtual nodes come, clockwise."""
    nodes = spark.range(shards * virtual_nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.floor(F.col("id") / shards).alias("replica"),
    ).select(  # from the shard and its own count alone, so that a further shard leaves the others' nodes in place
        "shard", F.pmod(F.xxhash64(F.lit(seed), "shard", "replica"), F.lit(cells)).cast("int").alias("cell")
    ).distinct().withColumn("node", F.col("cell"))
    grid = spark.range(shards * cells).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).cast("int").alias("cell")
    )
    ahead = Window.partitionBy("shard").orderBy("cell").rowsBetween(0, Window.unboundedFollowing)
    steps = grid.join(nodes, ["shard", "cell"], "left").withColumn(
        "steps",
        F.coalesce(
            F.first("node", ignorenulls=True).over(ahead),
            F.min("node").over(Window.partitionBy("shard")) + cells,
        ) - F.col("cell"),
    )
    step = F.struct("steps", F.xxhash64("cell", "shard").alias("tie"), "shard")
    return steps.groupBy("cell").agg(F.sort_array(F.collect_list(step)).alias("r")).select(
        "cell", F.col("r.shard").alias("route")
    )


def placements(counts: DataFrame, route: DataFrame, capacity: DataFrame, shards: int) -> DataFrame:
    """``cell, pieces``: which ranks of a cell go to which shard, and to which slots there.

    ``counts`` holds ``cell, n``, ``capacity`` holds ``shard, room``. In round r the rows without a
    place come to the r-th shard of their cell's route. A row that all shards refused would mean that
    all are full, so as many rounds as shards are enough when the room is.
    """
    now = saved(
        counts.join(route, "cell").select(
            "cell", "route", F.col("n").alias("left"), F.array().cast("array<struct<shard:int,n:bigint>>").alias("taken")
        ),
        "ring",
    )
    room, turn = capacity, 0
    while not now.where("left > 0").isEmpty():
        turn += 1
        if turn > shards:
            raise ValueError("the shards have less room than there are rows")
        order = Window.partitionBy("shard").orderBy("cell")
        asked = now.withColumn("shard", F.element_at("route", turn)).join(room, "shard")
        given = F.least("left", F.greatest(F.lit(0), F.col("room") - (F.sum("left").over(order) - F.col("left"))))
        now = saved(
            asked.withColumn("given", given).select(
                "cell", "route", (F.col("left") - F.col("given")).alias("left"),
                F.when(F.col("given") > 0, F.concat("taken", F.array(F.struct("shard", F.col("given").alias("n")))))
                .otherwise(F.col("taken")).alias("taken"),
            ),
            "ring",
        )
        used = now.select(F.explode("taken").alias("t")).groupBy("t.shard").agg(F.sum("t.n").alias("used"))
        room = capacity.join(used, "shard", "left").select(
            "shard", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room")
        )
    pieces = now.select("cell", F.posexplode("taken").alias("turn", "t")).select("cell", "turn", "t.shard", "t.n")
    within = Window.partitionBy("cell").orderBy("turn")
    along = Window.partitionBy("shard").orderBy("cell", "turn")
    placed = pieces.select(
        "cell",
        F.struct(
            (F.sum("n").over(within) - F.col("n")).alias("first"), F.sum("n").over(within).alias("end"), "shard",
            (F.sum("n").over(along) - F.col("n")).alias("slot"),
        ).alias("piece"),
    )
    return placed.groupBy("cell").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    slack: float = 0.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    virtual_nodes: int = VIRTUAL_NODES,
    cells: int = CELLS,
    strands: int = STRANDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot, home_shard``.

    No shard holds over ``1 + slack`` times its even share. With ``slack`` 0 the counts of two shards
    differ by one at most; the more slack, the fewer rows move when a shard is added.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = saved(
        docs.select(
            docs[id_col].alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(F.lit(seed), text).alias("place"),
        )
        .withColumn("cell", F.pmod("place", F.lit(cells)).cast("int"))
        .withColumn("strand", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(strands)).cast("int")),
        "shards",
    )
    by_strand = saved(rows.groupBy("cell", "strand").agg(F.count("*").alias("n")), "shards")
    total = by_strand.agg(F.sum("n")).first()[0] or 0
    even, over = divmod(total, shards)
    bound = -(-total * (1 + slack) // shards) if slack else None
    capacity = spark.range(shards).select(
        F.col("id").cast("int").alias("shard"),
        F.lit(int(bound)).cast("long").alias("room") if slack
        else (F.lit(even) + (F.col("id") < over).cast("long")).alias("room"),
    )
    route = saved(ring(spark, shards, virtual_nodes, cells, seed), "ring")
    placed = placements(by_strand.groupBy("cell").agg(F.sum("n").alias("n")), route, capacity, shards)
    earlier = Window.partitionBy("cell").orderBy("strand")
    strands_at = by_strand.withColumn("before", F.sum("n").over(earlier) - F.col("n")).drop("n")
    guide = saved(
        strands_at.join(placed, "cell").join(route.select("cell", F.element_at("route", 1).alias("home_shard")), "cell"),
        "shards",
    )
    rank = F.row_number().over(
        Window.partitionBy("cell", "strand").orderBy("place", "doc_id", "size", "text_crc32")
    )
    ranked = rows.withColumn("rank", rank - 1).join(guide, ["cell", "strand"])
    at = F.col("before") + F.col("rank")
    ranked = ranked.withColumn("at", at).withColumn(
        "piece", F.expr("element_at(filter(pieces, p -> p.first <= at and at < p.end), 1)")
    )
    return ranked.select(
        "doc_id", "size", "text_crc32", F.col("piece.shard").alias("shard"),
        (F.col("piece.slot") + F.col("at") - F.col("piece.first")).alias("slot"), "home_shard",
    )
