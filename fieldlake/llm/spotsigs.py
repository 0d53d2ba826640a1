"""SpotSigs fingerprints: chains of content words that follow common words.

A spot is a common word and the next two content words after it, common words in between left out;
words are lower-cased runs of letters and digits, and where fewer than two content words follow, empty ones
stand for them. A text without any common word takes each of its words as an anchor. The fingerprint is the set of its spots, written as their sorted hashes, and the
likeness of two fingerprints is the Jaccard index of their sets. For two sets that are alike by t the
smaller has at least t times the size of the larger, so ``similar_documents`` cuts sets by length into
parts, of which a set meets its own and the next, and within them joins on a prefix of the rarest
spots; a pair whose lengths alone rule it out is never compared.

Defined results: a null text is empty; texts without words have the empty fingerprint, all alike by 1
and alike to others by 0; rows that repeat both id and text are one document whose result is given as
often as the row; of rows that share an id but not the text each is a document, in the order of the
hashes of their texts; rows without an id come first; other columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldlake.llm.common import saved, texts

# Common words of English, French, German and Spanish.
COMMON_WORDS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she so that the "
    "their there they this to was we were which will with you "
    "au aux ce dans de des du elle en est et il je la le les leur mais ne nous on ou par pas plus pour que qui se "
    "son sur un une vous "
    "als am auch auf aus bei das dem den der die ein eine er es für im ist mit nicht noch sich sie so und von war "
    "wie wir zu zum "
    "al como con del el ella es esta la las lo los más no para pero por que se sin su sus un una y"
).split()
CHAIN = 2
THRESHOLD = 0.8
#: Documents in id order are numbered within so many ranges.
RANGES = 256


def with_spots(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` with the sorted distinct spots of ``text`` as longs in the column ``name``.

    The words are written with a mark behind each content word, so that a cut at the marks leaves, for
    every content word, the common words before it and the word itself. Each step is a projection of
    its own, so that no list is made twice.
    """
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")
    marked = F.array_join(
        F.transform(words, lambda w: F.concat(w, F.when(w.isin(*COMMON_WORDS), F.lit(" ")).otherwise(F.lit("\n")))), ""
    )
    runs, content, anchored = f"{name}_runs", f"{name}_content", f"{name}_anchored"

    def follow(xs: str) -> Column:
        return F.slice(F.concat(xs, F.array(F.lit(""))), F.lit(2), F.size(xs))

    def chained(run: Column, following: Column) -> Column:
        chain = F.xxhash64(F.substring_index(run, " ", -1), F.substring_index(following, " ", -1))
        pieces = F.split(run, " ", -1)
        return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda anchor: F.xxhash64(anchor, chain))

    # the last run holds what follows the last content word
    df = df.withColumn(runs, F.split(marked, "\n", -1))
    df = df.withColumn(anchored, F.flatten(F.zip_with(runs, follow(runs), chained))).withColumn(
        content, F.when(F.size(anchored) == 0, F.filter(runs, lambda w: w != ""))
    )
    bare = F.zip_with(content, follow(content), lambda w, n: F.xxhash64(w, n))
    found = F.when(F.size(anchored) > 0, F.col(anchored)).otherwise(bare)
    return df.withColumn(name, F.sort_array(F.array_distinct(found))).drop(runs, content, anchored)


def written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.lower(F.hex(x))), ".")


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, spots, fingerprint``."""
    return with_spots(texts(docs, id_col, text_col), F.col("text"), "spots").select(
        "doc_id", "spots", written(F.col("spots")).alias("fingerprint")
    )


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``a, b, likeness`` for fingerprints alike by ``threshold`` or more; ``a`` and ``b`` are the least ids of theirs.

    Documents with equal fingerprints are one class, whatever their number. A set of n spots shares
    one of its n - ceil(t n) + 1 rarest spots with any set that is alike by t.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and be at most 1")
    classes = saved(
        fingerprints(docs, id_col, text_col).where(F.size("spots") > 0).groupBy("fingerprint")
        .agg(F.min("doc_id").alias("id"), F.first("spots").alias("spots")).drop("fingerprint")
        .withColumn("n", F.size("spots"))
        .withColumn("part", F.floor(F.log(F.col("n")) / F.lit(-math.log(threshold) if threshold < 1 else 1.0))),
        "spots",
    )
    frequency = classes.select(F.explode("spots").alias("spot")).groupBy("spot").agg(F.count("*").alias("times"))
    each = classes.select("id", "n", "part", F.explode("spots").alias("spot")).join(frequency, "spot")
    rare = Window.partitionBy("id").orderBy("times", "spot")
    prefix = each.withColumn("rank", F.row_number().over(rare)).where(
        F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    ).where("times > 1")
    left = prefix.select(F.col("id").alias("a"), F.col("n").alias("na"), "part", "spot")
    right = prefix.select(
        F.col("id").alias("b"), F.col("n").alias("nb"), F.explode(F.array("part", F.col("part") - 1)).alias("part"), "spot"
    )
    pairs = left.join(right, ["part", "spot"]).where(
        "na < nb or (na = nb and a < b)"
    ).where(F.col("na") >= F.col("nb") * threshold - 1e-9).select("a", "b").distinct()
    one = classes.select(F.col("id").alias("a"), F.col("spots").alias("sa"))
    other = classes.select(F.col("id").alias("b"), F.col("spots").alias("sb"))
    return pairs.join(one, "a").join(other, "b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), likeness(F.col("sa"), F.col("sb")).alias("likeness")
    ).where(F.col("likeness") >= threshold)


def next_documents(keys: DataFrame) -> DataFrame:
    """``keys`` with ``after``, the next key in ascending order, the first after the last.

    A key is an id and the hash of a text. Ids are cut into ranges of about equal counts; the last
    document of a range is followed by the first of the next range that has any, and of those there
    are as many as ranges.
    """
    cuts = keys.agg(
        F.percentile_approx("key.doc_id", [i / RANGES for i in range(1, RANGES)], 10_000).alias("c")
    ).first()["c"]
    cuts = sorted(set(cuts or []))
    below = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("key.doc_id"))) if cuts else F.lit(0)
    ranged = keys.withColumn("range", F.when(F.col("key.doc_id").isNull(), -1).otherwise(below))
    inner = ranged.withColumn("after", F.lead("key").over(Window.partitionBy("range").orderBy("key")))
    firsts = inner.groupBy("range").agg(F.min("key").alias("first"))
    every = Window.orderBy("range")
    firsts = firsts.withColumn("follow", F.lead("first").over(every)).withColumn(
        "follow", F.coalesce("follow", F.first("first").over(every))
    )
    return inner.join(F.broadcast(firsts.select("range", "follow")), "range").select(
        *keys.columns, F.coalesce("after", "follow").alias("after")
    )


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against itself edited and against the next: one row per row of ``docs``.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The edit
    puts the first ``floor(n_chars / 4)`` characters of the next document for the last as many.
    """
    # of the type that a table gives back, so that no join casts it and shuffles the texts again
    key = F.struct("doc_id", F.xxhash64("text").alias("text_hash")).cast("struct<doc_id:bigint,text_hash:bigint>")
    rows = texts(docs, id_col, text_col).select(key.alias("key"), "text")
    keys = rows.groupBy("key").agg(
        F.max(F.char_length("text")).cast("long").alias("n_chars"), F.count("*").alias("times")
    )
    order = saved(next_documents(saved(keys, "order")), "order")
    before = order.select(
        F.col("after").alias("key"), F.col("key").alias("to"), F.floor(F.col("n_chars") / 4).cast("int").alias("lent")
    )
    # a struct is a key that is never null; texts are shuffled by it once and read from there for both joins
    one = Window.partitionBy("key").orderBy(F.lit(0))
    single = rows.withColumn("copy", F.row_number().over(one)).where("copy = 1").drop("copy")
    lent = with_spots(single.join(before, "key"), F.col("text"), "next_spots").select(
        F.col("to").alias("key"), F.expr("left(text, lent)").alias("borrowed"), "next_spots"
    )
    whole = single.join(lent, "key").join(order.drop("after"), "key").select(
        F.col("key.doc_id").alias("doc_id"), "n_chars", "times", "text", "next_spots",
        F.concat(F.expr("left(text, cast(n_chars - floor(n_chars / 4) as int))"), "borrowed").alias("edited"),
    )
    found = with_spots(with_spots(whole, F.col("text"), "own"), F.col("edited"), "changed")
    shown = found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "times",
        written(F.col("own")).alias("fingerprint"), written(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).cast("double").alias("near_edited"),
        likeness(F.col("own"), F.col("next_spots")).cast("double").alias("near_next"),
    )
    return shown.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("copy", "times")
