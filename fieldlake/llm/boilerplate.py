"""Line dedup by site: lines that over a given share of a host's pages hold are boilerplate and go.

Defined results: lines are compared trimmed of blanks, tabs and carriage returns; blank lines are
never counted nor dropped; a line of a single page, or of fewer than ``min_count``, is never
boilerplate; a null text stays null and counts as a page without lines; a null host is a host of its
own; a host of fewer than ``min_pages`` pages loses nothing; repeated rows are pages of their own,
unless ``copies`` is false: then equal texts of a host count as one page; a page may be left with an
empty text, but stays; all columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.llm.common import saved

MAX_RATIO = 0.2
MIN_PAGES = 4
#: Up to so many bytes of all hosts' boilerplate go to every task; beyond, pages and lists meet by host, the pages
#: of a host dealt over as many tasks as they need.
BROADCAST_BYTES = 8 << 20
TASK_PAGES = 20_000


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line, F.lit(" \t\r")))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(
    pages: DataFrame,
    host: Column,
    text: Column,
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    min_count: int = 2,
    copies: bool = True,
) -> DataFrame:
    """``host, lines, pages``: hashes of the lines that more than ``max_ratio`` of a host's pages hold, and their number.

    A page is counted once for a line, before anything is shuffled. A host has fewer such lines than
    a mean page of it has lines, divided by the ratio, so they are held as one array.
    """
    rows = pages.select(host.alias("host"), text.alias("text"), F.xxhash64(text).alias("page"))
    times = F.count("*") if copies else F.count_distinct("page")
    totals = rows.groupBy("host").agg(times.alias("pages")).where(F.col("pages") >= min_pages)
    own = F.array_distinct(F.transform(_lines(F.col("text")), _key))
    counts = (
        rows.select("host", "page", F.explode(own).alias("line"))
        .where(F.col("line") != _key(F.lit("")))
        .groupBy("host", "line").agg(times.alias("n"))
    )
    at = totals.select(F.col("host").alias("site"), "pages")
    common = counts.where(F.col("n") >= max(2, min_count)).join(at, counts.host.eqNullSafe(at.site)).where(
        F.col("n") > F.lit(max_ratio) * F.col("pages")
    )
    return common.groupBy("host").agg(F.collect_list("line").alias("lines"), F.max("pages").alias("pages"))


def _with_lists(rows: DataFrame, found: DataFrame, broadcast_bytes: int, task_pages: int) -> DataFrame:
    """``rows`` (with ``host``) and the ``lines`` of their host, null where it has none. The lists are brought to the
    pages where they are measured to be small."""
    found = saved(found, "lines")
    size = F.octet_length(F.coalesce("host", F.lit(""))) + F.size("lines") * 8 + 64
    if (found.agg(F.sum(size.cast("long"))).first()[0] or 0) <= broadcast_bytes:
        lists = F.broadcast(found.select(F.col("host").alias("site"), "lines"))
        return rows.join(lists, rows.host.eqNullSafe(lists.site), "left")
    tasks = F.ceil(F.col("pages") / F.lit(task_pages)).cast("int")
    many = found.where(F.col("pages") > task_pages).select(F.col("host").alias("large"), tasks.alias("tasks"))
    held = rows.join(many, rows.host.eqNullSafe(many.large), "left").withColumn(
        "salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("tasks", F.lit(1))).cast("int")
    )
    lists = found.select(
        F.col("host").alias("site"), "lines", F.explode(F.sequence(F.lit(0), tasks - 1)).alias("site_salt")
    )
    return held.join(lists, held.host.eqNullSafe(lists.site) & (held.salt == lists.site_salt), "left")


def drop_boilerplate(
    pages: DataFrame,
    host: Column,
    text_col: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    counts_as: str | None = None,
    min_count: int = 2,
    copies: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    task_pages: int = TASK_PAGES,
) -> DataFrame:
    """The pages with their columns, ``text_col`` without boilerplate lines.

    ``counts_as`` names a struct column to add: ``lines``, ``dropped``.
    """
    found = boilerplate(pages, host, F.col(text_col), max_ratio, min_pages, min_count, copies)
    rows = pages.select(F.struct("*").alias("page"), host.alias("host"), _lines(F.col(text_col)).alias("all"))
    joined = _with_lists(rows, found, broadcast_bytes, task_pages)
    kept = F.when(
        F.col("lines").isNull(), F.col("all")
    ).otherwise(F.filter("all", lambda x: ~F.array_contains(F.col("lines"), _key(x))))
    joined = joined.select("page", "all", kept.alias("kept"))
    shown = [
        F.array_join("kept", "\n").alias(c) if c == text_col else F.col("page")[c].alias(c) for c in pages.columns
    ]
    if counts_as:
        n = F.coalesce(F.size("all"), F.lit(0)).cast("long")
        shown.append(
            F.struct(n.alias("lines"), (n - F.coalesce(F.size("kept"), F.lit(0))).alias("dropped")).alias(counts_as)
        )
    return joined.select(*shown)


def tag_lines(html: Column) -> Column:
    """The text of a page; every tag ends a line."""
    return F.regexp_replace(html, "<[^>]*>", "\n")


def url_host(url: Column) -> Column:
    """The lower-case host of an address, null where there is none."""
    found = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.when(found != "", found))
