"""Exact repeats of bytes, found by matching statistics over run-length indexes.

Every window of ``length`` bytes that also starts elsewhere, in the same document or another, is
repeated, and the bytes that repeated windows cover go. Windows are dealt by their anchors (see
``seeds``), so equal windows meet whatever documents they come from; segments whose anchor occurs
once need no look. The different segments of a group of anchors are indexed together (``runindex``),
a segment that occurs several times being one string of that multiplicity, and the statistics are
streamed along them. An anchor with more text than one task should hold is dealt again by what the
windows near it have in common, at last by whole windows, which are counted by their hashes and not
indexed, so no index grows with the corpus, however many equal windows there are.

Defined results: a null text is empty; rows that repeat an id and text are documents of their own, so
their windows repeat; rows without an id are documents like any other; texts shorter than ``length``
stay; what is left need not be valid UTF-8, so it is binary; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.llm.common import parts_for, saved, texts
from fieldlake.llm.repeats import keyed, merged, repeated_segments, slices
from fieldlake.llm.runindex import RunIndex
from fieldlake.llm.seeds import Spans, chunks, segments

LENGTH = 400
GRAM = 32
#: Text of one index, and of one anchor before its windows are dealt again.
INDEX_BYTES = 1 << 20
HOT_BYTES = 8 << 20
#: Neighbouring windows that stay together when a hot anchor is dealt again, then again; at last single windows.
SPLITS = (32, 1)

_BYTES = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64)
_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("h", pa.int64()), ("sh", pa.int64()),
    ("start", pa.int32()), ("n", pa.int32()), ("anchor", pa.int32()),
])


def _finder(length: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "data")):
            data = batch.column("data").to_pylist()
            for held in chunks([len(x) for x in data], length):
                raw = np.frombuffer(b"".join([data[k][a:b] for k, a, b in held]), np.uint8)
                ends = np.cumsum([b - a for _, a, b in held])
                first, last, anchor, key, content = segments(_BYTES[raw], ends, gram, length)
                if not first.size:
                    continue
                piece = np.searchsorted(ends, first, "right")
                shift = np.array([a for _, a, _ in held]) - np.concatenate([[0], ends[:-1]])
                row = pa.array(np.array([k for k, _, _ in held])[piece])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(row), batch.column("text_hash").take(row),
                    pa.array(key.view(np.int64)), pa.array(content.view(np.int64)),
                    pa.array((first + shift[piece]).astype(np.int32)),
                    pa.array((last - first + length).astype(np.int32)), pa.array((anchor - first).astype(np.int32)),
                ], schema=_FOUND)

    return find


def _indexer(length: int):
    def index(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["h", "sh", "n", "cut"])
        found = RunIndex(frame["data"].tolist()).long_matches(length)
        rows = []
        for h, sh, n, cut, times, size, runs in zip(
            frame["h"], frame["sh"], frame["n"], frame["cut"], frame["times"], frame["data"].str.len(), found, strict=True
        ):
            runs = [(0, size)] if times > 1 else runs  # its own copies match it to its end
            rows += [(h, sh, n, cut + a, cut + b) for a, b in runs]
        return pd.DataFrame(rows, columns=["h", "sh", "n", "from", "to"]).astype(
            {"h": "int64", "sh": "int64", "n": "int32", "from": "int32", "to": "int32"}
        )

    return index


def _long(*parts: int) -> int:
    """One long from several, the same in every process."""
    out = 0
    for x in parts:
        out = (out * Spans.BASES[0] + x + 1) & (1 << 64) - 1
        out ^= out >> 29
    return out - (1 << 64) if out >> 63 else out


def _dealer(length: int, block: int):
    """Hot strings cut into blocks of windows by their distance to the anchor, dealt by what all of a block share."""

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for one in frame.itertuples(index=False):
                last = len(one.data) - length
                away = one.anchor - np.arange(last + 1)  # of each window's start to the anchor
                for b in np.unique(away // block):
                    starts = np.flatnonzero(away // block == b)
                    lo, hi = int(starts[0]), int(starts[-1])
                    # all windows of the block hold the bytes from its last place for a start to its first for an end
                    near = one.anchor - int(b) * block
                    raw = np.frombuffer(one.data, np.uint8)[max(0, near) : near - block + 1 + length]
                    codes, whole = _BYTES[raw], (np.array([0]), np.array([len(raw)]))
                    core = int(Spans(codes).hash(*whole)[0] ^ Spans(codes, 1).hash(*whole)[0])
                    rows.append((
                        _long(one.group, int(b), core), one.h, one.sh, one.n, one.cut + lo, one.times,
                        one.anchor - lo, one.data[lo : hi + length],
                    ))
            yield pd.DataFrame(rows, columns=["group", "h", "sh", "n", "cut", "times", "anchor", "data"])

    return deal


STRING = "group long, h long, sh long, n int, cut int, times long, anchor int, data binary"


def _groups(strings: DataFrame) -> DataFrame:
    return strings.groupBy("group").agg(F.sum(F.length("data").cast("long")).alias("bytes"), F.sum("times").alias("all"))


def _equal_windows(strings: DataFrame, length: int) -> DataFrame:
    """Strings of one window each, marked whole where their windows occur more than once; told apart by two hashes, no index."""
    each = strings.select("group", F.xxhash64("data").alias("window"), "h", "sh", "n", "cut", "times")
    often = saved(each.groupBy("group", "window").agg(F.sum("times").alias("all")).where("all > 1"), "windows")
    return each.join(often.drop("all"), ["group", "window"]).select(
        "h", "sh", "n", F.col("cut").alias("from"), (F.col("cut") + length).cast("int").alias("to")
    )


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``key, from, to``: stretches of repeated windows of the documents of ``keyed``; they may overlap."""
    found = saved(
        docs.select("key.doc_id", "key.text_hash", F.col("text").cast("binary").alias("data")).mapInArrow(
            _finder(length, gram), "doc_id long, text_hash long, h long, sh long, start int, n int, anchor int"
        ),
        "segments",
    )
    shared, looked = repeated_segments(found, "segments")
    wanted = looked.groupBy("first.key").agg(
        F.collect_list(F.struct("first.start", "h", "sh", "n", "times", "anchor")).alias("wanted")
    )
    piece = F.transform(
        "wanted",
        lambda w: F.struct(
            w["h"].alias("h"), w["sh"].alias("sh"), w["n"].alias("n"), w["times"].alias("times"), w["anchor"].alias("anchor"),
            F.substring(F.col("data"), w["start"] + 1, w["n"]).alias("data"),
        ),
    )
    cut = docs.select("key", F.col("text").cast("binary").alias("data")).join(wanted, "key").select(
        F.explode(piece).alias("p")
    )
    strings = saved(
        cut.select(
            F.col("p.h").alias("group"), "p.h", "p.sh", "p.n", F.lit(0).alias("cut"), "p.times", "p.anchor", "p.data"
        ),
        "strings",
    )
    marks = None
    for block in SPLITS:
        sizes = _groups(strings) if marks is None else saved(_groups(strings).where("all > 1"), "groups")
        total, most = sizes.agg(F.sum("bytes"), F.max("bytes")).first()
        fit = strings if marks is None and (most or 0) <= hot_bytes else strings.join(
            sizes.where(F.col("bytes") <= hot_bytes), "group"
        ).select(strings.columns)
        parts = parts_for(total or 0, INDEX_BYTES)
        done = fit.groupBy(F.pmod(F.xxhash64("group"), F.lit(parts)).alias("part")).applyInPandas(
            _indexer(length), "h long, sh long, n int, from int, to int"
        )
        marks = done if marks is None else marks.unionByName(done)
        if (most or 0) <= hot_bytes:
            break
        hot = strings.join(sizes.where(F.col("bytes") > hot_bytes).select("group"), "group").select(strings.columns)
        strings = saved(hot.mapInPandas(_dealer(length, block), STRING), "strings")
    else:
        marks = marks.unionByName(_equal_windows(strings, length))
    spans = saved(marks.groupBy("h", "sh").agg(F.collect_set(F.struct("from", "to")).alias("spans")), "spans")
    return shared.join(spans, ["h", "sh"]).select("key", "start", F.explode("spans").alias("s")).select(
        "key", (F.col("start") + F.col("s.from")).alias("from"), (F.col("start") + F.col("s.to")).alias("to")
    )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hot_bytes: int = HOT_BYTES
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, spans`` (maximal removed runs) and ``kept`` bytes."""
    rows = keyed(texts(docs, id_col, text_col))
    spans = repeated_spans(rows, length, hot_bytes=hot_bytes).groupBy("key").agg(
        F.collect_set(F.struct("from", "to")).alias("found")
    )

    @F.pandas_udf("spans array<struct<from:int,to:int>>, kept binary")
    def keep(data: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for raw, each in zip(data, found, strict=True):
            if each is None:
                out.append(([], None))
                continue
            runs, at, left = merged(each), 0, []
            for a, b in runs:
                left.append(raw[at:a])
                at = b
            out.append(([{"from": a, "to": b} for a, b in runs], b"".join([*left, raw[at:]])))
        return pd.DataFrame(out, columns=["spans", "kept"])

    data = F.col("text").cast("binary")
    joined = rows.join(spans, "key", "left").withColumn("k", keep(F.when(F.col("found").isNotNull(), data), F.col("found")))
    kept: Column = F.coalesce("k.kept", data)
    n = F.octet_length("text").cast("long")
    return joined.select(
        "doc_id", n.alias("n_bytes"), (n - F.octet_length(kept)).cast("long").alias("n_removed"),
        F.col("k.spans").alias("spans"), kept.alias("kept"),
    )
