"""Repeated word sequences by seed and extend.

Anchors winnowed from the word n-grams of every window of ``length`` words are the seeds. Texts are
joined on them, and the places that share a seed are extended to both sides at once: places stay in
one class while the words to their left agree, and in one class while those to their right do, so a
window is the pair of a left and a right class, and the earliest place of each pair is known without
comparing two places. Windows that start earlier elsewhere are removed, and overlapping ones join into
maximal repeats. A seed with very many different surroundings is extended by whole windows, counted
where they lie before they are shuffled.

Words are told apart by 64-bit hashes and windows, in the end, by sequences of them.

Order of places: ascending id, rows without an id first, then start. Rows of one id but different
texts are documents of their own, in the order of the hashes of their texts; rows that repeat both
come neither before nor after each other, so none loses words on account of its like.

Defined results: a null text has no words; texts shorter than ``length`` stay; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fieldlake.llm.common import parts_for, saved, texts
from fieldlake.llm.repeats import keyed, merged, repeated_segments, slices
from fieldlake.llm.runindex import covered
from fieldlake.llm.seeds import Spans, chunks, mix64, odd_powers, segments

LENGTH = 20
GRAM = 6
#: Segments extended together in a task, and of one seed before its windows are counted instead.
GROUP_SEGMENTS = 50_000
CROWD = 50_000
#: Bytes split into words at once.
STRETCH = 1 << 21

_BYTES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_STEP = 0xA0761D6478BD642F
_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("h", pa.int64()), ("sh", pa.int64()),
    ("start", pa.int32()), ("n", pa.int32()), ("anchor", pa.int32()),
])


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and codes of the words of some bytes."""
    blank = _BLANK[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not starts.size:
        return starts, np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    offset = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    sums = np.add.reduceat(_BYTES[raw[~blank]] * odd_powers(_STEP, int(lengths.max()))[offset], first)
    return starts, mix64(sums + lengths.astype(np.uint64))


def word_codes(data: list[bytes]) -> list[np.ndarray]:
    """The codes of each text's words; long texts are cut at blanks and short ones taken together."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            starts, codes = _words(np.frombuffer(b" ".join(held), np.uint8))
            at = np.cumsum([len(x) + 1 for x in held])
            out.extend(np.split(codes, np.searchsorted(starts, at[:-1])))
        held, size = [], 0

    for one in data:
        if len(one) > STRETCH:
            flush()
            raw, parts, at = np.frombuffer(one, np.uint8), [], 0
            while at < len(raw):
                to, step = min(len(raw), at + STRETCH), STRETCH
                while to < len(raw):  # until a stretch ends between words
                    gap = np.flatnonzero(_BLANK[raw[to : to + step]])
                    to = to + int(gap[0]) if gap.size else min(len(raw), to + step)
                    if gap.size:
                        break
                parts.append(_words(raw[at:to])[1])
                at = to
            out.append(np.concatenate(parts))
            continue
        held.append(one)
        size += len(one)
        if size > STRETCH:
            flush()
    flush()
    return out


def _finder(length: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "data")):
            words = word_codes(batch.column("data").to_pylist())
            for held in chunks([len(x) for x in words], length):
                codes = np.concatenate([words[k][a:b] for k, a, b in held])
                ends = np.cumsum([b - a for _, a, b in held])
                first, last, anchor, key, content = segments(codes, ends, gram, length)
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


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted segments of each text, one row per segment."""
    for batch in (part for whole in batches for part in slices(whole, "data")):
        wanted = batch.column("wanted")
        row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(wanted).to_numpy())
        fields = dict(zip([f.name for f in wanted.type.value_type], wanted.flatten().flatten(), strict=True))
        codes = word_codes(batch.column("data").to_pylist())
        at, n = fields["start"].to_numpy(), fields["n"].to_numpy()
        ids = batch.column("doc_id").take(pa.array(row))
        yield pa.RecordBatch.from_pydict({
            **{k: fields[k] for k in ("h", "sh", "n", "anchor", "kinds")},
            "words": pa.array([codes[k][a : a + b].tobytes() for k, a, b in zip(row, at, n, strict=True)], pa.binary()),
            "known": pc.cast(ids.is_valid(), pa.int32()), "id": pc.fill_null(ids, 0),
            "text_hash": batch.column("text_hash").take(pa.array(row)), "at": fields["start"],
        })


def _classes(parent: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Classes of equal (parent class, next word)."""
    order = np.lexsort((word, parent))
    new = np.ones(len(order), bool)
    new[1:] = (parent[order[1:]] != parent[order[:-1]]) | (word[order[1:]] != word[order[:-1]])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def earlier_windows(
    seed: np.ndarray, words: list[np.ndarray], anchor: np.ndarray, place: np.ndarray, length: int, gram: int
) -> list[np.ndarray]:
    """For each segment the starts of its windows that a segment of lower ``place`` has too."""
    n, around = len(seed), length - gram
    sizes = np.array([len(w) for w in words])
    flat, base = np.concatenate(words), np.concatenate([[0], np.cumsum(sizes)[:-1]])

    def word(at: np.ndarray) -> np.ndarray:
        inside = (at >= 0) & (at < sizes)
        return np.where(inside, flat[np.where(inside, base + at, 0)], np.uint64(0))

    start = np.unique(seed, return_inverse=True)[1]
    left, right = [start], [start]
    for a in range(1, around + 1):
        left.append(_classes(left[-1], word(anchor - a)))
        right.append(_classes(right[-1], word(anchor + gram - 1 + a)))
    rows, at = [], []
    for a in range(around + 1):
        whole = np.flatnonzero((anchor - a >= 0) & (anchor - a + length <= sizes))
        if not whole.size:
            continue
        kind = _classes(left[a][whole], right[around - a][whole])
        least = np.full(kind.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, kind, place[whole])
        late = whole[place[whole] > least[kind]]
        rows.append(late)
        at.append(anchor[late] - a)
    out: list[np.ndarray] = [np.empty(0, np.int64)] * n
    if rows:
        rows_, at_ = np.concatenate(rows), np.concatenate(at)
        order = np.lexsort((at_, rows_))
        rows_, at_ = rows_[order], at_[order]
        for piece in np.split(np.arange(len(rows_)), np.flatnonzero(np.diff(rows_)) + 1):
            if piece.size:
                out[rows_[piece[0]]] = at_[piece]
    return out


def _extender(length: int, gram: int):
    def extend(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["h", "sh", "n"]).sort_values(["known", "id", "text_hash", "at"], kind="stable")
        words = [np.frombuffer(w, np.uint64) for w in frame["words"]]
        found = earlier_windows(
            frame["h"].to_numpy(np.int64), words, frame["anchor"].to_numpy(np.int64), np.arange(len(frame)), length, gram
        )
        rows = [
            (h, sh, n, a, b)
            for h, sh, n, starts in zip(frame["h"], frame["sh"], frame["n"], found, strict=True)
            for a, b in covered(starts, length)
        ]
        return pd.DataFrame(rows, columns=["h", "sh", "n", "from", "to"]).astype(
            {"h": "int64", "sh": "int64", "n": "int32", "from": "int32", "to": "int32"}
        )

    return extend


def _windows(length: int):
    """Every window of the segments of a crowded seed, by where it lies to the seed and its two hashes."""

    def windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for one in frame.itertuples(index=False):
                codes = np.frombuffer(one.words, np.uint64)
                at = np.arange(len(codes) - length + 1)
                yield pd.DataFrame({
                    "h": one.h, "sh": one.sh, "n": one.n, "off": at.astype(np.int32),
                    "w1": Spans(codes).hash(at, at + length).view(np.int64),
                    "w2": Spans(codes, 1).hash(at, at + length).view(np.int64),
                    "known": one.known, "id": one.id, "text_hash": one.text_hash, "at": (one.at + at).astype(np.int32),
                })

    return windows


def _crowded(rows: DataFrame, length: int) -> DataFrame:
    each = saved(rows.mapInPandas(
        _windows(length),
        "h long, sh long, n int, off int, w1 long, w2 long, known int, id long, text_hash long, at int",
    ), "windows")
    place = F.struct("known", "id", "text_hash", "at")
    first = each.groupBy("h", "w1", "w2").agg(F.min(place).alias("first"))
    late = each.withColumn("place", place).join(first, ["h", "w1", "w2"]).where("first < place")
    return late.select("h", "sh", "n", F.col("off").alias("from"), (F.col("off") + length).cast("int").alias("to"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``key, from, to``: stretches of words of ``keyed`` documents that earlier places have too; they may overlap."""
    # the seeds are found twice: once to be counted, once for those that count; a table of all would cost more
    found = docs.select("key.doc_id", "key.text_hash", F.col("text").cast("binary").alias("data")).mapInArrow(
        _finder(length, gram), "doc_id long, text_hash long, h long, sh long, start int, n int, anchor int"
    )
    shared, looked = repeated_segments(found, "seeds")
    mixed = looked.where("kinds > 1")
    wanted = mixed.groupBy("first.key").agg(
        F.collect_list(F.struct("first.start", "n", "h", "sh", "anchor", "kinds")).alias("wanted")
    )

    pieces = docs.select("key", F.col("text").cast("binary").alias("data")).join(wanted, "key")
    places = saved(
        pieces.select("key.doc_id", "key.text_hash", "data", "wanted").mapInArrow(
            _cutter, "h long, sh long, n int, anchor int, kinds long, words binary, known int, id long, text_hash long, at int"
        ),
        "places",
    )
    total, most = mixed.agg(F.count("*"), F.max("kinds")).first()
    marks = places.where(F.col("kinds") <= crowd).groupBy(
        F.pmod(F.xxhash64("h"), F.lit(parts_for(total or 0, GROUP_SEGMENTS))).alias("part")
    ).applyInPandas(_extender(length, gram), "h long, sh long, n int, from int, to int")
    if (most or 0) > crowd:
        marks = marks.unionByName(_crowded(places.where(F.col("kinds") > crowd).dropDuplicates(["h", "sh", "n"]), length))
    marks = marks.groupBy("h", "sh").agg(F.collect_set(F.struct("from", "to")).alias("own"))
    guide = saved(
        looked.where("times > 1 or kinds > 1").select("h", "sh", "first").join(marks, ["h", "sh"], "left"), "spans"
    )
    whole = F.array(F.struct(F.lit(0).alias("from"), F.col("n").alias("to")))
    place = F.struct("key", "start")
    return (
        shared.join(guide, ["h", "sh"])
        .select("key", "start", F.explode(F.when(F.col("first") == place, F.col("own")).otherwise(whole)).alias("s"))
        .select("key", (F.col("start") + F.col("s.from")).alias("from"), (F.col("start") + F.col("s.to")).alias("to"))
    )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, spans`` (maximal repeats, in words) and ``kept`` text."""
    rows = keyed(texts(docs, id_col, text_col))
    spans = repeated_spans(rows, length, crowd=crowd).groupBy("key").agg(
        F.collect_set(F.struct("from", "to")).alias("found")
    )

    @F.pandas_udf("n_words long, n_removed long, spans array<struct<from:int,to:int>>, kept string")
    def keep(text: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for one, each in zip(text, found, strict=True):
            words = one.encode("utf-8").split()
            runs = [] if each is None else merged(each)
            left, at = [], 0
            for a, b in runs:
                left += words[at:a]
                at = b
            left += words[at:]
            out.append((
                len(words), len(words) - len(left), [{"from": a, "to": b} for a, b in runs], b" ".join(left).decode("utf-8")
            ))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "spans", "kept"])

    return rows.join(spans, "key", "left").select("doc_id", keep("text", "found").alias("k")).select("doc_id", "k.*")
