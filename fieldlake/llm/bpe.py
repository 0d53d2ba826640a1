"""Byte-level BPE encoding and decoding as a reduction tree over pieces of a text.

A text is halved until its pieces are short. A piece is held as its stable middle, already token ids,
and the text on either side that a neighbour might still change. Joining two neighbours encodes the
window between their middles. Where a letter, digit or ASCII sign is followed by a blank or a line break, or
a letter or digit by a sign, every parse by the pattern ends a match: letters and digits match with their
own kind alone, no match holds something else before a blank, none looks further than the first character
that is not white space, and matches know nothing of what came before. Tokens beyond such a cut cannot change, so a window grows from the seam to the nearest cut on
either side, and over whole neighbours that have none. Joining is associative: halves of one task and
chunks of a very long text dealt over many tasks are joined by the same rule. Decoding joins bytes.

Defined results: a null text is empty and has no ids; rows without an id and repeated rows are encoded
like any other; other columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fieldlake.llm.common import saved, texts
from fieldlake.llm.repeats import slices

LEAF_CHARS = 4_096
#: Texts of more characters are dealt over several tasks.
CHUNK_CHARS = 65_536
FAN_IN = 8
#: Bytes of text that a task encodes before it gives the results on.
SLICE_BYTES = 1 << 20
#: Ids that one step of decoding looks up.
DECODE_IDS = 65_536
#: Letters and signs of common scripts, which every version of Unicode knows as such (fixed values).
_LETTER = r"[a-zA-ZÀ-ÖØ-öА-яぁ-ゖァ-ヺ一-龥가-힣]"
_SIGN = r"[!-@\[-`{-~、。！，：；？]"
CUT = regex.compile(rf"[\p{{L}}\p{{N}}!-~](?=[ \n])|{_LETTER}(?={_SIGN})|[0-9](?=[!-/:-~、。！，：；？])")
EMPTY = np.empty(0, "<u4")


def cut(text: str, last: bool = False) -> int:
    """The first (or last) place that ends a match in every parse, -1 if there is none."""
    if not last:
        found = CUT.search(text)
        return found.end() if found else -1
    end = len(text)
    while end > 0:  # a window from the end that grows until it holds a cut
        start = max(0, end - 256)
        ends = [m.end() for m in CUT.finditer(text, start, min(len(text), end + 1))]
        if ends:
            return ends[-1]
        end = start
    return -1


@dataclass(frozen=True)
class Piece:
    """``head`` and ``tail`` may still change at a seam; without a cut all of the text is head and ids is None."""

    head: str
    ids: np.ndarray | None = None
    tail: str = ""


class Codec:
    def __init__(self, ranks: bytes, pattern: str):
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.words = [b""] * (max(table.values(), default=-1) + 1)
        for word, rank in table.items():
            self.words[rank] = word
        self.base = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def window(self, text: str) -> np.ndarray:
        return np.array(self.base.encode_ordinary(text), dtype="<u4") if text else EMPTY

    def piece(self, text: str, leaf_chars: int = LEAF_CHARS) -> Piece:
        if len(text) > leaf_chars:
            half = len(text) // 2
            return self.join(self.piece(text[:half], leaf_chars), self.piece(text[half:], leaf_chars))
        first = cut(text)
        if first < 0:
            return Piece(text)
        last = cut(text, last=True)
        return Piece(text[:first], self.window(text[first:last]), text[last:])

    def join(self, a: Piece, b: Piece) -> Piece:
        if a.ids is None and b.ids is None:
            return self._seam(a.head, b.head)
        if a.ids is None:
            left = self._seam(a.head, b.head)
            if left.ids is None:
                return Piece(left.head, b.ids, b.tail)
            return Piece(left.head, np.concatenate([left.ids, self.window(left.tail), b.ids]), b.tail)
        if b.ids is None:
            right = self._seam(a.tail, b.head)
            if right.ids is None:
                return Piece(a.head, a.ids, right.head)
            return Piece(a.head, np.concatenate([a.ids, self.window(right.head), right.ids]), right.tail)
        return Piece(a.head, np.concatenate([a.ids, self.window(a.tail + b.head), b.ids]), b.tail)

    def _seam(self, a: str, b: str) -> Piece:
        """Two texts without a cut of their own: the seam itself is the only place for one."""
        if a and b and CUT.match(a + b[:1], len(a) - 1):
            return Piece(a, EMPTY, b)
        return Piece(a + b)

    def finish(self, piece: Piece) -> np.ndarray:
        if piece.ids is None:
            return self.window(piece.head)
        return np.concatenate([self.window(piece.head), piece.ids, self.window(piece.tail)])

    def reduce(self, pieces: list[Piece]) -> Piece:
        while len(pieces) > 1:
            pairs = [self.join(a, b) for a, b in zip(pieces[::2], pieces[1::2], strict=False)]
            pieces = pairs + pieces[len(pieces) - len(pieces) % 2 :]
        return pieces[0]

    def encode(self, text: str, leaf_chars: int = LEAF_CHARS) -> np.ndarray:
        return self.finish(self.piece(text, leaf_chars))

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= DECODE_IDS:
            words = self.words
            return b"".join([words[i] for i in ids.tolist()])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(maxsize=2)
def codec(ranks: bytes, pattern: str) -> Codec:
    return Codec(ranks, pattern)


def read_ranks(path: str) -> bytes:
    """The rank file, a vocabulary of fixed size, read by the driver and broadcast to the tasks."""
    with open(path, "rb") as file:
        return file.read()


#: What ``encode_documents`` can return of a document besides its id and number of tokens.
OUTPUTS = ("ids", "decoded", "ids_sha256", "decoded_sha256")


def _results(own: Codec, ids: list[np.ndarray], doc_ids: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
    """The wanted columns; ids are encoded and decoded in the same call, and looked at once."""
    raw = [x.tobytes() for x in ids]
    words = [own.decode(x) for x in ids] if any(c.startswith("decoded") for c in schema.names) else []
    columns = {
        "n_tokens": lambda: [len(x) for x in ids], "ids": lambda: raw, "decoded": lambda: words,
        "ids_sha256": lambda: [hashlib.sha256(x).hexdigest() for x in raw],
        "decoded_sha256": lambda: [hashlib.sha256(x).hexdigest() for x in words],
    }
    made = [pa.array(columns[field.name](), field.type) for field in list(schema)[1:]]
    return pa.RecordBatch.from_arrays([doc_ids, *made], schema=schema)


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf_chars: int = LEAF_CHARS,
    chunk_chars: int = CHUNK_CHARS,
    fan_in: int = FAN_IN,
    outputs: tuple[str, ...] = ("ids",),
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens`` and the ``outputs``.

    ``ids`` are little-endian unsigned 32-bit integers and ``decoded`` the bytes that they stand for, both
    also as SHA-256 in hex. A text is encoded once, and its ids decoded in the same call; rows of a slice
    that hold equal texts share the work.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    rows = texts(docs, id_col, text_col).withColumn("n", F.char_length("text"))
    kind = rows.schema["doc_id"].dataType
    types = {c: ("string", pa.string()) if c.endswith("sha256") else ("binary", pa.binary()) for c in OUTPUTS}
    declared = f"doc_id {kind.simpleString()}, n_tokens long" + "".join(f", {c} {types[c][0]}" for c in outputs)
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("n_tokens", pa.int64()), *[(c, types[c][1]) for c in outputs]])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE_BYTES)):
            seen: dict[str, np.ndarray] = {}
            some = batch.column("text").to_pylist()
            for text in some:
                if text not in seen:
                    seen[text] = own.encode(text, leaf_chars)
            yield _results(own, [seen[text] for text in some], batch.column("doc_id"), schema)

    short = rows.where(F.col("n") <= chunk_chars).select("doc_id", "text").mapInArrow(encoded, declared)

    piece_type = "head string, ids binary, tail string"

    @F.pandas_udf(piece_type)
    def piece_of(text: pd.Series) -> pd.DataFrame:
        own = codec(ranks.value, pattern)
        found = [own.piece(x, leaf_chars) for x in text]
        return pd.DataFrame({
            "head": [p.head for p in found],
            "ids": pd.Series([None if p.ids is None else p.ids.tobytes() for p in found], dtype=object),
            "tail": [p.tail for p in found],
        })

    chunks = rows.where(F.col("n") > chunk_chars).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), "text", "n"
    ).select(
        "doc_id", "row", "n", F.posexplode(F.expr(
            f"transform(sequence(0L, (n - 1) div {chunk_chars}L), "
            f"i -> substring(text, cast(i * {chunk_chars} + 1 as int), {chunk_chars}))"
        )).alias("at", "text"),
    )
    pieces = saved(
        chunks.repartition("row", "at").select(
            "doc_id", "row", "n", F.col("at").cast("long").alias("at"), piece_of("text").alias("p")
        ).select("doc_id", "row", "n", "at", "p.*"),
        "pieces",
    )

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        own = codec(ranks.value, pattern)
        frame = frame.sort_values("at")
        ids = [None if x is None else np.frombuffer(x, "<u4") for x in frame["ids"]]
        parts = [Piece(*x) for x in zip(frame["head"], ids, frame["tail"], strict=True)]
        root = own.reduce(parts)
        return frame.head(1).assign(
            at=frame["at"] // fan_in, head=root.head,
            ids=pd.Series([None if root.ids is None else root.ids.tobytes()], dtype=object, index=frame.index[:1]),
            tail=root.tail,
        )

    most = -(-(pieces.agg(F.max("n")).first()[0] or 1) // chunk_chars)
    while most > 1:
        pieces = pieces.groupBy("row", F.floor(F.col("at") / fan_in).alias("to")).applyInPandas(joined, pieces.schema)
        most = -(-most // fan_in)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        for batch in (whole.slice(k, 1) for whole in batches for k in range(whole.num_rows)):
            head, ids, tail = (batch.column(c)[0].as_py() for c in ("head", "ids", "tail"))
            piece = Piece(head, None if ids is None else np.frombuffer(ids, "<u4"), tail)
            yield _results(own, [own.finish(piece)], batch.column("doc_id"), schema)

    long = pieces.select("doc_id", "head", "ids", "tail").mapInArrow(finished, declared)
    return short.unionByName(long)


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The rows of ``encoded`` with ``decoded``, the bytes that their ids stand for."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    @F.pandas_udf("binary")
    def bytes_of(ids: pd.Series) -> pd.Series:
        own = codec(ranks.value, pattern)
        return pd.Series([own.decode(np.frombuffer(x, "<u4")) for x in ids], dtype=object)

    return encoded.withColumn("decoded", bytes_of("ids"))
