"""Packing token ids into sequences of fixed capacity by reciprocal classes.

A piece of ``s`` ids belongs to class ``capacity // s``: so many such pieces share a sequence, whatever
they are, as each is at most that fraction of the capacity. Every task fills the sequences of its classes
by count alone and knows nothing of other tasks, so nothing is shuffled and no class meets in one place.
Documents may be cut: what is over whole sequences gives its largest halves, quarters, eighths ... of the
capacity, which fill their sequences exactly, until less than ``smallest`` ids are left; that tail stays
whole. At its end a task holds at most one unfinished sequence a class; their ids fill sequences one after
another, and the last of them is cut into powers of two, which need no padding. So only full sequences of
tails are padded, by less than a tail each.

Defined results: a null text is empty, so the end id is all it has; rows without an id and repeated rows
are documents like any other; other columns are never read. Which documents share a sequence follows from
how the input is divided into tasks.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from fieldlake.llm.common import texts
from fieldlake.llm.repeats import slices

CAPACITY = 4_096
END_ID = 2
SMALLEST = 64
#: Bytes of a text that are split at a time, of stretches whose ids are kept, and of text packed at a time.
STRETCHES_BYTES = 1 << 20
KNOWN_BYTES = 16 << 20
SLICE_BYTES = 1 << 20
#: A word of letters that compose with nothing and stay one letter in lower case, and signs after it, without the
#: apostrophe and the start of a special token.
ASCII_WORD = re.compile(rb"([A-Za-z]+)([!-&(-/:;=-@\[-`{-~]*)")
LATIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ſ]+)([!-&(-/:;=-@\[-`{-~]*)")
#: Sequences a task may number.
TASK_BITS = 40


class Encoder:
    """The library's tokenizer, asked once for each stretch between blanks that it has not seen lately.

    The vocabulary's rules drop white space, look at no neighbour beyond it and compose no character across
    it, and no special token holds any, so the ids of a text are those of its stretches one after another.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor share its cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.held = 0

    def _lacking(self, some: set[bytes]) -> set[bytes]:
        """Those of ``some`` to be asked for; what was known before the last turn of the store is known again."""
        known, before = self.known, self.before
        new = some.difference(known)
        lacking = new.difference(before)
        for x in new.difference(lacking):
            ids = known[x] = before[x]
            self.held += len(x) + len(ids)
        return lacking

    def _learn(self, stretches: set[bytes]) -> dict[bytes, bytes]:
        """The ids of all these, those known before or asked for now.

        A word of Latin letters and signs after it are asked for apart, as the rules match them apart, and a
        word of ASCII letters in lower case, as the rules make it. A full store is kept beside the next one until
        that is full too, so that what comes again and again is asked for once.
        """
        if self.held > KNOWN_BYTES:
            self.before, self.known, self.held = self.known, {}, 0
        known, parts, ask = self.known, [], set()
        for x in self._lacking(stretches):
            found = ASCII_WORD.fullmatch(x)
            if found:
                word, signs = found.groups()
                word = word.lower()
            else:
                found = None if x.isascii() else LATIN_WORD.fullmatch(x.decode())
                if not found:
                    ask.add(x)
                    continue
                word, signs = found[1].encode(), found[2].encode()
            if word != x:
                parts.append((x, word, signs))
            if word not in known:
                ask.add(word)
            if signs and signs not in known:
                ask.add(signs)
        asked = list(self._lacking(ask))
        for x, found in zip(asked, self.tokenizer.encode_batch_fast([x.decode() for x in asked], add_special_tokens=False), strict=True):
            ids = known[x] = array("I", found.ids).tobytes()
            self.held += len(x) + len(ids)
        for x, word, signs in parts:
            ids = known[x] = known[word] + known[signs] if signs else known[word]
            self.held += len(x) + len(ids)
        return known

    def encode(self, some: list[str], end_id: int | None = None) -> list[np.ndarray]:
        """The ids of each text, and the end id."""
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        out = []
        for text in some:
            data, at, ids = text.encode(), 0, []
            while at < len(data):
                to = data.find(b" ", at + STRETCHES_BYTES)
                stretches = data[at : to if to >= 0 else len(data)].split()
                known = self._learn(set(stretches))
                ids.append(b"".join([known[x] for x in stretches]))
                at = to if to >= 0 else len(data)
            out.append(np.frombuffer(b"".join([*ids, end]), "<u4"))
        return out


@lru_cache(maxsize=2)
def _encoder(model: str) -> Encoder:
    return Encoder(model)


def cut_sizes(n: int, capacity: int = CAPACITY, smallest: int = SMALLEST) -> list[int]:
    """Sizes of the pieces of ``n`` ids: whole sequences, then halves, quarters ... and a tail."""
    out = [capacity] * (n // capacity)
    n %= capacity
    size = capacity // 2
    while n >= smallest and size >= smallest:
        if n >= size:
            out.append(size)
            n -= size
        else:
            size //= 2
    return [*out, n] if n else out


@dataclass
class Piece:
    row: tuple  # document and number of its ids
    start: int
    ids: np.ndarray


@dataclass
class Packer:
    """The sequences of one task."""

    capacity: int
    first: int
    open: dict[int, list[Piece]] = field(default_factory=dict)
    closed: list[tuple] = field(default_factory=list)

    def add(self, piece: Piece) -> None:
        per = self.capacity // len(piece.ids)
        held = self.open.setdefault(per, [])
        held.append(piece)
        if len(held) == per:
            self._close(self.open.pop(per))

    def _close(self, pieces: list[Piece]) -> None:
        offset = 0
        for piece in pieces:
            self.closed.append((*piece.row, piece.start, piece.ids, self.first, offset))
            offset += len(piece.ids)
        self.first += 1

    def finish(self) -> None:
        """What is left of the classes, cut to fill sequences, the last one as powers of two."""
        left = [piece for per in sorted(self.open) for piece in self.open[per]]
        self.open = {}
        total = sum(len(piece.ids) for piece in left)
        room = [self.capacity] * (total // self.capacity)
        room += [1 << bit for bit in range(self.capacity.bit_length() - 1, -1, -1) if total % self.capacity >> bit & 1]
        held, free, sizes = [], 0, iter(room)
        for piece in left:
            start, ids = piece.start, piece.ids
            while len(ids):
                if not free:
                    free = next(sizes)
                take = min(free, len(ids))
                held.append(Piece(piece.row, start, ids[:take]))
                start, ids, free = start + take, ids[take:], free - take
                if not free:
                    self._close(held)
                    held = []

    def taken(self, schema: pa.Schema) -> pa.RecordBatch:
        doc, n, start, ids, sequence, offset = zip(*self.closed, strict=True)
        self.closed = []
        return pa.RecordBatch.from_arrays([
            pa.array(doc, schema.field("doc_id").type), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
            pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(n, pa.int64()), pa.array(sequence, pa.int64()),
            pa.array(offset, pa.int64()),
        ], schema=schema)


def pack_documents(
    docs: DataFrame, model_path: str, end_id: int | None = END_ID, capacity: int = CAPACITY, smallest: int = SMALLEST,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit), ``doc_tokens,
    sequence_id, offset``. ``model_path`` is the vocabulary file, read by the driver and broadcast."""
    with open(model_path, encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType
    numbers = ("doc_tokens", "sequence_id", "offset")
    schema = pa.schema([
        ("doc_id", to_arrow_type(kind)), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        *[(c, pa.int64()) for c in numbers],
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        packer = Packer(capacity, TaskContext.get().partitionId() << TASK_BITS)
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE_BYTES)):
            encoded = encoder.encode(batch.column("text").to_pylist(), end_id)
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                at = 0
                for size in cut_sizes(len(ids), capacity, smallest):
                    packer.add(Piece((doc, len(ids)), at, ids[at : at + size]))
                    at += size
            if packer.closed:
                yield packer.taken(schema)
        packer.finish()
        if packer.closed:
            yield packer.taken(schema)

    return rows.mapInArrow(
        work, f"doc_id {kind.simpleString()}, start long, length long, ids binary, " + ", ".join(f"{c} long" for c in numbers)
    )
