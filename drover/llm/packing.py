"""Bounded-space online packing of token sequences.

Each partition keeps a fixed number of open windows. What is left of a document after its
full windows goes into the open window it fits best; when none has room the fullest is
topped up with a cut of the document and emitted. At the end of a partition the open
windows are closed up to one, and these leftovers, one per partition, are merged in
groups of partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.llm.tokens import Encoder, encoded
from drover.session import materialize

LENGTH = 2048
OPEN = 16
#: Partitions whose leftovers one task merges; at most this many windows.
MERGE = 256
#: Closes every document.
END = 1

PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Windows:
    """The open windows of one partition. Pieces are (row, start, ids, tokens of the row)."""

    def __init__(self, length: int = LENGTH, most: int = OPEN):
        self.length, self.most = length, most
        self.open: list[tuple[int, list]] = []  # (used, pieces)

    def add(self, row, ids: np.ndarray, start: int = 0, total: int | None = None) -> Iterator[list]:
        """Place the ids of a row; yields the windows that became full."""
        total = len(ids) if total is None else total
        at = 0
        while len(ids) - at >= self.length:
            yield [(row, start + at, ids[at : at + self.length], total)]
            at += self.length
        while at < len(ids):
            need = len(ids) - at
            fits = [k for k, (used, _) in enumerate(self.open) if used + need <= self.length]
            if fits:
                take, best = need, max(fits, key=lambda k: self.open[k][0])
            elif len(self.open) < self.most:
                self.open.append((0, []))
                take, best = need, len(self.open) - 1
            else:
                best = max(range(len(self.open)), key=lambda k: self.open[k][0])
                take = self.length - self.open[best][0]
            used, pieces = self.open[best]
            pieces.append((row, start + at, ids[at : at + take], total))
            self.open[best] = (used + take, pieces)
            at += take
            if used + take == self.length:
                yield self.open.pop(best)[1]

    def close(self) -> tuple[list[list], list]:
        """All open windows closed up: the full ones, and the pieces of the last, which may be empty."""
        pieces = [p for _, ps in sorted(self.open, key=lambda x: -x[0]) for p in ps]
        self.open = []
        return merged(pieces, self.length)


def merged(pieces: list, length: int) -> tuple[list[list], list]:
    """Pieces in order into full windows, cut where a window ends, and the rest."""
    full, now, used = [], [], 0
    for row, start, ids, total in pieces:
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, length - used)
            now.append((row, start + at, ids[at : at + take], total))
            at, used = at + take, used + take
            if used == length:
                full.append(now)
                now, used = [], 0
    return full, now


def _rows(windows: list[list], first: int) -> Iterator[tuple]:
    for n, pieces in enumerate(windows):
        offset = 0
        for row, start, ids, total in pieces:
            raw = ids.astype("<u4", copy=False).tobytes()
            yield row, start, len(ids), zlib.crc32(raw), total, first + n, offset, raw
            offset += len(ids)


def pack(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH,
         most: int = OPEN) -> DataFrame:
    """Pieces (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A null text is empty: its only id is :data:`END`. Every id of every row lies in one
    piece, rows that are equal are packed each on their own, a null key is kept. All
    sequences are full but the last of each group of :data:`MERGE` partitions. An empty
    table gives no rows. Ids of sequences are unique but not consecutive.

    The pieces are written once to the shared folder, so that a task that is run again
    cannot mix two ways of packing.
    """
    kind = df.schema[key].dataType
    schema = f"`{key}` {kind.simpleString()}, {PIECE}, leftover boolean, ids binary"
    names = [key, *(c.split()[0] for c in PIECE.split(", ")), "leftover", "ids"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, windows, n = None, Windows(length, most), TaskContext.get().partitionId() << 36
        key_type = None

        def emit(full: list[list], first: int, leftover: bool = False) -> pa.RecordBatch:
            cols = list(zip(*_rows(full, first), strict=True)) or [()] * 8
            flags = pa.array([leftover] * len(cols[0]), pa.bool_())
            blobs = pa.array(cols[7] if leftover else [None] * len(cols[0]), pa.binary())
            arrays = [pa.array(cols[0], key_type), *(pa.array(c, pa.int64()) for c in cols[1:7]), flags, blobs]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            encoder = encoder or Encoder(tokenizer, added=True)
            key_type = batch.column(0).type
            full: list[list] = []
            texts = (t.as_py() or "" for t in batch.column(1))
            for row, ids in zip(batch.column(0).to_pylist(), encoded(encoder, texts), strict=True):
                full += windows.add(row, np.append(ids, np.uint32(END)))
                if len(full) >= 512:
                    yield emit(full, n)
                    n += len(full)
                    full = []
            if full:
                yield emit(full, n)
                n += len(full)
        if key_type is not None:
            full, rest = windows.close()
            if full:
                yield emit(full, n)
                n += len(full)
            if rest:
                yield emit([rest], n, leftover=True)

    thin = df.select(F.col(key), F.col(text).cast("string").alias("_text"))
    pieces = materialize(thin.mapInArrow(packed, schema), "pieces")
    group = F.floor(F.shiftright("sequence_id", 36) / MERGE).cast("long")

    def merge(table: pa.Table) -> pa.Table:
        first = (1 << 62) + (table.column("_group")[0].as_py() << 36)
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        columns = (table.column(c).to_pylist() for c in (key, "start", "ids", "doc_tokens"))
        full, rest = merged([(k, s, np.frombuffer(i, "<u4"), t) for k, s, i, t in zip(*columns, strict=True)], length)
        cols = list(zip(*_rows([*full, rest] if rest else full, first), strict=True))
        out = {key: pa.array(cols[0], table.column(key).type)}
        out |= {n: pa.array(c, pa.int64()) for n, c in zip(names[1:7], cols[1:7], strict=True)}
        return pa.table(out | {"leftover": pa.array([True] * len(cols[0])), "ids": pa.nulls(len(cols[0]), pa.binary())})

    rest = pieces.filter("leftover").withColumn("_group", group)
    closed = rest.groupBy("_group").applyInArrow(merge, schema)
    return pieces.filter("NOT leftover").unionByName(closed).drop("ids", "leftover")
