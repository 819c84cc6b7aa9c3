"""Removal of long byte strings that earlier documents hold too, by a logarithmic index family.

Every window of ``length`` bytes picks one of its positions, the one whose next bytes hash
lowest, so that equal windows pick alike; the suffixes that begin at picked positions are
the sampled suffixes. The job has four steps over blocks of documents:

1. each block sends its sampled suffixes as sorted runs of keys, split by key into shards;
2. each shard takes the runs in turn as batches of a logarithmic index: a run is
   merge-scanned against the levels for keys that are there already, its new keys become
   a level, and levels of like size merge, so a key is merged O(log n) times;
3. for the keys that more than one document holds, blocks send the bytes around the
   suffix; a shard sorts all windows of these and finds those that an earlier document has;
4. blocks cut the bytes covered.

Only runs, shared suffixes and spans move; texts are written once, in blocks, and stay there.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.llm.base import mix64
from drover.session import fresh_path

LENGTH = 50
#: Bytes of a suffix that its key covers. A window has LENGTH - KEY + 1 positions to pick from.
KEY = 16
#: Bytes of text of a block, and of all text for each shard. They set the grain, not the result.
BLOCK, SHARD = 8 << 20, 8 << 20
LEAST_SHARDS = 32
#: Suffixes of one shard whose windows are sorted at a time; those of one key stay together.
SORTED = 1 << 15
#: Bytes that are hashed at a time.
PIECE = 1 << 19
NO_ID = np.iinfo(np.int64).max

_ODD = np.uint64(0xD1342543DE82EF95)
_SALT = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def picked(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, position) of every sampled suffix of concatenated texts:
    the windows of one text that pick the same position are neighbours."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none
    grams = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
    value = (mix64(grams) >> np.uint64(32)).astype(np.uint32)
    where = np.arange(len(value), dtype=np.int32)
    reach, step = length - KEY + 1, 1  # positions p .. p + reach - 1
    while True:
        shift = min(step, reach - step)
        if shift <= 0:
            break
        later = value[shift:] < value[: len(value) - shift]
        where = np.where(later, where[shift:], where[: len(where) - shift])
        value = np.minimum(value[shift:], value[: len(value) - shift])
        step += shift
    n = len(data) - length + 1
    where = where[:n]
    edge = np.zeros(n + 1, np.int64)
    valid = stops - starts >= length
    np.add.at(edge, starts[valid], 1)
    np.add.at(edge, stops[valid] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:n]))
    if not len(at):
        return none, none, none
    chosen = where[at]
    new = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    return at[new], at[np.append(new[1:], len(at)) - 1], chosen[new].astype(np.int64)


def keys(data: np.ndarray, positions: np.ndarray) -> np.ndarray:
    grams = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
    return mix64(mix64(grams[positions] + np.uint64(0x632BE59BD9B4E019)) ^ (grams[positions + 8] * _ODD))


class LogIndex:
    """Sorted levels of keys with the batch that brought each; batches come in any order."""

    def __init__(self):
        self.levels: list[list[np.ndarray]] = []  # [keys, batch, told], large levels first

    def add(self, run: np.ndarray, batch: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Merge-scan an ascending run of distinct keys against the levels, then take in its new
        keys. Returns the keys that were there, and those of them that other batches
        brought and have not yet been told of, by batch."""
        fresh = np.ones(len(run), bool)
        owners: list[tuple[int, np.ndarray]] = []
        for level, source, told in self.levels:
            at = np.searchsorted(level, run)
            at[at == len(level)] = 0
            hit = level[at] == run
            fresh &= ~hit
            at = at[hit]
            untold = at[~told[at]]
            told[untold] = True
            for b in np.unique(source[untold]):
                owners.append((int(b), level[untold[source[untold] == b]]))
        if fresh.any():
            new = run[fresh]
            self.levels.append([new, np.full(len(new), batch, np.int64), np.zeros(len(new), bool)])
            while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
                later, earlier = self.levels.pop(), self.levels.pop()
                merged = [np.concatenate((a, b)) for a, b in zip(earlier, later, strict=True)]
                order = np.argsort(merged[0], kind="stable")  # two sorted runs: one merge
                self.levels.append([x[order] for x in merged])
        return run[~fresh], owners


# --- blocks ---------------------------------------------------------------------------------


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the blocks of a partition and the rows in each."""
    block, at, size = TaskContext.get().partitionId() << 24, 0, 0
    for batch in batches:
        text = batch.column("text")
        blocks, places = [], []
        for length in np.diff(np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]).tolist():
            if at and size + length > BLOCK:
                block, at, size = block + 1, 0, 0
            blocks.append(block)
            places.append(at)
            at, size = at + 1, size + length
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int64()), pa.array(places, pa.int64()), batch.column("doc_id"), text], names=["block", "at", "doc_id", "text"])


def _texts(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each, without a copy of one by one."""
    text = table.column("text")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
        text = pa.concat_arrays(text.chunks) if isinstance(text, pa.ChunkedArray) else text
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about :data:`PIECE` bytes; a larger text is a range of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, side="right")) - 1)
        yield first, last
        first = last


def _suffixes(data: np.ndarray, offsets: np.ndarray, length: int):
    """Per range of rows: (bytes, base, row, first window, last window, key) of its sampled suffixes."""
    for first, last in _pieces(offsets):
        base = offsets[first]
        part = data[base : offsets[last]]
        bounds = offsets[first : last + 1] - base
        lo, hi, at = picked(part, bounds[:-1], bounds[1:], length)
        if len(lo):
            row = first + np.searchsorted(bounds, lo, side="right") - 1
            yield part, bounds, row, lo - bounds[row - first], hi - bounds[row - first], lo, keys(part, at)


def _split(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, 32 bits of key within it)."""
    return (key >> np.uint64(64 - bits)).astype(np.int64), ((key >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


RUN = "shard long, block long, run binary, inside binary"


def _runs(length: int, bits: int):
    """Step 1. ``inside`` are the keys that several documents of the block hold."""

    def of_block(block: int, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        code = np.concatenate([k for k, _ in found])
        row = np.concatenate([r for _, r in found])
        code = code >> np.uint64(32 - bits)  # shard and key within it in one number
        order = np.argsort(code, kind="stable")
        code, row = code[order], row[order]
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        several = np.maximum.reduceat(row, first) != np.minimum.reduceat(row, first)
        code = code[first]
        shard = (code >> np.uint64(32)).astype(np.int64)
        value = (code & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True])))
        rows = [(int(shard[a]), block, value[a:b].tobytes(), value[a:b][several[a:b]].tobytes()) for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                          names=["shard", "block", "run", "inside"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found, base = None, [], 0
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1], [True]))) if len(blocks) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if now is not None and blocks[a] != now and found:
                    yield of_block(now, found)
                    found = []
                now = int(blocks[a])
                data, offsets = _texts(batch.slice(a, b - a))
                for _, _, row, _, _, _, key in _suffixes(data, offsets, length):
                    found.append((key, row + base))
                base += b - a
        if found:
            yield of_block(now, found)

    return run


def _told(table: pa.Table) -> pa.Table:
    """Step 2, one shard: which keys each block is to send."""
    index, told = LogIndex(), {}
    rows = sorted(zip(table.column("block").to_pylist(), range(table.num_rows), strict=True))
    shard = table.column("shard")[0].as_py() if table.num_rows else 0
    for block, r in rows:
        run = np.frombuffer(table.column("run")[r].as_py(), np.uint32)
        inside = np.frombuffer(table.column("inside")[r].as_py(), np.uint32)
        hits, owners = index.add(run, block)
        told.setdefault(block, []).extend((hits, inside))
        for b, found in owners:
            told.setdefault(b, []).append(found)
    out = [(b, shard, np.unique(np.concatenate(found)).tobytes()) for b, found in told.items()]
    out = [r for r in out if r[2]]
    return pa.table({"block": pa.array([r[0] for r in out], pa.int64()), "shard": pa.array([r[1] for r in out], pa.int64()),
                     "keys": pa.array([r[2] for r in out], pa.binary())})


SENT = "shard long, block long, keys binary, ids binary, rows binary, starts binary, counts binary, bytes binary, spans binary"


def _spans(rows: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> bytes:
    return np.stack([rows, starts, stops], axis=1).astype(np.int64).tobytes()


def _expanded(length: int, bits: int):
    """Step 3a, one block: the bytes that the windows of each shared suffix cover. Of suffixes
    that are alike in all of them the least id is sent; the others are covered at once."""
    width = 2 * length - KEY

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["shard", "block", "keys", "ids", "rows", "starts", "counts", "bytes", "spans"]
        types = [pa.int64()] * 2 + [pa.binary()] * 7
        empty = pa.table([pa.array([], t) for t in types], names=names)
        if not left.num_rows or not right.num_rows:
            return empty
        left = left.sort_by("at")
        wanted = np.sort(np.concatenate([
            (np.uint64(s) << np.uint64(32)) | np.frombuffer(k, np.uint32).astype(np.uint64)
            for s, k in zip(right.column("shard").to_pylist(), right.column("keys").to_pylist(), strict=True)]))
        block = left.column("block")[0].as_py()
        ids = left.column("doc_id").fill_null(NO_ID).to_numpy()
        data, offsets = _texts(left)
        got: list[tuple] = []
        for part, bounds, row, lo, hi, at, key in _suffixes(data, offsets, length):
            code = key >> np.uint64(32 - bits)
            k = np.searchsorted(wanted, code)
            k[k == len(wanted)] = 0
            hit = np.flatnonzero(wanted[k] == code)
            if not len(hit):
                continue
            count = (hi - lo + 1)[hit]
            a = at[hit]
            inside = np.minimum(a[:, None] + np.arange(width), len(part) - 1)
            content = part[inside]
            content[np.arange(width)[None, :] >= (count + length - 1)[:, None]] = 0
            got.append((code[hit], row[hit], lo[hit], count, content))
        if not got:
            return empty
        code, row, lo, count = (np.concatenate([g[i] for g in got]) for i in range(4))
        content = np.concatenate([g[4] for g in got])
        own = ids[row]
        # Alike: same key, number of windows and bytes.
        same = code.copy()
        for k in range(0, width, 4):
            word = np.zeros(len(same), np.uint64)
            for j in range(k, min(k + 4, width)):
                word = (word << np.uint64(8)) | content[:, j]
            same = mix64(same * _ODD + word + np.uint64(k + 1))
        same = mix64(same + count.astype(np.uint64))
        order = np.lexsort((own, same))
        first = np.flatnonzero(np.concatenate(([True], same[order][1:] != same[order][:-1])))
        least = np.empty(len(same), np.int64)
        least[order] = np.repeat(own[order][first], np.diff(np.append(first, len(order))))
        later = own > least
        shard = (code >> np.uint64(32)).astype(np.int64)
        rows = []
        if later.any():
            spans = _spans(row[later], lo[later], lo[later] + count[later] + length - 1)
            rows.append((int(shard[later][0]), block, b"", b"", b"", b"", b"", b"", spans))
        keep = np.flatnonzero(~later)
        keep = keep[np.argsort(shard[keep], kind="stable")]
        cuts = np.flatnonzero(np.concatenate(([True], shard[keep][1:] != shard[keep][:-1], [True])))
        for a, b in zip(cuts, cuts[1:], strict=False):
            s = keep[a:b]
            rows.append((int(shard[s[0]]), block, code[s].tobytes(), own[s].tobytes(), row[s].astype(np.int32).tobytes(),
                         lo[s].astype(np.int64).tobytes(), count[s].astype(np.uint8).tobytes(), pa.compress(content[s].tobytes(), codec="zstd", asbytes=True), b""))
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return run


def _resolved(length: int):
    """Step 3b, one shard: sort all windows, and cover those that a smaller id has too."""
    width = 2 * length - KEY
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(width, _ODD))), dtype=np.uint64)
    inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
    unpower = np.cumprod(np.concatenate(([np.uint64(1)], np.full(width, inverse))), dtype=np.uint64)

    def windows(content: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, suffix, place) of every window."""
        prefix = np.zeros((len(content), width + 1), np.uint64)
        np.cumsum(_SALT[content] * power[:width], axis=1, out=prefix[:, 1:])
        hashes, entry, place = [], [], []
        for i in range(int(counts.max())):
            has = np.flatnonzero(counts > i)
            hashes.append((prefix[has, i + length] - prefix[has, i]) * unpower[i])
            entry.append(has)
            place.append(np.full(len(has), i))
        return mix64(np.concatenate(hashes)), np.concatenate(entry), np.concatenate(place)

    def covered(key, ids, counts, content) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(suffix, first place, last place) of neighbouring windows that a smaller id has too."""
        hashes, entry, place = windows(content, counts)
        order = np.lexsort((key[entry], hashes))
        # Equal hash and equal key: 64 bits of the window and 32 and more of the suffix in it.
        new = np.flatnonzero(np.concatenate(([True], (np.diff(hashes[order]) != 0) | (np.diff(key[entry[order]]) != 0))))
        own = ids[entry[order]]
        least = np.repeat(np.minimum.reduceat(own, new), np.diff(np.append(new, len(order))))
        found = order[own > least]
        found = found[np.lexsort((place[found], entry[found]))]
        e, i = entry[found], place[found]
        if not len(e):
            return e, i, i
        begin = np.flatnonzero(np.concatenate(([True], (e[1:] != e[:-1]) | (i[1:] != i[:-1] + 1))))
        return e[begin], i[begin], i[np.append(begin[1:], len(e)) - 1]

    def run(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_pylist()
        out = [(b, s) for b, s in zip(blocks, table.column("spans").to_pylist(), strict=True) if s]
        load = lambda name, kind: [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
        parts = load("keys", np.uint64)
        source = np.repeat(np.arange(len(parts)), [len(k) for k in parts])
        if len(source):
            key = np.concatenate(parts)
            ids, rows, starts, counts = (
                np.concatenate(load(n, t)) for n, t in (("ids", np.int64), ("rows", np.int32), ("starts", np.int64), ("counts", np.uint8)))
            content = np.concatenate([
                np.frombuffer(pa.decompress(c, len(k) * width, codec="zstd"), np.uint8).reshape(-1, width)
                for c, k in zip(table.column("bytes").to_pylist(), parts, strict=True) if len(k)])
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
            ends = np.append(first[1:], len(order))
            found, at = [], 0
            while at < len(order):
                stop = int(ends[min(np.searchsorted(ends, at + SORTED), len(ends) - 1)])
                part = order[at:stop]
                e, low, high = covered(key[part], ids[part], counts[part], content[part])
                found.append((part[e], low, high))
                at = stop
            who, low, high = (np.concatenate(x) for x in zip(*found, strict=True))
            spans = np.stack([rows[who], starts[who] + low, starts[who] + high + length], axis=1).astype(np.int64)
            where = source[who]
            for s in np.unique(where):
                out.append((blocks[s], spans[where == s].tobytes()))
        return pa.table({"block": pa.array([r[0] for r in out], pa.int64()), "spans": pa.array([r[1] for r in out], pa.binary())})

    return run


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string, spans array<struct<start:bigint,end:bigint>>"


def _removed(with_text: bool):
    """Step 4, one block."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("at")
        data, offsets = _texts(left)
        found = [np.frombuffer(s, np.int64).reshape(-1, 3) for s in right.column("spans").to_pylist()]
        spans = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
        ends = np.searchsorted(spans[:, 0], np.arange(left.num_rows + 1))
        out = []
        for i in range(left.num_rows):
            text = data[offsets[i] : offsets[i + 1]]
            own = spans[ends[i] : ends[i + 1]]
            merged: list[list[int]] = []
            for _, a, b in own.tolist():
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            kept = b"".join(text[a:b].tobytes() for a, b in zip([0, *(m[1] for m in merged)], [*(m[0] for m in merged), len(text)], strict=True)) \
                if merged else text.tobytes()
            out.append((len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(),
                        kept.decode("utf-8", "ignore") if with_text else None, [{"start": a, "end": b} for a, b in merged]))
        columns = [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), span))]
        return pa.table([left.column("doc_id").cast(pa.int64()), *columns],
                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "spans"])

    return run


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, text, spans) for every row.

    A byte goes if a string of ``length`` bytes that covers it also begins in a row with a
    smaller key; strings are judged on the texts as given, as UTF-8, and never reach from
    one text into another. ``spans`` are the maximal removed runs in bytes, ``text`` is what
    is left (bytes of a character that is cut in two are left out of it, not of the hash);
    it is null where ``with_text`` is false. Keys must be integers; a null key counts as larger
    than all others. Null texts are empty. Rows that repeat a key do not remove each other's bytes.
    """
    if not KEY + 8 <= length <= 255:
        raise ValueError(f"length must lie between {KEY + 8} and 255")
    spark = df.sparkSession
    thin = df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = int(str(thin._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if total >= 1 << 50:  # the planner does not know
        total = int(thin.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    shards = max(LEAST_SHARDS, 1 << (total // SHARD).bit_length())
    bits = shards.bit_length() - 1
    buckets = min(100_000, max(16, total // BLOCK))
    name = f"drover_blocks_{uuid.uuid4().hex}"
    cut = thin.mapInArrow(_cut, "block long, at long, doc_id long, text string")
    # Bucketed by block: the two steps that bring findings back to the texts move only the findings.
    cut.write.bucketBy(buckets, "block").sortBy("block").option("path", fresh_path(spark, "blocks")).option("compression", "zstd").saveAsTable(name)
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay, and the frame has read what it needs of the catalog
    runs = blocks.mapInArrow(_runs(length, bits), RUN)
    told = runs.groupBy("shard").applyInArrow(_told, "block long, shard long, keys binary")
    sent = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_expanded(length, bits), SENT)
    spans = sent.groupBy("shard").applyInArrow(_resolved(length), "block long, spans binary")
    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(_removed(with_text), RESULT)
