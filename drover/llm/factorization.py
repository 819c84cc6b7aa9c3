"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector: one bucket per distinct word, weighted by its logarithmic count and
scaled to unit length, one per binned statistic of its structure, and one for the
binned ``n_chars`` column. The score is the logistic of a linear part plus all pairwise
interactions of low rank, found in linear time: for each factor, half of the square of
the sum less the sum of the squares.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.llm.base import extended, schema_of, text_column
from drover.llm.quality import MEASURES, measure

WORD_BUCKETS = 1 << 14
#: Bins of a statistic, and the number of statistics with the metadata column.
BINS, STATISTICS = 24, 13
BUCKETS = WORD_BUCKETS + BINS * STATISTICS
RANK = 8
#: Labelled documents that the fit sees at most.
TRAIN_CAP = 8_000
EPOCHS, BATCH, RATE, SHRINK, SEED = 8, 256, 0.1, 1e-4, 7
#: Distinct words whose buckets a task remembers.
REMEMBERED = 1 << 18


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = bucket = zlib.crc32(word) & (WORD_BUCKETS - 1)
        return bucket


def _size_bin(n: int) -> int:
    return min(BINS - 1, int(2 * math.log2(n + 1)))


def _share_bin(part: int, whole: int) -> int:
    """Bins grow with the square root, so that small shares are told apart. The last bin is for nothing at all."""
    return BINS - 1 if whole <= 0 else min(BINS - 2, math.ceil((BINS - 2) * math.sqrt(part / whole)))


def structure(text: str | None, n_distinct: int, n_chars: int | None) -> list[int]:
    """Buckets of the statistics of a whole text and of the metadata column, one each."""
    m = dict(zip(MEASURES, measure(text), strict=True))
    words, chars, lines = m["n_words"], m["word_chars"], m["n_lines"]
    size = len(text or "")
    bins = (
        _size_bin(words), _size_bin(lines), _share_bin(m["n_symbols"], chars), _share_bin(m["n_dup_lines"], lines),
        _share_bin(m["n_repeat_words"], words), _share_bin(m["n_upper"], m["n_letters"]), _share_bin(m["n_top_word"], words),
        _share_bin(m["n_stutter"], words), _share_bin(m["n_letters"], chars), _share_bin(n_distinct, words),
        min(BINS - 1, 2 * chars // max(1, words)), _share_bin(size - chars, size),
        BINS - 1 if n_chars is None else min(BINS - 2, int(math.log2(max(0, n_chars) + 1))),
    )
    return [WORD_BUCKETS + i * BINS + b for i, b in enumerate(bins)]


def features(text: str | None, n_chars: int | None, buckets: dict) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and weights of a whole document; null counts as empty."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    found, counts = np.unique(np.fromiter(map(buckets.__getitem__, words), np.int32, len(words)), return_counts=True)
    weight = 1 + np.log(counts)
    if len(weight):
        weight /= np.sqrt((weight**2).sum())
    told = structure(text, len(found), n_chars)
    return np.concatenate((found, np.array(told, np.int32))), np.concatenate((weight, np.ones(len(told)))).astype(np.float32)


class Machine:
    """Bias, weight of every bucket, and ``RANK`` factors of every bucket."""

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.linear, self.factors = bias, linear, factors

    def margins(self, starts: np.ndarray, index: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score before the logistic, and sums of factors, of documents whose features begin at ``starts``."""
        weighted = self.factors[index] * value[:, None]
        sums = np.add.reduceat(weighted, starts)
        pairs = 0.5 * (sums**2 - np.add.reduceat(weighted**2, starts)).sum(axis=1)
        return self.bias + np.add.reduceat(self.linear[index] * value, starts) + pairs, sums


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gradients(machine: Machine, starts, index, value, label) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean gradient of the logistic loss by bias, weights and factors."""
    margin, sums = machine.margins(starts, index, value)
    error = (logistic(margin) - label) / len(label)
    owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(index))))
    own = error[owner] * value
    by_factor = own[:, None] * (sums[owner] - machine.factors[index] * value[:, None])
    total = lambda x: np.bincount(index, x, len(machine.linear))
    return float(error.sum()), total(own), np.stack([total(by_factor[:, f]) for f in range(by_factor.shape[1])], axis=1)


def fit(docs: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> Machine:
    """AdaGrad over the features of a bounded table; the same rows in the same order give the same machine."""
    rng = np.random.default_rng(SEED)
    machine = Machine(0.0, np.zeros(BUCKETS), np.zeros((BUCKETS, RANK)))
    if not docs:
        return machine
    machine.factors = rng.normal(0, 0.05, (BUCKETS, RANK))
    seen = [1e-6, np.full(BUCKETS, 1e-6), np.full((BUCKETS, RANK), 1e-6)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for at in range(0, len(docs), BATCH):
            some = order[at : at + BATCH]
            sizes = np.array([len(docs[i][0]) for i in some])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            index = np.concatenate([docs[i][0] for i in some])
            value = np.concatenate([docs[i][1] for i in some]).astype(np.float64)
            g = gradients(machine, starts, index, value, label[some])
            used = np.unique(index)
            seen[0] += g[0] ** 2
            machine.bias -= RATE * g[0] / math.sqrt(seen[0])
            for now, grad, past in ((machine.linear, g[1], seen[1]), (machine.factors, g[2], seen[2])):
                step = grad[used] + SHRINK * now[used]
                past[used] += step**2
                now[used] -= RATE * step / np.sqrt(past[used])
    return machine


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets = _Buckets()
    for batch in batches:
        rows = [features(t, n, buckets) for t, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float32()))],
            names=["place", "index", "value"],
        )


def train(docs: DataFrame, labels: DataFrame, cap: int = TRAIN_CAP) -> Machine:
    """Fit on at most ``cap`` documents, taken by a hash of the id: ``docs`` has doc_id, text and
    n_chars, ``labels`` doc_id and label (0 or 1, null rows are left out; of several the greatest
    holds). The driver receives their features, at most one number per bucket each."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    place = F.xxhash64("doc_id", F.lit(SEED))
    picked = known.select("doc_id", "label", place.alias("place")).orderBy("place", "doc_id").limit(cap)
    # At most cap rows are broadcast; a repeated doc_id may still match more documents.
    met = docs.select("doc_id", "text", F.col("n_chars").cast("long").alias("n_chars")).join(F.broadcast(picked), "doc_id")
    order = F.struct("place", "doc_id", F.xxhash64("text").alias("text"), F.col("label").cast("int").alias("label"))
    rows = met.select(order.alias("place"), "text", "n_chars").mapInArrow(
        _featured, "place struct<place: long, doc_id: long, text: long, label: int>, index array<int>, value array<float>"
    )
    table = rows.orderBy("place").limit(cap).toArrow()
    label = np.array([p["label"] for p in table.column("place").to_pylist()], np.float64)
    lists = [[np.asarray(x.values) for x in table.column(c)] for c in ("index", "value")]
    return fit(list(zip(*lists, strict=True)), label)


def predict(df: DataFrame, machine: Machine, keep: list[str], text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``keep`` columns with ``score``, the probability of label 1, and ``predicted``, 1 from 0.5 on.
    Null and empty texts are scored by their structure; without labels every score is 0.5.
    The machine of BUCKETS x (RANK + 1) numbers is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast((machine.bias, machine.linear, machine.factors))
    count = "_chars"
    while count in df.columns:
        count += "_"
    wide = df.withColumn(count, F.col(n_chars).cast("long"))
    read, thin = text_column(wide, [*keep, count], text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, buckets = Machine(*shared.value), _Buckets()
        for batch in batches:
            rows = [features(t.as_py(), n, buckets) for t, n in zip(batch.column(read), batch.column(count).to_pylist(), strict=True)]
            score = np.zeros(0)
            if rows:
                starts = np.concatenate(([0], np.cumsum([len(r[0]) for r in rows])[:-1]))
                value = np.concatenate([r[1] for r in rows]).astype(np.float64)
                score = logistic(own.margins(starts, np.concatenate([r[0] for r in rows]), value)[0])
            yield extended(batch, keep, score=pa.array(score, pa.float64()), predicted=pa.array((score >= 0.5).astype(np.int32), pa.int32()))

    return thin.mapInArrow(scored, schema_of(thin, keep, "score double, predicted int"))


def held_out(doc_id: Column) -> Column:
    """The rows kept from training: crc32 of the id as text leaves 1 by 3. A null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1
