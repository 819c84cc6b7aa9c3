"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language on the cluster; the log-probability matrix, of a
fixed number of buckets per language, is broadcast; scoring multiplies the sparse counts
of a batch of texts with the matrix in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.llm.base import extended, schema_of, text_column

BUCKETS = 1 << 15
ORDERS = (2, 3)
#: Texts that a language gives to the training at most, on average: rows are taken by a
#: hash of their key below cap / count, so the sample is the same in every run.
TRAIN_CAP = 5_000
#: Languages beyond which training fails: the matrix that is broadcast has BUCKETS floats for each.
MOST_LANGS = 1_024
#: Additive smoothing of counts.
ALPHA = 0.5
#: Characters hashed at a time; a longer text is scored in overlapping pieces and summed.
PIECE = 1 << 20
UND = "und"
_MULT = np.uint32(0x9E3779B1)

_FOLD: np.ndarray | None = None


def _fold() -> np.ndarray:
    """Code point -> its lower case if it is a letter, else the space; built once per worker."""
    global _FOLD
    if _FOLD is None:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD = table
    return _FOLD


def folded(text: str) -> np.ndarray:
    """Letters in lower case, every run of other characters as one space, a space at both ends."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.concatenate(([np.uint32(32)], _fold()[codes], [np.uint32(32)]))
    blank = out == 32
    return out[np.concatenate(([True], ~(blank[1:] & blank[:-1])))]


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Bucket numbers of all n-grams of one order."""
    size = max(0, len(codes) - n + 1)
    h = np.full(size, n, np.uint32)
    for i in range(n):
        h = (h ^ codes[i : size + i]) * _MULT
        h ^= h >> np.uint32(15)
    return h & np.uint32(BUCKETS - 1)


def pieces(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of every n-gram of a whole text, a bounded number at a time. A piece
    reaches n - 1 characters into the next, so every n-gram is counted once."""
    codes = folded(text)
    if len(codes) < 3:  # no letter: at most the spaces at the ends
        return
    for at in range(0, len(codes), PIECE):
        for n in ORDERS:
            yield grams(codes[at : at + PIECE + n - 1], n)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, np.ndarray] = {}
    for pdf in batches:
        for text, lang in zip(pdf["text"], pdf["lang"], strict=True):
            own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for found in pieces(text):
                own += np.bincount(found, minlength=BUCKETS)
    for lang, own in counts.items():
        used = np.flatnonzero(own)
        yield pd.DataFrame({"lang": lang, "bucket": used, "n": own[used]})


class Model:
    """Languages in order and, per language, the log-probability of each bucket."""

    def __init__(self, langs: list[str], logp: np.ndarray, prior: np.ndarray):
        self.langs, self.logp, self.prior = langs, logp, prior

    def scores(self, text: str) -> np.ndarray | None:
        """Log-likelihoods of a whole text; None where it has no letter."""
        total, letters = np.zeros(len(self.langs)), False
        for found in pieces(text):
            letters = True
            # A row per language: gathers from contiguous memory, then sums in double.
            total += [row[found].sum(dtype=np.float64) for row in self.logp]
        return total + self.prior if letters else None


def train(rows: DataFrame, cap: int = TRAIN_CAP) -> Model:
    """Fit on (id, text, lang). Rows with a null text or lang are left out. ``cap`` bounds the
    expected number of texts per language. The driver receives at most one number per
    (language, bucket); more than MOST_LANGS languages are refused."""
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MOST_LANGS + 1).collect()}  # one row per language
    if len(sizes) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} values in the language column")
    if not sizes:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0))
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, cap / n)))])
    unit = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.filter(unit < F.element_at(share, F.col("lang"))).select("text", "lang")
    counted = sample.mapInPandas(_counted, "lang string, bucket int, n long")
    sums = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(sizes)
    counts = np.zeros((BUCKETS, len(langs)))
    index = {k: i for i, k in enumerate(langs)}
    at = np.array([index[k] for k in sums.column("lang").to_pylist()], np.int64)
    counts[sums.column("bucket").to_numpy(), at] = sums.column("n").to_numpy()
    smooth = counts + ALPHA
    logp = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
    n = np.array([sizes[k] for k in langs], float)
    return Model(langs, np.ascontiguousarray(logp.T), np.log(n / n.sum()))


def predict(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score``, the posterior probability of the
    predicted language. Null texts, texts without a letter, and every text where nothing
    could be learned, get ``und`` with score 0. Ties go to the first language by name."""
    shared = df.sparkSession.sparkContext.broadcast((model.langs, model.logp, model.prior))

    read, pass_on = text_column(df, keep, text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            langs, scores = [], []
            for value in batch.column(read):
                value = value.as_py()
                s = own.scores(value) if value and own.langs else None
                if s is None:
                    langs.append(UND)
                    scores.append(0.0)
                    continue
                best = int(s.argmax())
                langs.append(own.langs[best])
                scores.append(float(1 / np.exp(s - s[best]).sum()))
            yield extended(batch, keep, lang_pred=pa.array(langs, pa.string()), score=pa.array(scores, pa.float64()))

    return pass_on.mapInArrow(scored, schema_of(pass_on, keep, "lang_pred string, score double"))


def held_out(doc_id: Column) -> Column:
    """The rows kept from training: crc32 of the id as text is divisible by 5. A null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0
