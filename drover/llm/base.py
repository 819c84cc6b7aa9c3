"""What the operators share: reading tables, the word pattern, registration of queries, hashing in numpy."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import drover

# Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: Rows in an Arrow batch. It bounds what a Python worker holds of the texts at a time.
ROWS_PER_BATCH = "500"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, as ``--py-files`` would; once per application. Rows
    here are whole texts, so Arrow batches are held to fewer of them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(drover.__file__).parent
        target = Path(tempfile.mkdtemp(prefix="drover-")) / "drover.zip"  # read by the driver only, which serves it
        with zipfile.ZipFile(target, "w") as z:
            for path in sorted(root.rglob("*.py")):
                z.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)
    return spark


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(ship(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_in(text: Column) -> Column:
    """Number of words of a text as a long; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_column(df: DataFrame, keep: list[str], text: str) -> tuple[str, DataFrame]:
    """The columns an Arrow function needs, with the text once: its name there, and the frame."""
    if text in keep:
        return text, df.select(*keep)
    name = "_text"
    while name in keep:
        name += "_"
    return name, df.select(*keep, F.col(text).cast("string").alias(name))


def schema_of(df: DataFrame, keep: list[str], more: str) -> str:
    new = {x.split()[0] for x in more.split(", ")}
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep and f.name not in new), more])


def extended(batch: pa.RecordBatch, keep: list[str], **more: pa.Array) -> pa.RecordBatch:
    """The kept columns of a batch and new ones, which replace any of the same name."""
    own = [n for n in keep if n not in more]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in own), *more.values()], names=[*own, *more])


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PieceHash:
    """64-bit hashes of pieces of a sequence of symbols: a polynomial modulo each of two primes.

    Modulo a power of two some long words, such as those of Thue and Morse, share their hash for
    any base; modulo a prime no such family is known ahead. The primes are below 2 ** 32, so
    that every product is exact.
    """

    PRIMES = (np.uint64(4294967291), np.uint64(4294967279))
    BASES = (0x9E3779B1, 0x85EBCA6B)

    def __init__(self, symbols: int):
        salts = mix64(np.arange(1, 2 * symbols + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, symbols)
        self.salts = [s % (p - np.uint64(1)) + np.uint64(1) for s, p in zip(salts, self.PRIMES, strict=True)]
        self.powers = [np.ones(1, np.uint64) for _ in self.PRIMES]
        self.inverse = [np.ones(1, np.uint64) for _ in self.PRIMES]

    def _reach(self, n: int) -> None:
        for k, (p, base) in enumerate(zip(self.PRIMES, self.BASES, strict=True)):
            for tables, step in ((self.powers, base), (self.inverse, pow(base, -1, int(p)))):
                while len(tables[k]) < n:
                    ahead = np.uint64(pow(step, len(tables[k]), int(p)))
                    tables[k] = np.concatenate((tables[k], tables[k] * ahead % p))

    def __call__(self, codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The hash of codes[start:stop] for each pair."""
        self._reach(len(codes))
        out = []
        for p, salt, power, inverse in zip(self.PRIMES, self.salts, self.powers, self.inverse, strict=True):
            terms = salt[codes] * power[: len(codes)] % p
            sums = np.concatenate(([np.uint64(0)], np.cumsum(terms, dtype=np.uint64)))  # below 2 ** 64 for 2 ** 32 symbols
            out.append((sums[stops] - sums[starts]) % p * inverse[starts] % p)
        return out[0] << np.uint64(32) | out[1]
