"""The corpus pipeline: stages that each call one operator, from raw documents to packed sequences.

Every stage but the last returns the columns of ``documents``; its input is what its
predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from drover.llm import language, mixing, neardup, packing, pii
from drover.llm.base import WORD, ship, table, words_in
from drover.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document goes if no language is more likely than this.
LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised; those without a letter go."""
    model = language.train(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    found = language.predict(docs, model, COLUMNS)
    return found.filter((F.col("lang_pred") != language.UND) & (F.col("score") >= LANGUAGE_SCORE)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles: the one
    with the least doc_id. Rows that repeat a document under its own id count as copies."""
    found = neardup.near_duplicates(docs.select("doc_id", "text"), width=5, percent=80)
    kept = found.filter("kept").select(F.col("doc_id").alias("_id")).distinct()
    left = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    again = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang", "n_chars")
    return left.withColumn("_copy", F.row_number().over(again)).filter("_copy = 1 OR doc_id IS NULL").select(*COLUMNS)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the name of their kind."""
    masked = pii.redacted(docs.select(*COLUMNS), pii.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes. The one document of a source that
    the budget cuts gives its first words, joined by single blanks."""
    mixed = mixing.mix(docs.select(*COLUMNS), words_in(F.col("text")), mixing.random_key("doc_id"))
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    start = F.when(rest > 0, F.array_join(F.slice(words, 1, F.greatest(rest, F.lit(1))), " "))
    copies = F.concat(F.array_repeat("text", whole), F.when(rest > 0, F.array(start)).otherwise(F.array().cast("array<string>")))
    out = mixed.withColumn("text", F.explode(copies))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _shipped(stage: Stage) -> Stage:
    return lambda spark, docs, sf_dir: stage(ship(spark), docs, sf_dir)


STAGES = [
    (stage.__name__, _shipped(stage)) for stage in (language_id, near_dedup, mask_pii, mix_sources, pack)
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next begins."""
    out = table(ship(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = materialize(stage(spark, out, sf_dir), name)
    return STAGES[-1][1](spark, out, sf_dir)
