"""Headerless pipe-delimited endorsement files, plain or zipped."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drover.config import FEEDER_COMMODITY_CODE, INSURANCE_PLAN_CODE
from drover.functions.columns import integer, number, parsed_date

# The 31 columns in file order (source name, name, type).
COLUMNS = (
    ("Reinsurance Year", "reinsurance_year", "smallint"),
    ("Commodity Year", "commodity_year", "smallint"),
    ("Location State Code", "state_fips", "string"),
    ("Location State Abbreviation", "state_abbr", "string"),
    ("Location County Code", "county_fips", "string"),
    ("Location County Name", "county_name", "string"),
    ("Commodity Code", "commodity_code", "string"),
    ("Commodity Name", "commodity_name", "string"),
    ("Insurance Plan Code", "plan_code", "string"),
    ("Insurance Plan Name", "plan_name", "string"),
    ("Type Code", "type_code", "string"),
    ("Type Code Name", "type_name", "string"),
    ("Practice Code", "practice_code", "string"),
    ("Practice Code Name", "practice_name", "string"),
    ("Sales Effective Date", "effective_date", "date"),
    ("Endorsement Length", "length_weeks", "smallint"),
    ("Coverage Price", "coverage_price", "double"),
    ("Expected End Value", "expected_end_value", "double"),
    ("Coverage Level Percent", "coverage_level_pct", "double"),
    ("Rate", "rate", "double"),
    ("Cost Per Cwt", "cost_per_cwt", "double"),
    ("End Date", "end_date", "date"),
    ("Endorsements Earning Premium", "n_endorsements_earning", "bigint"),
    ("Endorsements Indemnified", "n_endorsements_indemn", "bigint"),
    ("Net Number of Head", "n_head", "int"),
    ("Total Weight", "total_weight_cwt", "double"),
    ("Subsidy Amount", "subsidy_amount", "bigint"),
    ("Total Premium Amount", "total_premium_amount", "bigint"),
    ("Producer Premium Amount", "producer_premium_amount", "bigint"),
    ("Liability Amount", "liability_amount", "bigint"),
    ("Indemnity Amount", "indemnity_amount", "bigint"),
)
FILE_NAME = r"^lrp_(\d{4})_(\d{4}-\d{2}-\d{2})\.(?:zip|txt)$"
DECLARED = [(i, src, name, kind) for i, (src, name, kind) in enumerate(COLUMNS)]


def _typed(raw: Column, kind: str) -> Column:
    present = F.when(raw != "", raw)
    if kind == "string":
        return F.trim(present)
    if kind == "date":
        return parsed_date(present, "yyyy-MM-dd")
    if kind == "double":
        return number(present)
    return integer(present, kind)


def typed(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text columns to typed columns: empty text is null, and so are numbers and dates
    that do not parse."""
    return raw.select(*keep, *[_typed(F.col(name), kind).alias(name) for _, name, kind in COLUMNS])


def parse_lines(lines: DataFrame, line: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed endorsements from text lines, without quoting. A line of the wrong width
    fails the job."""
    fields = F.split(F.col(line), r"\|", -1)
    wrong = F.raise_error(F.concat(F.lit(f"expected {len(COLUMNS)} fields: "), F.col(line))).cast("array<string>")
    checked = lines.filter(F.col(line) != "").select(
        *keep, F.when(F.size(fields) == len(COLUMNS), fields).otherwise(wrong).alias("_f")
    )
    return typed(checked.select(*keep, *[F.col("_f")[i].alias(name) for i, (_, name, _) in enumerate(COLUMNS)]), keep)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Typed endorsements of plain text files with their ``file_name``. The delimited-file
    reader splits large files across tasks and skips columns nobody asks for. A line of
    the wrong width fails the job."""
    schema = ", ".join(f"{name} string" for _, name, _ in COLUMNS) + ", _bad string"
    raw = (
        spark.read.schema(schema)
        .options(sep="|", quote="", mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
        .csv(path)
        .select("*", F.col("_metadata.file_name").alias("file_name"))
    )
    wrong = F.raise_error(F.concat(F.lit(f"expected {len(COLUMNS)} fields: "), F.col("_bad"))).cast("boolean")
    # A filter, so that the width is tested whichever columns are used later.
    return typed(raw.filter(F.when(F.col("_bad").isNull(), True).otherwise(wrong)), ("file_name",))


def feeder_policies(policies: DataFrame) -> DataFrame:
    """Feeder cattle under the price-insurance plan."""
    return policies.filter(
        (F.col("commodity_code") == FEEDER_COMMODITY_CODE) & (F.col("plan_code") == INSURANCE_PLAN_CODE)
    )


def with_file_tags(df: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Year and vintage from the file name; files with other names are skipped."""
    return df.filter(F.col(file_name).rlike(FILE_NAME)).withColumns({
        "file_year": F.regexp_extract(file_name, FILE_NAME, 1).cast("int"),
        "vintage": F.regexp_extract(file_name, FILE_NAME, 2).cast("date"),
    })


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, value) of plain text files, split across tasks by the reader."""
    return spark.read.text(path).select(F.col("_metadata.file_name").alias("file_name"), "value")


def zipped_lines(spark: SparkSession, path: str, batch: int = 20_000) -> DataFrame:
    """(file_name, value) of zip files with exactly one member each. Archives cannot be
    split, so the parallelism is the number of files; members are streamed."""

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for path, content in zip(files["path"], files["content"]):
                name = path.rsplit("/", 1)[-1]
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    members = archive.namelist()
                    if len(members) != 1:
                        raise RuntimeError(f"{name}: expected one member, found {members}")
                    with archive.open(members[0]) as raw:
                        chunk: list[str] = []
                        for text in io.TextIOWrapper(raw, encoding="utf-8", newline=""):
                            chunk.append(text.rstrip("\r\n"))
                            if len(chunk) == batch:
                                yield pd.DataFrame({"file_name": name, "value": chunk})
                                chunk = []
                        if chunk:
                            yield pd.DataFrame({"file_name": name, "value": chunk})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return files.mapInPandas(unzip, "file_name string, value string")


def corpus(lines: DataFrame, vintage: str) -> DataFrame:
    """All yearly files of one vintage as one filtered, typed table, from their lines."""
    tagged = with_file_tags(lines).filter(F.col("vintage") == F.lit(vintage).cast("date"))
    return feeder_policies(parse_lines(tagged, keep=("file_year", "vintage")))


def read_corpus(spark: SparkSession, path: str, vintage: str) -> DataFrame:
    """:func:`corpus` for a folder of plain text files."""
    tagged = with_file_tags(read_text(spark, path)).filter(F.col("vintage") == F.lit(vintage).cast("date"))
    return feeder_policies(tagged).drop("file_name")
