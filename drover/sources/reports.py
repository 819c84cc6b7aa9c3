"""Free-text auction reports to lots, without a shuffle.

A report stays in one row. It is cut at the first line that ends the feeder part, split
at its class headers, and each block keeps the run of data lines right after the header.
A blank line or any other line ends the run, so later look-alikes are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drover.config import FEEDER

# The wording of the reports.
LINE_BREAK = r"[\r\x0b\x0c\x1c\x1d\x1e\u0085\u2028\u2029]"
SALE_DATE = r"Feeder Cattle Weighted Average\s+(?:Report\s+)?for\s+(\d{1,2})/(\d{1,2})/(\d{2,4})"
FILE_DATE = r"(?i)CV_LS750(\d{4})(\d{2})(\d{2})"
RECEIPTS = r"(?m)^\s*Receipts:\s*([\d,]+)"
END_OF_FEEDERS = (
    r"(?m)^[^\S\n]*(?:Slaughter[^\S\n]+Cows:|Slaughter[^\S\n]+Bulls:|Replacement[^\S\n]+Cows:"
    r"|Cow/Calf[^\S\n]+Pairs:|Holstein[^\S\n]*:|Source:|#[^\S\n])"
)
HEADER = (
    r"(?m)^[^\S\n]*Feeder[^\S\n]+(Holstein[^\S\n]+)?(Steers|Heifers|Bulls)[^\S\n]+"
    r"(Medium and Large|Large)[^\S\n]+(1-2|1|2|3)[^\S\n]*$"
)
# Blank lines and one column-heading line may stand between a header and its data.
AFTER_HEADER = (
    r"^\s*(?:Head[^\S\n]+Wt Range[^\S\n]+Avg Wt[^\S\n]+Price Range[^\S\n]+Avg Price[^\n]*\n?)?"
)
DATA_LINE = (
    r"^\s*(\d+)\s+(\d+(?:\.\d+)?(?:-\d+(?:\.\d+)?)?)\s+(\d+(?:\.\d+)?)"
    r"\s+(\d+\.\d+(?:-\d+\.\d+)?)\s+(\d+\.\d+)\s*(.*)$"
)


def sale_date(text: Column, file_name: Column | None = None) -> Column:
    """Date from the prose (two-digit years are 2000s), else from the file name."""
    part = lambda i: F.regexp_extract(text, SALE_DATE, i).try_cast("int")
    year = F.when(part(3) < 100, part(3) + 2000).otherwise(part(3))
    found = F.try_make_timestamp(year, part(1), part(2), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    if file_name is None:
        return found
    named = F.to_date(F.nullif(F.concat(*[F.regexp_extract(file_name, FILE_DATE, i) for i in (1, 2, 3)]), F.lit("")), "yyyyMMdd")
    return F.coalesce(found, named)


def _range_edge(token: Column, last: bool) -> Column:
    return F.element_at(F.split(token, "-"), -1 if last else 1).cast("double")


def lot_columns(rows: DataFrame, vintage: Column | str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed lots of data lines ``_line`` with the columns that their report and header give."""
    rows = rows.withColumn("_f", F.split(F.ltrim("_line"), r"\s+", 5))
    cell = lambda i: F.get("_f", i - 1)
    tail = lambda i: F.regexp_extract(cell(5), r"^(\d+\.\d+)\s*(.*)$", i)
    nothing = F.lit(None).cast("double")
    return rows.select(
        *keep,
        "auction_date",
        F.lit(FEEDER).alias("commodity"),
        "class", "frame", "muscle_grade",
        _range_edge(cell(2), False).cast("int").alias("weight_break_low"),
        _range_edge(cell(2), True).cast("int").alias("weight_break_high"),
        cell(3).cast("double").alias("avg_weight"),
        nothing.alias("avg_weight_min"),
        nothing.alias("avg_weight_max"),
        cell(1).cast("int").alias("head_count"),
        _range_edge(cell(4), False).alias("price_low"),
        _range_edge(cell(4), True).alias("price_high"),
        tail(1).cast("double").alias("price_avg"),
        "receipts",
        F.lit(vintage).cast("date").alias("vintage"),
        "breed",
        F.trim(tail(2)).alias("annotation"),
    )


def parse_reports(
    reports: DataFrame, vintage: Column | str, text: str = "value", file_name: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Lots of every report. A report with no date at all fails the job."""
    body = F.replace(F.col(text), F.lit("\r\n"), F.lit("\n"))
    body = F.when(body.rlike(LINE_BREAK), F.regexp_replace(body, LINE_BREAK, "\n")).otherwise(body)
    name = F.col(file_name) if file_name else None
    undated = F.raise_error(F.lit("report has no sale date")).cast("date")
    feeders = F.split(F.col("_text"), END_OF_FEEDERS, 2)[0]
    cut = (
        reports.withColumn("_text", body)
        .withColumns({
            "auction_date": F.coalesce(sale_date(F.col("_text"), name), undated),
            "receipts": F.regexp_replace(F.regexp_extract("_text", RECEIPTS, 1), ",", "").try_cast("int"),
            "_feeders": feeders,
        })
    )
    parted = cut.withColumns({
        "_headers": F.regexp_extract_all(F.col("_feeders"), F.lit(HEADER), F.lit(0)),
        # The text before the first header is no block.
        "_bodies": F.slice(F.split("_feeders", HEADER), 2, 2**31 - 1),
    })
    # Zipped inside the generator: exploding a plain column would make the planner test
    # its size in a filter below and run all the expressions above a second time.
    blocks = parted.select(
        *keep, "auction_date", "receipts", F.inline(F.arrays_zip("_headers", "_bodies")).alias("_header", "_body")
    )
    head = lambda i: F.regexp_extract("_header", HEADER, i)
    # Staged so that each block is split once and each header is read once per block.
    staged = blocks.select(
        *keep, "auction_date", "receipts",
        head(2).alias("class"), head(3).alias("frame"), head(4).alias("muscle_grade"),
        F.when(head(1) != "", "Holstein").otherwise("Beef").alias("breed"),
        F.split(F.regexp_replace("_body", AFTER_HEADER, ""), "\n").alias("_lines"),
    ).withColumn("_stop", F.array_position(F.transform("_lines", lambda x: x.rlike(DATA_LINE)), False))
    live = F.when(F.col("_stop") == 0, F.col("_lines")).otherwise(
        F.slice("_lines", 1, F.greatest(F.col("_stop").cast("int") - 1, F.lit(0)))
    )
    return lot_columns(staged.withColumn("_line", F.explode(live)), vintage, keep)


def read_reports(spark: SparkSession, path: str, vintage: Column | str) -> DataFrame:
    """Lots of all report files under ``path``, one row per file before parsing."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), "value")
    return parse_reports(files, vintage, file_name="file_name", keep=("file_name",))
