"""Report files of any length to lots: a segmented scan over lines.

The row-wise parser holds a report in one value. Here the text reader splits a file by bytes, and
what a line needs from the lines before it is found in two steps: within a split by one pass over
Arrow batches in the order of the reader, and across splits by windows over one row per split, which
carries the last header, the kinds of the first and last line and whether the run of data lines
has ended. A file may also come in volumes (:mod:`drover.sources.volumes`), whose splits follow one
another. The result equals that of :func:`drover.sources.reports.parse_reports` on the whole
file, except that the date and the receipts may be broken over two lines, not more.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from drover.session import materialize
from drover.sources import reports as R
from drover.sources import volumes as V

#: Kinds of lines.
KINDS = HEAD, DATA, BLANK, TITLE, OTHER = "head", "data", "blank", "title", "other"
# What may follow what, so that a data line counts: blank lines and one title line may
# stand between a header and its data, and nothing may stand between data lines.
_MAY_FOLLOW = ((HEAD, BLANK), (HEAD, TITLE), (HEAD, DATA), (BLANK, BLANK), (BLANK, TITLE), (BLANK, DATA), (TITLE, DATA), (DATA, DATA))
_TITLE_LINE = r"^\s*Head[^\S\n]+Wt Range[^\S\n]+Avg Wt[^\S\n]+Price Range[^\S\n]+Avg Price"
# Texts without which the patterns for date and receipts cannot match a line.
_DATE_MARK, _RECEIPT_MARK = "Feeder Cattle Weighted Average", "Receipts:"
# The characters of R.LINE_BREAK.
_LINE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\u0085\u2028\u2029"
_SPLIT = ["source", "block"]
_PLACE = ["volume", "block", "place"]


def _source() -> Column:
    """A number for the file or volume being read, as its path is too long to go with every line."""
    return F.xxhash64(F.input_file_name()).alias("source")


def files(spark: SparkSession, path: str, volumes: str | None = None) -> DataFrame:
    """One row per file or volume: its number, the file it belongs to, and its place in that."""
    listed = spark.read.format("binaryFile").load(path)  # of a file not asked for its content, nothing is read
    at, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    return listed.select(_source(), V.whole(at, volumes).alias("file"), V.whole(name, volumes).alias("file_name"), V.number(name, volumes).alias("volume"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with the number of its file and the split it was read in."""
    return spark.read.text(path).select(_source(), F.input_file_block_start().alias("block"), "value")


def _may_follow(before: Column, kind: Column) -> Column:
    return F.concat_ws(">", before, kind).isin(*[f"{a}>{b}" for a, b in _MAY_FOLLOW])


#: Text that a task reads at least, where it is cut smaller: splits one after the other, each by itself. Else
#: every tiny split would leave a file.
TASK_BYTES = 32 << 20
# What :func:`scanned` gives, column by column.
_SCANNED = (
    "source bigint, block bigint, place bigint, line string, kind string, fact boolean, "
    "header string, broken boolean, first boolean, next string, last boolean"
)


def _scan() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The Arrow step of :func:`scanned`: a function inside, which travels to the executors by value. It
    holds one batch, and of the lines before it the last one with its header."""
    kinds, marks, end_line = KINDS, (_DATE_MARK, _RECEIPT_MARK), R.END_OF_FEEDERS
    data_line, blank_line, header_line, title_line = R.DATA_LINE, r"^\s*$", R.HEADER, _TITLE_LINE
    may_follow = np.array([[(a, b) in _MAY_FOLLOW for b in kinds] for a in kinds])
    names = [c.split()[0] for c in _SCANNED.split(", ")]
    plain = lambda column: column.to_numpy(zero_copy_only=False)
    # Bytes are matched, whatever their encoding: the patterns are in ASCII but for the breaks.
    has = lambda line, pattern: plain(pc.match_substring_regex(line.view(pa.binary()), pattern))
    breaks = "|".join("".join(f"\\x{b:02x}" for b in c.encode()) for c in _LINE_BREAKS)

    def parted(value, *others):
        """The lines of the reader cut at the other line breaks, too, each with its ``others``."""
        broken = has(value, breaks)
        if not broken.any():
            return value, *others
        parts = [re.split(breaks.encode(), v) for v in value.view(pa.binary()).filter(pa.array(broken)).to_pylist()]
        counts = np.ones(len(value), np.int64)
        counts[broken] = [len(p) for p in parts]
        rows = np.repeat(np.arange(len(value)), counts)
        line = pc.replace_with_mask(value.view(pa.binary()).take(pa.array(rows)), pa.array(broken[rows]), pa.array([x for p in parts for x in p], pa.binary()))
        return line.view(pa.string()), *(x[rows] for x in others)

    def coded(line):
        """Place in ``kinds`` of every line."""
        code = np.select([has(line, data_line), has(line, blank_line)], [kinds.index("data"), kinds.index("blank")], -1)
        rest = code < 0
        left = line.filter(pa.array(rest))
        code[rest] = np.select([has(left, header_line), has(left, title_line)], [kinds.index("head"), kinds.index("title")], kinds.index("other"))
        return code

    def kept(table, last):
        """Of the first rows, as many as ``last`` tells about, those that stay. The line after is asked
        for only where a fact may go on in it."""
        n = len(last)
        rows = table[:n]
        code, fact, first, broken = (rows[c].to_numpy() for c in ("code", "fact", "first", "broken"))
        rows = rows.append_column("kind", pa.array(kinds).take(pa.array(code))).append_column("last", pa.array(last))
        rows = rows.append_column("next", table["line"].take(pa.array(np.arange(1, n + 1), mask=last | ~fact)))
        stays = ((code == 1) & ~broken) | fact | first | last
        return rows.select(names).filter(pa.array(stays)).combine_chunks().to_batches()

    def scan(batches):
        held, header, was_broken, seen = None, None, False, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            line, source, block = parted(batch.column("value"), *(plain(batch.column(c)) for c in ("source", "block")))
            code, fact = coded(line), has(line, end_line)
            for mark in marks:
                fact = fact | plain(pc.match_substring(line.view(pa.binary()), mark))
            same = np.empty(len(code), bool)
            same[0] = held is not None and held["source"][0].as_py() == source[0] and held["block"][0].as_py() == block[0]
            same[1:] = (block[1:] == block[:-1]) & (source[1:] == source[:-1])
            before = np.append(held["code"][0].as_py() if same[0] else 0, code[:-1])
            # Places of the last start of a split (-1: in an earlier batch), header, and line that ended a run. A line that
            # may not follow the one before ends the run; the first line of a split is judged later.
            at, is_head = np.arange(len(code)), code == 0
            latest = lambda flags: np.maximum.accumulate(np.where(flags, at, -1))  # noqa: B023, E731
            start, head, end = latest(~same), latest(is_head), latest(~is_head & same & ~may_follow[before, code])
            own, goes_on = head >= np.maximum(start, 0), start < 0
            broken = np.where(own, end > head, (end >= np.maximum(start, 0)) | (goes_on & was_broken))
            known = pa.concat_arrays([line, pa.array([header], pa.string())])
            headers = known.take(pa.array(np.where(own, head, len(code)), mask=~own & ~goes_on))
            place = seen + at
            seen += len(at)
            table = pa.table({
                "source": source, "block": block, "place": place, "line": line, "code": code, "fact": fact, "header": headers, "broken": broken, "first": ~same,
            })
            table = table if held is None else pa.concat_tables([held, table])
            if table.num_rows > 1:
                yield from kept(table, table["first"].to_numpy()[1:])
            held, header, was_broken = table[-1:], headers[-1].as_py(), bool(broken[-1])
        if held is not None:
            yield from kept(held, np.array([True]))

    return scan


def scanned(spark: SparkSession, path: str) -> DataFrame:
    """What each split tells by itself, in the order in which it is read, without a shuffle or a sort:
    of the lines those that may be live data, may hold a fact of the report, or stand at an end of the split."""
    size = int(str(spark.read.text(path)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return lines(spark, path).mapInArrow(_scan(), _SCANNED).coalesce(max(32, size // TASK_BYTES))


def _across(told: DataFrame, found: DataFrame) -> DataFrame:
    """One row per split: its file and place there, the header that holds where it begins, whether the run after that has
    ended by then or ends with its first line, and the first line of the split after it."""
    ends = told.filter("first OR last").groupBy(*_SPLIT).agg(
        F.max(F.when(F.col("first"), F.col("kind"))).alias("first_kind"), F.max(F.when(F.col("last"), F.col("kind"))).alias("last_kind"),
        F.max(F.when(F.col("first"), F.col("line"))).alias("first_line"), F.max(F.when(F.col("last"), F.col("header"))).alias("own_header"),
        F.bool_or(F.when(F.col("last"), F.col("broken"))).alias("tail"),
    ).join(found, "source")
    over = Window.partitionBy("file").orderBy("volume", "block")
    earlier, so_far = (over.rowsBetween(Window.unboundedPreceding, n) for n in (-1, 0))
    has_header = F.col("own_header").isNotNull()
    border = (F.col("first_kind") != HEAD) & ~_may_follow(F.coalesce("kind_in", F.lit(OTHER)), F.col("first_kind"))
    ends = ends.withColumns({
        "kind_in": F.lag("last_kind").over(over), "line_out": F.lead("first_line").over(over),
        "header_in": F.last("own_header", ignorenulls=True).over(earlier), "chain": F.count_if(has_header).over(so_far),
    }).withColumn("border", border)
    # A chain is a split with a header and those after it without any: its run, once ended, stays so.
    ended = F.max(F.when(has_header, F.col("tail")).otherwise(F.col("tail") | F.col("border")))
    at_end = ended.over(Window.partitionBy("file", "chain").orderBy("volume", "block").rowsBetween(Window.unboundedPreceding, 0))
    ends = ends.withColumn("at_end", at_end).withColumn("ended_in", F.coalesce(F.lag("at_end").over(over), F.lit(False)))
    return ends.select(*_SPLIT, "file", "file_name", "volume", "header_in", "line_out", (F.col("ended_in") | F.col("border")).alias("ended_in"))


def _facts(told: DataFrame) -> DataFrame:
    """Per file: date in the prose or in the name, receipts, and the place where the feeder part ends."""
    pair = F.concat_ws("\n", "line", F.coalesce("next", "line_out"))
    at = F.struct(*_PLACE)
    has = lambda mark: F.contains("line", F.lit(mark))
    starts = lambda mark, pattern: F.when(has(mark) & F.regexp_instr(pair, F.lit(pattern)).between(1, F.length("line") + 1), pair)
    first = lambda name: F.min_by(name, F.when(F.col(name).isNotNull(), F.col("at")))
    per_file = told.select(
        "file", "file_name", at.alias("at"), starts(_DATE_MARK, R.SALE_DATE).alias("date_text"),
        starts(_RECEIPT_MARK, R.RECEIPTS).alias("receipt_text"), F.col("line").rlike(R.END_OF_FEEDERS).alias("ends"),
    ).groupBy("file", "file_name").agg(
        first("date_text").alias("date_text"), first("receipt_text").alias("receipt_text"), F.min(F.when(F.col("ends"), F.col("at"))).alias("end"),
    )
    undated = F.raise_error(F.lit("report has no sale date")).cast("date")
    return per_file.select(
        "file", F.coalesce(R.sale_date(F.coalesce("date_text", F.lit("")), F.col("file_name")), undated).alias("auction_date"),
        F.regexp_replace(F.regexp_extract("receipt_text", R.RECEIPTS, 1), ",", "").try_cast("int").alias("receipts"), "end",
    )


def live_lines(spark: SparkSession, path: str, volumes: str | None = None) -> DataFrame:
    """Data lines that stand in the run after a header, with ``header``, date and receipts."""
    told = materialize(scanned(spark, path), "scanned")
    across = materialize(_across(told, files(spark, path, volumes)), "across")  # one row per split
    # Every file has a first line, so every file has a row of facts.
    facts = materialize(_facts(told.filter("fact OR first").join(across, _SPLIT)), "facts")
    data = told.filter((F.col("kind") == DATA) & ~F.col("broken")).join(across, _SPLIT)
    data = data.filter(F.col("header").isNotNull() | ~F.col("ended_in")).withColumn("header", F.coalesce("header", "header_in"))
    data = data.filter(F.col("header").isNotNull()).join(facts, "file")
    return data.filter(F.col("end").isNull() | (F.struct(*_PLACE) < F.col("end")))


def read_long_reports(spark: SparkSession, path: str, vintage: Column | str, volumes: str | None = None) -> DataFrame:
    """Lots of all report files under ``path``; a file is one report, read by as many tasks as
    its size asks for. ``volumes`` is the pattern of the numbers of volumes, where a report may come in
    several. A report with no date at all fails the job."""
    # One pass over a header, whose line has no bar, gives its four parts.
    told = live_lines(spark, path, volumes).withColumn("_head", F.split(F.regexp_replace("header", R.HEADER, "$1|$2|$3|$4"), r"\|"))
    head = lambda i: F.get("_head", F.lit(i - 1))
    rows = told.select(
        "file_name", "auction_date", "receipts", head(2).alias("class"), head(3).alias("frame"), head(4).alias("muscle_grade"),
        F.when(head(1) != "", "Holstein").otherwise("Beef").alias("breed"), F.col("line").alias("_line"),
    )
    return R.lot_columns(rows, vintage, keep=("file_name",))
