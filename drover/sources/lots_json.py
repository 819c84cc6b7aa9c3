"""Auction report JSON: one parse feeding the feeder and the slaughter table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover import config as C
from drover.functions.columns import integer, number, parsed_date
from drover.sources import volumes as V

# Field names of a raw report row.
RAW_FIELDS = (
    "commodity", "price_unit", "class", "frame", "muscle_grade", "quality_grade_name", "dressing", "lot_desc",
    "report_date", "weight_break_low", "weight_break_high", "avg_weight", "avg_weight_min", "avg_weight_max",
    "head_count", "avg_price", "avg_price_min", "avg_price_max", "receipts",
)
# Everything is read as text and coerced later: the feed mixes numbers and text.
ROW = T.StructType([T.StructField(f, T.StringType()) for f in RAW_FIELDS])
ROWS = T.ArrayType(ROW)
ENVELOPE = T.StructType([T.StructField("results", ROWS)])


def raw_rows(payloads: DataFrame, body: str = "value", fields: tuple[str, ...] = RAW_FIELDS) -> DataFrame:
    """Rows of each payload text, which is an envelope with ``results`` or a bare list. ``fields`` names the
    columns wanted: a number read as text is dear, and the planner does not see through the list."""
    asked = T.ArrayType(T.StructType([f for f in ROW if f.name in fields]))
    text = F.col(body)
    is_list = F.ltrim(text).startswith("[")
    envelope = F.from_json(text, T.StructType([T.StructField("results", asked)]))
    return payloads.select(F.inline(F.when(is_list, F.from_json(text, asked)).otherwise(envelope["results"])))


def read_raw_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of every payload file under ``path``. The JSON reader takes each file as a stream,
    so no file has to fit in one text value: an envelope is one record with its rows in
    ``results``, a bare list gives its rows one by one."""
    both = T.StructType([*ENVELOPE.fields, *ROW.fields])
    found = spark.read.schema(both).json(path, multiLine=True)
    own = F.array(F.struct(*RAW_FIELDS))
    bare = F.coalesce(*[F.col(f) for f in RAW_FIELDS]).isNotNull()
    return found.select(F.inline(F.when(F.col("results").isNotNull(), F.col("results")).when(bare, own)))


_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# A string, or a flat JSON object: no braces inside but those in strings. Possessive, so that no text makes
# it try again.
_TOKEN = _STRING + r'|\{[^{}"]*+(?:' + _STRING + r'[^{}"]*+)*+\}'
# Most pieces hold one object and nothing before it.
_PLAIN = r"^\s*\{[^{}]*$"
_BEGINS = r"^\s*\{\s*" + _STRING + r"\s*:"
# An even number of quotes, those after a backslash not counted.
_NO_QUOTE = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
_EVEN = "^" + _NO_QUOTE + '(?:"' + _NO_QUOTE + '"' + _NO_QUOTE + ")*+$"
# Both at once, and neither brace nor backslash: one pass settles what most pieces are.
_PLAIN_WHOLE = r'^\s*\{\s*"[^"\\{}]*+"\s*:[^"\\{}]*+(?:"[^"\\{}]*+"[^"\\{}]*+)*+$'
# What parts the records of a list. It may be followed by white space.
_BORDER = "},"


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The files under ``path`` cut after every record, whatever their size: the text reader
    splits a file by bytes and makes each cut whole. ``file``, ``block`` and ``place`` give the order."""
    found = spark.read.option("lineSep", _BORDER).text(path)
    return found.select(
        "value", F.input_file_name().alias("file"), F.input_file_block_start().alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def mended(cut: DataFrame, volumes: str | None = None) -> DataFrame:
    """Pieces that were cut inside a string joined again, as column ``value``.

    A piece with an even number of quotes that begins with a brace and a key is whole: one
    that begins inside a string and ends inside another has a field name where the colon
    would be, and no field name begins with a colon. All others, the ends of files among them, are
    put in order, and those between an odd number of quotes and the next are one. They are few
    unless text fields are full of borders, and then sorted by file, not held.

    Where files come in ``volumes``, what ends with a line may be the end of a volume and is put in order too:
    no border stands between that and the piece after it, and both are one.
    """
    value = F.col("value")
    plain, even = value.rlike(_PLAIN_WHOLE), value.rlike(_EVEN)
    whole = plain | (even & value.rlike(_BEGINS))
    if volumes is not None:
        whole = whole & ~value.endswith("\n")
    place = ["volume", "block", "place"]
    order = Window.partitionBy("file").orderBy(*place)
    inside = F.coalesce(F.sum("odd").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    goes_on = F.coalesce(F.lag("volume").over(order) != F.col("volume"), F.lit(False))
    # Patterns are matched once a piece, and after the filter again on the few that are left.
    placed = cut.filter(~whole).withColumns({
        "file": V.whole(F.col("file"), volumes), "volume": V.number(F.col("file"), volumes), "odd": F.when(plain | even, 0).otherwise(1),
    })
    ordered = placed.withColumns({"goes_on": goes_on, "begins": ((inside == 0) & ~goes_on).cast("int")})
    after = F.when((F.col("begins") == 1) | F.col("goes_on"), value).otherwise(F.concat(F.lit(_BORDER), value))
    joined = ordered.withColumns({"value": after, "number": F.sum("begins").over(order)}).groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct(*place, "value"))).alias("parts")
    )
    return cut.filter(whole).select("value").unionByName(joined.select(F.array_join(F.col("parts.value"), "").alias("value")))


def read_split_rows(spark: SparkSession, path: str, volumes: str | None = None) -> DataFrame:
    """Rows of every payload file under ``path``, a file being read by as many tasks as its
    size asks for: one envelope may hold all rows. ``volumes`` is the pattern of the numbers of volumes, where a file
    may come in several. A file with a blank between brace and comma, which
    no common writer sets, is one piece. Rows are flat objects, in ``results`` or in a bare
    list; other objects of an envelope have none of the row fields and give no rows."""
    ended = F.concat("value", F.lit("}"))
    objects = F.filter(F.regexp_extract_all(ended, F.lit(_TOKEN), F.lit(0)), lambda t: t.startswith("{"))
    texts = F.when(F.col("value").rlike(_PLAIN), F.array(ended)).otherwise(objects)
    found = mended(pieces(spark, path), volumes).select(F.explode(texts).alias("text"))
    # From a generator, below which no filter is pushed: an object is parsed once, not once for every condition.
    rows = found.select(F.inline(F.array(F.from_json("text", ROW))))
    return rows.filter(F.coalesce(*RAW_FIELDS).isNotNull())


def _kept(raw: DataFrame, commodity: str, classes: tuple[str, ...]) -> DataFrame:
    return raw.filter(
        (F.col("commodity") == commodity) & (F.col("price_unit") == C.PER_CWT) & F.col("class").isin(*classes)
    ).withColumn("auction_date", parsed_date("report_date", "M/d/yyyy")).filter(
        F.col("auction_date").isNotNull() & number("avg_price").between(C.PRICE_MIN, C.PRICE_MAX)
    )


def _weights() -> list[Column]:
    return [number(c).alias(c) for c in ("avg_weight", "avg_weight_min", "avg_weight_max")]


def _prices_and_tail(vintage: Column | str) -> list[Column]:
    return [
        integer("head_count").alias("head_count"),
        number("avg_price_min").alias("price_low"),
        number("avg_price_max").alias("price_high"),
        number("avg_price").alias("price_avg"),
        integer("receipts").alias("receipts"),
        F.lit(vintage).cast("date").alias("vintage"),
    ]


def feeder_lots(raw: DataFrame, vintage: Column | str) -> DataFrame:
    """Typed feeder lots; rows with an unknown date or an implausible price are dropped."""
    return _kept(raw, C.FEEDER, C.FEEDER_CLASSES).select(
        "auction_date", "commodity", "class", "frame", "muscle_grade",
        integer("weight_break_low").alias("weight_break_low"),
        integer("weight_break_high").alias("weight_break_high"),
        *_weights(), *_prices_and_tail(vintage),
    )


#: Fields of a raw row that decide whether it is kept.
KEPT_BY = ("commodity", "price_unit", "class", "report_date", "avg_price")


def slaughter_lots(raw: DataFrame, vintage: Column | str) -> DataFrame:
    """Typed slaughter lots: no weight bin, but quality grade and dressing. Columns whose raw field was not
    asked for are left out; those of :data:`KEPT_BY` are needed."""
    weights = ("avg_weight", "avg_weight_min", "avg_weight_max")
    tail = ("head_count", "avg_price_min", "avg_price_max", "avg_price", "receipts")
    *typed, seen = _prices_and_tail(vintage)
    by_field = [*((f, F.col(f)) for f in ("quality_grade_name", "dressing", "lot_desc")), *zip(weights, _weights(), strict=True), *zip(tail, typed, strict=True)]
    return _kept(raw, C.SLAUGHTER, C.SLAUGHTER_CLASSES).select(
        "auction_date", "commodity", "class", *[column for field, column in by_field if field in raw.columns], seen,
    )
