"""Raw formats: each query renders the driver's rows in a raw format and reads them back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from binding import rendered
from binding.registry import q, query, rounded
from binding.tables import BIN, LOTS, POLICIES, cpi, CPI, lots, policies, table
from drover import config as C
from drover.functions.columns import integer, marker_to_null, number, parsed_date
from drover.functions.bins import bin_floor
from drover.operators import sorted_state as K
from drover.operators import vintage as V
from drover.operators.ranks import numbered
from drover.session import fresh_path, materialize
from drover.sources.long_reports import read_long_reports
from drover.sources import endorsements, index_json, lots_json, reports, sheets, tables as T, volumes

VINTAGE = "2002-01-07"

# ---- auction report JSON -------------------------------------------------------------


def _entries():
    """A feeder and a slaughter entry of a lineitem row."""
    c = F.col
    price = c("l_extendedprice") / 100
    shared = lambda commodity: [
        F.lit(commodity).alias("commodity") if commodity else F.when(c("l_linenumber") % 4 == 0, "Replacement Cattle").otherwise(C.FEEDER).alias("commodity"),
        F.when(c("l_linenumber") == 5, "Per Head").otherwise(C.PER_CWT).alias("price_unit"),
        F.when(c("l_discount") < 0.005, "13/45/2001").otherwise(F.date_format(c("l_shipdate"), "MM/dd/yyyy")).alias("report_date"),
        (c("l_quantity") * 20).alias("avg_weight"), (c("l_quantity") * 20 - 5).alias("avg_weight_min"), (c("l_quantity") * 20 + 5).alias("avg_weight_max"),
        c("l_linenumber").alias("head_count"),
        F.when(c("l_tax") < 0.005, "N/A").otherwise(price.cast("string")).alias("avg_price"),
        (price - 1).alias("avg_price_min"),
        (price + 1).alias("avg_price_max"),
        c("l_suppkey").cast("string").alias("receipts"),
    ]
    flag = c("l_returnflag")
    feeder = F.struct(
        *shared(None),
        F.when(flag == "A", "Steers").when(flag == "N", "Heifers").otherwise("Bulls").alias("class"),
        F.lit(C.CORE_FRAME).alias("frame"), F.lit("1").alias("muscle_grade"),
        F.when(c("l_linenumber") != 3, (c("l_quantity") * 20).cast("int")).alias("weight_break_low"),
        F.when(c("l_linenumber") != 3, ((c("l_quantity") * 20).cast("int") + 49).cast("string")).alias("weight_break_high"),
    )
    slaughter = F.struct(
        *shared(C.SLAUGHTER),
        F.when(flag == "A", "Cows").when(flag == "N", "Dairy Cows").otherwise("Calves").alias("class"),
        F.lit("Boner 80-85%").alias("quality_grade_name"), F.lit("Average").alias("dressing"), F.lit("None").alias("lot_desc"),
    )
    return feeder, slaughter


def payloads(spark, d):
    """One payload text per lineitem row with both entries: an envelope for even orders, a bare
    list for odd ones."""
    feeder, slaughter = _entries()
    as_list = F.concat(F.lit("["), F.to_json(feeder), F.lit(","), F.to_json(slaughter), F.lit("]"))
    value = F.when(F.col("l_orderkey") % 2 == 0, F.concat(F.lit('{"results":'), as_list, F.lit("}"))).otherwise(as_list)
    return rendered.texts(spark, d, "payloads", lambda: rendered.dealt(spark, d, "lineitem").select(value.alias("value")))


#: Lineitem rows in an envelope.
ENVELOPE_ROWS = 4_000_000


def envelopes(spark, d):
    """A folder with files of one envelope each, which hold the feeder entries of all rows: one file, or in
    large tables several. A task writes one file at a time, in compressed volumes, and an empty object closes its list."""

    def write(path):
        feeder, _ = _entries()
        lineitem = table(spark, d, "lineitem")
        n = 1 + lineitem.count() // ENVELOPE_ROWS
        part = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(n)).cast("int")
        ends = spark.range(n).select(F.col("id").cast("int").alias("file"), F.explode(F.array(F.lit(0), F.lit(2))).alias("at"))
        rows = lineitem.withColumns({"file": part, "at": F.lit(1)}).unionByName(ends, allowMissingColumns=True)
        # Dealt by file and sorted before the text is made of the rows, which are much shorter.
        dealt = rows.repartition(n, "file").sortWithinPartitions("file", "at")
        text = F.when(F.col("at") == 0, '{"stats": {"returned": 1}, "results": [').when(F.col("at") == 2, "{}]}").otherwise(
            F.concat(F.to_json(feeder), F.lit(",")))
        volumes.write(dealt.select("file", text.alias("value")), ["file"], path)

    return rendered.at_rest(spark, d, "envelope", write)


KEPT = "l_linenumber <> 5 AND l_discount >= 0.005 AND l_tax >= 0.005 AND l_extendedprice/100 BETWEEN 20 AND 800"


@query("a1_feeder_lots_json", f"""SELECT CAST(l_shipdate AS DATE) AS auction_date, CASE l_returnflag WHEN 'A' THEN 'Steers' WHEN 'N' THEN 'Heifers' ELSE 'Bulls' END AS class,
 CASE WHEN l_linenumber <> 3 THEN CAST(l_quantity*20 AS INTEGER) END AS weight_break_low, CASE WHEN l_linenumber <> 3 THEN CAST(l_quantity*20 AS INTEGER) + 49 END AS weight_break_high,
 l_quantity*20 AS avg_weight, l_quantity*20 - 5 AS avg_weight_min, l_quantity*20 + 5 AS avg_weight_max, l_linenumber AS head_count,
 {q('l_extendedprice/100 - 1')} AS price_low, {q('l_extendedprice/100 + 1')} AS price_high, {q('l_extendedprice/100')} AS price_avg, CAST(l_suppkey AS INTEGER) AS receipts
 FROM lineitem WHERE {KEPT} AND l_linenumber % 4 <> 0""")
def _(spark, d):
    """All rows from one file, or several long ones, each read by as many tasks as its size asks for."""
    out = lots_json.feeder_lots(lots_json.read_split_rows(spark, envelopes(spark, d), volumes.NUMBERED), VINTAGE)
    return rounded(out.drop("commodity", "frame", "muscle_grade", "vintage"), "price_low", "price_high", "price_avg")


@query("a2_slaughter_lots_json", f"""SELECT CAST(l_shipdate AS DATE) AS auction_date, CASE l_returnflag WHEN 'A' THEN 'Cows' ELSE 'Dairy Cows' END AS class,
 'Boner 80-85%' AS quality_grade_name, 'Average' AS dressing, l_linenumber AS head_count, {q('l_extendedprice/100 + 1')} AS price_high, {q('l_extendedprice/100')} AS price_avg
 FROM lineitem WHERE {KEPT} AND l_returnflag IN ('A','N')""")
def _(spark, d):
    fields = (*lots_json.KEPT_BY, "quality_grade_name", "dressing", "head_count", "avg_price_max")
    out = lots_json.slaughter_lots(lots_json.raw_rows(payloads(spark, d), fields=fields), VINTAGE)
    return rounded(out.select("auction_date", "class", "quality_grade_name", "dressing", "head_count", "price_high", "price_avg"), "price_high", "price_avg")


# ---- price index ---------------------------------------------------------------------


def index_payloads(spark, d):
    """One payload per year (at most twelve months each): a first body with stale values,
    then a body that corrects the even months and adds an annual figure."""
    months = cpi(spark, d).select(F.year("period").cast("string").alias("year"), F.month("period").alias("m"), "cpi_u")
    point = lambda v: F.struct("year", F.concat(F.lit("M"), F.lpad(F.col("m").cast("string"), 2, "0")).alias("period"), v.cast("string").alias("value"))
    lists = months.groupBy("year").agg(
        F.collect_list(point(F.col("cpi_u") + 1)).alias("stale"),
        F.collect_list(F.when(F.col("m") % 2 == 0, point(F.col("cpi_u")))).alias("fixed"),
    )
    annual = F.array(F.struct("year", F.lit("M13").alias("period"), F.lit("1.0").alias("value")))
    body = lambda data: F.to_json(F.struct(F.struct(F.array(F.struct(data.alias("data"))).alias("series")).alias("Results")))
    return lists.select(
        F.concat(F.lit("["), body(F.col("stale")), F.lit(","), body(F.concat("fixed", annual)), F.lit("]")).alias("value")
    )


@query("a3_index_json", f"""WITH {CPI} SELECT period, {q('cpi_u + CASE WHEN month(period) % 2 = 0 THEN 0 ELSE 1 END')} AS cpi_u, DATE '2002-01-07' AS vintage FROM cpi""")
def _(spark, d):
    out = index_json.index_table(index_json.raw_points(index_payloads(spark, d)), VINTAGE)
    return rounded(out.drop("revision_count"), "cpi_u")


@query("a3_latest_index_file", f"""WITH {CPI} SELECT period, {q('cpi_u + CASE WHEN month(period) % 2 = 0 THEN 0 ELSE 1 END')} AS cpi_u, DATE '2002-01-07' AS vintage FROM cpi""")
def _(spark, d):
    """The newest of two files by name, one list with the bodies of all years."""

    def build():
        bodies = F.array_join(F.collect_list(F.expr("substring(value, 2, length(value) - 2)")), ",")
        newest = index_payloads(spark, d).agg(F.concat(F.lit("["), bodies, F.lit("]")).alias("value"))
        older = newest.select(F.lit("cpi_raw_2001-12.json").alias("file_name"), F.replace("value", F.lit('"period":"M0'), F.lit('"period":"M1')).alias("value"))
        return newest.select(F.lit("cpi_raw_2002-01.json").alias("file_name"), "value").unionByName(older)

    points = index_json.read_latest_points(spark, rendered.named_files(spark, d, "index_files", build))
    return rounded(index_json.index_table(points, VINTAGE).drop("revision_count"), "cpi_u")


# ---- endorsement lines ---------------------------------------------------------------


def endorsement_lines(spark, d):
    """Pipe-delimited lines with padding, empty and malformed values, under file names of
    two vintages."""
    p = policies(spark, d, lineitem=rendered.dealt(spark, d, "lineitem"))
    have = set(p.columns)
    fields = []
    for _, name, kind in endorsements.COLUMNS:
        if name == "commodity_year":
            shown = F.lit("n/a")
        elif name == "county_name":
            shown = F.concat(F.coalesce(F.col(name), F.lit("")), F.lit("   "))
        elif name == "end_date":
            shown = F.when(F.col("length_weeks") == 13, "2001-99-99").otherwise(F.col(name).cast("string"))
        elif name in have:
            shown = F.col(name).cast("string")
        else:
            shown = F.lit("")
        fields.append(F.coalesce(shown, F.lit("")))
    edition = F.when(F.col("liability_amount") % 2 == 0, "2026-04-27").otherwise("2025-04-27")
    return p.select(
        F.concat(F.lit("lrp_"), F.col("reinsurance_year").cast("string"), F.lit("_"), edition, F.lit(".txt")).alias("file_name"),
        F.concat_ws("|", *fields).alias("value"),
    )


@query("a4_endorsement_lines", f"""WITH {POLICIES} SELECT reinsurance_year, CAST(NULL AS SMALLINT) AS commodity_year, state_abbr, coalesce(county_name, '') AS county_name, type_code, effective_date,
 CASE WHEN length_weeks <> 13 THEN end_date END AS end_date, length_weeks, {q('coverage_level_pct')} AS coverage_level_pct, n_head, {q('total_weight_cwt')} AS total_weight_cwt, indemnity_amount FROM policies""")
def _(spark, d):
    lines = rendered.texts(spark, d, "endorsements", lambda: endorsement_lines(spark, d))
    out = endorsements.parse_lines(lines).select(
        "reinsurance_year", "commodity_year", "state_abbr", "county_name", "type_code", "effective_date",
        "end_date", "length_weeks", "coverage_level_pct", "n_head", "total_weight_cwt", "indemnity_amount",
    )
    return rounded(out, "coverage_level_pct", "total_weight_cwt")


@query("a4_endorsement_files", f"""WITH {POLICIES} SELECT reinsurance_year, type_code, count(*) AS n, count(end_date) FILTER (length_weeks <> 13) AS n_end, CAST(sum(n_head) AS BIGINT) AS n_head, CAST(sum(indemnity_amount) AS BIGINT) AS indemnity
 FROM policies GROUP BY 1, 2""")
def _(spark, d):
    path = rendered.at_rest(spark, d, "endorsement_text", lambda p: endorsement_lines(spark, d).select("value").write.text(p))
    return endorsements.read_text(spark, path).groupBy("reinsurance_year", "type_code").agg(
        F.count("*").alias("n"), F.count("end_date").alias("n_end"), F.sum("n_head").alias("n_head"), F.sum("indemnity_amount").alias("indemnity")
    )


@query("a5_endorsement_corpus", f"""WITH {POLICIES} SELECT reinsurance_year, DATE '2026-04-27' AS vintage, count(*) AS n, CAST(sum(liability_amount) AS BIGINT) AS liability FROM policies
 WHERE liability_amount % 2 = 0 AND commodity_code = '0801' AND plan_code = '81' GROUP BY 1""")
def _(spark, d):
    path = rendered.split_named_files(spark, d, "endorsement_files", lambda: endorsement_lines(spark, d))
    return endorsements.read_corpus(spark, path, "2026-04-27").groupBy(
        F.col("file_year").alias("reinsurance_year"), "vintage"
    ).agg(F.count("*").alias("n"), F.sum("liability_amount").alias("liability"))


# ---- wide sheets ---------------------------------------------------------------------

# Fixed order: contracts that carry data in the rendered sheet.
SHEET = {"JAN": "1-URGENT", "MAY": "2-HIGH", "NOV": "3-MEDIUM", "NEARBY": "5-LOW"}


def wide_settles(spark, d):
    price = F.col("o_totalprice") / 500
    return table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        *[F.avg(F.when(F.col("o_orderpriority") == SHEET[c], price)).alias(c) if c in SHEET else F.lit(None).cast("double").alias(c) for c in C.CONTRACT_COLUMNS]
    )


LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT CAST(o_orderdate AS DATE) AS date, '{c}' AS contract_month, avg(o_totalprice/500) AS settle FROM orders WHERE o_orderpriority = '{p}' GROUP BY 1" for c, p in SHEET.items()
) + ")"


@query("a6_settles_long", f"WITH {LONG} SELECT date, contract_month, {q('settle')} AS settle FROM long WHERE settle BETWEEN 30 AND 600")
def _(spark, d):
    return rounded(sheets.plausible_settles(sheets.settles_long(wide_settles(spark, d))), "settle")


@query("a6_rejected_settles", f"WITH {LONG} SELECT contract_month, count(*) AS n FROM long WHERE NOT settle BETWEEN 30 AND 600 GROUP BY 1")
def _(spark, d):
    return sheets.rejected_settles(sheets.settles_long(wide_settles(spark, d))).groupBy("contract_month").agg(F.count("*").alias("n"))


@query("a8_second_opinion", f"""WITH {LOTS} SELECT auction_date, class, lo AS weight_break_low, lo + 100 AS weight_break_high, {q('avg(price_avg)')} AS price_avg
 FROM (SELECT *, {BIN} AS lo FROM lots) WHERE price_avg IS NOT NULL AND ((class = 'Steers' AND lo BETWEEN 300 AND 900) OR (class = 'Heifers' AND lo BETWEEN 300 AND 800)) GROUP BY 1, 2, 3""")
def _(spark, d):
    lo = bin_floor("weight_break_low", "avg_weight")
    cells = [
        F.avg(F.when((F.col("class") == cls) & (lo == edge), F.col("price_avg"))).alias(name)
        for name, (cls, edge) in sheets.second_opinion_columns().items()
    ]
    wide = lots(spark, d).groupBy(F.col("auction_date").cast("string").alias("date")).agg(*cells)
    return rounded(sheets.second_opinion_long(wide), "price_avg")


# ---- free-text reports ---------------------------------------------------------------


def report_texts(spark, d):
    """One report per lineitem row: two live blocks, look-alike lines outside a block, a
    terminator followed by a block that must not count. The date is written with four or
    two year digits, or only in the file name."""
    c = F.col
    s = lambda x: x.cast("string")
    cents = F.floor("l_extendedprice")
    money = lambda x: F.concat(s(F.floor(x / 100)), F.lit("."), F.lpad(s(x % 100), 2, "0"))
    weight = (c("l_quantity") * 10 + 100).cast("int")
    day = c("l_shipdate").cast("date")
    shown = F.when(c("l_linenumber") % 3 == 0, F.date_format(day, "M/d/yy")).otherwise(F.date_format(day, "MM/dd/yyyy"))
    title = F.when(c("l_linenumber") == 7, F.lit("Weighted averages")).otherwise(
        F.concat(F.lit("Feeder Cattle Weighted Average Report for "), shown)
    )
    lines = [
        title,
        F.concat(F.lit("Receipts:  "), F.format_number("l_partkey", 0), F.lit("    Last Week:  100")),
        F.lit(""),
        F.lit(" Feeder Steers Medium and Large 1-2"),
        F.lit(" Head   Wt Range   Avg Wt    Price Range   Avg Price"),
        F.concat(F.lit("  "), s(c("l_linenumber")), F.lit("   "), s(weight), F.lit("-"), s(weight + 45), F.lit("   "), s(weight + 20), F.lit("   "), money(cents), F.lit("-"), money(cents + 250), F.lit("   "), money(cents + 100), F.lit("  Calves  ")),
        F.concat(F.lit("  12   "), s(weight), F.lit("   "), s(weight), F.lit("   "), money(cents), F.lit("   "), money(cents)),
        F.lit(""),
        F.lit("  99   500   500   100.00   100.00"),
        F.lit("Feeder Holstein Heifers Large 3"),
        F.lit(""),
        F.concat(F.lit(" 3 "), s(weight), F.lit(" "), s(weight), F.lit(".5 "), money(cents), F.lit(" "), money(cents)),
        F.lit("demand was moderate"),
        F.lit("  98   500   500   100.00   100.00"),
        F.lit("Slaughter Cows:  Head"),
        F.lit(" Feeder Bulls Medium and Large 1"),
        F.lit("  97   500   500   100.00   100.00"),
    ]
    return rendered.texts(spark, d, "reports", lambda: rendered.dealt(spark, d, "lineitem").select(
        F.concat(F.lit("CV_LS750"), F.date_format(day, "yyyyMMdd"), F.lit(".TXT")).alias("file_name"),
        F.concat_ws("\r\n", *lines).alias("value"),
    ))


#: Lineitem rows that share the reports of all line numbers; about a quarter of them is in the longest report.
REPORT_ROWS = 4_000_000


def long_reports(spark, d):
    """A folder with long reports, one or, in large tables, several per line number, in which each lineitem
    row has two blocks. A task writes one report at a time, in compressed volumes."""

    def write(path):
        c = F.col
        s = lambda x: x.cast("string")
        weight = (c("l_quantity") * 10 + 100).cast("int")
        cents = F.floor("l_extendedprice")
        money = lambda x: F.concat(s(F.floor(x / 100)), F.lit("."), F.lpad(s(x % 100), 2, "0"))
        block = F.concat_ws("\n", *[x if not isinstance(x, str) else F.lit(x) for x in (
            " Feeder Steers Medium and Large 1-2", "", " Head   Wt Range   Avg Wt    Price Range   Avg Price",
            F.concat(F.lit("  12   "), s(weight), F.lit("-"), s(weight + 45), F.lit("   "), s(weight + 20), F.lit("   "), money(cents), F.lit("-"), money(cents + 250), F.lit("   "), money(cents + 100), F.lit("  Calves  ")),
            F.concat(F.lit("  13   "), s(weight), F.lit("   "), s(weight), F.lit("   "), money(cents), F.lit("   "), money(cents)),
            "", "  99   500   500   100.00   100.00", "Feeder Holstein Heifers Large 3", "",
            F.concat(F.lit(" 3 "), s(weight), F.lit(" "), s(weight), F.lit(".5 "), money(cents), F.lit(" "), money(cents)),
            "demand was moderate", "  98   500   500   100.00   100.00",
        )])
        report = ["l_linenumber", "report"]
        lineitem = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
        n = 1 + lineitem.count() // REPORT_ROWS
        numbers = lineitem.select("l_linenumber").distinct().withColumn("report", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        first = F.concat(F.lit("Feeder Cattle Weighted Average Report for 3/"), s(c("l_linenumber")), F.lit("/2001\nReceipts:  1,00"), s(c("l_linenumber")))
        last = F.lit("Slaughter Cows:  Head\n Feeder Bulls Medium and Large 1\n  97   500   500   100.00   100.00")
        rows = lineitem.withColumns({"report": F.pmod(F.xxhash64("l_orderkey"), F.lit(n)).cast("int"), "at": F.lit(1)}).drop("l_orderkey")
        for at in (0, 2):
            rows = rows.unionByName(numbers.withColumn("at", F.lit(at)), allowMissingColumns=True)
        # Dealt by report and sorted before the text is made of the rows, which are much shorter.
        dealt = rows.repartition(max(rendered.PARTS, 7 * n), *report).sortWithinPartitions(*report, "at")
        text = F.when(c("at") == 0, first).when(c("at") == 2, last).otherwise(block)
        volumes.write(dealt.select(*report, text.alias("value")), report, path)

    return rendered.at_rest(spark, d, "long_reports", write)


REPORT_COMMON = """CASE WHEN l_linenumber % 3 = 0 AND year(l_shipdate) < 2000 THEN CAST(l_shipdate AS DATE) + INTERVAL 100 YEAR ELSE CAST(l_shipdate AS DATE) END"""


@query("a7_report_lots", f"""WITH l AS (SELECT *, CAST({REPORT_COMMON} AS DATE) AS dd, CAST(l_quantity*10 + 100 AS INTEGER) AS w, CAST(floor(l_extendedprice) AS BIGINT) AS c FROM lineitem)
 SELECT dd AS auction_date, 'Steers' AS class, 'Medium and Large' AS frame, '1-2' AS muscle_grade, 'Beef' AS breed, l_linenumber AS head_count, w AS weight_break_low, w + 45 AS weight_break_high,
  CAST(w + 20 AS DOUBLE) AS avg_weight, c/100 AS price_low, (c + 250)/100 AS price_high, (c + 100)/100 AS price_avg, CAST(l_partkey AS INTEGER) AS receipts, 'Calves' AS annotation FROM l
 UNION ALL SELECT dd, 'Steers', 'Medium and Large', '1-2', 'Beef', 12, w, w, CAST(w AS DOUBLE), c/100, c/100, c/100, CAST(l_partkey AS INTEGER), '' FROM l
 UNION ALL SELECT dd, 'Heifers', 'Large', '3', 'Holstein', 3, w, w, w + 0.5, c/100, c/100, c/100, CAST(l_partkey AS INTEGER), '' FROM l""")
def _(spark, d):
    return reports.parse_reports(report_texts(spark, d), VINTAGE, file_name="file_name").drop(
        "commodity", "avg_weight_min", "avg_weight_max", "vintage"
    )


@query("e6_header_carry", """SELECT 'Beef' AS breed, 'Steers' AS class, count(*)*2 AS n FROM lineitem UNION ALL SELECT 'Holstein', 'Heifers', count(*) FROM lineitem""")
def _(spark, d):
    out = reports.parse_reports(report_texts(spark, d), VINTAGE, file_name="file_name")
    return out.groupBy("breed", "class").agg(F.count("*").alias("n"))


LONG_REPORTS = """l AS (SELECT make_date(2001, 3, CAST(l_linenumber AS INTEGER)) AS auction_date, CAST(1000 + l_linenumber AS INTEGER) AS receipts, CAST(l_quantity*10 + 100 AS INTEGER) AS w, CAST(floor(l_extendedprice) AS BIGINT) AS c FROM lineitem),
 lots AS (SELECT auction_date, receipts, 'Steers' AS class, 'Medium and Large' AS frame, '1-2' AS muscle_grade, 'Beef' AS breed, 12 AS head_count, w AS weight_break_low, w + 45 AS weight_break_high,
  CAST(w + 20 AS DOUBLE) AS avg_weight, c/100 AS price_low, (c + 250)/100 AS price_high, (c + 100)/100 AS price_avg, 'Calves' AS annotation FROM l
 UNION ALL SELECT auction_date, receipts, 'Steers', 'Medium and Large', '1-2', 'Beef', 13, w, w, CAST(w AS DOUBLE), c/100, c/100, c/100, '' FROM l
 UNION ALL SELECT auction_date, receipts, 'Heifers', 'Large', '3', 'Holstein', 3, w, w, w + 0.5, c/100, c/100, c/100, '' FROM l)"""


@query("a7_long_reports", f"WITH {LONG_REPORTS} SELECT * FROM lots")
def _(spark, d):
    """Few long files, headers carried across their splits."""
    return read_long_reports(spark, long_reports(spark, d), VINTAGE, volumes.NUMBERED).drop("file_name", "commodity", "avg_weight_min", "avg_weight_max", "vintage")


@query("e6_header_carry_long", f"WITH {LONG_REPORTS} SELECT breed, class, frame, muscle_grade, count(*) AS n FROM lots GROUP BY ALL")
def _(spark, d):
    out = read_long_reports(spark, long_reports(spark, d), VINTAGE, volumes.NUMBERED)
    return out.groupBy("breed", "class", "frame", "muscle_grade").agg(F.count("*").alias("n"))


# ---- coercion ------------------------------------------------------------------------


@query("b14_coercion", """SELECT l_linenumber, count(*) AS n, count(*) FILTER (l_linenumber <> 2) AS n_number, CAST(sum(CASE WHEN l_linenumber <> 2 THEN l_quantity END) AS BIGINT) AS total,
 count(*) FILTER (l_linenumber <> 3) AS n_date, max(CASE WHEN l_linenumber <> 3 THEN CAST(l_shipdate AS DATE) END) AS last_day FROM lineitem GROUP BY 1""")
def _(spark, d):
    c = F.col
    text = table(spark, d, "lineitem").select(
        "l_linenumber",
        F.when(c("l_linenumber") == 2, " x1 ").otherwise(F.concat(F.lit("  "), c("l_quantity").cast("string"), F.lit(" "))).alias("num"),
        F.when(c("l_linenumber") == 3, "2001-13-40").when(c("l_linenumber") == 4, F.date_format("l_shipdate", "M/d/yyyy"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("day"),
    )
    day = parsed_date("day", "yyyy-MM-dd", "M/d/yyyy")
    return text.groupBy("l_linenumber").agg(
        F.count("*").alias("n"), F.count(number("num")).alias("n_number"), F.sum(integer("num", "bigint")).alias("total"),
        F.count(day).alias("n_date"), F.max(day).alias("last_day"),
    )


MARKED = "['', '-', '(NA)', 'N/A', '(X)', 'NA', 'ok'][l_linenumber]"


@query("b22_missing_markers", f"SELECT CASE WHEN l_linenumber = 7 THEN 'ok' END AS shown, count(*) AS n FROM (SELECT l_linenumber, {MARKED} AS m FROM lineitem) GROUP BY 1")
def _(spark, d):
    marks = F.array(*[F.lit(f" {m} ") for m in (*C.MISSING_MARKERS, "ok")])
    shown = marker_to_null(F.get(marks, F.col("l_linenumber") - 1))
    return table(spark, d, "lineitem").groupBy(shown.alias("shown")).agg(F.count("*").alias("n"))


# ---- readers, vintages, sinks --------------------------------------------------------


@query("a9_optional_sources", "SELECT 'orders' AS source, count(*) AS rows, true AS present FROM orders UNION ALL SELECT 'absent', 0, false")
def _(spark, d):
    found = V.combine({"orders": T.read_any(spark, f"{d}/orders"), "absent": T.read_any(spark, f"{d}/absent")}, dedup=False)
    return found.counts()


@query("g1_union_sources", f"""WITH {LOTS} SELECT source, CASE WHEN source = 'legacy' THEN 'Beef' END AS breed, count(*) AS n FROM lots GROUP BY 1, 2""")
def _(spark, d):
    both = lots(spark, d)
    return (
        V.union_sources({
            "live": both.filter("source = 'live'").drop("source"),
            "legacy": both.filter("source = 'legacy'").drop("source").withColumn("breed", F.lit("Beef")),
        }).groupBy("source", "breed").agg(F.count("*").alias("n"))
    )


@query("g2_tag_before_union", f"""WITH {LOTS} SELECT source, class, count(*) AS n FROM lots GROUP BY 1, 2""")
def _(spark, d):
    both = lots(spark, d)
    parts = {s: both.filter(F.col("source") == s).drop("source") for s in ("live", "legacy")}
    return V.union_sources(parts).groupBy("source", "class").agg(F.count("*").alias("n"))


@query("g3_many_years", f"""WITH {POLICIES} SELECT reinsurance_year, count(*) AS n FROM policies GROUP BY 1""")
def _(spark, d):
    """One file per year, whatever years there are, read as one table."""
    path = fresh_path(spark, "yearly")
    policies(spark, d).select("reinsurance_year", "state_abbr").write.partitionBy("reinsurance_year").parquet(path)
    return spark.read.parquet(path).groupBy("reinsurance_year").agg(F.count("*").alias("n"))


KEY = "auction_date, class, frame, muscle_grade, weight_break_low, weight_break_high"
WINNER = f"""win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY vintage DESC, l_orderkey DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC, price_low DESC) AS k FROM lots) WHERE k = 1)"""
TIES = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "price_low")


@query("e3_latest_vintage", f"WITH {LOTS}, {WINNER} SELECT {KEY}, vintage, l_orderkey, l_linenumber, {q('price_low')} AS price_low FROM win")
def _(spark, d):
    won = V.latest_vintage_wins(lots(spark, d), ties=TIES)
    return rounded(won.select(*C.LOT_KEY, "vintage", "l_orderkey", "l_linenumber", "price_low"), "price_low")


@query("e3_sorted_vintages", f"WITH {LOTS}, {WINNER} SELECT {KEY}, vintage, l_orderkey, l_linenumber, {q('price_low')} AS price_low FROM win")
def _(spark, d):
    """The same from two vintages that lie bucketed and sorted by the key: a merge join with
    neither exchange nor sort."""
    order = ("vintage", *TIES)
    buckets = K.buckets_for(table(spark, d, "lineitem").count())
    both = lots(spark, d)
    sides = []
    for name in ("legacy", "live"):
        rows = K.keyed(both.filter(F.col("source") == name), C.LOT_KEY, order)
        path = rendered.at_rest(spark, d, f"{name}_lots", lambda p, r=rows: K.write_sorted(r, p, buckets))
        sides.append(K.read_sorted(spark, rows.schema, path, buckets))
    won = K.merged(*sides, order)
    return rounded(won.select(*C.LOT_KEY, "vintage", "l_orderkey", "l_linenumber", "price_low"), "price_low")


@query("e3_winning_vintage_rows", f"""WITH {LOTS}, m AS (SELECT *, max(vintage) OVER (PARTITION BY {KEY}) AS newest FROM lots) SELECT class, vintage, count(*) AS n FROM m WHERE vintage = newest GROUP BY 1, 2""")
def _(spark, d):
    return V.winning_vintage_rows(lots(spark, d)).groupBy("class", "vintage").agg(F.count("*").alias("n"))


@query("g6_combined_sources", f"""WITH {LOTS}, {WINNER} SELECT source, count(*) AS rows FROM win GROUP BY 1""")
def _(spark, d):
    both = lots(spark, d)
    parts = {s: both.filter(F.col("source") == s).drop("source") for s in ("live", "legacy")}
    return V.combine(parts).df.groupBy("source").agg(F.count("*").alias("rows"))


@query("g6_source_rows", f"""WITH {LOTS} SELECT source, count(*) AS rows, true AS present FROM lots GROUP BY 1 UNION ALL SELECT 'historical', 0, false""")
def _(spark, d):
    both = lots(spark, d)
    parts = {s: both.filter(F.col("source") == s).drop("source") for s in ("live", "legacy")}
    return V.combine(parts | {"historical": None}).counts()


PRIOR = "prior AS (SELECT period, cpi_u + CASE WHEN month(period) % 2 = 0 THEN 0.5 ELSE 0 END AS cpi_u, CAST(month(period) % 3 AS INTEGER) AS revision_count FROM cpi WHERE period < DATE '2001-06-01')"


def prior_index(index):
    m = F.month("period")
    return index.filter(F.col("period") < F.lit(date(2001, 6, 1))).select(
        "period", (F.col("cpi_u") + F.when(m % 2 == 0, 0.5).otherwise(0.0)).alias("cpi_u"), (m % 3).alias("revision_count")
    )


@query("c10_revision_counts", f"""WITH {CPI}, {PRIOR} SELECT c.period, {q('c.cpi_u')} AS cpi_u, CASE WHEN p.period IS NULL THEN 0 WHEN abs(p.cpi_u - c.cpi_u) > 1e-6 THEN p.revision_count + 1 ELSE p.revision_count END AS revision_count
 FROM cpi c LEFT JOIN prior p USING (period)""")
def _(spark, d):
    index = materialize(cpi(spark, d), "index")
    return rounded(V.revision_counts(index, prior_index(index)), "cpi_u")


def _root(spark):
    return fresh_path(spark, "published")


def _published(spark, d):
    """Two vintages of the index; the second, with a jump, fails its gate."""
    from drover.operators import quality

    root = _root(spark)
    good = materialize(cpi(spark, d), "good")
    wrong = good.withColumn("cpi_u", F.col("cpi_u") * 3)
    for tag, df in (("2002-01-01", good), ("2002-02-01", wrong)):
        gate = quality.run_rules(df, [quality.Rule("index_bounds", F.col("cpi_u") > 600)])
        T.publish(df, root, "cpi", tag, gate, extras={"first_month": F.min("period"), "last_month": F.max("period")})
    # The same vintage again replaces its own entry.
    T.record_manifest(good, root, "cpi", "2002-01-01", {"first_month": F.min("period"), "last_month": F.max("period")})
    return root


@query("a10_published_vintage", f"WITH {CPI} SELECT period, {q('cpi_u')} AS cpi_u, DATE '2002-01-01' AS vintage FROM cpi")
def _(spark, d):
    return rounded(T.read_latest(spark, _published(spark, d), "cpi"), "cpi_u")


@query("k12_last_good_stays", f"WITH {CPI} SELECT DATE '2002-01-01' AS vintage, count(*) AS rows FROM cpi")
def _(spark, d):
    return T.read_latest(spark, _published(spark, d), "cpi").groupBy("vintage").agg(F.count("*").alias("rows"))


@query("a11_manifest", f"WITH {CPI} SELECT 'cpi' AS dataset, '2002-01-01' AS vintage, count(*) AS rows, min(period) AS first_month, max(period) AS last_month FROM cpi")
def _(spark, d):
    return T.read_manifest(spark, _published(spark, d)).drop("file", "sha256", "written_at_utc")


@query("a11_manifest_upsert", f"""WITH {LOTS} SELECT source AS dataset, CAST(vintage AS VARCHAR) AS vintage, count(*) AS rows FROM lots WHERE source = 'live' GROUP BY 1, 2
 UNION ALL SELECT 'legacy', '2001-12-31', count(*) FROM lots WHERE source = 'legacy'""")
def _(spark, d):
    both = lots(spark, d)
    live = V.manifest_entry(both.filter("source = 'live'"), "live", "2002-01-07")
    stale = V.manifest_entry(both, "legacy", "2001-12-31")
    fresh = V.manifest_entry(both.filter("source = 'legacy'"), "legacy", "2001-12-31")
    return V.upsert_manifest(live.unionByName(stale), fresh).select("dataset", "vintage", "rows")


@query("a12_csv_export", f"WITH {CPI} SELECT period, {q('cpi_u')} AS cpi_u FROM cpi")
def _(spark, d):
    path = f"{_root(spark)}/csv"
    T.export_csv(cpi(spark, d), path, one_file=True)
    back = spark.read.option("header", True).schema("period date, cpi_u double").csv(path)
    return rounded(back, "cpi_u")


@query("a13_catalog", """SELECT 'orders' AS dataset, count(*) AS rows, 6 AS n_columns, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders
 UNION ALL SELECT 'lineitem', count(*), 11, CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE) FROM lineitem
 UNION ALL SELECT 'events', count(*), 6, CAST(min(ts) AS DATE), CAST(max(ts) AS DATE) FROM events""")
def _(spark, d):
    days = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    out = V.catalog({n: (table(spark, d, n), day) for n, day in days.items()})
    return out.withColumns({c: F.col(c).cast("date") for c in ("first_date", "last_date")})


@query("a13_freshness", f"""WITH {LOTS} SELECT source AS dataset, max(CAST(vintage AS VARCHAR)) AS vintage, CAST(1 AS BIGINT) AS n_vintages, count(*) AS rows FROM lots GROUP BY 1""")
def _(spark, d):
    both = lots(spark, d)
    entries = [V.manifest_entry(both.filter(F.col("source") == s), s, v) for s, v in (("live", "2002-01-07"), ("legacy", "2001-12-31"))]
    return V.latest_entries(entries[0].unionByName(entries[1])).select("dataset", "vintage", "n_vintages", "rows")


@query("a15_worklist", """SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS filename, 'B' AS era FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
 AND CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_quantity > 45)""")
def _(spark, d):
    day = lambda c: F.date_format(c, "yyyyMMdd").alias("filename")
    inventory = table(spark, d, "orders").select(
        day("o_orderdate"), F.when(F.year("o_orderdate") < 1998, "B").otherwise("A").alias("era")
    ).distinct()
    present = table(spark, d, "lineitem").filter("l_quantity > 45").select(day("l_shipdate")).distinct()
    return V.worklist(inventory, present, "B")


@query("f1_lots_in_order", f"""WITH {LOTS} SELECT {KEY}, CAST(row_number() OVER (PARTITION BY auction_date ORDER BY {', '.join(f'{c} NULLS LAST' for c in KEY.split(', '))}) AS INTEGER) AS place FROM lots""")
def _(spark, d):
    order = [F.asc_nulls_last(c) for c in C.LOT_ORDER]
    placed = numbered(lots(spark, d).select(*C.LOT_ORDER), order, within=("auction_date",))
    return placed.withColumn("place", F.col("place").cast("int"))


LOT_ORDER_SQL = ", ".join(f"{c} NULLS LAST" for c in C.LOT_ORDER)


@query("f1_global_place", f"WITH {LOTS} SELECT {KEY}, row_number() OVER (ORDER BY {LOT_ORDER_SQL}) AS place FROM lots")
def _(spark, d):
    """The place of every lot in the whole published order."""
    return numbered(lots(spark, d).select(*C.LOT_ORDER), [F.asc_nulls_last(c) for c in C.LOT_ORDER])


@query("g4_new_dates", """SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""")
def _(spark, d):
    day = lambda t, c: table(spark, d, t).select(F.col(c).cast("date").alias("day"))
    return V.absent_from(day("lineitem", "l_shipdate"), day("orders", "o_orderdate"), "day")
