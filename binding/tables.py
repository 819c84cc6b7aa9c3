"""Domain tables derived from the driver's tables, in Spark and as SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = date(2000, 12, 1)
CONTRACTS = ("1-URGENT", "2-HIGH", "3-MEDIUM")
HOME = "S02"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def lots(spark: SparkSession, d: str) -> DataFrame:
    """One lot per lineitem row: weekly sale dates, missing and zero heads, missing and
    zero prices, missing weight breaks, weights outside the ladder."""
    c = F.col
    price = 20 + c("l_extendedprice") / 150
    lo = (F.floor(c("l_quantity") * 20 / 50) * 50).cast("int")
    has_bin = c("l_linenumber") % 3 != 0
    return table(spark, d, "lineitem").select(
        F.trunc(c("l_shipdate").cast("date"), "week").alias("auction_date"),
        F.lit("Feeder Cattle").alias("commodity"),
        F.when(c("l_returnflag") == "A", "Steers").when(c("l_returnflag") == "N", "Heifers").otherwise("Bulls").alias("class"),
        F.when(c("l_linestatus") == "O", "Medium and Large").otherwise("Large").alias("frame"),
        F.when(c("l_tax") < 0.045, "1").otherwise("2").alias("muscle_grade"),
        F.when(has_bin, lo).alias("weight_break_low"),
        F.when(has_bin, lo + 50).alias("weight_break_high"),
        (c("l_quantity") * 20 + 0.5).alias("avg_weight"),
        F.when(c("l_linenumber") == 7, F.lit(None)).when(c("l_linenumber") == 6, 0).otherwise(c("l_linenumber") * 10).cast("int").alias("head_count"),
        F.when((c("l_discount") < 0.005) & (c("l_tax") < 0.005), F.lit(None).cast("double"))
        .when((c("l_discount") > 0.095) & c("l_tax").between(0.035, 0.045), F.lit(0.0))
        .otherwise(price).alias("price_avg"),
        (price - c("l_quantity") / 10).alias("price_low"),
        (price + c("l_quantity") / 10).alias("price_high"),
        (c("l_suppkey") % 1000).cast("int").alias("receipts"),
        F.when(c("l_orderkey") % 2 == 0, F.lit(date(2002, 1, 7))).otherwise(F.lit(date(2001, 12, 31))).alias("vintage"),
        F.when(c("l_orderkey") % 2 == 0, "live").otherwise("legacy").alias("source"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    )


LOTS = """lots AS (SELECT
 CAST(date_trunc('week', l_shipdate) AS DATE) AS auction_date, 'Feeder Cattle' AS commodity,
 CASE l_returnflag WHEN 'A' THEN 'Steers' WHEN 'N' THEN 'Heifers' ELSE 'Bulls' END AS class,
 CASE WHEN l_linestatus = 'O' THEN 'Medium and Large' ELSE 'Large' END AS frame,
 CASE WHEN l_tax < 0.045 THEN '1' ELSE '2' END AS muscle_grade,
 CASE WHEN l_linenumber % 3 <> 0 THEN CAST(floor(l_quantity*20/50)*50 AS INTEGER) END AS weight_break_low,
 CASE WHEN l_linenumber % 3 <> 0 THEN CAST(floor(l_quantity*20/50)*50 AS INTEGER) + 50 END AS weight_break_high,
 l_quantity*20 + 0.5 AS avg_weight,
 CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN 0 ELSE l_linenumber*10 END AS head_count,
 CASE WHEN l_discount < 0.005 AND l_tax < 0.005 THEN NULL
      WHEN l_discount > 0.095 AND l_tax BETWEEN 0.035 AND 0.045 THEN 0.0
      ELSE 20 + l_extendedprice/150 END AS price_avg,
 20 + l_extendedprice/150 - l_quantity/10 AS price_low, 20 + l_extendedprice/150 + l_quantity/10 AS price_high,
 CAST(l_suppkey % 1000 AS INTEGER) AS receipts,
 CASE WHEN l_orderkey % 2 = 0 THEN DATE '2002-01-07' ELSE DATE '2001-12-31' END AS vintage,
 CASE WHEN l_orderkey % 2 = 0 THEN 'live' ELSE 'legacy' END AS source,
 l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem)"""

BIN = "CAST(floor(coalesce(weight_break_low, avg_weight)/100)*100 AS INTEGER)"
CORE = "class IN ('Steers','Heifers') AND frame = 'Medium and Large' AND muscle_grade = '1'"
PAGE = f"page AS (SELECT *, {BIN} AS bin_lo FROM lots WHERE {CORE} AND {BIN} BETWEEN 300 AND 800)"
PAGE_LABEL = "bin_lo || '–' || (bin_lo + 99) || ' lb'"


def cpi(spark: SparkSession, d: str) -> DataFrame:
    """Monthly index from mean order value."""
    o = table(spark, d, "orders")
    return (
        o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("period"))
        .agg((F.avg("o_totalprice") / 1000).alias("cpi_u"))
    )


CPI = """cpi AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, avg(o_totalprice)/1000 AS cpi_u
 FROM orders GROUP BY 1)"""
BASE_SQL = f"DATE '{BASE}'"


def settles(spark: SparkSession, d: str) -> DataFrame:
    """Daily settle per order priority; every seventh day of the month has none."""
    day = F.col("o_orderdate").cast("date")
    return (
        table(spark, d, "orders")
        .groupBy(day.alias("date"), F.col("o_orderpriority").alias("contract_month"))
        .agg(F.avg("o_totalprice").alias("_p"))
        .select("date", "contract_month", F.when(F.dayofmonth("date") % 7 != 0, F.col("_p") / 1000).alias("settle"))
    )


SETTLES = """settles AS (SELECT date, contract_month, CASE WHEN day(date) % 7 <> 0 THEN p/1000 END AS settle FROM
 (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS contract_month, avg(o_totalprice) AS p FROM orders GROUP BY 1, 2))"""


def policies(spark: SparkSession, d: str, extra: tuple[str, ...] = (), lineitem: DataFrame | None = None) -> DataFrame:
    """One endorsement per row of ``lineitem`` (the table), with ``extra`` columns of it; the supplier's nation is the
    state (0 is the unattributed one), so lineitem joins one dimension."""
    c = F.col
    li = table(spark, d, "lineitem") if lineitem is None else lineitem
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    weeks = F.array(*[F.lit(w) for w in (13, 17, 21, 26, 30, 34, 39, 43, 47, 52)])
    price = 20 + c("l_extendedprice") / 150
    start = c("l_shipdate").cast("date")
    length = F.get(weeks, (c("l_partkey") % 10).cast("int"))
    producer = F.floor(c("l_extendedprice") * c("l_tax"))
    subsidy = F.floor(c("l_extendedprice") * c("l_tax") * 0.3)
    paid = c("l_tax") < 0.035
    return li.join(s, li["l_suppkey"] == s["s_suppkey"]).select(
        F.year(start).cast("int").alias("reinsurance_year"),
        F.when(c("s_nationkey") == 0, "XX").otherwise(F.concat(F.lit("S"), F.lpad(c("s_nationkey").cast("string"), 2, "0"))).alias("state_abbr"),
        c("s_nationkey").cast("string").alias("state_fips"),
        (c("l_partkey") % 7).cast("string").alias("county_fips"),
        F.when(c("l_partkey") % 7 != 3, F.concat(F.lit("County "), (c("l_partkey") % 7).cast("string"))).alias("county_name"),
        F.when(c("l_linenumber") == 2, "0802").otherwise("0801").alias("commodity_code"),
        F.when(c("l_partkey") % 50 == 0, "82").otherwise("81").alias("plan_code"),
        (809 + c("l_linenumber") % 5).cast("string").alias("type_code"),
        start.alias("effective_date"),
        F.date_add(start, length * 7).alias("end_date"),
        length.alias("length_weeks"),
        price.alias("coverage_price"),
        (price * 1.02).alias("expected_end_value"),
        F.when((c("l_tax") > 0.075) & (c("l_discount") < 0.005), F.lit(None).cast("double"))
        .otherwise(F.round(0.65 + 3.5 * c("l_discount"), 4)).alias("coverage_level_pct"),
        (c("l_tax") * 100 + 0.5).alias("cost_per_cwt"),
        (1 + c("l_linenumber") % 3).cast("long").alias("n_endorsements_earning"),
        F.when(paid, 1).otherwise(0).cast("long").alias("n_endorsements_indemn"),
        F.when(c("l_linenumber") != 7, c("l_quantity").cast("int")).alias("n_head"),
        F.when(c("l_linenumber") != 6, c("l_quantity") * c("l_linenumber")).otherwise(F.lit(0.0)).alias("total_weight_cwt"),
        subsidy.alias("subsidy_amount"),
        (subsidy + producer).alias("total_premium_amount"),
        producer.alias("producer_premium_amount"),
        F.floor("l_extendedprice").alias("liability_amount"),
        F.when(paid, F.floor(c("l_extendedprice") * c("l_discount") * 0.5)).otherwise(F.lit(0).cast("long")).alias("indemnity_amount"),
        *extra,
    )


POLICIES = """policies AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS reinsurance_year,
 CASE WHEN s_nationkey = 0 THEN 'XX' ELSE 'S' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') END AS state_abbr,
 CAST(s_nationkey AS VARCHAR) AS state_fips, CAST(l_partkey % 7 AS VARCHAR) AS county_fips,
 CASE WHEN l_partkey % 7 <> 3 THEN 'County ' || (l_partkey % 7) END AS county_name,
 CASE WHEN l_linenumber = 2 THEN '0802' ELSE '0801' END AS commodity_code,
 CASE WHEN l_partkey % 50 = 0 THEN '82' ELSE '81' END AS plan_code,
 CAST(809 + l_linenumber % 5 AS VARCHAR) AS type_code,
 CAST(l_shipdate AS DATE) AS effective_date,
 CAST(l_shipdate AS DATE) + CAST([13,17,21,26,30,34,39,43,47,52][l_partkey % 10 + 1] * 7 AS INTEGER) AS end_date,
 [13,17,21,26,30,34,39,43,47,52][l_partkey % 10 + 1] AS length_weeks,
 20 + l_extendedprice/150 AS coverage_price, (20 + l_extendedprice/150) * 1.02 AS expected_end_value,
 CASE WHEN l_tax > 0.075 AND l_discount < 0.005 THEN NULL ELSE round(0.65 + 3.5*l_discount, 4) END AS coverage_level_pct,
 l_tax*100 + 0.5 AS cost_per_cwt,
 CAST(1 + l_linenumber % 3 AS BIGINT) AS n_endorsements_earning,
 CAST(CASE WHEN l_tax < 0.035 THEN 1 ELSE 0 END AS BIGINT) AS n_endorsements_indemn,
 CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS INTEGER) END AS n_head,
 CASE WHEN l_linenumber <> 6 THEN l_quantity*l_linenumber ELSE 0.0 END AS total_weight_cwt,
 CAST(floor(l_extendedprice*l_tax*0.3) AS BIGINT) AS subsidy_amount,
 CAST(floor(l_extendedprice*l_tax*0.3) + floor(l_extendedprice*l_tax) AS BIGINT) AS total_premium_amount,
 CAST(floor(l_extendedprice*l_tax) AS BIGINT) AS producer_premium_amount,
 CAST(floor(l_extendedprice) AS BIGINT) AS liability_amount,
 CAST(CASE WHEN l_tax < 0.035 THEN floor(l_extendedprice*l_discount*0.5) ELSE 0 END AS BIGINT) AS indemnity_amount
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
CORE_TYPES = "type_code IN ('809','810','811','812')"
