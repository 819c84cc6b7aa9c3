"""Streaming forms over the event table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from binding.ingest import TIES
from binding.registry import q, query, rounded
from binding.tables import LOTS, lots, table
from drover.config import LOT_KEY
from drover.operators import quality as Q
from drover.operators.sorted_state import buckets_for
from drover.session import fresh_path
from drover.sources import tables as T
from drover.streaming import refresh as R
from drover.streaming import upsert as U
from drover.streaming import windows as W


def _stream(spark, d):
    schema = table(spark, d, "events").schema
    return R.file_stream(spark, d, schema, "events.parquet"), fresh_path(spark, "stream")


@query("s1_gated_refresh", f"SELECT event_type, count(*) AS n, {q('sum(value)', 2)} AS total FROM events GROUP BY 1")
def _(spark, d):
    stream, out = _stream(spark, d)
    gate = lambda batch: Q.run_rules(batch, [Q.Rule("event_type_missing", F.col("event_type").isNull())])
    R.gated_append(stream, gate, out, f"{out}/checkpoint").awaitTermination()
    landed = spark.read.parquet(f"{out}/accepted")
    return rounded(landed.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")), "total", digits=2)


@query("s1_rejected_batch", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    stream, out = _stream(spark, d)
    gate = lambda batch: Q.run_rules(batch, [Q.Rule("value_bounds", F.col("value") > 1)])
    R.gated_append(stream, gate, out, f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/rejected").groupBy("event_type").agg(F.count("*").alias("n"))


KEY = ", ".join(LOT_KEY)
ORDER = ", ".join(f"{c} DESC" for c in ("vintage", *TIES))


@query("s1_published_vintage", "SELECT event_type, DATE '2024-02-01' AS vintage, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    """A good batch is published; the same events with broken values come as a second one."""
    events = table(spark, d, "events")
    out = fresh_path(spark, "published")
    gate = lambda batch: Q.run_rules(batch, [Q.Rule("value_bounds", F.col("value") < 0)])
    for sign in (1, -1):
        events.withColumn("value", F.col("value") * sign).write.mode("append").parquet(f"{out}/in/{sign}")
        feed = R.file_stream(spark, f"{out}/in/*", events.schema)
        R.gated_publish(feed, gate, f"{out}/root", "events", f"{out}/checkpoint", lambda b: f"2024-02-0{b + 1}").awaitTermination()
    return T.read_latest(spark, f"{out}/root", "events").groupBy("event_type", "vintage").agg(F.count("*").alias("n"))


@query("s1_vintage_upsert", """SELECT DATE '2024-02-02' AS vintage, event_id, event_type, CASE WHEN event_id % 3 = 1 THEN value ELSE value + 1 END AS value FROM events
 UNION ALL SELECT DATE '2024-02-01', event_id, event_type, value FROM events WHERE event_id % 3 <> 0""")
def _(spark, d):
    """Two good batches add up, and the second revises a part of the first; a third, broken one
    is not published. Both vintages stay readable as whole tables."""
    events = table(spark, d, "events").select("event_id", "event_type", "value")
    out = fresh_path(spark, "upsert")
    gate = lambda batch: Q.run_rules(batch, [Q.Rule("value_bounds", F.col("value") < 0)])
    part = F.col("event_id") % 3
    feeds = (events.filter(part != 0), events.filter(part != 1).withColumn("value", F.col("value") + 1), events.withColumn("value", F.lit(-1.0)))
    for n, batch in enumerate(feeds):
        feed = R.file_stream(spark, f"{out}/in/*", events.schema, per_batch=_landed(batch, f"{out}/in/{n}"))
        U.gated_upsert(
            feed, gate, f"{out}/root", "events", ("event_id",), f"{out}/checkpoint", lambda b: f"2024-02-0{b + 1}", buckets=buckets_for(events.count())
        ).awaitTermination()
    latest = T.read_latest(spark, f"{out}/root", "events")
    first = spark.read.parquet(f"{out}/root/events").filter("vintage = DATE'2024-02-01'")
    return latest.unionByName(first).select("vintage", "event_id", "event_type", "value")


@query("s1_gate_reports", """SELECT DATE '2024-02-01' AS vintage, 'value_bounds' AS rule_id, CAST(0 AS BIGINT) AS n_bad, count(*) AS n_total FROM events
 UNION ALL SELECT DATE '2024-02-02', 'value_bounds', count(*) FILTER (value > 0), count(*) FROM events""")
def _(spark, d):
    events = table(spark, d, "events")
    out = fresh_path(spark, "reports")
    for sign, tag in ((1, "2024-02-01"), (-1, "2024-02-02")):
        batch = events.withColumn("value", F.col("value") * sign)
        T.publish(batch, out, "events", tag, Q.run_rules(batch, [Q.Rule("value_bounds", F.col("value") < 0)]))
    return T.read_reports(spark, out).select("vintage", "rule_id", "n_bad", "n_total")


def _landed(batch, path):
    """Write a feed in its own partitions; how many files a micro-batch must take to hold all of it."""
    batch.write.parquet(path)
    return max(1000, len(batch.sparkSession.read.schema(batch.schema).parquet(path).inputFiles()))


@query("s2_bounded_revisions", f"""WITH {LOTS}, cur AS (SELECT * FROM lots WHERE source = 'legacy'), b AS (SELECT * FROM lots WHERE source = 'live'),
 m AS (SELECT max(auction_date) - 14 AS cut FROM cur), recent AS (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {ORDER}) AS k FROM
 (SELECT cur.* FROM cur, m WHERE auction_date >= cut UNION ALL SELECT b.* FROM b, m WHERE auction_date >= cut))
 SELECT 'merged' AS part, {KEY}, l_orderkey, l_linenumber, {q('price_low')} AS price_low FROM cur, m WHERE auction_date < cut
 UNION ALL SELECT 'merged', {KEY}, l_orderkey, l_linenumber, {q('price_low')} FROM recent WHERE k = 1
 UNION ALL SELECT 'late', {KEY}, b.l_orderkey, b.l_linenumber, {q('b.price_low')} FROM b, m WHERE auction_date < cut
 AND NOT EXISTS (SELECT 1 FROM cur c WHERE c.l_orderkey = b.l_orderkey AND c.l_partkey = b.l_partkey AND c.l_suppkey = b.l_suppkey AND c.l_linenumber = b.l_linenumber)""")
def _(spark, d):
    """History arrives first, then the same under another vintage, which changes nothing, then a
    feed that revises it."""
    both = lots(spark, d)
    out = fresh_path(spark, "revisions")
    legacy = both.filter("source = 'legacy'")
    again = legacy.withColumn("vintage", F.date_add("vintage", -7))
    for n, batch in enumerate((legacy, again, both.filter("source = 'live'"))):
        feed = R.file_stream(spark, f"{out}/in/*", both.schema, per_batch=_landed(batch, f"{out}/in/{n}"))
        R.revise(feed, f"{out}/state", f"{out}/late", LOT_KEY, "auction_date", 14, f"{out}/checkpoint", ties=TIES).awaitTermination()
    shown = (*LOT_KEY, "l_orderkey", "l_linenumber", "price_low")
    parts = [spark.read.parquet(f"{out}/{f}").select(F.lit(p).alias("part"), *shown) for f, p in (("state", "merged"), ("late", "late"))]
    return rounded(parts[0].unionByName(parts[1]), "price_low")


WEEKLY_COLUMNS = f"event_type, count(*) AS n, {q('sum(value)', 2)} AS total, min(value) AS low, max(value) AS high"
WEEKLY = f"SELECT CAST(date_trunc('week', ts) AS DATE) AS week, {WEEKLY_COLUMNS} FROM events GROUP BY 1, 2"
EVENT_TYPE = ("event_type",)


@query("s3_weekly_windows", WEEKLY)
def _(spark, d):
    stream, out = _stream(spark, d)
    W.run_windows(stream, EVENT_TYPE, out, f"{out}/checkpoint").awaitTermination()
    return rounded(W.read_windows(spark, out, EVENT_TYPE), "total", digits=2)


@query("s3_weekly_windows_batch", WEEKLY)
def _(spark, d):
    return rounded(W.weekly(table(spark, d, "events"), EVENT_TYPE, "ts", "value"), "total", digits=2)


# Three feeds: the first weeks, the later ones, and stragglers from all of them.
SPLIT = datetime(2024, 1, 12)
FEEDS = f"""e AS (SELECT *, CASE WHEN event_id % 10 = 0 THEN 2 WHEN ts < TIMESTAMP '{SPLIT}' THEN 0 ELSE 1 END AS batch, date_trunc('week', ts) AS week FROM events),
 m AS (SELECT f.batch, max(e.ts) - INTERVAL 7 DAY AS mark FROM (VALUES (0), (1), (2)) f(batch) LEFT JOIN e ON e.batch < f.batch GROUP BY 1),
 l AS (SELECT e.*, coalesce(week + INTERVAL 7 DAY <= mark, false) AS late FROM e JOIN m USING (batch))"""


def _three_feeds(spark, d):
    events = table(spark, d, "events")
    out = fresh_path(spark, "weeks")
    straggler = F.col("event_id") % 10 == 0
    first = F.col("ts") < F.lit(SPLIT)
    for n, chosen in enumerate((~straggler & first, ~straggler & ~first, straggler)):
        per_batch = _landed(events.filter(chosen), f"{out}/in/{n}")
        feed = R.file_stream(spark, f"{out}/in/*", events.schema, per_batch=per_batch)
        W.run_windows(feed, EVENT_TYPE, out, f"{out}/checkpoint", delay="7 DAYS").awaitTermination()
    return out


@query("s3_late_rows", f"""WITH {FEEDS} SELECT CASE WHEN late THEN 'late' ELSE 'window' END AS part, CAST(week AS DATE) AS week, {WEEKLY_COLUMNS} FROM l GROUP BY 1, 2, event_type""")
def _(spark, d):
    """Windows and late rows together hold every event."""
    out = _three_feeds(spark, d)
    late = W.weekly(W.read_late(spark, out), EVENT_TYPE, "ts", "value")
    both = [df.withColumn("part", F.lit(p)) for p, df in (("window", W.read_windows(spark, out, EVENT_TYPE)), ("late", late))]
    return rounded(both[0].unionByName(both[1]), "total", digits=2)


@query("s3_late_gate", f"""WITH {FEEDS}, g AS (SELECT batch, count(*) FILTER (late) AS n_late, count(*) AS n_total FROM l GROUP BY 1)
 SELECT batch, 'late_rows' AS rule_id, n_late AS n_bad, n_total, n_late > 0 AS failed FROM g UNION ALL SELECT batch, 'untimed_rows', 0, n_total, false FROM g""")
def _(spark, d):
    """The gate counts what was set aside and fails the batch that brought it."""
    report = W.read_gates(spark, _three_feeds(spark, d))
    failed = Q.failures(report).select("batch", "rule_id", F.lit(True).alias("failed"))
    out = report.join(failed, ["batch", "rule_id"], "left")
    return out.select("batch", "rule_id", "n_bad", "n_total", F.coalesce("failed", F.lit(False)).alias("failed"))
