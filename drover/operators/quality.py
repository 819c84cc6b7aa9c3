"""Data-quality gates. Every gate yields rows of
``rule_id, severity, n_bad, n_total, sample`` where ``n_bad > 0`` is an issue."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drover import config as C
from drover.functions.columns import marker_to_null, number
from drover.operators.profile import CELL, class_shares, weeks_per_year
from drover.session import materialize

FAIL, WARN = "fail", "warn"


@dataclass(frozen=True)
class Rule:
    """``bad`` marks offending rows; ``scope`` marks the rows the rule looks at."""

    rule_id: str
    bad: Column
    scope: Column | None = None
    severity: str = FAIL
    sample: Column | None = None


def run_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Evaluate all rules in one aggregation over ``df``."""
    aggs = []
    for i, r in enumerate(rules):
        inside = F.lit(True) if r.scope is None else F.coalesce(r.scope, F.lit(False))
        hit = inside & F.coalesce(r.bad, F.lit(False))
        shown = F.lit(None).cast("string") if r.sample is None else r.sample.cast("string")
        aggs += [
            F.count_if(hit).alias(f"_bad{i}"),
            F.count_if(inside).alias(f"_all{i}"),
            F.min(F.when(hit, shown)).alias(f"_s{i}"),
        ]
    lines = F.array(*[
        F.struct(
            F.lit(r.rule_id).alias("rule_id"),
            F.lit(r.severity).alias("severity"),
            F.col(f"_bad{i}").alias("n_bad"),
            F.col(f"_all{i}").alias("n_total"),
            F.col(f"_s{i}").alias("sample"),
        )
        for i, r in enumerate(rules)
    ])
    return df.agg(*aggs).select(F.inline(lines))


def all_issues(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def failures(report: DataFrame) -> DataFrame:
    return report.filter((F.col("severity") == FAIL) & (F.col("n_bad") > 0))


def line(df: DataFrame, rule_id: str, bad: Column, sample: Column | None = None, severity: str = FAIL) -> DataFrame:
    """A report of one rule."""
    return run_rules(df, [Rule(rule_id, bad, severity=severity, sample=sample)])


# ---- shapes --------------------------------------------------------------------------


def key_signature(df: DataFrame, body: str, row_path: str | None = None, levels: dict[str, str] | None = None) -> DataFrame:
    """Hash of the sorted key names of each JSON text, and of the objects below it: ``levels``
    maps the name of a level to its path, ``row_path`` is a level called row. Looks at
    every row; one line per distinct shape."""
    names = lambda c: F.array_join(F.array_sort(F.json_object_keys(c)), ",")
    shape = F.concat(F.lit("root:"), F.coalesce(names(F.col(body)), F.lit("list")))
    for level, path in ((levels or {}) | ({"row": row_path} if row_path else {})).items():
        inner = names(F.get_json_object(body, path))
        shape = F.concat(shape, F.coalesce(F.concat(F.lit(f"|{level}:"), inner), F.lit("")))
    return df.groupBy(shape.alias("shape")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "signature", F.sha2("shape", 256)
    )


def check_signature(found: DataFrame, baseline: str | None) -> DataFrame:
    """Shapes that differ from the recorded baseline; the first run has none to compare."""
    bad = F.lit(False) if baseline is None else F.col("signature") != baseline
    return line(found, "schema_signature", bad, F.col("shape"))


def signature_gate(found: DataFrame, path: str, rebaseline: bool = False) -> DataFrame:
    """Shapes that are not in the baseline recorded under ``path``. The first run records what
    it finds and passes; later the baseline only changes when ``rebaseline`` is set."""
    from drover.sources.tables import read_optional

    spark = found.sparkSession
    known = None if rebaseline else read_optional(spark, path)
    if known is None:
        found.select("signature", "shape").write.mode("overwrite").parquet(path)
        return line(found, "schema_signature", F.lit(False), F.col("shape"))
    marked = found.join(known.select("signature", F.lit(True).alias("_known")), "signature", "left")
    return line(marked, "schema_signature", F.col("_known").isNull(), F.col("shape"))


def schema_hash(columns: list[tuple[int, str, str, str]]) -> str:
    """Hash of a declared schema: (position, source name, name, type) per column."""
    import hashlib

    body = "".join(f"{i}|{src}|{name}|{kind}\n" for i, src, name, kind in columns)
    return hashlib.sha256(body.encode()).hexdigest()


def required_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    return df.sparkSession.range(1).select(
        F.lit("required_columns").alias("rule_id"),
        F.lit(FAIL).alias("severity"),
        F.lit(len(missing)).cast("long").alias("n_bad"),
        F.lit(len(names)).cast("long").alias("n_total"),
        F.lit(",".join(missing) or None).cast("string").alias("sample"),
    )


# ---- insurance -----------------------------------------------------------------------


def policy_rules() -> list[Rule]:
    """Value rules for endorsements; dollar bounds apply to the core types only, because
    other types may be priced per head."""
    core = F.col("type_code").isin(*C.BACKTEST_TYPES)
    col = F.col

    def bounds(name: str, lo: float, hi: float) -> list[Rule]:
        scope = core & col(name).isNotNull()
        return [
            Rule(f"{name}_low", col(name) < lo, scope, sample=col(name)),
            Rule(f"{name}_high", col(name) > hi, scope, sample=col(name)),
        ]

    level = col("coverage_level_pct")
    return [
        *bounds("coverage_price", C.PRICE_MIN, C.PRICE_MAX),
        *bounds("expected_end_value", C.PRICE_MIN, C.PRICE_MAX),
        *bounds("cost_per_cwt", C.PREMIUM_PER_CWT_MIN, C.PREMIUM_PER_CWT_MAX),
        Rule("coverage_level_pct_range", (level < 0) | (level > 1), level.isNotNull(), sample=level),
        Rule("length_weeks_value", ~col("length_weeks").isin(*C.ENDORSEMENT_WEEKS), col("length_weeks").isNotNull(), sample=col("length_weeks")),
        Rule("effective_date_missing", col("effective_date").isNull()),
        Rule("end_date_missing", col("end_date").isNull()),
        Rule("end_before_start", col("end_date") < col("effective_date"), col("effective_date").isNotNull() & col("end_date").isNotNull()),
        # The columns that may not be negative.
        *[
            Rule(f"{c}_negative", col(c) < 0, col(c).isNotNull(), sample=col(c))
            for c in (
                "n_endorsements_earning", "n_endorsements_indemn", "n_head", "subsidy_amount",
                "total_premium_amount", "producer_premium_amount", "liability_amount", "total_weight_cwt",
            )
        ],
        Rule("commodity_code_filter", ~col("commodity_code").eqNullSafe(F.lit(C.FEEDER_COMMODITY_CODE))),
        Rule("plan_code_filter", ~col("plan_code").eqNullSafe(F.lit(C.INSURANCE_PLAN_CODE))),
    ]


def not_empty(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("_n")).select(
        F.lit("not_empty").alias("rule_id"),
        F.lit(FAIL).alias("severity"),
        F.when(F.col("_n") == 0, 1).otherwise(0).cast("long").alias("n_bad"),
        F.col("_n").alias("n_total"),
        F.lit(None).cast("string").alias("sample"),
    )


def check_years(df: DataFrame, raw_years: DataFrame, this_year: int, first: int = C.FIRST_INSURANCE_YEAR) -> DataFrame:
    """Years in range, and every year with a raw file present."""
    year = F.col("reinsurance_year")
    years = df.filter(year.isNotNull()).select(year.cast("int").alias("reinsurance_year")).distinct()
    wanted = raw_years.select(F.col("reinsurance_year").cast("int").alias("reinsurance_year")).distinct()
    have = years.withColumn("_have", F.lit(1))
    checked = wanted.join(have, "reinsurance_year", "left")
    return all_issues(
        line(years, "year_range", ~year.between(first, this_year), year),
        line(checked, "year_missing", F.col("_have").isNull(), year),
    )


# ---- lots ----------------------------------------------------------------------------


#: Fields of raw lot rows that :func:`raw_lot_issues` looks at.
LOT_ISSUE_FIELDS = (
    "commodity", "price_unit", "avg_price", "avg_price_min", "avg_price_max", "head_count", "weight_break_low", "weight_break_high",
)


def raw_lot_issues(raw: DataFrame) -> DataFrame:
    """Issue counts on raw lot rows (text columns). A row can add several issues."""
    names = ("avg_price", "avg_price_min", "avg_price_max", "head_count")
    scope = (F.col("commodity") == C.FEEDER) & (F.col("price_unit") == C.PER_CWT)
    # Staged, so that a text is made a number once and not in every rule.
    staged = raw.filter(scope).withColumns({f"_{name}_shown": marker_to_null(name) for name in names})
    staged = staged.withColumns({f"_{name}": number(f"_{name}_shown") for name in names}).withColumn(
        "_span", F.floor(number("weight_break_high")) - F.floor(number("weight_break_low"))
    )
    not_numeric = lambda name: Rule(f"{name}_not_numeric", F.col(f"_{name}_shown").isNotNull() & F.col(f"_{name}").isNull(), sample=F.col(name))
    rules = []
    for name in names[:3]:
        rules += [not_numeric(name), Rule(f"{name}_bounds", ~F.col(f"_{name}").between(C.PRICE_MIN, C.PRICE_MAX), sample=F.col(name))]
    span = F.col("_span")
    rules += [
        not_numeric("head_count"),
        Rule("head_count_negative", F.col("_head_count") < 0, sample=F.col("head_count")),
        Rule("weight_span", ~((span > 0) & (span <= C.MAX_WEIGHT_SPAN)), sample=span),
    ]
    return run_rules(staged, [Rule(r.rule_id, r.bad, severity=WARN, sample=r.sample) for r in rules])


def lot_value_gate(raw: DataFrame, tolerance: float = C.MAX_BAD_ROW_SHARE) -> DataFrame:
    """Single bad rows are tolerated; fails when issues exceed ``tolerance`` of the feeder
    rows, or when there are no feeder rows."""
    total = raw_lot_issues(raw).agg(F.sum("n_bad").alias("_bad"), F.max("n_total").alias("_n"))
    over = (F.col("_n") == 0) | (F.col("_bad") / F.greatest("_n", F.lit(1)) > tolerance)
    return total.select(
        F.lit("lot_values").alias("rule_id"),
        F.when(over, FAIL).otherwise(WARN).alias("severity"),
        F.when(F.col("_n") == 0, F.lit(1)).otherwise(F.col("_bad")).cast("long").alias("n_bad"),
        F.col("_n").alias("n_total"),
        F.lit(None).cast("string").alias("sample"),
    )


def lot_continuity(new: DataFrame, prior: DataFrame, day: str = "auction_date", weeks: int = C.REVISION_WEEKS) -> DataFrame:
    """No unseen date older than the newest prior date minus ``weeks``; a prior date older than
    that which vanished is a warning."""
    fresh, known = new.select(day).distinct(), prior.select(day).distinct()
    newest = known.agg(F.max(day)).scalar()
    cutoff = F.date_sub(newest, 7 * weeks)
    unseen = fresh.join(known, day, "left_anti")
    gone = known.join(fresh, day, "left_anti")
    return all_issues(
        line(unseen, "deep_history_date", F.col(day) < cutoff, F.col(day)),
        line(gone, "vanished_date", F.col(day) < cutoff, F.col(day), WARN),
    )


# ---- price index ---------------------------------------------------------------------


def monthly(raw: DataFrame) -> DataFrame:
    """Raw (year, period, value) text rows of real months, with the numeric value."""
    return raw.filter(F.col("period").rlike("^M(0[1-9]|1[0-2])$")).select(
        F.make_date(F.col("year").cast("int"), F.substring("period", 2, 2).cast("int"), F.lit(1)).alias("period"),
        F.col("value").alias("raw_value"),
        marker_to_null("value").alias("shown"),
        number(marker_to_null("value")).alias("cpi_u"),
    )


def monthly_change(raw: DataFrame, limit: float = C.MAX_MONTHLY_CHANGE) -> DataFrame:
    """Month-over-month change. A missing or invalid month is a gap: the next month has
    nothing to compare with. Points of one month are first reduced to one, the largest as
    text, so the window over the series sees one row per calendar month."""
    w = Window.partitionBy(F.lit(1)).orderBy("period")
    points = monthly(raw).groupBy("period").agg(F.max(F.struct("raw_value", "shown", "cpi_u")).alias("_p")).select("period", "_p.*")
    before = F.lag("cpi_u").over(w)
    change = F.try_divide(F.col("cpi_u") - before, before)
    return points.withColumns({
        "change": change,
        "flagged": F.coalesce(F.abs(change) > limit, F.lit(False)),
        "invalid": F.col("shown").isNotNull() & F.col("cpi_u").isNull(),
    })


def index_gate(raw: DataFrame, limit: float = C.MAX_MONTHLY_CHANGE) -> DataFrame:
    return run_rules(monthly_change(raw, limit), [
        Rule("index_not_numeric", F.col("invalid"), sample=F.col("raw_value")),
        Rule("index_monthly_change", F.col("flagged"), sample=F.col("period")),
    ])


def index_continuity(new: DataFrame, prior: DataFrame, depth: int = C.REVISION_MONTHS, tolerance: float = 1e-6) -> DataFrame:
    """At most one month is added, the series never ends earlier, and months older than
    the last ``depth`` prior months neither change nor appear."""
    ends = new.agg(F.max("period").alias("_new"), F.count("period").alias("_n"))
    last = prior.agg(F.max("period")).scalar()
    added = F.months_between("_new", last).cast("int")
    ending = ends.select("_new", "_n", added.alias("_added"))
    old = new.filter(F.col("period") <= F.add_months(last, -depth)).join(
        prior.select("period", F.col("cpi_u").alias("_was")), "period", "left"
    )
    return all_issues(
        run_rules(ending, [
            Rule("index_has_rows", F.col("_n") == 0),
            Rule("index_ends_earlier", F.col("_added") < 0, sample=F.col("_new")),
            Rule("index_adds_months", F.col("_added") > 1, sample=F.col("_added")),
        ]),
        run_rules(old, [
            Rule("index_new_history", F.col("_was").isNull(), sample=F.col("period")),
            Rule("index_deep_revision", F.abs(F.col("_was") - F.col("cpi_u")) > tolerance, sample=F.col("period")),
        ]),
    )


# ---- historical batch ----------------------------------------------------------------


HISTORY_COLUMNS = (
    "auction_date", "commodity", "class", "frame", "muscle_grade", "head_count",
    "price_low", "price_high", "price_avg", "receipts", "vintage",
)


def history_rules(window: tuple[date, date] = C.HISTORY_WINDOW) -> list[Rule]:
    day, price = F.col("auction_date"), F.col("price_avg")
    return [
        Rule("auction_date_missing", day.isNull()),
        Rule("auction_date_window", ~day.between(*[F.lit(d) for d in window]), sample=day),
        Rule("class_value", ~F.coalesce(F.col("class").isin(*C.FEEDER_CLASSES), F.lit(False)), sample=F.col("class")),
        Rule("grade_value", ~F.coalesce(F.col("muscle_grade").isin(*C.GRADES), F.lit(False)), severity=WARN, sample=F.col("muscle_grade")),
        Rule("price_missing", price.isNull()),
        Rule("price_bounds", ~price.between(C.PRICE_MIN, C.PRICE_MAX), sample=price),
    ]


def floor_table(floors: dict) -> Column:
    """Array of (key, floor) pairs for a small fixed table."""
    return F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("floor")) for k, v in floors.items()])


def coverage_gate(df: DataFrame, floors: dict[int, int] = C.WEEKS_PER_YEAR_FLOORS) -> DataFrame:
    """Each listed year has enough distinct sale dates; an absent year has none."""
    wanted = df.sparkSession.range(1).select(F.inline(floor_table(floors)))
    found = wanted.join(weeks_per_year(df).withColumnRenamed("year", "key"), "key", "left")
    return line(found, "weeks_per_year", F.coalesce("n_weeks", F.lit(0)) < F.col("floor"), F.col("key"))


def balance_gate(
    df: DataFrame,
    floors: dict[str, float] = C.CLASS_SHARE_FLOORS,
    warn_only: tuple[tuple[int, str], ...] = C.CLASS_SHARE_WARN_ONLY,
    weight: Column | None = None,
) -> DataFrame:
    """Each class keeps its minimum share every year; listed exceptions only warn. ``weight``
    is the rows that a row stands for, if it is a cell."""
    floor = F.lit(None).cast("double")
    for name, share in floors.items():
        floor = F.when(F.col("class") == name, F.lit(share)).otherwise(floor)
    excused = reduce(
        lambda a, b: a | b, [(F.col("year") == y) & (F.col("class") == c) for y, c in warn_only], F.lit(False)
    )
    shares = class_shares(df, tuple(floors), weight=weight)
    label = F.concat_ws(" ", "year", "class")
    low = F.col("share") < floor
    return run_rules(shares, [
        Rule("class_share", low, ~excused, sample=label),
        Rule("class_share_excused", low, excused, WARN, sample=label),
    ])


def history_gate(
    df: DataFrame, window: tuple[date, date] = C.HISTORY_WINDOW, weeks: dict[int, int] = C.WEEKS_PER_YEAR_FLOORS,
    shares: dict[str, float] = C.CLASS_SHARE_FLOORS, warn_only: tuple[tuple[int, str], ...] = C.CLASS_SHARE_WARN_ONLY,
) -> DataFrame:
    """All gates of a historical batch from one scan: every counter is kept per (date, class),
    and the reports roll up from those cells."""
    rules = history_rules(window)
    counters = []
    for i, r in enumerate(rules):
        bad = F.coalesce(r.bad, F.lit(False))
        shown = F.lit(None).cast("string") if r.sample is None else r.sample.cast("string")
        counters += [F.count_if(bad).alias(f"_bad{i}"), F.min(F.when(bad, shown)).alias(f"_s{i}")]
    cells = materialize(df.groupBy("auction_date", "class").agg(F.count(F.lit(1)).alias("_rows"), *counters), "history")
    n = F.coalesce(F.sum("_rows"), F.lit(0))
    lines = [F.struct(F.lit("not_empty").alias("rule_id"), F.lit(FAIL).alias("severity"), F.when(n == 0, 1).otherwise(0).cast("long").alias("n_bad"),
                      n.alias("n_total"), F.lit(None).cast("string").alias("sample"))]
    lines += [
        F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.coalesce(F.sum(f"_bad{i}"), F.lit(0)).alias("n_bad"),
                 n.alias("n_total"), F.min(f"_s{i}").alias("sample"))
        for i, r in enumerate(rules)
    ]
    totals = cells.agg(F.array(*lines).alias("_lines")).select(F.inline("_lines"))
    return all_issues(
        totals, required_columns(df, HISTORY_COLUMNS), coverage_gate(cells, weeks), balance_gate(cells, shares, warn_only, F.col("_rows")),
    )


# ---- two-source consistency ----------------------------------------------------------


def consistency_of(medians: DataFrame, ours: str, theirs: str, source: str = "source") -> DataFrame:
    """:func:`consistency_cells` from one table of medians that has the source as a key, so
    that both sides come from the same scans."""
    side = lambda name: medians.filter(F.col(source) == name)
    return consistency_cells(side(ours), side(theirs))


def consistency_cells(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Annual medians of two sources side by side, difference in percent of theirs."""
    a = ours.select(*CELL, F.col("price_median").alias("our_median"), F.col("n_obs").alias("our_n"))
    b = theirs.select(*CELL, F.col("price_median").alias("ref_median"), F.col("n_obs").alias("ref_n"))
    delta = F.try_divide(F.col("our_median") - F.col("ref_median"), "ref_median") * 100
    return b.join(a, list(CELL)).withColumns({"delta_pct": delta, "abs_delta_pct": F.abs(delta)})


def consistency_summary(cells: DataFrame) -> DataFrame:
    """Mean, median and max difference with threshold counts and a verdict. One row per
    (year, class, bin) comes in, so the exact median is over a bounded set."""
    d = F.col("abs_delta_pct")
    # The two thresholds that are counted.
    summary = cells.agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.avg(d).alias("mean_abs"),
        F.percentile(d, F.lit(0.5)).alias("median_abs"),
        F.max(d).alias("max_abs"),
        F.count_if(d > 5).alias("n_over_5"),
        F.count_if(d > 10).alias("n_over_10"),
    )
    mean, top = F.col("mean_abs"), F.col("max_abs")
    return summary.withColumn(
        "verdict",
        F.when(F.col("n_cells") == 0, "skipped")
        .when((mean > C.CONSISTENCY_MEAN_FAIL) | (top > C.CONSISTENCY_MAX_FAIL), FAIL)
        .when((mean > C.CONSISTENCY_MEAN_WARN) | (top > C.CONSISTENCY_MAX_WARN), WARN)
        .otherwise("pass"),
    )


def worst_cells(cells: DataFrame, n: int = 3) -> DataFrame:
    """The cells that differ most."""
    return cells.orderBy(F.desc("abs_delta_pct"), *CELL).limit(n)


# ---- manifest ------------------------------------------------------------------------


def manifest_gate(manifest: DataFrame) -> DataFrame:
    """There are entries, and each has its required keys."""
    return all_issues(
        not_empty(manifest),
        run_rules(manifest, [
            Rule(f"manifest_{k}", F.col(k).isNull()) for k in ("vintage", "sha256", "written_at_utc")
        ]),
        manifest_order(manifest),
    )


def manifest_order(manifest: DataFrame) -> DataFrame:
    """The entry written last within a dataset is its newest vintage. Entries are in the order
    of ``position`` where there is one, else in that of their write time."""
    order = "position" if "position" in manifest.columns else "written_at_utc"
    ends = manifest.groupBy("dataset").agg(F.max_by("vintage", order).alias("_last"), F.max("vintage").alias("_newest"))
    return line(ends, "manifest_last_is_newest", F.col("_last") != F.col("_newest"), F.col("dataset"))
