"""Price-insurance summaries and back-test.

``policies`` has one row per endorsement. Summaries start from :func:`policy_cube`, a
table of (core flag, year, state) that is computed in one scan; every state, window
and year view is a roll-up of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drover.config import (
    BACKTEST_TYPES,
    CI_Z,
    HOME_STATE,
    MIN_BIN_N,
    UNATTRIBUTED_STATE,
    YEAR_WINDOWS,
)
from drover.functions import formats
from drover.functions.bins import coverage_bin, coverage_label
from drover.functions.columns import county_id, positive_ratio, safe_ratio, sum0
from drover.functions.dates import year_window_start, year_windows_of
from drover.functions.weighted import ZERO_IF_MISSING, from_parts, merge_parts, parts
from drover.operators.quantiles import counts_and_percentile

YEAR = "reinsurance_year"
# Output names of the summaries and the columns behind them.
COUNTS = (
    "n_endorsements_earning", "n_endorsements_indemn", "n_head", "liability_amount",
    "producer_premium_amount", "subsidy_amount", "total_premium_amount", "indemnity_amount",
)
MEANS = {
    "avg_endorsement_length_weeks": "length_weeks",
    "avg_coverage_price": "coverage_price",
    "avg_expected_end_value": "expected_end_value",
    "avg_coverage_level_pct": "coverage_level_pct",
    "avg_cost_per_cwt": "cost_per_cwt",
}
NATIONAL = "All"


def is_core(types: tuple[str, ...] = BACKTEST_TYPES) -> Column:
    return F.coalesce(F.col("type_code").isin(*types), F.lit(False))


# ---- windows -------------------------------------------------------------------------


def year_bounds(df: DataFrame) -> tuple[Column, Column]:
    """First and last year of ``df`` as constants (0 and 0 when empty). Two numbers reach the
    driver when this is called; a subquery would be computed anew in every plan it is used in."""
    return tuple(F.lit(int(y or 0)) for y in df.agg(F.min(YEAR), F.max(YEAR)).first())


def apply_year_window(df: DataFrame, window: str, bounds_of: DataFrame | None = None) -> DataFrame:
    """Rows in a calendar-year window that ends at the latest year of ``bounds_of``
    (default ``df`` itself). An unknown window name raises."""
    if window == "all":
        return df.filter(F.col(YEAR).isNotNull())
    first, last = year_bounds(df if bounds_of is None else bounds_of)
    return df.filter(F.col(YEAR).between(year_window_start(window, first, last), last))


def window_bounds(df: DataFrame) -> DataFrame:
    """First and last year of every window."""
    first, last = year_bounds(df)
    rows = [
        F.struct(F.lit(w).alias("window"), year_window_start(w, first, last).alias("first_year"), last.alias("last_year"))
        for w in YEAR_WINDOWS
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def available_states(df: DataFrame, first: str = HOME_STATE) -> DataFrame:
    """Real states, the home state first."""
    return (
        df.filter(F.col("state_abbr").isNotNull() & (F.col("state_abbr") != UNATTRIBUTED_STATE))
        .select("state_abbr")
        .distinct()
        .orderBy(F.col("state_abbr") != first, "state_abbr")
    )


def available_years(df: DataFrame) -> DataFrame:
    return df.filter(F.col(YEAR).isNotNull()).select(F.col(YEAR).cast("int").alias(YEAR)).distinct().orderBy(YEAR)


def backtest_subset(
    policies: DataFrame, state: str | None = None, window: str = "all", include_unattributed: bool = True
) -> DataFrame:
    """Core types in a window and state. Window bounds come from the core types of all
    states. Nationally, unattributed rows stay only if asked for."""
    sub = apply_year_window(policies.filter(is_core()), window)
    return sub.filter(in_area(state, include_unattributed))


def in_area(state: str | None = None, include_unattributed: bool = True) -> Column:
    """Whether a row belongs to a state or to the nation."""
    if state not in (None, NATIONAL):
        return F.col("state_abbr") == state
    return F.lit(True) if include_unattributed else F.col("state_abbr") != UNATTRIBUTED_STATE


def slice_sizes(policies: DataFrame, slices: dict[str, tuple[str | None, str, bool]]) -> DataFrame:
    """Rows of several back-test subsets, as (part, n): slices are (state, window, include
    unattributed). All are counted in one pass, after one for the bounds."""
    core = policies.filter(is_core())
    first, last = year_bounds(core)
    inside = {
        part: F.col(YEAR).between(year_window_start(window, first, last), last) & in_area(state, attributed)
        for part, (state, window, attributed) in slices.items()
    }
    counted = core.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(part) for part, c in inside.items()])
    lines = F.array(*[F.struct(F.lit(part).alias("part"), F.col(part).alias("n")) for part in slices])
    return counted.select(F.inline(lines))


# ---- summaries -----------------------------------------------------------------------


CUBE_KEYS = ("core", YEAR, "state_abbr")


def policy_cube(policies: DataFrame) -> DataFrame:
    """Sums and weighted-mean parts per (core flag, year, state)."""
    means = [c for out, src in MEANS.items() for c in parts(src, "n_head", ZERO_IF_MISSING, out)]
    return policies.groupBy(is_core().alias("core"), F.col(YEAR).cast("int").alias(YEAR), "state_abbr").agg(
        F.count(F.lit(1)).alias("rows"),
        *[sum0(c).alias(c) for c in COUNTS],
        F.coalesce(F.sum("total_weight_cwt"), F.lit(0.0)).alias("total_weight_cwt"),
        *means,
    )


def revised_cube(cube: DataFrame, changes: DataFrame, sign: str = "_sign") -> DataFrame:
    """The cube of a table after ``changes``: rows that came with ``sign`` 1, and rows that they replaced
    or that went with -1. Only the changes are read besides the cube.

    Every column of a cube is a sum, so cells are added and taken off. Sums of doubles agree with
    those of a full rebuild to the last digits; a cell whose last row goes, goes with it.
    """
    sums = [c for c in cube.columns if c not in CUBE_KEYS]
    came, went = (policy_cube(changes.filter(F.col(sign) == s)) for s in (1, -1))
    taken = went.select(*CUBE_KEYS, *[(-F.col(c)).alias(c) for c in sums])
    after = cube.unionByName(came).unionByName(taken).groupBy(*CUBE_KEYS).agg(*[F.sum(c).alias(c) for c in sums])
    return after.filter("rows > 0")


def _roll_up(cells: DataFrame, *keys: str | Column) -> DataFrame:
    merged = [c for out in MEANS for c in merge_parts(out)]
    sums = ("rows", *COUNTS, "total_weight_cwt")
    rolled = cells.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *merged)
    named = rolled.withColumns({out: from_parts(out, ZERO_IF_MISSING) for out in MEANS})
    return named.drop(*[f"{out}_{p}" for out in MEANS for p in ("wx", "w", "x", "n")])


def _ratios(producer_share: bool = True, ratio=safe_ratio) -> dict[str, Column]:
    out = {
        "indemnified_share": ratio("n_endorsements_indemn", "n_endorsements_earning"),
        "indemnity_to_producer_premium_rate": ratio("indemnity_amount", "producer_premium_amount"),
        "subsidy_share": ratio("subsidy_amount", "total_premium_amount"),
    }
    if producer_share:
        out["producer_share_of_premium"] = ratio("producer_premium_amount", "total_premium_amount")
    return out


def _padded(years: DataFrame, spine: DataFrame, keys: list[str]) -> DataFrame:
    """Zero-fill years without rows. Their weight total stays null, except in a slice with
    no rows at all, where everything is zero."""
    slice_rows = F.sum("rows").over(Window.partitionBy(*([k for k in keys if k != YEAR] or [F.lit(1)])))
    filled = spine.join(years, keys, "left").withColumn("_slice_rows", slice_rows)
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in COUNTS}
    zeros |= {c: F.coalesce(c, F.lit(0.0)) for c in MEANS}
    zeros["total_weight_cwt"] = F.when(F.col("_slice_rows").isNull(), F.lit(0.0)).otherwise(F.col("total_weight_cwt"))
    return filled.withColumns(zeros).drop("rows", "_slice_rows").withColumns(_ratios())


def yearly_summary(cube: DataFrame, state: str | None = None, window: str = "all") -> DataFrame:
    """One row per year of the window; the year axis spans the whole corpus, the rows come
    from the core types. Nationally, unattributed rows count."""
    core = cube.filter("core")
    cells = apply_year_window(core, window)
    if state not in (None, NATIONAL):
        cells = cells.filter(F.col("state_abbr") == state)
    first, last = year_bounds(cube)
    spine = cube.sparkSession.range(1).select(
        F.explode(F.sequence(year_window_start(window, first, last), last)).alias(YEAR)
    )
    return _padded(_roll_up(cells, YEAR), spine, [YEAR])


def yearly_summary_by_state(cube: DataFrame) -> DataFrame:
    """All states and the nation at once, each on the full year axis."""
    first, last = year_bounds(cube)
    core = cube.filter("core")
    groups = core.withColumn("area", F.explode(_areas()))
    states = cube.filter(F.col("state_abbr").isNotNull()).select(F.explode(_areas()).alias("area")).distinct()
    spine = states.select("area", F.explode(F.sequence(first, last)).alias(YEAR))
    return _padded(_roll_up(groups, "area", YEAR), spine, ["area", YEAR])


def _areas() -> Column:
    """A row counts for its state and the nation; unattributed rows for the nation only."""
    attributed = F.col("state_abbr").isNotNull() & (F.col("state_abbr") != UNATTRIBUTED_STATE)
    return F.when(attributed, F.array("state_abbr", F.lit(NATIONAL))).otherwise(F.array(F.lit(NATIONAL)))


def _state_rollup(cells: DataFrame, *keys: str) -> DataFrame:
    return _roll_up(cells, *keys).drop("rows", *MEANS).withColumns(_ratios(producer_share=False))


def _attributed(cube: DataFrame) -> DataFrame:
    return cube.filter("core").filter(F.col("state_abbr") != UNATTRIBUTED_STATE)


def state_summary(cube: DataFrame, window: str = "last_5") -> DataFrame:
    """Per state, largest producer premium first."""
    cells = apply_year_window(_attributed(cube), window, bounds_of=cube.filter("core"))
    return _state_rollup(cells, "state_abbr").orderBy(F.desc("producer_premium_amount"), "state_abbr")


def state_summary_by_window(cube: DataFrame) -> DataFrame:
    """Per (window, state): all windows from one pass over the cube."""
    first, last = year_bounds(cube.filter("core"))
    fanned = _attributed(cube).withColumn("window", F.explode(year_windows_of(YEAR, first, last, YEAR_WINDOWS)))
    return _state_rollup(fanned, "window", "state_abbr")


def benchmark_rows(cube: DataFrame, window: str, selected: str, home: str = HOME_STATE, top: int = 10) -> DataFrame:
    """Top states by premium, plus the home and the selected state with their own rank."""
    by_premium = Window.partitionBy("window").orderBy(F.desc("producer_premium_amount"), "state_abbr")
    ranked = (
        state_summary_by_window(cube)
        .filter(F.col("window") == window)
        .withColumn("rank", F.row_number().over(by_premium))
    )
    return ranked.filter((F.col("rank") <= top) | F.col("state_abbr").isin(home, selected))


def benchmark_text(rows: DataFrame) -> DataFrame:
    """Benchmark rows as display text."""
    return rows.select(
        "rank",
        F.col("state_abbr").alias("state"),
        formats.whole("n_endorsements_earning").alias("endorsements"),
        formats.whole("n_head").alias("head"),
        formats.millions("producer_premium_amount").alias("producer_premium"),
        formats.millions("indemnity_amount").alias("indemnity"),
        formats.percent("indemnified_share").alias("indemnified_share"),
    )


COUNTY_KEYS = ("state_abbr", "state_fips", "county_fips", "fips_5", "county_name")


def county_summary(policies: DataFrame, state: str, window: str = "last_5") -> DataFrame:
    """Per county of one state; rows with missing county keys form their own group."""
    sub = backtest_subset(policies, state, window, include_unattributed=False)
    sums = ("n_endorsements_earning", "n_head", "producer_premium_amount", "indemnity_amount")
    with_id = sub.withColumn("fips_5", county_id("state_fips", "county_fips"))
    return with_id.groupBy(*COUNTY_KEYS).agg(
        *[sum0(c).alias(c) for c in (*sums[:1], "n_endorsements_indemn", *sums[1:])]
    ).orderBy(F.desc("producer_premium_amount"), F.asc_nulls_last("fips_5"))


def summary_metrics(cube: DataFrame, state: str | None = None, year: int | Column | None = None) -> DataFrame:
    """One record for a (state, year); default year is the latest of the slice. An empty
    slice gives ``rows = 0`` and nulls."""
    cells = cube.filter("core")
    if state not in (None, NATIONAL):
        cells = cells.filter(F.col("state_abbr") == state)
    if year is None:
        chosen = F.coalesce(cells.agg(F.max(YEAR)).scalar(), F.lit(0))
    else:
        chosen = year if isinstance(year, Column) else F.lit(year)
    record = _roll_up(cells.filter(F.col(YEAR) == chosen))
    return record.withColumns(_ratios(ratio=positive_ratio)).select(
        F.lit(state or NATIONAL).alias("state_abbr"),
        chosen.cast("int").alias("year"),
        F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
        *COUNTS, "total_weight_cwt", *MEANS,
        "indemnified_share", "indemnity_to_producer_premium_rate", "subsidy_share", "producer_share_of_premium",
    )


def latest_year_metrics(cube: DataFrame) -> DataFrame:
    """At-a-glance record for the nation and every state at its latest year.

    The latest year looks at all types; the sums only at core types.
    """
    areas = cube.filter(F.col(YEAR).isNotNull()).withColumn("area", F.explode(_areas()))
    w = Window.partitionBy("area")
    latest = areas.withColumn("latest_year", F.max(YEAR).over(w)).filter(F.col(YEAR) == F.col("latest_year"))
    return _roll_up(latest.filter("core"), "area", "latest_year").withColumns(_ratios(ratio=positive_ratio))


def glance_text(metrics: DataFrame) -> DataFrame:
    """At-a-glance records as (area, position, group, metric, value) rows of display text."""
    use, cost, design, outcome = "Participation / use", "Cost / subsidy", "Coverage design", "Outcome / payout"
    # Groups, labels and formats of the at-a-glance table, in order.
    lines = [
        (use, "Endorsements earning premium", formats.whole("n_endorsements_earning")),
        (use, "Endorsements indemnified", formats.whole("n_endorsements_indemn")),
        (use, "Net head insured", formats.whole("n_head")),
        (use, "Total weight (cwt)", formats.whole("total_weight_cwt")),
        (use, "Liability ($)", formats.millions("liability_amount")),
        (cost, "Producer premium ($)", formats.millions("producer_premium_amount")),
        (cost, "Subsidy ($)", formats.millions("subsidy_amount")),
        (cost, "Total premium ($)", formats.millions("total_premium_amount")),
        (cost, "Subsidy share of total premium", formats.percent("subsidy_share")),
        (cost, "Producer share of total premium", formats.percent("producer_share_of_premium")),
        (cost, "Avg cost per cwt", formats.dollars("avg_cost_per_cwt")),
        (design, "Avg endorsement length", formats.weeks("avg_endorsement_length_weeks")),
        (design, "Avg coverage price ($/cwt)", formats.dollars("avg_coverage_price")),
        (design, "Avg expected end value ($/cwt)", formats.dollars("avg_expected_end_value")),
        (design, "Avg coverage level", formats.percent("avg_coverage_level_pct")),
        (outcome, "Indemnity ($)", formats.millions("indemnity_amount")),
        (outcome, "Indemnified-endorsement share", formats.percent("indemnified_share")),
        (outcome, "Indemnity-to-producer-premium ratio", formats.decimals("indemnity_to_producer_premium_rate")),
    ]
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(g).alias("group"), F.lit(m).alias("metric"), v.alias("value"))
        for i, (g, m, v) in enumerate(lines, start=1)
    ])
    return metrics.select("area", "latest_year", F.inline(cells))


# ---- back-test -----------------------------------------------------------------------


def with_advantage(policies: DataFrame) -> DataFrame:
    """Payout minus producer premium per unit of weight; rows without weight are dropped."""
    return policies.filter(F.col("total_weight_cwt") > 0).withColumn(
        "advantage_per_cwt",
        (F.col("indemnity_amount") - F.col("producer_premium_amount")) / F.col("total_weight_cwt"),
    )


def _backtest_parts() -> list[Column]:
    adv = F.col("advantage_per_cwt")
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(adv).alias("n_adv"),
        F.avg(adv).alias("mean"),
        (F.var_pop(adv) * F.count(adv)).alias("m2"),
        F.count_if(F.col("indemnity_amount") > 0).alias("n_indemnified"),
        sum0("n_head").alias("head"),
        F.coalesce(F.sum("total_weight_cwt"), F.lit(0.0)).alias("weight"),
    ]


def _merge_backtest(cells: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Combine (count, mean, squared deviation) cells, then derive the statistics."""
    n = F.sum("n_adv")
    mean = F.sum(F.col("mean") * F.col("n_adv")) / n
    m2 = F.sum("m2") + F.sum(F.col("n_adv") * F.col("mean") * F.col("mean")) - n * mean * mean
    merged = cells.groupBy(*keys).agg(
        F.sum("n").alias("n_endorsements"),
        F.when(n > 0, mean).alias("mean_advantage_per_cwt"),
        F.when(n > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1))).alias("std_advantage_per_cwt"),
        F.sum("n_indemnified").alias("n_indemnified"),
        F.sum("head").alias("total_head"),
        F.sum("weight").alias("total_weight_cwt"),
    )
    sem = F.col("std_advantage_per_cwt") / F.sqrt(F.col("n_endorsements").cast("double"))
    return merged.withColumns({
        "sem_advantage_per_cwt": sem,
        "ci95_lower": F.col("mean_advantage_per_cwt") - CI_Z * sem,
        "ci95_upper": F.col("mean_advantage_per_cwt") + CI_Z * sem,
        "indemnified_share": F.col("n_indemnified") / F.col("n_endorsements"),
        "suppressed": F.col("n_endorsements") < MIN_BIN_N,
    })


COVERAGE_COLUMNS = (
    "coverage_level_pct", "n_endorsements", "mean_advantage_per_cwt", "median_advantage_per_cwt",
    "std_advantage_per_cwt", "sem_advantage_per_cwt", "ci95_lower", "ci95_upper",
    "indemnified_share", "total_head", "total_weight_cwt", "suppressed",
)


def _coverage_rows(sub: DataFrame) -> DataFrame:
    return (
        with_advantage(sub)
        .withColumn("coverage_level_pct", coverage_bin("coverage_level_pct"))
        .filter(F.col("coverage_level_pct").isNotNull())
    )


def by_coverage(policies: DataFrame, state: str | None = None, window: str = "all") -> DataFrame:
    """Back-test statistics per coverage bin of one slice."""
    return _with_medians(_coverage_rows(backtest_subset(policies, state, window)), ("coverage_level_pct",)).select(*COVERAGE_COLUMNS)


def _with_medians(rows: DataFrame, keys: tuple[str, ...], base: tuple[str, ...] | None = None, fan=None) -> DataFrame:
    """Merged back-test statistics and the exact median per group."""
    cells, median = counts_and_percentile(
        rows, keys, "advantage_per_cwt", 0.5, "median_advantage_per_cwt", _backtest_parts(), base, fan
    )
    stats = _merge_backtest(fan(cells) if fan else cells, keys)
    return stats.join(median, list(keys), "left")


def by_coverage_everywhere(policies: DataFrame) -> DataFrame:
    """Back-test statistics for every (window, state or nation, coverage bin).

    Counts, means and deviations are first reduced to (year, state, bin) cells; windows
    and areas multiply only those cells, and so do the bucket counts behind the medians.
    Rows meet the (at most eight) slices they belong to only in the last step of the
    median, where all but those near the wanted rank drop out before the shuffle.
    """
    core = policies.filter(is_core())
    first, last = year_bounds(core)
    windows = F.explode(year_windows_of(YEAR, first, last, YEAR_WINDOWS))
    keys = ("window", "area", "coverage_level_pct")
    rows = _coverage_rows(core).filter(F.col(YEAR).isNotNull())
    base = (YEAR, "state_abbr", "coverage_level_pct")
    fan = lambda df: df.withColumn("window", windows).withColumn("area", F.explode(_areas()))
    return _with_medians(rows, keys, base, fan).select("window", "area", *COVERAGE_COLUMNS)


def by_year(policies: DataFrame, state: str | None = None, window: str = "all") -> DataFrame:
    """Count, mean, median and indemnified share per year of one slice."""
    rows = with_advantage(backtest_subset(policies, state, window))
    return _with_medians(rows, (YEAR,)).select(
        YEAR, "n_endorsements", "mean_advantage_per_cwt", "median_advantage_per_cwt", "n_indemnified", "indemnified_share"
    )


def sample_summary(policies: DataFrame, state: str | None = None, window: str = "all") -> DataFrame:
    """Size and share disclosure of a slice; zeros when it is empty."""
    return sample_summaries(policies, (state,), window)


def sample_summaries(policies: DataFrame, states: tuple[str | None, ...], window: str = "all") -> DataFrame:
    """:func:`sample_summary` of several states or the nation (None) in one pass: a row fans
    out to the slices it belongs to, and partial sums come before the shuffle."""
    labels = {s or NATIONAL: "National (all states)" if s in (None, NATIONAL) else s for s in states}
    rows = with_advantage(backtest_subset(policies, None, window))
    own = F.filter(F.array(*map(F.lit, labels)), lambda s: F.coalesce((s == NATIONAL) | (s == F.col("state_abbr")), F.lit(False)))
    paid = F.count_if(F.col("indemnity_amount") > 0)
    stats = rows.withColumn("_area", F.explode(own)).groupBy("_area").agg(
        F.count(F.lit(1)).alias("n_endorsements"),
        paid.alias("n_indemnified"),
        F.min(YEAR).cast("int").alias("year_min"),
        F.max(YEAR).cast("int").alias("year_max"),
        F.try_divide(paid, F.count(F.lit(1))).alias("indemnified_share"),
        F.avg("advantage_per_cwt").alias("mean_advantage_per_cwt"),
    )
    wanted = F.array(*[F.struct(F.lit(a).alias("_area"), F.lit(t).alias("state_label")) for a, t in labels.items()])
    asked = policies.sparkSession.range(1).select(F.inline(wanted))
    return asked.join(stats, "_area", "left").drop("_area").na.fill(0)


def visible_bins(stats: DataFrame) -> DataFrame:
    """Bins large enough to show, with interval offsets around the mean."""
    mean = F.col("mean_advantage_per_cwt")
    return stats.filter(~F.col("suppressed")).withColumns({
        "range_label": coverage_label("coverage_level_pct"),
        "err_up": F.coalesce(F.col("ci95_upper") - mean, F.lit(0.0)),
        "err_dn": F.coalesce(mean - F.col("ci95_lower"), F.lit(0.0)),
    })
