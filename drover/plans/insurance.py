"""Insurance corpus to published tables and page lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame

from drover import config as C
from drover.operators import insurance, quality, vintage
from drover.session import materialize
from drover.sources import endorsements, tables


def summaries(policies: DataFrame) -> dict[str, DataFrame]:
    """Every descriptive summary from one scan of the endorsements."""
    cube = materialize(insurance.policy_cube(policies), "policies")
    return {
        "yearly": insurance.yearly_summary_by_state(cube),
        "states": insurance.state_summary_by_window(cube),
        "glance": insurance.glance_text(insurance.latest_year_metrics(cube)),
        "window_bounds": insurance.window_bounds(cube),
    }


def backtest(policies: DataFrame) -> DataFrame:
    """Back-test bins of every window and area, ready to show."""
    return insurance.visible_bins(insurance.by_coverage_everywhere(policies))


def refresh(lines: DataFrame, root: str, tag: str, this_year: int) -> bool:
    """Raw lines to a published corpus, gated on values and on year coverage."""
    corpus = materialize(endorsements.corpus(lines, tag), "corpus")
    raw_years = endorsements.with_file_tags(lines.select("file_name").distinct()).selectExpr(
        "file_year AS reinsurance_year"
    )
    report = quality.all_issues(
        quality.not_empty(corpus),
        quality.run_rules(corpus, quality.policy_rules()),
        quality.check_years(corpus, raw_years, this_year),
    )
    ordered = vintage.in_publication_order(corpus.drop("file_year"), C.POLICY_ORDER)
    return tables.publish(ordered, root, "endorsements", tag, report)
