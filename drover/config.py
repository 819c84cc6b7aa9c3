"""Vocabulary, thresholds and column names. Every operator takes these as parameters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# ---- Fixed values: vocabulary and thresholds the results depend on -----------------
FEEDER = "Feeder Cattle"
SLAUGHTER = "Slaughter Cattle"
PER_CWT = "Per Cwt"
FEEDER_CLASSES = ("Steers", "Heifers", "Bulls")
SLAUGHTER_CLASSES = ("Cows", "Bulls", "Dairy Cows")
CORE_CLASSES = ("Steers", "Heifers")
CORE_FRAME = "Medium and Large"
CORE_GRADE = "1"
GRADES = ("1", "1-2", "2", "3")
PRICE_MIN, PRICE_MAX = 20.0, 800.0
SETTLE_MIN, SETTLE_MAX = 30.0, 600.0
BASE_MONTH = date(2025, 12, 1)
WINDOW_KEYS = ("all", "5y", "3y", "latest")
YEAR_WINDOWS = ("all", "last_5", "last_3", "latest")
CONTRACTS = ("MAY", "NOV", "NEARBY")
CONTRACT_COLUMNS = ("JAN", "MAR", "APR", "MAY", "AUG", "SEP", "OCT", "NOV", "NEARBY")
SETTLE_FALLBACK_DAYS = 5
BACKTEST_TYPES = ("809", "810", "811", "812")
FEEDER_COMMODITY_CODE = "0801"
INSURANCE_PLAN_CODE = "81"
HOME_STATE = "AZ"
UNATTRIBUTED_STATE = "XX"
COVERAGE_EDGES = (0.70, 0.75, 0.80, 0.85, 0.90, 0.95, 1.00)
MIN_BIN_N = 30
CI_Z = 1.96
ENDORSEMENT_WEEKS = (13, 17, 21, 26, 30, 34, 39, 43, 47, 52)
FIRST_INSURANCE_YEAR = 2003
PREMIUM_PER_CWT_MIN, PREMIUM_PER_CWT_MAX = 0.01, 100.0
MAX_WEIGHT_SPAN = 100
MAX_BAD_ROW_SHARE = 0.001
REVISION_WEEKS = 2
REVISION_MONTHS = 2
MAX_MONTHLY_CHANGE = 0.05
MISSING_MARKERS = ("", "-", "(NA)", "N/A", "(X)", "NA")
WEEKS_PER_YEAR_FLOORS = {2017: 9, 2018: 40, 2019: 12}
CLASS_SHARE_FLOORS = {"Steers": 0.30, "Heifers": 0.20, "Bulls": 0.03}
CLASS_SHARE_WARN_ONLY = ((2017, "Bulls"),)
CONSISTENCY_MEAN_FAIL, CONSISTENCY_MAX_FAIL = 5.0, 25.0
CONSISTENCY_MEAN_WARN, CONSISTENCY_MAX_WARN = 3.0, 10.0
HISTORY_WINDOW = (date(2017, 10, 4), date(2019, 4, 11))
LIVE_FLOOR = date(2019, 4, 17)
ROW_CAPS = (5000, 100000)

LOT_KEY = ("auction_date", "class", "frame", "muscle_grade", "weight_break_low", "weight_break_high")
LOT_ORDER = LOT_KEY
SLAUGHTER_ORDER = ("auction_date", "class", "quality_grade_name", "dressing")
POLICY_ORDER = (
    "reinsurance_year", "effective_date", "state_abbr", "county_fips",
    "type_code", "length_weeks", "coverage_price",
)
BASIS_ORDER = ("auction_date", "class", "weight_break_low", "contract_month")
# ---- end of fixed values -----------------------------------------------------------


@dataclass(frozen=True)
class LotScope:
    """Which lots count as the analytic core."""

    commodity: str | None = FEEDER
    classes: tuple[str, ...] = CORE_CLASSES
    frame: str = CORE_FRAME
    grade: str = CORE_GRADE


@dataclass(frozen=True)
class SpikeRule:
    """Centred rolling-median screen."""

    half_window: int = 6
    min_values: int = 5
    ratio_lo: float = 0.60
    ratio_hi: float = 1.0 / 0.60
    min_abs_dev: float = 50.0


@dataclass(frozen=True)
class Channel:
    """Cost structure of one way to sell a lot."""

    name: str
    commission_pct: float
    yardage: float
    inspection: float
    fees: float
    shrink_pct: float
    haul: str  # which distance applies: "local", "video" or "none"


# Default cost structures.
CHANNELS = (
    Channel("Local auction", 3.0, 7.0, 1.0, 0.0, 4.0, "local"),
    Channel("Special feeder sale", 4.0, 8.0, 1.0, 0.0, 4.0, "local"),
    Channel("Video auction", 2.0, 0.0, 0.0, 10.0, 2.0, "video"),
    Channel("Internet auction", 1.5, 0.0, 0.0, 0.0, 2.0, "video"),
    Channel("Private treaty", 0.0, 0.0, 0.0, 0.0, 2.0, "none"),
)
