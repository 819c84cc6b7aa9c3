"""All bound queries."""

from binding import gates, ingest, insurance, prices, scenarios, streams  # noqa: F401
from binding.registry import QUERIES, SQL  # noqa: F401
