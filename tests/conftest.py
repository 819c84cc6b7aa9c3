import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from drover.session import builder, release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        builder("tests").master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture
def rows():
    """Collect as plain tuples, sorted, doubles rounded."""

    def collect(df, digits=4):
        tidy = lambda v: round(v, digits) if isinstance(v, float) else v
        return sorted((tuple(tidy(v) for v in r) for r in df.collect()), key=repr)

    return collect
