import pytest

from drover.llm.base import ship

EXTRA = "size string, score string, shard string, spans string, node string, rank string, _text string, target string, text_crc32 string, _first string, _source string"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, lang, source]) with extra columns whose names clash."""
    ship(spark)

    def make(rows):
        full = [(r[0], r[1], *(r[2:] + ("en", "a")[len(r) - 2 :]), len(r[1] or ""), *["x"] * len(EXTRA.split(", "))) for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")

    return make
