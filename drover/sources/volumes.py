"""Long text files in volumes.

No fast codec of the text reader can be split, so a compressed file is one task's. A long file is kept in
volumes instead: files that each end at the end of a line, compressed one by one, and follow one
another by a number in their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names as Spark gives them under ``maxRecordsPerFile``: ``x.c000.txt.lz4``, ``x.c001.txt.lz4`` and on. The group is the number.
NUMBERED = r"\.c(\d{3,})(?:\.\w+)*$"
#: Rows of text in a volume of :func:`write`.
ROWS = 100_000


def whole(name: Column, volumes: str | None) -> Column:
    """Path or name of the file that a volume belongs to, which of a file without volumes is its own."""
    return name if volumes is None else F.regexp_replace(name, volumes, "")


def number(name: Column, volumes: str | None) -> Column:
    """Place of a volume in its file."""
    return F.lit(0) if volumes is None else F.coalesce(F.regexp_extract(name, volumes, 1).try_cast("int"), F.lit(0))


def write(rows: DataFrame, by: list[str], path: str) -> None:
    """Write the texts ``value`` to one file per key ``by``, in volumes named as :data:`NUMBERED` says. The rows of
    a key have to lie in one partition, sorted by the key."""
    rows.select(*by, "value").write.partitionBy(*by).option("maxRecordsPerFile", ROWS).option("compression", "lz4").text(path)
