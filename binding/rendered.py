"""Raw files rendered from the driver's tables, written once per application and folder.

A source query is about reading raw text. Rendering the text is no part of it, so the files are
kept for later calls, until :func:`clear`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from binding.tables import table
from drover.session import shared_dir

#: Parts that the rows of a small table are dealt to before they are rendered: its file may be one row group.
PARTS = 32
#: Bytes from which the reader's own splits of a table are tasks enough, so that no row is moved.
LARGE = 128 << 20
_made: dict[tuple[str, str, str], str] = {}


def at_rest(spark: SparkSession, d: str, kind: str, write: Callable[[str], None]) -> str:
    """The folder that ``write`` has filled for these tables."""
    key = (spark.sparkContext.applicationId, str(d), kind)
    if key not in _made:
        path = f"{shared_dir(spark)}/raw-{kind}-{uuid.uuid4().hex}"
        write(path)
        _made[key] = path
    return _made[key]


def size_of(spark: SparkSession, path: str) -> int:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def dealt(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table of the driver, in parts enough to render it."""
    rows = table(spark, d, name)
    return rows if size_of(spark, f"{d}/{name}.parquet") >= LARGE else rows.repartition(PARTS)


def texts(spark: SparkSession, d: str, kind: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A rendered frame as a table at rest."""
    path = at_rest(spark, d, kind, lambda p: build().write.option("compression", "zstd").parquet(p))
    return spark.read.parquet(path)


def named_files(spark: SparkSession, d: str, kind: str, build: Callable[[], DataFrame]) -> str:
    """A folder with one text file per ``file_name`` of the frame's rows, under that name."""

    def write(path: str) -> None:
        build().select("file_name", "value").repartition("file_name").write.partitionBy("file_name").text(f"{path}/_parts")
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in fs.listStatus(hadoop(f"{path}/_parts")):
            if not folder.isDirectory():
                continue
            parts = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            if len(parts) != 1:
                raise RuntimeError(f"{folder.getPath()}: expected one part, found {len(parts)}")
            fs.rename(parts[0], hadoop(f"{path}/{folder.getPath().getName().partition('=')[2]}"))

    return at_rest(spark, d, kind, write)


def split_named_files(spark: SparkSession, d: str, kind: str, build: Callable[[], DataFrame]) -> str:
    """A folder with text files named by ``file_name``, one for each task that has rows of it, in
    folders ``part=0`` and on. Every task writes its own rows: none are moved or sorted."""

    def write(path: str) -> None:
        writers = "spark.sql.maxConcurrentOutputFileWriters"
        before = spark.conf.get(writers)
        spark.conf.set(writers, "100")
        try:
            build().select("file_name", "value").write.partitionBy("file_name").text(f"{path}/_parts")
        finally:
            spark.conf.set(writers, before)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in fs.listStatus(hadoop(f"{path}/_parts")):
            if not folder.isDirectory():
                continue
            parts = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            for i, part in enumerate(parts):
                fs.mkdirs(hadoop(f"{path}/part={i}"))
                if not fs.rename(part, hadoop(f"{path}/part={i}/{folder.getPath().getName().partition('=')[2]}")):
                    raise RuntimeError(f"{part}: not renamed")

    return at_rest(spark, d, kind, write)


def clear(spark: SparkSession) -> None:
    """Delete all rendered files of this driver."""
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.popitem()[1])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
