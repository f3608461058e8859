"""Tables written once and read many times, in the folder the cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.chunks import CHUNK_LINES, chunk_of

# Whether Spark removes a query's shuffle files at its end; else they stay until the driver collects garbage.
PASSING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Landed tables are written once and held on disk while others are made from them.
LANDED = "zstd"
LANDED_ROWS = 100_000

_OWN_FOLDERS: dict[str, str] = {}
_open = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches: ``spark.checkpoint.dir``.

    Where it is unset a local session takes a temporary folder, removed when the driver ends; on a
    cluster that would be another folder on each machine, so it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _OWN_FOLDERS:
        path = _OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="ledgerline-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    return _OWN_FOLDERS[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def land(table: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back.

    It cuts the lineage with files that outlive any executor, and gives later joins the exact
    size of the table. Partitioned tables are rebalanced first: few files per partition, and
    a hot partition is split over several tasks.
    """
    spark = table.sparkSession
    path = _noted(spark, fresh_path(spark, name))
    if partition_by:
        table = table.hint("rebalance", *partition_by)
    with passing_shuffles(spark):
        table.write.option("compression", LANDED).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def land_more(table: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Add a table to what lies in a folder already, which may have more columns; returns the rows of both.

    Files have a bounded number of rows, since the engine deals files to tasks by bytes, and rows that
    compress well would meet in one task.
    """
    spark = table.sparkSession
    with passing_shuffles(spark):
        table.write.mode("append").options(compression=LANDED, maxRecordsPerFile=LANDED_ROWS).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(table.schema).parquet(path)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when the write has ended, since nothing reads them any more."""
    usual = spark.conf.get(PASSING, None)
    spark.conf.set(PASSING, "true")
    try:
        yield
    finally:
        if usual is None:
            spark.conf.unset(PASSING)
        else:
            spark.conf.set(PASSING, usual)


def land_by_chunk(lines: DataFrame, buckets: int | None = None, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """Lines landed in buckets by ``(file_id, chunk)``, with their chunk as a column.

    They are shuffled this once; whatever meets them by chunk later comes to them. A bucket is one
    file; there are as many as shuffle partitions unless told otherwise. It is a table of the
    session's catalog, since only tables know their buckets.
    """
    spark = lines.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = _noted(spark, fresh_path(spark, "lines"))
    name = path.rsplit("/", 1)[1].replace("-", "_")
    dealt = lines.withColumn("chunk", chunk_of("line_no", chunk_lines)).repartition(buckets, "file_id", "chunk")
    dealt.write.bucketBy(buckets, "file_id", "chunk").option("path", path).saveAsTable(name)
    return spark.table(name)


def _noted(spark: SparkSession, path: str) -> str:
    for paths in getattr(_open, "scopes", [])[-1:]:
        paths.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables landed inside by this thread are removed at its end, also if that is an error.

    For work that is done when the scope ends: a table that is still to be computed must not read them.
    """
    scopes = _open.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            remove(spark, path)


def forget(table: DataFrame) -> None:
    """Delete a landed table that is not read again."""
    for file in table.inputFiles()[:1]:
        remove(table.sparkSession, file.rsplit("/", 1)[0])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fits(table: DataFrame, max_rows: int) -> bool:
    """Whether a table has at most ``max_rows`` rows; a plain count, which landed tables answer from their footers."""
    return table.count() <= max_rows
