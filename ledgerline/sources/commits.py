"""What is published: tables written commit by commit, and a small log of the filings in each.

A commit writes its rows to a folder of its own in each table and then, when all are there, the keys of
its filings to the log and one record that names it:

    <folder>/<table>/commit=<id>/year=<y>/quarter=<q>/   rows
    <folder>/_log/filings/commit=<id>/year=<y>/quarter=<q>/   keys, one row a filing
    <folder>/_log/commits/<id>/   the record

Rows count once their commit is recorded, so several tables change at once, and a commit that broke off
is as if it had never been. Made again under its id it overwrites what it left, and once recorded it is
not made again: work that is delivered twice is there once, in all tables.

Which filings are there is answered from the log alone. It is read for the periods in question, and
``merge_log`` turns the logs of many commits into one a period.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.keys import date_of
from ledgerline.sources.landing import LANDED, fits, passing_shuffles, remove

FILINGS, COMMITS = "_log/filings", "_log/commits"
# Keys of filings that are broadcast; some 60 bytes each.
BROADCAST_FILINGS = 300_000
_RECORD = "commit string, covers array<string>"
_LOGGED = "file_id string, commit string, year int, quarter int"


def new_commit() -> str:
    return f"run-{uuid.uuid4().hex}"


def with_period(table: DataFrame, key: str = "file_id") -> DataFrame:
    """Year and quarter of filing, from the file key; null where the key holds no date."""
    filed = F.try_to_date(date_of(F.col(key)), "yyyy-MM-dd")
    return table.withColumn("year", F.year(filed)).withColumn("quarter", F.quarter(filed))


def published(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """A published table, empty where there is none yet; other errors are errors."""
    try:
        return spark.read.schema(schema).options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return published(spark, f"{folder}/{COMMITS}", _RECORD, recursiveFileLookup=True)


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """``(commit)``: the recorded commits, those merged since included. One row a commit."""
    records = _records(spark, folder)
    every = F.array_append(F.coalesce("covers", F.array().cast("array<string>")), F.col("commit"))
    return records.select(F.explode(every).alias("commit")).distinct()


def _heads(spark: SparkSession, folder: str) -> DataFrame:
    """The commits whose logs count: those that no merged log covers."""
    records = _records(spark, folder)
    merged = records.select(F.explode("covers").alias("commit"))
    return records.select("commit").distinct().join(F.broadcast(merged), "commit", "left_anti")


def is_recorded(spark: SparkSession, folder: str, commit: str) -> bool:
    return not commits(spark, folder).where(F.col("commit") == commit).isEmpty()


def write(table: DataFrame, folder: str, name: str, commit: str) -> DataFrame:
    """Write a commit's rows of a table with ``year`` and ``quarter``, over what it left before; returns them as read back."""
    path = f"{folder}/{name}".rstrip("/") + f"/commit={commit}"
    with passing_shuffles(table.sparkSession):
        (
            table.hint("rebalance", "year", "quarter")
            .write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", LANDED)
            .partitionBy("year", "quarter").parquet(path)
        )
    return table.sparkSession.read.schema(table.schema).parquet(path)


def record(filings: DataFrame, folder: str, commit: str) -> None:
    """Log the filings ``(file_id, year, quarter)`` of a commit whose tables are written, and record it."""
    write(filings.select("file_id", "year", "quarter"), folder, FILINGS, commit)
    none = filings.sparkSession.range(1, numPartitions=1).select(F.array().cast("array<string>").alias("covers"))
    _put(none, folder, commit)


def _put(covers: DataFrame, folder: str, commit: str) -> None:
    covers.select(F.lit(commit).alias("commit"), "covers").write.mode("overwrite").parquet(f"{folder}/{COMMITS}/{commit}")


def read_table(spark: SparkSession, folder: str, name: str = "", schema: StructType | str | None = None) -> DataFrame:
    """The rows of all recorded commits of a published table; a table that may have no rows needs its schema, ``commit`` included."""
    path = f"{folder}/{name}".rstrip("/")
    return (published(spark, path, schema) if schema else spark.read.parquet(path)).join(F.broadcast(commits(spark, folder)), "commit", "left_semi")


def log(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_id, commit, year, quarter)`` of all published filings, partitioned by commit and period."""
    return published(spark, f"{folder}/{FILINGS}", _LOGGED).join(F.broadcast(_heads(spark, folder)), "commit", "left_semi")


def known(spark: SparkSession, folder: str, filings: DataFrame) -> DataFrame:
    """Those of ``filings(file_id, year, quarter)`` that are published.

    The log is opened for their periods only. A side small enough, counted, is broadcast; of two
    large ones the engine may build a bloom filter before they are shuffled.
    """
    # One row for each quarter of a calendar.
    periods = [r[0] for r in filings.select(_period().alias("period")).distinct().collect()]
    logged = log(spark, folder).where(_period().isin(periods)).select("file_id")
    if fits(filings, BROADCAST_FILINGS):
        logged = logged.join(F.broadcast(filings.select("file_id")), "file_id", "left_semi")
        return filings.join(F.broadcast(logged), "file_id", "left_semi")
    return filings.join(logged, "file_id", "left_semi")


def _period():
    return F.coalesce(F.col("year") * 10 + F.col("quarter"), F.lit(0))


def merge_log(spark: SparkSession, folder: str) -> None:
    """Turn the logs of all recorded commits into one, a few files a period; rows of tables stay where they are.

    The old logs and records go when the new ones are there. A merge that breaks off changes nothing.
    """
    merged, old = f"merged-{uuid.uuid4().hex}", [r["commit"] for r in _heads(spark, folder).collect()]
    if len(old) < 2:
        return
    write(log(spark, folder).select("file_id", "year", "quarter"), folder, FILINGS, merged)
    _put(commits(spark, folder).agg(F.collect_set("commit").alias("covers")), folder, merged)
    for commit in old:
        remove(spark, f"{folder}/{COMMITS}/{commit}")
        remove(spark, f"{folder}/{FILINGS}/commit={commit}")


def sweep(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """Remove the folders of commits that were never recorded; only while no commit is being made. Returns their ids."""
    counted = {r["commit"] for r in commits(spark, folder).collect()}
    gone = set()
    for name in [*names, FILINGS]:
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        store = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in store.listStatus(root) if store.exists(root) else []:
            commit = status.getPath().getName().removeprefix("commit=")
            if status.isDirectory() and status.getPath().getName().startswith("commit=") and commit not in counted:
                if name != FILINGS or not commit.startswith("merged-"):
                    gone.add(commit)
                remove(spark, status.getPath().toString())
    return sorted(gone)
