"""Reference tables that users bring as CSV, read by column name and never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators.index import INDEX_COLUMNS

# The columns of the reference tables.
MASTER = ["CUSIP8", "ISSUE_CHECK", "ISSUER_NUM"]
LIST_A = ["CUSIP", "NCUSIP"]
LIST_B = ["CUSIP"]
ENTITIES = ["ReportedCIK", "WRDS_CIK", "CIK_May16"]
INDEX = ["CIK", "Company Name", "Form Type", "Date Filed", "Filename"]


def read_named(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns of a CSV file with a heading, all as text, wherever they stand in it."""
    table = spark.read.csv(path, header=True, inferSchema=False, escape='"', nullValue=None, emptyValue="")
    return table.select(*[F.coalesce(F.col(f"`{name}`"), F.lit("")).alias(name.lower()) for name in columns])


def read_master(spark: SparkSession, path: str) -> DataFrame:
    return read_named(spark, path, MASTER)


def read_list_a(spark: SparkSession, path: str) -> DataFrame:
    return read_named(spark, path, LIST_A)


def read_list_b(spark: SparkSession, path: str) -> DataFrame:
    return read_named(spark, path, LIST_B)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    return read_named(spark, path, ENTITIES)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned index written as CSV, as the parsed index names its columns."""
    return read_named(spark, path, INDEX).toDF(*INDEX_COLUMNS)
