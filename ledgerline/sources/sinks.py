"""Where results go: Parquet partitioned by period, and CSV for those who want text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.operators.merge import as_written, definite_options, option_candidates
from ledgerline.sources.commits import new_commit, record, with_period, write


def write_by_period(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per year and quarter; a period too big for one task is split over several."""
    (
        table.hint("rebalance", "year", "quarter")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "quarter")
        .parquet(path)
    )


def write_csv(table: DataFrame, path: str) -> None:
    """Text export with a heading; quotes only where a value needs them, doubled inside."""
    table.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", nullValue="")


def write_merged(stock: DataFrame, folder: str, commit: str | None = None) -> DataFrame:
    """Stock, option and definite-option tables of new filings, from one computation of the holdings.

    The stock rows are written once and the other two are filters of them; returns the stock rows.
    Without a commit that goes on, these three tables are a commit of their own.
    """
    own = commit or new_commit()
    written = write(with_period(stock, "filename"), folder, "stock", own)
    write(option_candidates(written), folder, "option", own)
    write(definite_options(written), folder, "option_def", own)
    if not commit:
        record(written.select(F.col("filename").alias("file_id"), "year", "quarter").distinct(), folder, own)
    return written


def export_merged(stock: DataFrame, folder: str) -> None:
    """The three merged tables as CSV text, in the published column order.

    Rebalanced, since a first part without rows would be a file with nothing but the heading.
    """
    for name, table in (
        ("StockFile", stock),
        ("OptionFile", option_candidates(stock)),
        ("OptionDef", definite_options(stock)),
    ):
        write_csv(as_written(table).hint("rebalance"), f"{folder}/{name}")
