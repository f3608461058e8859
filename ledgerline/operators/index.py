"""The quarterly index of filings, and which filings to take from it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions.rules import FORM_TYPES
from ledgerline.functions.text import clean_utf8, count_of, strip

# The columns of an index line, and its heading.
INDEX_COLUMNS = ["cik", "company", "form_type", "date_filed", "filename"]
INDEX_HEADING = "CIK|Company Name|Form Type|Date Filed|Filename"


def parse_index(lines: DataFrame) -> DataFrame:
    """Index rows of ``lines(year, quarter, line)``: at least four pipes, split at each, trimmed."""
    line = clean_utf8(F.col("line"))
    fields = F.split(line, r"\|")
    return lines.filter((count_of(line, "|") >= 4) & (strip(line) != INDEX_HEADING)).select(
        "year",
        "quarter",
        *[strip(F.get(fields, i)).alias(name) for i, name in enumerate(INDEX_COLUMNS)],
    )


def in_periods(table: DataFrame, years: Iterable[int], quarters: Iterable[int] = (1, 2, 3, 4)) -> DataFrame:
    """Rows of every year and quarter given; on a landed table this prunes partitions."""
    return table.filter(F.col("year").isin(list(years)) & F.col("quarter").isin(list(quarters)))


def by_form(index: DataFrame) -> DataFrame:
    """Filings and filers per form type."""
    return index.groupBy("form_type").agg(
        F.count(F.lit(1)).alias("n_filings"),
        F.countDistinct("cik").alias("n_filers"),
        F.min("date_filed").alias("first_filed"),
        F.max("date_filed").alias("last_filed"),
    )


def by_filer(index: DataFrame) -> DataFrame:
    """Filings per filer."""
    return index.groupBy("cik").agg(
        F.count(F.lit(1)).alias("n_filings"),
        F.min("date_filed").alias("first_filed"),
        F.max("date_filed").alias("last_filed"),
    )


def select_filings(
    index: DataFrame,
    ids: DataFrame | None = None,
    form_types: Iterable[str] | None = tuple(FORM_TYPES),
    first_date: str | None = None,
    last_date: str | None = None,
) -> DataFrame:
    """Filings of the given filers and form types; None takes all of them.

    ``ids(cik)`` is compared as written, zeros and all, and names each filer once. Dates are
    optional bounds on the filing date, as yyyy-mm-dd text.
    """
    if form_types is not None:
        index = index.filter(F.col("form_type").isin(list(form_types)))
    if first_date is not None:
        index = index.filter(F.col("date_filed") >= first_date)
    if last_date is not None:
        index = index.filter(F.col("date_filed") <= last_date)
    if ids is not None:
        index = index.join(ids.select("cik"), "cik", "left_semi")
    return index
