"""Holdings to the published stock and option tables. Narrow: no step moves a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.keys import cik_of, date_of, name_of
from ledgerline.functions.rules import (
    DEFINITE_OPTIONS, FALSE_OPTIONS, FLAG_BAD, FLAG_EMPTY, FLAG_FALSE, FLAG_SAME, FLAG_TRUE,
    LONGEST_NAME, MISSING, RULES, java,
)
from ledgerline.functions.text import as_number
from ledgerline.operators.holdings import COLUMNS


def lacks_values() -> Column:
    """Option candidates the layout step could not split; no output takes them."""
    return F.col("poss_hit") & ((F.col("type") == MISSING) | (F.col("shares") == MISSING))


def quality_flag() -> Column:
    """How far to trust an option candidate; null for other holdings. The first rule that holds wins."""
    opt = F.col("opt")
    return (
        F.when(~F.col("poss_hit"), None)
        .when(F.length("name") > LONGEST_NAME, FLAG_BAD)
        .when((F.col("value") == "") | (F.col("shares") == ""), FLAG_EMPTY)
        .when(F.col("cusip").isin(F.col("value"), F.col("shares")), FLAG_SAME)
        .when(F.upper(opt).isin(FALSE_OPTIONS) | opt.rlike("[^0-9A-Za-z]"), FLAG_FALSE)
        .otherwise(FLAG_TRUE)
    )


def merged(holdings: DataFrame) -> DataFrame:
    """All kept holdings with provenance and flag: the stock table."""
    file_id = F.col("file_id")
    return holdings.filter(~lacks_values()).select(
        file_id.alias("filename"),
        cik_of(file_id).alias("cik"),
        date_of(file_id).alias("date"),
        "line_no",
        "poss_hit", "name", "type", "cusip", "value", "shares", "opt", "extra",
        quality_flag().alias("flagr"),
    )


def option_candidates(stock: DataFrame) -> DataFrame:
    return stock.filter("poss_hit")


def definite_options(stock: DataFrame) -> DataFrame:
    return stock.filter(F.upper("opt").isin(DEFINITE_OPTIONS))


def typed(stock: DataFrame) -> DataFrame:
    """Typed siblings of the raw text columns."""
    return stock.withColumns({
        "value_num": as_number(F.col("value")),
        "shares_num": as_number(F.col("shares")),
        "filed_on": F.try_to_date("date", "yyyy-MM-dd"),
    })


def as_written(stock: DataFrame) -> DataFrame:
    """The published text form: 12 columns, True and False spelled out, no value for no flag, names without folder."""
    return stock.select(
        name_of(F.col("filename")).alias("Filename"),
        F.col("cik").alias("CIK"),
        F.col("date").alias("Date"),
        F.initcap(F.col("poss_hit").cast("string")).alias("Poss_hit"),
        *[F.col(name).alias(name.upper() if name == "cusip" else name.capitalize())
          for name in COLUMNS[1:]],
        F.col("flagr").alias("FlagR"),
    )


def option_audit(eligible: DataFrame, holdings: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """Everything that looked like an option, as found in the line and as split, with its year."""
    texts = [F.col("poss_hit").cast("string")] + [F.col(name) for name in COLUMNS[1:]]
    found = eligible.filter(F.col("line").rlike(java(rules["Anyopt"]))).select(
        "file_id", "line_no", F.lit("line").alias("stage"), F.col("line").alias("text")
    )
    split = holdings.filter("poss_hit").select(
        "file_id", "line_no", F.lit("holding").alias("stage"), F.concat_ws("|", *texts).alias("text")
    )
    year = F.substring_index(date_of(F.col("file_id")), "-", 1).try_cast("int")
    return found.unionByName(split).withColumn("year", year)


def pattern_score(rows: DataFrame, columns: list[str], patterns: list[str]) -> DataFrame:
    """How many patterns are found in some column of a row, and whether all but one column's worth are."""
    def found(pattern):
        return reduce(Column.__or__, [F.col(name).rlike(java(pattern)) for name in columns])
    hits = reduce(Column.__add__, [found(pattern).cast("int") for pattern in patterns])
    return rows.withColumn("hits", hits).withColumn("passes", F.col("hits") + 1 >= len(columns))
