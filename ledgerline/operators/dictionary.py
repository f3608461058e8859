"""The dictionary of accepted identifier spellings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions.text import without_zeros

SPELLINGS = ("full", "issuer", "short", "stripped")


def security_dictionary(
    master: DataFrame, list_a: DataFrame, list_b: DataFrame, spellings=SPELLINGS
) -> DataFrame:
    """Distinct union of the identifier spellings of three security tables.

    ``spellings`` says how liberal the set is: ``full`` the 9 characters, ``issuer`` the first
    six, ``short`` 8 characters, ``stripped`` any of these without leading zeros.
    """
    id8, check, issuer = F.col("cusip8"), F.col("issue_check"), F.col("issuer_num")
    cusip, ncusip = F.col("cusip"), F.col("ncusip")
    bare8 = without_zeros(id8)
    # Table by table what each choice adds, so that a table is read once.
    added = {
        "full": ([F.concat(id8, check)], [], []),
        "issuer": ([issuer], [], []),
        "short": ([], [cusip, ncusip], [cusip]),
        "stripped": (
            [without_zeros(issuer), bare8, F.concat(bare8, check)],
            [without_zeros(cusip), without_zeros(ncusip)],
            [without_zeros(cusip)],
        ),
    }
    parts = []
    for table, *columns in zip((master, list_a, list_b), *(added[choice] for choice in added if choice in spellings)):
        keys = [key for some in columns for key in some]
        if keys:
            parts.append(table.select(F.explode(F.array(*keys)).alias("key")))
    return reduce(DataFrame.unionByName, parts).filter(F.col("key").isNotNull()).distinct()


def lookup_keys(dictionary: DataFrame) -> DataFrame:
    """The part of the dictionary that decides a lookup, far smaller than the whole.

    A candidate is accepted by itself or by its first six characters. A longer spelling whose
    first six characters are listed too can thus never change an answer and is left out. What
    remains also meets a candidate at most once: by its prefix or by itself, never by both.
    """
    short = dictionary.filter(F.length("key") <= 6)
    long = dictionary.filter(F.length("key") > 6)
    listed = short.select(F.col("key").alias("prefix"))
    kept = long.withColumn("prefix", F.substring("key", 1, 6)).join(listed, "prefix", "left_anti")
    return short.unionByName(kept.select("key"))


def entity_ids(entities: DataFrame) -> DataFrame:
    """Distinct entity ids of the three id columns, leading zeros dropped."""
    ids = F.array("reportedcik", "wrds_cik", "cik_may16")
    return (
        entities.select(F.explode(ids).alias("raw"))
        .filter(F.col("raw").isNotNull())
        .select(without_zeros(F.col("raw")).alias("cik"))
        .distinct()
    )
