"""The key of a filing: its period folder and its file name, which packs ``cik_date_ext``.

A name alone is not unique: it holds neither the filer's prefix nor the year of the accession number.
Files of one name in two period folders are two filings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.text import without_zeros


# A folder that holds the filings of one period.
PERIOD_FOLDER = r"^rawdata_\d{4}_QTR\d$"


def file_id_of(path: Column) -> Column:
    """Base name of a path without its extension, behind its folder if that is one period's."""
    name = F.regexp_replace(F.substring_index(path, "/", -1), r"(.)\.[^.]*$", "$1")
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(folder.rlike(PERIOD_FOLDER), F.concat_ws("/", folder, name)).otherwise(name)


def name_of(file_id: Column) -> Column:
    """The file name in a key, without folder and extension."""
    return F.substring_index(file_id, "/", -1)


def cik_of(file_id: Column) -> Column:
    return F.substring_index(name_of(file_id), "_", 1)


def date_of(file_id: Column) -> Column:
    return F.substring_index(F.substring_index(name_of(file_id), "_", 2), "_", -1)


def file_key(files: DataFrame) -> DataFrame:
    """Unpack ``file_id`` into cik, filed_on and ext; names without exactly three parts go."""
    parts = F.split(name_of(F.col("file_id")), "_")
    return files.filter(F.size(parts) == 3).select(
        "file_id",
        F.get(parts, 0).alias("cik"),
        F.get(parts, 1).alias("filed_on"),
        F.get(parts, 2).alias("ext"),
    )


def local_key(index: DataFrame) -> DataFrame:
    """Local file name and folder of every index row.

    The extension is the last dash part of the remote name with the characters of ``.txt``
    taken off both ends and leading zeros dropped. It is not unique across filers and years,
    so it stays an attribute; ``accession`` is the identity.
    """
    tail = F.substring_index("filename", "-", -1)
    ext = without_zeros(F.btrim(tail, F.lit(".tx")))
    return index.select(
        "year",
        "quarter",
        F.regexp_replace(F.substring_index("filename", "/", -1), r"\.txt$", "").alias("accession"),
        F.concat_ws("_", without_zeros(F.col("cik")), "date_filed", ext).alias("local_key"),
        F.concat(F.lit("rawdata_"), F.col("year").cast("string"), F.lit("_QTR"),
                 F.col("quarter").cast("string")).alias("folder"),
    )


def identities(index: DataFrame) -> DataFrame:
    """Local key and accession of every index row, and how many accessions share the local key in its folder.

    A key with ``n_same`` over 1 names several filings; the accession tells them apart.
    """
    keyed = local_key(index)
    same = keyed.groupBy("folder", "local_key").agg(F.count_distinct("accession").alias("n_same"))
    return keyed.join(same, ["folder", "local_key"]).select(
        "year", "quarter", "accession", "local_key", F.concat_ws("/", "folder", "local_key").alias("file_id"), "n_same"
    )
