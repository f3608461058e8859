"""Which filings are there, which belong to the entities of interest, which are still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions.keys import cik_of

FOLDER = r"rawdata_(\d{4})_(QTR\d)$"


def manifest(files: DataFrame) -> DataFrame:
    """(cik, year, qtr, path, size, filename) of every text file in ``files(path, size)``."""
    name = F.substring_index("path", "/", -1)
    folder = F.regexp_replace("path", r"/[^/]*$", "")
    return files.filter(name.endswith(".txt")).select(
        cik_of(name).alias("cik"),
        F.regexp_extract(folder, FOLDER, 1).alias("year"),
        F.regexp_extract(folder, FOLDER, 2).alias("qtr"),
        folder.alias("path"),
        F.col("size").cast("bigint").alias("size"),
        name.alias("filename"),
    )


def of_entities(manifest: DataFrame, entities: DataFrame) -> DataFrame:
    """The part of the manifest whose filer is an entity of interest."""
    return manifest.join(entities.select("cik"), "cik", "left_semi")


def not_yet(table: DataFrame, done: DataFrame, key: str = "file_id") -> DataFrame:
    """Rows whose key the target does not hold yet."""
    return table.join(done.select(key), key, "left_anti")


def curated_folder(manifest: DataFrame, old: str, new: str) -> DataFrame:
    """Manifest with the path in the curated area: the first occurrence of ``old`` replaced."""
    at = F.instr("path", F.lit(old))
    moved = F.concat(
        F.substring("path", F.lit(1), at - 1),
        F.lit(new),
        F.substring("path", at + len(old), F.length("path")),
    )
    return manifest.withColumn("curated_path", F.when(at > 0, moved).otherwise(F.col("path")))
