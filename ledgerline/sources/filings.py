"""Raw filings: text files in ``rawdata_<year>_QTR<n>`` folders, read as numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.keys import file_id_of
from ledgerline.functions.text import NEWLINES, clean_utf8
from ledgerline.operators.chunks import number_rows, run_of
from ledgerline.sources.landing import land

# A filing up to this size is read in one piece; longer ones are read block by block.
WHOLE_BYTES = 32 * 1024 * 1024


def scan_files(spark: SparkSession, path: str) -> DataFrame:
    """``files(path, size)`` below a folder; the content is never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", F.col("length").alias("size"))
    )


def lines_of(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Split whole texts into numbered lines; a final line end adds no empty line, a leading byte-order mark is dropped."""
    whole = F.regexp_replace(clean_utf8(F.col(text)), "^\ufeff", "")
    ended = F.when(whole.endswith("\r\n"), 2).when(whole.endswith("\n") | whole.endswith("\r"), 1).otherwise(0)
    cut = F.substring(whole, F.lit(1), F.length(whole) - ended)
    return texts.filter(F.col(text) != "").select(
        key, F.posexplode(F.split(cut, NEWLINES)).alias("line_no", "line")
    )


def read_lines(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """``lines(file_id, line_no, line)`` of all filings at a glob such as ``raw/*/*.txt``.

    Files of usual size come as one value each and are split in place, without a shuffle.
    Longer files are read as splittable text, so that one huge filing is shared among tasks;
    their lines are numbered per block. The size decides in the listing: each file is read once.
    """
    size, name = F.col("_metadata.file_size"), F.col("_metadata.file_path")
    whole = (
        spark.read.text(path, wholetext=True).filter(size <= whole_bytes)
        .select(file_id_of(name).alias("file_id"), "value")
    )
    lines = lines_of(whole, "file_id", "value")
    if scan_files(spark, path).filter(F.col("size") > whole_bytes).isEmpty():
        return lines
    return lines.unionByName(read_long_lines(spark, path, whole_bytes))


def read_long_lines(spark: SparkSession, path: str, over_bytes: int) -> DataFrame:
    """Lines of the files longer than ``over_bytes``, each block of a file read by its own task.

    The running id of a task orders the lines inside a block. It is written down before the
    blocks are counted, so that both passes number the same lines. Lines are sorted in bounded runs
    of it, so a packed file, which is one block, is shared among tasks from there on.
    """
    blocks = (
        spark.read.text(path).filter(F.col("_metadata.file_size") > over_bytes)
        .select(
            file_id_of(F.col("_metadata.file_path")).alias("file_id"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            clean_utf8(F.col("value")).alias("line"),
        )
    )
    placed = land(blocks, "blocks").withColumn("run", run_of("block", "seq"))
    numbered = number_rows(placed, "file_id", "run", ["seq"], "line_no")
    return numbered.select("file_id", (F.col("line_no") - 1).cast("int").alias("line_no"), "line")


def read_index_lines(spark: SparkSession, path: str) -> DataFrame:
    """``lines(year, quarter, line)`` of index files below ``year=<y>/quarter=<q>`` folders."""
    return (
        spark.read.schema("value STRING, year INT, quarter INT").text(path)
        .select("year", "quarter", F.col("value").alias("line"))
    )
