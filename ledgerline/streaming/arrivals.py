"""Filings as they arrive: each new file once, through the same operators as in batch.

Every step works per filing and a filing is one file, so nothing is carried from batch to batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.keys import file_id_of
from ledgerline.functions.rules import RULES
from ledgerline.functions.text import clean_utf8
from ledgerline.operators.chunks import number_rows, run_of
from ledgerline.plans.run import extract
from ledgerline.sources.filings import WHOLE_BYTES, lines_of
from ledgerline.sources.landing import land, scope


def arriving_filings(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stream of the lines of all new files, whatever their size, with the block they are in; see ``lines_of_blocks``."""
    return arriving_long_lines(spark, path, -1, **options)


def arriving_texts(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES, **options) -> DataFrame:
    """Stream of ``(file_id, text)``: new files of usual size, whole; ``arriving_filings`` takes files of any size."""
    return (
        spark.readStream.format("text").options(wholetext=True, **options).load(path)
        .filter(F.col("_metadata.file_size") <= whole_bytes)
        .select(file_id_of(F.col("_metadata.file_path")).alias("file_id"), F.col("value").alias("text"))
    )


def arriving_long_lines(
    spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES, **options
) -> DataFrame:
    """Stream of the lines of new files too long to be read whole, with the block they are in."""
    return (
        spark.readStream.format("text").options(**options).load(path)
        .filter(F.col("_metadata.file_size") > whole_bytes)
        .select(
            file_id_of(F.col("_metadata.file_path")).alias("file_id"),
            F.col("_metadata.file_block_start").alias("block"),
            clean_utf8(F.col("value")).alias("line"),
        )
    )


def lines_of_texts(batch: DataFrame) -> DataFrame:
    return lines_of(batch, "file_id", "text")


def lines_of_blocks(batch: DataFrame) -> DataFrame:
    """Numbered lines of a batch of long files; their order in a block is written down first."""
    blocks = land(batch.withColumn("seq", F.monotonically_increasing_id()), "blocks")
    numbered = number_rows(blocks.withColumn("run", run_of("block", "seq")), "file_id", "run", ["seq"], "line_no")
    return numbered.select("file_id", (F.col("line_no") - 1).cast("int").alias("line_no"), "line")


def ingest(
    arrivals: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
) -> None:
    """Work off everything that has arrived and stop.

    ``build`` turns a batch into the rows to publish. A batch may be delivered again after a
    failure; it overwrites the folder of its own number, so every row is there once.
    """
    def publish(batch: DataFrame, batch_id: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    (
        arrivals.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def arriving_bundles(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stream of the lines of new Parquet files ``(file_id, line_no, line)``, each with whole filings."""
    return spark.readStream.schema("file_id string, line_no int, line string").options(**options).parquet(path)


def publish(
    arrivals: DataFrame,
    keys: DataFrame,
    folder: str,
    checkpoint: str,
    lines_of_batch: Callable[[DataFrame], DataFrame] = lines_of_blocks,
    rules: dict[str, str] = RULES,
) -> None:
    """Work off everything that has arrived into the published tables, and stop.

    A batch is one commit, named after its stream (as its checkpoint has it) and its number. A batch that
    ended between two tables is made again under the same name and writes over what it left; one that was
    recorded before the stream could note it does nothing. Filings that any run published are left out.
    """
    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("a batch outside of its stream has no name")
        with scope(spark):
            extract(land(lines_of_batch(batch), "arrived"), keys, folder, rules, commit=f"stream-{stream}-{number}")

    (
        arrivals.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
