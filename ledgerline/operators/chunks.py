"""Work on one filing split into chunks of lines, so that no task ever holds a whole filing.

A filing may be of any size: one file can hold a third of all lines. Whatever needs the
lines of a filing together is therefore keyed by ``(file_id, chunk)``, where a chunk is a
bounded run of line numbers. What crosses chunks is reduced to one small row per chunk
first. A filing of usual size is a single chunk, and nothing changes for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK_LINES = 65536


def chunk_of(line_no: Column | str, chunk_lines: int = CHUNK_LINES) -> Column:
    number = F.col(line_no) if isinstance(line_no, str) else line_no
    # Never null, so that a join on it adds no null test that would tell two equal scans apart.
    return F.coalesce(F.floor(number / F.lit(chunk_lines)).cast("int"), F.lit(0))


def over_chunks(per_file: DataFrame, last_chunk: str = "last_chunk") -> DataFrame:
    """Repeat one row per filing for each of its chunks.

    The result joins to lines already partitioned by ``(file_id, chunk)`` without moving
    them: only these small rows travel, and the lines of a huge filing stay spread out.
    """
    return per_file.withColumn("chunk", F.explode(F.sequence(F.lit(0), last_chunk))).drop(last_chunk)


def carry_forward(lines: DataFrame, events: DataFrame, out: str) -> DataFrame:
    """Fill ``out`` with the latest event up to each line, false before any.

    ``lines`` and ``events`` have file_id, chunk and line_no. ``events`` has every line of the
    filings, with ``event`` true, false or null for none; ``lines`` has ``event`` too and may be
    a part of them that keeps all events. Inside a chunk a window does it. The state a chunk
    starts with comes from a second window over one row per chunk; line number and event share
    one number there, so that these rows come from a hash aggregation.
    """
    in_chunk = (
        Window.partitionBy("file_id", "chunk").orderBy("line_no")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = (
        Window.partitionBy("file_id").orderBy("chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    code = F.col("line_no").cast("bigint") * 2 + F.col("event").cast("bigint")
    per_chunk = (
        events.groupBy("file_id", "chunk")
        .agg(F.max(code).alias("_end"))
        .withColumn("_start", F.last(F.col("_end") % 2 == 1, ignorenulls=True).over(before))
        .filter(F.col("_start"))
        .select("file_id", "chunk", "_start")
    )
    return (
        lines.withColumn("_seen", F.last("event", ignorenulls=True).over(in_chunk))
        .join(per_chunk, ["file_id", "chunk"], "left")
        .withColumn(out, F.coalesce("_seen", "_start", F.lit(False)))
        .drop("event", "_seen", "_start")
    )


def number_rows(rows: DataFrame, key: str, chunk: str, order: list, out: str) -> DataFrame:
    """Number the rows of each key from 1, in the order of ``chunk`` and then ``order``.

    Only rows of one ``(key, chunk)`` are sorted together; the count of earlier chunks is
    added from one row per chunk.
    """
    in_chunk = Window.partitionBy(key, chunk).orderBy(*order)
    before = Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(key, chunk).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.sum("_n").over(before))
        .filter(F.col("_start").isNotNull())
        .select(key, chunk, "_start")
    )
    return (
        rows.withColumn("_rank", F.row_number().over(in_chunk))
        .join(starts, [key, chunk], "left")
        .withColumn(out, F.col("_rank") + F.coalesce("_start", F.lit(0)))
        .drop("_rank", "_start")
    )


def run_of(block: str, seq: str, chunk_lines: int = CHUNK_LINES) -> Column:
    """A bounded run of a block's rows, for ``number_rows``: ``seq`` numbers them as one task read them.

    A block that cannot be split, such as a packed file, may hold any number of rows.
    """
    return F.struct(F.col(block), F.floor(F.col(seq) / chunk_lines).alias("run"))


def number_sorted(rows: DataFrame, key: str, order: list[str], out: str, land, run_rows: int = CHUNK_LINES // 2) -> DataFrame:
    """Number the rows of each key from 1, in the full order of ``order``, however many rows a key or a value has.

    The rows are dealt by sampled ranges of key and whole order, so many that a run has about ``run_rows``
    of them; rows alike in all of it may lie in several runs, in any order. A run is landed with its number
    (``land`` writes a table and reads it back) and sorted by itself; the counts of a key's earlier runs
    are added from one row a run.
    """
    runs = max(1, -(-rows.count() // run_rows))
    # Rows alike are told apart by a draw, so that they do not all fall into one range.
    dealt = rows.withColumn("_draw", F.rand(7)).repartitionByRange(runs, key, *order, "_draw")
    placed = land(dealt.withColumn("_run", F.spark_partition_id()), "runs")
    return number_rows(placed, key, "_run", [*order, "_draw"], out).drop("_run", "_draw")
