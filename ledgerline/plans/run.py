"""The whole extraction: filings to published tables, each stage written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions.keys import cik_of
from ledgerline.functions.rules import RULES
from ledgerline.operators.chunks import over_chunks
from ledgerline.operators.eligible import eligible_rows, placed, remainder_lines
from ledgerline.operators.header import header_fields
from ledgerline.operators.holdings import holdings
from ledgerline.operators.layout import cut_positions, full_profile, profile, split_on_id
from ledgerline.operators.manifest import of_entities
from ledgerline.operators.merge import merged, option_audit
from ledgerline.sources.commits import BROADCAST_FILINGS, is_recorded, known, new_commit, record, with_period, write
from ledgerline.sources.landing import land, scope
from ledgerline.sources.sinks import write_merged

# The published tables, in the order in which they are written.
TABLES = ["collisions", "eligible", "remainder", "layouts", "holdings", "option_audit", "stock", "option", "option_def", "headers"]


def filings_of(lines: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """``(file_id, n_lines, last_line, last_chunk, year, quarter)``: one row a filing; no text is read.

    ``files(file_id)`` adds filings that have no line at all.
    """
    counted = lines.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.max("line_no").cast("bigint").alias("last_line"), F.max(placed(lines)).alias("last_chunk")
    )
    if files is not None:
        none = files.select("file_id").distinct().join(counted, "file_id", "left_anti")
        counted = counted.unionByName(none.withColumns({"n_lines": F.lit(0), "last_line": F.lit(-1), "last_chunk": F.lit(0)}))
    return with_period(counted)


def _sorted_out(lines: DataFrame, folder: str, files: DataFrame | None = None, chosen=None) -> tuple[DataFrame, dict[str, int]]:
    """``filings_of`` with ``state``: known (published), mixed (two files under one key), fresh, or other (not ``chosen``); and their counts."""
    spark, filings = lines.sparkSession, filings_of(lines, files)
    filings = land(filings, "filings")
    done = known(spark, folder, filings).select("file_id", F.lit(True).alias("_known"))
    mixes = F.col("n_lines") > F.coalesce("last_line", F.lit(-1)) + 1
    other = F.lit(False) if chosen is None else ~F.col("_chosen")
    if chosen is not None:
        filings = filings.join(chosen(filings).select("file_id", F.lit(True).alias("_chosen")), "file_id", "left").fillna({"_chosen": False})
    state = F.when(other, "other").when(F.col("_known"), "known").when(mixes, "mixed").otherwise("fresh")
    states = land(filings.join(done, "file_id", "left").withColumn("state", state).drop("_known", "_chosen"), "states")
    return states, {r["state"]: r["count"] for r in states.groupBy("state").count().collect()}


def _lines_of(lines: DataFrame, states: DataFrame, counts: dict[str, int], state: str = "fresh") -> DataFrame:
    """The lines of the filings in one state.

    The list of these or that of all others is broadcast, the shorter one, if it is short enough.
    Two long lists meet the lines by chunk, so that a huge filing is no single task's.
    """
    own, others = counts.get(state, 0), sum(n for name, n in counts.items() if name != state)
    wanted = F.col("state") == state
    if not others:
        return lines
    if min(own, others) > BROADCAST_FILINGS:
        chunks = over_chunks(states.filter(wanted).select("file_id", "last_chunk"))
        return lines.withColumn("chunk", placed(lines)).join(chunks, ["file_id", "chunk"], "left_semi").select(lines.columns)
    if others <= own:
        return lines.join(F.broadcast(states.filter(~wanted).select("file_id")), "file_id", "left_anti")
    return lines.join(F.broadcast(states.filter(wanted).select("file_id")), "file_id", "left_semi")


def extract(
    lines: DataFrame, keys: DataFrame, folder: str, rules: dict[str, str] = RULES,
    commit: str | None = None, files: DataFrame | None = None,
) -> None:
    """Add filings to the eligible, remainder, layouts, holdings, headers, audit and merged tables.

    ``lines(file_id, line_no, line)`` should be a landed table: it is read several times. ``files(file_id)``
    names filings that may have no lines; they get a header and a layout row. A null key counts as empty.

    The tables change at once, when all are written (``sources.commits``); read them with ``read_table``.
    Filings that are published already are left out, which the log of keys decides: no published row is
    read. A run under the id of a recorded ``commit`` does nothing, and one that broke off can be repeated.

    A filing with more lines than their numbers allow is two files under one key. It is set aside in
    ``collisions(file_id, n_lines, last_line)``, not logged, and taken when it comes alone.
    """
    spark, commit = lines.sparkSession, commit or new_commit()
    if is_recorded(spark, folder, commit):
        return
    lines = lines.withColumn("file_id", F.coalesce("file_id", F.lit("")))
    with scope(spark):
        states, counts = _sorted_out(lines, folder, files)
        if not counts.keys() & {"fresh", "mixed"}:
            return
        fresh, own = states.filter("state = 'fresh'"), _lines_of(lines, states, counts)

        def staged(table: DataFrame, name: str, key: str = "file_id") -> DataFrame:
            return write(with_period(table, key), folder, name, commit)

        if "mixed" in counts:
            write(states.filter("state = 'mixed'").select("file_id", "n_lines", "last_line", "year", "quarter"), folder, "collisions", commit)
        eligible = staged(eligible_rows(own, keys, rules), "eligible").drop("year", "quarter")
        staged(remainder_lines(own, eligible, rules), "remainder")
        profiles = land(profile(cut_positions(split_on_id(eligible))), "profiles")
        staged(full_profile(fresh, profiles), "layouts")
        rows = staged(holdings(eligible, rules, profiles=profiles), "holdings").drop("year", "quarter")
        staged(option_audit(eligible, rows, rules).drop("year"), "option_audit")
        write_merged(merged(rows), folder, commit)
        staged(header_fields(fresh, own), "headers", "file")
        record(fresh, folder, commit)


def curate(lines: DataFrame, entities: DataFrame, folder: str, commit: str | None = None) -> None:
    """Add the filings of the given entities to a curated archive, leaving out what it has.

    ``entities(cik)`` is compared with the filer in the file key. The archive is partitioned by
    commit and period and only grows; a second run over the same filings adds nothing. Its log says
    what it has, so no line of it is read. Filings whose lines are mixed are left out.
    """
    spark, commit = lines.sparkSession, commit or new_commit()
    if is_recorded(spark, folder, commit):
        return
    with scope(spark):
        of_these = lambda filings: of_entities(filings.withColumn("cik", cik_of(F.col("file_id"))), entities)
        states, counts = _sorted_out(lines, folder, chosen=of_these)
        if "fresh" not in counts:
            return
        own = _lines_of(lines, states, counts)
        write(with_period(own.select("file_id", "line_no", "line")), folder, "", commit)
        record(states.filter("state = 'fresh'"), folder, commit)
