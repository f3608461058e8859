"""Comma lines read as one stream: a quote left open runs on into the filing's next lines.

Whether a line ends inside quotes depends on whether it begins inside, so a line is a function of one
bit: it always ends open, always closed, as it began, or the other way. Such functions are put together
like sums: a line ends as the last line said that fixes it, turned around by each turning line since.
Inside a chunk a window does that; what a chunk does as a whole is one row, and a second window over
these rows gives each chunk the state it begins with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.functions.text import QUOTED
from ledgerline.operators.chunks import CHUNK_LINES, chunk_of
from ledgerline.sources.landing import fits, land

# A record of more characters is not put together; readers of comma files refuse much shorter fields.
RECORD_CHARS = 1 << 20
# Records that are broadcast, by key.
BROADCAST_RECORDS = 300_000

_FIELD = rf'(?:{QUOTED}[^,]*+|[^",][^,]*+|)'
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
# A line that begins outside of quotes, or inside, and ends inside.
OPENS = rf'^(?:{_FIELD},)*+"{_INSIDE}\z'
STAYS = rf'^{_INSIDE}(?:\z|"[^,]*+,(?:{_FIELD},)*+"{_INSIDE}\z)'


def _before(partition: str, order: str) -> Window:
    return Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def with_quote_state(lines: DataFrame) -> DataFrame:
    """``lines(file_id, chunk, line_no, line)`` with ``begins`` and ``ends`` inside quotes, as true or false."""
    so_far = Window.partitionBy("file_id", "chunk").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens, stays = F.col("_opens"), F.col("_stays")
    turned = (
        lines.withColumns({"_opens": F.col("line").rlike(OPENS).cast("int"), "_stays": F.col("line").rlike(STAYS).cast("int")})
        .withColumns({"_fixed": F.when(opens == stays, opens), "_turns": F.sum(F.when(opens > stays, 1).otherwise(0)).over(so_far)})
        .withColumn("_fixed", F.last((F.col("_fixed") + F.col("_turns")) % 2, ignorenulls=True).over(so_far))
    )
    turned = land(turned, "turned")
    # The last line of a chunk has what the chunk does.
    last = turned.groupBy("file_id", "chunk").agg(F.max_by(F.struct("_fixed", "_turns"), "line_no").alias("last")).select("file_id", "chunk", "last.*")
    earlier = _before("file_id", "chunk")
    turns = F.coalesce(F.sum("_turns").over(earlier), F.lit(0))
    starts = (
        last.withColumn("_earlier", turns)
        .withColumn("_known", F.when(F.col("_fixed").isNotNull(), (F.col("_fixed") + F.col("_earlier")) % 2))
        .select("file_id", "chunk", ((F.coalesce(F.last("_known", ignorenulls=True).over(earlier), F.lit(0)) + F.col("_earlier")) % 2).alias("_start"))
    )
    ends = (F.coalesce("_fixed", "_start") + F.col("_turns")) % 2
    order = Window.partitionBy("file_id", "chunk").orderBy("line_no")
    return (
        turned.join(starts, ["file_id", "chunk"]).withColumn("_ends", ends)
        .withColumn("begins", F.coalesce(F.lag("_ends").over(order), "_start") == 1)
        .withColumn("ends", F.col("_ends") == 1)
        .drop("_opens", "_stays", "_fixed", "_turns", "_start", "_ends")
    )


def quoted_records(lines: DataFrame, chunk_lines: int = CHUNK_LINES, longest: int = RECORD_CHARS) -> DataFrame:
    """Lines with those that a quote runs over put together, without anything between, as the first of them.

    ``lines`` has file_id, chunk, line_no and line; other columns stay as the first line has them. If
    the last line of a filing ends inside quotes, they are closed there. A record of more than ``longest`` characters is left as
    the lines it is: no task holds what an open quote makes of the rest of a huge filing.
    """
    state = land(with_quote_state(lines), "quoted")
    single = ~F.col("begins") & ~F.col("ends")
    columns = lines.columns
    several = state.where(~single)
    # The first line of the record that a line is in: in its chunk, or in the last chunk before that has one.
    so_far = Window.partitionBy("file_id", "chunk").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.when(~F.col("begins"), F.col("line_no"))
    per_chunk = several.groupBy("file_id", "chunk").agg(F.max(first).alias("_last"))
    per_chunk = per_chunk.select("file_id", "chunk", F.max("_last").over(_before("file_id", "chunk")).alias("_carried"))
    several = land(
        several.withColumn("_own", F.max(first).over(so_far)).join(per_chunk, ["file_id", "chunk"])
        .withColumn("_first", F.coalesce("_own", "_carried")).drop("_own", "_carried", "begins"),
        "several",
    )
    sizes = several.groupBy("file_id", "_first").agg(F.sum(F.length("line")).alias("_chars"), F.count(F.lit(1)).alias("_n"))
    long = land(sizes.where(F.col("_chars") > longest).select("file_id", "_first"), "long_records")
    if not long.isEmpty():
        named = F.broadcast(long) if fits(long, BROADCAST_RECORDS) else long
        left = several.join(named, ["file_id", "_first"], "left_semi").select(columns)
        several = several.join(named, ["file_id", "_first"], "left_anti")
    else:
        left = several.limit(0).select(columns)
    rest = [name for name in columns if name not in ("file_id", "chunk", "line_no", "line")]
    row = F.struct("line_no", "line", "ends", *rest)
    joined = several.groupBy("file_id", "_first").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    text = F.array_join(F.transform("rows", lambda r: r["line"]), "")
    text = F.when(F.element_at("rows", -1)["ends"], F.concat(text, F.lit('"'))).otherwise(text)
    head = F.get("rows", F.lit(0))
    put = joined.select(
        "file_id", chunk_of(head["line_no"], chunk_lines).alias("chunk"), head["line_no"].alias("line_no"), text.alias("line"),
        *[head[name].alias(name) for name in rest],
    ).select(columns)
    return state.where(single).select(columns).unionByName(left).unionByName(put)


def over_lines(eligible: DataFrame, profiles: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """Accepted lines of which those of filings in comma layout are put together where a quote runs on."""
    commas = land(profiles.where("layout = 'csv'").select("file_id", "last_chunk"), "comma_filings")
    if commas.isEmpty():
        return eligible
    chunks = commas.withColumn("chunk", F.explode(F.sequence(F.lit(0), "last_chunk"))).drop("last_chunk")
    own = eligible.join(chunks, ["file_id", "chunk"], "left_semi").select(eligible.columns)
    others = eligible.join(chunks, ["file_id", "chunk"], "left_anti").select(eligible.columns)
    return others.unionByName(quoted_records(own, chunk_lines))
