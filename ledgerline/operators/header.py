"""Header fields and reported totals, one wide row per filing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.functions.keys import cik_of, date_of
from ledgerline.functions.rules import (
    FILING_URL, HEADER_CLOSE, HEADER_KEYS, HEADER_OPEN, RULES, TOTAL_RULES, VALUE_TOTAL, java,
)
from ledgerline.functions.text import WHITE, as_number, once, strip, unparsed
from ledgerline.operators.chunks import CHUNK_LINES, carry_forward, chunk_of, over_chunks
from ledgerline.operators.merge import typed
from ledgerline.sources.landing import land


def column_of(key: str) -> str:
    return key.lower().replace(" ", "_")


def header_marker(line: Column) -> Column:
    """True where the header opens, false where it closes."""
    return F.when(F.startswith(line, F.lit(HEADER_OPEN)), True).when(
        F.startswith(line, F.lit(HEADER_CLOSE)), False
    )


def header_region(lines: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """Lines with the flag ``in_header``: opening line inside, closing line outside."""
    placed = _with_event(lines, header_marker(F.col("line")), chunk_lines)
    return carry_forward(placed, placed, "in_header").drop("chunk")


def _with_event(lines: DataFrame, event: Column, chunk_lines: int) -> DataFrame:
    return lines.withColumn("chunk", chunk_of("line_no", chunk_lines)).withColumn("event", event)


def table_region(
    lines: DataFrame, rules: dict[str, str] = RULES, chunk_lines: int = CHUNK_LINES
) -> DataFrame:
    """Lines with the flag ``in_table``; a skipped line ends the table as its closing mark does.

    A diagnosis only: no later step filters by it.
    """
    bare = F.replace("line", F.lit("-"), F.lit(""))
    closes = F.col("line").rlike(java(rules["SkipL"])) | bare.rlike(java(rules["StopL"]))
    marker = F.when(closes, False).when(bare.rlike(java(rules["UseL"])), True)
    placed = _with_event(lines, marker, chunk_lines)
    return carry_forward(placed, placed, "in_table").drop("chunk")


def header_events(lines: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """The few lines of a filing that can set a header field, with what they say.

    Picked in the scan, so that only they are sorted to find the header region. An in-header
    ``key: value`` line has ``key`` and ``value``; a line naming a total has its amount in that
    total's own column.
    """
    line, lower = F.col("line"), F.col("lower")
    totals = {column_of(total): total.lower() for total in TOTAL_RULES}
    marker = header_marker(line)
    picked = (
        lines.select("file_id", "line_no", "line", F.lower("line").alias("lower"))
        .select("*", once(F.ltrim(F.substring_index("line", ":", 1), F.lit(WHITE))).alias("key"))
        .filter(
            reduce(Column.__or__, [lower.contains(name) for name in totals.values()])
            | (F.col("key").isin(HEADER_KEYS) & line.contains(":"))
            | marker.isNotNull()
        )
    )
    # The rule sees the line end too, and may take it for the amount.
    amounts = {
        column: F.when(
            lower.contains(name),
            F.regexp_extract(F.concat(lower, F.lit("\n")), TOTAL_RULES[total], 1),
        )
        for (column, name), total in zip(totals.items(), TOTAL_RULES, strict=True)
    }
    # Of a line only what it sets or names is sorted.
    sets = F.col("key").isin(HEADER_KEYS) & line.contains(":")
    placed = picked.select(
        "file_id",
        chunk_of("line_no", chunk_lines).alias("chunk"),
        "line_no",
        marker.alias("event"),
        F.when(sets, F.col("key")).alias("key"),
        F.when(sets, strip(F.substring_index("line", ":", -1))).alias("value"),
        *[amount.alias(column) for column, amount in amounts.items()],
    )
    flagged = carry_forward(placed, _with_event(lines, marker, chunk_lines), "in_header")
    return flagged.select(
        "file_id",
        "chunk",
        "line_no",
        F.when(F.col("in_header"), F.col("key")).alias("key"),
        "value",
        *amounts,
    ).filter(F.coalesce("key", *totals).isNotNull())


def reading_stops(events: DataFrame) -> DataFrame:
    """Per filing the line where its value total becomes known and reading stops."""
    set_here = (F.col("key") == VALUE_TOTAL) & (F.col("value") != "")
    named_here = F.col(column_of(VALUE_TOTAL)) != ""
    hit = F.coalesce(set_here, F.lit(False)) | F.coalesce(named_here, F.lit(False))
    return events.groupBy("file_id").agg(
        F.min(F.when(hit, F.col("line_no"))).alias("stop"), F.max("chunk").alias("last_chunk")
    )


def header_values(events: DataFrame) -> DataFrame:
    """``(file_id, found, named)``: the last value of each header key as a map, and the amounts named for the totals, in their order.

    A total is the last value a header line sets, unless that is empty; else it is the first
    amount named on or after that line, or anywhere when no header line sets it.

    Events are dealt by chunk once and reduced there: to one entry a key, and for each total the chunk's last
    line that sets it with the first amount from there on. Only these come together, one row a chunk.
    """
    stops = over_chunks(reading_stops(events))
    in_chunk = Window.partitionBy("file_id", "chunk")
    names = {total: column_of(total) for total in TOTAL_RULES}
    resets = {f"{name}_reset": F.max(F.when(F.col("key") == total, F.col("line_no"))).over(in_chunk) for total, name in names.items()}
    read = events.join(stops, ["file_id", "chunk"]).filter(
        F.col("stop").isNull() | (F.col("line_no") <= F.col("stop"))
    ).withColumns(resets)
    def first(name):
        reset = F.col(f"{name}_reset")
        named = (F.col(name) != "") & (reset.isNull() | (F.col("line_no") >= reset))
        return F.min(F.when(named, F.struct(F.col("line_no").alias("at"), F.col(name).alias("amount"))))
    per_key = read.groupBy("file_id", "chunk", "key").agg(
        F.max(F.struct("line_no", "value")).alias("last"),
        *[first(name).alias(name) for name in names.values()], *[F.max(reset).alias(reset) for reset in resets],
    )
    entry = F.struct("key", F.col("last.line_no").alias("line_no"), F.col("last.value").alias("value"))
    per_chunk = per_key.groupBy("file_id", "chunk").agg(
        F.collect_list(F.when(F.col("key").isNotNull(), entry)).alias("entries"),
        *[F.struct(F.max(f"{name}_reset").alias("reset"), F.min(name).alias("first")).alias(name) for name in names.values()],
    )
    per_file = per_chunk.groupBy("file_id").agg(
        F.flatten(F.collect_list("entries")).alias("entries"), *[F.collect_list(name).alias(name) for name in names.values()],
    )
    def last(key):
        own = F.filter("entries", lambda e: e["key"] == key)
        return F.array_max(F.transform(own, lambda e: F.struct(e["line_no"], e["value"])))["value"]
    keys = F.array_distinct(F.transform("entries", lambda e: e["key"]))
    # Keys repeat in filings of several chunks only.
    found = F.map_from_entries(F.when(
        F.size(keys) == F.size("entries"), F.transform("entries", lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    ).otherwise(F.transform(keys, lambda key: F.struct(key.alias("key"), last(key).alias("value")))))
    def named(name):
        reset = F.array_max(F.transform(name, lambda c: c["reset"]))
        later = F.filter(F.transform(name, lambda c: c["first"]), lambda f: f.isNotNull() & (reset.isNull() | (f["at"] >= reset)))
        return F.array_min(later)["amount"]
    return per_file.select("file_id", found.alias("found"), F.array(*map(named, names.values())).alias("named"))


def header_fields(files: DataFrame, lines: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """One row per filing with every header key as a column, empty text where absent."""
    events = land(header_events(lines, chunk_lines), "header_events")
    # At most one entry per header key: the map stays small in any filing.
    values = F.transform(
        F.array(*map(F.lit, HEADER_KEYS)), lambda key: F.try_element_at("found", key)
    )
    own = {"CIK": cik_of(F.col("file_id")), "date": date_of(F.col("file_id"))}
    totals = list(TOTAL_RULES)
    def value_of(key):
        value = F.get("values", F.lit(HEADER_KEYS.index(key)))
        if key in TOTAL_RULES:
            value = F.coalesce(F.nullif(value, F.lit("")), F.get("named", F.lit(totals.index(key))))
        return F.coalesce(value, own.get(key, F.lit(""))).alias(column_of(key))
    wide = (
        files.select("file_id").join(header_values(events), "file_id", "left")
        .select("file_id", "named", once(values).alias("values"))
        .select(F.col("file_id").alias("file"), *[value_of(key) for key in HEADER_KEYS])
    )
    url = F.concat(F.lit(FILING_URL), "accession_number", F.lit(".txt"))
    return wide.select("file", url.alias("url"), *[column_of(key) for key in HEADER_KEYS])


def typed_headers(headers: DataFrame) -> DataFrame:
    """Typed siblings of period, filing date and the three totals."""
    return headers.withColumns({
        "period": F.try_to_date("conformed_period_of_report", "yyyyMMdd"),
        "filed_on": F.try_to_date("date", "yyyy-MM-dd"),
        **{column_of(total) + "_num": as_number(F.col(column_of(total))) for total in TOTAL_RULES},
    })


def with_header(headers: DataFrame, stock: DataFrame) -> DataFrame:
    """Every filing's header beside each of its holdings; filings without holdings stay.

    ``stock`` is read twice and ``headers`` too, so they should be landed tables.
    It is a join plus the filings that leaves out: in a plain outer join the holdings of a huge
    filing could not be split over tasks, since they are not the preserved side.
    """
    wide = headers.select(
        F.col("file").alias("filename"), "accession_number", "company_conformed_name",
        "conformed_period_of_report",
    )
    columns = ["line_no", "name", "cusip", "value", "shares", "opt", "flagr"]
    holding = stock.select("filename", *columns)
    without = wide.join(stock.select("filename").distinct(), "filename", "left_anti")
    return holding.join(wide, "filename").unionByName(without, allowMissingColumns=True)


def reconciled(headers: DataFrame, stock: DataFrame) -> DataFrame:
    """Reported against extracted totals per filing; n_unparsed values are no numbers and not in value_found."""
    found = typed(stock).groupBy(F.col("filename").alias("file")).agg(
        F.count(F.lit(1)).alias("n_found"),
        F.try_sum("value_num").alias("value_found"),
        F.count_if(unparsed(F.col("value"))).alias("n_unparsed"),
    )
    entry = "form_13f_information_table_entry_total_num"
    value = "form_13f_information_table_value_total_num"
    reported = typed_headers(headers).select(
        "file", F.col(entry).alias("n_reported"), F.col(value).alias("value_reported")
    )
    return reported.join(found, "file", "left").select(
        "file",
        "n_reported",
        "value_reported",
        F.coalesce("n_found", F.lit(0)).alias("n_found"),
        "value_found",
        F.coalesce("n_unparsed", F.lit(0)).alias("n_unparsed"),
        (F.col("n_reported") == F.coalesce("n_found", F.lit(0))).alias("entries_agree"),
        (F.col("value_reported") == F.col("value_found")).alias("values_agree"),
    )
