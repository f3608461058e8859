"""Accepted lines to the eight holding columns, by the layout of their filing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.rules import (
    DEFAULT_CUT, MISSING, NOT_APPLICABLE, RULES, UNLIKELY, java,
)
from ledgerline.functions.text import csv_fields, csv_value, strip
from ledgerline.operators.chunks import over_chunks
from ledgerline.operators.layout import IGNORED, cut_positions, profile, split_on_id
from ledgerline.operators.quotes import over_lines
from ledgerline.sources.landing import land

# How value and shares follow the identifier.
TAB_PAIR = r"\d+\t+\d+"
WIDE_PAIR = r"\d+\s{2,}\d+"
CLOSE_PAIR = r"\d+\s\d+"
WIDE_GAP = r"\s{2,}\w"

COLUMNS = ["poss_hit", "name", "type", "cusip", "value", "shares", "opt", "extra"]


def option_words(before: Column, after: Column, rules: dict[str, str] = RULES) -> Column:
    """First text on the line that may mean an option, empty when there is none."""
    return F.regexp_extract(F.concat(before, after), java(rules["Anyopt"]), 0)


def option_token(found: Column, after: Column, rules: dict[str, str] = RULES) -> Column:
    """The option text to report: what follows the id has precedence over the rest of the line."""
    behind = F.regexp_extract(after, java(rules["Anyopt"]), 0)
    return F.when(found == "", UNLIKELY).otherwise(F.coalesce(F.nullif(behind, F.lit("")), found))


def _searched(lines: DataFrame, rules: dict[str, str], split_on_tab: bool) -> DataFrame:
    """Per line what its layout reads out of it, each pattern run once and only where needed.

    ``left`` and ``right`` are the two sides of the identifier, null where the layout does not
    look at them; ``head`` and ``skip`` cut the left side into name and type; ``found`` is the
    option text; ``pair`` the value and shares found together; ``fields`` the comma fields.
    """
    layout, known = F.col("layout"), F.col("before").isNotNull()
    fixed, tab = known & (layout == "fixed"), known & (layout == "tab")
    left, right = F.col("left"), F.col("right")
    mark = "\t" if split_on_tab else "\\t"
    gap = F.when(layout == "tab", F.instr(left, F.lit(mark))).otherwise(
        F.regexp_instr(left, F.lit(WIDE_GAP))
    )
    first = F.regexp_extract(right, TAB_PAIR, 0)
    wide = F.regexp_extract(right, WIDE_PAIR, 0)
    usual = F.coalesce(F.when(layout == "tab", F.col("tab_cut")).otherwise(F.col("name_cut")),
                       F.lit(DEFAULT_CUT))
    seen = lines.select(
        "file_id", "line_no", "layout", "cusip", "line", "value_cut",
        usual.alias("usual"),
        F.when(fixed, F.translate("before", IGNORED, "")).when(tab, F.col("before")).alias("left"),
        F.when(fixed, F.translate("after", IGNORED, "")).when(tab, F.col("after")).alias("right"),
    ).select(
        "*",
        F.inline(F.array(F.struct(
            option_words(left, right, rules).alias("found"),
            gap.alias("gap"),
            F.when(layout == "tab", first).otherwise(wide).alias("wide"),
            F.when(layout == "csv", csv_fields(F.col("line"))).alias("raw_fields"),
        ))),
    )
    close = F.when((layout == "fixed") & (F.col("wide") == ""), F.regexp_extract(right, CLOSE_PAIR, 0))
    at_gap = F.col("gap") > 0
    return seen.select(
        "file_id", "line_no", "layout", "cusip", "value_cut", "left", "right", "found",
        F.coalesce(close, "wide").alias("pair"),
        F.when(at_gap, F.col("gap") - 1).otherwise(F.col("usual")).alias("head"),
        F.when(at_gap & (layout == "tab"), len(mark)).otherwise(0).alias("skip"),
        F.transform("raw_fields", csv_value).alias("fields"),
    )


def holdings(
    eligible: DataFrame, rules: dict[str, str] = RULES, split_on_tab: bool = False,
    profiles: DataFrame | None = None, quoted_lines: bool = False,
) -> DataFrame:
    """All holdings: file_id, line_no, layout and the eight columns.

    The one-row-per-filing profile is repeated per chunk and meets the lines where they lie;
    the accepted lines are not shuffled again. Filings voted html or garbage give no rows.

    Tab layout: name and type are cut at the filing's usual tab position, not at the line's own
    tab (``split_on_tab`` does that), value and shares are two numbers around a tab.
    Fixed layout: name and type are cut at the first wide gap, else at the usual position; value
    and shares are two numbers apart, else cut at the usual position.
    Comma layout: fields by position, untrimmed, from lines of six fields or more; the first four
    are name, identifier, value and shares, and the rest is joined. With ``quoted_lines`` a quote
    left open runs on into the filing's next lines, which then are one line under its number.
    """
    split = split_on_id(eligible)
    if profiles is None:
        profiles = profile(cut_positions(split))
    if quoted_lines:
        profiles = land(profiles, "profiles")
        split = split_on_id(over_lines(eligible, profiles))
    cuts = over_chunks(
        profiles.filter(F.col("layout").isin("tab", "csv", "fixed"))
        .select("file_id", "last_chunk", "layout", "tab_cut", "name_cut", "value_cut")
    )
    seen = _searched(split.join(cuts, ["file_id", "chunk"]), rules, split_on_tab)
    commas, left, right, fields = F.col("layout") == "csv", F.col("left"), F.col("right"), F.col("fields")
    extra = F.array_join(F.slice(fields, F.lit(5), F.greatest(F.size(fields) - 4, F.lit(0))), " ")
    none = F.col("pair") == ""
    cut = none & (F.col("layout") == "fixed") & (F.col("value_cut") > 0)
    pair = F.translate("pair", "\t\n\r\x0b\x0c", "     ")
    value = F.when(cut, F.substring(right, F.lit(1), F.col("value_cut"))).when(none, right).otherwise(
        F.substring_index(pair, " ", 1)
    )
    shares = F.when(cut, F.substring(right, F.col("value_cut") + 1, F.length(right))).when(
        none, MISSING
    ).otherwise(F.substring_index(pair, " ", -1))
    name = F.substring(left, F.lit(1), F.col("head"))
    kind = F.substring(left, F.col("head") + F.col("skip") + 1, F.length(left))
    found = F.when(commas, option_words(F.get(fields, 0), extra, rules)).otherwise(F.col("found"))
    return (
        seen.filter(F.when(commas, F.size(fields) > 5).otherwise(left.isNotNull()))
        .select(
            "file_id",
            "line_no",
            "layout",
            (found != "").alias("poss_hit"),
            F.when(commas, F.get(fields, 0)).otherwise(strip(name)).alias("name"),
            F.when(commas, NOT_APPLICABLE).otherwise(strip(kind)).alias("type"),
            F.when(commas, F.get(fields, 1)).otherwise(strip(F.col("cusip"))).alias("cusip"),
            F.when(commas, F.get(fields, 2)).otherwise(strip(value)).alias("value"),
            F.when(commas, F.get(fields, 3)).otherwise(strip(shares)).alias("shares"),
            F.when(commas, NOT_APPLICABLE).otherwise(
                strip(option_token(F.col("found"), right, rules))
            ).alias("opt"),
            F.when(commas, extra).otherwise(
                strip(F.regexp_replace(right, r"[^\sA-Za-z]", ""))
            ).alias("extra"),
        )
    )
