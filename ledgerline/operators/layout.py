"""How a filing lays out its holdings: the split at the identifier, the vote, the usual cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.functions.text import (
    WHITE, count_of, offset_of, strip_left_chars, strip_right_chars,
)

# Where columns begin, and the characters the fixed-width layout ignores.
TAB_CUT = r"\t\w"
NAME_CUT = r"\s{2}\w"
VALUE_CUT = r"\d\s{2,}\d"
IGNORED = "-\t.,$"

# Kinds of counted rows: one per line, the cuts of a layout, and the votes of a line.
LINE, TAB, BEFORE, AFTER, IS_SPLIT, IS_TAB, IS_CSV, IS_HTML, IS_GARBAGE = range(9)


def split_on_id(eligible: DataFrame) -> DataFrame:
    """Text before and after the first occurrence of the accepted identifier.

    ``before`` and ``after`` are null when the identifier is not in the line as accepted, which
    happens to lines printing it in lower case.
    """
    at = F.instr("line", F.col("cusip"))
    rest = at + F.length("cusip")
    before = F.when(at > 0, F.substring("line", F.lit(1), at - 1))
    after = F.when(at > 0, F.substring("line", rest, F.length("line")))
    return eligible.select(
        "*",
        strip_right_chars(before, ",\t").alias("before"),
        strip_left_chars(after, ",\t").alias("after"),
    )


def _squeezed(name: str):
    return F.translate(name, IGNORED, "")


def cut_positions(split: DataFrame) -> DataFrame:
    """Votes and column positions of every filing, counted: (file_id, kind, pos, n, first, last_chunk).

    A line gives one row per position it shows and per vote it casts (at position 0). They are counted by
    chunk, where the lines lie, and the counts dealt by filing: a chunk shuffles its distinct positions, and
    what follows by filing finds them together. Their number is given, as the engine would deal them by
    position too, and then once more by filing.
    """
    line, bare = F.col("line"), F.btrim("line", F.lit(WHITE))
    inside = F.col("before").isNotNull()
    garbage = F.startswith(bare, F.col("cusip")) & (F.length(bare) < F.length("cusip") + 5)
    parts = int(split.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    def vote(condition):
        return F.when(condition, 0).otherwise(-1)
    positions = {
        LINE: F.lit(0),
        TAB: offset_of(F.col("before"), TAB_CUT),
        BEFORE: offset_of(_squeezed("before"), NAME_CUT),
        AFTER: offset_of(_squeezed("after"), VALUE_CUT),
        IS_SPLIT: vote(inside),
        IS_TAB: vote(inside & line.contains("\t")),
        IS_CSV: vote(inside & (count_of(line, ",") > count_of(line, " "))),
        IS_HTML: vote(inside & F.upper(line).contains("<HTML>")),
        IS_GARBAGE: vote(garbage),
    }
    return (
        split.select(
            "file_id", "chunk", "line_no",
            F.posexplode(F.array(*[positions[kind] for kind in range(9)])).alias("kind", "pos"),
        )
        .filter(F.col("pos") >= 0)
        .withColumn("pos", F.col("pos") + F.when(F.col("kind") == AFTER, 1).otherwise(0))
        .groupBy("file_id", "chunk", "kind", "pos")
        .agg(F.count(F.lit(1)).alias("n"), F.min("line_no").alias("first"))
        .repartition(parts, "file_id")
        .groupBy("file_id", "kind", "pos")
        .agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("chunk").alias("last_chunk"))
    )


def profile(positions: DataFrame) -> DataFrame:
    """One row per filing: its counts, the layout they vote for, and its modal cuts.

    The most frequent position wins, and among equals the one seen first. Filings without
    accepted lines have no row; ``full_profile`` adds them.
    """
    def mode(kind):
        best = F.struct("n", (-F.col("first")).alias("first"), "pos")
        return F.max(F.when(F.col("kind") == kind, best))["pos"]
    def count(kind):
        return F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))
    counted = positions.groupBy("file_id").agg(
        F.max("last_chunk").alias("last_chunk"),
        count(LINE).alias("n_lines"),
        count(IS_SPLIT).alias("n_split"),
        count(IS_TAB).alias("n_tab"),
        count(IS_CSV).alias("n_csv"),
        count(IS_HTML).alias("n_html"),
        count(IS_GARBAGE).alias("n_garbage"),
        mode(TAB).alias("tab_cut"),
        mode(BEFORE).alias("name_cut"),
        mode(AFTER).alias("value_cut"),
    )
    return counted.withColumn("layout", vote_of())


def vote_of():
    """The layout a filing's counts decide: a strict majority of all its accepted lines."""
    half = F.floor(F.col("n_lines") / 2)
    return (
        F.when(F.col("n_tab") > half, "tab")
        .when(F.col("n_csv") > half, "csv")
        .when(F.col("n_html") > 0, "html")
        .when(F.col("n_garbage") > half, "garbage")
        .otherwise("fixed")
    )


def full_profile(files: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profiles of all filings; one without accepted lines counts as fixed, with no rows."""
    counts = ["n_lines", "n_split", "n_tab", "n_csv", "n_html", "n_garbage"]
    return files.select("file_id").join(profiles, "file_id", "left").select(
        "file_id",
        F.coalesce("layout", F.lit("fixed")).alias("layout"),
        *[F.coalesce(name, F.lit(0)).alias(name) for name in counts],
        "tab_cut",
        "name_cut",
        "value_cut",
    )


def frequent_splits(positions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Positions that more than a tenth of a fixed-width filing's lines share.

    Of neighbouring ``before`` positions the last is kept, of ``after`` positions the first.
    Fewer than ten positions can pass per filing and kind, so the window is tiny.
    """
    fixed = profiles.filter(F.col("layout") == "fixed").select(
        "file_id", F.floor(F.col("n_split") / 10).alias("tenth")
    )
    often = (
        positions.filter(F.col("kind").isin(BEFORE, AFTER))
        .select("file_id", "kind", "pos", "n")
        .join(fixed, "file_id")
        .filter(F.col("n") > F.col("tenth"))
    )
    by_pos = Window.partitionBy("file_id", "kind").orderBy("pos")
    is_before = F.col("kind") == BEFORE
    return (
        often.withColumn("next", F.lead("pos").over(by_pos))
        .withColumn("previous", F.lag("pos").over(by_pos))
        .filter(
            F.when(is_before, ~F.equal_null("next", F.col("pos") + 1))
            .otherwise(~F.equal_null("previous", F.col("pos") - 1))
        )
        .select(
            "file_id",
            F.when(is_before, "before").otherwise("after").alias("side"),
            "pos",
            "n",
        )
    )
