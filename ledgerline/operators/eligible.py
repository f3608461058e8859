"""Which lines of a filing report a holding, and of which security."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.rules import RULES, java
from ledgerline.functions.text import strip_right
from ledgerline.operators.chunks import CHUNK_LINES, chunk_of
from ledgerline.sources.landing import fits, land

# A key has at most 9 characters: 2 million of them stay well under half a gigabyte hashed.
BROADCAST_KEYS = 2_000_000
# A sieve of keys is broadcast: rows of 512 bits, 32 bits a key while there are at most 2 ** 19 rows (some 60 MB hashed).
SIEVE_ROWS = 1 << 19
SIEVE_WORDS = 8
# The bits of accepted lines, as they are on disk and about twice as much hashed.
BROADCAST_BYTES = 64 * 1024 * 1024


def is_skipped(line: Column, rules: dict[str, str] = RULES) -> Column:
    """Lines that look like header or file matter are never holdings."""
    return line.rlike(java(rules["SkipL"]))


def without_dashes(line: Column) -> Column:
    return F.replace(line, F.lit("-"), F.lit(""))


def share_tag(line: Column, cusip: Column, rules: dict[str, str] = RULES) -> Column:
    """First share-type tag after the last occurrence of the identifier, empty when none."""
    rest = F.call_function("substring_index", line, cusip, F.lit(-1))
    return F.regexp_extract(rest, java(rules["Shprn"]), 1)


def _found(line: Column, rules: dict[str, str]) -> Column:
    return F.regexp_extract_all(line, F.lit(java(rules["CUSIP"])), F.lit(1))


def _searched(lines: DataFrame, rules: dict[str, str], chunk_lines: int) -> DataFrame:
    """The lines that are searched at all, as they are searched."""
    text = lines.select("file_id", "line_no", strip_right(F.col("line")).alias("line"))
    return text.filter(~is_skipped(F.col("line"), rules)).select(
        "file_id",
        chunk_of("line_no", chunk_lines).alias("chunk"),
        "line_no",
        without_dashes(F.col("line")).alias("line"),
    )


def candidates(lines: DataFrame, rules: dict[str, str] = RULES, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """Every identifier-like word of every line, once per key it can be accepted by.

    ``rank`` orders the candidates of a line, longest first and then from left to right.
    """
    words = _searched(lines, rules, chunk_lines).select(
        "*", F.posexplode(_found(F.col("line"), rules)).alias("pos", "word")
    )
    upper = F.upper("word")
    keys = F.when(F.length("word") <= 6, F.array(upper)).otherwise(
        F.array(upper, F.substring(upper, 1, 6))
    )
    return words.select(
        "file_id",
        "chunk",
        "line_no",
        "line",
        ((F.lit(1024) - F.length("word")).cast("bigint") * F.lit(1 << 32) + F.col("pos")).alias("rank"),
        F.explode(keys).alias("key"),
    )


def _sieve_places(key: Column, rows: int) -> tuple[Column, list[Column]]:
    """The row of a key in a sieve and its two places there, from different bits of one hash."""
    number = F.xxhash64(key)
    return F.pmod(number, F.lit(rows)).cast("int"), [F.shiftrightunsigned(number, at).bitwiseAND(F.lit(SIEVE_WORDS * 64 - 1)).cast("int") for at in (32, 48)]


def sieve(keys: DataFrame, most_rows: int = SIEVE_ROWS) -> tuple[DataFrame, int]:
    """``(row, bits)`` and how many rows there can be: two bits set for each key. Of other words, some 4 in 1,000 find both of theirs set.

    More keys than it has room for make it let more words pass; it never keeps a key back.
    """
    rows, n_keys = 1, keys.count()
    while rows < min(most_rows, n_keys * 32 / (SIEVE_WORDS * 64)):
        rows *= 2
    row, places = _sieve_places(F.col("key"), rows)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place") % 64)
    words = [F.coalesce(F.bit_or(F.when(F.floor(F.col("place") / 64) == at, bit)), F.lit(0).cast("bigint")) for at in range(SIEVE_WORDS)]
    return keys.select(row.alias("row"), F.explode(F.array(*places)).alias("place")).groupBy("row").agg(F.array(*words).alias("bits")), rows


def sifted(words: DataFrame, bits: DataFrame, rows: int) -> DataFrame:
    """The words whose key may be one of those that a sieve was made of."""
    row, places = _sieve_places(F.col("key"), rows)
    kept = words.withColumn("row", row).join(F.broadcast(bits), "row")
    for place in places:
        kept = kept.filter(F.getbit(F.get("bits", F.floor(place / 64).cast("int")), place % 64) == 1)
    return kept.drop("row", "bits")


def eligible_rows(
    lines: DataFrame,
    keys: DataFrame,
    rules: dict[str, str] = RULES,
    chunk_lines: int = CHUNK_LINES,
    broadcast_keys: int = BROADCAST_KEYS,
    ltrim_lines: bool = False,
) -> DataFrame:
    """Lines with an accepted identifier: (file_id, chunk, line_no, cusip, shprn, line).

    ``keys`` comes from ``lookup_keys``. When it is small enough, counted, it is broadcast, the
    text travels along, and the accepted lines are shuffled once. When it is not, a broadcast sieve
    of its keys leaves out nearly all words that are none; what is left, with its line, is dealt by
    key and meets the dictionary, and the accepted lines are shuffled as before. Lines without a
    likely word are never shuffled.

    The result is partitioned by ``(file_id, chunk)``; later per-filing steps build on that.
    """
    words = candidates(lines, rules, chunk_lines)
    if fits(keys, broadcast_keys):
        accepted = words.join(F.broadcast(keys), "key", "left_semi")
    else:
        keys = land(keys, "keys")
        bits, rows = sieve(keys)
        # An inner join: the optimizer would move a semi join below the sieve. A key met twice is one row again below.
        accepted = sifted(words, bits, rows).join(keys, "key")
    best = accepted.repartition("file_id", "chunk").groupBy("file_id", "chunk", "line_no", "line").agg(F.min("rank").alias("rank"))
    word = F.get(_found(F.col("line"), rules), (F.col("rank") % F.lit(1 << 32)).cast("int"))
    picked = best.withColumn("cusip", F.upper(word))
    line = F.ltrim("line") if ltrim_lines else F.col("line")
    return picked.select(
        "file_id",
        "chunk",
        "line_no",
        "cusip",
        share_tag(F.col("line"), F.col("cusip"), rules).alias("shprn"),
        line.alias("line"),
    )


def accepted_bits(eligible: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """``(file_id, chunk, bits)``: which lines of a chunk are accepted, 64 lines in a number.

    One row per chunk that has any, of some 8 bytes for each 64 lines up to the last accepted one.
    """
    place = F.pmod("line_no", F.lit(chunk_lines)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)))
    words = eligible.groupBy("file_id", "chunk", F.floor(place / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    per_chunk = words.groupBy("file_id", "chunk").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("found"), F.max("word").alias("last")
    )
    filled = F.transform(
        F.sequence(F.lit(0), F.col("last")),
        lambda word: F.coalesce(F.try_element_at("found", word), F.lit(0).cast("bigint")),
    )
    return per_chunk.select("file_id", "chunk", filled.alias("bits"))


def placed(lines: DataFrame, chunk_lines: int = CHUNK_LINES) -> Column:
    """The chunk of a line: its column, where lines were dealt by it, else computed."""
    return F.col("chunk") if "chunk" in lines.columns else chunk_of("line_no", chunk_lines).alias("chunk")


def remainder_lines(
    lines: DataFrame, eligible: DataFrame, rules: dict[str, str] = RULES, chunk_lines: int = CHUNK_LINES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every line without an accepted identifier, for audit.

    Skipped lines stay as they are, the others appear as they were searched, without dashes.
    No text is moved to find out: a chunk's accepted lines come to its text as one small row of
    bits. These are broadcast if their measured size allows it; else they are dealt by chunk, and
    lines that lie so already (``land_by_chunk``) stay where they are. Lines of any other table
    are dealt by chunk then, so those of a huge filing spread over many tasks.
    """
    line = strip_right(F.col("line"))
    text = lines.select(
        "file_id",
        placed(lines, chunk_lines),
        "line_no",
        F.when(is_skipped(line, rules), line).otherwise(without_dashes(line)).alias("line"),
    )
    bits = land(accepted_bits(eligible, chunk_lines), "accepted")
    size = bits.agg(F.sum(F.size("bits") * 8 + F.octet_length("file_id") + 64)).first()[0] or 0
    found = F.broadcast(bits) if size <= broadcast_bytes else bits.hint("shuffle_hash")
    place = F.pmod("line_no", F.lit(chunk_lines)).cast("int")
    accepted = F.getbit(F.get("bits", F.floor(place / 64).cast("int")), F.pmod(place, F.lit(64))) == 1
    return text.join(found, ["file_id", "chunk"], "left").filter(
        ~F.coalesce(accepted, F.lit(False))
    ).select("file_id", "line_no", "line")


def coverage(lines: DataFrame, eligible: DataFrame, remainder: DataFrame) -> DataFrame:
    """Lines, accepted lines and remaining lines per filing; the last two add up to the first."""
    counted = [
        table.select("file_id", F.lit(kind).alias("kind"))
        for kind, table in (("n_lines", lines), ("n_eligible", eligible), ("n_remainder", remainder))
    ]
    def tally(kind):
        return F.count_if(F.col("kind") == kind).alias(kind)
    return (
        counted[0].unionByName(counted[1]).unionByName(counted[2])
        .groupBy("file_id").agg(tally("n_lines"), tally("n_eligible"), tally("n_remainder"))
    )
