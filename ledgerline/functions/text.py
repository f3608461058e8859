"""Small Column helpers. All of them are built-ins, so plans stay free of Python workers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerline.functions.rules import MISSING

# Everything a text strip removes: ASCII and Unicode white space.
WHITE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
NEWLINES = r"\r\n|\r|\n"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def strip_right(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITE))


def strip_left_chars(text: Column, chars: str) -> Column:
    return F.ltrim(text, F.lit(chars))


def strip_right_chars(text: Column, chars: str) -> Column:
    return F.rtrim(text, F.lit(chars))


def without_zeros(text: Column) -> Column:
    """Leading zeros removed."""
    return F.ltrim(text, F.lit("0"))


def count_of(text: Column, piece: str) -> Column:
    """How often a single character occurs."""
    return F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))


def offset_of(text: Column, pattern: str) -> Column:
    """0-based offset of the first match, -1 when there is none."""
    return F.regexp_instr(text, F.lit(pattern)) - 1


def once(value: Column) -> Column:
    """Generator of one row: a column made with it is computed once, however often it is used.

    The optimizer copies a plain projected expression to each place that reads it.
    """
    return F.explode(F.array(value))


def clean_utf8(text: Column) -> Column:
    """Bad bytes dropped (a genuine replacement character goes with them)."""
    return F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit(""))


# Possessive, so that a field of any length takes no stack.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'


def csv_fields(line: Column) -> Column:
    """The raw fields of one comma-separated line, quotes still on.

    A field is quoted only when its first character is a quote; a quote further in is an
    ordinary character, and text after a closing quote belongs to the field.
    """
    return F.regexp_extract_all(
        F.concat(line, F.lit(",")), F.lit(rf'({QUOTED}[^,]*+|[^",][^,]*+|),'), F.lit(1)
    )


def csv_value(field: Column) -> Column:
    """One raw field without its quotes."""
    quoted = F.regexp_extract(field, f"^({QUOTED})", 1)
    inside = F.replace(
        F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit('""'), F.lit('"')
    )
    after = F.substring(field, F.length(quoted) + 1, F.length(field))
    return F.when(F.startswith(field, F.lit('"')), F.concat(inside, after)).otherwise(field)


def as_number(text: Column) -> Column:
    """Typed sibling of a raw number text, decimal(38,6): thousands separators gone, null when not a number.

    A sign and a fraction may stand: 32 digits before the point and 6 behind it, zeros aside. A longer
    number is null, not cut, and so is the mark of what could not be split.
    """
    bare = F.replace(strip(text), F.lit(","), F.lit(""))
    exact = bare.rlike(r"^[+-]?(?:\d+(?:\.\d{0,6}0*)?|\.\d{1,6}0*)$") & (strip(text) != MISSING)
    return F.when(exact, bare.try_cast("decimal(38,6)"))


def unparsed(text: Column) -> Column:
    """Whether a text that is not blank has no number."""
    return (F.coalesce(strip(text), F.lit("")) != "") & as_number(text).isNull()
