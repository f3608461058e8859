"""Matching rules and other fixed values of the filing format."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from ledgerline.functions.patterns import check_rule

# The matching rules, all applied ignoring case.
RULES = {
    "CUSIP": r"(?P<cusip>[A-Z0-9]{9}|[A-Z0-9]{5,8}(?:\s|\d|\w)?|[A-Z0-9]{5,6}[-\s][A-Z0-9]{2}[-\s][A-Z0-9])",
    "Shprn": r"[\s\d]?(?P<Shprn>SH|PRN|X)",
    "Anyopt": r"([^\w]P[UT\s]{1,2}|[^\w]C[AL\s]{1,3}|[^\w]OP[TION\s]{1,5})",
    "SkipL": r"SEC|\.txt|\.sgml|ACCESSION|CONFORMED PERIOD|FILED AS OF|BUSINESS PHONE|IRS NUMBER|:",
    "UseL": r"<TABLE>",
    "StopL": r"</TABLE>",
}

# Markers and defaults of the holdings tables.
MISSING = "-999999"
UNLIKELY = "Unlikely"
NOT_APPLICABLE = "N/A"
DEFAULT_CUT = 30
FALSE_OPTIONS = ["CLA", "PU", "CL A", "CL"]
DEFINITE_OPTIONS = ["CALL", "PUT"]
LONGEST_NAME = 35
FLAG_BAD = "Likely bad observation"
FLAG_EMPTY = "Missing shares or value"
FLAG_SAME = "Possible invalid CUSIP, same as shares or value"
FLAG_FALSE = "Likely false positive"
FLAG_TRUE = "Likely true positive"

# Header keys, in output order.
OTHER_MANAGERS = "Number of Other Included Managers"
ENTRY_TOTAL = "Form 13F Information Table Entry Total"
VALUE_TOTAL = "Form 13F Information Table Value Total"
HEADER_KEYS = [
    "CIK", "date", "ACCESSION NUMBER", "CONFORMED SUBMISSION TYPE", "PUBLIC DOCUMENT COUNT",
    "EFFECTIVENESS DATE", "CONFORMED PERIOD OF REPORT", "FILED AS OF DATE",
    "COMPANY CONFORMED NAME", "CENTRAL INDEX KEY", "IRS NUMBER", "FISCAL YEAR END",
    "FORM TYPE", "SEC FILE NUMBER", "FILM NUMBER", "STREET 1", "STREET 2", "CITY", "STATE",
    "ZIP", "BUSINESS PHONE", OTHER_MANAGERS, ENTRY_TOTAL, VALUE_TOTAL,
]
TOTAL_RULES = {
    OTHER_MANAGERS: r"number of other included managers:?\s*_*(\d*)",
    ENTRY_TOTAL: r"form 13f information table entry total:?\s*_*(\d*,?\d*,?\d*)",
    VALUE_TOTAL: r"form 13f information table value total:?\s*\$?_*(\s?\d*,?\d*,?\d*\.?\d*)",
}
HEADER_OPEN = "<SEC-HEADER>"
HEADER_CLOSE = "</SEC-HEADER>"
FILING_URL = "ftp://ftp.sec.gov/edgar/data/"

# The form types selected by default.
FORM_TYPES = ["13F-HR", "13F-HR/A", "13F-NT", "13F-NT/A"]


def java(pattern: str) -> str:
    """A rule as Spark's regex functions expect it: Java group names, case ignored, lines ended by \\n alone."""
    flags = "(?id)" if re.search(r"[.$^]", re.sub(r"\\.|\[\^", "", pattern)) else "(?i)"
    return flags + pattern.replace("(?P<", "(?<")


def load_rules(spark: SparkSession, path: str) -> dict[str, str]:
    """Read a user's rule table (columns Type, Pattern) and lay it over the built-in rules.

    The table is configuration of a few rows; it becomes literals in the plan, because
    a literal pattern is compiled once per task and a joined column once per row. A rule that
    Java would read otherwise, or that could take a line exponential time, is a ``RuleError``.
    """
    table = (
        spark.read.schema("Type STRING, Pattern STRING")
        .csv(path, header=True, enforceSchema=False, escape='"')
    )
    own = {row["Type"]: row["Pattern"] or "" for row in table.collect()}
    for name, pattern in own.items():
        check_rule(name, pattern)
    return RULES | own
