"""Numbers in texts: signs, fractions, long numbers, and sums that say what they leave out."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions.text import as_number, unparsed
from ledgerline.operators.header import column_of, reconciled
from ledgerline.functions.rules import TOTAL_RULES


def test_as_number(spark):
    cases = {
        "1,234.50": "1234.5", "5.0": "5", "-7": "-7", "+7": "7", "123456789012345678901": "123456789012345678901", " 12 ": "12", ".5": "0.5", "5.": "5",
        "9" * 32 + ".123456": "9" * 32 + ".123456", "1.50000000": "1.5", "": None, None: None, "-": None, ".": None, "1.2.3": None, "1e5": None, "-999999": None,
        "-999,999": "-999999", "9" * 33: None, "0.1234567": None, "n/a": None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", as_number(F.col("t")), unparsed(F.col("t"))).collect()
    assert {r[0]: r[1] for r in rows} == {k: v if v is None else Decimal(v) for k, v in cases.items()}
    assert {r[0] for r in rows if r[2]} == {k for k, v in cases.items() if v is None and k}


def test_reconciled_sums_fractions_and_counts_the_rest(spark):
    entry, value = (column_of(t) for t in list(TOTAL_RULES)[1:])
    totals = {column_of(t): "" for t in TOTAL_RULES} | {entry: "4", value: "1,241.25"}
    names = ["file", "conformed_period_of_report", "date", *totals]
    headers = spark.createDataFrame([("f", "20200331", "2020-05-01", *totals.values()), ("g", "", "", *[""] * len(totals))], ", ".join(n + " string" for n in names))
    rows = [("f", v, "1", "2020-05-01") for v in ("1,234.50", "7.75", "-1", "n/a")]
    got = {r["file"]: r for r in reconciled(headers, spark.createDataFrame(rows, "filename string, value string, shares string, date string")).collect()}
    assert got["f"]["value_found"] == Decimal("1241.25") and got["f"]["values_agree"] and got["f"]["entries_agree"]
    assert got["f"]["n_unparsed"] == 1 and got["g"]["n_unparsed"] == 0 and got["g"]["value_found"] is None
