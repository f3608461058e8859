"""Hand-made filings with worked-out results."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.eligible import eligible_rows, remainder_lines
from ledgerline.operators.holdings import holdings
from ledgerline.operators.layout import cut_positions, full_profile, profile, split_on_id
from ledgerline.operators.merge import as_written, definite_options, merged, option_candidates

KEYS = ["037833100", "037833", "931142103"]
CASES = {
    "plain": "APPLE INC   COM  037833100   12345   1000 SH SOLE",
    "indented": "   APPLE INC  COM  037833100   5   7",
    "commas": "APPLE INC   COM  037833100   1,234   5.50",
    "dashed": "APPLE INC   COM  037833-10-0   12   34",
    "blank": "APPLE INC   COM  037833 12   34",
    "option": "APPLE INC   CALL  037833100   12   34 CALL",
    "false": "X CALIFORNIA WTR   COM  037833100   12   34",
    "class": "APPLE INC   COM  037833100   12   34 CL A",
    "tab": "APPLE INC\tCOM\t037833100\t12345\t1000",
    "tabsep": "APPLE INC\tCOM\t037833100\t1,234\t5",
    "tabone": "APPLE INC\tCOM\t037833100\t12345",
    "csv": '"APPLE, INC",037833100,12345,1000,SH,SOLE',
    "csvquote": '"APPLE ""A"" INC"x,037833100,1"2,3,"S,H",SOLE',
    "csvfive": "APPLE,037833100,1,2,SH",
    "csvopt": "APPLE,037833100,1,2,SH,A CALL",
    "colon": "APPLE INC: 037833100   1   2",
    "sec": "SECURITIES CO   COM  037833100   1   2",
    "unknown": "FOO CORP   COM  99-9999999   1   2",
    "sentinel": "APPLE INC\tCOM\t037833100\t12345 CALL",
    "lower": "APPLE INC   COM  03783310a   1   2",
    "longname": "A" * 40 + "   COM  037833100   12   34 CALL",
    "same": "ALPHABETA   CALL  037833   037833   34",
    "novalue": "APPLE INC\tCOM PUT\t037833100\t",
    "html": "<HTML> APPLE INC   COM  037833100   12   34",
    "garbage": "037833100 12",
    "backslash": "APPLE\\tINC\tCOM\t037833100\t12345\t1000",
    "empty": "nothing here",
}
ROWS = {
    # case: poss_hit, name, type, cusip, value, shares, opt, extra
    "plain": (False, "APPLE INC", "COM", "037833100", "12345", "1000", "Unlikely", "SH SOLE"),
    "indented": (False, "", "APPLE INC  COM", "037833100", "5", "7", "Unlikely", ""),
    "commas": (False, "APPLE INC", "COM", "037833100", "1234", "550", "Unlikely", ""),
    "dashed": (False, "APPLE INC", "COM", "037833100", "12", "34", "Unlikely", ""),
    "blank": (False, "APPLE INC", "COM", "037833", "12", "34", "Unlikely", ""),
    "option": (True, "APPLE INC", "CALL", "037833100", "12", "34", "CALL", "CALL"),
    "false": (True, "X CALIFORNIA WTR", "COM", "037833100", "12", "34", "CAL", ""),
    "class": (True, "APPLE INC", "COM", "037833100", "12", "34", "CL A", "CL A"),
    "tab": (False, "APPLE INC", "COM", "037833100", "12345", "1000", "Unlikely", ""),
    "tabsep": (False, "APPLE INC", "COM", "037833100", "234", "5", "Unlikely", ""),
    "tabone": (False, "APPLE INC", "COM", "037833100", "12345", "-999999", "Unlikely", ""),
    "csv": (False, "APPLE, INC", "N/A", "037833100", "12345", "1000", "N/A", "SH SOLE"),
    "csvquote": (False, 'APPLE "A" INCx', "N/A", "037833100", '1"2', "3", "N/A", "S,H SOLE"),
    "csvopt": (True, "APPLE", "N/A", "037833100", "1", "2", "N/A", "SH A CALL"),
    "sentinel": (True, "APPLE INC", "COM", "037833100", "12345 CALL", "-999999", "CALL", "CALL"),
    "longname": (True, "A" * 40, "COM", "037833100", "12", "34", "CALL", "CALL"),
    "novalue": (True, "APPLE INC", "COM PUT", "037833100", "", "-999999", "PUT", ""),
    "backslash": (False, "APPLE", "INC\tCOM", "037833100", "12345", "1000", "Unlikely", ""),
}
FLAGS = {
    "option": "Likely true positive",
    "false": "Likely true positive",
    "class": "Likely false positive",
    "csvopt": "Likely false positive",
    "longname": "Likely bad observation",
}


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(f"{case}_2001-02-03_1.5", 0, line) for case, line in CASES.items()]
    lines = spark.createDataFrame(rows, "file_id string, line_no int, line string")
    keys = spark.createDataFrame([(key,) for key in KEYS], "key string")
    eligible = eligible_rows(lines, keys).cache()
    return lines, eligible, holdings(eligible).cache()


def case_of(row):
    return row[0].split("_")[0]


def test_rows(tables):
    found = {case_of(r): tuple(r)[3:] for r in tables[2].collect()}
    assert {case: found.get(case) for case in ROWS} == ROWS
    assert set(found) == set(ROWS) | {"same", }


def test_flags(tables):
    stock = merged(tables[2])
    flags = {case_of(r): r["flagr"] for r in stock.collect()}
    assert {case: flag for case, flag in flags.items() if flag} == FLAGS | {"same": flags["same"]}
    assert flags["same"] == "Possible invalid CUSIP, same as shares or value"
    assert not {"sentinel", "novalue"} & set(flags)
    assert {case_of(r) for r in option_candidates(stock).collect()} == set(FLAGS) | {"same"}
    assert {case_of(r) for r in definite_options(stock).collect()} == {"option", "longname", "same"}
    written = as_written(stock).filter(F.col("CIK") == "plain").first()
    assert written.asDict() == {
        "Filename": "plain_2001-02-03_1.5", "CIK": "plain", "Date": "2001-02-03", "Poss_hit": "False",
        "Name": "APPLE INC", "Type": "COM", "CUSIP": "037833100", "Value": "12345", "Shares": "1000",
        "Opt": "Unlikely", "Extra": "SH SOLE", "FlagR": None,
    }


def test_remainder(tables):
    lines, eligible, _ = tables
    rest = {case_of(r): r["line"] for r in remainder_lines(lines, eligible).collect()}
    assert set(rest) == {"colon", "sec", "unknown", "empty"}
    assert rest["unknown"] == "FOO CORP   COM  999999999   1   2"


def test_tags_and_layouts(spark, tables):
    lines, eligible, _ = tables
    tags = {case_of(r): (r["cusip"], r["shprn"]) for r in eligible.collect()}
    assert tags["plain"] == ("037833100", "SH")
    assert tags["blank"] == ("037833 ", "")
    assert tags["lower"] == ("03783310A", "")
    profiles = full_profile(lines, profile(cut_positions(split_on_id(eligible))))
    layouts = {case_of(r): r["layout"] for r in profiles.collect()}
    assert {case: layouts[case] for case in ("html", "garbage", "empty", "csvfive", "lower", "tab", "plain")} == {
        "html": "html", "garbage": "garbage", "empty": "fixed", "csvfive": "csv", "lower": "fixed",
        "tab": "tab", "plain": "fixed",
    }


def test_split_on_tab_option(spark):
    rows = [("1_2001-01-01_1", i, f"{name}\tCOM\t037833100\t1\t2") for i, name in enumerate(["AB", "AB", "ABCD"])]
    lines = spark.createDataFrame(rows, "file_id string, line_no int, line string")
    eligible = eligible_rows(lines, spark.createDataFrame([("037833",)], "key string"))
    as_is = [r["name"] for r in holdings(eligible).orderBy("line_no").collect()]
    by_tab = [r["name"] for r in holdings(eligible, split_on_tab=True).orderBy("line_no").collect()]
    assert as_is == ["AB", "AB", "AB"] and by_tab == ["AB", "AB", "ABCD"]
