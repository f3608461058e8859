"""Random filings: the operators against the plain model, in every way they can run."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.rules import HEADER_KEYS
from ledgerline.operators.dictionary import lookup_keys
from ledgerline.operators.eligible import eligible_rows, remainder_lines
from ledgerline.operators.header import column_of, header_fields, header_region
from ledgerline.operators.holdings import holdings
from ledgerline.operators.layout import cut_positions, frequent_splits, full_profile, profile, split_on_id
from tests import model

KEYS = {"037833100", "037833", "931142103", "12345", "459200101", "45920010", "COMMON", "G1234K10", "594918"}
WORDS = ["APPLE", "INC", "COMMON", "International", "CL A", "CALL", "put", "Trust", "X", "SH", "PRN", "sole",
         "1,234", "5.50", "12345", "$77", "OPTION", "a\\tb", "CALIFORNIA", "<HTML>", "60-1"]
IDS = ["037833100", "037833-10-0", "03783310", "931142103", "93114 21 0", "g1234k10", "G1234K10", "459200101",
       "594918zz", "999999999", "12345"]
GAPS = {"fixed": ["  ", "   ", " ", "     "], "tab": ["\t", "\t", "\t\t", " "], "csv": [",", ",", ", "], "mixed": [" ", "\t", ",", "  "]}


def random_line(rng, kind):
    if kind == "short":
        return rng.choice(IDS) + " " + rng.choice(["1", "22", ""])
    left = [rng.choice(WORDS) for _ in range(rng.randint(0, 3))]
    right = [rng.choice(WORDS + ["17", "2300", "9"] * 4) for _ in range(rng.randint(0, 5))]
    cells = [*left, rng.choice(IDS), *right]
    if kind == "csv" and rng.random() < 0.4:
        cells[0] = '"' + cells[0] + ', ""CO"""'
    gap = GAPS[kind]
    line = rng.choice(["", "", " ", "   "]) + "".join(cell + rng.choice(gap) for cell in cells)
    return line + rng.choice(["", "", "", " : x", "\t"])


def random_filing(rng):
    kind = rng.choice(["fixed", "fixed", "tab", "csv", "csv", "mixed", "short"])
    return [random_line(rng, kind) for _ in range(rng.randint(0, 12))]


@pytest.fixture(scope="module")
def filings():
    rng = random.Random(7)
    return {f"{i}_2001-02-03_{i}": random_filing(rng) for i in range(400)}


@pytest.fixture(scope="module")
def lines(spark, filings):
    rows = [(name, i, line) for name, text in filings.items() for i, line in enumerate(text)]
    return spark.createDataFrame(rows, "file_id string, line_no int, line string").repartition(5).cache()


@pytest.fixture(scope="module")
def keys(spark):
    return lookup_keys(spark.createDataFrame([(key,) for key in KEYS], "key string"))


def test_lookup_keys_leave_out_what_a_prefix_decides(keys):
    assert {r["key"] for r in keys.collect()} == KEYS - {"037833100"}


@pytest.mark.parametrize("chunk_lines, broadcast_keys", [(65536, 10**6), (3, 10**6), (3, 0), (1, 0)])
def test_extraction(filings, lines, keys, chunk_lines, broadcast_keys):
    eligible = eligible_rows(lines, keys, chunk_lines=chunk_lines, broadcast_keys=broadcast_keys).cache()
    want_good, want_rest, want_rows, want_layout, want_splits = set(), set(), set(), {}, set()
    for name, text in filings.items():
        good, rest = model.resolve(text, KEYS)
        want_good |= {(name, n, *row) for n, row in good.items()}
        want_rest |= {(name, n, line) for n, line in rest.items()}
        layout, rows = model.extract(text, KEYS)
        want_layout[name] = layout
        want_rows |= {(name, row[0], layout, *row[1:]) for row in rows}
        if layout == "fixed":
            want_splits |= {(name, *key, n) for key, n in model.splits(good).items()}
    got_good = {tuple(r) for r in eligible.select("file_id", "line_no", "cusip", "shprn", "line").collect()}
    assert got_good == want_good
    rest = remainder_lines(lines, eligible, chunk_lines=chunk_lines)
    assert {tuple(r) for r in rest.collect()} == want_rest
    assert {tuple(r) for r in holdings(eligible).collect()} == want_rows
    positions = cut_positions(split_on_id(eligible))
    files = lines.select("file_id").distinct()
    got_layout = {r["file_id"]: r["layout"] for r in full_profile(files, profile(positions)).collect()}
    assert got_layout == {name: layout for name, layout in want_layout.items() if filings[name]}
    got_splits = {tuple(r) for r in frequent_splits(positions, profile(positions)).collect()}
    assert got_splits == want_splits
    assert len({row[2] for row in want_rows}) == 3 and set(want_layout.values()) >= {"html", "garbage"}


HEADER_LINES = [
    "<SEC-HEADER>x", "</SEC-HEADER>", "CIK: 77", "date:", "STREET 1: A", "\t STREET 1:\tB:C ", "STREET 1 : no",
    "CITY:", "CITY: X", "city: lower", "FORM TYPE: 13F", "Number of Other Included Managers:",
    "Number of Other Included Managers: 4", "number of other included managers 5", "nothing",
    "x Form 13F Information Table Entry Total: 1,234", "Form 13F Information Table Entry Total:",
    "Form 13F Information Table Entry Total: __12", "form 13f information table value total",
    "Form 13F Information Table Value Total:", "Form 13F Information Table Value Total: $",
    "Form 13F Information Table Value Total: 1,234,567,890", "Form 13F Information Table Value Total: $ 5.5",
]


@pytest.mark.parametrize("chunk_lines", [65536, 2])
def test_headers(spark, chunk_lines):
    rng = random.Random(11)
    weights = [4, 2] + [1] * 16 + [2] + [1] + [0.3] * 3
    filings = {
        f"{i}_2001-02-03_{i}": rng.choices(HEADER_LINES, weights, k=rng.randint(0, 14)) for i in range(300)
    }
    rows = [(name, i, line) for name, text in filings.items() for i, line in enumerate(text)]
    lines = spark.createDataFrame(rows, "file_id string, line_no int, line string")
    files = spark.createDataFrame([(name,) for name in filings], "file_id string")
    got = {r["file"]: r.asDict() for r in header_fields(files, lines, chunk_lines).collect()}
    for name, text in filings.items():
        want = model.header(text, {"CIK": name.split("_")[0], "date": "2001-02-03"})
        assert {key: got[name][column_of(key)] for key in HEADER_KEYS} == want, text
    assert set(got) == set(filings)
    flags = {(r["file_id"], r["line_no"]): r["in_header"] for r in header_region(lines, chunk_lines).collect()}
    for name, text in filings.items():
        inside = False
        for i, line in enumerate(text):
            if "SEC-HEADER>" in line:
                inside = not line.startswith("</")
            assert flags[name, i] == inside


def test_results_do_not_depend_on_partitioning(lines, keys):
    one = holdings(eligible_rows(lines.coalesce(1), keys)).orderBy("file_id", "line_no").collect()
    many = holdings(eligible_rows(lines.repartition(13, F.rand(1)), keys)).orderBy("file_id", "line_no").collect()
    assert one == many
