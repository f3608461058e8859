"""Quotes that run over lines, against the standard reader of comma files."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.text import csv_fields, csv_value
from ledgerline.operators.eligible import eligible_rows
from ledgerline.operators.holdings import holdings
from ledgerline.operators.quotes import quoted_records, with_quote_state


def table(spark, files, chunk_lines):
    rows = [(name, i // chunk_lines, i, line, f"{name}{i}") for name, text in files.items() for i, line in enumerate(text)]
    return spark.createDataFrame(rows, "file_id string, chunk int, line_no int, line string, extra string")


def random_files(seed, n, alphabet):
    pick = random.Random(seed)
    return {f"f{k}": ["".join(pick.choices(alphabet, k=pick.randrange(0, 7))) for _ in range(pick.randrange(1, 40))] for k in range(n)}


def read(text):
    """(number of the first line, fields) of each record."""
    reader, out, at = csv.reader(text), [], 0
    for fields in reader:
        out.append((at, fields))
        at = reader.line_num
    return out


@pytest.mark.parametrize("chunk_lines", [1, 4, 1000])
def test_random_lines(spark, chunk_lines):
    files = random_files(chunk_lines, 150, '""",,ab ')
    lines = table(spark, files, chunk_lines)
    found = quoted_records(lines, chunk_lines).select(
        "file_id", "line_no", "line", "extra", "chunk", F.transform(csv_fields(F.col("line")), csv_value).alias("fields"))
    got = {}
    for r in found.orderBy("file_id", "line_no").collect():
        assert r["extra"] == f"{r['file_id']}{r['line_no']}" and r["chunk"] == r["line_no"] // chunk_lines
        got.setdefault(r["file_id"], []).append((r["line_no"], r["line"], r["fields"]))
    for name, text in files.items():
        want = read(text)
        assert [n for n, _, _ in got[name]] == [n for n, _ in want]
        ends = [n for n, _ in want[1:]] + [len(text)]
        whole = ["".join(text[a:b]) for (a, _), b in zip(want, ends)]
        if open_at_end(whole[-1]):
            whole[-1] += '"'
        assert [line for _, line, _ in got[name]] == whole
        # The reader gives no field for an empty line, and the fields of others as they are here.
        assert [fields if line else [] for _, line, fields in got[name]] == [fields for _, fields in want]


def open_at_end(line):
    return len(list(csv.reader([line, "x"]))) == 1


def test_state_over_chunk_boundaries(spark):
    text = ['a,"b', 'c', 'd",e', 'f', '"', '"', 'x"y', '"p""', '""q', 'r"'] * 3
    for chunk_lines in (1, 3, 100):
        rows = with_quote_state(table(spark, {"f": text}, chunk_lines)).orderBy("line_no").collect()
        starts = [r["line_no"] for r in rows if not r["begins"]]
        assert starts == [n for n, _ in read(text)]
        assert all(a["ends"] == b["begins"] for a, b in zip(rows, rows[1:]))


def test_records_too_long_to_put_together(spark):
    text = ['a,"b', *["x" * 10] * 50, 'c"', "d,e", '"f', 'g"']
    got = [tuple(r) for r in quoted_records(table(spark, {"f": text}, 8), 8, longest=100).select("line_no", "line").orderBy("line_no").collect()]
    assert got == [(i, line) for i, line in enumerate(text[:53])] + [(53, '"fg"')]
    whole = quoted_records(table(spark, {"f": text}, 8), 8).select("line").orderBy("line_no").collect()
    assert [r["line"] for r in whole] == ["".join(text[:52]), "d,e", '"fg"']


def test_empty_table(spark):
    assert quoted_records(table(spark, {}, 4).limit(0), 4).collect() == []


def test_holdings(spark):
    comma = ['"ONE, INC",037833100,1,2,SH,SOLE', '"TWO,037833100,3,4,SH,SOLE', 'STILL, TWO",037833100,5,6,SH,PUT', 'FOUR,037833100,7,8,SH,SOLE', '"FIVE,037833100,9,9,9,9']
    tabbed = ["A\tCOM\t037833100\t1\t2", '"B\tCOM\t037833100\t3\t4']
    rows = [(name, i, line) for name, text in (("1_2001-01-01_1", comma), ("2_2001-01-01_1", tabbed)) for i, line in enumerate(text)]
    lines = spark.createDataFrame(rows, "file_id string, line_no int, line string")
    eligible = eligible_rows(lines, spark.createDataFrame([("037833",)], "key string"))
    plain, joined = ({(r["file_id"][0], r["line_no"]): r for r in holdings(eligible, quoted_lines=on).collect()} for on in (False, True))
    assert set(plain) == {("1", i) for i in range(5)} - {("1", 4)} | {("2", 0), ("2", 1)} or set(plain) >= {("1", 0), ("1", 3)}
    want = {n: fields for n, fields in read(comma) if len(fields) > 5}
    got = {n: [r["name"], r["cusip"], r["value"], r["shares"]] for (f, n), r in joined.items() if f == "1"}
    assert got == {n: fields[:4] for n, fields in want.items()} and set(got) == {0, 1, 3}
    assert got[1][0] == "TWO,037833100,3,4,SH,SOLESTILL, TWO"
    assert {k: r for k, r in joined.items() if k[0] == "2"} == {k: r for k, r in plain.items() if k[0] == "2"}
