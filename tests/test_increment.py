"""Adding filings to published tables, and inputs that broke earlier."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.rules import RULES
from ledgerline.functions.text import csv_fields
from ledgerline.plans.run import extract
from ledgerline.sources.filings import read_lines
from ledgerline.sources.landing import shared_folder
from ledgerline.streaming.arrivals import arriving_filings, ingest, lines_of_blocks

KEYS = [("037833",)]


def lines(spark, *filings):
    rows = [(name, i, line) for name, text in filings for i, line in enumerate(text)]
    return spark.createDataFrame(rows, "file_id string, line_no int, line string")


def test_new_filings_leave_old_ones(spark, tmp_path):
    keys, folder = spark.createDataFrame(KEYS, "key string"), str(tmp_path)
    read = lambda name: {tuple(r) for r in spark.read.parquet(f"{folder}/{name}").collect()}
    extract(lines(spark, ("1_2001-02-03_1", ["a notice"])), keys, folder)  # no holdings at all
    assert len(read("headers")) == 1 and len(read("remainder")) == 1
    extract(lines(spark, ("2_2001-02-04_2", ["APPLE INC   PUT  037833100   12   34 PUT"])), keys, folder)
    before = read("holdings"), read("stock"), read("option")
    assert [len(x) for x in before] == [1, 1, 1]
    other = RULES | {"Anyopt": "nothing-of-this"}
    extract(lines(spark, ("3_2001-03-03_3", ["APPLE INC   COM  037833100   5   7"]), ("2_2001-02-04_2", ["x"])), keys, folder, other)
    after = read("holdings"), read("stock"), read("option")
    assert before[0] < after[0] and before[1] < after[1] and before[2] == after[2] and len(after[1]) == 2
    assert len(read("headers")) == 3


def test_long_quoted_field(spark):
    long = '"' + '""' * 20_000 + 'x",b'
    got = spark.createDataFrame([(long,)], "line string").select(csv_fields(F.col("line")).alias("f")).first()["f"]
    assert got == [long[:-2], "b"]


def test_byte_order_mark_at_both_sizes(spark, tmp_path):
    (tmp_path / "1_2001-01-01_1.txt").write_bytes(b"\xef\xbb\xbf<SEC-HEADER>\nx\n")
    for limit in (1 << 20, 1):
        assert [r["line"] for r in read_lines(spark, f"{tmp_path}/*.txt", limit).orderBy("line_no").collect()] == ["<SEC-HEADER>", "x"]


def test_stream_of_all_sizes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1_2001-01-01_1.txt").write_text("a\nb\n")
    (tmp_path / "in/1_2001-01-01_2.txt").write_text("".join(f"line {i}\n" for i in range(50_000)))
    ingest(arriving_filings(spark, str(tmp_path / "in")), lines_of_blocks, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("file_id").agg(F.count("*").alias("n"), F.max("line_no").alias("last")).orderBy("file_id").collect()
    assert [(r["n"], r["last"]) for r in got] == [(2, 1), (50_000, 49_999)]


def test_no_shared_folder_on_a_cluster():
    class Context:
        master, applicationId = "spark://somewhere:7077", "x"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, other: other)

    with pytest.raises(ValueError):
        shared_folder(Session())
