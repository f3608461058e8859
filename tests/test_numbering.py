"""Line numbers where one key, one value or one packed file holds nearly everything."""

import gzip

from pyspark.sql import functions as F

from ledgerline.operators import chunks
from ledgerline.operators.chunks import number_sorted
from ledgerline.sources.filings import read_long_lines
from ledgerline.sources.landing import land


def test_a_skewed_order_is_numbered_in_bounded_runs(spark, monkeypatch):
    # One key has nearly all rows, most of them of one value, a third alike in everything.
    rows = spark.range(6000).select(
        F.when(F.col("id") % 100 == 0, F.col("id") % 7).otherwise(3).alias("k"),
        F.when(F.col("id") % 10 < 8, 5).otherwise(F.col("id") % 50).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.hash("id")).alias("b"),
    )
    seen = []
    plain = chunks.number_rows
    monkeypatch.setattr(chunks, "number_rows", lambda table, key, chunk, *rest: seen.append(table.groupBy(key, chunk).count().agg(F.max("count")).first()[0]) or plain(table, key, chunk, *rest))
    got = sorted((r["k"], r["n"], r["a"], r["b"]) for r in number_sorted(rows, "k", ["a", "b"], "n", land, run_rows=300).collect())
    own = {}
    for k, a, b in sorted((r["k"], r["a"], r["b"]) for r in rows.collect()):
        own.setdefault(k, []).append((a, b))
    assert got == [(k, i + 1, a, b) for k in sorted(own) for i, (a, b) in enumerate(own[k])]
    assert seen[0] < 900  # sampled ranges of about 300


def test_a_packed_file_is_sorted_in_runs(spark, tmp_path, monkeypatch):
    text = [f"line {i} " + "x" * (i % 9) for i in range(5000)]
    with gzip.open(tmp_path / "1_2001-01-01_1.txt.gz", "wt") as out:
        out.write("\n".join(text) + "\n")
    monkeypatch.setattr("ledgerline.sources.filings.run_of", lambda block, seq: chunks.run_of(block, seq, 512))
    plain, seen = chunks.number_rows, []
    monkeypatch.setattr("ledgerline.sources.filings.number_rows", lambda table, key, chunk, *rest: seen.append(table.groupBy(key, chunk).count().agg(F.max("count")).first()[0]) or plain(table, key, chunk, *rest))
    got = read_long_lines(spark, f"{tmp_path}/*.gz", 10).orderBy("line_no").collect()
    assert [r["line"] for r in got] == text and [r["line_no"] for r in got] == list(range(5000)) and seen[0] <= 512


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k long, a long")
    assert number_sorted(empty, "k", ["a"], "n", land).collect() == []
