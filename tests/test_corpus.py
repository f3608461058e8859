"""The corpus derived from the tables."""

import time

from ledgerline.operators.header import header_events, header_fields, header_values
from ledgerline.plans import corpus as corpora
from ledgerline.sources import landing
from ledgerline.sources.landing import PASSING, land

FOLDER = "/root/testdata/sf0.001"


def test_long_filings_are_numbered_alike_in_pieces(spark, monkeypatch):
    usual = corpora.Corpus(spark, FOLDER).holding_lines()
    want = sorted(map(tuple, usual.collect()))
    monkeypatch.setattr(corpora, "CHUNK_LINES", 2)
    pieces = corpora.Corpus(spark, FOLDER).holding_lines()
    assert sorted(map(tuple, pieces.collect())) == want


def test_line_numbers_skip_at_most_the_two_totals(spark):
    lines = corpora.corpus(spark, FOLDER).lines()
    bad = lines.groupBy("file_id").agg({"line_no": "max", "*": "count"}).filter("`max(line_no)` >= `count(1)` + 2")
    assert bad.count() == 0


def test_texts_are_made_after_the_last_shuffle(spark):
    body = corpora.Corpus(spark, FOLDER)._body()
    plan = body._jdf.queryExecution().executedPlan().toString()
    above, *below = plan.split("Exchange")
    assert "SH SOLE" in above and not any("SH SOLE" in part for part in below)


def test_filings_under_one_key_have_the_totals_of_its_lines(spark, tmp_path):
    import datetime as dt

    when = dt.datetime(1994, 5, 6)
    tables = {
        "orders": ([(2, 7, when), (2, 8, when), (3, 7, when), (None, 7, when)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "customer": ([(7, "Seven"), (8, "Eight")], "c_custkey long, c_name string"),
        "part": ([(1, "one"), (4, "four"), (4, "vier")], "p_partkey long, p_name string"),
        "lineitem": (
            [(2, n, p, 5, 3.0, 10.5 + n, 0.0, 0.0, "R", "F", when) for n, p in ((1, 1), (2, 4), (3, 99))] + [(None, 1, 1, 5, 3.0, 9.0, 0.0, 0.0, "R", "F", when)],
            "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, "
            "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = corpora.Corpus(spark, str(tmp_path)).lines().collect()
    for filing in ("8_1994-05-06_3", "9_1994-05-06_3"):
        lines = sorted((r["line_no"], r["line"]) for r in found if r["file_id"] == filing)
        # One line for each name of a part, none for a part that is not there.
        assert [n for n, _ in lines if n > 12] == [13, 14, 14, 16]
        assert dict(lines)[10].endswith("Total:  3") and dict(lines)[11].endswith("$ 0,035")
    assert max(r["line_no"] for r in found if r["file_id"] == "8_1994-05-06_4") == 13


def test_landing_leaves_no_shuffle_files(spark):
    def kept():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    before = kept()
    land(spark.range(1000).repartition(5, "id"), "dealt")
    deadline = time.time() + 10
    while kept() > before and time.time() < deadline:
        time.sleep(0.2)
    assert kept() <= before
    assert spark.conf.get(PASSING) == "false"


def test_headers_are_dealt_by_chunk_once(spark):
    lines = corpora.corpus(spark, FOLDER).lines()
    events = land(header_events(lines), "events")
    plan = header_values(events)._jdf.queryExecution().executedPlan().toString()
    dealt = [part for part in plan.split("\n") if "Exchange hashpartitioning" in part]
    # The events and what tells where to stop by chunk, the stops and one row a chunk by filing.
    assert len(dealt) <= 4


def test_totals_over_several_chunks(spark):
    text = ["<SEC-HEADER>", "FORM 13F INFORMATION TABLE ENTRY TOTAL: 4", "Form 13F Information Table Entry Total: 5", "CIK: 1",
            "FORM 13F INFORMATION TABLE ENTRY TOTAL: ", "x", "Form 13F Information Table Entry Total: 7", "CIK: 2",
            "Form 13F Information Table Entry Total: 8", "</SEC-HEADER>", "CIK: 3"]
    lines = spark.createDataFrame([("f", i, line) for i, line in enumerate(text)], "file_id string, line_no int, line string")
    files = spark.createDataFrame([("f",), ("g",)], "file_id string")
    want = {tuple(r) for r in header_fields(files, lines).collect()}
    assert {tuple(r) for r in header_fields(files, lines, 2).collect()} == want
    assert {tuple(r) for r in header_fields(files, lines, 3).collect()} == want


def test_landed_files_have_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "LANDED_ROWS", 100)
    landing.land_more(spark.range(250, numPartitions=1), str(tmp_path / "rows"))
    both = landing.land_more(spark.range(250, 500, numPartitions=1), str(tmp_path / "rows"))
    assert both.count() == 500
    assert max(r["count"] for r in both.groupBy("_metadata.file_path").count().collect()) == 100
