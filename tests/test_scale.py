"""What is shuffled when the dictionary or the part table is too large to broadcast."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.eligible import eligible_rows, sieve, sifted
from ledgerline.operators.layout import cut_positions, profile, split_on_id
from ledgerline.plans import corpus as corpora
from ledgerline.plans.corpus import Corpus
from ledgerline.sources.landing import land
from tests.test_plans import plan_of


@pytest.fixture()
def unaided(spark):
    """No join is broadcast that does not ask for it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("most_rows", [1, 1 << 19])
def test_a_sieve_keeps_every_key_and_few_others(spark, most_rows):
    keys = spark.range(3000).select(F.concat(F.lit("K"), "id").alias("key"))
    words = spark.range(30000).select(F.concat(F.lit("K"), "id").alias("key"))
    kept = {r["key"] for r in sifted(words, *sieve(keys, most_rows)).collect()}
    assert {f"K{i}" for i in range(3000)} <= kept
    assert most_rows == 1 or len(kept) < 3500


def test_only_lines_with_a_likely_word_are_shuffled(unaided):
    rows = [("f", i, f"APPLE {37833 + i:06d}100 {i}" if i % 50 == 0 else f"WORDS {700000 + i} AND OTHERS") for i in range(5000)]
    lines = land(unaided.createDataFrame(rows, "file_id string, line_no int, line string"), "few")
    keys = unaided.createDataFrame([(f"{37833 + i:06d}",) for i in range(0, 5000, 50)] + [("700",), ("WORDS9",)], "key string")
    eligible = eligible_rows(lines, keys, broadcast_keys=0)
    got = {(r["line_no"], r["cusip"]) for r in eligible.collect()}
    assert got == {(i, f"{37833 + i:06d}100") for i in range(0, 5000, 50)}
    plan = plan_of(eligible, run=True)
    # The line goes to the dictionary with its words; the lines are not read again to be joined.
    assert plan.count("SortMergeJoin") == 1 and "SortMergeJoin [key" in plan and plan.count("line#") and plan.count("regexp_extract_all(") <= 2 * plan.count("FileScan")
    assert "SortMergeJoin [file_id" not in plan


def test_positions_are_dealt_once_by_filing(unaided):
    rows = [("f", chunk, chunk * 10 + i, "037833100", f"APPLE   COM 037833100 {i}   7") for chunk in range(3) for i in range(5)] + [("g", 0, 1, "037833100", "037833100")]
    eligible = land(unaided.createDataFrame(rows, "file_id string, chunk int, line_no int, cusip string, line string"), "dealt").repartition("file_id", "chunk")
    profiles = profile(cut_positions(split_on_id(eligible)))
    got = {r["file_id"]: (r["last_chunk"], r["n_lines"], r["n_split"], r["name_cut"], r["layout"]) for r in profiles.collect()}
    assert got == {"f": (2, 15, 15, 6, "fixed"), "g": (0, 1, 1, None, "garbage")}
    # The lines by chunk, then their counts by filing.
    assert plan_of(profile(cut_positions(split_on_id(eligible)))).count("Exchange hashpartitioning") == 2


def test_names_of_many_parts_come_before_the_numbers(unaided, monkeypatch, tmp_path):
    """Items without a part count for the numbers, parts that are repeated or have no name give a line each."""
    items = [(1, n, part, 5, 10.0 + n, 100.0 * n, "R", "O", 0.0, 0.0, f"1998-01-0{n}") for n, part in ((1, 7), (2, None), (3, 8), (4, 9), (5, 6))] + [(2, 1, 9, 5, 1.0, 2.0, "N", "O", 0.0, 0.0, "1998-01-01")] * 2
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_discount double, l_tax double, l_shipdate string"
    unaided.createDataFrame(items, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    unaided.createDataFrame([(7, "red"), (9, "blue"), (9, "green"), (6, None), (None, "none")], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    few = Corpus(unaided, str(tmp_path))._holdings()
    monkeypatch.setattr(corpora, "BROADCAST_PARTS", 0)
    many = Corpus(unaided, str(tmp_path))._holdings()
    assert sorted(map(str, many.collect())) == sorted(map(str, few.select(many.columns).collect()))
    assert {(r["k"], r["rn"], r["nm"]) for r in many.collect()} == {(1, 1, "RED"), (1, 4, "BLUE"), (1, 4, "GREEN"), (1, 5, None), (2, 1, "BLUE"), (2, 1, "GREEN"), (2, 2, "BLUE"), (2, 2, "GREEN")}
    assert few.columns == many.columns
    # Parts by key, items by part, items by filing.
    assert plan_of(Corpus(unaided, str(tmp_path))._holdings()).count("Exchange hashpartitioning") == 3
