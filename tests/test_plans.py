"""The shape of the plans."""

import pytest

from ledgerline.operators.eligible import eligible_rows, remainder_lines
from ledgerline.operators.holdings import holdings
from ledgerline.operators.index import in_periods
from ledgerline.operators.merge import definite_options, merged
from ledgerline.plans.corpus import corpus
from ledgerline.plans.queries import OPERATORS
from ledgerline.sources.landing import land, land_by_chunk

FOLDER = "/root/testdata/sf0.001"


def plan_of(frame, run=False):
    execution = frame._jdf.queryExecution()
    if run:
        execution.toRdd().count()
    text = execution.executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if run else text


@pytest.fixture(scope="module")
def tables(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    return corpus(spark, FOLDER)


@pytest.mark.parametrize("name", [name for name in OPERATORS if not name.startswith("stream_")])
def test_no_query_pairs_rows_without_a_key_or_runs_python(tables, name):
    plan = plan_of(OPERATORS[name](tables))
    for bad in ("NestedLoop", "Cartesian", "Python", "Pandas", "SinglePartition"):
        assert bad not in plan


def test_accepted_lines_are_shuffled_once_and_shared(spark, tables):
    plan = plan_of(holdings(eligible_rows(tables.lines(), tables.keys())), run=True)
    assert plan.count("REPARTITION_BY_COL") == 2 and "ReusedExchange" in plan
    assert plan.count("posexplode(regexp_extract_all") == 1


def test_lines_stay_where_they_are_without_broadcast(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(holdings(eligible_rows(tables.lines(), tables.keys(), broadcast_keys=0)), run=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only the table of three-letter beginnings is broadcast.
    assert plan.count("+- BroadcastExchange") <= 2
    assert "SortMergeJoin [key" in plan
    last = plan.index("SortMergeJoin [file_id")
    assert "SortMergeJoin [file_id" in plan and "chunk" in plan[last:last + 80]
    above = plan[:plan.index("REPARTITION_BY_COL")]
    assert "ENSURE_REQUIREMENTS" not in above


def test_merge_moves_nothing(spark, tables):
    rows = land(holdings(eligible_rows(tables.lines(), tables.keys())), "rows")
    stock = merged(rows)
    assert "Exchange" not in plan_of(stock) and "Exchange" not in plan_of(definite_options(stock))


def test_periods_prune_partitions(spark, tables):
    plan = plan_of(in_periods(tables.index(), [1996], [1, 2]))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "quarter" in filters


def test_columns_are_pruned(spark, tables):
    plan = plan_of(OPERATORS["skip_lines"](tables))
    assert "ReadSchema: struct<file_id:string,line_no:int,line:string>" in plan
    manifest = plan_of(OPERATORS["incremental_skip"](tables))
    assert "l_comment" not in manifest and "c_acctbal" not in manifest


def test_reference_tables_are_read_once(tables):
    plan = plan_of(tables.dictionary())
    assert plan.count("FileScan") == 3


def test_remainder_moves_no_text(spark, tables):
    lines = land_by_chunk(tables.lines().select("file_id", "line_no", "line"), 5)
    eligible = land(eligible_rows(lines, tables.keys()), "eligible")
    for limit in (1 << 26, 0):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760" if limit else "-1")
        try:
            rest = remainder_lines(lines, eligible, broadcast_bytes=limit)
            plan = plan_of(rest, run=True)
            assert ("BroadcastHashJoin" if limit else "ShuffledHashJoin") in plan
            text = next(part for part in plan.split("\n") if "FileScan" in part and ",line#" in part or "line#" in part and "FileScan" in part)
            assert "Bucketed: true" in text or limit
            # Only rows of bits are exchanged.
            exchanged = [part for part in plan.split("\n") if "Exchange" in part and "Broadcast" not in part]
            assert all("file_id" in part and "chunk" in part for part in exchanged) and len(exchanged) <= 1
            assert rest.count() == lines.count() - eligible.count()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bits_of_chunk_boundaries(spark):
    rows = [("f", i, f"APPLE 037833100 {i}" if i % 5 == 0 else f"no {i}") for i in range(700)] + [("g", i, "none") for i in range(3)]
    lines = spark.createDataFrame(rows, "file_id string, line_no int, line string")
    keys = spark.createDataFrame([("037833",)], "key string")
    for chunk_lines in (1, 64, 100, 65536):
        eligible = eligible_rows(lines, keys, chunk_lines=chunk_lines)
        for limit in (1 << 26, 0):
            got = {(r["file_id"], r["line_no"]) for r in remainder_lines(lines, eligible, chunk_lines=chunk_lines, broadcast_bytes=limit).collect()}
            assert got == {(f, i) for f, i, line in rows if line[0] == "n"}
