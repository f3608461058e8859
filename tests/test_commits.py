"""Commits over several tables: broken off, delivered twice, merged; what is published is not read again."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.eligible import eligible_rows
from ledgerline.operators.header import header_fields
from ledgerline.operators.holdings import holdings
from ledgerline.plans import run
from ledgerline.plans.run import TABLES, curate, extract
from ledgerline.sources import commits
from ledgerline.sources.commits import merge_log, read_table, sweep
from ledgerline.sources.landing import shared_folder
from ledgerline.streaming import arrivals
from ledgerline.streaming.arrivals import arriving_bundles, arriving_filings, publish

ROWS = [name for name in TABLES if name != "collisions"]


def filing(i):
    return "".join(f"APPLE {i}{j}   COM  037833100   {i}   {j} {'CALL' if j % 3 == 0 else ''}\n" for j in range(i)) + "a notice\n"


@pytest.fixture
def keys(spark):
    return spark.createDataFrame([("037833",)], "key string").cache()


def put(tmp_path, i, folder="rawdata_2001_QTR1"):
    path = tmp_path / "raw" / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{i}_2001-02-{i:02}_{i}.txt").write_text(filing(i))


def tables(spark, folder, names=ROWS):
    return {name: sorted(map(repr, read_table(spark, folder, name).drop("commit").collect())) for name in names}


def lines(spark, raw):
    return run.land(arrivals.lines_of_blocks(spark.read.text(f"{raw}/*/*.txt").select(
        arrivals.file_id_of(F.col("_metadata.file_path")).alias("file_id"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))), "lines")


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """Files, and the tables of one run over them."""
    root = tmp_path_factory.mktemp("whole")
    for i in range(1, 7):
        put(root, i)
    extract(lines(spark, root / "raw"), spark.createDataFrame([("037833",)], "key string"), str(root / "out"))
    return root


@pytest.fixture
def copied(whole, tmp_path):
    shutil.copytree(whole, tmp_path, dirs_exist_ok=True)
    return tmp_path


def ended(*args):
    raise RuntimeError("lost")


def test_a_batch_that_ends_between_two_tables(spark, tmp_path, whole, keys, monkeypatch):
    raw, folder, state = whole / "raw", str(tmp_path / "out"), tmp_path / "state"
    want, before = tables(spark, str(whole / "out")), set(os.listdir(shared_folder(spark)))
    assert [len(want[name]) for name in ("headers", "holdings", "remainder")] == [6, 21, 6]
    arrived = lambda: arriving_filings(spark, f"{raw}/*/*.txt")
    with monkeypatch.context() as broken:
        broken.setattr(run, "write_merged", ended)
        with pytest.raises(Exception, match="lost"):
            publish(arrived(), keys, folder, str(state))
    # Rows lie there, and count for nothing.
    assert (tmp_path / "out/holdings").exists() and read_table(spark, folder, "holdings").count() == 0
    publish(arrived(), keys, folder, str(state))
    assert tables(spark, folder) == want
    # Delivered once more after it was recorded, since the stream could not note it; and by another run.
    for note in [*state.glob("commits/0"), *state.glob("commits/.0.*")]:
        note.unlink()
    publish(arrived(), keys, folder, str(state))
    given = lines(spark, raw)
    extract(given, keys, folder)
    assert tables(spark, folder) == want and commits.commits(spark, folder).count() == 1
    # Nobody who reads the folders themselves sees a row twice either, and nothing else is left behind.
    assert spark.read.parquet(f"{folder}/holdings").count() == 21 and sweep(spark, folder, TABLES) == []
    assert set(os.listdir(shared_folder(spark))) - before == {given.inputFiles()[0].split("/")[-2], blocks_of(spark, before)}


def blocks_of(spark, before):
    """The landed blocks of the lines that the test itself made."""
    return next(name for name in os.listdir(shared_folder(spark)) if name.startswith("blocks-") and name not in before)


def test_batches_of_bundles_give_what_one_run_gives(spark, tmp_path, whole, keys):
    folder, bundles, all_lines = str(tmp_path / "out"), str(tmp_path / "bundles"), lines(spark, whole / "raw")
    all_lines.repartition(4, "file_id").write.parquet(bundles)
    publish(arriving_bundles(spark, bundles, maxFilesPerTrigger=2), keys, folder, str(tmp_path / "state"), lambda batch: batch)
    assert tables(spark, folder) == tables(spark, str(whole / "out")) and commits.commits(spark, folder).count() > 1
    found = eligible_rows(all_lines, keys)
    assert sorted(map(repr, holdings(found).collect())) == sorted(map(repr, read_table(spark, folder, "holdings").drop("commit", "year", "quarter").collect()))
    assert sorted(map(repr, header_fields(all_lines.select("file_id").distinct(), all_lines).collect())) == sorted(
        map(repr, read_table(spark, folder, "headers").drop("commit", "year", "quarter").collect()))


def test_published_rows_are_not_read_again(spark, copied, keys):
    folder = str(copied / "out")
    for name in ROWS:  # whoever opened these would fail
        for part in (copied / "out" / name).rglob("*.parquet"):
            part.write_bytes(b"not parquet")
    put(copied, 9)
    put(copied, 3, "rawdata_2002_QTR1")  # a name that is there, in another folder
    extract(lines(spark, copied / "raw"), keys, folder, commit="second")
    new = {"rawdata_2001_QTR1/9_2001-02-09_9", "rawdata_2002_QTR1/3_2001-02-03_3"}
    for name, key, n in (("headers", "file", 2), ("holdings", "file_id", 12), ("stock", "filename", 12), ("remainder", "file_id", 2), ("layouts", "file_id", 2)):
        rows = spark.read.parquet(f"{folder}/{name}/commit=second").collect()
        assert {r[key] for r in rows} == new and len(rows) == n
    assert commits.log(spark, folder).count() == 8


def test_mixed_files_are_set_aside(spark, tmp_path, keys):
    folder = str(tmp_path / "out")
    rows = [("1_2001-01-01_1", 0, "a"), ("1_2001-01-01_1", 0, "b"), ("1_2001-01-01_1", 1, "c"), ("2_2001-01-01_1", 0, "x"), (None, 0, "y")]
    table = spark.createDataFrame(rows, "file_id string, line_no int, line string")
    extract(table, keys, folder)
    assert [tuple(r)[:3] for r in spark.read.parquet(f"{folder}/collisions").select("file_id", "n_lines", "last_line").collect()] == [("1_2001-01-01_1", 3, 1)]
    assert {r["file"] for r in read_table(spark, folder, "headers").collect()} == {"2_2001-01-01_1", ""}
    for _ in range(2):
        extract(table.where("line <> 'b'"), keys, folder)
    assert sorted(r["file"] for r in read_table(spark, folder, "headers").collect()) == ["", "1_2001-01-01_1", "2_2001-01-01_1"]


def commit(spark, folder, name, *files):
    """A commit of one table, by hand."""
    rows = commits.with_period(spark.createDataFrame([(f,) for f in files], "file_id string"))
    commits.write(rows, folder, "names", name)
    commits.record(rows, folder, name)


def names(spark, folder):
    return sorted(r["file_id"] for r in read_table(spark, folder, "names").collect())


def test_the_log_is_read_for_the_periods_in_question(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    commit(spark, folder, "a", *[f"1_2001-{month:02}-01_{month}" for month in (1, 4, 7)], "undated")
    for part in (tmp_path / "_log/filings").rglob("quarter=3/*.parquet"):
        part.write_bytes(b"not parquet")
    filings = commits.with_period(spark.createDataFrame([("1_2001-01-01_1",), ("1_2001-05-01_9",), ("1_2001-04-01_4",), ("undated",)], "file_id string"))
    for limit in (10, 0):
        monkeypatch.setattr(commits, "BROADCAST_FILINGS", limit)
        assert {r["file_id"] for r in commits.known(spark, folder, filings).collect()} == {"1_2001-01-01_1", "1_2001-04-01_4", "undated"}


def test_merged_logs(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    for i in range(3):
        commit(spark, folder, f"c{i}", f"1_2001-01-01_{i}", f"1_2001-07-01_{i}")
    want = names(spark, folder)
    for step in ("_put", "remove"):  # a merge that breaks off changes nothing
        with monkeypatch.context() as broken:
            broken.setattr(commits, step, ended)
            with pytest.raises(RuntimeError):
                merge_log(spark, folder)
        assert names(spark, folder) == want and commits.log(spark, folder).count() == 6
    commit(spark, folder, "c3", "1_2001-01-01_3")
    for _ in range(2):
        merge_log(spark, folder)
    assert names(spark, folder) == [*want[:3], "1_2001-01-01_3", *want[3:]] and commits.log(spark, folder).count() == 7
    assert len([r for r in commits._heads(spark, folder).collect()]) == 1
    assert all(commits.is_recorded(spark, folder, f"c{i}") for i in range(4)) and not commits.is_recorded(spark, folder, "c4")


def test_swept_commits(spark, tmp_path):
    folder = str(tmp_path)
    commit(spark, folder, "kept", "1_2001-01-01_1")
    commits.write(commits.with_period(spark.createDataFrame([("2_2001-01-01_1",)], "file_id string")), folder, "names", "lost")
    assert spark.read.parquet(f"{folder}/names").count() == 2 and names(spark, folder) == ["1_2001-01-01_1"]
    assert sweep(spark, folder, ["names"]) == ["lost"] and spark.read.parquet(f"{folder}/names").count() == 1
    commit(spark, folder, "lost", "2_2001-01-01_1")
    assert names(spark, folder) == ["1_2001-01-01_1", "2_2001-01-01_1"]


def test_curated_archive_reads_its_log_only(spark, tmp_path, whole):
    target, own = str(tmp_path / "curated"), spark.createDataFrame([("1",), ("3",)], "cik string")
    given = lines(spark, whole / "raw")
    curate(given, own, target)
    for part in (tmp_path / "curated").glob("commit=*/**/*.parquet"):
        part.write_bytes(b"not parquet")
    curate(given, own.unionByName(spark.createDataFrame([("5",)], "cik string")), target, commit="second")
    got = spark.read.parquet(f"{target}/commit=second")
    assert {r["file_id"] for r in got.collect()} == {"rawdata_2001_QTR1/5_2001-02-05_5"} and got.count() == 6


@pytest.mark.parametrize("limit", [0, 1, 100])
def test_long_lists_of_filings(spark, monkeypatch, limit):
    monkeypatch.setattr(run, "BROADCAST_FILINGS", limit)
    rows = [(f"f{i}", j, "x") for i in range(6) for j in range(3)]
    given = spark.createDataFrame(rows, "file_id string, line_no int, line string")
    for fresh in (set(), {"f1"}, {"f0", "f2", "f3", "f4"}, {f"f{i}" for i in range(6)}):
        states = run.filings_of(given).withColumn("state", F.when(F.col("file_id").isin(list(fresh)), "fresh").otherwise("known"))
        counts = {r["state"]: r["count"] for r in states.groupBy("state").count().collect()}
        got = run._lines_of(given, states, counts)
        assert sorted(map(tuple, got.collect())) == [r for r in rows if r[0] in fresh]
