"""Files in, tables out."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.keys import file_key, identities
from ledgerline.functions.rules import RULES, load_rules
from ledgerline.operators.dictionary import entity_ids, lookup_keys, security_dictionary
from ledgerline.operators.eligible import eligible_rows
from ledgerline.operators.holdings import holdings
from ledgerline.operators.index import in_periods, parse_index
from ledgerline.operators.manifest import curated_folder, manifest, not_yet, of_entities
from ledgerline.operators.merge import merged
from ledgerline.plans.run import curate, extract
from ledgerline.sources.commits import read_table
from ledgerline.sources.filings import read_index_lines, read_lines, read_long_lines, scan_files
from ledgerline.sources.listing import filings_in, list_files
from ledgerline.sources.sinks import export_merged, write_merged
from ledgerline.sources.tables import read_entities, read_index, read_list_a, read_list_b, read_master

TEXTS = {
    "rawdata_2001_QTR1/12_2001-02-03_7.txt": b"<SEC-HEADER>\r\nCITY: X\r\n</SEC-HEADER>\rAPPLE INC   COM  037833100   5   7 \n\nend",
    "rawdata_2001_QTR1/13_2001-03-03_8.txt": b"one\n\n",
    "rawdata_2001_QTR2/12_2001-05-03_9.txt": b"",
    "rawdata_2001_QTR2/14_2001-05-04_1.txt": b"bad \xff byte\nAPPLE INC   PUT  037833100   12   34 PUT\n",
    "rawdata_2001_QTR2/notes.md": b"not a filing",
}
LINES = {
    "rawdata_2001_QTR1/12_2001-02-03_7": ["<SEC-HEADER>", "CITY: X", "</SEC-HEADER>", "APPLE INC   COM  037833100   5   7 ", "", "end"],
    "rawdata_2001_QTR1/13_2001-03-03_8": ["one", ""],
    "rawdata_2001_QTR2/14_2001-05-04_1": ["bad  byte", "APPLE INC   PUT  037833100   12   34 PUT"],
}


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    root = tmp_path_factory.mktemp("archive")
    for name, text in TEXTS.items():
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_bytes(text)
    return root


def as_dict(lines):
    out = {}
    for row in lines.orderBy("file_id", "line_no").collect():
        assert row["line_no"] == len(out.setdefault(row["file_id"], []))
        out[row["file_id"]].append(row["line"])
    return out


@pytest.mark.parametrize("whole_bytes", [10**6, 30, 0])
def test_lines_are_the_same_whole_or_in_blocks(spark, archive, whole_bytes):
    got = as_dict(read_lines(spark, f"{archive}/*/*.txt", whole_bytes))
    assert {name: got.get(name) for name in LINES} == LINES
    # An empty file has no line when read in blocks; read whole it has none either.
    assert set(got) == set(LINES)


def test_blocks_of_one_file_are_numbered_through(spark, tmp_path):
    text = [f"line {i} " + "x" * (i % 50) for i in range(5000)]
    (tmp_path / "1_2001-01-01_1.txt").write_text("\n".join(text) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        long = read_long_lines(spark, f"{tmp_path}/*.txt", 100)
        assert as_dict(long) == {"1_2001-01-01_1": text}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sizes_choose_files_in_the_listing(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.txt").write_text("x" * 100 * (i + 1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50")
    try:
        some = spark.read.text(f"{tmp_path}/*.txt", wholetext=True).filter(F.col("_metadata.file_size") > 400)
        assert some.count() == 2
        assert some._jdf.queryExecution().toRdd().getNumPartitions() == 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_manifest(spark, archive):
    # File scans leave out files without content.
    files = manifest(scan_files(spark, str(archive)))
    rows = {r["filename"]: (r["cik"], r["year"], r["qtr"], r["size"]) for r in files.collect()}
    assert rows == {
        name.split("/")[1]: (name.split("/")[1].split("_")[0], "2001", name.split("/")[0][-4:], len(text))
        for name, text in TEXTS.items() if name.endswith(".txt") and text
    }
    mine = of_entities(files, spark.createDataFrame([("12",)], "cik string"))
    assert {r["filename"] for r in mine.collect()} == {"12_2001-02-03_7.txt"}
    moved = curated_folder(mine, "rawdata", "curated").first()
    assert moved["curated_path"] == moved["path"].replace("rawdata", "curated", 1)
    left = not_yet(files, mine, "filename")
    assert left.count() == 2


def test_scan_reads_no_content(spark, archive):
    plan = scan_files(spark, str(archive))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_reference_tables(spark, tmp_path):
    (tmp_path / "master.csv").write_text("X,ISSUER_NUM,CUSIP8,ISSUE_CHECK\n1,037833,03783310,0\n2,001055,00105510,\n")
    (tmp_path / "a.csv").write_text("CUSIP,NCUSIP\n00123456,0012345X\n")
    (tmp_path / "b.csv").write_text("CUSIP\n93114210\n")
    (tmp_path / "e.csv").write_text('ReportedCIK,WRDS_CIK,CIK_May16\n0012,12,\n"0013",13,014\n')
    master = read_master(spark, f"{tmp_path}/master.csv")
    a, b = read_list_a(spark, f"{tmp_path}/a.csv"), read_list_b(spark, f"{tmp_path}/b.csv")
    full = security_dictionary(master, a, b)
    assert {r["key"] for r in full.collect()} == {
        "037833100", "037833", "37833", "3783310", "37833100", "00105510", "001055", "1055", "105510",
        "00123456", "123456", "0012345X", "12345X", "93114210",
    }
    strict = security_dictionary(master, a, b, spellings=("full",))
    assert {r["key"] for r in strict.collect()} == {"037833100", "00105510"}
    assert {r["key"] for r in lookup_keys(full).collect()} == {
        "037833", "37833", "3783310", "37833100", "001055", "1055", "105510", "00123456", "123456",
        "0012345X", "12345X", "93114210",
    }
    assert {r["cik"] for r in entity_ids(read_entities(spark, f"{tmp_path}/e.csv")).collect()} == {"12", "13", "14", ""}


def test_rules(spark, tmp_path):
    (tmp_path / "rules.csv").write_text('Type,Pattern\nSkipL,"SEC|""x"",y"\nMine,"(?P<a>b)"\n')
    rules = load_rules(spark, f"{tmp_path}/rules.csv")
    assert rules["SkipL"] == 'SEC|"x",y' and rules["Mine"] == "(?P<a>b)" and rules["CUSIP"] == RULES["CUSIP"]


def test_index(spark, tmp_path):
    for quarter, name in ((1, "A CO"), (2, "B|CO")):
        folder = tmp_path / "year=2001" / f"quarter={quarter}"
        folder.mkdir(parents=True)
        (folder / "master.idx").write_bytes(
            b"Description: a | b\n\nCIK|Company Name|Form Type|Date Filed|Filename\n-----\n"
            + f"1|{name} |13F-HR| 2001-01-01|edgar/data/1/0000000001-01-000002.txt\n".encode()
            + b"2|\xffBAD|10-K|2001-01-02|x-0.txt\n")
    index = parse_index(read_index_lines(spark, str(tmp_path)))
    rows = {(r["quarter"], r["cik"]): (r["company"], r["form_type"], r["filename"]) for r in index.collect()}
    assert rows[1, "1"] == ("A CO", "13F-HR", "edgar/data/1/0000000001-01-000002.txt")
    assert rows[2, "1"] == ("B", "CO", "2001-01-01")
    assert rows[1, "2"] == ("BAD", "10-K", "x-0.txt") and len(rows) == 4
    pruned = in_periods(index, [2001], [2])
    assert pruned.count() == 2
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().executedPlan().toString() or (
        "quarter" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0])
    (tmp_path / "clean.csv").write_text("CIK,Company Name,Form Type,Date Filed,Filename\n1,\"A, CO\",10-K,2001-01-01,f\n")
    assert read_index(spark, f"{tmp_path}/clean.csv").first()["company"] == "A, CO"


def test_file_key(spark):
    files = spark.createDataFrame([("1_2001-01-01_a.b",), ("no_key",), ("a_b_c_d",), ("rawdata_2001_QTR1/1_2001-01-01_a.b",)], "file_id string")
    assert [tuple(r) for r in file_key(files).collect()] == [
        ("1_2001-01-01_a.b", "1", "2001-01-01", "a.b"), ("rawdata_2001_QTR1/1_2001-01-01_a.b", "1", "2001-01-01", "a.b")]


def test_identities(spark):
    rows = [(2001, 1, "0001", "2001-01-02", f"edgar/data/1/{name}.txt") for name in ("0001234567-01-000012", "0007654321-01-000012", "0001234567-01-000013")]
    rows.append((2001, 2, "1", "2001-01-02", "edgar/data/1/0001234567-01-000012.txt"))
    index = spark.createDataFrame(rows, "year int, quarter int, cik string, date_filed string, filename string")
    got = {(r["accession"], r["file_id"], r["n_same"]) for r in identities(index).collect()}
    assert got == {
        ("0001234567-01-000012", "rawdata_2001_QTR1/1_2001-01-02_12", 2), ("0007654321-01-000012", "rawdata_2001_QTR1/1_2001-01-02_12", 2),
        ("0001234567-01-000013", "rawdata_2001_QTR1/1_2001-01-02_13", 1), ("0001234567-01-000012", "rawdata_2001_QTR2/1_2001-01-02_12", 1),
    }


def test_written_tables(spark, archive, tmp_path):
    lines = read_lines(spark, f"{archive}/*/*.txt")
    keys = spark.createDataFrame([("037833",)], "key string")
    stock = merged(holdings(eligible_rows(lines, keys)))
    write_merged(stock, str(tmp_path / "out"))
    read = spark.read.parquet(str(tmp_path / "out/stock"))
    assert {(r["filename"], r["year"], r["quarter"]) for r in read.collect()} == {
        ("rawdata_2001_QTR1/12_2001-02-03_7", 2001, 1), ("rawdata_2001_QTR2/14_2001-05-04_1", 2001, 2)}
    assert spark.read.parquet(str(tmp_path / "out/option_def")).count() == 1
    export_merged(stock, str(tmp_path / "csv"))
    text = spark.read.text(str(tmp_path / "csv/OptionFile")).collect()
    assert [r["value"] for r in text] == [
        "Filename,CIK,Date,Poss_hit,Name,Type,CUSIP,Value,Shares,Opt,Extra,FlagR",
        "14_2001-05-04_1,14,2001-05-04,True,APPLE INC,PUT,037833100,12,34,PUT,PUT,Likely true positive",
    ]


def test_whole_run(spark, archive, tmp_path):
    keys = spark.createDataFrame([("037833",)], "key string")
    for _ in range(2):
        extract(read_lines(spark, f"{archive}/*/*.txt"), keys, str(tmp_path / "run"))
    counts = {
        name: spark.read.parquet(str(tmp_path / "run" / name)).count()
        for name in ("eligible", "remainder", "holdings", "layouts", "headers", "option_audit", "stock", "option", "option_def")
    }
    assert counts == {"eligible": 2, "remainder": 8, "holdings": 2, "layouts": 3, "headers": 3,
                      "option_audit": 2, "stock": 2, "option": 1, "option_def": 1}


def test_curated_archive_grows_once(spark, archive, tmp_path):
    lines = read_lines(spark, f"{archive}/*/*.txt")
    target = str(tmp_path / "curated")
    for ciks, n_files in ((["12"], 1), (["12"], 1), (["12", "13"], 2)):
        curate(lines, spark.createDataFrame([(cik,) for cik in ciks], "cik string"), target)
        kept = spark.read.parquet(target)
        assert kept.select("file_id").distinct().count() == n_files
        assert as_dict(kept) == {name: text for name, text in LINES.items() if name.split("/")[1].split("_")[0] in ciks}


def test_files_without_content(spark, archive, tmp_path):
    found = list_files(spark, str(archive))
    assert {(r["path"].removeprefix(f"{archive}/"), r["size"]) for r in found.collect()} == {(name, len(text)) for name, text in TEXTS.items()}
    rows = {r["filename"]: (r["cik"], r["year"], r["qtr"], r["size"]) for r in manifest(found).collect()}
    assert rows["12_2001-05-03_9.txt"] == ("12", "2001", "QTR2", 0) and len(rows) == 4
    filings = filings_in(found)
    assert {tuple(r) for r in filings.collect()} == {(name[:-4], 1, len(text)) for name, text in TEXTS.items() if name.endswith(".txt")}
    folder = str(tmp_path / "run")
    for _ in range(2):
        extract(read_lines(spark, f"{archive}/*/*.txt"), spark.createDataFrame([("037833",)], "key string"), folder, files=filings)
    headers = {r["file"]: r for r in read_table(spark, folder, "headers").collect()}
    assert len(headers) == 4 and headers["rawdata_2001_QTR2/12_2001-05-03_9"]["cik"] == "12" and headers["rawdata_2001_QTR2/12_2001-05-03_9"]["city"] == ""
    assert read_table(spark, folder, "layouts").count() == 4 and read_table(spark, folder, "remainder").count() == 8


def test_files_of_one_key(spark, tmp_path):
    for root in ("a", "b"):
        (tmp_path / root / "rawdata_2001_QTR1").mkdir(parents=True)
        (tmp_path / root / "rawdata_2001_QTR1/1_2001-01-01_1.txt").write_text(root)
    (tmp_path / "2_2001-01-01_1.txt").write_text("")
    got = {tuple(r) for r in filings_in(list_files(spark, str(tmp_path))).collect()}
    assert got == {("rawdata_2001_QTR1/1_2001-01-01_1", 2, 2), ("2_2001-01-01_1", 1, 0)}
    assert filings_in(list_files(spark, f"file://{tmp_path}")).count() == 2
