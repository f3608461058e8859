"""Every operator as a query over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.keys import file_key, identities, local_key
from ledgerline.functions.rules import RULES
from ledgerline.operators import dictionary as dic
from ledgerline.operators import eligible as eli
from ledgerline.operators import header as hdr
from ledgerline.operators import index as idx
from ledgerline.operators import layout as lay
from ledgerline.operators import manifest as man
from ledgerline.operators import merge as mrg
from ledgerline.operators.holdings import holdings
from ledgerline.plans.corpus import Corpus, corpus
from ledgerline.sources.commits import read_table
from ledgerline.sources.filings import lines_of, read_index_lines
from ledgerline.sources.landing import fresh_path, land
from ledgerline.sources.tables import read_list_a, read_list_b, read_master
from ledgerline.streaming.arrivals import ingest, lines_of_texts

PERIOD_YEARS, PERIOD_QUARTERS = range(1996, 1999), (1, 2)
PUBLISHED = ["eligible", "remainder", "layouts", "holdings", "option_audit", "stock", "option", "option_def", "headers"]
SCORED = ["name", "type", "cusip", "value", "shares"]
SCORE_RULES = [RULES["CUSIP"], RULES["Shprn"], RULES["Anyopt"], r"\d\d", r"[a-z] [a-z]"]


def _eligible(c: Corpus) -> DataFrame:
    return eli.eligible_rows(c.lines(), c.keys())


def _holdings(c: Corpus) -> DataFrame:
    return holdings(_eligible(c))


def _layout(name: str):
    return lambda c: _holdings(c).filter(F.col("layout") == name).drop("layout")


def _stock(c: Corpus) -> DataFrame:
    return mrg.merged(_holdings(c))


def _headers(c: Corpus) -> DataFrame:
    return hdr.header_fields(c.filings(), c.lines())


def _positions(c: Corpus) -> DataFrame:
    return lay.cut_positions(lay.split_on_id(_eligible(c)))


def _documents(c: Corpus) -> DataFrame:
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))
    return c.table("documents").select(name.alias("file_id"), "text")


def _document_lines(c: Corpus) -> DataFrame:
    return lines_of(_documents(c), "file_id", "text")


def _remainder(c: Corpus, lines: DataFrame) -> DataFrame:
    return eli.remainder_lines(lines, eli.eligible_rows(lines, c.keys()))


def filing_lines(c):
    return lines_of(c.table("documents"), "doc_id", "text").select(
        "doc_id", "line_no", eli.strip_right(F.col("line")).alias("line")
    )


def skip_lines(c):
    return c.lines().filter(eli.is_skipped(F.col("line"))).select("file_id", "line_no", "line")


def _covered(c: Corpus, lines: DataFrame) -> DataFrame:
    """The places of accepted lines are landed: they are counted, and what remains follows from them."""
    eligible = land(eli.eligible_rows(lines, c.keys()).select("file_id", "chunk", "line_no"), "accepted_lines")
    return eli.coverage(lines, eligible, eli.remainder_lines(lines, eligible))


def coverage_check(c):
    return _covered(c, c.lines())


def noise_coverage(c):
    return _covered(c, _document_lines(c))


def split_on_id(c):
    return lay.split_on_id(_eligible(c)).filter(F.col("before").isNotNull()).select(
        "file_id", "line_no", "before", "after"
    )


def modal_split(c):
    return lay.profile(_positions(c)).select("file_id", "tab_cut", "name_cut", "value_cut")


def layout_vote(c):
    return lay.profile(_positions(c)).select(
        "file_id", "n_lines", "n_tab", "n_csv", "n_html", "n_garbage", "layout"
    )


def layout_profile(c):
    return lay.full_profile(c.filings(), lay.profile(_positions(c)))


def frequent_splits(c):
    positions = _positions(c)
    return lay.frequent_splits(positions, lay.profile(positions))


def sentinel_skip(c):
    return _holdings(c).groupBy("layout", "poss_hit").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(mrg.lacks_values()).alias("n_dropped")
    )


def _whole(name):
    """A number as its SQL has it, a bigint: null, not cut, where it is none."""
    return F.when(F.col(name) == F.floor(name), F.col(name).try_cast("bigint")).alias(name)


def header_totals(c):
    totals = [hdr.column_of(total) for total in hdr.TOTAL_RULES]
    numbers = [_whole(name + "_num") for name in totals]
    return hdr.typed_headers(_headers(c)).select("file", *totals, *numbers)


def totals_reconciled(c):
    table = hdr.reconciled(_headers(c), _stock(c)).drop("n_unparsed")
    numbers = ("n_reported", "value_reported", "value_found")
    return table.withColumns({name: _whole(name) for name in numbers})


def holdings_with_header(c):
    """Only what the join shows is landed."""
    headers = _headers(c).select("file", "accession_number", "company_conformed_name", "conformed_period_of_report")
    stock = _stock(c).select("filename", "line_no", "name", "cusip", "value", "shares", "opt", "flagr")
    return hdr.with_header(land(headers, "headers"), land(stock, "stock"))


def _index_of(c):
    return c.index().select("year", "quarter", *idx.INDEX_COLUMNS)


def index_period_prune(c):
    chosen = idx.in_periods(c.index(), PERIOD_YEARS, PERIOD_QUARTERS)
    return chosen.groupBy("year", "quarter").agg(F.count(F.lit(1)).alias("n_filings"))


def filing_select_ids(c):
    raw = F.explode(F.array("reportedcik", "wrds_cik", "cik_may16"))
    return idx.select_filings(_index_of(c), c.entities().select(raw.alias("cik")))


def _manifest(c):
    folder = F.concat(F.lit("/archive/rawdata_"), F.col("year").cast("string"), F.lit("_QTR"),
                      F.col("quarter").cast("string"))
    files = c.lines().groupBy("file_id", "year", "quarter").agg(
        F.sum(F.octet_length("line") + 1).alias("size")
    )
    path = F.concat(folder, F.lit("/"), "file_id", F.lit(".txt"))
    return man.manifest(files.select(path.alias("path"), "size"))


def manifest_subset(c):
    return man.of_entities(_manifest(c), dic.entity_ids(c.entities()))


def curated_paths(c):
    return man.curated_folder(manifest_subset(c), "/archive/rawdata", "/curated/rawdata").select(
        "cik", "filename", "path", "curated_path"
    )


def incremental_skip(c):
    done = _holdings(c).select("file_id").distinct()
    return man.not_yet(c.filings().select("file_id", "cik", "filed_on"), done)


def stream_ingest(c):
    spark = c.spark
    texts = (
        spark.readStream.schema(c.table("documents").schema).parquet(f"{c.folder}/documents.parquet*")
        .select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("file_id"), "text")
    )
    target = fresh_path(spark, "arrived")
    ingest(texts, lambda batch: _remainder(c, lines_of_texts(batch)), target,
           fresh_path(spark, "arrived-state"))
    return spark.read.parquet(target).select("file_id", "line_no", "line")


def _published(folder: str, c: Corpus, name: str) -> DataFrame:
    return read_table(c.spark, folder, name).drop("commit", "year", "quarter")


def published_rerun(c):
    """How many rows each published table has of each filing."""
    keys = {"headers": "file", "stock": "filename", "option": "filename", "option_def": "filename"}
    counted = [
        _published(c.published(), c, name).groupBy(F.col(keys.get(name, "file_id")).alias("file_id"))
        .agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "file_id", "n_rows")
        for name in PUBLISHED
    ]
    return reduce(DataFrame.unionByName, counted)


def reference_tables(c):
    folder = c.reference_files()
    return dic.security_dictionary(
        read_master(c.spark, f"{folder}/master"), read_list_a(c.spark, f"{folder}/a"), read_list_b(c.spark, f"{folder}/b"))


OPERATORS: dict[str, Callable[[Corpus], DataFrame]] = {
    "filing_lines": filing_lines,
    "file_key": lambda c: file_key(c.filings()),
    "skip_lines": skip_lines,
    "security_dictionary": lambda c: c.dictionary(),
    "lookup_keys": lambda c: dic.lookup_keys(c.dictionary()),
    "entity_ids": lambda c: dic.entity_ids(c.entities()),
    "eligible_rows": lambda c: _eligible(c).drop("chunk"),
    "remainder_lines": lambda c: _remainder(c, c.lines()),
    "coverage_check": coverage_check,
    "noise_coverage": noise_coverage,
    "share_tag": lambda c: _eligible(c).select("file_id", "line_no", "cusip", "shprn"),
    "split_on_id": split_on_id,
    "modal_split": modal_split,
    "layout_vote": layout_vote,
    "layout_profile": layout_profile,
    "frequent_splits": frequent_splits,
    "layout_tab": _layout("tab"),
    "layout_csv": _layout("csv"),
    "layout_fixed": _layout("fixed"),
    "holdings_all": _holdings,
    "option_token": lambda c: _holdings(c).select("file_id", "line_no", "poss_hit", "opt"),
    "quality_flag": lambda c: _stock(c).select("filename", "line_no", "flagr"),
    "sentinel_skip": sentinel_skip,
    "merged_stock": _stock,
    "merged_option": lambda c: mrg.option_candidates(_stock(c)),
    "merged_option_def": lambda c: mrg.definite_options(_stock(c)),
    "merged_typed": lambda c: mrg.typed(_stock(c)).select(
        "filename", "line_no", _whole("value_num"), _whole("shares_num"), "filed_on"),
    "merged_as_written": lambda c: mrg.as_written(_stock(c)),
    "option_audit": lambda c: (lambda e: mrg.option_audit(e, holdings(e)))(_eligible(c)),
    "header_region": lambda c: hdr.header_region(c.lines()).select("file_id", "line_no", "in_header"),
    "table_region": lambda c: hdr.table_region(c.lines()).select("file_id", "line_no", "in_table"),
    "header_fields": _headers,
    "header_totals": header_totals,
    "holdings_with_header": holdings_with_header,
    "totals_reconciled": totals_reconciled,
    "index_parse": lambda c: idx.parse_index(c.index_lines()),
    "index_period_prune": index_period_prune,
    "index_by_form": lambda c: idx.by_form(_index_of(c)),
    "index_by_filer": lambda c: idx.by_filer(_index_of(c)),
    "filing_select": lambda c: idx.select_filings(_index_of(c)),
    "filing_select_ids": filing_select_ids,
    "filing_select_all": lambda c: idx.select_filings(_index_of(c), form_types=None),
    "filing_local_key": lambda c: local_key(_index_of(c)),
    "file_manifest": _manifest,
    "manifest_subset": manifest_subset,
    "curated_paths": curated_paths,
    "incremental_skip": incremental_skip,
    "row_pattern_score": lambda c: mrg.pattern_score(_holdings(c), SCORED, SCORE_RULES).select(
        "file_id", "line_no", "hits", "passes"),
    "stream_ingest": stream_ingest,
    "filing_identity": lambda c: identities(_index_of(c)),
    "published_incremental": lambda c: _published(c.published(), c, "holdings"),
    "published_rerun": published_rerun,
    "stream_published": lambda c: _published(c.streamed(), c, "holdings"),
    "stream_headers": lambda c: _published(c.streamed(), c, "headers"),
    "curated_archive": lambda c: _published(c.curated(), c, ""),
    "index_files": lambda c: idx.parse_index(read_index_lines(c.spark, c.index_files())),
    "reference_tables": reference_tables,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_tables(operator):
        return lambda spark, folder: operator(corpus(spark, folder))
    return {name: over_tables(operator) for name, operator in OPERATORS.items()}
