"""The filing corpus that a set of star-schema tables stands for.

One filing per order, one holdings line per line item, one security per part. The layout of a
filing follows from its order key, and the spelling of an identifier from part and supplier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerline.operators.chunks import CHUNK_LINES, number_sorted
from ledgerline.operators.dictionary import entity_ids, lookup_keys, security_dictionary
from ledgerline.operators.index import parse_index
from ledgerline.plans.run import curate, extract
from ledgerline.sources.landing import fits, fresh_path, land, land_more
from ledgerline.sources.sinks import write_csv
from ledgerline.streaming.arrivals import arriving_bundles, publish

LINE = ["file_id", "line_no", "line"]
# Parts that are broadcast with their names; some 100 bytes each.
BROADCAST_PARTS = 1_500_000
# Between the first and the last year of filings.
MIDDLE_YEAR = 1995


class Corpus:
    """Tables of the corpus; the big ones are landed once per application and reused."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._landed: dict[str, DataFrame] = {}
        self._folders: dict[str, str] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _once(self, name: str, build, partition_by=()) -> DataFrame:
        if name not in self._landed:
            self._landed[name] = land(build(), name, partition_by)
        return self._landed[name]

    def _orders(self) -> DataFrame:
        """(k, number, filed, name): what a filing is told from, without the texts made of it."""
        return (
            self.table("orders").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("k"), F.col("c_custkey").alias("number"), F.to_date("o_orderdate").alias("filed"), F.col("c_name").alias("name"))
        )

    @staticmethod
    def _described() -> dict[str, Column]:
        """The columns of a filing, over those of ``_orders``."""
        cik = (F.col("number") + 1).cast("string")
        filed, number = F.col("filed"), (F.col("k") + 1).cast("string")
        forms = F.array(*[F.lit(form) for form in ("13F-HR", "13F-HR/A", "13F-NT", "10-K")])
        return {
            "file_id": F.concat_ws("_", cik, filed.cast("string"), number),
            "cik": cik,
            "filed_on": filed.cast("string"),
            "year": F.year(filed),
            "quarter": F.quarter(filed),
            "company": F.upper("name"),
            "form_type": F.get(forms, (F.col("k") % 4).cast("int")),
            "accession": F.concat_ws("-", F.lpad(cik, 10, "0"), F.date_format(filed, "yy"), F.lpad(number, 6, "0")),
        }

    def filings(self) -> DataFrame:
        return self._orders().select("k", *[column.alias(name) for name, column in self._described().items()])

    def securities(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("p"), *[column.alias(name) for name, column in self._identifier("p_partkey").items()], F.upper("p_name").alias("nm")
        )

    @staticmethod
    def _identifier(key: str) -> dict[str, Column]:
        """Identifier, check digit and issuer of the part with a key."""
        part = F.col(key)
        digits = F.lpad((part * 1009 + 1000007).cast("string"), 8, "0")
        id8 = F.when(part % 13 == 0, F.concat(F.substring(digits, 1, 7), F.lit("K"))).otherwise(digits)
        return {"id8": id8, "chk": (part % 10).cast("string"), "issuer": F.substring(digits, 1, 6)}

    def _holdings(self) -> DataFrame:
        """The line items with the name of their part, numbered from 1 (``rn``) in each filing: numbers and a name, no text made of them.

        The few filings longer than a chunk are numbered in ranges of their order. Names that are too many to
        broadcast come to the items first, all of a part in one row, so that items are dealt by part and then by
        filing, once each; items without a part are numbered with the others and go after that.
        """
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_shipdate", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
        items = self.table("lineitem").select("l_orderkey", *order)
        parts = self.securities().select("p", "nm")
        small = fits(parts, BROADCAST_PARTS)
        long = land(
            items.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CHUNK_LINES).select("l_orderkey"), "long_filings"
        )
        if not small:
            named = parts.groupBy("p").agg(F.collect_list(F.struct("nm")).alias("names"))
            items = items.join(named, F.col("l_partkey") == F.col("p"), "left").drop("p")
        usual = items
        if not long.isEmpty():
            usual = items.join(long, "l_orderkey", "left_anti")
        in_filing = Window.partitionBy("l_orderkey").orderBy(*order)
        numbered = usual.withColumn("rn", F.row_number().over(in_filing))
        if not long.isEmpty():
            numbered = numbered.unionByName(number_sorted(items.join(long, "l_orderkey", "left_semi"), "l_orderkey", order, "rn", land))
        told = [F.col("l_orderkey").alias("k"), F.col("rn").cast("int").alias("rn"), "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag"]
        if small:
            return numbered.select(*told).join(F.broadcast(parts), F.col("l_partkey") == F.col("p")).drop("p")
        return numbered.select(*told, F.inline("names"))

    def holding_lines(self) -> DataFrame:
        """(k, rn, val, line): the holdings lines of every filing, numbered from 1."""
        return self._written(self._holdings(), "k", "rn", "val")

    def _written(self, holdings: DataFrame, *columns: str) -> DataFrame:
        """The given columns of ``_holdings``, joined to others or not, and the line."""
        return holdings.withColumns(self._identifier("l_partkey")).withColumns({
            "pid": self._printed_id(),
            "val": F.floor("l_extendedprice").cast("bigint").cast("string"),
            "shr": F.col("l_quantity").cast("bigint").cast("string"),
            "opt": self._option_words(),
            "odd": F.col("l_partkey") % 8,
        }).select(*columns, self._line().alias("line"))

    @staticmethod
    def _printed_id():
        spelling = (F.col("l_partkey") + F.col("l_suppkey")) % 6
        dashed = F.concat_ws("-", F.substring("id8", 1, 6), F.substring("id8", 7, 2), "chk")
        return (
            F.when(spelling == 3, dashed)
            .when(spelling == 4, F.concat(F.lower("id8"), "chk"))
            .when(spelling == 5, F.col("id8"))
            .otherwise(F.concat("id8", "chk"))
        )

    @staticmethod
    def _option_words():
        rest = F.col("l_suppkey") % 4
        return (
            F.when((F.col("l_returnflag") == "R") & (rest == 0), " CALL")
            .when((F.col("l_returnflag") == "A") & (rest == 1), " PUT")
            .when(rest == 2, " CL A")
            .otherwise("")
        )

    @staticmethod
    def _line():
        tabbed = F.concat(F.concat_ws("\t", "nm", F.lit("COM"), "pid", "val", "shr", F.lit("SH")), "opt")
        # Comma lines have every way an option candidate can look: a name too long, no value, the identifier as value.
        odd = F.col("odd")
        name = F.concat("nm", F.when(odd == 0, "INTERNATIONALHOLDINGSCORPORATION").otherwise(""))
        value = F.when(odd == 1, "").when(odd == 2, F.col("pid")).otherwise(F.col("val"))
        commas = F.concat(F.lit('"'), name, F.lit(', INC",'), "pid", F.lit(","), value, F.lit(","),
                          "shr", F.lit(",SH,SOLE"), "opt")
        short = F.concat("pid", F.lit(" "), F.substring("shr", 1, 2))
        width = F.greatest(F.length("nm"), F.lit(20)) + F.when(F.length("nm") < 20, 0).otherwise(2)
        padded = F.rpad("nm", width, F.lit(" "))
        columns = F.concat(padded, F.lit("COM   "), "pid", F.lit("   "), "val", F.lit("   "),
                           "shr", F.lit(" SH SOLE"), "opt")
        seed = F.col("k") % 5
        # Some filings hold a page: its mark is on the first line.
        page = F.when((F.col("k") % 7 == 0) & (seed == 2) & (F.col("rn") == 1), "<html>").otherwise("")
        return F.when(seed == 0, tabbed).when(seed == 1, commas).when(seed == 4, short).otherwise(F.concat(columns, page))

    def lines(self) -> DataFrame:
        """``lines(file_id, line_no, line, year, quarter)`` of the whole corpus, landed."""
        if "lines" not in self._landed:
            self._landed["lines"] = self._landed_lines()
        return self._landed["lines"]

    def _body(self) -> DataFrame:
        """The holdings lines with the key, the value and, of filings under one key, a mark for the one that counts for all.

        Only numbers, dates and names are shuffled; the texts are made after that.
        """
        about, key = self._described(), ["file_id", "year", "quarter"]
        one = F.row_number().over(Window.partitionBy("k").orderBy("number", "filed", "name")) == 1
        filings = self._orders().withColumn("counted", one).withColumns({name: about[name] for name in key}).select("k", "counted", *key)
        return self._written(
            self._holdings().join(filings, "k"), "k", "counted", *key, (F.col("rn") + 12).alias("line_no"),
            F.floor("l_extendedprice").cast("bigint").alias("val"),
        )

    def _landed_lines(self) -> DataFrame:
        """Holdings lines and the lines around them, landed into one folder.

        The totals of a filing are read off its landed holdings lines. Nothing is dealt by period: each task writes its own files.
        """
        period, about, body = ("year", "quarter"), self._described(), self._body()
        path = fresh_path(self.spark, "lines")
        land_more(body.select(*LINE, "k", "counted", "val", *period), path, period)
        totals = (
            self.spark.read.schema(body.schema).parquet(path).filter("counted").groupBy("k")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("val").alias("total"))
        )
        each = self._orders().join(totals, "k", "left").withColumns(about)
        return land_more(self._around(each), path, period)

    @staticmethod
    def _around(filings: DataFrame) -> DataFrame:
        """The lines before and after a filing's holdings; filings have ``n`` and ``total`` of these."""
        tab = F.lit("\t")
        n, total = F.col("n"), F.col("total")
        frame = [
            (0, F.concat(F.lit("<SEC-HEADER>"), "accession", F.lit(".hdr"))),
            (1, F.concat(F.lit("ACCESSION NUMBER:"), tab, "accession")),
            (2, F.concat(F.lit("CONFORMED SUBMISSION TYPE:"), tab, "form_type")),
            (3, F.concat(F.lit("CONFORMED PERIOD OF REPORT:"), tab,
                         F.replace("filed_on", F.lit("-"), F.lit("")))),
            (4, F.concat(tab, tab, F.lit("COMPANY CONFORMED NAME:"), tab, "company")),
            (5, F.concat(tab, tab, F.lit("STREET 1:"), tab, "cik", F.lit(" MAIN"))),
            (6, F.concat(tab, tab, F.lit("STREET 1:"), tab, F.lit("BOX "), "cik")),
            (7, F.lit("</SEC-HEADER>")),
            (8, F.lit("STREET 1: outside the header")),
            (9, F.concat(F.lit("Number of Other Included Managers: "), (F.col("k") % 3).cast("string"))),
            (10, F.concat(F.lit("Form 13F Information Table Entry Total:  "), n.cast("string"))),
            (11, F.concat(F.lit("Form 13F Information Table Value Total: $ "),
                          F.floor(total / 1000).cast("string"), F.lit(","),
                          F.lpad((total % 1000).cast("string"), 3, "0"))),
            (12, F.lit("<TABLE>")),
            (F.coalesce(n, F.lit(0)).cast("int") + 13, F.lit("</TABLE>")),
        ]
        return filings.select("file_id", "year", "quarter", F.inline(F.array(*[
            F.struct((F.lit(at) if isinstance(at, int) else at).alias("line_no"), text.alias("line"))
            for at, text in frame
        ]))).filter(F.col("line").isNotNull()).select(*LINE, "year", "quarter")

    def master(self) -> DataFrame:
        return self.securities().filter(F.col("p") % 7 != 0).select(
            F.col("id8").alias("cusip8"), F.col("chk").alias("issue_check"), F.col("issuer").alias("issuer_num")
        )

    def list_a(self) -> DataFrame:
        return self.securities().filter((F.col("p") % 7).isin(1, 2)).select(
            F.col("id8").alias("cusip"), F.concat(F.substring("id8", 1, 7), F.lit("9")).alias("ncusip")
        )

    def list_b(self) -> DataFrame:
        return self.securities().filter(F.col("p") % 7 == 3).select(F.col("id8").alias("cusip"))

    def dictionary(self) -> DataFrame:
        return security_dictionary(self.master(), self.list_a(), self.list_b())

    def keys(self) -> DataFrame:
        return self._once("keys", lambda: lookup_keys(self.dictionary()))

    def entities(self) -> DataFrame:
        number = F.col("c_custkey")
        return self.table("customer").filter(F.col("c_nationkey") < 5).select(
            F.lpad((number + 1).cast("string"), 10, "0").alias("reportedcik"),
            (number + 1).cast("string").alias("wrds_cik"),
            F.when(number % 2 == 0, F.lpad((number + 2).cast("string"), 7, "0")).otherwise("").alias("cik_may16"),
        )

    def index_lines(self) -> DataFrame:
        """``(year, quarter, line)`` of the quarterly index texts, preamble included."""
        row = F.concat("cik", F.lit("|"), "company", F.lit(" |"), "form_type", F.lit("| "), "filed_on",
                       F.lit("|edgar/data/"), "cik", F.lit("/"), "accession", F.lit(".txt"))
        preamble = F.array(
            F.lit("Description: Master Index | of filings"),
            F.lit("CIK|Company Name|Form Type|Date Filed|Filename"),
            F.lit("-" * 41),
        )
        filings = self.filings()
        heads = filings.select("year", "quarter").distinct().select(
            "year", "quarter", F.explode(preamble).alias("line")
        )
        return filings.select("year", "quarter", row.alias("line")).unionByName(heads)

    def index(self) -> DataFrame:
        """The parsed index, landed by period."""
        return self._once("index", lambda: parse_index(self.index_lines()), ("year", "quarter"))

    def _work(self, name: str, build) -> str:
        """A folder that a piece of work fills, once per application."""
        if name not in self._folders:
            path = fresh_path(self.spark, name)
            build(path)
            self._folders[name] = path
        return self._folders[name]

    def published(self) -> str:
        """The tables that two runs publish, the second over all filings; then the second once more."""
        def build(folder):
            lines, keys = self.lines(), self.keys()
            extract(lines.filter(F.col("year") < MIDDLE_YEAR), keys, folder, commit="early")
            extract(lines, keys, folder, commit="all")
            extract(lines, keys, folder, commit="again")
        return self._work("published", build)

    def streamed(self) -> str:
        """The tables that a stream of bundles of filings publishes, three batches or so."""
        def build(folder):
            bundles, tasks = fresh_path(self.spark, "bundles"), int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            # A bundle holds whole filings, as a file does.
            self.lines().select("file_id", "line_no", "line").repartition(tasks, "file_id").write.parquet(bundles)
            arrivals = arriving_bundles(self.spark, bundles, maxFilesPerTrigger=tasks // 3 + 1)
            publish(arrivals, self.keys(), folder, fresh_path(self.spark, "published-state"), lambda batch: batch)
        return self._work("streamed", build)

    def curated(self) -> str:
        """The curated archive of the entities' filings, grown in two runs."""
        def build(folder):
            lines, entities = self.lines(), entity_ids(self.entities())
            curate(lines.filter(F.col("year") < MIDDLE_YEAR), entities, folder)
            curate(lines, entities, folder)
        return self._work("curated", build)

    def index_files(self) -> str:
        """The quarterly index texts as files, a folder a period."""
        def build(folder):
            self.index_lines().select(F.col("line").alias("value"), "year", "quarter").hint("rebalance", "year", "quarter").write.partitionBy("year", "quarter").text(folder)
        return self._work("index-files", build)

    def reference_files(self) -> str:
        """Security master and lists as CSV files with a heading."""
        def build(folder):
            for name, table in (("master", self.master()), ("a", self.list_a()), ("b", self.list_b())):
                write_csv(table.toDF(*[column.upper() for column in table.columns]), f"{folder}/{name}")
        return self._work("reference-files", build)


_CORPORA: dict[tuple[str, str], Corpus] = {}


def corpus(spark: SparkSession, folder: str) -> Corpus:
    """The corpus over a folder of tables, one per application and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _CORPORA:
        _CORPORA[key] = Corpus(spark, folder)
    return _CORPORA[key]
