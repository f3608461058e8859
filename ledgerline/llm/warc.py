"""Web archives: write records, normalise monolithic gzip files, read records back by offset.

``write`` has Spark's text writer make whole-file gzip streams of WARC records: one stream a file, in
which no record can be found without inflating all before it. ``normalise`` inflates each stream once,
piece by piece, and writes every record as a gzip member of its own, beside a sidecar index (a Parquet
table of file, offset, length and record headers). ``read`` fetches single members by the index.

Files go to a shared folder; a task that is repeated writes files of its own, and the index names only
those of the attempts that Spark accepted.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shipping import mapped
from ledgerline.sources.landing import fresh_path, land

#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
#: Bytes inflated at once.
PIECE = 1 << 20
#: Records in an archive file, at most.
FILE_RECORDS = 20_000

_END = b"\r\n\r\n"
_INDEX = "file string, offset long, length long, record_type string, record_id string, target string"
_RECORD = "record_type string, record_id string, target string, refers_to string, payload_digest string, payload_bytes long, payload string"


def records(pages: DataFrame) -> DataFrame:
    """One row per page: uid, page_id, url, html (null: empty), digest, n_bytes, record_type, refers_to, refers_uid.

    Of equal payloads of at least REVISIT_BYTES bytes the one with the largest page_id (null is smallest;
    repeated: any one) is the response, the others refer to it.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.monotonically_increasing_id().alias("uid"), F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), html.alias("html"))
    rows = land(rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("n_bytes", F.octet_length("html").cast("long")), "payloads")
    long = rows.where(F.col("n_bytes") >= REVISIT_BYTES)
    named = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "uid")
    firsts = long.groupBy("digest").agg(F.max(named).alias("first"), F.count("*").alias("c")).where("c > 1")
    revisits = long.join(firsts, "digest").where("uid <> first.uid").select("uid", F.col("first.page_id").alias("refers_to"), F.col("first.uid").alias("refers_uid"))
    joined = rows.join(land(revisits, "revisits"), "uid", "left")
    return joined.withColumn("record_type", F.when(F.col("refers_uid").isNull(), "response").otherwise("revisit"))


def _header_value(column):
    """A value as it may stand in a header line: percent signs and control characters escaped."""
    escaped = F.regexp_replace(column, "%", "%25")
    for code, text in (("\r", "%0D"), ("\n", "%0A")):
        escaped = F.replace(escaped, F.lit(code), F.lit(text))
    return escaped


def rendered(table: DataFrame):
    """The record as text, without its ending."""
    def urn(page: str, uid: str):
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(":"), F.col(uid).cast("string"), F.lit(">"))

    head = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"), F.concat(F.lit("WARC-Record-ID: "), urn("page_id", "uid")),
        F.concat(F.lit("WARC-Target-URI: "), _header_value(F.col("url"))), F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("n_bytes").cast("string")), F.concat(F.lit("WARC-Refers-To: "), urn("refers_to", "refers_uid")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(F.col("refers_uid").isNull(), F.col("n_bytes")).otherwise(0).cast("string")),
    ]
    body = F.when(F.col("refers_uid").isNull(), F.col("html")).otherwise("")
    return F.concat(F.concat_ws("\r\n", *head), F.lit("\r\n\r\n"), body)


def write(table: DataFrame, folder: str) -> None:
    """Archives of records(): each file one gzip stream."""
    lines = table.select(rendered(table).alias("value"))
    writer = lines.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", FILE_RECORDS)
    writer.text(folder)


def parsed(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of a stream of records; holds one record and one piece."""
    kept = bytearray()
    more = True

    def fill(n: int) -> bool:
        nonlocal more
        while more and len(kept) < n:
            piece = next(pieces, None)
            more = piece is not None
            kept.extend(piece or b"")
        return len(kept) >= n

    while fill(1):
        while (end := kept.find(_END)) < 0:
            if not fill(len(kept) + 1):
                raise ValueError("a record's headers do not end")
        head = headers(bytes(kept[:end]))
        size = end + 4 + int(head["Content-Length"]) + 4
        if not fill(size):
            raise ValueError("a record is cut off")
        yield head, bytes(kept[:size])
        del kept[:size]


def headers(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def inflated(raw: Iterator[bytes]) -> Iterator[bytes]:
    """The content of gzip members, in pieces."""
    state = zlib.decompressobj(31)
    for piece in raw:
        while piece:
            out = state.decompress(piece, PIECE)
            if out:
                yield out
            piece = state.unconsumed_tail
            if state.eof:
                piece, state = state.unused_data, zlib.decompressobj(31)


def deflated(record: bytes) -> bytes:
    state = zlib.compressobj(6, zlib.DEFLATED, 31)
    return state.compress(record) + state.flush()


def _pieces(content: bytes) -> Iterator[bytes]:
    for at in range(0, len(content), PIECE):
        yield content[at : at + PIECE]


def normalise(spark: SparkSession, archives: str, folder: str) -> DataFrame:
    """Write each archive anew, a member for each record, into ``folder``; returns the index.

    An archive is one task: gzip streams cannot be entered elsewhere. Its compressed bytes (bounded by
    FILE_RECORDS when written here) are held, its content only record by record.
    """
    files = spark.read.format("binaryFile").load(archives).select("content")

    def rewritten(batches):
        store = None
        for batch in batches:
            for content in batch.column(0):
                name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                store, path = fs.FileSystem.from_uri(name)
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                at, rows = 0, []
                with store.open_output_stream(path, compression=None) as out:
                    for head, record in parsed(inflated(_pieces(content.as_py()))):
                        member = deflated(record)
                        out.write(member)
                        rows.append((name, at, len(member), head["WARC-Type"], head["WARC-Record-ID"], head["WARC-Target-URI"]))
                        at += len(member)
                for start in range(0, len(rows), 10_000):
                    columns = list(zip(*rows[start : start + 10_000]))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["file", "offset", "length", "record_type", "record_id", "target"])

    return land(mapped(files, rewritten, _INDEX), "warc_index")


def read(index: DataFrame) -> DataFrame:
    """The records that an index names, fetched by offset: type, id, target, refers_to, digest, payload and its full length."""

    def fetched(batches):
        opened = {}
        for batch in batches:
            rows = []
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if file not in opened:
                    for other in opened.values():
                        other.close()
                    store, path = fs.FileSystem.from_uri(file)
                    opened = {file: store.open_input_file(path)}
                opened[file].seek(offset)
                head, record = next(parsed(inflated(iter([opened[file].read(length)]))))
                payload = record[len(record) - 4 - int(head["Content-Length"]) : -4]
                target = head["WARC-Target-URI"].replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
                rows.append((head["WARC-Type"], head["WARC-Record-ID"], target, head.get("WARC-Refers-To"), head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["WARC-Payload-Length"]), payload.decode()))
                if len(rows) == 256:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return mapped(index.repartition("file").sortWithinPartitions("file", "offset"), fetched, _RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _RECORD.split(", ")]
    kinds = [pa.int64() if x.endswith("long") else pa.string() for x in _RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def page_of(urn):
    """The page_id in a record's id, null if the page had none."""
    digits = F.regexp_extract(urn, "^<urn:x-page:(-?[0-9]+):", 1)
    return F.when(digits != "", digits.cast("long"))


def archived(pages: DataFrame) -> DataFrame:
    """Pages written to whole-file streams, normalised and read back: the columns of read(), page_id and refers_to_page."""
    spark = pages.sparkSession
    whole, folder = fresh_path(spark, "warc_whole"), fresh_path(spark, "warc")
    write(records(pages), whole)
    found = read(normalise(spark, whole, folder))
    return found.withColumn("page_id", page_of(F.col("record_id"))).withColumn("refers_to_page", page_of(F.col("refers_to")))
