"""Similarity join on word n-grams with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their sets of word shingles reaches a threshold.
Shingles are put in one global order, rare before frequent. Similar documents must share shingles
early in that order: in prefixes of ``n - ceil(t*n) + m`` shingles they share ``m`` at least, and more
when the sizes of both are known. Each document picks its own ``m``: a longer prefix costs more rows,
but a candidate must then meet it more often before it is verified.

The order follows a counting table of fixed size over all shingles of the corpus; any order gives
the same links, a good one gives fewer candidates. Documents with equal sets are one record.

Nulls and texts without words have the empty set: they link with nothing. Repeated rows
count as copies of one text. Other columns are ignored. Texts, shingles and sets go by 64-bit or 128-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.arrays import chunks, list_column, shingles
from ledgerline.llm.linking import components, link, maybe
from ledgerline.llm.shipping import mapped
from ledgerline.sources.landing import land

#: Counters of the frequency table (8 MB), whatever the corpus.
COUNTERS = 1 << 21
#: Choices for the number of shared prefix shingles.
MATCHES = np.array([1, 2, 4, 8, 16, 32, 64, 128])
#: Cost of looking at one candidate's whole set, in prefix rows.
VERIFY = 20.0

_PARTS = 64


def counted(texts: DataFrame, k: int) -> np.ndarray:
    """How often shingles of all texts fall on each counter: summed by tasks, then across tasks."""

    def part(batches):
        total, waiting, n = np.zeros(COUNTERS, np.int64), [], 0

        def add():
            np.add.at(total, (np.concatenate(waiting) >> np.uint64(43)).astype(np.int64), 1)

        for batch in batches:
            for _, data, offsets in chunks(batch.column(0)):
                for own in shingles(data, offsets, k, distinct=False):
                    waiting.append(own)
                    n += len(own)
                if n > 250_000:
                    add()
                    waiting, n = [], 0
        if waiting:
            add()
        for i, x in enumerate(np.split(total, _PARTS)):
            used = np.flatnonzero(x)
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([used.astype(np.uint16).tobytes()]), pa.array([x[used].tobytes()])], ["part", "used", "counts"])

    def merged(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part_id, used, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = sums.setdefault(part_id, np.zeros(COUNTERS // _PARTS, np.int64))
                own[np.frombuffer(used, np.uint16)] += np.frombuffer(counts, np.int64)
        for part_id, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part_id]), pa.array([np.minimum(own, (1 << 31) - 1).astype(np.int32).tobytes()])], ["part", "counts"])

    parts = mapped(texts.select("text"), part, "part long, used binary, counts binary").repartition(_PARTS, "part")
    out = np.zeros((_PARTS, COUNTERS // _PARTS), np.int32)
    for row in mapped(parts, merged, "part long, counts binary").collect():  # COUNTERS numbers, whatever the input
        out[row["part"]] = np.frombuffer(row["counts"], np.int32)
    return out.reshape(-1)


def chosen(frequency: np.ndarray, percent: int, noise: float) -> int:
    """The prefix length that costs least, from the frequencies in order.

    Cost: the prefix itself, the records it is estimated to meet, and the whole sets to look at, at most
    as many as are met often enough by a pair of equal sizes.
    """
    n = len(frequency)
    least, common = -(-percent * n // 100), -(-2 * percent * n // (100 + percent))
    lengths = n - least + MATCHES[MATCHES <= least]
    met = np.cumsum(np.maximum(frequency - noise, 0.0))[lengths - 1]
    asked = np.maximum(1, lengths - (n - common))
    return int(lengths[np.argmin(lengths + met + VERIFY * met / asked)])


def prefixes(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """For each text (tid, doc_id, text): the size and a digest of its set, its prefix, where that ends in the order, and how much follows."""
    frequency = counted(texts, k)
    noise = float(frequency.mean())
    sent = texts.sparkSession.sparkContext.broadcast(frequency)

    def per_text(batches):
        for batch in batches:
            for row, data, offsets in chunks(batch.column("text")):
                n, left, last, digests, kept = [], [], [], [], []
                for own in shingles(data, offsets, k):
                    often = sent.value[(own >> np.uint64(43)).astype(np.int64)]
                    n.append(len(own))
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                    if not len(own):
                        left.append(0)
                        last.append(0)
                        kept.append(np.zeros(0, np.int64))
                        continue
                    order = np.lexsort((own, often))
                    length = chosen(often[order].astype(float), percent, noise)
                    left.append(len(own) - length)
                    end = order[length - 1]
                    last.append((int(often[end]) << 32) | (int(own[end]) >> 32))
                    kept.append(own[order[:length]].view(np.int64))
                rest = batch.slice(row, len(n))
                yield pa.RecordBatch.from_arrays(
                    [rest.column("tid"), rest.column("doc_id"), pa.array(n, pa.int32()), pa.array(left, pa.int32()), pa.array(last, pa.int64()), pa.array(digests, pa.binary()), list_column(kept, pa.int64())],
                    ["tid", "doc_id", "n", "rest", "last", "digest", "prefix"],
                )

    return mapped(texts, per_text, "tid long, doc_id long, n int, rest int, last long, digest binary, prefix array<long>")


def verified(pairs: DataFrame, records: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of records whose sets are similar enough, computed on both whole sets."""
    pairs = land(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = land(records.join(ids, "id", "left_semi").select("id", "tid"), "wanted")
    near = maybe(texts.select("tid", "text"), "tid", wanted.select("tid")).dropDuplicates(["tid"])
    found = land(near.join(wanted, "tid").select("id", "text"), "wanted_texts")
    both = pairs.join(found.toDF("a", "text_a"), "a").join(found.toDF("b", "text_b"), "b")

    def similar(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                names = part.column("a").to_pylist() + part.column("b").to_pylist()
                texts = part.column("text_a").to_pylist() + part.column("text_b").to_pylist()
                once = dict(zip(names, texts))
                sets = {}
                for row, data, offsets in chunks(pa.array(once.values(), pa.large_string())):
                    sets |= dict(zip(list(once)[row : row + len(offsets) - 1], shingles(data, offsets, k)))
                keep = []
                for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist()):
                    x, y = sets[a], sets[b]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return mapped(both, similar, "a long, b long")


def classes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """One row per row of docs: doc_id, tid (hash of its text), n (size of its set), root (its component; null without words)."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    texts = texts.select(F.xxhash64("text").alias("tid"), "doc_id", "text")
    rows = land(prefixes(texts, k, percent), "prefixes")
    records = rows.where("n > 0").groupBy("digest").agg(F.min("tid").alias("tid"))
    records = land(records.withColumn("id", F.monotonically_increasing_id()), "records")
    sets = rows.where("n > 0").select("tid", "n", "rest", "last", "prefix").dropDuplicates(["tid"])
    keys = sets.join(records.select("tid", "id"), "tid").select("id", "n", "rest", "last", F.explode("prefix").alias("key"))
    links = link(keys.select("key", "id", "n", "rest", "last"), lambda pairs: verified(pairs, records, texts, k, percent), percent)
    grouped = records.join(components(links), "id", "left").select("digest", F.coalesce("root", "id").alias("root"))
    linked = rows.where("n > 0").select("digest", "doc_id", "tid", "n").join(grouped, "digest")
    out = linked.select("doc_id", "tid", "n", "root")
    return out.union(rows.where("n = 0").select("doc_id", "tid", "n", F.lit(None).cast("long")))


def similar_documents(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles (size of its set), component_id (smallest doc_id reachable by links).

    docs: doc_id and text, other columns are ignored. percent: similarity in hundredths. A row
    without words links with nothing: component_id is its own doc_id. A null doc_id is the
    component's only if all of the component are null.
    """
    found = land(classes(docs, k, percent), "classes")
    smallest = found.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = found.where("root is not null").join(smallest, "root").select("doc_id", "n", "component_id")
    out = linked.union(found.where("root is null").select("doc_id", "n", F.col("doc_id")))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs without near copies: of each component the row with the smallest doc_id stays (null last).

    A row that is repeated stays once. Rows without words all stay. Columns are those of docs.
    """
    found = land(classes(docs, k, percent), "classes")
    named = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tid")
    stays = found.where("root is not null").groupBy("root").agg(F.min(named).alias("stays"), F.count("*").alias("c")).where("c > 1")
    many = found.join(stays, "root").select("doc_id", "tid", (named == F.col("stays")).alias("stay"), "c").groupBy("doc_id", "tid").agg(F.max("stay").alias("stay"))
    many = many.toDF("many_id", "many_tid", "many_stay")
    own = docs.withColumn("many_text", F.xxhash64(F.coalesce("text", F.lit(""))))
    rule = (F.col("many_text") == F.col("many_tid")) & F.col("doc_id").cast("long").eqNullSafe(F.col("many_id"))
    kept = own.join(many, rule, "left").where("many_stay is null or many_stay")
    single, repeated = kept.where("many_stay is null"), kept.where("many_stay").dropDuplicates(["many_id", "many_tid"])
    return single.select(docs.columns).union(repeated.select(docs.columns))
