"""Document fingerprints by closed syncmers.

A k-mer is a run of ``K`` words (a word of more than 16 characters counts in pieces). It is an anchor if
the smallest hash of its words lies at its first or last word: that depends on the k-mer alone, so
whatever is edited elsewhere, the anchors of unchanged passages stay. A fingerprint lists the hashes of
a text's anchors in order, each once. A text of fewer than K words is one k-mer; a text without words
has no anchors. Everything is a built-in function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words in a k-mer.
K = 4
WORD = r"[^\x20\x09-\x0D]{1,16}"
#: Ranges of the order in which neighbours meet, for each shuffle partition.
RANGES = 4


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def fingerprint(text: Column) -> Column:
    """The anchors of a text: array of int, distinct, in order."""

    def anchored(h: Column) -> Column:
        def edge(i: Column) -> Column:
            inner = F.least(*[F.get(h, i + j) for j in range(1, K - 1)])
            return F.least(F.get(h, i), F.get(h, i + (K - 1))) <= inner

        places = F.filter(F.sequence(F.lit(0), F.size(h) - K), edge)
        kmers = F.transform(places, lambda i: F.shiftright(F.xxhash64(*[F.get(h, i + j) for j in range(K)]), 32).cast("int"))
        short = F.transform(F.array(F.aggregate(h, F.lit(0).cast("long"), lambda s, x: F.xxhash64(s, x))), lambda x: F.shiftright(x, 32).cast("int"))
        return F.when(F.size(h) >= K, F.array_distinct(kmers)).when(F.size(h) > 0, short).otherwise(F.array().cast("array<int>"))

    return _let(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)), anchored)


def likeness(a: Column, b: Column) -> Column:
    """Shared anchors of all anchors, 0 to 1; 1 if neither has any."""

    def shared(n: Column) -> Column:
        both = F.size(a) + F.size(b) - n
        return F.when(both == 0, 1.0).otherwise(n / both)

    return _let(F.size(F.array_intersect(a, b)), shared)


def with_next(table: DataFrame) -> DataFrame:
    """table (doc_id, text, fp) with next: text and fp of the row that follows in descending doc_id; after the last the first.

    Null ids come last; equal ids go by a hash of the text. Rows are dealt into ranges of that order by
    one shuffle, and the first row of each range is sent to the range before as well, so that only
    neighbours within a range are looked up. A range boundary is a place in the order of (doc_id, hash),
    so an id that many rows share is split too; boundaries are as many as the ranges.
    """
    spark = table.sparkSession
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.shiftrightunsigned("tid", 11) / F.lit(float(1 << 53))
    keyed = table.withColumn("tid", F.xxhash64("text")).withColumn("place", F.col("doc_id").cast("double") + spread)
    cuts = keyed.agg(F.percentile_approx("place", [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or [] if ranges > 1 else []
    cuts = sorted(set(cuts), reverse=True)
    known = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c > F.col("place"))) if cuts else F.lit(0)
    dealt = keyed.withColumn("range", F.when(F.col("doc_id").isNotNull(), known).otherwise(len(cuts) + 1 + F.floor((1 - spread) * ranges).cast("int")).cast("int"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tid").desc()]
    named = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tid")
    firsts = dealt.groupBy("range").agg(F.max(named).alias("first")).orderBy("range").collect()  # one row a range
    edges = [(firsts[i - 1]["range"], row["first"]["doc_id"], row["first"]["tid"]) for i, row in enumerate(firsts)]
    edges = spark.createDataFrame(edges, "edge_range int, edge_id long, edge_tid long")
    rule = (F.col("tid") == F.col("edge_tid")) & F.col("doc_id").eqNullSafe(F.col("edge_id"))
    copies = dealt.join(F.broadcast(edges), rule).withColumn("range", F.col("edge_range")).drop("edge_range", "edge_id", "edge_tid")
    both = dealt.withColumn("edge", F.lit(False)).unionByName(copies.withColumn("edge", F.lit(True)))
    both = both.withColumn("fp", fingerprint(F.col("text")))
    window = Window.partitionBy("range").orderBy("edge", *order)
    return both.withColumn("next", F.lead(F.struct("text", "fp")).over(window)).where("not edge").drop("edge", "tid", "place", "range")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, text, fp, edited, edited_fp and next_fp of every row of docs (null text: empty).

    edited: the last third of the code points replaced by as many from the start of the next document.
    docs: doc_id and text; other columns are ignored.
    """
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = with_next(table).withColumn("n_chars", F.char_length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.left(F.col("text"), (F.col("n_chars") - third).cast("int")), F.left(F.col("next.text"), third))
    found = found.select("doc_id", "n_chars", "text", "fp", edited.alias("edited"), F.col("next.fp").alias("next_fp"))
    return found.withColumn("edited_fp", fingerprint(F.col("edited")))
