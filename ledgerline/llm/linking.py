"""Links between records that share keys, found without listing the pairs of a group.

``link`` takes rows (key, id) and a check of candidate pairs. Each round names one leader a key, the
member whose keys most others have (later one of another component), and checks the key's members against it only,
so candidates grow with the rows. Checked links are joined into components, and keys whose members are all connected are
done. Keys that a record shares with no other component bound what a pair can have in common; pairs
that cannot reach the similarity any more are done too. While the keys that are left have many pairs
a row, their members are dealt into groups of a bounded size and meet there only, which is as much as
the rows, and joins most into components. Of the pairs that are left,
each record's best few are checked first, which connects most of the others, then all that still lie
across components: every pair of one key is checked, connected, or too far apart for sure, so no
component is split.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shipping import mapped
from ledgerline.sources.landing import fits, forget, land

#: A prefilter has 2**25 bits: a fixed 4 MB whatever the data holds. When it is full it lets all rows pass.
BIT_COUNT = 25
#: Rounds that check each record's best pairs at most, before all pairs that are left are checked.
ROUNDS = 2
#: Best pairs a record: one in each bin of its partners.
BINS = 16
#: Members that a key has in a group, in the mean; pairs of components a row from which groups are worth a round; rounds of groups;
#: and rows a link from which on another round is not worth it.
GROUP, CROWDED, DEALS, SPARSE = 4, 4, 2, 64
#: Links that one task joins into components at most (4 MB); more take steps over all tasks.
GATHERED = 1 << 18
#: Keys of a record that travel with its rows, so that a join counts shared keys itself; where there are more, rows are counted.
_LISTED = 64


def components(links: DataFrame) -> DataFrame:
    """(id, root) of all ids in links (a, b): the smallest id that links reach.

    Large-star and small-star steps, each a grouped minimum and a join, so that a hub with any
    number of links is split over tasks. The links of each step are landed. Up to ``GATHERED`` links are
    joined by one task.
    """
    links = land(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    if fits(links, GATHERED):
        return mapped(links.coalesce(1), _gathered, "id long, root long")
    while not _are_stars(links):
        both = links.union(links.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(small.select("a", F.col("m").alias("b")))
        links = land(small.distinct(), "links")
    roots = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "id")
    return roots.union(links.select("b", "b").distinct().toDF("id", "root"))


def _gathered(batches):
    """(id, root) of links (a, b) that fit one task: labels hook onto smaller ones and are shortened until none changes."""
    parts = [(batch.column("a").to_numpy(), batch.column("b").to_numpy()) for batch in batches]
    if not parts:
        return
    ids, at = np.unique(np.concatenate([x for p in parts for x in p]), return_inverse=True)
    at, labels = np.split(at, np.cumsum([len(x) for p in parts for x in p])[:-1]), np.arange(len(ids))
    a, b = np.concatenate(at[::2]), np.concatenate(at[1::2])
    while (labels[a] != labels[b]).any():
        x, y = labels[a], labels[b]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels != labels[labels]).any():
            labels = labels[labels]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[labels])], ["id", "root"])


def _are_stars(links: DataFrame) -> bool:
    """Whether each id has one link down at most, and those that have one have none from above."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(links.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or (down = 1 and up = 1)").isEmpty()


def bitmap(ids: DataFrame) -> np.ndarray:
    """Bits of the ids (evenly spread hashes, one column), as a fixed-size array of 64-bit words."""
    place = F.shiftrightunsigned(F.col(ids.columns[0]), 64 - BIT_COUNT)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    found = ids.select(F.shiftright(place, 6).cast("int").alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(1 << (BIT_COUNT - 6), np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def marked(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids (64-bit hashes) may be in a bitmap."""
    place = (ids.view(np.uint64) >> np.uint64(64 - BIT_COUNT)).view(np.int64)
    return (bits[place >> 6] >> (place & 63)) & 1 == 1


def maybe(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose column may be among ids: spares a shuffle most of the others; join to be exact."""
    sent = rows.sparkSession.sparkContext.broadcast(bitmap(ids))

    def kept(batches):
        for batch in batches:
            yield batch.filter(pa.array(marked(sent.value, batch.column(column).to_numpy())))

    return mapped(rows, kept, rows.schema)


#: Words of 64 bits in a sketch of a set: each bit says whether an odd number of its elements' hashes falls on it.
SKETCH = 4
SKETCH_TYPE = f"struct<{', '.join(f'w{i}:bigint' for i in range(SKETCH))}>"

#: What a record brings to each key, and is known by beside it: its set's size, what follows its keys, where they end, its sketch, and the most it can share.
_GIVEN = ("id", "n", "rest", "last", "sketch")
_KNOWN = (*_GIVEN, "most")


def _crossing(rows: DataFrame) -> DataFrame:
    """Rows (key, id, n, rest, last, sketch, root) of keys that lie in several components, with most and score.

    most: how much a record can share with one of another component whose keys end later, as keys that
    lie in no other component are shared with none. score: how many rows its keys have, in the mean.
    """
    keys = rows.groupBy("key").agg(F.count("*").alias("c"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key", "c")
    keys = land(keys, "crossing_keys")
    left = land(maybe(rows, "key", keys.select("key")).join(keys, "key"), "crossing_rows")
    own = left.groupBy("id").agg(F.count("*").alias("k"), F.sum("c").alias("s"))
    rated = left.drop("c").join(own, "id").withColumn("most", (F.col("rest") + F.col("k")).cast("int"))
    rated = rated.withColumn("score", F.col("s") / F.greatest(F.lit(1), F.col("n") - F.col("rest"))).drop("k", "s")
    out = land(rated, "crossing")
    forget(left)
    forget(keys)
    return out


def _possible(percent: int) -> tuple[str, str]:
    """Whether sizes leave the similarity of a record and lead possible, and how many keys they must share.

    Both bounds are those of the record whose keys end first: what is shared up to there are shared keys.
    Each bit in which two sketches differ is one element at least that only one set has, of which similar sets have few.
    """
    first = "if(last < lead.last, {0}, if(last > lead.last, lead.{0}, greatest({0}, lead.{0})))"
    sizes = f"100 * least(n, lead.n) >= {percent} * greatest(n, lead.n) and {100 + percent} * {first.format('most')} >= {percent} * (n + lead.n)"
    apart = " + ".join(f"bit_count(sketch.w{i} ^ lead.sketch.w{i})" for i in range(SKETCH))
    sizes += f" and coalesce({100 + percent} * ({apart}) <= {100 - percent} * (n + lead.n), true)"
    return sizes, f"greatest(1, ceil({percent} * (n + lead.n) / {100 + percent}) - {first.format('rest')})"


def _led(rows: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs (a, b) of members and the leader of their keys that lie in different components and share enough of the keys it leads.

    In the first turn the leader is the member whose keys most others have, later that of a component picked by hash.
    """
    sizes, need = _possible(percent)
    picked = F.xxhash64("root", F.lit(turn)) if turn else F.lit(0)
    central = F.max_by(F.struct(*_KNOWN, "root"), F.struct(picked, "score", F.negative("id")))
    led = rows.join(rows.groupBy("key").agg(central.alias("lead")), "key").where("root <> lead.root").where(sizes)
    pairs = led.groupBy(F.greatest("id", "lead.id").alias("a"), F.least("id", "lead.id").alias("b"))
    return pairs.agg(F.count("*").alias("shared"), F.min(F.expr(need)).alias("need")).where("shared >= need").select("a", "b")


def _listed(rows: DataFrame) -> DataFrame:
    """rows with all keys of their record, where these are up to ``_LISTED``."""
    lists = rows.groupBy("id").agg(F.collect_list("key").alias("keys")).select("id", F.when(F.size("keys") <= _LISTED, F.col("keys")).alias("keys"))
    return rows.join(lists, "id").select("key", "keys", "root", *_KNOWN)


def _best(pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b, shared) each record's best in each bin of its partners."""
    one = pairs.select(F.col("a").alias("id"), F.col("b").alias("other"), "shared")
    both = one.union(pairs.select("b", "a", "shared"))
    best = both.groupBy("id", F.pmod(F.xxhash64("other"), F.lit(BINS))).agg(F.max_by("other", F.struct("shared", "other")).alias("other"))
    return land(best.select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct(), "best_pairs")


def _is_crowded(rows: DataFrame) -> bool:
    """Whether keys have many pairs across components for each row."""
    parts = rows.groupBy("key", "root").agg(F.count("*").cast("double").alias("c"))
    keys = parts.groupBy("key").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("own"))
    return not keys.agg(F.sum(F.expr("c * c - own")).alias("pairs"), F.sum("c").alias("n")).where(F.col("pairs") > 2 * CROWDED * F.col("n")).isEmpty()


def _grouped(rows: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs (a, b, shared) of different components that share enough keys, of members that fall into one group of a key.

    A key's members are dealt into groups of ``GROUP`` in the mean, whatever their number, anew each turn.
    """
    sizes, need = _possible(percent)
    groups = rows.groupBy("key").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    dealt = _listed(rows).join(groups, "key").withColumn("group", F.pmod(F.xxhash64("key", "id", F.lit(turn)), F.col("groups"))).drop("groups")
    common = "array_intersect(keys, lead.keys)"
    rule = f"root < lead.root and {sizes} and (keys is null or lead.keys is null or size({common}) >= {need})"
    met = dealt.join(dealt.select("key", "group", F.struct("keys", "root", *_KNOWN).alias("lead")), ["key", "group"]).where(rule)
    shared = F.expr(f"if(keys is null or lead.keys is null, 1, size({common}))")
    return met.select(F.col("id").alias("a"), F.col("lead.id").alias("b"), shared.alias("shared"))


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b, shared) of different components that share enough keys.

    Records carry up to ``_LISTED`` keys in each row; two such records meet in the smallest key that
    they share, if they share enough. Others meet in each key and are counted afterwards.
    """
    sizes, need = _possible(percent)
    rows = _listed(rows)
    common = "array_intersect(keys, lead.keys)"
    rule = f"root < lead.root and {sizes} and (keys is null or lead.keys is null or (key = array_min({common}) and size({common}) >= {need}))"
    met = rows.join(rows.select("key", F.struct("keys", "root", *_KNOWN).alias("lead")), "key").where(rule)
    shared = F.expr(f"if(keys is null or lead.keys is null, 1, size({common}))")
    met = met.select(F.col("id").alias("a"), F.col("lead.id").alias("b"), shared.alias("shared"), F.expr(need).alias("need"))
    return met.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("need").alias("need")).where("shared >= need").drop("need")


def link(rows: DataFrame, check: Callable[[DataFrame], DataFrame], percent: int, leaders: int = 1) -> DataFrame:
    """Links (a, b) whose components are those of all pairs that share enough keys and pass the check.

    rows: key long, id long, n int (size of the record's set), rest int (elements of the set that come
    after the record's keys in the common order), last long (where in that order its keys end; may be
    coarse, and missing if unknown), sketch (``SKETCH_TYPE``, of the whole set; may be null or missing),
    each (key, id) once. check: returns those pairs (a, b)
    that are linked. Of the record whose keys end first, all shared elements up to there are shared
    keys and at most its ``rest`` can follow. So a pair that reaches the similarity shares the overlap
    it needs less that ``rest``, and others are not checked; neither are sizes too far apart.
    leaders: rounds with one leader a key. The links returned join each id to its component.
    """
    if "last" not in rows.columns:
        rows = rows.withColumn("last", F.lit(0).cast("long"))
    if "sketch" not in rows.columns:
        rows = rows.withColumn("sketch", F.lit(None).cast(SKETCH_TYPE))
    rest = _crossing(rows.withColumn("root", F.col("id")))
    links = land(check(_led(rest, percent, 0)), "linked")
    for turn in range(1, leaders + 1):
        links, rest = _joined(links, rest)
        if turn < leaders:
            links = links.union(land(check(_led(rest, percent, turn)), "linked"))
    for turn in range(DEALS):
        if not _is_crowded(rest):
            break
        found = land(check(_best(_grouped(rest, percent, turn))), "linked")
        links = links.union(found)
        if SPARSE * found.count() < rest.count():
            break
        links, rest = _joined(links, rest)
    pairs = land(_across(rest, percent), "pairs_across")
    for _ in range(ROUNDS):
        best = _best(pairs)
        if pairs.count() <= 2 * best.count():
            break
        found = land(check(best), "linked")
        if found.isEmpty():
            break
        roots = components(links.union(found))
        links = roots.select(F.col("id").alias("a"), F.col("root").alias("b"))
        pairs = land(_split(pairs, roots), "pairs_across")
    return links.union(land(check(pairs.select("a", "b")), "linked"))


def _joined(links: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links that join each id to its component, and the rows of keys that still lie in several components."""
    roots = components(links)
    placed = rows.select("key", *_GIVEN).join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    left = _crossing(placed)
    forget(rows)
    return roots.select(F.col("id").alias("a"), F.col("root").alias("b")), left


def _split(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs that lie in different components."""
    roots = land(roots, "roots")
    placed = pairs.join(roots.toDF("a", "x"), "a", "left").join(roots.toDF("b", "y"), "b", "left")
    return placed.where("coalesce(x, a) <> coalesce(y, b)").select("a", "b", "shared")
