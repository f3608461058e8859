"""Mix sources to target weights by pivotal dependent rounding.

Every document of a source gets the same fractional number of copies, target over size of the
source. Its whole part is taken, the fraction is rounded: two fractions are paired and words move
from one to the other until one of them is 0 or 1. The other is paired again. Whether a document
rises or falls is drawn with its fraction as probability when it is taken up, so the expected copies
stay, and it keeps to that until it is whole: long documents come first and are not left for the end. The words of a source are kept exactly in each step, so only one
document a source is ever rounded up or down beyond its share.

Blocks of about 256 documents are folded in one row each; what each leaves (one fraction at most) goes
up to the next level of blocks, a tree whose levels shrink 256-fold. Blocks are hashed, so that a
source that holds all rows is spread like any other. Draws are hashes of the documents: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.landing import land

#: Documents in a block, on average.
BLOCK = 256

#: A fraction this near to 0 or 1 counts as whole.
_NEAR = 1e-9


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target: weighted shares of ``share`` times all, none above ``most`` times its size.

    sizes: one row per source (source, source_size); that table is as short as the list of sources,
    so its two ordered sums run in one task. Sources are put in order of code points, null last, and
    take the weights in turn. With the stopped sources in order of ``most * size / weight``, the level
    of the others follows from two running sums: the first source that its level does not stop.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    with_caps = sizes.withColumn("w", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("w"))
    before = Window.orderBy("full_at", F.col("source").isNull(), F.col("source").cast("binary")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total, weight_sum = F.sum("source_size").over(everything) * F.lit(float(share)), F.sum("w").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (weight_sum - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    found = with_caps.withColumn("level", level)
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(everything)["level"]
    found = found.withColumn("chosen", level)
    return found.select("source", "source_size", F.when(F.col("chosen").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("w") * F.col("chosen"))).alias("target"))


def _let(value, body):
    return F.transform(F.array(value), body)[0]


def _whole(f):
    return (f < _NEAR) | (f > 1 - _NEAR)


def _drawn(key, salt: int):
    """A number from 0 to 1 that depends on the document only."""
    return F.shiftrightunsigned(F.xxhash64(*[key[c] for c in ("doc_id", "size", "tid")], F.lit(salt)), 11) / F.lit(float(1 << 53))


def _opened(key, size, f, up):
    return F.struct(key.alias("key"), size.alias("size"), f.alias("f"), up.alias("up"))


def _settled(key, f):
    return F.array(F.struct(key.alias("key"), (f > 0.5).alias("up")))


def _paired(state, unit, level: int):
    """One step of the fold: words move between the open unit and the next until one of them is whole."""
    opened, done = state["open"], state["done"]

    def move(words):
        first = opened["f"] + words / opened["size"]
        second = unit["f"] - words / unit["size"]
        return _let(F.struct(first.alias("first"), second.alias("second")), settle)

    def settle(n):
        other = _opened(unit["key"], unit["size"], n["second"], _drawn(unit["key"], level) < n["second"])
        same = _opened(opened["key"], opened["size"], n["first"], opened["up"])
        return F.when(
            _whole(n["first"]), F.struct(other.alias("open"), F.concat(done, _settled(opened["key"], n["first"])).alias("done"))
        ).otherwise(F.struct(same.alias("open"), F.concat(done, _settled(unit["key"], n["second"])).alias("done")))

    rise = F.least(opened["size"] * (1 - opened["f"]), unit["size"] * unit["f"])
    fall = F.least(opened["size"] * opened["f"], unit["size"] * (1 - unit["f"]))
    pair = _let(F.when(opened["up"], rise).otherwise(-fall), move)
    first = _opened(unit["key"], unit["size"], unit["f"], _drawn(unit["key"], level) < unit["f"])
    return F.when(opened.isNull() | _whole(opened["f"]), F.struct(first.alias("open"), _closed(state).alias("done"))).otherwise(pair)


def _closed(state):
    """What is decided, with the open unit if that is whole."""
    opened = state["open"]
    return F.when(opened.isNotNull() & _whole(opened["f"]), F.concat(state["done"], _settled(opened["key"], opened["f"]))).otherwise(state["done"])


_KEY = "struct<doc_id:bigint,size:bigint,tid:bigint>"


def rounded(units: DataFrame) -> DataFrame:
    """src, key, up: whether each fraction is rounded up. units: src, key, size (over 0), f (0 to 1)."""
    level, settled = 0, []
    most = units.groupBy("src").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 1
    blocks = -(-most // BLOCK)
    while True:
        block = F.pmod(F.xxhash64("key", F.lit(level)), F.lit(blocks))
        grouped = units.groupBy("src", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("size", "key", "f")), asc=False).alias("us"))
        zero = F.struct(
            F.lit(None).cast(f"struct<key:{_KEY},size:double,f:double,up:boolean>").alias("open"), F.array().cast(f"array<struct<key:{_KEY},up:boolean>>").alias("done")
        )
        here = level
        folded = F.aggregate("us", zero, lambda s, u: _paired(s, u, here), lambda s: F.struct(F.when(~_whole(s["open"]["f"]), s["open"]).alias("open"), _closed(s).alias("done")))
        made = land(grouped.select("src", folded.alias("r")), "rounding")
        settled.append(made.select("src", F.explode("r.done").alias("d")).select("src", "d.key", "d.up"))
        units = made.where("r.open is not null").select("src", "r.open.key", "r.open.size", "r.open.f")
        if blocks == 1:
            break
        blocks, level = -(-blocks // BLOCK), level + 1
    out = units.select("src", "key", (_drawn(F.col("key"), -1) < F.col("f")).alias("up"))
    for table in settled:
        out = out.union(table)
    return out


def copies(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """How often each document is taken: one row for all rows alike in src, doc_id, size and tid.

    src stands for the source (null is one of its own), tid for the text, size for its words, c for the
    rows alike, k for the copies of all of them together. Then source_size and target. Null and empty
    texts have size 0 and are not taken.
    """
    tid, size = F.xxhash64(F.coalesce("text", F.lit(""))), F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    src = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    rows = docs.select(src.alias("src"), F.col("doc_id").cast("long").alias("doc_id"), size.cast("long").alias("size"), tid.alias("tid"))
    alike = land(rows.groupBy("src", "doc_id", "size", "tid").agg(F.count("*").alias("c")), "sizes")
    sizes = alike.groupBy("src").agg(F.sum(F.col("size") * F.col("c")).alias("source_size"))
    named = sizes.select(F.when(F.col("src") != "", F.expr("substring(src, 2)")).alias("source"), "source_size")
    aims = land(targets(named, weights, share, most), "targets").withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")
    units = alike.join(aims, "src").withColumn("p", F.when(F.col("size") > 0, F.col("c") * F.col("target") / F.col("source_size")).otherwise(0.0))
    near = F.round("p")
    units = units.withColumn("p", F.when(F.abs(F.col("p") - near) < _NEAR, near).otherwise(F.col("p"))).withColumn("key", F.struct("doc_id", "size", "tid"))
    part = units.select("src", "key", F.col("size").cast("double").alias("size"), (F.col("p") - F.floor("p")).alias("f")).where("f > 0")
    up = rounded(part)
    found = units.join(up.withColumnRenamed("up", "is_up"), ["src", "key"], "left")
    return found.withColumn("k", F.floor("p") + F.coalesce(F.col("is_up").cast("long"), F.lit(0)))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per row of docs.

    docs: doc_id, source, text; other columns are ignored. Rows alike in all three share their copies.
    """
    each = copies(docs, weights, share, most).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), "c")))
    own = F.floor(F.col("k") / F.col("c")) + F.when(F.col("i") <= F.col("k") % F.col("c"), 1).otherwise(0)
    return each.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("size") * own).cast("long").alias("taken"))


def mixture(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of docs, each as often as it is taken; of rows alike, which one takes an odd copy is drawn by place."""
    found = copies(docs, weights, share, most).select("src", F.col("doc_id").alias("own_id"), F.col("tid").alias("own_tid"), "c", "k")
    src, tid = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))
    rule = (src == F.col("src")) & (tid == F.col("own_tid")) & F.col("doc_id").cast("long").eqNullSafe(F.col("own_id"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", "text")
    spare = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("c")) < F.col("k") % F.col("c")
    times = F.floor(F.col("k") / F.col("c")) + F.when(F.col("c") == 1, 0).otherwise(spare.cast("long"))
    out = own.join(found, rule).withColumn("time", F.explode(F.sequence(F.lit(0).cast("long"), times))).where("time > 0")
    return out.select("row.*")
