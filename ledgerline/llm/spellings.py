"""Groups of spelling variants: words that differ by one letter, found with bitsets over letter positions.

``vocabulary`` counts the words of all texts with built-in functions, pre-aggregated before they are
shuffled. ``near_words`` finds every pair of words that differ by exactly one inserted, deleted or
replaced code point. ``variants`` names each word's form and follows forms to the root.

A block of words has one bitset for each (position, letter) that occurs in it: which words have that
letter there. A word is looked up in the whole block at once. Reading it letter by letter, three sets
are kept side by side: the words equal so far, those with one letter replaced, and those with one
letter more, which are compared one position further on:

    more  = (more | equal) & at[i + 1][letter]
    other = (other & at[i][letter]) | (equal & ~at[i][letter])
    equal = equal & at[i][letter]

A letter less is the same pair seen from the other word. The lookups of many words run in one array.

Blocks are shards of the vocabulary. Of a pair whose shorter word has c letters, cut in thirds, one
edit leaves two thirds as they are: the beginnings, or the ends, or both outer thirds of the two words
are equal. So each word goes to three groups for its own length as c and three for one less, dealt by
hash; neighbouring groups fill a block. A pair that shares several groups is given by the first alone.
A group of more than ``MOST`` words, however large, is dealt once more by what is left of its words
without one letter of the third that may differ; such groups have no more words than there are letters
to put in, so no task ever holds an unbounded group and no pairs are lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.shipping import mapped
from ledgerline.sources.landing import fits, land

#: Words shorter than this are left out.
SHORTEST = 7
#: Words in a group that is still looked up as it is.
MOST = 4096
#: A block is closed when it has so many words or so many letters.
BLOCK_WORDS, BLOCK_LETTERS = 512, 65_536
#: Bytes of one array of sets while words are looked up.
SET_BYTES = 1 << 20
#: Keys of large groups that are broadcast, at most (8 bytes each).
BROADCAST_KEYS = 1_000_000

LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PAIR = "word string, n long, near string, near_n long"


def vocabulary(docs: DataFrame, letters: str = LETTERS, shortest: int = SHORTEST, least: int = 2, one_in: int = 31) -> DataFrame:
    """``(word, n)``: the words of at least ``shortest`` letters that occur ``least`` times in all texts.

    A word is a maximal run of ``letters`` of a text (null: none) with A-Z in lower case. If ``one_in``
    divides the crc32 h of ``<doc_id>:<word>`` (null doc_id: nothing before the colon) the code point
    h % length is left out of it. Repeated rows count as often as they are there; other columns do not matter.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(f"([{letters}]{{{shortest},}})"), F.lit(1)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), run.alias("run"))
    lowered = runs.select("doc", F.translate("run", _UPPER, _LOWER).alias("run"))
    hashed = lowered.select("run", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    rest = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % one_in == 0, rest).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).where(F.char_length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least)


def _part(kind: int, c: Column) -> Column:
    """What stays equal: 0 the beginning, 1 the end, 2 both outer thirds, of a pair whose shorter word has c letters."""
    first, second, length = F.floor(c / 3).cast("int"), F.floor(2 * c / 3).cast("int"), F.char_length("word")
    if kind == 0:
        return F.substring("word", F.lit(1), second)
    if kind == 1:
        return F.substring("word", length - (c - first) + 1, c - first)
    return F.concat_ws("\n", F.substring("word", F.lit(1), first), F.substring("word", length - (c - second) + 1, c - second))


def _grouped(words: DataFrame, shortest: int) -> DataFrame:
    """Each word once for each group it is in: (key, c, kind, word, n)."""
    length = F.char_length("word")
    classes = F.explode(F.filter(F.array(length, length - 1), lambda c: c >= shortest))
    rows = words.select("word", "n", classes.alias("c"))
    keys = F.array(*[F.struct(F.lit(k).alias("kind"), F.xxhash64(F.lit(k), "c", _part(k, F.col("c"))).alias("key")) for k in range(3)])
    return rows.select("word", "n", "c", F.inline(keys)).select("key", "c", "kind", "word", "n")


def _without_one(rows: DataFrame) -> DataFrame:
    """Words of large groups, once for each word left when a letter goes that their pair may differ in.

    A pair of equal length loses the letter at the same place; of a pair of different lengths the longer
    word loses one and is then the shorter. A word left in two ways stands twice; the block takes it once.
    """
    c, length = F.col("c"), F.char_length("word")
    first, second = F.floor(c / 3).cast("int"), F.floor(2 * c / 3).cast("int")
    same = length == c
    begin = F.when(F.col("kind") == 0, second).when(F.col("kind") == 1, F.lit(0)).otherwise(first)
    # Places of the part that may differ; a longer word has one more.
    end = F.when(F.col("kind") == 0, length - 1).when(F.col("kind") == 1, F.when(same, first - 1).otherwise(first)).otherwise(F.when(same, second - 1).otherwise(second))
    holes = rows.withColumn("at", F.explode(F.sequence(begin, end)))
    left = F.concat(F.substring("word", F.lit(1), F.col("at")), F.substring("word", F.col("at") + 2, length))
    hole = lambda place, text: F.xxhash64(F.col("kind"), "c", place, text)
    lost = holes.select(hole(F.when(same, F.col("at")).otherwise(-1), left).alias("key"), "c", "kind", "word", "n")
    whole = rows.where(same).select(hole(F.lit(-1), F.col("word")).alias("key"), "c", "kind", "word", "n")
    return lost.unionByName(whole)


def near_words(words: DataFrame, shortest: int = SHORTEST, most: int = MOST) -> DataFrame:
    """``(word, n, near, near_n)``: all pairs of words that differ by one code point, both ways, each once.

    ``words(word, n)`` has each word once, none shorter than ``shortest`` (at least 3); it is read
    several times and should be landed. Words may be of any length.
    """
    rows = land(_grouped(words, shortest), "spelling_groups")
    # Groups of one word have no pairs, but only a count could tell; blocks pass over them.
    large = land(rows.groupBy("key").count().where(F.col("count") > most).select("key"), "large_groups")
    if large.isEmpty():
        return mapped(_in_order(rows), _looked_up, _PAIR)
    keys = F.broadcast(large) if fits(large, BROADCAST_KEYS) else large
    dealt = rows.join(keys, "key", "left_anti").unionByName(_without_one(rows.join(keys, "key", "left_semi")))
    return mapped(_in_order(dealt), _looked_up, _PAIR)


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("c", "key", "kind", "word")


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of sorted group rows: neighbouring groups of one class and kind are put in blocks, groups of one word passed over."""
    block, group, letters, last = [], [], 0, None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if last is None or row[:3] != last:
                if len(group) > 1:
                    block.append(group)
                    letters += sum(len(r[3]) for r in group)
                group, before, last = [], last, row[:3]
                if block and (before[1] != row[1] or letters >= BLOCK_LETTERS or sum(map(len, block)) >= BLOCK_WORDS):
                    yield from _pairs(block, before[1])
                    block, letters = [], 0
            if not group or group[-1][3] != row[3]:
                group.append(row)
    if len(group) > 1:
        block.append(group)
    if block:
        yield from _pairs(block, last[1])


def _shares(kind: int, c: int, one: str, two: str) -> bool:
    """Whether two words are in a common group of a kind, in the class of pairs whose shorter word has c letters."""
    first, second = c // 3, 2 * c // 3
    if kind == 0:
        return one[:second] == two[:second]
    if kind == 1:
        return one[len(one) - (c - first) :] == two[len(two) - (c - first) :]
    return one[:first] == two[:first] and one[len(one) - (c - second) :] == two[len(two) - (c - second) :]


def _pairs(block: list[list[tuple]], c: int) -> Iterator[pa.RecordBatch]:
    """All pairs inside the groups of a block, both ways."""
    rows = [row for group in block for row in group]
    names = [row[3] for row in rows]
    owner = np.repeat(np.arange(len(block)), [len(g) for g in block])
    found: list[tuple] = []
    for one, two in one_edit(names, c, owner):
        kind = rows[one][2]
        if next((k for k in range(3) if _shares(k, c, names[one], names[two])), None) == kind:
            found.append((names[one], rows[one][4], names[two], rows[two][4]))
            if len(names[two]) > c:
                found.append((names[two], rows[two][4], names[one], rows[one][4]))
        if len(found) >= 4096:
            yield _batch(found)
            found = []
    if found:
        yield _batch(found)


def _batch(found: list[tuple]) -> pa.RecordBatch:
    word, n, near, near_n = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(word), pa.array(n, pa.int64()), pa.array(near), pa.array(near_n, pa.int64())], ["word", "n", "near", "near_n"])


def one_edit(names: list[str], c: int, owner: np.ndarray) -> Iterator[tuple[int, int]]:
    """(i, j) for words of c letters and the words of the same owner with one letter replaced or one more.

    ``names`` are words of c or c + 1 letters. Of equal lengths both orders are given.
    """
    width = c + 2
    codes = np.zeros((len(names), width), np.int64)  # place * all letters + letter; 0 after the end
    lengths = np.array([len(w) for w in names])
    flat = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32).astype(np.int64)
    known, letters = np.unique(flat, return_inverse=True)
    inside = np.arange(width) < lengths[:, None]
    places = np.broadcast_to(np.arange(width), codes.shape)
    size = len(known) + 1
    codes[inside] = places[inside] * size + letters + 1
    # One bitset for each (place, letter) that occurs; the first stays empty.
    pairs, at = np.unique(codes[inside], return_inverse=True)
    sets = np.zeros((len(pairs) + 1, (len(names) + 63) // 64), np.uint64)
    member = np.nonzero(inside)[0]
    np.bitwise_or.at(sets, (at + 1, member // 64), np.uint64(1) << (member % 64).astype(np.uint64))
    of_length = np.zeros((2, sets.shape[1]), np.uint64)
    everyone = np.arange(len(names))
    np.bitwise_or.at(of_length, ((lengths > c).astype(int), everyone // 64), np.uint64(1) << (everyone % 64).astype(np.uint64))
    asked = np.flatnonzero(lengths == c)
    step = max(1, SET_BYTES // (8 * sets.shape[1]))
    own = np.zeros(codes.shape, np.int64)
    own[inside] = at + 1
    for start in range(0, len(asked), step):
        query = asked[start : start + step]
        equal = np.full((len(query), sets.shape[1]), ~np.uint64(0))
        other, more = np.zeros_like(equal), np.zeros_like(equal)
        for i in range(c):
            here = sets[own[query, i]]
            further = codes[query, i] + size  # the same letter one place on
            there = np.searchsorted(pairs, further)
            hit = pairs[np.minimum(there, len(pairs) - 1)] == further
            more = (more | equal) & sets[np.where(hit, there + 1, 0)]
            other = (other & here) | (equal & ~here)
            equal &= here
        found = (other & of_length[0]) | ((more | equal) & of_length[1])
        bits = np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")
        for one, two in zip(*np.nonzero(bits)):
            if owner[query[one]] == owner[two]:
                yield int(query[one]), int(two)


def variants(words: DataFrame, ratio: int = 10, shortest: int = SHORTEST, most: int = MOST) -> DataFrame:
    """``(word, n, form, form_n, root, n_near)`` for all words.

    ``form`` is the near word of largest n (ties: smallest in code-point order) if it occurs ``ratio``
    times as often at least, else null; ``root`` is where forms lead to, the word itself without one.
    Counts grow by ``ratio`` on each step, so forms never go in a circle and chains are short: each
    round of joins doubles the steps taken, which makes 5 rounds at most.
    """
    if ratio < 2:
        raise ValueError("the ratio must be 2 at least")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("best")
    near = near_words(words, shortest, most).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(near, "word", "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    formed = land(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    ), "spelling_forms")
    roots = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        stepped = land(roots.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spelling_roots")
        roots = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            break
    return formed.join(roots, "word", "left").select("word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), "n_near")
