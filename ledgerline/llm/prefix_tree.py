"""Chat formatting over a prefix tree: conversations that begin alike share their first turns' tokens.

A turn is written ``[INST]role[/INST]text</s>``; such strings inside roles and texts get a backslash more
after their first character, which reading takes away again. Turns of all conversations form a tree:
a node is a turn together with all turns before it. The tree is packed depth first into one token
sequence in which every node stands once. Conversations in order of their node paths are its leaves
in that order, so each distinct conversation adds one segment: its turns after those it shares with an
earlier one. A segment has its place in the sequence, position ids that go on from its parent, a loss
mask (texts of the assistant) and the intervals of its ancestors, all that its tokens may attend to
besides the segment's own earlier tokens.

The tree is built from hashes and token counts alone; texts are shuffled once, to their conversation,
where they become tokens after the last shuffle, and what a reader needs of its ancestors' tokens goes to
it as text with the marked spans. Node keys are running hashes over ordered turns; places come from sums
per range of the sorted leaves, so neither a common first turn nor a common conversation gathers in one
task. A conversation with its own turns is one record.

Rows of a conversation are ordered by turn (null first), role, hash of the text; repeated rows are turns of
their own. Null roles and texts are empty, null conv_ids are one conversation. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.shipping import mapped
from ledgerline.sources.landing import land

OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
#: Control strings with any backslashes after their first character.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
#: Tokens: control strings, words, white space, single characters; together the whole text.
TOKEN = r"(?s)\[/?INST\]|</?s>|[\p{L}\p{M}\p{N}_]+|[ \t\r\n]+|."
#: Roles whose texts are trained on.
TRAINED = ("assistant",)

_TURN = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.S)
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def restored(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escaped(role), F.lit(CLOSE))


def _ordering(turn: Column, role: Column, text: Column) -> list[Column]:
    """What the rows of a conversation are ordered by."""
    return [turn.isNotNull().alias("known"), turn.alias("turn"), role.alias("role"), F.xxhash64(F.lit(1), text).alias("h"), F.xxhash64(F.lit(2), text).alias("g")]


def _rows(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )


def paths(conversations: DataFrame) -> DataFrame:
    """conv (its key) and path: for each turn in order a, b (hashes of the turns up to here) and n, its tokens."""
    size = F.regexp_count(F.concat(_head(F.col("role")), escaped(F.col("text")), F.lit(END)), F.lit(TOKEN))
    rows = _rows(conversations).select("conv", *_ordering(F.col("turn"), F.col("role"), F.col("text")), size.alias("n"))
    order = Window.partitionBy("conv").orderBy("known", "turn", "role", "h", "g")
    rows = rows.withColumn("i", F.row_number().over(order))
    so_far = Window.partitionBy("conv").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashed = lambda salt: F.bit_xor(F.xxhash64(F.lit(salt), "i", "role", "h", "g")).over(so_far)
    rows = rows.select("conv", "i", hashed(1).alias("a"), hashed(2).alias("b"), "n")
    path = F.array_sort(F.collect_list(F.struct("i", "a", "b", "n")))
    return rows.groupBy("conv").agg(F.transform(path, lambda x: F.struct(x["a"], x["b"], x["n"])).alias("path"))


def places(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(placed, leaves) of landed paths.

    placed: segment, conv (whose turns it has), first (how many of them it shares), tree (the segment that begins it),
    start, size, position, attend. leaves: segment, leaf (a, b of the last turn).
    """
    last = F.element_at("path", -1)
    leaf = F.struct(last["a"].alias("a"), last["b"].alias("b"))
    firsts = found.groupBy(leaf.alias("leaf")).agg(F.min("conv").alias("conv"))
    ranges = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = found.join(firsts.select("conv"), "conv", "left_semi").repartitionByRange(ranges, "path").sortWithinPartitions("path")
    ordered = land(ordered.withColumn("segment", F.monotonically_increasing_id()), "leaves")

    nodes = ordered.select("segment", F.posexplode("path").alias("i", "node")).select("segment", "i", "node.a", "node.b", "node.n")
    owners = nodes.groupBy("a", "b").agg(F.min("segment").alias("owner"))
    # A segment's own turns are its last; what it shares with an owner begins where that owner's own turns begin.
    pieces = nodes.join(owners, ["a", "b"]).groupBy("segment", "owner").agg(F.min("i").alias("first"), F.sum("n").alias("size"))
    pieces = land(pieces, "pieces")
    own = pieces.where("owner = segment").select("segment", "first", "size")
    sizes = own.join(pieces.where("first = 0").select("segment", F.col("owner").alias("tree")), "segment").withColumn("range", F.shiftright("segment", 33))

    # Starts: sums per range of leaves, then within the range.
    by_range = sizes.groupBy("tree", "range").agg(F.sum("size").alias("size"))
    before = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    by_range = by_range.select("tree", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    before = Window.partitionBy("tree", "range").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("inner", F.coalesce(F.sum("size").over(before), F.lit(0))).join(by_range, ["tree", "range"])
    starts = land(starts.select("segment", "tree", "first", (F.col("base") + F.col("inner")).alias("start"), "size"), "starts")

    above = pieces.where("owner <> segment").join(starts.select(F.col("segment").alias("owner"), "start"), "owner")
    listed = F.array_sort(F.collect_list(F.struct("first", F.col("owner").alias("segment"), "start", (F.col("start") + F.col("size")).alias("end"))))
    above = above.groupBy("segment").agg(F.transform(listed, lambda x: F.struct(x["segment"], x["start"], x["end"])).alias("attend"), F.sum("size").alias("position"))
    kind = "array<struct<segment:bigint,start:bigint,end:bigint>>"
    placed = starts.join(above, "segment", "left").join(ordered.select("segment", "conv"), "segment").select(
        "segment", "conv", "first", "tree", "start", "size", F.coalesce("position", F.lit(0)).alias("position"), F.coalesce(F.col("attend").cast(kind), F.array().cast(kind)).alias("attend"),
    )
    return land(placed, "places"), ordered.select("segment", leaf.alias("leaf"))


def laid(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segments, members) before turns become tokens.

    segments: tree (its first segment), segment, conv (the conversation whose turns it has), start (place in the
    tree's sequence), size (tokens), position (of its first), attend: the ancestors' intervals (segment, start, end)
    from the root on, and turns: role and text of its own. They lie by conv. members: conv_id, segment (the one
    that ends the conversation). Conversations alike in all turns have one segment.
    """
    found = land(paths(conversations), "paths")
    placed, leaves = places(found)
    gathered = _rows(conversations).groupBy("conv").agg(F.collect_list(F.struct("turn", "role", "text")).alias("rows"))
    ordered = F.array_sort(F.transform("rows", lambda x: F.struct(*_ordering(x["turn"], x["role"], x["text"]), x["text"].alias("text"))))
    segments = gathered.join(placed, "conv").select(
        "tree", "segment", "conv", "start", "size", "position", "attend", F.slice(ordered, F.col("first") + 1, F.size("rows")).alias("turns")
    )
    last = F.element_at("path", -1)
    key = F.when(F.col("conv") != "", F.col("conv").cast("long")).alias("conv_id")
    members = found.select(key, F.struct(last["a"].alias("a"), last["b"].alias("b")).alias("leaf")).join(leaves, "leaf")
    return segments, members.select("conv_id", "segment")


def with_tokens(segments: DataFrame) -> DataFrame:
    """Segments with tokens, loss and position_ids instead of their turns."""
    cut = F.transform("turns", lambda x: F.struct(_tokens(_head(x["role"])).alias("head"), _tokens(escaped(x["text"])).alias("body"), x["role"].isin(*TRAINED).alias("on")))
    tokens = F.flatten(F.transform("cut", lambda x: F.concat(x["head"], x["body"], F.array(F.lit(END)))))
    loss = F.flatten(F.transform("cut", lambda x: F.concat(F.array_repeat(F.lit(False), F.size(x["head"])), F.array_repeat(x["on"], F.size(x["body"])), F.array(F.lit(False)))))
    places = F.sequence("position", F.col("position") + F.col("size") - 1)
    return segments.withColumn("cut", cut).withColumns({"tokens": tokens, "loss": loss, "position_ids": places}).drop("cut", "turns", "size", "position")


def packed(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segments, members): segments laid out in their trees, as tokens with loss, position_ids and attend."""
    segments, members = laid(conversations)
    return with_tokens(segments), members


def _spelled(tokens: pa.ListArray, loss: pa.ListArray) -> list[tuple[str, list[tuple[int, int]]]]:
    """For each row its tokens as one text, and the spans (code points, half open) of neighbouring tokens under the mask."""
    values = tokens.flatten().cast(pa.large_string())
    on = loss.flatten().to_numpy(zero_copy_only=False).astype(np.int8)
    at = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    data = memoryview(values.buffers()[2] or b"") if len(values) else memoryview(b"")
    ends = np.cumsum(np.concatenate(([0], tokens.value_lengths().to_numpy(zero_copy_only=False))))
    out = []
    for lo, hi in zip(ends[:-1], ends[1:]):
        raw = bytes(data[at[lo] : at[hi]])
        flips = np.flatnonzero(np.diff(on[lo:hi], prepend=0, append=0))
        places, text = at[lo + flips] - at[lo], raw.decode()
        if len(text) < len(raw):
            points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
            places = points[places]
        out.append((text, list(zip(places[::2].tolist(), places[1::2].tolist()))))
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SPANS_SQL = "array<struct<start:bigint,end:bigint>>"
#: Rows that are put together at a time in a worker.
_SLICE = 64


def _slices(batches):
    for batch in batches:
        for begin in range(0, batch.num_rows, _SLICE):
            yield batch.slice(begin, _SLICE)


def _spans(rows: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": s, "end": e} for s, e in row] for row in rows], _SPANS)


def _pieces(batches):
    for part in _slices(batches):
        texts, spans = zip(*_spelled(part.column("tokens"), part.column("loss")))
        kept = [part.column(c) for c in ("segment", "start", "end")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), _spans(spans)], ["segment", "start", "end", "text", "spans"])


def _wholes(batches):
    for part in _slices(batches):
        texts, marks = [], []
        for above, own in zip(part.column("above").to_pylist(), _spelled(part.column("tokens"), part.column("loss"))):
            text, spans, at = [], [], 0
            for piece, own_spans in [*((x["text"], [(s["start"], s["end"]) for s in x["spans"]]) for x in above or ()), own]:
                text.append(piece)
                spans.extend((at + s, at + e) for s, e in own_spans)
                at += len(piece)
            texts.append("".join(text))
            marks.append(spans)
        yield pa.RecordBatch.from_arrays([part.column("segment"), pa.array(texts, pa.string()), _spans(marks)], ["segment", "text", "spans"])


def read_back(segments: DataFrame) -> DataFrame:
    """segment, text, spans of the conversation that each laid segment ends, put together by its intervals.

    text is the conversation as formatted, spans are its places under the loss mask (code points, half open).
    Tokens stay where they are: each interval that is asked for is cut out once, by its owner, and goes
    as text to the readers, who are found by their conversation as the owners are.
    """
    wanted = segments.select(F.col("conv").alias("reader"), F.posexplode("attend").alias("k", "piece")).select("reader", "k", "piece.*")
    wanted = land(wanted, "wanted")
    asked = wanted.select("segment", "start", "end").distinct().join(segments.select("segment", "conv"), "segment")
    asked = asked.select("conv", F.col("start").alias("lo"), "end")
    found = with_tokens(segments.join(asked, "conv"))
    cut = lambda c: F.slice(c, (F.col("lo") - F.col("start") + 1).cast("int"), (F.col("end") - F.col("lo")).cast("int")).alias(c)
    found = found.select("segment", F.col("lo").alias("start"), "end", cut("tokens"), cut("loss"))
    found = mapped(found, _pieces, f"segment long, start long, end long, text string, spans {_SPANS_SQL}")
    above = wanted.join(found, ["segment", "start", "end"]).groupBy(F.col("reader").alias("conv"))
    above = above.agg(F.array_sort(F.collect_list(F.struct("k", "text", "spans"))).alias("above"))
    whole = with_tokens(segments).select("conv", "segment", "tokens", "loss").join(above, "conv", "left").drop("conv")
    return mapped(whole, _wholes, f"segment long, text string, spans {_SPANS_SQL}")


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn in a formatted conversation."""
    return [(restored(role), restored(text)) for role, text in _TURN.findall(text)]


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of all conversations, read back from the packed trees."""
    segments, members = laid(conversations)

    def digested(batches):
        for part in _slices(batches):
            rows = []
            for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                whole, own = hashlib.sha256(), parsed(text)
                for role, said in own:
                    whole.update(f"{role}\n{said}\n".encode())
                under = "".join(restored(text[s["start"] : s["end"]]) for s in spans)
                rows.append((len(own), whole.hexdigest(), len(under), hashlib.sha256(under.encode()).hexdigest(), len(text)))
            columns = zip(*rows)
            yield pa.RecordBatch.from_arrays([part.column("segment"), *map(pa.array, columns)], ["segment", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    schema = "segment long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return members.join(mapped(read_back(segments), digested, schema), "segment").drop("segment")
