"""Fuzzy line dedup: MinHash signatures of character shingles, banding, exact check, union-find.

Lines are compared in lower case with single spaces. A line's character shingles are hashed and
split into bins; each bin's minimum is a MinHash value, an empty bin borrows from the next. Lines that
agree in all values of a band are candidates; with 10 bands of 4 values, 99.5 of 100 pairs at the
similarity itself meet, nearly all above it. Of the lines of a band those are candidates whose set sizes and
sketches leave the similarity possible (``near_sets``). Each line's nearest are checked exactly first and joined into
components, then what still lies across components; of each component the first line (doc_id, place in the document) stays.

Blank lines are no lines: they stay, and null and empty texts stay as they are. A document all of
whose lines go is dropped; a row that is repeated stays once. A null doc_id comes last.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import strip
from ledgerline.llm.arrays import mixed, powers
from ledgerline.llm.arrays import _BASE, _INVERSE
from ledgerline.llm.linking import SKETCH, bitmap, components, marked
from ledgerline.llm.near_sets import cells, near_pairs, widths
from ledgerline.llm.shipping import mapped
from ledgerline.sources.landing import forget, land

BANDS, ROWS = 10, 4
#: Characters in a shingle, and the similarity in hundredths. One changed inner character replaces a shingle for each
#: of its places: with 4, lines from about 40 characters on stay linked then.
SHINGLE, PERCENT = 4, 80
#: Rounds in which drawn pairs of a cell with too many are checked, before all that are left.
DEALS = 2

#: Lines a task remembers to send their bands once.
_REMEMBERED = 1 << 17
_CODES = 300_000
_EMPTY = np.uint32(0xFFFFFFFF)
_LETTERS = mixed(np.arange(1, 65537, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def plain(line: str) -> str:
    """A line as it is compared: lower case, single spaces."""
    return " ".join(line.lower().split())


def _values(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value for each code point of all lines, and where each line begins and ends."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.zeros(len(lines) + 1, np.int64)
    np.cumsum([len(x) for x in lines], out=offsets[1:])
    values = _LETTERS[np.minimum(codes, 65535)]
    far = codes > 65535
    if far.any():
        values[far] = mixed(codes[far].astype(np.uint64))
    return values, offsets


def _windows(values: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of all shingles; a line shorter than k is one shingle."""
    sizes = np.diff(offsets)
    counts = np.maximum(sizes - k + 1, (sizes > 0).astype(np.int64))
    line = np.repeat(np.arange(len(sizes)), counts)
    whole = values[: max(0, len(values) - k + 1)].copy()
    inside = np.ones(len(values), bool)
    for i in range(1, k):
        whole += values[i : i + len(whole)] * powers(_BASE, k)[i]
        before = offsets[1:] - i
        inside[before[before >= 0]] = False
    out = whole[inside[: len(whole)]]
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    if len(short):
        single = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            has = sizes[short] > i
            single[has] += values[offsets[short[has]] + i] * powers(_BASE, k)[i]
        at = np.zeros(len(line), bool)
        at[(np.cumsum(counts) - counts)[short]] = True
        both = np.empty(len(line), np.uint64)
        both[at], both[~at] = single, out
        out = both
    return line, mixed(out)


def line_ids(lines: list[str]) -> np.ndarray:
    """A 64-bit digest of each line."""
    return np.frombuffer(b"".join([hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest() for x in lines]), np.int64)


def bands(lines: list[str], k: int = SHINGLE) -> np.ndarray:
    """The band keys of each line."""
    return _bands(*_windows(*_values(lines), k), len(lines))


def _bands(line: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    bins = BANDS * ROWS
    places = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    least = np.full(n * bins, _EMPTY, np.uint32)
    np.minimum.at(least, line * bins + places.astype(np.int64), (hashes & np.uint64(0xFFFFFFFE)).astype(np.uint32))
    least = least.reshape(n, bins)
    holes = np.flatnonzero((least == _EMPTY).any(1))
    part = least[holes]
    for _ in range(bins):
        empty = part == _EMPTY
        if not empty.any():
            break
        part = np.where(empty, np.roll(part, -1, axis=1) & np.uint32(0xFFFFFFFF), part)
    least[holes] = part
    grouped = least.reshape(n, BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
    for i in range(ROWS):
        key = mixed(key ^ grouped[:, :, i]) + np.uint64(i)
    return mixed(key).view(np.int64)


def set_sizes(lines: list[str], k: int, words: int = SKETCH) -> tuple[np.ndarray, np.ndarray]:
    """How many different shingles each line has, and the sketch of these: whether an even or odd number falls on a bit."""
    line, codes = _distinct(*_windows(*_values(lines), k), len(lines))
    return np.bincount(line, minlength=len(lines)).astype(np.int32), _sketches(line, codes, np.full(len(lines), words)).view(np.int64).reshape(-1, words)


def _distinct(line: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each (line, hash) once, in order. One number for both, which loses the hash's last bits (10 for a thousand lines), sorts many times as fast."""
    low = np.uint64(max(1, (n - 1).bit_length()))
    both = (line.astype(np.uint64) << (np.uint64(64) - low)) | (hashes >> low)
    both.sort()
    first = np.ones(len(both), bool)
    first[1:] = both[1:] != both[:-1]
    both = both[first]
    return (both >> (np.uint64(64) - low)).astype(np.int64), both << low


def _sketches(line: np.ndarray, hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The sketches of sets one after another, each of its own number of words (a power of two)."""
    places, bits = hashes >> np.uint64(32), np.zeros(int(words.sum()), np.uint64)
    at = (np.cumsum(words) - words)[line] + ((places >> np.uint64(6)).astype(np.int64) & (words - 1)[line])
    np.bitwise_xor.at(bits, at, np.uint64(1) << (places & np.uint64(63)))
    return bits


def _split(column: pa.Array):
    """(rows, the text and place of each line that is not blank, in runs of about 300,000 characters)."""
    texts, start = column.fill_null(""), 0
    while start < len(texts):
        stop, n, lines, rows, places = start, 0, [], [], []
        while stop < len(texts) and n < _CODES:
            text = texts[stop].as_py()
            for place, line in enumerate(text.split("\n")):
                if line := plain(line):
                    lines.append(line)
                    rows.append(stop)
                    places.append(place)
            stop, n = stop + 1, n + len(text)
        if lines:
            yield np.array(rows), np.array(places, np.int32), lines
        start = stop


def occurrences(texts: DataFrame, k: int) -> DataFrame:
    """doc_id, tid, place, line (its id) of each line, with its band keys, n (size of its shingle set) and the set's sketch where a task sees it first."""

    def made(batches):
        seen: set[int] = set()
        for batch in batches:
            for rows, places, lines in _split(batch.column("text")):
                ids = line_ids(lines)
                fresh = []
                for i, x in enumerate(ids.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh.append(i)
                if len(seen) > _REMEMBERED:
                    seen.clear()
                words = [lines[i] for i in fresh]
                keys, sizes, bits = np.zeros((0, BANDS), np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
                if words:
                    windows = _windows(*_values(words), k)
                    keys, (line, codes) = _bands(*windows, len(words)), _distinct(*windows, len(words))
                    sizes = np.bincount(line, minlength=len(words))
                    bits = _sketches(line, codes, widths(sizes))
                counts, own = np.zeros(len(lines), np.int64), np.full(len(lines), -1)
                counts[fresh], own[fresh] = BANDS, np.arange(len(fresh))
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                at, own = pa.array(rows), pa.array(own, mask=own < 0)
                ends = np.concatenate([[0], np.cumsum(8 * widths(sizes))]).astype(np.int32)
                sketches = pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(bits)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("tid").take(at), pa.array(places), pa.array(ids), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1))),
                     pa.array(sizes.astype(np.int32)).take(own), sketches.take(own)],
                    ["doc_id", "tid", "place", "line", "bands", "n", "sketch"],
                )

    return mapped(texts.select("doc_id", "tid", "text"), made, "doc_id long, tid long, place int, line long, bands array<long>, n int, sketch binary")


def line_texts(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """line, words of the lines in ids (line), from one pass over all texts."""
    sent = texts.sparkSession.sparkContext.broadcast(bitmap(ids))

    def wanted(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, _, lines in _split(batch.column(0)):
                found, fresh = line_ids(lines), []
                for i in np.flatnonzero(marked(sent.value, found)).tolist():
                    if (x := int(found[i])) not in seen:
                        seen.add(x)
                        fresh.append(i)
                if len(seen) > _REMEMBERED:
                    seen.clear()
                if fresh:
                    yield pa.RecordBatch.from_arrays([pa.array(found[fresh]), pa.array([lines[i] for i in fresh])], ["line", "words"])

    return mapped(texts.select("text"), wanted, "line long, words string").join(ids, "line", "left_semi").dropDuplicates(["line"])


def verified(pairs: DataFrame, found: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of line ids whose shingle sets are similar enough; found: line and words."""
    both = pairs.join(found.toDF("a", "text_a"), "a").join(found.toDF("b", "text_b"), "b")

    def similar(batches):
        for batch in batches:
            ends = np.cumsum([len(x) + len(y) for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())])
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, min(start + 512, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + 2 * _CODES, "right"))))
                part = batch.slice(start, stop - start)
                names, first, at = np.unique(np.concatenate([part.column("a").to_numpy(), part.column("b").to_numpy()]), return_index=True, return_inverse=True)
                words = pa.concat_arrays([part.column("text_a"), part.column("text_b")]).take(pa.array(first)).to_pylist()
                line, hashes = _distinct(*_windows(*_values(words), k), len(words))
                sizes = np.bincount(line, minlength=len(words))
                # The hashes of both sets of each pair, once more in order of pair and hash: those that both have stand side by side.
                each, begins = sizes[at], (np.cumsum(sizes) - sizes)[at]
                pair = np.repeat(np.tile(np.arange(len(part)), 2), each)
                own = hashes[np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(begins, each)]
                codes = (pair.astype(np.uint64) << np.uint64(54)) | (own >> np.uint64(10))
                codes.sort()
                common = np.bincount((codes[1:][codes[1:] == codes[:-1]] >> np.uint64(54)).astype(np.int64), minlength=len(part))
                total = each[: len(part)] + each[len(part) :]
                yield part.select(["a", "b"]).filter(pa.array(100 * common >= percent * (total - common)))
                start = stop

    return mapped(both, similar, "a long, b long")


def linked(lines: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(line, root) of lines that link with another one. lines: landed ``occurrences`` of texts."""
    sets = lines.where("n is not null").select(F.col("line").alias("id"), "bands", "n", "sketch")
    met = cells(sets.select(F.explode("bands").alias("key"), "id", "n"), percent)
    sets = sets.drop("bands")
    near = land(near_pairs(met.join(sets, "id"), percent), "near_lines")
    pairs, dense = _found(near)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct()
    found = land(line_texts(texts, ids), "line_texts")
    links = land(verified(pairs.where("best"), found, k, percent), "linked")
    roots = land(components(links), "roots")
    placed = pairs.where("not best").join(roots.toDF("a", "x"), "a", "left").join(roots.toDF("b", "y"), "b", "left")
    across = land(placed.where("coalesce(x, a) <> coalesce(y, b)").select("a", "b"), "line_pairs")
    links = links.union(land(verified(across, found, k, percent), "linked"))
    turn = 0
    while not dense.isEmpty():
        turn, roots = turn + 1, land(components(links), "roots")
        rows = met.join(dense, F.col("cell") == F.col("dense"), "left_semi").join(sets, "id").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        pairs, dense = _found(land(near_pairs(rows, percent, turn, turn > DEALS), "near_lines"))
        links = links.union(land(verified(pairs, found, k, percent), "linked"))
    out = land(components(links).toDF("line", "root"), "line_roots")
    for table in (met, found):
        forget(table)
    return out


def _found(near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each pair once, and the cells with too many."""
    pairs = land(near.where("a is not null").groupBy("a", "b").agg(F.max("best").alias("best")), "line_pairs")
    dense = land(near.where("dense is not null").select("dense").distinct(), "dense_cells")
    forget(near)
    return pairs, dense


def dropped_lines(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, tid, places (of lines that go) of documents that lose lines; landed."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).select("doc_id", F.xxhash64("text").alias("tid"), "text")
    lines = land(occurrences(texts, k), "lines")
    roots = linked(lines, texts, k, percent)
    placed = lines.select("doc_id", "tid", "place", "line").join(roots, "line", "left").withColumn("root", F.coalesce("root", "line")).drop("line")
    named = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tid", "place")
    firsts = placed.groupBy("root").agg(F.min(named).alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    gone = placed.join(firsts, "root").where(named != F.col("first"))
    out = land(gone.groupBy("doc_id", "tid").agg(F.collect_set("place").alias("places")), "gone_lines")
    forget(lines)
    return out


def once_each(docs: DataFrame) -> DataFrame:
    """docs with one row of those alike in doc_id and text; rows without lines all stay.

    All lines of a repeated row stand in the row before. Only rows that are repeated are shuffled with their texts.
    """
    tid = F.xxhash64(F.coalesce("text", F.lit("")))
    keys = docs.where(strip(F.col("text")) != "").select(F.col("doc_id").cast("long").alias("again_id"), tid.alias("again_tid"))
    again = land(keys.groupBy("again_id", "again_tid").count().where("count > 1").drop("count"), "repeated_rows")
    rule = (tid == F.col("again_tid")) & F.col("doc_id").cast("long").eqNullSafe(F.col("again_id"))
    repeated = docs.join(again, rule).dropDuplicates(["again_id", "again_tid"])
    return docs.join(again, rule, "left_anti").union(repeated.select([F.col(f"`{c}`") for c in docs.columns]))


def without_repeats(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs with one line of each component left; n_chars, if there, follows the text. Columns are those of docs."""
    gone = dropped_lines(docs, k, percent).toDF("gone_id", "gone_tid", "gone_places")
    tid = F.xxhash64(F.coalesce("text", F.lit("")))
    rule = (tid == F.col("gone_tid")) & F.col("doc_id").cast("long").eqNullSafe(F.col("gone_id"))
    joined = once_each(docs).join(gone, rule, "left").drop("gone_id", "gone_tid")
    at, names = docs.columns.index("text"), docs.columns
    count = names.index("n_chars") if "n_chars" in names else None

    def cut(batches):
        for batch in batches:
            columns = list(batch.columns[: len(names)])
            texts, keep = columns[at].to_pylist(), [True] * batch.num_rows
            for i, places in enumerate(columns_gone := batch.column(len(names)).to_pylist()):
                if places:
                    off = set(places)
                    left = [x for p, x in enumerate(texts[i].split("\n")) if p not in off]
                    texts[i], keep[i] = "\n".join(left), any(plain(x) for x in left)
            columns[at] = pa.array(texts, pa.string())
            if count is not None:
                own = [n if not places else len(t) for n, places, t in zip(columns[count].to_pylist(), columns_gone, texts)]
                columns[count] = pa.array(own, columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    return mapped(joined, cut, docs.schema)
