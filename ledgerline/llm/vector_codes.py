"""Vector codes: each part of a vector is named by the nearest entry of the part's codebook, found in a tree of distances.

Components become integers, floor(scale * x), and all distances, sums and ties are exact in them. The
codebook of a part starts as that part of the vectors with the smallest ids; each round assigns every
part to its nearest entry (squared Euclidean distance, ties to the lower index) and replaces an entry by
the floors of its parts' means. Sums are made inside tasks and added up by a shuffle; only codebooks,
whose size does not depend on the data, pass the driver.

The entries of a codebook are a geometric near-neighbour access tree: a node has a few split points, far
from each other, every other entry belongs to the child of the nearest one, and the node stores for each
split point and child the least and the largest distance between the split point and the child's
entries. A query measures its distance to the split points. If one says that all of a child lies farther
than the nearest entry so far (by the triangle inequality, strictly, with distances rounded so that a
child is rather kept), the child is left out with all below it. What is left is measured in integers, so
entries equally near are told apart exactly. Many queries walk the tree at once.

Rows whose vector is null or holds a null or non-finite component are left out. The vector with the
smallest id (ties: the smaller vector; null ids last) sets the length; a vector of another length has a
null code and error. A length that the parts do not divide gives parts as equal as possible. Repeated
rows count as often as they are there; fewer vectors than entries give so many entries. Components of
any finite size are exact; an error beyond a long is null, and so is a label's sum. Empty tables have no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shipping import mapped
from ledgerline.sources.landing import fits, land

#: Split points of a node, and entries that are measured one by one.
SPLITS, LEAF = 8, 10
#: Distances are rounded by this share, far more than their own error.
MARGIN = 2.0**-46
#: Integers below this are computed in 64 bits (parts of up to 1,024 components), larger ones in Python's integers.
PLAIN = 1 << 24
#: Bits of a sum in one row, and labels whose sums are broadcast.
LIMB, BROADCAST_LABELS = 56, 500_000

_LONG = 1 << 63
_SUMS = "part int, entry int, place int, limb int, total long"
_CODES = "vec_id long, label string, code string, error long"


class Tree:
    """The entries of one codebook (integers, one row an entry), as a tree."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = self._node(np.arange(len(entries)))

    def _node(self, own: np.ndarray):
        if len(own) <= LEAF:
            return own
        # Far from each other: each next split point is the entry farthest from those chosen.
        near = self._squares(own, own[:1])[:, 0]
        splits = [own[0]]
        while len(splits) < SPLITS and near.max() > 0:
            splits.append(own[int(near.argmax())])
            near = np.minimum(near, self._squares(own, np.array(splits[-1:]))[:, 0])
        if len(splits) == 1:
            return own  # all alike
        splits = np.array(splits)
        squares = self._squares(own, splits)
        child = squares.argmin(1)
        distance = np.sqrt(squares.astype(np.float64))
        rest = ~np.isin(own, splits)
        children, low, high = [], [], []
        for j in range(len(splits)):
            members = rest & (child == j)
            if members.any():
                low.append(distance[members].min(0) * (1 - MARGIN))
                high.append(distance[members].max(0) * (1 + MARGIN))
                children.append((j, self._node(own[members])))
        return splits, children, np.array(low), np.array(high)

    def _squares(self, some: np.ndarray, others: np.ndarray) -> np.ndarray:
        return ((self.entries[some][:, None] - self.entries[others][None]) ** 2).sum(-1)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each query, ties to the lower index."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.entries))
        self._visit(self.root, queries, np.arange(len(queries)), best, index)
        return index, best

    def _measure(self, own: np.ndarray, queries: np.ndarray, at: np.ndarray, best: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Squared distances to some entries; the nearest so far is brought up to date."""
        squares = ((queries[at][:, None] - self.entries[own][None]) ** 2).sum(-1)
        least = squares.min(1)
        named = np.where(squares == least[:, None], own, len(self.entries)).min(1)
        better = (least < best[at]) | ((least == best[at]) & (named < index[at]))
        best[at[better]], index[at[better]] = least[better], named[better]
        return squares

    def _visit(self, node, queries, at, best, index) -> None:
        if isinstance(node, np.ndarray):
            self._measure(node, queries, at, best, index)
            return
        splits, children, low, high = node
        squares = self._measure(splits, queries, at, best, index)
        distance = np.sqrt(squares.astype(np.float64))
        first = squares.argmin(1)
        for turn in (True, False):  # the child of the nearest split point first, then the others
            for k, (j, below) in enumerate(children):
                mine = np.flatnonzero((first == j) == turn)
                radius = np.sqrt(best[at[mine]].astype(np.float64))[:, None] * (1 + MARGIN)
                out = (distance[mine] * (1 - MARGIN) - radius > high[k]) | (distance[mine] * (1 + MARGIN) + radius < low[k])
                kept = mine[~out.any(1)]
                if len(kept):
                    self._visit(below, queries, at[kept], best, index)


def integers(vector: list[float], scale: int) -> list[int]:
    """floor(scale * x) of each component, exact for any finite x; scale is a power of two."""
    return [int(x) * scale if abs(x) >= 1 << 53 else int(np.floor(x * scale)) for x in vector]


def bounds(length: int, parts: int) -> list[int]:
    return [i * length // parts for i in range(parts + 1)]


class Coder:
    """Assigns vectors to codebooks: ``books[part][entry]`` is a list of integers."""

    def __init__(self, books: list[list[list[int]]], scale: int):
        self.books, self.scale = books, scale
        self.cuts = np.cumsum([0, *[len(book[0]) for book in books]]).tolist()
        self.plain = all(abs(x) < PLAIN for book in books for entry in book for x in entry)
        self.trees = [Tree(np.array(book, np.int64).reshape(len(book), -1)) for book in books] if self.plain else []

    def coded(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Runs of (rows, integers, indexes a part, errors) for the vectors of the right length; none for others."""
        length = self.cuts[-1]
        ends = column.offsets.to_numpy()
        values = column.values.to_numpy(zero_copy_only=False)
        right = np.flatnonzero(np.diff(ends) == length)
        vectors = values[ends[right][:, None] + np.arange(length)] if length else np.zeros((len(right), 0))
        small = (np.abs(vectors) * self.scale < PLAIN - 1).all(1) if self.plain else np.zeros(len(right), bool)
        if small.any():
            whole = np.floor(vectors[small] * self.scale).astype(np.int64)
            found = [tree.nearest(whole[:, a:b]) for tree, a, b in zip(self.trees, self.cuts, self.cuts[1:])]
            yield right[small], whole, np.stack([f[0] for f in found], 1), np.sum([f[1] for f in found], 0)
        for row, vector in zip(right[~small], vectors[~small]):
            whole = integers(vector.tolist(), self.scale)
            found = [self._exact(book, whole[a:b]) for book, a, b in zip(self.books, self.cuts, self.cuts[1:])]
            yield np.array([row]), np.array([whole], object), np.array([[i for _, i in found]]), np.array([sum(d for d, _ in found)], object)

    @staticmethod
    def _exact(book: list[list[int]], part: list[int]) -> tuple[int, int]:
        return min((sum((x - y) ** 2 for x, y in zip(part, entry)), i) for i, entry in enumerate(book))


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(limb, signed number below 2**LIMB) that add up to a value."""
    sign, rest, limb = (-1, -value, 0) if value < 0 else (1, value, 0)
    while rest:
        if rest & ((1 << LIMB) - 1):
            yield limb, sign * (rest & ((1 << LIMB) - 1))
        rest, limb = rest >> LIMB, limb + 1


def _lists(table: DataFrame, vector: str) -> DataFrame:
    return table.select(F.col(vector).alias("vector"))


def _updated(kept: DataFrame, books: list[list[list[int]]], scale: int) -> list[list[list[int]]]:
    """Codebooks after one round: entries replaced by the floors of the means of what is nearest to them."""

    def summed(batches):
        coder, sums, counts = Coder(books, scale), {}, {}
        for batch in batches:
            for _, whole, indexes, _ in coder.coded(batch.column(0)):
                for part, (a, b) in enumerate(zip(coder.cuts, coder.cuts[1:])):
                    for entry in np.unique(indexes[:, part]).tolist():
                        mine = whole[indexes[:, part] == entry, a:b]
                        own = sums.setdefault((part, entry), [0] * (b - a))
                        sums[part, entry] = [x + int(y) for x, y in zip(own, mine.sum(0))]
                        counts[part, entry] = counts.get((part, entry), 0) + len(mine)
        rows = [(*key, -1, 0, n) for key, n in counts.items()]
        rows += [(*key, place, *limb) for key, own in sums.items() for place, value in enumerate(own) for limb in _limbs(value)]
        if rows:
            kinds = [pa.int32()] * 4 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in _SUMS.split(", ")])

    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    rows = mapped(_lists(kept, "vector"), summed, _SUMS).groupBy("part", "entry", "place", "limb").agg(total).collect()
    counts = {(r["part"], r["entry"]): int(r["total"]) for r in rows if r["place"] < 0}
    sums: dict[tuple[int, int, int], int] = {}
    for r in rows:
        if r["place"] >= 0:
            at = r["part"], r["entry"], r["place"]
            sums[at] = sums.get(at, 0) + (int(r["total"]) << (LIMB * r["limb"]))
    return [
        [[sums.get((p, e, i), 0) // n for i in range(len(entry))] if (n := counts.get((p, e))) else entry for e, entry in enumerate(book)]
        for p, book in enumerate(books)
    ]


def _finite(vector: Column) -> Column:
    """Whether a vector has finite components only."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))


def coded(
    table: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label",
    parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``: one row for each vector that is kept.

    ``code`` is the index of each part's entry, two hex digits a part; ``error`` the squared distances
    summed over parts, ``label_error`` its sum over rows of the same label (nulls together). The digest
    is of all final entries' components by part, entry and place, as decimal numbers joined by commas.
    """
    if not 1 <= entries <= 256 or scale < 1 or scale & (scale - 1):
        raise ValueError("a codebook has 1 to 256 entries, and the scale is a power of two")
    kept = table.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    kept = kept.where(F.col("vector").isNotNull() & _finite(F.col("vector")))
    seeds = [r["vector"] for r in kept.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()]
    length = len(seeds[0]) if seeds else 0
    cuts = bounds(length, parts)
    whole = [integers(s, scale) for s in seeds if len(s) == length]
    books = [[own[a:b] for own in whole] for a, b in zip(cuts, cuts[1:])]
    if seeds:
        for _ in range(rounds):
            books = _updated(kept, books, scale)

    def named(batches):
        coder = Coder(books, scale) if seeds else None
        for batch in batches:
            codes, errors = np.full(batch.num_rows, None), np.full(batch.num_rows, None)
            for rows, _, indexes, error in coder.coded(batch.column(2)):
                # A code is the bytes of its indexes in hex, cut from one text of all rows.
                text = np.ascontiguousarray(indexes, np.uint8).tobytes().hex()
                codes[rows] = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
                errors[rows] = [int(e) if e < _LONG else None for e in error]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    found = land(mapped(kept, named, _CODES), "vector_codes")
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    summed = _with_label_errors(found)
    return summed.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _with_label_errors(found: DataFrame, broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """Each row with the sum of its label's errors.

    So few labels that their sums can be broadcast meet the rows where they are. Of more labels, those
    with a fair share of all rows are so few again, and only the rows of the others are shuffled.
    """
    sums = land(found.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("n")), "label_errors")

    def met(rows, own):
        own = own.select(F.col("label").alias("of"), "label_error")
        return rows.join(own, F.col("label").eqNullSafe(F.col("of")), "inner").drop("of")

    if fits(sums, broadcast_labels):
        return met(found, F.broadcast(sums))
    # A label with this many rows is one of broadcast_labels at the most.
    hot = sums.where(F.col("n") > found.count() // broadcast_labels)
    names = F.broadcast(hot.select("label"))
    rest = found.join(names, found["label"].eqNullSafe(names["label"]), "left_anti")
    return met(found, F.broadcast(hot)).unionByName(met(rest, sums.join(hot.select(F.col("label").alias("of")), F.col("label").eqNullSafe(F.col("of")), "left_anti")))
