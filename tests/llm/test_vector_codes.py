"""Vector codes against plain integers."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm import queries
from ledgerline.llm import vector_codes as vc
from ledgerline.llm.queries import op13_vector_codes
from tests.check import compare, duck


def plain(rows, parts=16, entries=64, rounds=2, scale=256):
    """(vec_id, code, error, label_error, digest) of rows (vec_id, vector, label), by comparing with every entry."""
    kept = [(k, v, b) for k, v, b in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    whole = [[math.floor(Fraction(x) * scale) for x in v] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    length = len(whole[order[0]])
    cuts = [i * length // parts for i in range(parts + 1)]
    cut = lambda v: [tuple(v[a:b]) for a, b in zip(cuts, cuts[1:])]
    split = [cut(v) if len(v) == length else None for v in whole]
    books = [[split[i][p] for i in order if split[i]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            groups = {}
            for own in filter(None, split):
                groups.setdefault(nearest(own[p], book)[1], []).append(own[p])
            new.append([tuple(sum(c) // len(groups[e]) for c in zip(*groups[e])) if e in groups else old for e, old in enumerate(book)])
        books = new
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    found = [[nearest(own[p], books[p]) for p in range(parts)] if own else None for own in split]
    errors = [sum(d for d, _ in f) if f else None for f in found]
    by_label = {}
    for (_, _, label), error in zip(kept, errors):
        by_label.setdefault(label, []).append(error)
    total = {b: sum(e for e in own if e is not None) if any(e is not None for e in own) else None for b, own in by_label.items()}
    return [(k, "".join(f"{i:02x}" for _, i in f) if f else None, e, total[b], digest) for (k, _, b), f, e in zip(kept, found, errors)]


def coded(spark, rows, **options):
    table = spark.createDataFrame([(k, v, b, "x", 1) for k, v, b in rows], "vec_id long, embedding array<double>, label int, code string, error int")
    return sorted(map(tuple, vc.coded(table, **options).collect()), key=repr)


def random_rows(seed, n, length, coarse):
    pick = np.random.default_rng(seed)
    vectors = pick.normal(size=(n, length))
    if coarse:  # many equal distances
        vectors = np.round(vectors * 2) / 256
    return [(i, v.tolist(), int(i % 5) if i % 7 else None) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("coarse", [False, True])
def test_random_vectors(spark, coarse):
    rows = random_rows(1, 700, 64, coarse)
    assert coded(spark, rows) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("size", [1, 9, 64, 256])
def test_tree_finds_the_first_nearest_entry(size):
    pick = np.random.default_rng(size)
    for spread in (2, 6, 1000, 1 << 23):
        book = pick.integers(-spread, spread + 1, (size, 3))
        queries = np.concatenate([pick.integers(-spread, spread + 1, (500, 3)), book])
        squares = ((queries[:, None] - book[None]) ** 2).sum(-1)
        index, best = vc.Tree(book).nearest(queries)
        assert (best == squares.min(1)).all() and (index == squares.argmin(1)).all()


def test_trees_leave_out_subtrees(monkeypatch):
    pick = np.random.default_rng(4)
    book = (pick.integers(0, 8, (256, 1)) * 10_000 + pick.integers(0, 50, (256, 4))).astype(np.int64)
    tree, measured = vc.Tree(book), []
    kept = vc.Tree._measure
    monkeypatch.setattr(vc.Tree, "_measure", lambda self, own, q, at, *rest: measured.append(len(own) * len(at)) or kept(self, own, q, at, *rest))
    tree.nearest(book)
    assert sum(measured) < 0.5 * 256 * 256


def test_left_out_ties_and_odd_rows(spark):
    rows = random_rows(2, 90, 32, True)
    nan, inf = float("nan"), float("inf")
    rows += [(200, None, 1), (201, [None] + [0.0] * 31, 1), (202, [nan] * 32, 1), (203, [-inf] + [0.0] * 31, 2), (-9, [inf] * 32, 2)]
    rows += [(5, rows[5][1], 3), (5, rows[6][1], 3), (None, [0.25] * 32, None), (None, [0.25] * 32, None)]
    rows += [(300, [1.0] * 31, 4), (301, [], 9), (302, [-0.0] * 32, 4)]
    assert coded(spark, rows) == sorted(plain(rows), key=repr)


def test_components_of_any_size(spark):
    rows = random_rows(3, 40, 16, False) + [(50, [1e6] * 16, 1), (51, [-3e7] + [1e5] * 15, 1), (-1, [1e12, -1e12] * 8, 2), (52, [1e30] * 16, 3), (53, [-1e300] * 16, 4)]
    want = [(k, c, e if e < 1 << 63 else None, t, d) for k, c, e, t, d in plain(rows)]
    totals = {k: t for k, _, _, t, _ in want}
    got = coded(spark, rows)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in sorted(want, key=repr)]
    assert all(r[3] == totals[r[0]] for r in got if r[0] in (50, 51))


def test_few_vectors_short_vectors_and_none(spark):
    for rows in (random_rows(5, 3, 16, False), random_rows(6, 30, 5, True), random_rows(7, 70, 37, True), [(1, [], None)], [(1, None, 2)]):
        assert coded(spark, rows) == sorted(plain(rows), key=repr)
    assert coded(spark, []) == []


def test_many_labels(spark):
    rows = [(i, i % 3 if i % 4 else i + 10, 2 * i) for i in range(400)]
    found = spark.createDataFrame([(k, None if b == 13 else str(b), "c", e) for k, b, e in rows], "vec_id long, label string, code string, error long")
    wide = sorted(map(tuple, vc._with_label_errors(found).select("vec_id", "label_error").collect()))
    assert wide == sorted(map(tuple, vc._with_label_errors(found, 8).select("vec_id", "label_error").collect())) and len(wide) == 400


def test_query_over_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, op13_vector_codes(spark, folder).collect())) == sorted(plain(rows))


@pytest.mark.parametrize("key", ["op12_spellings", "op13_vector_codes"])
def test_sql_over_the_given_tables(spark, key):
    folder = "/root/testdata/sf0.001"
    same_names, got, want, _, _ = compare(spark, duck(folder), folder, key, queries.queries()[key], queries.oracle_sql()[key])
    assert same_names and got == want and got
