"""Spelling variants against plain code."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import spellings as sp
from ledgerline.llm.queries import op12_spellings


def plain_vocabulary(rows):
    found = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= 2 and len(w) >= 7}


def is_near(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    short, long = sorted((x, y), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_near(counts):
    """Near words of each word, by words left when one letter goes."""
    holes = {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
            holes.setdefault((-1, w[:i] + w[i + 1 :]), []).append(w)
    near = {w: set() for w in counts}
    for (i, rest), group in holes.items():
        for one in group:
            if i >= 0:
                near[one] |= {two for two in group if two != one}
            elif rest in counts:
                near[one].add(rest)
                near[rest].add(one)
    return near


def plain_variants(counts, ratio=10):
    near = plain_near(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, n, form[w], counts.get(form[w]), root, len(near[w])))
    return rows


def words_of(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def as_rows(table):
    return [(r["word"], r["n"], r["form"], r["form_n"], r["root"], r["n_near"]) for r in table.collect()]


def random_words(seed, n, letters, shortest, longest):
    """Words among which many differ by a letter or two."""
    pick = random.Random(seed)
    words = {"".join(pick.choices(letters, k=pick.randint(shortest, longest))) for _ in range(n // 4)}
    while len(words) < n:
        w = pick.choice(sorted(words)[:50] if pick.random() < 0.1 else tuple(words))
        i = pick.randrange(len(w))
        w = pick.choice((w[:i] + w[i + 1 :], w[:i] + pick.choice(letters) + w[i:], w[:i] + pick.choice(letters) + w[i + 1 :]))
        if len(w) >= shortest:
            words.add(w)
    return {w: int(10 ** pick.uniform(0.4, 5)) for w in sorted(words)}


@pytest.mark.parametrize("c", [7, 8, 12, 40])
def test_block_lookup(c):
    counts = random_words(c, 300, "abé", c, c + 1)
    names = [w for w in counts if len(w) in (c, c + 1)]
    got = sorted(sp.one_edit(names, c, np.zeros(len(names), int)))
    want = sorted((i, j) for i, x in enumerate(names) for j, y in enumerate(names) if len(x) == c and i != j and is_near(x, y))
    assert got == want


def test_blocks_over_several_slices(monkeypatch):
    monkeypatch.setattr(sp, "SET_BYTES", 64)
    test_block_lookup(9)


@pytest.mark.parametrize("most", [sp.MOST, 40, 2])
def test_near_words_with_and_without_large_groups(spark, most):
    counts = random_words(3, 1500, "abcdeß", 7, 11)
    got = [tuple(r) for r in sp.near_words(words_of(spark, counts), most=most).collect()]
    near = plain_near(counts)
    assert len(got) == len(set(got))
    assert set(got) == {(w, counts[w], x, counts[x]) for w in near for x in near[w]}
    assert all(is_near(w, x) for w, _, x, _ in got)


@pytest.mark.parametrize("most", [sp.MOST, 5])
def test_variants(spark, most):
    counts = random_words(5, 1200, "abcdé", 7, 9)
    got = as_rows(sp.variants(words_of(spark, counts), most=most))
    assert len(got) == len(counts) and set(got) == plain_variants(counts)


def test_chains_and_ties(spark):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 300, "aaaabbb": 4000, "aaabbbb": 50_000, "aabbbbb": 600_000, "zzzzzzz": 3, "zzzzzzy": 30, "zzzzzzx": 30, "zzzzzzzz": 29, "alonely": 9}
    got = as_rows(sp.variants(words_of(spark, counts)))
    assert set(got) == plain_variants(counts)
    by_word = {r[0]: r for r in got}
    assert by_word["aaaaaaa"][4] == "aabbbbb" and by_word["zzzzzzz"][2] == "zzzzzzx" and by_word["alonely"] == ("alonely", 9, None, None, "alonely", 0)


def test_very_long_words(spark):
    base = "".join(random.Random(1).choices("abcdefgh", k=20_000))
    counts = {base: 100, base[:9] + "z" + base[10:]: 5, base[:-1]: 7, "q" + base: 2, base[:10_000] + "é" + base[10_000:]: 3, base[::-1]: 4}
    got = as_rows(sp.variants(words_of(spark, counts)))
    assert {(r[1], r[3], r[5]) for r in got} == {(100, None, 4), (5, 100, 1), (7, 100, 1), (2, 100, 1), (3, 100, 1), (4, None, 0)}


def test_vocabulary_of_odd_texts(spark):
    rows = [(1, "Wonderful wonderful WONDERFUL×ïsland short Ünderneath,Ünderneath"), (None, "wonderful wonderful"), (2, None), (3, ""), (1, "abcdefgh" * 5000 + " " + "abcdefgh" * 5000), (4, "İstanbul ſeventeen Ⅷ"), (4, "naïveté́ly naïveté́ly")]
    rows += [(i, f"planted seventeen{'x' * (i % 3)} planted") for i in range(200)]
    table = spark.createDataFrame([(k, t, 1, "w", 2) for k, t in rows], "doc_id long, text string, n long, word string, run long")
    assert dict(map(tuple, sp.vocabulary(table).collect())) == plain_vocabulary(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sp.variants(sp.vocabulary(empty)).collect() == []


def test_query_over_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = as_rows(op12_spellings(spark, folder))
    want = plain_variants(plain_vocabulary(rows))
    assert len(got) == len(want) and set(got) == want and any(r[2] for r in got)
