"""How many pairs the linking looks at, and what it leaves on disk."""

import os

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import linking
from ledgerline.llm.fuzzy_lines import line_ids, set_sizes
from ledgerline.llm.linking import SKETCH_TYPE, components, link
from ledgerline.sources.landing import shared_folder


def linked(a, b):
    """Two of five pairs of a large group, and none with the first ten."""
    return (F.abs(F.hash(F.least(a, b), F.greatest(a, b))) % 5 < 2) & (F.least(a, b) >= 10)


def test_a_large_group_is_joined_before_its_pairs_are_listed(spark, monkeypatch):
    listed, usual = [], linking.land

    def counted(table, name, *more):
        out = usual(table, name, *more)
        if name == "pairs_across":
            listed.append(out.count())
        return out

    monkeypatch.setattr(linking, "land", counted)
    before = set(os.listdir(shared_folder(spark)))
    ids = spark.range(300).select("id", F.lit(100).alias("n"), F.lit(95).alias("rest"))
    rows = ids.select("*", F.explode(F.expr("sequence(1L, 6L)")).alias("key"))
    found = components(link(rows, lambda pairs: pairs.where(linked(F.col("a"), F.col("b"))), 80))
    assert {tuple(r) for r in found.collect()} == {(i, 10) for i in range(10, 300)}
    # The first ten meet all others, which is some 3,000 pairs; all pairs are 44,850.
    assert listed[0] < 4_000
    left = {f.rsplit("-", 1)[0] for f in set(os.listdir(shared_folder(spark))) - before}
    assert not left & {"crossing_rows", "crossing_keys"}


def test_sketches_spare_pairs_that_are_too_far_apart_and_no_others(spark):
    words = [f"the quick brown fox {i} jumps over the lazy dog" for i in (11, 12)] + ["the quick brown cat was never seen again by dogs"]
    sizes, bits = set_sizes(words, 4)
    sets = [{x[i : i + 4] for i in range(len(x) - 3)} for x in words]
    assert sizes.tolist() == [len(x) for x in sets]
    for i in range(3):
        for j in range(3):
            differ = sum(int(x).bit_count() for x in (bits[i] ^ bits[j]).view(np.uint64))
            assert differ <= len(sets[i] ^ sets[j])
    names = line_ids(words).tolist()
    made = [(1, x, int(n), int(n), tuple(b)) for x, n, b in zip(names, sizes, bits.tolist())]
    rows = spark.createDataFrame(made, f"key long, id long, n int, rest int, sketch {SKETCH_TYPE}")
    asked = []

    def check(pairs):
        asked.extend(frozenset(r) for r in pairs.collect())
        return pairs

    assert len(sets[0] & sets[1]) / len(sets[0] | sets[1]) >= 0.8
    found = {r["id"] for r in components(link(rows, check, 80)).collect()}
    assert found == set(names[:2])
    assert set(asked) == {frozenset(names[:2])}
