"""The operators against plain versions, on small tables with nulls, empty and odd texts, ties and repeated rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import arrays, bpe, fuzzy_lines, grades, graph_ann, linking, main_text, mixing, prefix_join, prefix_tree, syncmers, warc
from ledgerline.llm.queries import vocabulary_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, target string, key long"


def words(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi".split()) + str(draw.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base, long = words(1, 60), words(2, 4000)
    near = base.split()
    near[30] = "other"
    rows = [
        (1, base, "s1"), (2, " ".join(near), "s1"), (3, base.upper(), "s2"), (4, None, "s2"), (5, "", None), (6, " \n\t", None), (7, "one two", "s3"),
        (8, "ONE  two", "s3"), (9, long, "s1"), (9, long, "s1"), (None, words(3, 50), None), (None, words(4, 50), "s2"), (10, long + " end", "s4"), (11, words(5, 3), "s4"),
        (12, base + "\n" + words(6, 20) + "\n\n" + words(7, 20), "s1"), (13, words(6, 20) + "!\nown line of this one", "s2"), (14, "éß😀 x\u0000y <|endoftext|> z", "s5"),
    ]
    return [(i, t, "en", s, len(t or ""), 1, "t", 2) for i, t, s in rows]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def sets(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_ngram_join(docs, empty, texts):
    got = sorted(tuple(r) for r in prefix_join.similar_documents(docs, 4, 80).collect() if r[0] is not None)
    own = [(r[0], sets(r[1], 4)) for r in texts if r[0] is not None]
    root = {i: i for i, _ in own}
    for (a, x), (b, y) in itertools.combinations(own, 2):
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    assert got == sorted((i, len(x), root[i]) for i, x in own)
    kept = prefix_join.one_of_each(docs, 4, 80)
    assert kept.columns == docs.columns
    ids = sorted(r[0] for r in kept.collect() if r[0] is not None)
    assert ids == sorted({i for i, _ in own if root[i] == i})
    assert prefix_join.similar_documents(empty, 4, 80).count() == 0


def test_ngram_join_of_copies_at_the_threshold(spark):
    """Copies of one text, each with a few words of its own: similarities lie on both sides of the threshold, many on it."""
    draw = random.Random(5)
    bases = [[f"w{b}x{i}" for i in range(100 + b)] for b in range(2)]
    texts = []
    for i in range(160):
        own = list(bases[i % 2])
        for _ in range(draw.choice((0, 1, 1, 2, 2, 3))):
            own[draw.randrange(len(own))] = draw.choice(("a", "b", f"own{i}"))
        texts.append(" ".join(own[draw.choice((0, 0, 3)) :]))
    sets = [{tuple(t.split()[j : j + 4]) for j in range(len(t.split()) - 3)} for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in prefix_join.similar_documents(table, 4, 85).collect()}
    assert found == {i: find(i) for i in range(len(texts))}


def _mirrored(n: int) -> list[str]:
    """Two words of n letters whose polynomial hashes modulo 2^64 are equal for every odd base, if n is 1,024 or more."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return ["".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)]


def test_built_words_and_lines_stay_apart(spark):
    first, second = _mirrored(2048)
    assert len(set(fuzzy_lines.line_ids([first, second, first]).tolist())) == 2
    texts = pa.array([f"{first} {second} é {first}", second, ""]).cast(pa.large_string())
    (_, data, offsets), = arrays.chunks(texts)
    own, at = arrays.words(data, offsets)
    assert list(at) == [0, 4, 5, 5] and own[0] == own[3] and own[1] == own[4] and len(set(own.tolist())) == 3
    docs = spark.createDataFrame([(1, first), (2, second), (3, first.upper())], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in prefix_join.similar_documents(docs, 4, 85).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_identities_follow_content():
    draw = np.random.default_rng(3)
    values = draw.integers(0, 1 << 64, 5, dtype=np.uint64)[draw.integers(0, 5, 70_000)]
    starts = draw.integers(0, 69_000, 4_000)
    ends = starts + draw.integers(0, 140, 4_000)  # on both sides of LONG
    found = {}
    for h, s, e in zip(arrays.identities(values, starts, ends).tolist(), starts, ends):
        found.setdefault(h, set()).add(values[s:e].tobytes())
    assert all(len(x) == 1 for x in found.values())
    assert len(found) == len({values[s:e].tobytes() for s, e in zip(starts, ends)})
    assert arrays.identities(values[:0], np.zeros(1, int), np.zeros(1, int)).tolist() == arrays.identities(values, np.zeros(1, int), np.zeros(1, int)).tolist()


def test_links_lose_nothing_and_list_no_group(spark):
    rows = [(k, i) for k in range(3) for i in range(40)] + [(9, 3), (9, 77)]
    table = spark.createDataFrame(rows, "key long, id long").selectExpr("key", "id", "10 n", "9 rest")
    checked = []

    def odd_even(pairs):
        checked.append(pairs.count())
        return pairs.where("a % 2 = b % 2")

    roots = {r["id"]: r["root"] for r in linking.components(linking.link(table, odd_even, 50)).collect()}
    assert {roots[i] for i in range(0, 40, 2)} == {0} and {roots[i] for i in range(1, 40, 2)} == {1} and roots[77] == 1
    assert checked[0] <= 40


def test_bpe_round_trip(docs, empty, texts):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(vocabulary_path())
    reference.no_truncation(), reference.no_padding()
    got = sorted(bpe.round_trip(docs, vocabulary_path()).collect(), key=repr)
    want = sorted(((r[0], r[1] or "") for r in texts), key=repr)
    assert sorted((r["doc_id"], r["decoded"]) for r in got if r["doc_id"]) == sorted(x for x in want if x[0])
    for r in got:
        assert r["ids"] == reference.encode(r["text"], add_special_tokens=False).ids
    own = bpe.Vocabulary(open(vocabulary_path()).read())
    for text in ("a" * 3000, "  \n\n x", "<|endoftext|><|endoftext|>", "'s'RE ½² ٣"):
        assert own.encoded(text).tolist() == reference.encode(text, add_special_tokens=False).ids
    assert bpe.round_trip(empty, vocabulary_path()).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs.withColumn("ids", F.lit(1)), vocabulary_path())


def test_mixing(spark, docs, empty):
    rows = [(i, words(i, 1 + i * 7 % 90), f"s{i % 7}" if i % 7 else None) for i in range(700)] + [(5000, words(1, 3000), "s1")]
    many = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(many).toPandas()
    again = mixing.mixed(many.repartition(5)).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    size = {i: len(t.split()) for i, t, _ in rows}
    assert [size[i] for i in got["doc_id"]] == list(got["size"])
    assert (got["taken"] <= 2 * got["size"]).all() and (got["taken"] % got["size"] == 0).all()
    of = {i: s for i, _, s in rows}
    names = sorted({s for s in of.values() if s}) + [None]
    weight, full = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, {s: sum(size[i] for i in of if of[i] == s) for s in names}
    left, left_open, target = 1.5 * sum(full.values()), set(names), {}
    while True:
        total = sum(weight[s] for s in left_open)
        over = [s for s in left_open if left * weight[s] / total > 2 * full[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in left_open}
            break
        for s in over:
            target[s], left = 2 * full[s], left - 2 * full[s]
            left_open.discard(s)
    for s in names:
        part = got[[of[i] == s for i in got["doc_id"]]]
        assert part["target"].iloc[0] == pytest.approx(target[s]) and part["source_size"].iloc[0] == full[s]
        assert abs(part["taken"].sum() - target[s]) <= 0.02 * target[s] + 90
    odd = mixing.mixed(docs)
    assert odd.count() == docs.count() and odd.where("size = 0 and taken > 0").count() == 0
    assert mixing.mixture(docs).columns == docs.columns
    assert mixing.mixed(empty).count() == 0


def test_archives(spark):
    long = "é\r\n\r\nWARC/1.1\r\n" * 200
    rows = [(1, "http://a/", long, 0), (2, None, long, 0), (2, None, long, 0), (None, "u\r\nx%", long, 0), (3, "v", None, 0), (4, "w", "", 0), (5, "w", "short", 0), (6, "w", "short", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, uid int")
    got = warc.archived(pages).collect()
    assert sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"]) for r in got) == sorted((i or 0, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h, _ in rows)
    shared = [(r["record_type"], r["page_id"], r["refers_to_page"]) for r in got if r["payload_bytes"] > 1000]
    assert sorted(shared, key=str) == sorted([("response", 2, None), ("revisit", 2, 2), ("revisit", 1, 2), ("revisit", None, 2)], key=str)
    assert all(r["record_type"] == "response" for r in got if r["payload_bytes"] < 1000)
    assert {r["target"] for r in got} == {"http://a/", "", "u\r\nx%", "v", "w"}
    assert warc.archived(pages.where("false")).count() == 0


def anchors(text):
    w = re.findall(syncmers.WORD, text)
    return [tuple(w[i : i + 4]) for i in range(len(w) - 3)]


def test_syncmers(docs, empty, texts):
    got = syncmers.edited_pairs(docs).collect()
    # A repeated row follows itself; null ids come last, by the hash of the text.
    known = sorted(((i, t or "") for i, t, *_ in texts if i is not None), reverse=True)
    after = {a: b[1] for a, b in zip(known[:-1], known[1:])}
    for r in got:
        if r["doc_id"] is not None and (r["doc_id"], r["text"]) in after and r["doc_id"] != 9:
            k = len(r["text"]) // 3
            assert r["edited"] == r["text"][: len(r["text"]) - k] + after[r["doc_id"], r["text"]][:k]
    by_text = {}
    for r in got:
        assert by_text.setdefault(r["text"], r["fp"]) == r["fp"]
        assert len(r["fp"]) == len(set(r["fp"])) and (len(r["fp"]) > 0) == bool(r["text"].strip())
        assert len(r["fp"]) <= max(1, len(set(anchors(r["text"]))))
    assert len(got) == len(texts)
    # An anchor does not depend on what surrounds it.
    whole, part = by_text[texts[12][1]], by_text[texts[8][1]]
    assert len(set(part) - set(whole)) == 0
    assert syncmers.edited_pairs(empty).count() == 0


def shingle_set(line, k=fuzzy_lines.SHINGLE):
    return {line[i : i + k] for i in range(max(1, len(line) - k + 1))}


def test_fuzzy_lines(spark, docs, empty):
    a, b = words(11, 30), words(12, 30)
    near = a[:60] + "#" + a[61:]
    rows = [(1, f"{a}\n{b}\n\n{a}"), (2, near), (3, f"own\n{b.upper()}"), (4, None), (5, ""), (6, f"{words(13, 30)}\n {words(13, 30)} "), (7, "tail"), (7, "tail"), (None, b)]
    table = spark.createDataFrame([(i, t, len(t or ""), 1) for i, t in rows], "doc_id long, text string, n_chars long, line int")
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in fuzzy_lines.without_repeats(table).collect()), key=str)
    want = [(1, f"{a}\n{b}\n"), (3, "own"), (4, None), (5, ""), (6, words(13, 30)), (7, "tail")]
    assert sorted([g[:2] for g in got if g[0] != 7], key=str) == sorted([w for w in want if w[0] != 7], key=str)
    x, y = shingle_set(a), shingle_set(near)
    assert len(x & y) / len(x | y) >= 0.8
    assert fuzzy_lines.without_repeats(docs).columns == docs.columns
    assert fuzzy_lines.without_repeats(empty).count() == 0


def test_fuzzy_lines_of_repeated_rows(spark):
    """Rows alike in doc_id and text stay once, those with a null doc_id and those without lines included."""
    a, b = words(21, 30), words(22, 30)
    rows = [(7, "tail")] * 3 + [(8, f"{a}\n{b}")] * 40 + [(8, b), (9, a + "!"), (None, "loose")] + [(None, "loose")] * 2 + [(5, " \n\u2003"), (5, " \n\u2003"), (4, None), (4, None), (3, ""), (3, "")]
    table = spark.createDataFrame([(i, t, len(t or ""), n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n_chars long, own int").repartition(5)
    got = sorted(((r["doc_id"], r["text"]) for r in fuzzy_lines.without_repeats(table).collect()), key=str)
    want = [(7, "tail"), (8, f"{a}\n{b}"), (None, "loose"), (5, " \n\u2003"), (5, " \n\u2003"), (4, None), (4, None), (3, ""), (3, "")]
    # b stands in two texts of document 8: the one with the smaller hash is the first.
    kept_b = [(8, a), (8, b)]
    assert got in (sorted(want, key=str), sorted([w for w in want if w[0] != 8] + kept_b, key=str))


def test_fuzzy_short_lines(spark):
    """Lines of 30 to 90 characters with one character or one word changed, against brute force."""
    draw, lines = random.Random(9), []
    for i in range(90):
        base = "".join(words(900 + i, 20))[: 30 + draw.randrange(61)].strip()
        at, own = draw.randrange(1, len(base) - 1), base.split(" ")
        own[draw.randrange(len(own))] = draw.choice(("a", "tree", "winter"))
        lines += [base, base[:at] + "#" + base[at + 1 :], " ".join(own)]
    lines = list(dict.fromkeys(lines))
    of, root = [shingle_set(x) for x in lines], list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            if 100 * len(of[i] & of[j]) >= 80 * len(of[i] | of[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    edited = [i for i in range(len(lines)) if "#" in lines[i] and len(lines[i]) >= 40]
    assert len(edited) > 50 and sum(root[i] != i for i in edited) >= 0.8 * len(edited)
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in fuzzy_lines.without_repeats(table).collect()) == sorted(set(root))


def test_signatures_follow_similarity():
    draw, met, alike = random.Random(5), 0, 0
    for i in range(150):
        a = words(100 + i, 30)
        b = list(a)
        for _ in range(2):
            b[draw.randrange(len(b))] = "#"
        x, y = shingle_set(a), shingle_set("".join(b))
        if len(x & y) / len(x | y) >= 0.8:
            alike += 1
            one, two = fuzzy_lines.bands([a, "".join(b)])
            met += bool(set(one.tolist()) & set(two.tolist()))
    assert alike > 50 and met >= 0.98 * alike


def test_grades(spark, docs, empty):
    draw = random.Random(1)
    rows = []
    for i in range(900):
        kind = i % 3
        text = [f"w{draw.randrange(300)}" for _ in range(40)]
        if kind == 0:
            text[draw.randrange(40)] = draw.choice(["awful", "awfully", "awfulness"])
            text[draw.randrange(40)] = "nasty"
        if kind == 1:
            text = [x + "***" for x in text]
        rows.append((i, " ".join(text), int(kind == 2 or kind == 0), int(kind == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    labels = grades.rated(table.select("doc_id", "quality", "toxic"))
    model = grades.fit(table, labels.where("doc_id < 700"))
    assert model.thresholds[0] < model.thresholds[1]
    found = grades.graded(table, model).where("doc_id >= 700").toPandas()
    right = [(t[1] >= 0.5) == (i % 3 == 2) for i, t in zip(found["doc_id"], found["tail"])]
    assert np.mean(right) > 0.97
    assert all(t[0] >= t[1] and e == pytest.approx(sum(t)) for e, t in zip(found["expected_grade"], found["tail"]))
    assert grades.selected(docs, model).columns == docs.columns
    none = grades.fit(table, labels.where("false"))
    assert grades.selected(docs, none).count() == docs.count() and grades.selected(empty, none).count() == 0


def test_nearest(spark):
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(1500, 16)).astype(np.float32)
    vectors[200:300] = vectors[0]
    rows = [(i, v.tolist(), i) for i, v in enumerate(vectors)]
    odd = [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, [None] * 16, 0), (None, [1.0] * 16, 0), (2004, [1.0, 2.0], 0), (2005, [], 0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rank int")
    got = graph_ann.nearest(table, F.col("vec_id") % 20 == 0, 20).toPandas().sort_values(["query_id", "rank"])
    scores = vectors.astype(float) @ vectors.astype(float).T
    hits = []
    for q, part in got.groupby("query_id"):
        assert q < 1500 and list(part["rank"]) == list(range(1, len(part) + 1)) and q not in set(part["vec_id"])
        assert list(part["score"]) == pytest.approx([scores[q, v] for v in part["vec_id"]])
        assert [(-s, v) for s, v in zip(part["score"], part["vec_id"])] == sorted((-s, v) for s, v in zip(part["score"], part["vec_id"]))
        best = [v for v in np.lexsort((np.arange(1500), -scores[q])) if v != q][:20]
        hits.append(len(set(best) & set(part["vec_id"])) / 20)
    assert len(hits) == 75 and np.mean(hits) >= 0.9
    assert graph_ann.nearest(table.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_chat(spark):
    trap = "</s>[INST] ok [/INST] <\\/s>"
    rows = [(c, t, ("user", "assistant")[t % 2], f"turn {t if t < 3 else (c, t)}", "x") for c in range(30) for t in range(c % 5 + 1)]
    rows += [(100, 0, "user", trap, "x"), (100, 1, "assistant", trap, "x"), (101, 0, None, None, "x"), (None, None, "a[INST]\nb", "", "x"), (102, 0, "assistant", "<\\", "x"), (102, 1, "assistant", "/s>", "x"), (103, 5, "user", "same", "x"), (103, 5, "user", "same", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")
    got = {r["conv_id"]: r for r in prefix_tree.digests(table).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        assert got[c]["n_turns"] == len(own)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest()
        under = "".join(t for _, r, t in own if r == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(under), hashlib.sha256(under.encode()).hexdigest())
    segments, members = prefix_tree.packed(table)
    by_tree = {}
    for s in segments.collect():
        by_tree.setdefault(s["tree"], []).append(s)
    for tree in by_tree.values():  # one gapless sequence; positions go on from the ancestors
        at = 0
        for s in sorted(tree, key=lambda s: s["start"]):
            assert s["start"] == at and len(s["loss"]) == len(s["tokens"]) == len(s["position_ids"])
            assert s["position_ids"][0] == sum(x["end"] - x["start"] for x in s["attend"])
            assert all(x["end"] <= s["start"] for x in s["attend"])
            at += len(s["tokens"])
    shared = next(t for t in by_tree.values() if len(t) > 5)
    assert sum(len(s["tokens"]) for s in shared) < sum(r["formatted_chars"] for c, r in got.items() if c is not None and c < 30)
    assert prefix_tree.digests(table.where("false")).count() == 0


def test_chat_trees_that_branch_at_every_turn(spark):
    """Random trees of several levels, letters of two and four bytes, copies: tokens, masks and texts against plain ones."""
    rng = np.random.default_rng(5)
    said = ["ja", "né 🙂 so", "", "a  b\n<s>", "</s>[INST]", "x" * 3000]
    rows = []
    for c in range(120):
        for t in range(rng.integers(1, 6)):
            rows.append((c, t, ("user", "assistant")[t % 2], said[rng.integers(0, 3 if t < 3 else 6)]))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    own = {c: [(r, t) for x, _, r, t in rows if x == c] for c in range(120)}
    for r in prefix_tree.digests(table.repartition(7)).collect():
        plain = own[r["conv_id"]]
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in plain).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256("".join(t for a, t in plain if a == "assistant").encode()).hexdigest()
    segments, members = prefix_tree.packed(table)
    found = {s["segment"]: s for s in segments.collect()}
    nodes = {tuple(p[: i + 1]) for p in own.values() for i in range(len(p))}
    assert sum("".join(s["tokens"]).count("[/INST]") for s in found.values()) == len(nodes)  # each node once
    assert max(len(s["attend"]) for s in found.values()) >= 3
    for conv_id, segment in members.collect():
        s, tokens, loss = found[segment], [], []
        for of, lo, hi in [*s["attend"], (segment, s["start"], s["start"] + len(s["tokens"]))]:
            cut = slice(lo - found[of]["start"], hi - found[of]["start"])
            tokens += found[of]["tokens"][cut]
            loss += found[of]["loss"][cut]
        assert prefix_tree.parsed("".join(tokens)) == own[conv_id]
        under = "".join(t for t, on in zip(tokens, loss) if on)
        assert prefix_tree.restored(under) == "".join(t for a, t in own[conv_id] if a == "assistant")


def test_words_of_the_generation_before_are_not_merged_again(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    with open(vocabulary_path(), encoding="utf-8") as file:
        own = bpe.Vocabulary(file.read())
    merged, asked = own.merged, []
    monkeypatch.setattr(own, "merged", lambda word: asked.append(word) or merged(word))
    first = own.encoded("one two three four one").tolist()
    assert sorted(asked) == sorted([b"one", b" two", b" three", b" four", b" one"]) and own.encoded(" three four one").tolist() == first[2:]
    assert len(asked) == 5


PAGE = """<html><head><title>t</title><script>var x="<p>no</p>"</script></head><body><header>Site</header><nav><a>Menu</a></nav><div class="cookie-notice">Cookies</div>
<article><header><h1>The &amp; title</h1></header><p>One <b>bold</b>
 text<br>more<p>Two &#233;<div class="ad">Buy</div><form><input>Name</form><ul><li>a<li>b</ul><aside>Side</aside><section class="comments"><p>Reader</p></section></article><footer>End</footer></body>"""


def test_main_text(spark):
    assert main_text.blocks(PAGE)[0] == (main_text.ARTICLE, "The & title")
    boiler, own = "this line stands on each page of the host and says nothing new", [words(500 + i, 15) for i in range(6)]
    rows = [(1, "http://h.example/1", PAGE, 1), (2, None, None, 1), (3, "http://h.example/3", "", 1), (4, "http://h.example/4", "plain <i>te</i>xt", 1)]
    rows += [(10 + i, f"http://k.example/{i}", f"<div>{boiler}</div><div>{own[i]}</div>", 1) for i in range(6)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r["page_id"]: r["text"] for r in main_text.main_texts(table).collect()}
    assert got[1] == "The & title\nOne bold text more\nTwo é\na\nb"
    assert got[2] == got[3] == "" and got[4] == "plain text"
    assert all(got[10 + i] == own[i] for i in range(6))
    assert main_text.main_texts(table.where("false")).count() == 0


def kept_text(html):
    return [t for _, t in main_text.blocks(html)]


@pytest.mark.parametrize("name", ["related-work", "social-impact", "sharing-data", "login-flow", "related", "comments"])
def test_headings_keep_their_ids(name):
    assert kept_text(f'<article><h2 id="{name}">A heading</h2><p id="{name}">Text</p></article>') == ["A heading", "Text"]


@pytest.mark.parametrize("name", ["no-sidebar", "with-banner", "related-work", "content-with-menu", "with-fixed-header"])
def test_layout_wrappers_are_not_left_out(name):
    assert kept_text(f'<div class="layout {name}"><article><p>Text</p></article></div>') == ["Text"]


@pytest.mark.parametrize("name", ["ad", "adSlot2", "ad-300x250", "cookie-notice", "social-share", "comment-list", "related-posts", "sidebar left"])
def test_names_are_left_out(name):
    assert kept_text(f'<article><div class="{name}"><p>Gone</p></div><p>Text</p></article>') == ["Text"]


def test_articles_in_left_out_wrappers():
    inner = (main_text.INNER, "Text")
    assert main_text.blocks('<div class="sidebar">Gone<article><p>Text</p><div class="ad">Buy</div></article></div>') == [inner]
    assert main_text.blocks('<div id="banner"><main><article><p>Text</p></article></main></div>') == [inner]
    assert kept_text('<div id="comments"><article class="reply"><p>Gone</p></article></div><aside><article>Gone</article></aside><div hidden><main>Gone</main></div>') == []


def test_main_text_of_hosts_without_articles(spark):
    """A passage on two pages of a large host goes wherever they lie; copies of a page keep their text; hosts are apart."""
    passage, filler = words(700, 20), "<script>" + "x" * 1_000_000 + "</script>"
    rows = [(i, f"http://large.example/{i}", f"{filler}<div>{words(800 + i, 20)}</div>") for i in range(24)]
    rows += [(100 + i, f"http://large.example/p{i}", f"<div>{passage}</div><div>{words(900 + i, 20)}</div>") for i in range(4)]
    rows += [(200 + i, f"http://copies.example/{i}", f"<p>{passage}</p><p>{words(950, 20)}</p>") for i in range(3)] + [(200, "http://copies.example/0", f"<p>{passage}</p><p>{words(950, 20)}</p>")]
    rows += [(300, "http://mixed.example/a", f"<article>{passage}</article>"), (301, "http://mixed.example/b", f"<div>{passage}</div><div>{words(960, 20)}</div>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["text"]) for r in main_text.main_texts(table).collect())
    want = [(i, words(800 + i, 20)) for i in range(24)] + [(100 + i, words(900 + i, 20)) for i in range(4)]
    want += [(i, f"{passage}\n{words(950, 20)}") for i in (200, 200, 201, 202)] + [(300, passage), (301, words(960, 20))]
    assert got == want


def test_repeats_are_found_by_suffix_order(spark):
    """The runs of any length cover what the plain version marks, and start with the longest; copies are one content, hosts are apart."""
    draw = random.Random(11)
    common = [draw.randrange(40) for _ in range(70)]
    pages = []
    for i in range(14):
        own = [draw.randrange(3 if i < 4 else 40) for _ in range(draw.randrange(1, 60))]
        at, n = draw.randrange(50), draw.randrange(9, 70)
        pages.append(own + common[at : at + n] + [1000 + i])
    rows = [(i, host, [" ".join(map(str, p[:5])), " ".join(map(str, p[5:]))]) for host in (1, 2) for i, p in enumerate(pages) if len(p) > 5 and (host == 1 or i == 3)]
    rows = [(100 * host + i, host, texts) for i, host, texts in rows]
    found = main_text.repeats(spark.createDataFrame(rows + rows[:2], "content long, host_id long, texts array<string>")).collect()
    kept = [p for p in pages if len(p) > 5]
    tokens, of = np.array(sum(kept, [])), np.repeat(np.arange(len(kept)), [len(p) for p in kept])
    want = main_text.repeated(tokens, of)
    got, begin = np.zeros(len(tokens), bool), dict(zip([100 + i for i, p in enumerate(pages) if len(p) > 5], np.cumsum([0] + [len(p) for p in kept])))
    for r in found:
        got[begin[r["content"]] + r["at"] : begin[r["content"]] + r["at"] + r["length"]] = True
    assert (got == want).all() and want.any() and not want.all()
    assert max(r["length"] for r in found) > 2 * main_text.RUN and len({(r["content"], r["at"]) for r in found}) == len(found)


def test_runs_are_cut_in_doubtful_blocks(spark):
    """What stands on two pages goes from unmarked blocks and from "main-nav" in an article; words beside it, the article's own and unique blocks stay."""
    menu, own = "one two three four five six seven eight nine", [words(1000 + i, 15) for i in range(8)]
    rows = [(i, f"http://a.example/{i}", f"<article><div class='main-nav'>{menu}</div><p>{own[i]}</p><p>{menu}</p><div class='with-menu'>{menu}</div><div class='reader-comments'>{own[4 + i]}</div></article>") for i in range(2)]
    rows += [(2 + i, f"http://b.example/{i}", f"<div>{own[2 + i]} {menu}</div>") for i in range(2)]
    got = {r["page_id"]: r["text"] for r in main_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{own[i]}\n{menu}\n{menu}\n{own[4 + i]}" for i in range(2)} | {2 + i: own[2 + i] for i in range(2)}


def test_page_runs_agree_with_the_plain_version():
    draw = random.Random(8)
    pages = [["".join(" " * bool(n) + draw.choice(("a", "bb", "é😀")) for n in range(draw.randrange(1, 14))) for _ in range(draw.randrange(1, 5))] for _ in range(30)]
    found = [main_text.page_runs(p, -7) for p in pages]
    seen = {}
    for i, (hashes, _, _) in enumerate(found):
        for h in hashes.tolist():
            seen.setdefault(h, set()).add(i)
    tokens, of, covered = [], [], []
    for i, (p, (hashes, at, lengths)) in enumerate(zip(pages, found)):
        own = " ".join(p).split(" ")
        assert list(lengths) == [len(t.split(" ")) for t in p]
        marks = [False] * len(own)
        for h, a in zip(hashes.tolist(), at.tolist()):
            if len(seen[h]) > 1:
                marks[a : a + main_text.RUN] = [True] * main_text.RUN
        tokens, of, covered = tokens + own, of + [i] * len(own), covered + marks
    ids = np.unique(tokens, return_inverse=True)[1]
    assert any(covered) and not all(covered) and (main_text.repeated(ids, np.array(of)) == np.array(covered)).all()


def test_repeated_runs():
    draw = random.Random(4)
    pages = [[draw.randrange(6) for _ in range(draw.randrange(1, 60))] for _ in range(12)]
    tokens, of = np.array(sum(pages, [])), np.repeat(np.arange(12), [len(p) for p in pages])
    runs = {}
    for p, own in enumerate(pages):
        for i in range(len(own) - main_text.RUN + 1):
            runs.setdefault(tuple(own[i : i + main_text.RUN]), []).append((p, i))
    want = np.zeros(len(tokens), bool)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in pages])])
    for places in runs.values():
        if len({p for p, _ in places}) > 1:
            for p, i in places:
                want[starts[p] + i : starts[p] + i + main_text.RUN] = True
    assert (main_text.repeated(tokens, of) == want).all()
