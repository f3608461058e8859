"""Token files against the tokenizers library over whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import token_files as tf
from ledgerline.llm.queries import op11_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
OWN = tf.words(open(PATH, encoding="utf-8").read(), 1)
LIBRARY = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, start long, path string, digest int"


def plain(rows, end=1):
    """What the files must give: (doc_id, start, n_tokens, crc32) in ascending order of doc_id, nulls first."""
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n\x0b\x0c\r\x1c\x85́̇İΣſé'sll<|startofend>12")), max_size=40))
def test_words_alone_give_the_ids_of_the_text(text):
    own = OWN
    for value in (text, f"a{text}<|endoftext|>b {text}"):
        assert np.frombuffer(own.encoded(value.encode()), own.kind).tolist() == LIBRARY.encode(value, add_special_tokens=False).ids + [1]


def test_other_tokenizers_are_refused(spark):
    with pytest.raises(ValueError):
        tf.write(spark.createDataFrame([(1, "a")], "doc_id long, text string"), public_tokenizers.path("byte_bpe_50k.json"), "/nowhere", 1)


def test_small_table(spark):
    texts = [(5, "Some words, two's"), (3, None), (None, "null key"), (9, ""), (-4, "x" * 50_000), (12, "<|endoftext|> ok é"), (None, None), (7, "word " * 30_000)]
    table = spark.createDataFrame([(k, t, 0, "p", 1) for k, t in texts], SCHEMA)
    got = sorted(map(tuple, tf.through_files(table, PATH).collect()), key=lambda r: r[1])
    assert {(k, n, c) for k, _, n, c in got} == {(k, n, c) for k, _, n, c in plain(texts)}
    assert [r for r in got if r[0] is not None] == [r for r in plain(texts) if r[0] is not None]
    assert [r[0] for r in got[:2]] == [None, None] and got[1][1] == got[0][2]


def test_repeated_keys_and_many_shards(spark, tmp_path):
    rows = [(i // 3 if i % 2 else 50, f"text {i % 7}") for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = f"{tmp_path}/set"
    manifest = tf.write(table, PATH, folder, 1, shard_docs=70).orderBy("shard").collect()
    assert len(manifest) == 9
    assert [m["shard"] for m in manifest] == list(range(len(manifest)))
    assert [m["first_id"] for m in manifest] == np.cumsum([0] + [m["n_ids"] for m in manifest])[:-1].tolist()
    assert [m["first_doc"] for m in manifest] == np.cumsum([0] + [m["n_docs"] for m in manifest])[:-1].tolist()
    got = sorted(map(tuple, tf.read(spark, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted(r[0] for r in rows)
    assert np.cumsum([0] + [r[2] for r in got])[:-1].tolist() == [r[1] for r in got]
    assert sorted((r[0], r[2], r[3]) for r in got) == sorted((r[0], r[2], r[3]) for r in plain(rows))


def test_shards_are_closed_when_full(spark, tmp_path):
    folder = f"{tmp_path}/set"
    table = spark.range(20).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    rows = table.collect()
    own = OWN
    shard = tf._Shard(folder, own.kind.itemsize)
    for row in rows:
        shard.add(row["doc_id"], own.encoded(row["text"].encode()))
    path, width, n_docs, n_null, n_ids = shard.close()
    assert (width, n_docs, n_null, n_ids) == (2, 20, 0, 80)
    assert [(k, b, i.tolist()[-1]) for k, b, i in tf.documents(path, width, 0)] == [(i, 4 * i, 1) for i in range(20)]


def test_empty_table(spark):
    assert tf.through_files(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_query_over_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, op11_token_files(spark, folder).collect()), key=lambda r: r[1])
    assert got == plain(rows)


def test_kept_words_are_bounded():
    """Words and pieces kept together, whatever the number of different words; the ids stay the library's."""
    own = tf.Words(LIBRARY.to_str(), 1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for block in range(0, 26**4, 26**3):
        own.encoded(" ".join(letters[i // 26**3] + letters[i // 26**2 % 26] + letters[i // 26 % 26] + letters[i % 26] + end for i in range(block, block + 26**3) for end in ("", "x")).encode())
    assert len(own.words) + len(own.words.before) + len(own.pieces) + len(own.pieces.before) <= 800_000
    for text in ("Word. word, WORD; a:b; end! why? é. x2. 's. it's. ... .a a.. <|endoftext|>.", "qzx. Qzx, qzx"):
        assert np.frombuffer(own.encoded(text.encode()), own.kind).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids + [1]
