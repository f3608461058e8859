"""Token files: flat unsigned integers beside 64-bit document offsets, written in order and mapped back.

A dataset is a folder of shards and a manifest. A shard is three flat little-endian files:

    <name>.ids  the ids of its documents, one after the other: 2 bytes each if the vocabulary and the end id fit, else 4
    <name>.off  n_docs + 1 signed 64-bit integers: where each document begins in .ids, and the end
    <name>.key  n_docs signed 64-bit integers: the documents' keys (0 where null; null keys come first)

The manifest is a Parquet table, one row a shard: ``shard`` (its number from 0, in key order), ``path``
(without suffix), ``width``, ``n_docs``, ``n_null``, ``n_ids`` and its bases ``first_doc`` and
``first_id``: prefix sums of the counts of all shards before. A document's place in the whole dataset
is its shard's base plus its offset, so shards are written at once and nothing is written twice.

Documents are dealt by ranges of (key, hash of the text, place in the input), so that one key with many
rows is spread too, and sorted by these inside a task, which starts a new shard whenever one is full.
A repeated task writes files of other names, and the manifest names those of accepted attempts alone.

Texts are cut at ASCII white space, and words are encoded by the tokenizers library, which is asked
once for what recurs; a tokenizer for which that is not the same as encoding the whole text is refused
(``splits_at_space``).

Null texts are empty; every document ends with the end id. Rows of one key stand in the order of their
texts' hashes, rows alike in any order. An empty table has no shards. Other columns are not looked at.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.shipping import mapped
from ledgerline.sources.landing import fresh_path, land

#: A shard is closed when its ids have so many bytes or it has so many documents.
SHARD_BYTES = 256 << 20
SHARD_DOCS = 1 << 22
#: Words and pieces of words whose ids a worker keeps (twice), and the length of the longest of them.
KEPT_WORDS, KEPT_PIECES = 1 << 18, 1 << 17
KEPT_LENGTH = 64
#: Below are Latin letters whose case, composition and classes are the same in all versions of Unicode.
SIMPLE = "\u0250"
#: Shards whose bases are summed in one task.
SUMMED = 1024
#: Tasks that read shards back, at most.
READERS = 20_000

_SHARD = "part int, piece int, path string, width int, n_docs long, n_null long, n_ids long"


def splits_at_space(content: str) -> bool:
    """Whether a tokenizer file encodes a text as it encodes the text's ASCII-space-separated words.

    It does if its own pattern drops white space from all words and no rule looks beyond a word: no
    added token that strips or holds white space, no prefix space, no post-processor.
    """
    model = json.loads(content)
    steps = model.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    cut = [s for s in steps if s.get("type") == "Split" and s["behavior"] == "Removed" and s["invert"]]
    tokens = model["added_tokens"]
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(" \t\n\r\x0b\x0c") for t in tokens)
    # Every alternative of the pattern is made of letters, numbers, or characters other than white space.
    parts = cut[0]["pattern"]["Regex"].split("|") if cut else []
    inner = all(p.startswith("'") or p in (r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+") for p in parts)
    prefixed = any(s.get("add_prefix_space") for s in steps)
    byte_level = [s.get("type") for s in steps] == ["Split", "ByteLevel"] and not steps[1].get("use_regex")
    return bool(cut) and plain and inner and byte_level and not prefixed and not model["post_processor"] and bool(model["normalizer"])


class Kept(dict):
    """What was made for recent keys: at ``most`` keys those of a generation before are dropped, unless asked for since."""

    def __init__(self, make, most: int):
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key):
        made = self.before.get(key)
        if made is None:
            made = self.make(key)
        if len(key) <= KEPT_LENGTH:
            if len(self) >= self.most:
                self.before = self.copy()
                self.clear()
            self[key] = made
        return made


class Words:
    """Encodes texts word by word through the library's normalizer, pattern and model.

    Kept are the ids of words (UTF-8 bytes) and of the pieces that the pattern cuts words into, as
    little-endian bytes. A word that is long, holds an added token or letters beyond Latin is encoded as
    a text of its own.
    """

    def __init__(self, content: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        largest = max(end_id, *self.tokenizer.get_vocab(with_added_tokens=True).values())
        self.kind = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self.end = self._bytes([end_id])
        model = json.loads(content)
        added = [t["content"] for t in model["added_tokens"]]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        normalizer = model["normalizer"] or {}
        steps = [n["type"] for n in normalizer.get("normalizers", [normalizer]) if n]
        # Letters below SIMPLE are only lowered by these steps, and the pattern means the same there to every library.
        simple = steps == ["NFC", "Replace", "Lowercase"] and not any(t.isalpha() for t in added)
        pattern = model["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern) if simple else None
        # A mark after letters is a piece of its own.
        self.marks = ".,;:!?" if {r"[\p{L}]+", r"[^\s\p{L}\p{N}]+"} <= set(pattern.split("|")) else ""
        letters = bytes_to_letters()
        self.letters = {byte: letters[byte] for byte in range(256)}
        self.pieces = Kept(self._piece, KEPT_PIECES)
        self.words = Kept(self._word, KEPT_WORDS)

    def _bytes(self, ids: list[int]) -> bytes:
        made = array("H" if self.kind.itemsize == 2 else "I", ids)
        if sys.byteorder == "big":
            made.byteswap()
        return made.tobytes()

    def _piece(self, piece: str) -> bytes:
        # ASCII letters stand for themselves.
        spelled = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.letters)
        return self._bytes([t.id for t in self.tokenizer.model.tokenize(spelled)])

    def _word(self, raw: bytes) -> bytes:
        word = raw.decode("utf-8", "replace")
        if len(raw) <= KEPT_LENGTH:
            if self.pattern and (word.isascii() or max(word) < SIMPLE):
                low = word.lower()
                if low.isalpha():
                    return self.pieces[low]
                if word.isprintable() and not self.added.search(word):
                    if low[-1] in self.marks and low[:-1].isalpha():
                        return self.pieces[low[:-1]] + self.pieces[low[-1]]
                    return b"".join(map(self.pieces.__getitem__, self.pattern.findall(low)))
        return self._bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def encoded(self, text: bytes) -> bytes:
        """The ids of one text and the end id; bytes.split() cuts at ASCII white space."""
        return b"".join(map(self.words.__getitem__, text.split())) + self.end


def bytes_to_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself, or the next one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte) if byte in printable else chr(next(others)) for byte in range(256)]


@lru_cache(2)
def words(content: str, end_id: int) -> Words:
    return Words(content, end_id)


class _Shard:
    """One shard being written."""

    def __init__(self, folder: str, width: int, most_bytes: int = SHARD_BYTES, most_docs: int = SHARD_DOCS):
        self.most_bytes, self.most_docs = most_bytes, most_docs
        self.path, self.width = f"{folder}/{uuid.uuid4().hex}", width
        self.store, path = fs.FileSystem.from_uri(f"{self.path}.ids")
        self.store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = self.store.open_output_stream(path, compression=None)
        self.ends, self.keys, self.n_null, self.bytes = [], [], 0, 0

    def add(self, key: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.bytes += len(ids)
        self.ends.append(self.bytes // self.width)
        self.keys.append(key or 0)
        self.n_null += key is None

    def full(self) -> bool:
        return self.bytes >= self.most_bytes or len(self.keys) >= self.most_docs

    def close(self) -> tuple:
        self.out.close()
        for suffix, values in (("off", [0, *self.ends]), ("key", self.keys)):
            with self.store.open_output_stream(fs.FileSystem.from_uri(f"{self.path}.{suffix}")[1], compression=None) as out:
                out.write(np.array(values, "<i8").tobytes())
        return self.path, self.width, len(self.keys), self.n_null, self.bytes // self.width


def _based(shards: DataFrame) -> DataFrame:
    """The manifest of landed shards: numbers and bases from sums of blocks of shards, then inside each block."""
    order = ["part", "piece"]
    before = Window.partitionBy("block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumn("block", F.floor(F.col("part") / SUMMED))
    blocks = shards.groupBy("block").agg(F.count("*").alias("b_n"), F.sum("n_docs").alias("b_docs"), F.sum("n_ids").alias("b_ids"))
    # One row for each SUMMED tasks: a thousand rows for a million tasks.
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("b_n", "b_docs", "b_ids")])
    base = lambda whole, own: F.col(whole) + F.coalesce(own.over(before), F.lit(0))
    return shards.join(F.broadcast(blocks), "block").select(
        base("b_n", F.count("path")).alias("shard"), "path", "width", "n_docs", "n_null", "n_ids",
        base("b_docs", F.sum("n_docs")).alias("first_doc"), base("b_ids", F.sum("n_ids")).alias("first_id"),
    )


def write(
    docs: DataFrame, vocabulary_path: str, folder: str, end_id: int, text: str = "text", key: str = "doc_id",
    shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """Encode all documents into shards below ``folder``, in ascending key order; returns the manifest (Parquet in ``folder``/manifest).

    vocabulary_path: a file of the tokenizers library on the driver; its content (a few MB) is broadcast.
    A shard is closed once it has ``shard_bytes`` of ids or ``shard_docs`` documents.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        content = file.read()
    if not splits_at_space(content):
        raise ValueError("this tokenizer does not encode a text word by word")
    sent = spark.sparkContext.broadcast(content)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, piece, shard = words(sent.value, end_id), TaskContext.get().partitionId(), 0, None
        rows = []
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
            for at, number in enumerate(keys):
                shard = shard or _Shard(folder, own.kind.itemsize, shard_bytes, shard_docs)
                shard.add(number, own.encoded(texts[at].as_py() or b""))
                if shard.full():
                    rows.append((part, piece, *shard.close()))
                    piece, shard = piece + 1, None
        if shard:
            rows.append((part, piece, *shard.close()))
        names = [x.split()[0] for x in _SHARD.split(", ")]
        kinds = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in _SHARD.split(", ")]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    order = ["key", "digest", "place"]
    placed = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).select(
        "key", "text", F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("place")
    )
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    shards = land(mapped(dealt, written, _SHARD), "token_shards")
    _based(shards).coalesce(1).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _mapped_file(path: str, kind: str) -> np.ndarray:
    """A flat file as an array: mapped where the store is a mounted folder, else read."""
    store, name = fs.FileSystem.from_uri(path)
    if isinstance(store, fs.LocalFileSystem):
        empty = store.get_file_info(name).size == 0
        return np.zeros(0, kind) if empty else np.memmap(name, kind, "r")
    with store.open_input_file(name) as file:
        return np.frombuffer(file.read(), kind)


def documents(path: str, width: int, n_null: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(key, offset in the shard, ids) of each document of a shard; ids are a view of the mapped file."""
    ids = _mapped_file(f"{path}.ids", f"<u{width}")
    offsets, keys = _mapped_file(f"{path}.off", "<i8"), _mapped_file(f"{path}.key", "<i8")
    for at, number in enumerate(keys.tolist()):
        begin, end = int(offsets[at]), int(offsets[at + 1])
        yield None if at < n_null else number, begin, ids[begin:end]


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a dataset from its files: doc_id, start (ids before it in the dataset), n_tokens, ids_crc32.

    ids_crc32 is the unsigned crc32 of the ids as little-endian unsigned 32-bit integers. A task reads
    whole shards, whose size is bounded, and holds one document's ids beside the mapped file.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    tasks = max(1, min(READERS, manifest.count()))

    def scanned(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = []
                for number, begin, ids in documents(row["path"], row["width"], row["n_null"]):
                    found.append((number, row["first_id"] + begin, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(found) == 4096:
                        yield _rows(found)
                        found = []
                if found:
                    yield _rows(found)

    wanted = manifest.select("path", "width", "n_null", "first_id")
    return mapped(wanted.repartition(tasks), scanned, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def through_files(docs: DataFrame, vocabulary_path: str, end_id: int = 1) -> DataFrame:
    """Documents written to token files in the shared folder and read back."""
    folder = fresh_path(docs.sparkSession, "tokens")
    write(docs, vocabulary_path, folder, end_id)
    return read(docs.sparkSession, folder)
