"""Byte-level BPE: encode by a priority queue of merge ranks over a linked list, decode by concatenation.

A text is cut at special tokens, then into words by the vocabulary's pattern. A word's bytes form a
doubly linked list of symbols. A heap holds the ranks of neighbouring pairs; the lowest rank (the
leftmost, if equal) is merged and its new neighbours are pushed. Entries whose symbols have changed
since are stale and skipped. This takes n log n steps, also for a word of a million characters.
Decoding takes each id's bytes from the vocabulary and joins them.

A null text is empty and has no ids; null ids decode to the empty text. Unknown ids are an error.
"""

from __future__ import annotations

import heapq
import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.shipping import mapped

#: Words whose ids a worker keeps; when they are so many, those of a generation before are dropped, unless asked for since.
KEPT_WORDS = 1 << 18
#: Longer words are not kept.
KEPT_LENGTH = 64
#: Code points of text encoded at once.
CHUNK = 300_000

# The word pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file: itself, or the next one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary(dict):
    """Maps a word to its ids as 32-bit integers in bytes; missing words are encoded and kept."""

    def __init__(self, content: str):
        model = json.loads(content)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        ids = {raw(token): i for token, i in model["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        self.pattern = regex.compile(PATTERN)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.arrow = pa.array(self.bytes_of, pa.large_binary())
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = array("i", self.merged(word.encode())).tobytes()
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.before = self.copy()
                self.clear()
            self[word] = ids
        return ids

    def merged(self, word: bytes) -> list[int]:
        """The ids of one word."""
        symbols = [self.byte_ids[b] for b in word]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges, heap = self.merges, []
        for i in range(n - 1):
            if (found := merges.get((symbols[i], symbols[i + 1]))) is not None:
                heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i] if symbols[i] == left else n
            if j >= n or symbols[j] != right:
                continue  # stale: one of the two has been merged since
            symbols[i], symbols[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (found := merges.get((new, symbols[k]))) is not None:
                    heapq.heappush(heap, (found[0], i, new, symbols[k], found[1]))
            if (h := before[i]) >= 0 and (found := merges.get((symbols[h], new))) is not None:
                heapq.heappush(heap, (found[0], h, symbols[h], new, found[1]))
        return [s for s in symbols if s >= 0]

    def encoded(self, text: str) -> np.ndarray:
        """The ids of one text."""
        out, start = [], 0
        for found in [*(self.cut.finditer(text) if self.cut else ()), None]:
            part = text[start : found.start() if found else len(text)]
            words = (m.group() for m in self.pattern.finditer(part)) if len(part) > CHUNK else self.pattern.findall(part)
            out += map(self.__getitem__, words)
            if found:
                out.append(array("i", [self.special[found.group()]]).tobytes())
                start = found.end()
        return np.frombuffer(b"".join(out), np.int32)


@lru_cache(2)
def vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


def _with(table: DataFrame, column: str, new: str, kind: T.DataType, function) -> DataFrame:
    """table with one more column, computed from another's Arrow array in runs of rows."""
    if new in table.columns:
        raise ValueError(f"the table has a column {new} already")
    at = table.columns.index(column)

    def per_batch(batches):
        for batch in batches:
            for rows, made in function(batch, at):
                yield pa.RecordBatch.from_arrays([*rows.columns, made], [*rows.schema.names, new])

    return mapped(table, per_batch, T.StructType([*table.schema.fields, T.StructField(new, kind)]))


def encode(table: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """table with the column ids (array of int): the whole text encoded without extra special tokens.

    vocabulary_path: a byte-level BPE file on the driver; its content (a few MB) is broadcast. All
    columns stay; a column with the name of the new one is an error.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        sent = table.sparkSession.sparkContext.broadcast(file.read())

    def encoded(batch, at):
        own = vocabulary(sent.value)
        column, start = batch.column(at), 0
        while start < batch.num_rows:
            arrays, stop, n = [], start, 0
            while stop < batch.num_rows and n < CHUNK:
                value = column[stop].as_py() or ""
                arrays.append(own.encoded(value))
                stop, n = stop + 1, n + len(value)
            offsets = np.zeros(len(arrays) + 1, np.int32)
            np.cumsum([len(a) for a in arrays], out=offsets[1:])
            yield batch.slice(start, stop - start), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))
            start = stop

    return _with(table, text, ids, T.ArrayType(T.IntegerType()), encoded)


def decode(table: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """table with the column text: its ids' bytes joined, special tokens kept, broken UTF-8 replaced by U+FFFD."""
    with open(vocabulary_path, encoding="utf-8") as file:
        sent = table.sparkSession.sparkContext.broadcast(file.read())

    def decoded(batch, at):
        own = vocabulary(sent.value)
        for start in range(0, batch.num_rows, 256):
            rows = batch.slice(start, 256)
            lists = rows.column(at)
            pieces = pc.take(own.arrow, pc.list_flatten(lists))
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            at_byte = np.frombuffer(pieces.buffers()[1], np.int64)[np.concatenate([[0], ends]).astype(np.int64)] if len(pieces) else np.zeros(len(ends) + 1, np.int64)
            data = pieces.buffers()[2].to_pybytes() if len(pieces) else b""
            yield rows, pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(at_byte[:-1], at_byte[1:])], pa.string())

    return _with(table, ids, text, T.StringType(), decoded)


def round_trip(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, text (null: empty), ids and the text decoded from them."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return decode(encode(texts, vocabulary_path), vocabulary_path)
