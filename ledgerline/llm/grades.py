"""Quality by ordinal cumulative-link regression on graded ratings.

A rating's grades are ordered: 0 toxic, 1 poor, 2 good. One linear score of hashed text features is
shared by all grades; ordered thresholds cut it: P(grade <= k) = logistic(threshold_k - score). That
gives the expected grade and the probability of at least some grade, by which documents are selected.

Features: each distinct word (lower case), its beginnings and each run of symbols, hashed, weighing
less each the more there are; and the shape of the text in hashed steps (repeated neighbours, capitals,
symbols, distinct words, length). The model is fitted on a bounded sample of the rated documents, the
``fit_rows`` with the smallest hash of doc_id; features are computed in tasks over whole texts and
one task fits the model.

Null and empty texts have no features; they get the grade that the thresholds give a score of the
bias alone. Without ratings everything is selected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.arrays import chunks, mixed, slices
from ledgerline.llm.shipping import mapped
from ledgerline.sources.landing import land

#: Buckets of hashed features.
BUCKETS = 1 << 18
#: Rated documents that a model is fitted on, at most.
FIT_ROWS = 12_000
#: Bytes of the word beginnings that are features as well.
PREFIXES = (4, 5, 6)

_KIND = np.full(256, 1, np.uint8)  # 0 white space, 1 letters, digits and bytes beyond ASCII, 2 symbols
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 2
_KIND[[*range(0, 33), 127]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def _step(x: np.ndarray, steps: int) -> np.ndarray:
    return np.minimum((x * steps).astype(np.int64), steps)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of all features of some texts, texts in order."""
    n_texts = len(offsets) - 1
    kind = _KIND[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    bounds = np.flatnonzero(edge)
    starts, ends = bounds[:-1], bounds[1:]
    own = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[own], ends[own]
    hashes = slices(_VALUES[_LOWER[data]], starts, ends)
    text = np.searchsorted(offsets, starts, "right") - 1
    symbol = kind[starts] == 2
    named, owners = [hashes], [text]
    for length in PREFIXES:  # words that begin alike
        longer = (ends - starts > length) & ~symbol
        named.append(mixed(slices(_VALUES[_LOWER[data]], starts[longer], starts[longer] + length) + np.uint64(length)))
        owners.append(text[longer])
    pairs = np.unique((np.concatenate(owners) << 18) | (np.concatenate(named) >> np.uint64(46)).astype(np.int64))
    of, bucket = pairs >> 18, pairs & (BUCKETS - 1)
    distinct = np.bincount(of, minlength=n_texts)
    value = np.maximum(distinct, 1)[of] ** -0.25

    def per_text(flags):
        return np.bincount(text[flags], minlength=n_texts)

    word = ~symbol
    many, words_of, word_hashes = np.maximum(per_text(word), 1), text[word], hashes[word]
    again = np.zeros(n_texts, np.int64)
    if len(word_hashes) > 1:
        same = (word_hashes[1:] == word_hashes[:-1]) & (words_of[1:] == words_of[:-1])
        again = np.bincount(words_of[1:][same], minlength=n_texts)
    upper_total = np.concatenate([[0], np.cumsum(_UPPER[data])])
    capitals = np.bincount(text[word], (upper_total[ends] - upper_total[starts] == ends - starts)[word] & ((ends - starts)[word] > 1), minlength=n_texts)
    shapes = [
        _step(again / many, 16), _step(capitals / many, 16), _step(per_text(symbol) / many, 16), _step(distinct / many, 8),
        np.minimum(np.log2(many).astype(np.int64), 12),
    ]
    filled = np.flatnonzero(distinct)
    for i, shape in enumerate(shapes):
        of = np.concatenate([of, filled])
        bucket = np.concatenate([bucket, (mixed((shape[filled] + 1000 * (i + 1)).astype(np.uint64)) >> np.uint64(46)).astype(np.int64)])
        value = np.concatenate([value, np.full(len(filled), 0.5)])
    order = np.argsort(of, kind="stable")
    return of[order], bucket[order], value[order]


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        of, bucket, value = features(data, offsets)
        return np.bincount(of, self.weights[bucket] * value, minlength=len(offsets) - 1)

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1 on, one row a text."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))


def fitted(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int, epochs: int | None = None, rate: float = 0.5, decay: float = 1e-6) -> Model:
    """The model of rows (grade, buckets, values): adaptive gradient steps; rare grades weigh more, to the root of their rarity."""
    weights, squares = np.zeros(BUCKETS), np.full(BUCKETS, 1e-4)
    low, steps = -2.0, np.ones(grades - 2) * np.log(1.0)
    thresholds = lambda: low + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
    counts = np.bincount([g for g, _, _ in rows], minlength=grades)
    if not rows or np.count_nonzero(counts) < 2:
        return Model(weights, np.full(grades - 1, -20.0) + np.arange(grades - 1))
    importance = np.sqrt(len(rows) / grades / np.maximum(counts, 1))
    epochs = epochs or max(12, 150_000 // len(rows))
    draw = np.random.default_rng(7)
    for epoch in range(epochs):
        order = draw.permutation(len(rows))
        for at in range(0, len(order), 128):
            batch = [rows[i] for i in order[at : at + 128]]
            grade = np.array([g for g, _, _ in batch])
            bucket = np.concatenate([b for _, b, _ in batch])
            value = np.concatenate([v for _, _, v in batch])
            of = np.repeat(np.arange(len(batch)), [len(b) for _, b, _ in batch])
            score = np.bincount(of, weights[bucket] * value, minlength=len(batch))
            cut = np.concatenate([[-np.inf], thresholds(), [np.inf]])
            below = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))
            upper, lower = below(cut[grade + 1] - score), below(cut[grade] - score)
            p = np.maximum(upper - lower, 1e-9)
            slope_up, slope_low = upper * (1 - upper) * np.isfinite(cut[grade + 1]), lower * (1 - lower) * np.isfinite(cut[grade])
            by_score = importance[grade] * (slope_up - slope_low) / p  # of the negative log likelihood
            slope = np.bincount(bucket, by_score[of] * value, minlength=BUCKETS)
            touched = np.unique(bucket)
            g = slope[touched] / len(batch) + decay * weights[touched]
            squares[touched] += g * g
            weights[touched] -= rate * g / np.sqrt(squares[touched])
            by_cut = np.zeros(grades + 1)
            np.add.at(by_cut, grade + 1, -importance[grade] * slope_up / p / len(batch))
            np.add.at(by_cut, grade, importance[grade] * slope_low / p / len(batch))
            by_cut = by_cut[1:-1]
            low -= 0.05 * by_cut.sum()
            for i in range(len(steps)):
                steps[i] = np.clip(steps[i] - 0.05 * by_cut[i + 1 :].sum() * np.exp(steps[i]), -3, 3)
    return Model(weights, thresholds())


def rated(labels: DataFrame) -> DataFrame:
    """doc_id and grade of each rated document: 0 toxic, 1 poor, 2 good; the worst of several ratings."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade")).where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, grades: int = 3, fit_rows: int = FIT_ROWS) -> Model:
    """A model of the documents' ratings (doc_id, grade), at most ``fit_rows`` of them: those with the smallest hash."""
    chosen = land(ratings.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "ratings")
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def made(batches):
        for batch in batches:
            for row, data, offsets in chunks(batch.column("text")):
                of, bucket, value = features(data, offsets)
                cuts = np.searchsorted(of, np.arange(1, len(offsets) - 1))
                part = batch.slice(row, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("grade").cast(pa.int32()), pa.array([x.astype(np.int32).tobytes() for x in np.split(bucket, cuts)], pa.binary()), pa.array([x.astype(np.float32).tobytes() for x in np.split(value, cuts)], pa.binary())],
                    ["doc_id", "grade", "bucket", "value"],
                )

    def trained(batches):
        rows = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "grade", "bucket", "value"))):
                rows.append(row)
        rows = [(g, np.frombuffer(b, np.int32), np.frombuffer(v, np.float32)) for _, g, b, v in sorted(rows)]
        model = fitted(rows, grades)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.thresholds.tobytes()], pa.binary())], ["weights", "thresholds"])

    # A document that is repeated counts once, so one task gets fit_rows feature lists at most.
    once = mapped(sample, made, "doc_id long, grade int, bucket binary, value binary").dropDuplicates(["doc_id"])
    found = mapped(once.repartition(1), trained, "weights binary, thresholds binary").collect()
    if not found:
        return fitted([], grades)
    return Model(np.frombuffer(bytes(found[0]["weights"])), np.frombuffer(bytes(found[0]["thresholds"])))


def selected(docs: DataFrame, model: Model, least_grade: int = 2, probability: float = 0.5) -> DataFrame:
    """The rows of docs whose grade is at least ``least_grade`` with that probability; columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches):
        for batch in batches:
            column = batch.column(batch.schema.names.index("text"))
            for row, data, offsets in chunks(column):
                tail = sent.value.at_least(sent.value.scores(data, offsets))[:, least_grade - 1]
                yield batch.slice(row, len(offsets) - 1).filter(pa.array(tail >= probability))

    return mapped(docs, kept, docs.schema)


def graded(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_grade and tail (P(grade >= k) for k from 1 on) of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            for row, data, offsets in chunks(batch.column("text")):
                tail = sent.value.at_least(sent.value.scores(data, offsets))
                part = batch.slice(row, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(tail.sum(1)), pa.array(list(tail), pa.list_(pa.float64()))], ["doc_id", "expected_grade", "tail"])

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), scored, "doc_id long, expected_grade double, tail array<double>")
