"""Approximate nearest neighbours: robust-pruned directed graphs, one a shard, searched by beams.

Distinct vectors are dealt into shards of bounded size. In a shard vectors are inserted in batches:
a greedy search over the graph so far proposes neighbours, and robust pruning keeps the nearest one
and drops those that are clearly nearer to it than to the vector, again and again; the relaxed factor
``ALPHA`` keeps some longer, diverse edges. Reverse edges are added and pruned alike. A query walks
every shard's graph from its central vector with a beam of ``BEAM`` and keeps its best; the shards'
answers are merged and scored in double precision on the original vectors.

Nearness is the inner product. The graph works on distances of vectors with one more component that
gives all the same norm, which order as the inner product does.

Rows with a null id, a null, zero, empty or non-finite vector take no part; vectors meet only those of
their own length. Equal vectors are one entry that carries its smallest ids, as many as a query can
return, so copies cost nothing. A query never returns rows with its own id.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.shipping import mapped, ship
from ledgerline.sources.landing import land

SHARD, DEGREE, ALPHA, BUILD_BEAM, BEAM = 8192, 32, 1.2, 64, 160
#: Query vectors searched together, and vectors inserted together.
BLOCK, BATCH = 1024, 256


def _levelled(x: np.ndarray) -> np.ndarray:
    """x with a component more, so that all rows have the largest row's norm."""
    norms = np.einsum("ij,ij->i", x, x)
    return np.hstack([x, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]]).astype(np.float32)


def beam_search(x: np.ndarray, near: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of the beam of each query, nearest first; -1 where there are fewer."""
    m = len(queries)
    seen = np.zeros((m, len(x)), bool)
    ids = np.full((m, beam), -1, np.int32)
    far = np.full((m, beam), np.inf, np.float32)
    done = np.ones((m, beam), bool)
    ids[:, 0], done[:, 0], seen[:, entry] = entry, False, True
    far[:, 0] = ((queries - x[entry]) ** 2).sum(1)
    norms = np.einsum("ij,ij->i", x, x)
    own = np.einsum("ij,ij->i", queries, queries)
    active = np.arange(m)
    while len(active):
        open_far = np.where(done[active], np.inf, far[active])
        first = open_far.argmin(1)
        going = np.isfinite(open_far[np.arange(len(active)), first])
        active, first = active[going], first[going]
        if not len(active):
            break
        done[active, first] = True
        step = near[ids[active, first]]
        fresh = (step >= 0) & ~seen[active[:, None], step]
        seen[active[:, None], np.where(fresh, step, entry)] = True
        dist = norms[step] - 2 * np.einsum("mrd,md->mr", x[step], queries[active]) + own[active][:, None]
        dist = np.where(fresh, dist, np.inf)
        all_far = np.hstack([far[active], dist])
        best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        rows = np.arange(len(active))[:, None]
        far[active] = all_far[rows, best]
        ids[active] = np.hstack([ids[active], step])[rows, best]
        done[active] = np.hstack([done[active], np.zeros(step.shape, bool)])[rows, best]
    order = far.argsort(1, kind="stable")
    rows = np.arange(m)[:, None]
    far, ids = far[rows, order], ids[rows, order]
    return np.where(np.isfinite(far), ids, -1), far


def pruned(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """Robust pruning: up to ``degree`` of each point's candidates (-1: none)."""
    m, k = candidates.shape
    candidates = np.where(candidates == points[:, None], -1, candidates)
    dist = ((x[candidates] - x[points][:, None, :]) ** 2).sum(2)
    dist = np.where(candidates < 0, np.inf, dist)
    order = dist.argsort(1, kind="stable")
    rows = np.arange(m)[:, None]
    candidates, dist = candidates[rows, order], dist[rows, order]
    dist[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = np.inf
    vectors = x[candidates]
    norms = np.einsum("mkd,mkd->mk", vectors, vectors)
    out = np.full((m, degree), -1, np.int32)
    alive = np.isfinite(dist)
    flat = np.arange(m)
    for i in range(degree):
        pick = np.where(alive, dist, np.inf).argmin(1)
        some = alive[flat, pick]
        if not some.any():
            break
        out[some, i] = candidates[flat, pick][some]
        chosen = vectors[flat, pick]
        between = norms - 2 * np.einsum("mkd,md->mk", vectors, chosen) + norms[flat, pick][:, None]
        alive &= ALPHA * ALPHA * between > dist
        alive[flat, pick] = False
    return out


def built(x: np.ndarray) -> tuple[np.ndarray, int]:
    """(neighbours, entry) of the graph of levelled vectors."""
    n = len(x)
    near = np.full((n, DEGREE), -1, np.int32)
    entry = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    order = np.random.default_rng(1).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    at, size = 1, 16
    while at < n:
        points = order[at : at + size]
        found, _ = beam_search(x, near, entry, x[points], BUILD_BEAM)
        within = np.full((len(points), min(len(points), 64)), -1, np.int32)
        if len(points) > 1:  # vectors of one batch do not meet in the search
            gaps = np.einsum("ij,ij->i", x[points], x[points])[None, :] - 2 * x[points] @ x[points].T
            within = points[np.argsort(gaps, axis=1)[:, : within.shape[1]]].astype(np.int32)
        near[points] = pruned(x, points, np.hstack([found, within[:, :16]]), DEGREE)
        heads, tails = near[points].reshape(-1), np.repeat(points, DEGREE)
        heads, tails = heads[heads >= 0], tails[heads >= 0]
        by = np.argsort(heads, kind="stable")
        heads, tails = heads[by], tails[by]
        targets, starts, counts = np.unique(heads, return_index=True, return_counts=True)
        extra = np.full((len(targets), counts.max() if len(counts) else 0), -1, np.int32)
        extra[np.repeat(np.arange(len(targets)), counts), np.arange(len(heads)) - np.repeat(starts, counts)] = tails
        for i in range(0, len(targets), 512):
            part = targets[i : i + 512]
            near[part] = pruned(x, part, np.hstack([near[part], extra[i : i + 512]]), DEGREE)
        at, size = at + size, min(BATCH, 2 * size)
    return near, entry


def _packed(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles), vid (hash of the vector) of the rows that take part."""
    table = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = F.forall("embedding", lambda x: F.coalesce(finite(x), F.lit(False))) & F.exists("embedding", lambda x: x != 0)
    return table.where("vec_id is not null").where(good).withColumn("vid", F.xxhash64(F.transform("embedding", lambda x: x + F.lit(0.0))))


def nearest(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row where ``is_query`` holds; ties to the smaller vec_id.

    vectors: vec_id and embedding; other columns are ignored.
    """
    ship(vectors.sparkSession)
    rows = land(valid(vectors), "vectors")
    first = F.row_number().over(Window.partitionBy("vid").orderBy("vec_id"))
    few = rows.select("vid", "vec_id").distinct().withColumn("i", first).where(F.col("i") <= k + 1).groupBy("vid").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    distinct = rows.groupBy("vid").agg(F.first("embedding").alias("embedding")).join(few, "vid")
    distinct = land(distinct, "distinct_vectors")
    shards = -(-max(1, distinct.count()) // SHARD)
    shard = F.pmod("vid", F.lit(shards)).cast("int")

    def build(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, own in part.groupby(part["embedding"].map(len)):
            own = own.sort_values("vid")
            vectors = np.stack(own["embedding"].to_numpy())
            scale = np.abs(vectors).max()
            x = _levelled(vectors / scale)
            near, entry = built(x)
            out.append((int(own["shard"].iloc[0]), int(dim), _packed(vid=own["vid"].to_numpy(), vectors=vectors, x=x, near=near, entry=entry, scale=scale)))
        return pd.DataFrame(out, columns=["shard", "dim", "graph"])

    graphs = distinct.select("vid", "embedding", shard.alias("shard")).groupBy("shard").applyInPandas(build, "shard int, dim int, graph binary")
    graphs = land(graphs, "graphs")
    asked = land(rows.where(is_query).select("vid", F.col("vec_id").alias("query_id")).distinct(), "queries")
    wanted = distinct.select("vid", "embedding").join(asked.select("vid").distinct(), "vid", "left_semi")
    n_blocks = -(-max(1, asked.select("vid").distinct().count()) // BLOCK)
    block = F.pmod(F.xxhash64("vid"), F.lit(n_blocks))
    blocks = wanted.groupBy(F.size("embedding").alias("dim"), block.alias("block")).agg(F.collect_list(F.struct("vid", "embedding")).alias("queries"))
    tasks = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(graphs, ["shard", "dim"]).select("queries", "graph")

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                graph = np.load(io.BytesIO(batch.column("graph")[i].as_py()))
                vid, vectors, x, near = (graph[c] for c in ("vid", "vectors", "x", "near"))
                asked = batch.column("queries")[i].values
                names = asked.field("vid").to_numpy()
                own = np.stack(asked.field("embedding").to_numpy(zero_copy_only=False))
                norm = np.sqrt((own * own).sum(1, keepdims=True))
                reach = np.float64(np.sqrt((x[0].astype(float) ** 2).sum()))
                q = np.hstack([own / norm * reach, np.zeros((len(own), 1))]).astype(np.float32)
                for start in range(0, len(q), BATCH):
                    ids, _ = beam_search(x, near, int(graph["entry"]), q[start : start + BATCH], min(BEAM, len(x)))
                    ids = ids[:, : 2 * k + 2]
                    score = np.einsum("mkd,md->mk", vectors[ids], own[start : start + BATCH])
                    score = np.where(ids < 0, -np.inf, score)
                    best = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
                    rows_ = np.arange(len(ids))[:, None]
                    keep = (ids[rows_, best] >= 0).reshape(-1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(names[start : start + BATCH], best.shape[1])[keep]),
                            pa.array(vid[ids[rows_, best]].reshape(-1)[keep]),
                            pa.array(score[rows_, best].reshape(-1)[keep]),
                        ],
                        ["asked", "vid", "score"],
                    )

    found = land(mapped(tasks, search, "asked long, vid long, score double"), "found")
    each = found.join(distinct.select("vid", "ids"), "vid").select("asked", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    each = each.withColumn("i", F.row_number().over(best)).where(F.col("i") <= k + 1).drop("i")
    pairs = asked.withColumnRenamed("vid", "asked").join(each, "asked").where("query_id <> vec_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
