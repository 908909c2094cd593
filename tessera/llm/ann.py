"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by a pseudo-random rotation, three rounds of random
signs and a fast Hadamard transform, and hashed to the nearest signed axis
of the rotated space.  ``TABLES`` rotations give as many tables of
``2 x padded dimension`` buckets.  A query probes, in every table, the
``probes`` buckets whose axes lie nearest to it; the union of those buckets
is its candidate set, reranked by the exact cosine in double precision.

Every row is indexed.  Queries are a stated set: they are taken in blocks of
about ``QUERY_BLOCK`` rows, each block broadcast to one pass over all rows.
A task hashes its rows, looks the buckets up, scores the candidates and
keeps the best ``k`` per query, so a bucket that holds a third of all rows
stays spread over the tasks that read them, and only ``k`` rows per query
and task are shuffled.  Queries whose buckets held fewer than ``k`` rows get
one more such pass in which every row is a candidate.

Defined cases: vectors that are null, empty, zero, or hold a null or
non-finite component take no part; vectors of another dimension than the
query are no candidates; ties go to the smaller id; rows sharing an id are
never each other's neighbours, and the first by value is the query; an id
that is null is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ship, stage

TABLES = 12
PROBES = 0.047    # share of a table's buckets that a query probes, two at least
QUERY_BLOCK = 4096
CHUNK = 4096
NEAREST = "query_id long, vec_id long, score double"


def signs(dim: int, table: int, rounds: int = 3):
    """The table's random signs, the same in every process."""
    rng = np.random.Generator(np.random.PCG64([dim, table, 0x5EED]))
    return rng.choice(np.array([-1.0, 1.0]), (rounds, dim))


def rotate(x, table: int):
    """Pseudo-rotation H D3 H D2 H D1 of the rows of ``x``, zero-padded to a
    power of two (scaled by a constant, which does not move the nearest axis)."""
    n, d = x.shape
    size = 1 << max(0, (d - 1).bit_length())
    y = np.zeros((n, size))
    y[:, :d] = x
    for sign in signs(size, table):
        y *= sign
        h = 1
        while h < size:
            z = y.reshape(n, size // (2 * h), 2, h)
            y = np.stack((z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]), axis=2).reshape(n, size)
            h *= 2
    return y


def buckets(x, table: int):
    """Nearest signed axis of each row: axis number, plus ``size`` if negative."""
    y = rotate(x, table)
    axis = np.abs(y).argmax(axis=1)
    return axis + np.where(y[np.arange(len(y)), axis] < 0, y.shape[1], 0)


def probe_order(x, table: int, probes: int):
    """The ``probes`` nearest signed axes of each row, nearest first."""
    y = rotate(x, table)
    return np.argsort(-np.concatenate((y, -y), axis=1), axis=1, kind="stable")[:, :probes]


def _by_dimension(ids, vectors) -> dict:
    """dimension -> (ids, float64 matrix) of the usable vectors."""
    found: dict[int, tuple[list, list]] = {}
    for i, v in zip(ids, vectors, strict=True):
        if i is None or v is None or len(v) == 0 or any(c is None for c in v):
            continue
        a = np.asarray(v, np.float64)
        if np.isfinite(a).all() and a.any():
            found.setdefault(len(a), ([], []))
            found[len(a)][0].append(i)
            found[len(a)][1].append(a)
    return {d: (np.array(i, np.int64), np.stack(m)) for d, (i, m) in found.items()}


def _norms(x):
    # scale first: squares of very large or small components stay finite
    top = np.abs(x).max(axis=1, keepdims=True)
    return top[:, 0] * np.sqrt(((x / top) ** 2).sum(axis=1))


def _best(scores, ids, k: int):
    """Places of the best score of each of the ``k`` best distinct ids."""
    order = np.lexsort((ids, -scores))
    size = 2 * k
    while True:
        _, first = np.unique(ids[order[:size]], return_index=True)
        if len(first) >= k or size >= len(order):
            return order[np.sort(first)[:k]]
        size *= 4


def _search(queries_bc, k: int, tables: int, share: float | None):
    """Tasks' best ``k`` per query; without a ``share`` every row is a candidate."""
    tables = 0 if share is None else tables

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        prepared = {}
        for d, (ids, q) in queries_bc.value.items():
            size = 2 << max(0, (d - 1).bit_length())
            n = min(size, max(2, math.ceil(size * (share or 0))))
            prepared[d] = (ids, q / _norms(q)[:, None],
                           [probe_order(q, t, n) for t in range(tables)])
        best = {d: [(np.empty(0), np.empty(0, np.int64))] * len(p[0]) for d, p in prepared.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                rows = _by_dimension(part.column(0).to_pylist(), part.column(1).to_pylist())
                for d, (ids, x) in rows.items():
                    if d not in prepared:
                        continue
                    qids, q, probes = prepared[d]
                    unit = x / _norms(x)[:, None]
                    lists = []
                    for t in range(tables):
                        b = buckets(x, t)
                        order = np.argsort(b, kind="stable")
                        lists.append((order, np.searchsorted(b[order], np.arange(4 * d + 4))))
                    for j in range(len(qids)):
                        mark = np.full(len(ids), share is None)
                        for t, (order, bounds) in enumerate(lists):
                            for b in probes[t][j]:
                                mark[order[bounds[b]:bounds[b + 1]]] = True
                        mark &= ids != qids[j]
                        found = np.flatnonzero(mark)
                        if len(found) == 0:
                            continue
                        s, near = best[d][j]
                        s = np.concatenate((s, (unit[found] * q[j]).sum(axis=1)))
                        near = np.concatenate((near, ids[found]))
                        top = _best(s, near, k)
                        best[d][j] = (s[top], near[top])
        out = [(int(prepared[d][0][j]), int(v), float(s))
               for d in best for j, (ss, vs) in enumerate(best[d]) for s, v in zip(ss, vs, strict=True)]
        cols = list(zip(*out, strict=True)) if out else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
            names=["query_id", "vec_id", "score"])
    return run


def nearest(rows: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id",
            vector: str = "embedding", tables: int = TABLES, probes: float = PROBES,
            block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found."""
    ship()
    sc = rows.sparkSession.sparkContext
    data = rows.select(F.col(key).cast("long").alias("_id"), F.col(vector).alias("_v"))
    queries = (rows.where(is_query & F.col(key).isNotNull())
               .groupBy(F.col(key).cast("long").alias("_id")).agg(F.min(vector).alias("_v")))

    def search(queries: DataFrame, share: float | None) -> DataFrame | None:
        """One pass over all rows for each block of usable queries."""
        found = None
        blocks = max(1, -(-queries.count() // block))
        for b in range(blocks):
            part = queries.where(F.pmod(F.xxhash64("_id"), F.lit(blocks)) == b).collect()
            usable = _by_dimension([r[0] for r in part], [r[1] for r in part])
            if usable:
                hits = data.mapInArrow(_search(sc.broadcast(usable), k, tables, share), NEAREST)
                found = hits if found is None else found.unionByName(hits)
        return found

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        # several tasks may report the same id once each when rows repeat
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return (found.withColumn("rank", F.row_number().over(order).cast("int"))
                .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))

    found = search(queries, probes)
    if found is None:
        return ranked(rows.sparkSession.createDataFrame([], NEAREST))
    found = stage(ranked(found), "nearest")
    # queries whose buckets held fewer than k rows are searched among all rows
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("_id"))
    more = search(queries.join(full, "_id", "left_anti"), None)
    return found if more is None else ranked(found.drop("rank").unionByName(more))
