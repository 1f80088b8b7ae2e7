"""Exact top-k inner-product search by block-at-a-time pruning.

Components become integers, floor(scale * x); a component with its sign is a
term. Vectors lie in blocks (ranges of an order in which similar vectors are
neighbours); a block keeps the maximum and minimum of every component. For a
query, the sum of its components times a block's maxima (minima where the
component is negative) bounds every score in the block. Each query visits blocks
by falling bound and scores them through the block's forward index, its rows,
until the next bound falls below its k-th score; equal bounds are still visited,
since a tie may have the smaller id.

The work is dealt as (shard of vectors, chunk of queries): both have a bounded
number of rows, and every pair of them is one group of a cogroup. The best k of
each group then meet in a window per query.

Defined results: vectors that are null, or that hold null or non-finite
components, or have a null id, take no part; shorter vectors count as padded with
zeros; rows that share the query's id are its own; of query rows that repeat an
id, the one with the largest vector asks; repeated candidate rows are candidates
each; scores beyond the range of a long are cut to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.common import ship_code, written


def integer_rows(vectors: pa.ChunkedArray, scale: int) -> np.ndarray:
    """floor(scale * x) as float64 (whole numbers), padded with zeros."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.asarray(flat.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    values = np.floor(np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64) * scale)
    wide = int(sizes.max()) if len(sizes) else 0
    if len(sizes) and (sizes == wide).all():
        return values.reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide))
    out[np.arange(wide) < sizes[:, None]] = values
    return out


def neighbour_order(rows: np.ndarray, clusters: int, rounds: int = 2) -> np.ndarray:
    """An order of the rows in which similar ones stand together: a few rounds of spherical k-means."""
    n = len(rows)
    if n <= clusters or not rows.shape[1]:
        return np.arange(n)
    unit = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1.0)
    centres = unit[np.linspace(0, n - 1, clusters).astype(int)]
    for _ in range(rounds):
        near = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    scores = unit @ centres.T
    near = scores.argmax(axis=1)
    return np.lexsort((-scores[np.arange(n), near], near))


def best_of_blocks(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int,
                   block_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query position, id, score) of each query's k best rows, and how many blocks were scored."""
    wide = max(queries.shape[1], rows.shape[1])
    queries = np.pad(queries, ((0, 0), (0, wide - queries.shape[1])))
    rows = np.pad(rows, ((0, 0), (0, wide - rows.shape[1])))
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(wide, 1)
    exact = largest < 2 ** 52  # else whole numbers of any size, slower
    if not exact:
        queries, rows = (np.array([[int(x) for x in r] for r in m], dtype=object).reshape(len(m), wide)
                         for m in (queries, rows))
    order = neighbour_order(np.asarray(rows, np.float64), max(1, len(ids) // block_rows))
    ids, rows = ids[order], rows[order]
    starts = np.arange(0, len(ids), block_rows)
    most, least = np.maximum.reduceat(rows, starts), np.minimum.reduceat(rows, starts)
    bounds = np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T
    if exact:
        falling = np.argsort(-bounds, axis=1, kind="stable")
    else:  # beyond floats: sort the whole numbers themselves
        falling = np.array([sorted(range(len(starts)), key=lambda b, r=r: -r[b]) for r in bounds]).reshape(bounds.shape)
    low = -np.inf if exact else -(10 ** 1000)
    top_s = np.full((len(queries), k), low, dtype=queries.dtype)
    top_i = np.full((len(queries), k), np.iinfo(np.int64).max)
    active, scored = np.arange(len(queries)), 0
    for wave in range(len(starts)):
        block = falling[active, wave]
        go = bounds[active, block] >= top_s[active, k - 1]
        go = np.asarray(go, bool)
        active, block = active[go], block[go]
        if not len(active):
            break
        for b in np.unique(block):
            own, at = active[block == b], slice(starts[b], starts[b] + block_rows)
            score = queries[own] @ rows[at].T
            score[query_ids[own][:, None] == ids[at][None, :]] = low
            scored += len(own)
            s = np.concatenate([top_s[own], score], axis=1)
            i = np.concatenate([top_i[own], np.broadcast_to(ids[at], score.shape)], axis=1)
            if exact:
                pick = np.lexsort((i, -s), axis=1)[:, :k]
            else:
                pick = np.array([sorted(range(s.shape[1]), key=lambda c, r=r: (-s[r, c], i[r, c]))[:k]
                                 for r in range(len(own))])
            top_s[own], top_i[own] = np.take_along_axis(s, pick, 1), np.take_along_axis(i, pick, 1)
    q, c = np.nonzero(np.asarray(top_s != low, bool))
    lo, hi = -(2 ** 63), 2 ** 63 - 1
    score = np.array([min(max(int(x), lo), hi) for x in top_s[q, c]], dtype=np.int64)
    return q, top_i[q, c], score, scored


def top_k_search(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, shard_rows: int = 16_384,
                 chunk_rows: int = 1024, block_rows: int = 128, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates. ``is_query``: a column over ``id_col``."""
    ship_code(vectors.sparkSession)
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * F.lit(float(scale))) < F.lit(float("inf"))))
    rows = (vectors.where(F.col(id_col).isNotNull() & is_query.isNotNull() & F.col(vector_col).isNotNull() & sound)
            .select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_v"), is_query.alias("_ask")))
    asked = written(rows.where("_ask").groupBy("_id").agg(F.max("_v").alias("_v")), "search-queries")
    shards = max(1, -(-rows.count() // shard_rows))
    chunks = max(1, -(-asked.count() // chunk_rows))

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        return df.select("_id", "_v", F.pmod(F.xxhash64("_id"), F.lit(parts)).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.int64())})
        query_ids = right.column("_id").to_numpy()
        q, i, s, _ = best_of_blocks(query_ids, integer_rows(right.column("_v"), scale),
                                    left.column("_id").to_numpy(), integer_rows(left.column("_v"), scale),
                                    k, block_rows)
        return pa.table({"query_id": pa.array(query_ids[q], pa.int64()), "vec_id": pa.array(i, pa.int64()),
                         "score": pa.array(s, pa.int64())})

    found = (dealt(rows, "_shard", shards, "_chunk", chunks).groupBy("_shard", "_chunk")
             .cogroup(dealt(asked, "_chunk", chunks, "_shard", shards).groupBy("_shard", "_chunk"))
             .applyInArrow(search, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
