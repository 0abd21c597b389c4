"""Nearest neighbours over vectors for a stated query set, in blocks.

The query vectors go to the tasks in blocks of at most ``BLOCK`` rows, one block at a time; every row meets each
block once in a vectorised product.  ``nearest`` keeps the best ``k`` of each batch per query, and a final ranking
per query merges them; ``near_counts`` counts all partners above given cosines.
Null, empty or zero vectors and vectors of another length than the query's are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docstrata.sources.tables import cut

BLOCK = 4096


def unit(rows: list) -> np.ndarray:
    m = np.array(rows, dtype=np.float64)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def usable_rows(rows: DataFrame, key: str, column: str) -> DataFrame:
    good = F.col(column).isNotNull() & (F.size(column) > 0) & (F.aggregate(column, F.lit(0.0), lambda a, x: a + x * x) > 0)
    return rows.filter(good & F.col(key).isNotNull())


def against_blocks(vectors: DataFrame, queries: DataFrame, key: str, column: str, schema: str, scored: Callable) -> DataFrame:
    """Rows of ``scored(query ids, row keys, similarities)`` for each block of queries and batch of rows.

    One block is on its way at a time: its result is written before the next block is taken.
    """
    vectors = usable_rows(vectors, key, column)
    q = usable_rows(queries, key, column).select(key, column).distinct()
    dim = vectors.agg(F.max(F.size(column)).alias("d")).first()["d"] or 0
    rows = vectors.filter(F.size(column) == dim).select(key, column)
    blocks = max(1, -(-q.count() // BLOCK))
    out = None
    for b in range(blocks):
        part = (q if blocks == 1 else q.filter(F.pmod(F.xxhash64(key), F.lit(blocks)) == b)).filter(F.size(column) == dim).orderBy(key).toArrow()
        packed = vectors.sparkSession.sparkContext.broadcast((part.column(0).to_numpy(), np.array(part.column(1).to_pylist(), dtype=np.float64).reshape(-1, dim)))

        def run(batches: Iterator[pa.RecordBatch], packed=packed) -> Iterator[pa.RecordBatch]:
            ids, qs = packed.value
            if not len(ids):
                return
            qs = qs / np.linalg.norm(qs, axis=1, keepdims=True)
            for rb in batches:
                if rb.num_rows:
                    keys = rb.column(0).to_numpy()
                    s = np.round(qs @ unit(rb.column(1).to_pylist()).T, 9)
                    s[ids[:, None] == keys[None, :]] = -np.inf
                    yield scored(ids, keys, s)

        got = rows.mapInArrow(run, schema)
        if blocks > 1:
            got = cut(got)
            packed.unpersist()
        out = got if out is None else out.unionByName(got)
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """q, key, similarity, rank: the ``k`` nearest other rows of each query by cosine, ties by key."""

    def best(ids: np.ndarray, keys: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
        least = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(ids), -np.inf)
        i, j = np.nonzero((s >= least[:, None]) & np.isfinite(s))
        order = np.lexsort((keys[j], -s[i, j], i))
        i, j = i[order], j[order]
        start = np.searchsorted(i, i)
        top = np.arange(len(i)) - start < k
        i, j = i[top], j[top]
        return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(keys[j]), pa.array(s[i, j])], names=["q", "key", "similarity"])

    out = against_blocks(vectors, queries, key, column, "q bigint, key bigint, similarity double", best)
    w = Window.partitionBy("q").orderBy(F.desc("similarity"), "key")
    return out.distinct().withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).withColumnRenamed("key", key)


def near_counts(vectors: DataFrame, queries: DataFrame, levels: Sequence[float], key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """q, level, n: how many other rows reach each of these cosines, for queries with any; all partners count."""

    def count(ids: np.ndarray, keys: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
        n = np.stack([(s >= x).sum(1) for x in levels], 1)
        i, j = np.nonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(np.array(levels, dtype=np.float64)[j]), pa.array(n[i, j].astype(np.int64))], names=["q", "level", "n"])

    rows = vectors.dropDuplicates([key])
    return against_blocks(rows, queries.dropDuplicates([key]), key, column, "q bigint, level double, n bigint", count).groupBy("q", "level").agg(F.sum("n").alias("n"))
