"""Topic clusters: hashed TF-IDF, truncated SVD and k-means, all seeded.

Weights, projection and centres are fitted on all documents: document frequencies, the Gramian and the sums
of the centres are partial aggregates of a size that does not grow with the corpus.  Words are hashed into
``FEATURES`` columns, so that the Gramian stays small.  The texts are read once and become counts by column; these
are weighed batch by batch in tasks.  Fewer than 8 documents with terms give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstrata.operators.text import plain_words
from docstrata.sources.tables import cut, spread

FEATURES = 1024
DIMS = 100
MIN_DF = 5
CACHE_WORDS = 500_000
CHUNK = 2_000  # documents in memory at once


def column_of(word: str) -> int:
    """Murmur3 hash (seed 42) modulo ``FEATURES``, the column that MLlib's HashingTF gives a word."""
    data, h = word.encode(), 42
    tail = len(data) & 3
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
        h ^= k
        if i + 4 <= len(data):
            h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return (h ^ h >> 16) % FEATURES


def column_counts(docs: DataFrame, key: str) -> DataFrame:
    """key, fit, at (columns), n (words in each) of the documents (key, text, fit) with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        for b in (b.slice(i, CHUNK) for b in batches for i in range(0, b.num_rows, CHUNK)):
            size, found = [], []
            for t in b.column(1).to_pylist():
                w = plain_words(t)
                size.append(len(w))
                for x in w:
                    if x not in cache:
                        if len(cache) >= CACHE_WORDS:
                            cache.clear()
                        cache[x] = column_of(x)
                    found.append(cache[x])
            doc = np.repeat(np.arange(len(size)), size)
            pair, n = np.unique(doc * FEATURES + np.array(found, dtype=np.int64), return_counts=True)
            offs = pa.array(np.searchsorted(pair // FEATURES, np.arange(len(size) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offs, pa.array(x)) for x in ((pair % FEATURES).astype(np.int16), n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *lists], names=[key, "fit", "at", "n"]).filter(pa.array(np.array(size) > 0))

    return docs.select(key, "text", "fit").mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, fit boolean, at array<smallint>, n array<int>")


def dense(b: pa.RecordBatch, idf: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of a batch with their weights as rows of unit length; ``at`` and ``n`` are its last two columns."""
    for i in range(0, b.num_rows, CHUNK):
        part = b.slice(i, CHUNK)
        at, n = (part.column(part.num_columns + j).flatten().to_numpy(zero_copy_only=False) for j in (-2, -1))
        doc = np.repeat(np.arange(part.num_rows), [len(x) for x in part.column(part.num_columns - 2)])
        x = np.zeros((part.num_rows, FEATURES))
        x[doc, at] = n * idf[at]
        yield part, x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def topic_clusters(docs: DataFrame, key: str, max_clusters: int = 100, fit: Column | None = None) -> DataFrame:
    """key, cluster, distance to the centre; the model is fitted on the rows where ``fit`` holds, all rows are assigned."""
    spark = docs.sparkSession
    w = spread(docs.select(key, "text", (F.lit(True) if fit is None else F.coalesce(fit, F.lit(False))).alias("fit")))
    tf = cut(column_counts(w, key))
    known = tf.filter("fit").select("at", "n")
    n = known.count()
    if n < 8:
        return tf.select(key, F.lit(0).alias("cluster"), F.lit(0.0).alias("distance")).limit(0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(FEATURES, dtype=np.int64)
        for b in batches:
            df += np.bincount(b.column(0).flatten().to_numpy(zero_copy_only=False), minlength=FEATURES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES, dtype=np.int32)), pa.array(df)], names=["i", "df"])

    got = known.mapInArrow(frequencies, "i int, df bigint").groupBy("i").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(FEATURES, dtype=np.int64)
    df[got.column(0).to_numpy()] = got.column(1).to_numpy()
    weights = spark.sparkContext.broadcast(np.where(df >= MIN_DF, np.log((n + 1.0) / (df + 1.0)), 0.0))

    def gramian(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((FEATURES, FEATURES))
        for b in batches:
            for _, x in dense(b, weights.value):
                g += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES, dtype=np.int32)), pa.array([r.tobytes() for r in g], pa.binary())], names=["i", "row"])

    def summed(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype=np.float64) for x in t.column("row").to_pylist())
        return pa.table({"i": t.column("i")[:1].cast(pa.int32()), "row": pa.array([total.tobytes()], pa.binary())})

    # one pass: the right singular vectors are the leading eigenvectors of the FEATURES x FEATURES Gramian; a part for each core is added up
    parts = known.coalesce(2 * spark.sparkContext.defaultParallelism).mapInArrow(gramian, "i int, row binary")
    got = parts.groupBy("i").applyInArrow(summed, "i int, row binary").toArrow()
    gram = np.zeros((FEATURES, FEATURES))
    for i, row in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
        gram[i] = np.frombuffer(row, dtype=np.float64)
    basis = np.linalg.eigh(gram)[1][:, ::-1][:, : min(DIMS, FEATURES - 1, n - 1)]
    basis = basis * np.where(basis[np.abs(basis).argmax(0), np.arange(basis.shape[1])] < 0, -1.0, 1.0)  # signs fixed
    packed = spark.sparkContext.broadcast(basis)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, x in dense(b, weights.value):
                x = x @ packed.value
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                offs = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(offs, pa.array(x.reshape(-1)))], names=[key, "fit", "x"])

    kind = docs.schema[key].dataType.simpleString()
    z = cut(tf.mapInArrow(project, f"`{key}` {kind}, fit boolean, x array<double>").select(key, "fit", array_to_vector("x").alias("features")))
    k = max(8, min(max_clusters, n // 40))
    model = KMeans(k=min(k, n), seed=0, maxIter=15).fit(z.filter("fit"))
    out = model.transform(z)
    centres = docs.sparkSession.sparkContext.broadcast(np.array(model.clusterCenters()))

    @F.pandas_udf("double")
    def distance(x: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(np.linalg.norm(np.stack(x.to_numpy()) - centres.value[c.to_numpy()], axis=1) if len(x) else [])

    gap = distance(vector_to_array("features"), F.col("prediction"))
    return out.select(key, F.col("prediction").alias("cluster"), F.round(gap, 6).alias("distance"))
