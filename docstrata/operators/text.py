"""TF-IDF weights, BM25 search and note-to-document links.

Terms are counted document by document inside tasks and added up before the shuffle, so (document, term) rows
are never shuffled.  The vocabulary is bounded by definition and goes to the tasks, where a second pass
over the texts weighs and normalises each document's terms.  Null and blank texts have no terms; an empty
corpus gives empty results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docstrata.config import STOP_WORDS
from docstrata.sources.tables import cut, spread

MAX_TERMS = 60_000  # size of the vocabulary, part of the definition
FLUSH_TERMS = 300_000
NOTES_BLOCK = 2_000
CHUNK = 2_500  # documents whose terms are in memory at once
TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}_]+")
WORD, MARK = re.compile(r"\w+"), regex.compile(r"\p{M}")


def words(text: Column, stop: Sequence[str] = STOP_WORDS) -> Column:
    """Plain lower-case words of three letters or more that are no stop words, in order."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{M}\p{N}_]+"), F.lit(0))
    return F.filter(tokens, lambda x: x.rlike("^[a-z]{3,}$") & ~x.isin(list(stop)))


def plain_words(text: str | None, stop: frozenset[str] = frozenset(STOP_WORDS)) -> list[str]:
    """The words of a text, as in ``words``."""
    t = (text or "").lower()
    tokens = WORD if t.isascii() or not MARK.search(t) else TOKEN  # the same without marks, and faster
    return [w for w in tokens.findall(t) if len(w) > 2 and w.isascii() and w.isalpha() and w not in stop]


def terms_of(text: str | None, stop: frozenset[str] = frozenset(STOP_WORDS)) -> Counter:
    """Counts of the words of a text (as in ``words``) and of pairs of neighbours."""
    return Counter(term_list(text, stop))


def term_list(text: str | None, stop: frozenset[str] = frozenset(STOP_WORDS)) -> list[str]:
    w = plain_words(text, stop)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def vocabulary(docs: DataFrame, min_df: int = 5, max_df: float = 0.35, max_terms: int = MAX_TERMS) -> dict[str, float]:
    """term -> inverse document frequency of the ``max_terms`` most frequent terms (ties by term) within the bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, cf = Counter(), Counter()

        def emit() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64()), pa.array([cf[t] for t in df], pa.int64())], names=["term", "df", "cf"])
            df.clear()
            cf.clear()
            return rows

        for b in batches:
            for t in b.column(0).to_pylist():
                terms = term_list(t)
                df.update(set(terms))
                cf.update(terms)
                if len(df) > FLUSH_TERMS:
                    yield emit()
        yield emit()

    n = docs.count()
    v = spread(docs.select("text")).mapInArrow(run, "term string, df bigint, cf bigint").groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    v = v.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * n)).orderBy(F.desc("cf"), "term").limit(max_terms)
    got = v.select("term", (F.log((1.0 + n) / (1 + F.col("df"))) + 1).alias("idf")).toArrow()
    return dict(zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True))


def weighted(text: str | None, idf: dict[str, float]) -> dict[str, float]:
    """term -> (1 + ln tf) * idf over the vocabulary, normalised."""
    w = {t: (1 + math.log(n)) * idf[t] for t, n in terms_of(text).items() if t in idf}
    norm = math.sqrt(sum(x * x for x in w.values()))
    return {t: x / norm for t, x in w.items()}


def tfidf(docs: DataFrame, key: str, idf: dict[str, float] | None = None) -> DataFrame:
    """key, term, weight of every document's terms within the vocabulary."""
    packed = docs.sparkSession.sparkContext.broadcast(vocabulary(docs) if idf is None else idf)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, terms, weights = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                w = weighted(t, packed.value)
                at += [i] * len(w)
                terms += w
                weights += w.values()
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), pa.array(terms, pa.string()), pa.array(weights, pa.float64())], names=[key, "term", "weight"])

    return spread(docs.select(key, "text")).mapInArrow(run, f"`{key}` {kind}, term string, weight double")


def term_sums(docs: DataFrame, group: str) -> DataFrame:
    """group, term, s: summed weights (as in ``tfidf``) of the documents of each group; added up inside tasks under the terms' numbers."""
    spark = docs.sparkSession
    idf = vocabulary(docs)
    packed = spark.sparkContext.broadcast(({t: i for i, t in enumerate(idf)}, np.array(list(idf.values()), dtype=float)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, idf = packed.value
        for b in (b.slice(i, CHUNK) for b in batches for i in range(0, b.num_rows, CHUNK)):
            at, n, size = [], [], []
            for t in b.column(1).to_pylist():
                c = [(index[t], k) for t, k in terms_of(t).items() if t in index]
                size.append(len(c))
                at += [i for i, _ in c]
                n += [k for _, k in c]
            at, doc = np.array(at, dtype=np.int64), np.repeat(np.arange(len(size)), size)
            w = (1 + np.log(np.array(n, dtype=float))) * idf[at]
            w /= np.sqrt(np.bincount(doc, weights=w * w, minlength=len(size)))[doc]
            groups = b.column(0).dictionary_encode()
            code = pc.fill_null(groups.indices, len(groups.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
            pair, where = np.unique(code[doc] * max(len(idf), 1) + at, return_inverse=True)
            code = pair // max(len(idf), 1)
            mine = groups.dictionary.take(pa.array(code, mask=code == len(groups.dictionary)))
            yield pa.RecordBatch.from_arrays([mine, pa.array((pair % max(len(idf), 1)).astype(np.int32)), pa.array(np.bincount(where, weights=w, minlength=len(pair)).astype(float))], names=[group, "i", "s"])

    rows = spread(docs.select(F.col(group).cast("int").alias(group), "text"))
    sums = rows.mapInArrow(run, f"`{group}` int, i int, s double").groupBy(group, "i").agg(F.sum("s").alias("s"))
    terms = spark.createDataFrame(list(enumerate(idf)), "i int, term string")  # MAX_TERMS at most
    return sums.join(F.broadcast(terms), "i").select(group, "term", "s")


def bm25(docs: DataFrame, key: str, query: Sequence[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """key, score of the documents with any query term; only the query's terms are counted, nothing is exploded."""
    terms = sorted({q.lower() for q in query})
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            w = [plain_words(t) for t in rb.column(1).to_pylist()]
            counts = [pa.array([x.count(t) for x in w], pa.int32()) for t in terms]
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array([len(x) for x in w], pa.int32()), *counts], names=[key, "len", *[f"tf{i}" for i in range(len(terms))]])

    schema = f"`{key}` {kind}, len int" + "".join(f", tf{i} int" for i in range(len(terms)))
    w = cut(spread(docs.select(key, "text")).mapInArrow(run, schema).filter("len > 0"))
    stats = w.agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("avg_len"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        part = F.log((F.col("n") - df + 0.5) / (df + 0.5) + 1) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("len") / F.col("avg_len")))
        score = score + F.when(tf > 0, part).otherwise(0.0)
    any_term = sum((F.col(f"tf{i}") for i in range(len(terms))), F.lit(0)) > 0
    return w.filter(any_term).join(F.broadcast(stats)).select(key, F.round(score, 6).alias("score"))  # stats: one row


def note_matches(notes: DataFrame, docs: DataFrame, note_key: str, key: str, top: int = 40) -> DataFrame:
    """note_key, key, similarity, rank: the ``top`` most similar documents of each note (ties by key), cosine of TF-IDF.

    The notes are the stated query set: they go to the tasks in blocks of ``NOTES_BLOCK``.  Each batch of documents
    is scored against a block and keeps its own ``top`` per note; these few rows are ranked.
    """
    spark = docs.sparkSession
    idf = vocabulary(docs)
    all_idf = spark.sparkContext.broadcast(idf)
    rows = notes.filter(F.col(note_key).isNotNull()).select(note_key, "text").dropDuplicates([note_key])
    blocks = max(1, -(-rows.count() // NOTES_BLOCK))
    kinds = [x.schema[c].dataType.simpleString() for x, c in ((notes, note_key), (docs, key))]
    out = None
    for n in range(blocks):
        mine = [(r[note_key], weighted(r["text"], idf)) for r in rows.filter(F.pmod(F.xxhash64(note_key), F.lit(blocks)) == n).toLocalIterator()]
        by_term: dict[str, list[tuple[int, float]]] = {}
        for i, (_, w) in enumerate(mine):
            for t, x in w.items():
                by_term.setdefault(t, []).append((i, x))
        index = {t: (np.array([i for i, _ in p]), np.array([x for _, x in p])) for t, p in by_term.items()}
        packed = spark.sparkContext.broadcast(([k for k, _ in mine], index))

        def run(batches: Iterator[pd.DataFrame], packed=packed) -> Iterator[pd.DataFrame]:
            ids, index = packed.value
            for b in batches:
                keys = b[key].to_numpy()
                s = np.zeros((len(b), len(ids)))
                for row, t in enumerate(b["text"]):
                    for term, x in weighted(t, all_idf.value).items():
                        if term in index:
                            at, y = index[term]
                            s[row, at] += x * y
                s = np.round(s, 6)
                found = []
                for i in range(len(ids)):
                    col = s[:, i]
                    least = np.partition(col, -top)[-top] if len(col) > top else 0.0
                    cand = np.flatnonzero((col >= least) & (col > 0))
                    cand = cand[np.lexsort((keys[cand], -col[cand]))][:top]
                    found += [(ids[i], keys[j], col[j]) for j in cand]
                yield pd.DataFrame(found, columns=[note_key, key, "similarity"])

        part = spread(docs.filter(F.col(key).isNotNull()).select(key, "text")).mapInPandas(run, f"`{note_key}` {kinds[0]}, `{key}` {kinds[1]}, similarity double")
        out = part if out is None else out.unionByName(part)
    best = Window.partitionBy(note_key).orderBy(F.desc("similarity"), key)
    return out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
