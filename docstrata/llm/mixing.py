"""Mixing sources to target token shares by systematic sampling.

The total is a parameter.  Where none is given it is the largest for which every source reaches its share
within its cap on repeats: T = min over sources of tokens * max_repeats / share.  With a larger one, sources
that cannot reach their share give max_repeats copies of all they have, and the report tells the tokens they
are short of.  A document of source s is expected r = T * share / tokens times, at most max_repeats.  Within each source, expected copies are summed up along a hash order, one
random offset per source is added, and a document is emitted once for each integer boundary that its
interval crosses, so it is emitted floor(r) or ceil(r) <= max_repeats times.

The prefix sums are distributed: the hash order is cut into buckets, bucket counts give each bucket its
start, and windows run within (source, bucket) only, so a source with a third of all rows is spread over
all tasks.

Edge results: null source and sources without a target are left out (share 0); a target without any tokens
cannot be met and is reported with actual share 0, the others keep their proportions; null or empty texts
have 0 tokens and may be chosen like any document; max_repeats null counts as 1, below 1 as source left out;
several target rows of one source are added up; repeated rows (same doc_id) count once; empty tables give
empty results.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docstrata.sources.tables import cut

TOKENIZER = os.environ.get("DOCSTRATA_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: split pattern of the byte-level BPE vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROWS_PER_BUCKET = 50_000
SEED = 17


def clean_source(source: Column) -> Column:
    """Source names spelled alike: lower case, every other mark an underscore."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(source)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, source, n_tokens: whole texts under the public tokenizer whose file is named; the file is sent to the tasks."""
    documents.sparkSession.sparkContext.addFile(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(SparkFiles.get(os.path.basename(tokenizer)), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(n, pa.int64())], names=["doc_id", "source", "n_tokens"])

    named = documents.filter("doc_id is not null").select("doc_id", clean_source(F.col("source")).alias("source"), "text")
    return named.mapInArrow(run, "doc_id bigint, source string, n_tokens bigint").dropDuplicates(["doc_id"])


def mix_rates(counts: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """source, target_share, max_repeats, n_docs, n_tokens, rate, short: one row per target, expected copies of a document, tokens it lacks."""
    t = targets.filter("source is not null and target_share > 0").groupBy(clean_source(F.col("source")).alias("source")).agg(
        F.sum("target_share").alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats")
    )
    sizes = counts.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    t = t.join(sizes, "source", "left").withColumns({"n_docs": F.coalesce("n_docs", F.lit(0)), "n_tokens": F.coalesce("n_tokens", F.lit(0))})
    able = (F.col("n_tokens") > 0) & (F.col("max_repeats") >= 1)
    total = t.filter(able).agg(F.min(F.col("n_tokens") * F.col("max_repeats") / F.col("target_share")).alias("total"))
    if total_tokens is not None:
        total = total.select(F.lit(float(total_tokens)).alias("total"))
    rate = F.when(able, F.least(F.col("total") * F.col("target_share") / F.col("n_tokens"), F.col("max_repeats").cast("double"))).otherwise(F.lit(0.0))
    short = F.greatest(F.col("total") * F.col("target_share") - F.col("rate") * F.col("n_tokens"), F.lit(0.0))
    return t.join(F.broadcast(total)).withColumn("rate", rate).withColumn("short", F.coalesce(F.round(short), F.lit(0.0)).cast("bigint")).drop("total")


def systematic_copies(counts: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, n_tokens, copies (1 or more) of the chosen documents."""
    docs = counts.join(F.broadcast(rates.select("source", "rate")) if rates.count() <= 100_000 else rates.select("source", "rate"), "source").filter("rate > 0")
    buckets = max(1, counts.count() // ROWS_PER_BUCKET)
    order = F.xxhash64(F.lit(seed), "doc_id")
    docs = docs.withColumns({"order": order, "bucket": F.pmod(F.shiftright(order, 16), F.lit(buckets))})
    sums = docs.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # one row per source and bucket; rows before the bucket, so that its start and its rows' places are one product
    starts = sums.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("source", "bucket", "before")
    w = Window.partitionBy("source", "bucket").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offset = F.pmod(F.xxhash64(F.lit(seed + 1), "source"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    place = F.col("before") + F.count(F.lit(1)).over(w)
    upper, lower = (F.floor(F.round(x * F.col("rate") + offset, 9)) for x in (place, place - 1))
    copies = (upper - lower).cast("int")
    return docs.join(starts, ["source", "bucket"]).withColumn("copies", copies).filter("copies > 0").select("doc_id", "source", "n_tokens", "copies")


def mixed_documents(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """doc_id, source, n_tokens, copies: the training mix."""
    counts = cut(token_counts(documents))
    return systematic_copies(counts, cut(mix_rates(counts, targets, total_tokens)))


def mix_report(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """Per target source: shares wanted and reached, tokens and documents in and out, repeats allowed and used."""
    counts = cut(token_counts(documents))
    rates = cut(mix_rates(counts, targets, total_tokens))
    chosen = systematic_copies(counts, rates).groupBy("source").agg(
        F.count(F.lit(1)).alias("docs_chosen"), F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens_out"), F.max("copies").alias("repeats_used")
    )
    out = rates.join(chosen, "source", "left").select(
        "source", "target_share", "max_repeats", "n_docs", "n_tokens", "rate", "short", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("docs_chosen", "tokens_out", "repeats_used")]
    )
    total = out.agg(F.sum("tokens_out").alias("all_out"), F.sum("target_share").alias("all_share"))
    return out.join(F.broadcast(total)).select(
        "source", "n_docs", "n_tokens", "max_repeats", F.round("rate", 6).alias("expected_copies"), "docs_chosen", "tokens_out", "repeats_used", "short",
        F.round(F.col("target_share") / F.col("all_share"), 6).alias("target_share"), F.round(F.col("tokens_out") / F.greatest("all_out", F.lit(1)), 6).alias("actual_share"),
    )
