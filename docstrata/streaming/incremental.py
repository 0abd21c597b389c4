"""Conversion attempts as a stream: a file source whose micro-batches are merged into the state table.

The checkpoint folder replaces a hand-kept offset.  A micro-batch reads and rewrites the key buckets it has rows of.
A batch that is run again after a failure starts from the versions below its own, whether it had been
published or not, and gives the same state.  A new checkpoint goes on from the state that is there.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.operators.pending import last_attempts
from docstrata.operators.state import bucket_of, current, pointer, publish

FILES_PER_BATCH = 16


def first_version(spark: SparkSession, state: str, checkpoint: str) -> int:
    """Number of batch 0 of this checkpoint among the versions of the state."""
    try:
        runs = spark.read.schema("checkpoint string, first int").json(f"{state}/_runs")
        known = runs.filter(F.col("checkpoint") == checkpoint).agg(F.min("first").alias("n")).first()["n"]
    except AnalysisException:
        known = None
    if known is not None:
        return known
    at = pointer(spark, state)
    last = None if at is None else at.agg(F.max("version").alias("v")).first()["v"]
    first = 0 if last is None else int(last[1:]) + 1
    spark.createDataFrame([(checkpoint, first)], "checkpoint string, first int").coalesce(1).write.mode("append").json(f"{state}/_runs")
    return first


def merge_batch(spark: SparkSession, batch: DataFrame, state: str, number: int) -> None:
    """Merge one micro-batch into the buckets it touches and publish them as version ``number``."""
    batch = batch.filter("item_key is not null").persist()
    version = f"v{number:08d}"
    touched = [r["b"] for r in batch.select(bucket_of("item_key").alias("b")).distinct().collect()]  # at most BUCKETS
    if touched:
        old = current(spark, state, below=version, buckets=touched)
        publish(last_attempts(batch if old is None else old.unionByName(batch, allowMissingColumns=True)), state, version, "item_key")
    batch.unpersist()


def follow_attempts(spark: SparkSession, source: str, state: str, checkpoint: str, schema) -> None:
    """Merge everything that is new in ``source`` into versions of ``state`` and return when done."""
    first = first_version(spark, state, checkpoint)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(source)
    merge = lambda batch, batch_id: merge_batch(spark, batch, state, first + batch_id)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
