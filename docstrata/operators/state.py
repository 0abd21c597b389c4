"""Tables that change between runs: upsert, insert-if-absent, update by join, additive columns, versioned write.

All return the new state as a DataFrame; ``publish`` writes the touched key buckets as a new version directory and
adds them to a pointer table, so a table is never overwritten while it is read.  Keys that are null never match and are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row per key; an aggregate, so a key with a third of all rows is combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with their key."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def insert_absent(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``old``; within the batch the first of a key wins."""
    rest = [c for c in new.columns if c not in keys]
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")
    return first.join(old.select(*keys).distinct(), list(keys), "left_anti").select(*new.columns)


def update_from(target: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """``column`` of ``target`` set from ``changes`` (one row per key) where present."""
    new = changes.select(key, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    base = target if column in target.columns else target.withColumn(column, F.lit(None).cast(changes.schema[column].dataType))
    return base.join(new, key, "left").withColumn(column, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))).drop("_new", "_hit")


def patch_versions(current: DataFrame, patches: DataFrame, key: str) -> DataFrame:
    """Outcome of optimistic patches: 'ok' where the base version still stands, else 'skipped', 'missing' if gone."""
    cur = current.select(key, F.col("version").alias("current_version"))
    outcome = F.when(F.col("current_version").isNull(), "missing").when(F.col("current_version") == F.col("version"), "ok").otherwise("skipped")
    return patches.join(cur, key, "left").withColumn("outcome", outcome)


BUCKETS = 64


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def pointer(spark: SparkSession, root: str) -> DataFrame | None:
    """version, bucket of what was published; None before the first version."""
    try:
        return spark.read.schema("version string, bucket int").json(f"{root}/_pointer")
    except AnalysisException:
        return None


def publish(df: DataFrame, root: str, version: str, key: str, buckets: int = BUCKETS) -> None:
    """Write a version that holds the buckets of ``key`` it has rows of, whole, and point to them.

    Versions are read in the order of their names.  A version published again after a failure replaces itself.
    """
    df.withColumn("bucket", bucket_of(key, buckets)).write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/{version}")
    written = df.sparkSession.read.parquet(f"{root}/{version}").select(F.lit(version).alias("version"), "bucket").distinct()
    written.coalesce(1).write.mode("append").json(f"{root}/_pointer")


def current(spark: SparkSession, root: str, below: str | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """The newest published rows of each bucket, of versions below a name and of some buckets if given; None without any."""
    at = pointer(spark, root)
    if at is None:
        return None
    at = at.filter(F.col("version") < below) if below else at
    newest = at.groupBy("bucket").agg(F.max("version").alias("version")).collect()  # one row per bucket
    parts: dict[str, list[int]] = {}
    for r in newest:
        if buckets is None or r["bucket"] in buckets:
            parts.setdefault(r["version"], []).append(r["bucket"])
    out = None
    for version, mine in sorted(parts.items()):
        rows = spark.read.parquet(f"{root}/{version}").filter(F.col("bucket").isin(mine)).drop("bucket")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def append_log(rows: DataFrame, path: str, run: str) -> None:
    """Append rows to an audit log of JSON lines, with the name of the run that wrote them."""
    rows.withColumn("run", F.lit(run)).write.mode("append").json(path)
