"""Which documents wait for conversion, what became of the others, and how much one run may read.

The budget admits files in order (source, key): the first always, later ones while the sum stays within the
budget; a file that does not fit is put off and smaller ones after it may still fit.  Instead of a fold over one
sorted list, the files are cut into ordered buckets of a bounded number of rows.  A bucket that fits is taken
by its sum and one whose smallest file is too large is left out by its minimum, neither is looked into; only
the others are folded, each in a task of its own.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.operators.state import latest
from docstrata.sources.tables import cut

ROWS_PER_BUCKET = 100_000


def last_attempts(fulltext: DataFrame) -> DataFrame:
    """One row per item: the latest attempt (ties: status, chars), whatever order the rows arrived in."""
    order = [F.coalesce("converted_at", F.lit("1970-01-01").cast("timestamp_ntz")), F.coalesce("status", F.lit("")), F.coalesce("chars", F.lit(-1))]
    return latest(fulltext.filter("item_key is not null"), ["item_key"], order)


def pending(documents: DataFrame, fulltext: DataFrame) -> DataFrame:
    return documents.filter("coalesce(is_duplicate, false) = false").join(fulltext.select("item_key").distinct(), "item_key", "left_anti")


def fold(used: float, budget: float, first: bool, order: list[str], size: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The fold over one bucket's files, ``used`` megabytes into the budget; ``first`` if the very first file is among them."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows, total, keep = rows.sort_values(order), used, []
        for i, x in enumerate(rows[size]):
            keep.append((first and i == 0) or round(total + x, 6) <= budget)
            total = round(total + x, 6) if keep[-1] else total
        return rows[keep]

    return run


def admit(files: DataFrame, budget: float, order: list[str], size: str = "size_mb") -> DataFrame:
    """The files admitted within the budget; null sizes count as 0, rows must be unique in ``order``."""
    files = files.withColumn(size, F.coalesce(size, F.lit(0.0)))
    buckets = max(1, files.count() // ROWS_PER_BUCKET)
    ranged = cut(files.repartitionByRange(buckets, *order).withColumn("bucket", F.spark_partition_id()))
    sums = ranged.groupBy("bucket").agg(F.sum(size).alias("sum"), F.min(size).alias("least")).orderBy("bucket").collect()  # one row per bucket
    used, whole, opened = 0.0, [], []
    for r in sums:
        first = r is sums[0]
        if round(used + r["sum"], 6) <= budget:
            whole.append(r["bucket"])
            used = round(used + r["sum"], 6)
        elif first or round(used + r["least"], 6) <= budget:
            taken = cut(ranged.filter(F.col("bucket") == r["bucket"]).groupBy("bucket").applyInPandas(fold(used, budget, first, order, size), ranged.schema))
            used = round(used + (taken.agg(F.sum(size).alias("s")).first()["s"] or 0.0), 6)
            opened.append(taken)
    out = ranged.filter(F.col("bucket").isin(whole))
    for taken in opened:
        out = out.unionByName(taken)
    return out.drop("bucket")
