"""Sources as they are landed by the adapters: listings, logs, notes, archives, item pages.

Network calls, uploads and document converters are adapters outside this library; they land files that are
read here.  Bad lines are dropped where the format allows it, never the whole file.
"""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM = "key string, version bigint, title string, url string, md5 string, mtime bigint, dateAdded string, tags array<struct<tag: string>>, collections array<string>"
LOG = "path string, status string, size bigint, time double, error string"
NOTE_CHARS, DESCRIPTION_CHARS = 3000, 200  # what a note row holds by definition
SECRET = r"(?i)credential|secret|password|token|api[-_ ]?key|passwd"


def listing(lines: DataFrame) -> DataFrame:
    """path, size, modified_ms of listing lines ``path TAB size TAB time``; other lines are dropped."""
    parts = F.split("value", "\t", -1)
    return lines.filter(F.size(parts) == 3).select(parts[0].alias("path"), parts[1].try_cast("bigint").alias("size"), listing_time(parts[2]).alias("modified_ms"))


def listing_time(text: Column) -> Column:
    """Epoch milliseconds of ``yyyy-MM-dd HH:mm:ss...`` in UTC; null when unreadable."""
    return F.unix_millis(F.try_to_timestamp(F.substring(text, 1, 19), F.lit("yyyy-MM-dd HH:mm:ss")))


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    return listing(spark.read.text(path))


def read_log(spark: SparkSession, path: str, schema: str = LOG) -> DataFrame:
    """Rows of an append-only JSON-lines log; undecodable lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def marked_line(lines: DataFrame, order: str, text: str, mark: Column) -> DataFrame:
    """passed, line: the last line that has the mark, else the last line of all; no row without lines."""
    last = lines.agg(F.max_by(text, F.when(mark, F.col(order))).alias("hit"), F.max_by(text, order).alias("tail"), F.count(F.lit(1)).alias("n"))
    return last.filter("n > 0").select(F.col("hit").isNotNull().alias("passed"), F.coalesce("hit", "tail").alias("line"))


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Library items of landed result pages, tags as plain strings."""
    items = spark.read.schema(f"data struct<{', '.join(f.replace(' ', ': ', 1) for f in ITEM.split(', '))}>").json(path).select("data.*").filter("key is not null")
    return items.withColumn("tags", F.transform("tags", lambda t: t["tag"]))


def read_notes(spark: SparkSession, path: str, index: str = "INDEX.md") -> DataFrame:
    """name, description, text of Markdown notes; the index and notes that speak of secrets are left out."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("file"), F.substring("value", 1, NOTE_CHARS).alias("t"))
    notes = files.filter(F.col("file").endswith(".md") & (F.col("file") != index)).select(
        F.regexp_replace("file", r"\.md$", "").alias("name"),
        F.substring(F.regexp_replace(F.regexp_extract("t", r"(?m)^description:\s*(.+)$", 1), '^"|"$', ""), 1, DESCRIPTION_CHARS).alias("description"),
        F.regexp_replace("t", r"(?s)\A---.*?---", "").alias("body"),
    )
    return notes.filter(~F.col("name").rlike(SECRET) & ~F.col("description").rlike(SECRET)).select("name", "description", F.concat("description", F.lit(" "), "body").alias("text"))


def read_archives(spark: SparkSession, path: str, max_member_bytes: int = 200_000_000) -> DataFrame:
    """path (``archive!member``), size, status, content of the members of zip and tar archives, one level deep.

    Archives in archives are listed, not opened; members above the bound are listed without content; files that
    cannot be opened give one row with status ``unreadable``.
    """

    def members(name: str, data: bytes) -> Iterator[tuple]:
        try:
            if zipfile.is_zipfile(io.BytesIO(data)):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    for m in z.infolist():
                        if not m.is_dir():
                            yield m.filename, m.file_size, lambda m=m: z.read(m)
            else:
                with tarfile.open(fileobj=io.BytesIO(data)) as t:
                    for m in t:
                        if m.isfile():
                            yield m.name, m.size, lambda m=m: t.extractfile(m).read()
        except (tarfile.TarError, zipfile.BadZipFile, OSError, EOFError):
            yield None, len(data), None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, data in zip(b["path"], b["content"], strict=True):
                rows = []
                for name, size, read in members(p, data):
                    if name is None:
                        rows.append((p, size, "unreadable", None))
                    elif name.lower().endswith((".zip", ".tar", ".gz", ".tgz", ".rar", ".7z")):
                        rows.append((f"{p}!{name}", size, "nested", None))
                    else:
                        rows.append((f"{p}!{name}", size, "ok", read()) if size <= max_member_bytes else (f"{p}!{name}", size, "too_large", None))
                yield pd.DataFrame(rows, columns=["path", "size", "status", "content"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(run, "path string, size bigint, status string, content binary")


def enriched(items: DataFrame, first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Items with title and year filled from the first lookup that has them; ``enriched`` tells whether one did."""
    a = first.select(key, F.col("title").alias("t1"), F.col("year").alias("y1"), F.lit(True).alias("h1"))
    b = second.select(key, F.col("title").alias("t2"), F.col("year").alias("y2"), F.lit(True).alias("h2"))
    out = items.join(a, key, "left").join(b, key, "left")
    return out.withColumns({"title": F.coalesce("t1", "t2", "title"), "year": F.coalesce("y1", "y2", "year"), "enriched": F.coalesce("h1", "h2", F.lit(False))}).drop("t1", "t2", "y1", "y2", "h1", "h2")
