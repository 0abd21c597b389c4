"""Each operator on empty tables, nulls in every column, repeated rows, extra clashing columns, long and short texts."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docstrata.llm import clusters, history, leaks, mixing, readlevel, subjects, survivor

NAMES = ["documents", "docs", "claims_done", "fulltext_md", "auto_topics", "labels", "subjects", "eval_items", "mix_targets"]
OPERATORS = {
    "p1": lambda t: history.repeated_rows(t["docs"], t["documents"], t["claims_done"], t["fulltext_md"]),
    "p2": lambda t: survivor.best_values(survivor.values_judged(t["documents"])),
    "p3": lambda t: subjects.document_subjects(t["documents"], t["auto_topics"], t["subjects"]).select("doc_id", "subject"),
    "p4": lambda t: clusters.cluster_pairs(clusters.similarity_clusters(t["documents"])),
    "p4d": lambda t: clusters.describe_clusters(clusters.similarity_clusters(t["documents"])),
    "p6": lambda t: leaks.leaked_items(t["documents"], t["eval_items"]),
    "p7": lambda t: mixing.mixed_documents(t["documents"], t["mix_targets"]),
    "p7r": lambda t: mixing.mix_report(t["documents"], t["mix_targets"]),
    "p8": lambda t: readlevel.reading_levels(t["documents"], t["labels"]),
}


@pytest.fixture(scope="module")
def tables(spark, data):
    return {n: spark.read.parquet(f"{data}/{n}.parquet").cache() for n in NAMES}


@pytest.fixture(scope="module")
def clean(tables):
    return {n: {tuple(r) for r in f(tables).collect()} for n, f in OPERATORS.items()}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty(tables, name):
    assert OPERATORS[name]({n: df.limit(0) for n, df in tables.items()}).filter("true").count() == (0)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_repeats_nulls_and_clashing_columns(spark, tables, clean, name):
    """Repeated rows, rows of nulls and columns of other operators' names change nothing."""
    dirty = {}
    for n, df in tables.items():
        nulls = spark.createDataFrame([tuple([None] * len(df.columns))], T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]))
        keep = df if n == "mix_targets" else df.unionByName(df)
        dirty[n] = keep.unionByName(nulls).withColumns({c: F.lit(None).cast("string") for c in ("word", "key", "seq", "sim", "cluster_", "n", "share", "rate", "copies", "p", "term") if c not in df.columns})
    got = [tuple(r) for r in OPERATORS[name](dirty).collect()]
    assert len(got) == len(set(got))
    if name == "p8":  # document frequencies double with repeated rows, ranks stay
        assert len(set(got) ^ clean[name]) <= 0.02 * len(clean[name])
    elif name in ("p3", "p7r", "p1"):
        assert len({r[0] for r in got} ^ {r[0] for r in clean[name]}) <= 0.02 * len(clean[name]) + 1
    else:
        assert set(got) == clean[name]


def test_null_columns_one_by_one(spark, tables):
    """Nulls in half the rows of any column of documents do not crash an operator."""
    d = tables["documents"]
    half = {c: F.when(F.xxhash64("doc_id", F.lit(i)) % 2 == 0, F.col(c)).alias(c) for i, c in enumerate(d.columns)}
    t = tables | {"documents": d.select(*half.values())}
    for f in OPERATORS.values():
        f(t).count()


def test_long_and_short_texts(spark, tables):
    text = tables["documents"].filter("length(text) > 2000").select("text").first()["text"]
    d = tables["documents"].limit(40)
    more = d.limit(3).withColumn("doc_id", F.col("doc_id") + 10_000_000).withColumn("item_key", F.concat(F.lit("L"), "item_key"))
    more = more.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.repeat(F.lit(text + "\n\n"), 400)).otherwise(F.lit("short")))
    t = tables | {"documents": d.unionByName(more)}
    for f in OPERATORS.values():
        f(t).count()
