"""Subject areas of documents by aggregated labelling functions.

Labelling functions for each (document, subject):
  lexicon  share of the text's topical words that belong to the subject, with its error
  section  whether the heading (title and first line) speaks for the subject
  address  whether the document's folder stands for the subject (catch-all folders stand for none)
  title    whether the earlier title classifier named the subject
  source   how typical the subject is of the document's source

The lexicon (word -> subject) and the meaning of folders are learned from at most ``MAX_LEXICON_DOCS``
documents that the title classifier assigns to a subject, taken in hash order; hand-made labels are not used.
A latent model (one binary class per subject, functions independent given the class) learns the functions'
accuracies by EM without labels.  The lexicon's evidence is as strong as the number of topical words it
rests on, the other functions say nothing where they do not name the subject.  The model works on counts of
vote patterns, of which there are at most subjects x 17 x 2 x 2 x 2 x 3, so nothing that grows with the
corpus reaches the driver.

Edge results: texts under 200 characters, null and blank texts give no row; a text without any topical word
gives no row; no subjects no rows; null hints are abstentions; repeated rows count once; a document has at most two rows (its largest subjects).
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstrata.llm.features import MIN_CHARS, plain
from docstrata.llm.mixing import clean_source
from docstrata.sources.tables import cut

MAX_LEXICON_DOCS = 12_000
MIN_WORD_DOCS = 8
WORD_PURITY = 0.5
FOLDER_PURITY = 0.5
QUARTER = 0.24  # about a quarter of the text
SPREAD = 0.5  # words of a subject are spread over a text more evenly than by chance, so shares err by less; set on labels
SUREST = 8
WORD = re.compile(r"[^\W\d_]{3,}")


def folder_of(path: Column) -> Column:
    """The folder nearest to the file that is not an archive's inside or a generic bucket name."""
    parts = F.filter(F.slice(F.split(path, "/"), 1, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0))), lambda x: ~x.contains("!") & (F.lower(x) != "sub"))
    return F.when(F.size(parts) > 0, F.element_at(parts, -1))


def weak_labels(documents: DataFrame, auto_topics: DataFrame, subjects: DataFrame) -> DataFrame:
    """doc_id, hint: the title classifier's subject, for documents where it names one (several: the first by name)."""
    names = subjects.filter("name is not null and subject is not null").select(F.lower(F.trim("name")).alias("auto"), "subject").distinct()
    auto = auto_topics.filter("item_key is not null").join(F.broadcast(names), F.lower(F.trim("auto_topic")) == F.col("auto")).groupBy("item_key").agg(F.min("subject").alias("hint"))
    return documents.select("doc_id", "item_key").join(auto, "item_key").select("doc_id", "hint")


def learn_lexicon(documents: DataFrame, hints: DataFrame) -> dict[str, str]:
    """word -> subject from the bounded sample; words whose documents are mostly of one subject."""
    known = hints.filter("doc_id is not null").select("doc_id", F.col("hint").alias("subject")).distinct()
    one = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("subject").alias("subject")).filter("n = 1")
    sample = cut(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LEXICON_DOCS).select("doc_id", "subject"))
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])  # MAX_LEXICON_DOCS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, str], int] = defaultdict(int)
        for b in batches:
            for t, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for w in set(WORD.findall(plain(t or ""))):
                    total[w, s] += 1
        rows = [(w, s, n) for (w, s), n in total.items()]
        cols = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=["word", "subject", "n"])

    counts = texts.select("text", "subject").mapInArrow(run, "word string, subject string, n bigint").groupBy("word", "subject").agg(F.sum("n").alias("n"))
    sizes = sample.groupBy("subject").agg(F.count(F.lit(1)).alias("size"))
    rates = counts.join(F.broadcast(sizes), "subject").withColumn("rate", F.col("n") / F.col("size"))
    best = rates.groupBy("word").agg(F.sum("n").alias("n"), F.sum("rate").alias("all"), F.max(F.struct("rate", "subject")).alias("b"))
    # bounded: words of at most MAX_LEXICON_DOCS documents that MIN_WORD_DOCS of them share
    rows = best.filter((F.col("n") >= MIN_WORD_DOCS) & (F.col("b.rate") >= WORD_PURITY * F.col("all"))).select("word", "b.subject").collect()
    return {r["word"]: r["subject"] for r in rows}


def topical_shares(documents: DataFrame, lexicon: dict[str, str], codes: list[str]) -> DataFrame:
    """doc_id, shares (one per subject code, of the topical words), n_topical (these words), heading (subject code of title and first line)."""
    number = {s: i for i, s in enumerate(codes)}
    packed = documents.sparkSession.sparkContext.broadcast({w: number[s] for w, s in lexicon.items() if s in number})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = packed.value
        for b in batches:
            ids, shares, sizes, heads = [], [], [], []
            for i, t, title in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                if not t or len(t.strip()) < MIN_CHARS:
                    continue
                t = plain(t)
                got = Counter(lex[w] for w in WORD.findall(t) if w in lex)
                n = sum(got.values())
                if not n:
                    continue
                first = t.lstrip().split("\n", 1)[0]
                head = Counter(lex[w] for w in WORD.findall((title or "").lower() + (" " + first if len(first) < 80 else "")) if w in lex).most_common(1)
                ids.append(i)
                shares.append([got.get(k, 0) / n for k in range(len(codes))])
                sizes.append(n)
                heads.append(codes[head[0][0]] if head else None)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(shares, pa.list_(pa.float32())), pa.array(sizes, pa.int32()), pa.array(heads, pa.string())], names=["doc_id", "shares", "n_topical", "heading"])

    texts = documents.filter("doc_id is not null").select("doc_id", "text", "title")
    return texts.mapInArrow(run, "doc_id bigint, shares array<float>, n_topical int, heading string").dropDuplicates(["doc_id"])


def lexicon_level(share: Column, n: Column) -> Column:
    """Log odds, rounded and within +-``SUREST``, that a subject takes up a quarter of a text with this share of n topical words.

    A logistic curve for the normal approximation of the share's error, ``SPREAD`` times the variance of independent words.
    """
    z = (share - QUARTER) * F.sqrt(n / F.lit(SPREAD * QUARTER * (1 - QUARTER)))
    return F.greatest(F.lit(-SUREST), F.least(F.lit(SUREST), F.round(z * 1.7))).cast("int")


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """Posterior of the positive class for each vote pattern of one subject; EM over pattern counts.

    The first vote is the lexicon's log odds, whose error is known from the number of words it rests on.  The
    accuracy of each other function is learned; it abstains where it does not speak for the subject (vote 0),
    as a document may have two subjects and naming another one is no evidence against this one.
    """
    if not patterns:
        return {}
    votes = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], dtype=float)
    post = 1 / (1 + np.exp(-votes[:, 0].astype(float)))
    for _ in range(rounds):
        logit = votes[:, 0].astype(float)
        for f in range(1, votes.shape[1]):
            pos, neg = (np.bincount(votes[:, f], weights=n * p, minlength=3) + 0.5 for p in (post, 1 - post))
            ratio = np.log((pos / pos.sum()) / (neg / neg.sum()))
            ratio[0] = 0.0
            logit += ratio[votes[:, f]]
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return dict(zip(map(tuple, votes.tolist()), post.tolist(), strict=True))


def subject_votes(documents: DataFrame, auto_topics: DataFrame, subjects: DataFrame) -> DataFrame:
    """doc_id, subject, share, posterior for every (document, subject code)."""
    codes = sorted(r["subject"] for r in subjects.filter("subject is not null").select("subject").distinct().collect())  # the stated list of codes
    if not codes:
        return documents.sparkSession.createDataFrame([], "doc_id bigint, subject string, share float, posterior double")
    hints = cut(weak_labels(documents, auto_topics, subjects))
    lexicon = learn_lexicon(documents, hints)
    text = cut(topical_shares(documents, lexicon, codes))
    top = F.element_at(F.array(*[F.lit(c) for c in codes]), F.array_position("shares", F.array_max("shares")).cast("int"))
    meta = documents.filter("doc_id is not null").select("doc_id", F.coalesce(F.lower(F.trim("topic")), F.lit("")).alias("topic"), F.coalesce(folder_of(F.col("path")), F.lit("")).alias("folder"), clean_source(F.coalesce("source", F.lit(""))).alias("source"))
    d = cut(text.join(meta.dropDuplicates(["doc_id"]), "doc_id").join(hints.dropDuplicates(["doc_id"]), "doc_id", "left").withColumn("top", top))

    def meaning(col: str) -> DataFrame:
        per = d.groupBy(col, "top").agg(F.count(F.lit(1)).alias("n"))
        return per.groupBy(col).agg(F.sum("n").alias("all"), F.max(F.struct("n", "top")).alias("b")).filter(f"all >= 5 and b.n >= {FOLDER_PURITY} * all").select(col, F.col("b.top").alias(f"{col}_means"))

    usual = d.groupBy("source", "top").agg(F.count(F.lit(1)).alias("n"))
    usual = usual.groupBy("source").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("top", "n"))).alias("n"))
    d = d.join(meaning("topic"), "topic", "left").join(meaning("folder"), "folder", "left").join(usual, "source", "left")
    address = F.coalesce("topic_means", "folder_means")
    speaks = lambda c, s: F.when(c == s, 1).otherwise(0)
    long = d.select("doc_id", F.posexplode("shares").alias("k", "share"), "n_topical", "heading", "hint", address.alias("address"), "all", "n").withColumn("subject", F.element_at(F.array(*[F.lit(c) for c in codes]), F.col("k") + 1))
    lift = F.coalesce(F.try_element_at("n", F.col("subject")), F.lit(0)) / F.col("all") * len(codes)
    long = long.select(
        "doc_id", "subject", "share", lexicon_level(F.col("share"), F.col("n_topical")).alias("v0"), speaks(F.col("heading"), F.col("subject")).alias("v1"), speaks(F.col("address"), F.col("subject")).alias("v2"),
        speaks(F.col("hint"), F.col("subject")).alias("v3"), F.when(lift < 0.7, 2).when(lift < 1.5, 0).otherwise(1).alias("v4"),
    )
    votes = ["v0", "v1", "v2", "v3", "v4"]
    grouped = defaultdict(list)
    for r in long.groupBy("subject", *votes).count().collect():  # bounded, see module
        grouped[r["subject"]].append((tuple(r[v] for v in votes), r["count"]))
    table = [(s, *p, q) for s, rows in grouped.items() for p, q in fit_votes(rows).items()]
    spark = documents.sparkSession
    post = spark.createDataFrame(table, "subject string, v0 int, v1 int, v2 int, v3 int, v4 int, posterior double")
    return long.join(F.broadcast(post), ["subject", *votes]).select("doc_id", "subject", "share", "posterior")


def document_subjects(documents: DataFrame, auto_topics: DataFrame, subjects: DataFrame) -> DataFrame:
    """doc_id, subject, share, posterior: one or two subjects of each document by posterior probability."""
    votes = subject_votes(documents, auto_topics, subjects)
    ranked = votes.groupBy("doc_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((F.col("posterior") >= 0.5).alias("yes"), "share", "posterior", "subject")), asc=False), 1, 2).alias("v"))
    rows = ranked.select("doc_id", F.posexplode("v").alias("i", "x"))
    return rows.filter("x.yes or (i = 0 and x.share > 0)").select("doc_id", "x.subject", "x.share", "x.posterior")
