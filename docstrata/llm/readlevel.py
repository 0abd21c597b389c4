"""Reading level by a familiar-word formula.

Languages are told apart by profiles learned from the corpus (``language_profiles``).  Familiar words: per
language, the words that most documents have, by document frequency over the whole corpus.  A text's features are the shares of its words outside the list at several list lengths, its mean
and median sentence length and its mean word length.  Words that hardly any document has (names, recognition
errors) count for neither side.  Sentence by sentence medians keep single sentences of another level,
headings and page lines from moving the result.  The formula's weights are fitted on the hand-labelled
sample (at most ``MAX_LABELLED`` rows, taken in hash order) as a softmax over the levels.

Edge results: texts under 200 characters, null and blank texts and texts without known words give no row;
null levels and labels of unknown documents are ignored; without any labels fixed cuts on sentence length
and unfamiliar share are used; documents labelled several times count once with their highest level.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.llm.features import CACHE_WORDS, MIN_CHARS, word_ids
from docstrata.sources.tables import cut

CUTS = (30, 50, 75, 100, 150, 200, 300, 500, 800)
KNOWN_SHARE = 0.004  # at most (words per text) / KNOWN_SHARE words per language have such a share
MAX_LABELLED = 20_000
PER_LANGUAGE = 150
FLUSH_WORDS = 400_000
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?;]\s+|\n\s*\n")
MIN_LANGUAGE_DOCS = 3
USUAL = 0.2  # share of a language's documents that have a word of its profile
PROFILE_WORDS = 25
ALIKE = 0.6  # codes whose usual words agree so far are spellings of one language
Profiles = list[dict[str, float]]


def language_profiles(documents: DataFrame) -> Profiles:
    """Per language the words that tell it from the others, with weights; learned from documents that have a code.

    The codes are free text: those whose usual words agree are one language.  All documents with a code count; without
    any code all texts are of one language.
    """
    if "lang" not in documents.columns:
        return [{}]
    coded = documents.filter("lang is not null and doc_id is not null").withColumn("code", F.regexp_replace(F.lower("lang"), r"[^\p{L}]+", "")).filter("code <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, Counter] = {}

        def emit() -> pa.RecordBatch:
            rows = [(c, w, n) for c, words in total.items() for w, n in words.items()]
            total.clear()
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=["code", "word", "n"])

        for b in batches:
            for code, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                mine = total.setdefault(code, Counter())
                mine.update(set(WORD.findall((t or "").lower())))
                mine[""] += 1  # documents of the code
            if sum(map(len, total.values())) > FLUSH_WORDS:
                yield emit()
        yield emit()

    counts = cut(coded.select("code", "text").mapInArrow(run, "code string, word string, n bigint").groupBy("code", "word").agg(F.sum("n").alias("n")))
    sizes = counts.filter("word = ''").select("code", F.col("n").alias("docs"))
    usual = counts.join(F.broadcast(sizes), "code").filter(F.col("n") >= USUAL * F.col("docs"))  # at most (words per text) / USUAL words a code
    shares: dict[str, dict[str, float]] = {}
    docs: dict[str, int] = {}
    for r in usual.collect():
        docs[r["code"]] = r["docs"]
        if r["word"]:
            shares.setdefault(r["code"], {})[r["word"]] = r["n"] / r["docs"]
    groups: Profiles = []
    for code in sorted(shares, key=lambda c: (-docs[c], c)):
        if docs[code] >= MIN_LANGUAGE_DOCS and not any(cosine(shares[code], g) >= ALIKE for g in groups):
            groups.append(shares[code])
    out = []
    for g in groups:
        weight = {w: math.log((x + 0.01) / (max((o.get(w, 0.0) for o in groups if o is not g), default=0.0) + 0.01)) for w, x in g.items()}
        best = sorted(weight, key=lambda w: (-weight[w] * g[w], w))[:PROFILE_WORDS]
        out.append({w: weight[w] for w in best if weight[w] > 0})
    return out or [{}]


def cosine(a: dict[str, float], b: dict[str, float]) -> float:
    norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return sum(x * b.get(w, 0.0) for w, x in a.items()) / norm if norm else 0.0


def language(counts: Counter, profiles: Profiles) -> int:
    """Number of the language whose own words are most frequent."""
    return max(range(len(profiles)), key=lambda k: sum(counts[w] * x for w, x in profiles[k].items()))


def familiar_words(documents: DataFrame, profiles: Profiles) -> dict[int, dict[int, int]]:
    """Per language the rank by document frequency of each word that a KNOWN_SHARE of its documents have.

    Document frequencies cover all texts; each task adds its own up before the shuffle.  The result is bounded
    by (distinct words per text) / KNOWN_SHARE words per language, whatever the corpus size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        total: list[Counter] = [Counter() for _ in profiles]

        def emit() -> pa.RecordBatch:
            rows = [(k, w, n) for k, c in enumerate(total) for w, n in c.items()]
            for c in total:
                c.clear()
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64())], names=["lang", "word", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                c = Counter(WORD.findall((t or "").lower()))
                if c:
                    mine = total[language(c, profiles)]
                    mine.update(word_ids(list(c), cache))
                    mine[0] += 1  # documents of the language
            if sum(map(len, total)) > FLUSH_WORDS:
                yield emit()
        yield emit()

    df = documents.select("text").mapInArrow(run, "lang int, word int, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    df = cut(df)
    docs = {r["lang"]: r["n"] for r in df.filter("word = 0").collect()}
    low = F.lit(None).cast("double")
    for k, n in docs.items():
        low = F.when(F.col("lang") == k, F.lit(KNOWN_SHARE * n)).otherwise(low)
    ranks: dict[int, dict[int, int]] = {k: {} for k in range(len(profiles))}
    for r in df.filter((F.col("word") != 0) & (F.col("n") >= low)).orderBy(F.desc("n"), "word").collect():
        ranks[r["lang"]][r["word"]] = len(ranks[r["lang"]])
    return ranks


class Ranks(dict):
    """word -> rank of one language (-1 for words hardly any document has); filled as words come up."""

    def __init__(self, known: dict[int, int]):
        super().__init__()
        self.known, self.ids = known, {}

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        r = self[word] = self.known.get(word_ids([word], self.ids)[0], -1)
        return r


def text_features(text: str, ranks: list[Ranks], profiles: Profiles) -> tuple[int, list[float]] | None:
    """Language and formula features of a text; None without known words."""
    sentences = [s for s in map(WORD.findall, SENTENCE.split(text.lower())) if s]
    words = [w for s in sentences for w in s]
    k = language(Counter(words), profiles)
    rank = np.fromiter(map(ranks[k].__getitem__, words), dtype=np.int32, count=len(words))
    known = rank >= 0
    n = int(known.sum())
    if not n:
        return None
    size = np.fromiter(map(len, words), dtype=np.int32, count=len(words)) * known
    lengths = np.fromiter(map(len, sentences), dtype=np.int32, count=len(sentences))
    at = np.repeat(np.arange(len(sentences)), lengths)
    hist = np.bincount(np.searchsorted(CUTS, rank[known], "right"), minlength=len(CUTS) + 1)
    beyond = 1 - np.cumsum(hist)[:-1] / n
    inner = lengths[lengths >= 2]
    inner = inner if len(inner) else lengths
    per = np.bincount(at, weights=known, minlength=len(sentences))
    good = per >= 3
    hard, mean = (np.bincount(at, weights=v, minlength=len(sentences))[good] / per[good] for v in (rank >= 200, size))
    mid = lambda v: float(np.median(v)) if len(v) else 0.0
    return k, [*beyond.tolist(), float(lengths.mean()), mid(inner), size.sum() / n, mid(hard), mid(mean), float((inner >= 15).mean())]


def reading_features(documents: DataFrame) -> DataFrame:
    """doc_id, lang, features of every text of 200 characters or more."""
    profiles = language_profiles(documents)
    packed = documents.sparkSession.sparkContext.broadcast(familiar_words(documents, profiles))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = [Ranks(packed.value[k]) for k in range(len(profiles))]
        for b in batches:
            ids, langs, feats = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got = text_features(t, ranks, profiles) if t and len(t.strip()) >= MIN_CHARS else None
                if got:
                    ids.append(i)
                    langs.append(got[0])
                    feats.append(got[1])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.int32()), pa.array(feats, pa.list_(pa.float32()))], names=["doc_id", "lang", "features"])

    return documents.filter("doc_id is not null").select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang int, features array<float>")


def expand(x: np.ndarray, mean: np.ndarray, std: np.ndarray, square: bool) -> np.ndarray:
    z = np.clip((x - mean) / std, -4, 4)
    return np.hstack([z, z**2, np.ones((len(z), 1))] if square else [z, np.ones((len(z), 1))])


def fit_softmax(x: np.ndarray, y: np.ndarray, square: bool, steps: int = 1500) -> dict:
    """Softmax regression by gradient descent with a small ridge."""
    levels = np.unique(y)
    mean, std = x.mean(0), x.std(0) + 1e-6
    z = expand(x, mean, std, square)
    target = (y[:, None] == levels[None, :]).astype(float)
    w = np.zeros((z.shape[1], len(levels)))
    ridge = np.full((z.shape[1], 1), 1e-4 if square else 1e-3)
    ridge[-1] = 0
    for _ in range(steps):
        s = z @ w
        p = np.exp(s - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        w -= 0.3 * (z.T @ (p - target) / len(z) + ridge * w)
    return {"mean": mean, "std": std, "w": w, "levels": levels, "square": square}


def fit_levels(features: DataFrame, labels: DataFrame) -> dict:
    """Model per language, and one over all where a language has fewer than PER_LANGUAGE labelled texts."""
    y = labels.filter("doc_id is not null and reading_level is not null").groupBy("doc_id").agg(F.max("reading_level").alias("level"))
    rows = features.join(y, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED).select("lang", "features", "level").collect()
    if len({r["level"] for r in rows}) < 2:
        return {}
    x, t, k = np.array([r["features"] for r in rows], dtype=float), np.array([r["level"] for r in rows]), np.array([r["lang"] for r in rows])
    models: dict = {None: fit_softmax(x, t, square=len(t) >= 10 * PER_LANGUAGE)}
    for lang in np.unique(k).tolist():
        mine = k == lang
        if mine.sum() >= PER_LANGUAGE and len(np.unique(t[mine])) == len(np.unique(t)):
            models[lang] = fit_softmax(x[mine], t[mine], square=mine.sum() >= 3 * PER_LANGUAGE)
    return models


def predict(models: dict, langs: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not models:  # fixed cuts: sentence length, then share outside the 200 most familiar words
        return np.where(x[:, 9] < 9, 1, np.where(x[:, 9] < 14, 2, np.where(x[:, 5] < 0.45, 3, 4)))
    out = np.zeros(len(x), dtype=np.int64)
    for lang in np.unique(langs):
        m, at = models.get(int(lang), models[None]), langs == lang
        out[at] = m["levels"][(expand(x[at], m["mean"], m["std"], m["square"]) @ m["w"]).argmax(1)]
    return out


def graded(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang (its number), unfamiliar (share of words outside the 100 most familiar ones), sentence (mean words), reading_level."""
    features = cut(reading_features(documents))
    packed = documents.sparkSession.sparkContext.broadcast(cloudpickle.dumps(fit_levels(features, labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = cloudpickle.loads(packed.value)
        for b in batches:
            n = b.num_rows
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(float) if n else np.zeros((0, 15))
            y = predict(models, b.column(1).to_numpy(zero_copy_only=False), x) if n else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(x[:, CUTS.index(100)]), pa.array(x[:, len(CUTS)]), pa.array(y.astype(np.int32), pa.int32())],
                names=["doc_id", "lang", "unfamiliar", "sentence", "reading_level"],
            )

    return features.mapInArrow(run, "doc_id bigint, lang int, unfamiliar double, sentence double, reading_level int").dropDuplicates(["doc_id"])


def reading_levels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, reading_level (1 easiest to 4 hardest)."""
    return graded(documents, labels).select("doc_id", "reading_level")
