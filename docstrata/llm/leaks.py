"""Evaluation passages inside training text, by template canonicalisation.

A test item is instruction, passage and question; only passages are searched, each distinct one once.  In a
template, names and numbers become typed placeholders; what counts as a name is learned from the passages, and
a corpus word that no passage has is a name, too.  Both sides are cut into windows, the passages' windows fill
a Bloom filter of fixed size, corpus windows that pass it are hash-joined with the passages' windows on Spark,
so neither side passes through the driver and the corpus is read once however many items there are.  Slots
are checked by joining on them: windows of ``WINDOW`` words whose slots hold the same words are anchors of a
verbatim (whole, partial or lightly disguised) leak, and so are windows of ``TEMPLATE_WINDOW`` words with ``MIN_SLOTS``
slots that map one to one onto other words, at least one of them onto itself: names and numbers changed so
often leave no shorter window whole.  Templates without a run (see below) are re-parameterised items.

Anchors are extended to runs that tolerate single changed, inserted or lost words, on the texts of anchored
documents alone.  A run that holds names must hold the passage's own ones, the more the fewer words match:
else it is stock wording.  A run without names counts if most of its windows are particular: the documents
that have the window have, for the greater part, a whole run around it and not just a phrase.

Edge results: null or blank texts and items without a passage give no rows; documents under 200 characters
are never cases; repeated rows give one row; items with the same passage are each reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.llm.features import CACHE_WORDS, MIN_CHARS, TOKEN, plain, word_ids
from docstrata.sources.tables import bounded_broadcast, cut

WINDOW = 6
TEMPLATE_WINDOW = 20
MIN_RUN = 22  # about two dozen words, first to last, one or two of them changed
MAX_GAP = 3
MIN_MATCHED = 0.72
MIN_EVIDENCE = 1.55  # share of matched words plus share of name slots with the passage's own names
MIN_MATCHED_PLAIN = 0.9  # of a run without names
MIN_PLAIN, MIN_PLAIN_SPAN = 5, 14  # anchors and words from first to last that a run without names has left with two words changed
PARTICULAR = 0.5  # of the documents with a window that have a run around it, and of the run's windows
MIN_SLOTS = 3
FILTER_BITS = 26
MAX_KEYS, MAX_PASSAGES = 200_000, 20_000
NAME_IN_SENTENCE = re.compile(r"(?<![.!?:;]\s)(?<![\"“„«»¿¡])(?<=\s)[^\W\d_a-zß-öø-ÿ][\w]*|(?<=-)[^\W\d_a-z]\w*")
SEPARATOR, NAME, NUMBER, FIRST_WORD = 0, 1, 2, 3


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k ids."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    out = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0x100000001B3) + mixed[i : i + n]
    out ^= out >> np.uint64(32)
    return out


def encoded(words: list[str], cache: dict[str, int]) -> np.ndarray:
    return (np.array(word_ids(words, cache), dtype=np.int32).view(np.uint32)).astype(np.int64) + FIRST_WORD


class Coder(dict):
    """word -> place in ``ids`` and ``canon`` (its id, and its id or placeholder in templates); filled as words come up."""

    def __init__(self, known: tuple[np.ndarray, np.ndarray]):
        super().__init__()
        self.known, self.ids, self.canon = known, [], []

    def __missing__(self, word: str) -> int:
        i = encoded([word], {})
        self.ids.append(int(i[0]))
        self.canon.append(int(canonical(i, np.array([word[0].isdigit()]), self.known)[0]))
        self[word] = len(self.ids) - 1
        return len(self.ids) - 1


def among(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Mask of values found in sorted keys."""
    if not len(keys):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(keys, values)
    at[at == len(keys)] = 0
    return keys[at] == values


def item_passages(eval_items: DataFrame) -> DataFrame:
    """item_id, pid, passage: the blocks between the first and the last one."""
    blocks = F.filter(F.split("text", r"\n\s*\n"), lambda b: ~b.rlike(r"(?U)^\s*$"))
    t = eval_items.filter("item_id is not null and text is not null").select("item_id", blocks.alias("b")).filter(F.size("b") > 2)
    t = t.select("item_id", F.array_join(F.slice("b", 2, F.size("b") - 2), "\n").alias("passage")).distinct()
    return t.select("item_id", F.xxhash64("passage").alias("pid"), "passage")


def vocabulary(passages: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids of the passages' names and of their other words: the distinct words of the stated query set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, int] = {}
        for b in batches:
            rows: dict[int, bool] = {}
            for t in b["passage"]:
                names = {w.lower() for w in NAME_IN_SENTENCE.findall(t)}
                words = TOKEN.findall(plain(t))
                for w, i in zip(words, encoded(words, cache).tolist(), strict=True):
                    if not w[0].isdigit():
                        rows[i] = rows.get(i, False) or w in names
            yield pd.DataFrame(list(rows.items()), columns=["word", "name"]).astype({"word": "int64", "name": "bool"})

    got = passages.mapInPandas(run, "word bigint, name boolean").groupBy("word").agg(F.bool_or("name").alias("name")).toArrow()
    words, name = got.column(0).to_numpy(), got.column(1).to_numpy(zero_copy_only=False).astype(bool)
    return np.sort(words[name]), np.sort(words[~name])


def canonical(ids: np.ndarray, digit: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.where(ids == SEPARATOR, SEPARATOR, np.where(digit, NUMBER, np.where(among(known[1], ids), ids, NAME)))


def item_windows(passages: DataFrame, known: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """h, template, pid, at, name (whether it has one), words, slots of the passages' windows; words (ids) and slots (places) of templates only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, int] = {}
        for b in batches:
            rows = []
            for pid, t in zip(b["pid"], b["passage"], strict=True):
                words = TOKEN.findall(plain(t))
                ids, digit = encoded(words, cache), np.array([w[0].isdigit() for w in words], dtype=bool)
                canon = canonical(ids, digit, known)
                slot = canon < FIRST_WORD
                rows += [(h, False, pid, j, bool((canon[j : j + WINDOW] == NAME).any()), None, None) for j, h in enumerate(rolling(ids, WINDOW).view(np.int64).tolist())]
                for j, h in enumerate(rolling(canon, TEMPLATE_WINDOW).view(np.int64).tolist()):
                    at = np.flatnonzero(slot[j : j + TEMPLATE_WINDOW])
                    if len(at) >= MIN_SLOTS:
                        rows.append((h, True, pid, j, True, ids[j : j + TEMPLATE_WINDOW].tolist(), at.tolist()))
            yield pd.DataFrame(rows, columns=["h", "template", "pid", "at", "name", "words", "slots"])

    return passages.mapInPandas(run, "h bigint, template boolean, pid bigint, at int, name boolean, words array<bigint>, slots array<int>")


def bloom_filter(windows: DataFrame) -> np.ndarray:
    """Bits of the windows' hashes, 2 ** FILTER_BITS whatever their number."""
    mask = (1 << FILTER_BITS) - 1
    bit = windows.select(F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", FILTER_BITS).bitwiseAND(mask))).alias("bit"))
    got = bit.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << FILTER_BITS - 6, dtype=np.uint64)
    out[got.column(0).to_numpy()] = got.column(1).to_numpy().view(np.uint64)
    return out


def may_have(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    mask, one = np.uint64((1 << FILTER_BITS) - 1), np.uint64(1)
    out = np.ones(len(h), dtype=bool)
    for x in (h & mask, h >> np.uint64(FILTER_BITS) & mask):
        out &= (bits[x >> np.uint64(6)] >> (x & np.uint64(63)) & one).astype(bool)
    return out


def corpus_windows(documents: DataFrame, bits: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, h, template, pos, words of the corpus windows that pass the filter."""
    packed = documents.sparkSession.sparkContext.broadcast((bits, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = packed.value
        coder = Coder(known)
        for b in batches:
            if len(coder) > CACHE_WORDS:
                coder = Coder(known)
            places, begin, key = [], [], []
            n = 1
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not t or len(t.strip()) < MIN_CHARS:
                    continue
                mine = np.fromiter(map(coder.__getitem__, TOKEN.findall(plain(t))), dtype=np.int64)
                places.append(mine)
                begin.append(n)
                key.append(d)
                n += len(mine) + 1
            begin = np.array(begin, dtype=np.int64)
            ids, canon = (np.full(n, SEPARATOR, dtype=np.int64) for _ in "ab")
            if places:
                place = np.concatenate(places)
                at = np.arange(len(place)) + np.repeat(np.arange(1, len(places) + 1), [len(x) for x in places])
                ids[at], canon[at] = (np.array(x, dtype=np.int64)[place] for x in (coder.ids, coder.canon))
            near, far = rolling(ids, WINDOW), rolling(canon, TEMPLATE_WINDOW)
            at = [np.flatnonzero(may_have(bits, x)) for x in (near, far)]
            k, at = len(at[0]), np.concatenate(at)
            doc = np.searchsorted(begin, at, "right") - 1
            h = np.concatenate([near[at[:k]], far[at[k:]]]).view(np.int64)
            words = [None] * k + [ids[p : p + TEMPLATE_WINDOW].tolist() for p in at[k:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(key, dtype=np.int64)[doc]), pa.array(h), pa.array(np.arange(len(at)) >= k), pa.array((at - begin[doc]).astype(np.int32)), pa.array(words, pa.list_(pa.int64()))],
                names=["doc_id", "h", "template", "pos", "words"],
            )

    return documents.filter("doc_id is not null").select("doc_id", "text").mapInArrow(run, "doc_id bigint, h bigint, template boolean, pos int, words array<bigint>")


def runs(doc: np.ndarray, passage: np.ndarray, names: np.ndarray, shifts: list[int]) -> tuple[int, int, int]:
    """Words of the longest run with the passage's names found in doc at these shifts; start and words of the longest without any name.

    A run bridges up to MAX_GAP unmatched words and keeps a share of MIN_MATCHED matched words.
    """
    hit = np.zeros(len(passage), dtype=bool)
    j = np.arange(len(passage))
    for s in shifts:
        i = j + s
        ok = (i >= 0) & (i < len(doc))
        same = np.zeros(len(passage), dtype=bool)
        same[ok] = doc[i[ok]] == passage[ok]
        # a lone equal word at some shift means nothing: three in a row do
        if len(same) >= 3:
            run = same[:-2] & same[1:-1] & same[2:]
            hit[:-2] |= run
            hit[1:-1] |= run
            hit[2:] |= run
    at = np.flatnonzero(hit)
    named, start, bare = 0, 0, 0
    if len(at):
        for part in np.split(at, np.flatnonzero(np.diff(at) > MAX_GAP + 1) + 1):
            span = int(part[-1] - part[0] + 1)
            if span < MIN_RUN:
                continue
            slots, own = int(names[part[0] : part[-1] + 1].sum()), int(names[part].sum())
            if own and len(part) >= MIN_MATCHED * span and len(part) / span + own / slots >= MIN_EVIDENCE:
                named = max(named, span)
            if not slots and len(part) >= MIN_MATCHED_PLAIN * span and span > bare:
                start, bare = int(part[0]), span
    return named, start, bare


def extended(candidates: DataFrame, documents: DataFrame, passages: DataFrame, names: np.ndarray) -> DataFrame:
    """doc_id, pid, named, start, bare (see ``runs``) of candidates (doc_id, pid, shifts)."""
    packed = documents.sparkSession.sparkContext.broadcast(names)

    @F.pandas_udf("named int, start int, bare int")
    def best(text: pd.Series, passage: pd.Series, shifts: pd.Series) -> pd.DataFrame:
        cache: dict[str, int] = {}
        last, code, out = None, None, []
        passages: dict[str, np.ndarray] = {}
        for t, p, s in zip(text, passage, shifts, strict=True):
            if t != last:
                last, code = t, encoded(TOKEN.findall(plain(t)), cache)
            if p not in passages:
                passages[p] = encoded(TOKEN.findall(plain(p)), cache)
            out.append(runs(code, passages[p], among(packed.value, passages[p]), list(s)))
        return pd.DataFrame(out, columns=["named", "start", "bare"], dtype="int32")

    # one row per document with its passages, so that the texts stay where they are
    per_doc = cut(candidates.groupBy("doc_id").agg(F.collect_list(F.struct("pid", "shifts")).alias("c")))
    both = documents.select("doc_id", "text").filter("text is not null").join(bounded_broadcast(per_doc, per_doc.count(), MAX_KEYS), "doc_id")
    both = both.select("doc_id", "text", F.explode("c").alias("c")).select("doc_id", "text", "c.*")
    both = both.join(bounded_broadcast(passages.select("pid", "passage"), passages.count(), MAX_PASSAGES), "pid")
    return both.select("doc_id", "pid", best("text", "passage", "shifts").alias("r")).select("doc_id", "pid", "r.*").filter("named > 0 or bare > 0").distinct()


def particular_runs(found: DataFrame, anchors: DataFrame) -> DataFrame:
    """doc_id, pid, words of runs without names most of whose windows belong to whole runs wherever they stand."""
    w = found.filter("bare > 0").select("doc_id", "pid", "bare", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("bare") - WINDOW)).alias("at"))
    inside = w.groupBy("pid", "at").agg(F.count_distinct("doc_id").alias("n_run"))
    docs = anchors.join(inside.select("pid", "at"), ["pid", "at"], "left_semi").groupBy("pid", "at").agg(F.count_distinct("doc_id").alias("n"))
    ours = inside.join(docs, ["pid", "at"]).select("pid", "at", (F.col("n_run") >= PARTICULAR * F.col("n")).cast("int").alias("own"))
    return w.join(ours, ["pid", "at"]).groupBy("doc_id", "pid").agg(F.avg("own").alias("own"), F.max("bare").alias("words")).filter(F.col("own") >= PARTICULAR).select("doc_id", "pid", "words")


def leaked_items(documents: DataFrame, eval_items: DataFrame) -> DataFrame:
    """doc_id, item_id, kind (verbatim or re-parameterised), words (length of the longest run)."""
    items = cut(item_passages(eval_items))
    passages = items.groupBy("pid").agg(F.first("passage").alias("passage"))
    known = vocabulary(passages)
    windows = cut(item_windows(passages, known))
    hits = cut(corpus_windows(documents, bloom_filter(windows), known))
    small = lambda w: bounded_broadcast(w, w.count(), MAX_KEYS)
    anchors = hits.filter("not template").select("doc_id", "h", "pos").join(small(windows.filter("not template").select("h", "pid", "at", "name")), "h")
    # template windows: what a slot holds in the passage must map one to one onto what it holds in the document
    far = hits.filter("template").select("doc_id", "h", "pos", F.col("words").alias("mine")).join(small(windows.filter("template").select("h", "pid", "at", F.col("words").alias("theirs"), "slots")), "h")
    pairs = F.array_distinct(F.transform("slots", lambda i: F.struct(F.get("theirs", i).alias("a"), F.get("mine", i).alias("b"))))
    one_to_one = (F.size("pairs") == F.size(F.array_distinct("pairs.a"))) & (F.size("pairs") == F.size(F.array_distinct("pairs.b")))
    far = cut(far.withColumn("pairs", pairs).filter(one_to_one).select("doc_id", "pid", "at", "pos", F.exists("pairs", lambda x: x["a"] == x["b"]).alias("name")).distinct())
    # a template whose slots hold some word of the passage's own may be a leak with words changed ever so often
    near = anchors.select("doc_id", "pid", "at", "pos", "name", F.lit(WINDOW).alias("size")).unionByName(far.filter("name").withColumn("size", F.lit(TEMPLATE_WINDOW)))
    near = near.groupBy("doc_id", "pid").agg(
        F.bool_or("name").alias("name"), F.count_distinct("at").alias("n"), (F.max(F.col("at") + F.col("size")) - F.min("at")).alias("span"), F.collect_set(F.col("pos") - F.col("at")).alias("shifts")
    )
    near = near.filter(F.col("name") | ((F.col("n") >= MIN_PLAIN) & (F.col("span") >= MIN_PLAIN_SPAN)))
    found = cut(extended(near.select("doc_id", "pid", "shifts"), documents, passages, known[0]))
    verbatim = found.filter("named > 0").select("doc_id", "pid", F.col("named").alias("words")).unionByName(particular_runs(found, anchors))
    verbatim = cut(verbatim.groupBy("doc_id", "pid").agg(F.max("words").alias("words")))
    other = far.select("doc_id", "pid").distinct().join(verbatim, ["doc_id", "pid"], "left_anti")
    both = verbatim.withColumn("kind", F.lit("verbatim")).unionByName(other.select("doc_id", "pid", F.lit(TEMPLATE_WINDOW).alias("words"), F.lit("re-parameterised").alias("kind")))
    return both.join(items.select("pid", "item_id"), "pid").select("doc_id", "item_id", "kind", "words")
