"""One pass over whole texts that turns each document into a compact word profile.

A profile holds the distinct words of five letters or more as 32-bit hashes with their counts.  It is a
tenth of the text's size, so later stages shuffle profiles and never the texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docstrata.sources.tables import bounded_broadcast, cut

MIN_CHARS = 200
WORD = re.compile(r"[^\W\d_]{5,}")
TOKEN = re.compile(r"\w+")
BROKEN = re.compile(r"(?<=\w)-\s*\n\s*(?=\w)")
CACHE_WORDS = 500_000
MAX_BROADCAST = 200_000
BANDS, ROWS = 16, 3


def word_ids(words: list[str], cache: dict[str, int]) -> list[int]:
    """Signed 32-bit hashes of words; the cache is emptied when full, so memory stays bounded."""
    out = []
    for w in words:
        h = cache.get(w)
        if h is None:
            if len(cache) >= CACHE_WORDS:
                cache.clear()
            h = zlib.crc32(w.encode())
            h = cache[w] = h - (1 << 32) if h >= 1 << 31 else h
        out.append(h)
    return out


def plain(text: str) -> str:
    """Lower case with words broken at line ends put together again."""
    t = text.lower()
    return BROKEN.sub("", t) if "-" in t else t


def profiles(documents: DataFrame, id_cols: list[str]) -> DataFrame:
    """id_cols, n_chars (trimmed), n_words, n_long (words of five letters or more), norm (hash of the text without spacing and case), words, counts.

    Null or empty text: n_chars 0, norm of the empty string, empty arrays.  Other columns are ignored.
    """
    schema = documents.select(*id_cols).schema
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", n_chars int, n_words int, n_long int, norm bigint, words array<int>, counts array<smallint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        for b in batches:
            n_chars, n_words, n_long, norm, offs, ids, cnt = [], [], [], [], [0], [], []
            for t in b.column(b.num_columns - 1).to_pylist():
                t = plain(t or "")
                c = Counter(WORD.findall(t))
                ids += word_ids(list(c), cache)
                cnt += c.values()
                offs.append(len(ids))
                parts = t.split()
                n_words.append(len(parts))
                n_long.append(sum(c.values()))
                n_chars.append(len(t.strip()))
                norm.append(xxhash.xxh64_intdigest("".join(parts)) - (1 << 63))
            o = pa.array(offs, pa.int32())
            ids_np, cnt_np = np.array(ids, dtype=np.int32), np.array(cnt, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(id_cols))]
                + [pa.array(n_chars, pa.int32()), pa.array(n_words, pa.int32()), pa.array(n_long, pa.int32()), pa.array(norm, pa.int64())]
                + [pa.ListArray.from_arrays(o, pa.array(ids_np)), pa.ListArray.from_arrays(o, pa.array(np.minimum(cnt_np, 32000).astype(np.int16)))],
                names=[*id_cols, "n_chars", "n_words", "n_long", "norm", "words", "counts"],
            )

    return documents.select(*id_cols, "text").mapInArrow(run, out_schema)


def term_frequencies(profile: DataFrame) -> DataFrame:
    """word, df: documents of ``profile`` that have the word (partial counts are made before the shuffle)."""
    return profile.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))


def common_words(profile: DataFrame, share: float, at_least: int) -> tuple[DataFrame, DataFrame]:
    """(word, df) of words in two documents or more, and the words above ``share`` of the documents.

    The second list has at most (distinct words per text) / share rows whatever the corpus size, so it may be
    broadcast; its size is checked before the hint is given.
    """
    n = profile.count()
    df = cut(term_frequencies(profile).filter("df >= 2"))
    common = df.filter(F.col("df") > max(at_least, int(share * n))).select("word")
    return df, bounded_broadcast(common, common.count(), MAX_BROADCAST)


def band_keys(reps: DataFrame, key_col: str, common_ids: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """key_col, share, keys: the share of common words in the text, and its ``bands`` hashes of ``rows`` least words each.

    Taken over common words, or over all words where a text has none.
    """
    common = reps.sparkSession.sparkContext.broadcast(np.sort(np.array([r["word"] for r in common_ids.collect()], dtype=np.int32)))
    rng = np.random.default_rng(0)
    factors = rng.integers(1, 1 << 62, bands * rows, dtype=np.int64) | 1
    schema = T.StructType([reps.schema[key_col], T.StructField("share", T.DoubleType()), T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        for b in batches:
            shares, keys = [], []
            for words, counts in zip(b.column(1), b.column(2), strict=True):
                w, c = (np.asarray(x.values) for x in (words, counts))
                at = np.searchsorted(known, w)
                hit = at < len(known)
                hit[hit] = known[at[hit]] == w[hit]
                shares.append(float(c[hit].sum() / max(c.sum(), 1)))
                w = (w[hit] if hit.any() else w).astype(np.int64)
                if not len(w):
                    keys.append([])
                    continue
                x = (w[None, :] + 0x51ED270B) * factors[:, None]
                x = (x ^ (x >> 29)) * 0x3C79AC492BA7B653
                least = w[np.argmin(x ^ (x >> 32), axis=1)].reshape(bands, rows)
                key = np.arange(bands, dtype=np.int64)
                for j in range(rows):
                    key = (key ^ least[:, j]) * 0x1C69B3F74AC4AE35
                    key ^= key >> 31
                keys.append(key.tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shares, pa.float64()), pa.array(keys, pa.list_(pa.int64()))], names=[key_col, "share", "keys"])

    return reps.select(key_col, "words", "counts").mapInArrow(run, schema)


UNRELATED = 0.35  # below this share of the smaller vocabulary in common two texts are unrelated


def checksum_members(texts: DataFrame) -> DataFrame:
    """md5, key, first for checksums that stand for one file; ``texts`` has md5, key, seq and words.

    Each text is compared with the earliest of its checksum that has words: one row per text, however many
    share the checksum.  A checksum with any unrelated text proves nothing and is left out whole.  Texts
    without words (blank, failed conversions) neither prove nor disprove.
    """
    sums = texts.groupBy("md5").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("seq", "key"))["key"].alias("first"), F.min_by("key", F.when(F.size("words") > 0, F.col("seq"))).alias("model")
    )
    sums = sums.filter("n > 1").select("md5", "first", "model")
    t = cut(texts.join(sums, "md5"))
    model = t.filter("key = model").select("md5", F.col("words").alias("m_words"))
    both = t.filter("key <> model").join(model, "md5").filter("size(words) > 0")
    share = F.size(F.array_intersect("words", "m_words")) / F.least(F.size("words"), F.size("m_words"))
    void = both.filter(share < UNRELATED).select("md5").distinct()
    return t.join(void, "md5", "left_anti").select("md5", "key", "first")
