"""Quantitative claims in running text: money figures and growth rates with the market they speak of.

Windows around match offsets need positions, which no built-in function gives, so one small pure function
works on a text inside ``mapInPandas``; everything before and after is relational.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed formats and values.
MONEY = re.compile(r"(USD|US\$|\$|INR|Rs\.?|₹|EUR|€|GBP|£)\s?(\d[\d,]*(?:\.\d+)?)\s?(trillion|billion|million|bn|mn|tn|lakh crore|crore|B|M)\b", re.I)
GROWTH = re.compile(r"CAGR[^%\n]{0,50}?(\d{1,2}(?:\.\d+)?)\s?%", re.I)
MARKET = re.compile(r"((?:[A-Za-z][A-Za-z\-]+\s+){1,4})market\b", re.I)
YEAR = re.compile(r"\b(20[1-5]\d)\b")
CUE = re.compile(r"size|worth|valued|value of|reach|projected|expected|estimated|revenue|grow", re.I)
FILLER = set(
    "the a an of in for and to by this that its their with on is as at from was be are which has have will target overall total current entire whole growing large new".split()
)
CODES = {"$": "USD", "us$": "USD", "rs": "INR", "rs.": "INR", "₹": "INR", "€": "EUR", "£": "GBP"}
FACTORS = {"trillion": 1e12, "tn": 1e12, "lakh crore": 1e12, "billion": 1e9, "bn": 1e9, "b": 1e9, "crore": 1e7, "million": 1e6, "mn": 1e6, "m": 1e6}
MAX_CLAIMS = 40  # per text, money before growth; part of the table's definition
SCHEMA = "claim_no int, kind string, subject string, currency string, value double, year int, snippet string"


def market_before(window: str, at: int) -> str | None:
    """The words of the last market phrase that begins at or before ``at``, three at most, without filler in front."""
    phrase = None
    for m in MARKET.finditer(window):
        if m.start() > at:
            break
        phrase = m.group(1)
    words = (phrase or "").lower().split()
    start = next((i for i, w in enumerate(words) if w not in FILLER), len(words))
    kept = [w for w in words[start:] if w not in ("the", "a")]
    return " ".join(kept[-3:]) or None


def claims_in(text: str | None) -> list[tuple]:
    """(kind, subject, currency, value, year, snippet) in text order, money figures first."""
    found = []
    t = text or ""
    for pattern, kind, after in ((MONEY, "market_size", 120), (GROWTH, "cagr_pct", 60)):
        for m in pattern.finditer(t):
            lo = max(0, m.start() - 160)
            window = t[lo : m.end() + after]
            money = kind == "market_size"
            if money and not ("market" in window.lower() and CUE.search(window)):
                continue
            subject = market_before(window, m.start() - lo)
            if subject is None:
                continue
            snippet = " ".join(window.split())[:280]
            if money:
                years = YEAR.findall(window)
                code = CODES.get(m.group(1).lower(), m.group(1).upper())
                found.append((kind, subject, code, float(m.group(2).replace(",", "")) * FACTORS[m.group(3).lower()], int(max(years)) if years else None, snippet))
            else:
                found.append((kind, subject, None, float(m.group(1)), None, snippet))
    return found[:MAX_CLAIMS]


def extract_claims(texts: DataFrame, key: str) -> DataFrame:
    """key and the claims of each text; null and blank texts give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, i, *c) for k, t in zip(b[key], b["text"], strict=True) for i, c in enumerate(claims_in(t))]
            out = pd.DataFrame(rows, columns=[key, "claim_no", "kind", "subject", "currency", "value", "year", "snippet"])
            out["year"] = out["year"].astype("Int32")
            yield out

    kind = texts.schema[key].dataType.simpleString()
    return texts.filter(F.length(F.trim("text")) > 0).select(key, "text").mapInPandas(run, f"`{key}` {kind}, {SCHEMA}")


def contradictions(claims: DataFrame, generic: tuple[str, ...] = ("market", "global", "global market")) -> DataFrame:
    """Same market, currency and year, different texts, figures two to fifteen times apart."""
    per_text = (
        claims.filter("kind = 'market_size' and year is not null and value >= 1e7")
        .groupBy("subject", "currency", "year", "text_hash")
        .agg(F.min("item_key").alias("item_key"), F.median("value").alias("v"))
    )
    return (
        per_text.filter(~F.col("subject").isin(list(generic)))
        .groupBy("subject", "currency", "year")
        .agg(
            F.count(F.lit(1)).alias("n_docs"), F.min("v").alias("lo"), F.max("v").alias("hi"),
            F.min_by("item_key", F.struct("v", "item_key")).alias("lo_key"), F.max_by("item_key", F.struct("v", "item_key")).alias("hi_key"),
        )
        .withColumn("ratio", F.round(F.col("hi") / F.col("lo"), 6))
        .filter("n_docs >= 2 and ratio between 2 and 15")
    )
