"""Common units for quantities recorded in mixed units and scales.

Money figures come out in whole US dollars, growth rates in basis points.  The order of evidence is
(1) a figure stated in the snippet (the later one in time if there are two), (2) a unit or scale named in
the snippet and applied to ``value``, (3) no evidence: the scale is inferred by a log-scale mixture whose
components are offset by the known conversion factors, with a posterior and an uncertainty flag.

All row work is built-in column expressions.  The mixture is fitted on a histogram with a fixed number of
cells (see ``HIST_STEP``), so what reaches the driver does not grow with the data.

Defined edge results: null or blank snippet = no evidence; null ``value`` without a stated figure = no row;
unknown currency of a money figure = no row; value <= 0 = no mixture posterior (``uncertain``); a claim_id
delivered several times yields one row (the delivery with most fields filled, ties by value and snippet).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstrata.sources.tables import cut

# Spellings of currencies and scales.
CURRENCY_NAMES = {
    "USD": ["usd", "us$", "$", "dollar", "dollars", "us dollars"],
    "EUR": ["eur", "€", "euro", "euros"],
    "GBP": ["gbp", "£", "pound", "pounds"],
    "INR": ["inr", "₹", "rs", "rs.", "rupee", "rupees"],
    "JPY": ["jpy", "¥", "yen"],
    "AUD": ["aud", "a$", "australian dollars"],
    "SGD": ["sgd", "s$", "singapore dollars"],
    "CHF": ["chf", "swiss franc", "swiss francs", "francs"],
}
SCALE_NAMES = {
    1e12: ["lakh crore", "lakh crores", "lakh cr", "trillion", "trillions", "tn"],
    1e9: ["billion", "billions", "bn", "b", "mil millones", "milliarde", "milliarden", "mrd", "mrd.", "milliard", "milliards", "md"],
    1e7: ["crore", "crores", "cr"],
    1e6: ["million", "millions", "mn", "m", "millón", "millones", "millionen", "mio", "mio."],
    1e5: ["lakh", "lakhs"],
    1e3: ["thousand", "thousands", "'000", "mille", "mil", "tausend"],
}
NUMBER_WORDS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve"]
RATE_NAMES = {100.0: ["%", "percent", "per cent", "pct"], 1.0: ["basis points", "basis point", "bps", "bp"]}
MONEY_FACTORS = [1.0, 1e3, 1e5, 1e6, 1e7, 1e9, 1e12]
RATE_FACTORS = [1.0, 10.0, 100.0, 1e4]

# Fixed formats. Groups: 1 bracket currency, 2 bracket scale, 3 currency, 4 number, 5 scale, 6 currency after, 7 year.
_CODE = r"USD|EUR|GBP|INR|CHF|AUD|SGD|JPY"
_CUR = rf"US\$|A\$|S\$|\$|€|£|¥|₹|Rs\.?|(?:{_CODE})(?![A-Za-z])"
_CUR2 = rf"(?:de |d')?(?:{_CODE}|€|[Ee]uros?|dollars|pounds|rupees|yen|Swiss francs)(?![A-Za-z])"
_NUM = r"[0-9](?:[0-9.,]*[0-9])?|(?<![A-Za-z])(?:" + "|".join(NUMBER_WORDS) + r")(?: and a half)?(?![A-Za-z])"
_SCALE = (
    r"lakh cr(?:ores?)?|crores?|Crores?|cr|lakhs?|trillions?|tn|mil millones|mill(?:ón|ones)|[Mm]illiarden?|milliards?|"
    r"[Mm]illionen|millions?|Mrd\.?|Mio\.?|Md|billions?|bn|mn|thousands?|M|B"
)
_TAIL = r"(?:,? ?(?:\((?:Stand )?|in |by |en |a |for |para |pour )(?:el )?((?:19|20)[0-9]{2})(?![0-9]))?"
MONEY = rf"(?:(?:\(({_CODE}) ('000|thousands?|millions?|billions?|mn|bn)\)|({_CUR}))\s*)?({_NUM})(?:\s?({_SCALE})(?![A-Za-z]))?(?:\s?({_CUR2}))?{_TAIL}"
UNIT_ONLY = rf"(?:(?:in|en|read) \"?)(?:({_CODE}) ({_SCALE})|({_SCALE}) (?:de |d'|in )?({_CODE}))(?![A-Za-z])"
RATE = r"(?i)CAGR(?: (?:of|de|von|d'environ))?\s+([0-9](?:[0-9.,]*[0-9])?)\s*(%|per ?cent|pct|basis points?|bps?)"
RATE_UNIT = r"(?i)(?:in|en) (%|per ?cent|pct|basis points?|bps?)(?![A-Za-z])"

HIST_STEP = 0.05
DOUBTFUL_BELOW = 0.95


def _lookup(names: dict, key: Column) -> Column:
    pairs = [x for value, keys in names.items() for k in keys for x in (F.lit(k), F.lit(value))]
    return F.try_element_at(F.create_map(*pairs), key)


def currency_code(raw: Column) -> Column:
    """ISO code of a freely spelled currency; null when unknown."""
    key = F.regexp_replace(F.lower(F.trim(raw)), r"^(?:de |d')", "")
    return _lookup(CURRENCY_NAMES, F.when(key != "", key))


def scale_factor(raw: Column) -> Column:
    """Multiplier of a scale word; null when unknown."""
    return _lookup(SCALE_NAMES, F.when(raw != "", F.lower(raw)))


def number_value(raw: Column) -> Column:
    """Number in English or continental spelling, or a number word, as double.

    With both marks the later one is the decimal mark; a lone comma or dot followed only by groups of three
    digits marks thousands (for the dot: two groups or more).
    """
    both = raw.contains(",") & raw.contains(".")
    english = F.regexp_replace(raw, ",", "")
    continental = F.replace(F.regexp_replace(raw, r"\.", ""), F.lit(","), F.lit("."))
    text = (
        F.when(both & (F.locate(".", raw) > F.locate(",", raw)), english)
        .when(both, continental)
        .when(raw.rlike(r"^[0-9]{1,3}(?:,[0-9]{3})+$"), english)
        .when(raw.contains(",") | raw.rlike(r"^[0-9]{1,3}(?:\.[0-9]{3}){2,}$"), continental)
        .otherwise(raw)
    )
    words = {float(i + 1): [w] for i, w in enumerate(NUMBER_WORDS)} | {i + 1.5: [f"{w} and a half"] for i, w in enumerate(NUMBER_WORDS)}
    return F.coalesce(text.try_cast("double"), _lookup(words, raw))


def _parts(hit: Column) -> Column:
    """The groups of a money mention as an array; one match of the pattern instead of one per group."""
    return F.split(F.regexp_replace(hit, MONEY, "\u0001".join(f"${i}" for i in range(1, 8))), "\u0001", -1)


def _money_mention(p: Column, at: Column) -> Column:
    part = lambda i: F.get(p, F.lit(i - 1))
    return F.struct(
        F.coalesce(part(7).try_cast("int"), F.lit(0)).alias("year"),
        at.alias("at"),
        F.coalesce(*[currency_code(part(i)) for i in (1, 3, 6)]).alias("cur"),
        F.coalesce(scale_factor(part(2)), scale_factor(part(5))).alias("scale"),
        number_value(part(4)).alias("num"),
    )


def with_evidence(claims: DataFrame) -> DataFrame:
    """One row per claim_id with the snippet's evidence: figure, currency, factor and its kind."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in ("snippet", "value", "currency")), F.lit(0))
    best = claims.filter("claim_id is not null").groupBy("claim_id").agg(
        F.max(F.struct(filled.alias("filled"), "value", "snippet", "currency", "kind")).alias("r")
    )
    best = best.select("claim_id", "r.value", "r.snippet", "r.currency", "r.kind")
    hits = F.regexp_extract_all(F.coalesce("snippet", F.lit("")), F.lit(MONEY), F.lit(0))
    stated_parts = F.filter(F.transform(hits, _parts), lambda p: F.concat(F.get(p, F.lit(0)), F.get(p, F.lit(2)), F.get(p, F.lit(4)), F.get(p, F.lit(5))) != "")
    mention = F.array_max(F.filter(F.transform(stated_parts, _money_mention), lambda m: m["num"].isNotNull()))
    # each pattern goes over the snippet once; its groups are taken from the short hit
    unit_parts = F.split(F.regexp_replace(F.regexp_extract(F.coalesce("snippet", F.lit("")), UNIT_ONLY, 0), UNIT_ONLY, "$1\u0001$2\u0001$3\u0001$4"), "\u0001", -1)
    rate_parts = F.split(F.regexp_replace(F.regexp_extract(F.coalesce("snippet", F.lit("")), RATE, 0), RATE, "$1\u0001$2"), "\u0001", -1)
    unit = lambda i: F.coalesce(F.get("unit_parts", F.lit(i - 1)), F.lit(""))
    rate = lambda i: F.coalesce(F.get("rate_parts", F.lit(i - 1)), F.lit(""))
    rate_factor = lambda c: _lookup(RATE_NAMES, F.when(c != "", F.regexp_replace(F.lower(c), r"\s+", " ")))
    money, growth = F.col("kind") == "market_size", F.col("kind") == "cagr_pct"
    best = best.withColumns({"unit_parts": F.when(money, unit_parts), "rate_parts": F.when(growth, rate_parts)})
    out = best.withColumns(
        {
            "m": F.when(money, mention),
            "named_scale": F.when(money, F.coalesce(scale_factor(unit(2)), scale_factor(unit(3)))).otherwise(
                rate_factor(F.regexp_extract(F.coalesce("snippet", F.lit("")), RATE_UNIT, 1))
            ),
            "named_cur": F.when(money, F.coalesce(currency_code(unit(1)), currency_code(unit(4)))),
            "rate_num": F.when(growth, number_value(rate(1))),
            "rate_factor": F.when(growth, rate_factor(rate(2))),
        }
    )
    stated = F.when(money, F.col("m").isNotNull() & F.col("named_scale").isNull()).otherwise(F.col("rate_num").isNotNull() & F.col("rate_factor").isNotNull())
    return out.select(
        "claim_id",
        "kind",
        "value",
        F.when(stated, "stated").when(F.col("named_scale").isNotNull(), "named").otherwise("none").alias("evidence"),
        F.when(money, F.coalesce(F.when(stated, F.col("m.cur")), F.col("named_cur"), currency_code(F.col("currency")))).otherwise("rate").alias("cur"),
        F.when(stated, F.coalesce(F.col("m.num"), F.col("rate_num"))).alias("stated_num"),
        F.when(stated & money, F.coalesce(F.col("m.scale"), F.lit(1.0))).when(stated, F.col("rate_factor")).otherwise(F.col("named_scale")).alias("factor"),
    ).filter(money | growth)


def fit_scale_mixture(evidence: DataFrame) -> dict[str, dict]:
    """Per kind with any known factor: weights of the conversion-factor components and the common log10 mean and deviation.

    Semi-supervised EM over a histogram of log10(value): rows whose factor is known from the snippet sit in
    their component, the others are shared out by responsibility.  Histogram size is bounded by
    2 kinds x (28 / HIST_STEP) cells x (components + 1), whatever the number of claims.
    """
    truth = F.when(F.col("evidence") == "stated", F.col("stated_num") * F.col("factor"))
    step = F.round(F.log10(truth / F.col("value")) * 2) / 2
    known = F.when(F.col("evidence") == "named", F.round(F.log10("factor") * 2) / 2).otherwise(step)
    cells = (
        evidence.filter("value > 0 and value < 1e20")
        .select("kind", (F.floor(F.log10("value") / HIST_STEP)).alias("cell"), known.alias("known"))
        .filter("cell between -160 and 400 and (known is null or known between 0 and 12)")
        .groupBy("kind", "cell", "known")
        .count()
        .collect()
    )
    models = {}
    for kind, factors in (("market_size", MONEY_FACTORS), ("cagr_pct", RATE_FACTORS)):
        offs = [math.log10(f) for f in factors]
        rows = [((r["cell"] + 0.5) * HIST_STEP, r["known"], r["count"]) for r in cells if r["kind"] == kind]
        fixed = [(x + k, n) for x, k, n in rows if k is not None]
        total = sum(n for _, n in fixed)
        if not total:  # nothing fixes the scale
            continue
        mu = sum(x * n for x, n in fixed) / total
        sd = max(0.2, math.sqrt(sum(n * (x - mu) ** 2 for x, n in fixed) / total))
        w = [1 / len(offs)] * len(offs)
        free = [(x, n) for x, k, n in rows if k is None]
        for _ in range(60):
            got, s1, s2, mass = [1e-3] * len(offs), 0.0, 0.0, 0.0
            for x, n in free:
                p = [wk * math.exp(-0.5 * ((x + o - mu) / sd) ** 2) for wk, o in zip(w, offs, strict=True)]
                z = sum(p) or 1.0
                for j, pj in enumerate(p):
                    got[j] += n * pj / z
                    s1 += n * pj / z * (x + offs[j])
                    s2 += n * pj / z * (x + offs[j]) ** 2
                    mass += n * pj / z
            w = [g / sum(got) for g in got]
            mass += total
            s1 += sum(x * n for x, n in fixed)
            s2 += sum(x * x * n for x, n in fixed)
            mu = s1 / mass
            sd = max(0.2, math.sqrt(max(0.0, s2 / mass - mu * mu)))
        models[kind] = {"factors": factors, "weights": w, "mu": mu, "sd": sd}
    return models


def convert_units(claims: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """claim_id, kind, unit, amount, evidence, factor, posterior, uncertain for every claim with a known figure.

    ``factor`` and ``posterior`` of rows without evidence come from the mixture.  ``amount`` takes the mixture's factor
    where its posterior is decisive; where it is not (``uncertain``), the figure is read in whole units of
    currency or in percent, the project's reading where nothing helps.
    """
    ev = cut(with_evidence(claims))
    models = fit_scale_mixture(ev)
    post = F.lit(None).cast("array<struct<p:double,f:double>>")
    for kind, m in models.items():
        x = F.log10(F.when(F.col("value") > 0, F.col("value")))
        like = [
            F.lit(max(w, 1e-9)) * F.exp(F.lit(-0.5) * F.pow((x + F.lit(math.log10(f)) - F.lit(m["mu"])) / F.lit(m["sd"]), F.lit(2.0))) + F.lit(1e-300)
            for w, f in zip(m["weights"], m["factors"], strict=True)
        ]
        total = sum(like[1:], like[0])
        arr = F.array(*[F.struct((p / total).alias("p"), F.lit(f).alias("f")) for p, f in zip(like, m["factors"], strict=True)])
        post = F.when((F.col("kind") == kind) & (F.col("evidence") == "none") & x.isNotNull(), arr).otherwise(post)
    # the rate table is one row per currency of the world; checked before it is broadcast
    rates = fx_rates.filter("currency is not null and usd_per_unit is not null").groupBy(F.upper(F.trim("currency")).alias("cur")).agg(F.max("usd_per_unit").alias("rate"))
    rates = F.broadcast(rates) if rates.count() <= 1000 else rates
    best = F.array_max("post")
    base = F.when(F.col("kind") == "market_size", F.lit(1.0)).otherwise(F.lit(100.0))
    money = F.col("kind") == "market_size"
    rows = (
        ev.withColumn("post", post)
        .join(rates, "cur", "left")
        .withColumns({"rate": F.when(money, F.col("rate")).otherwise(F.lit(1.0)), "figure": F.when(F.col("evidence") == "stated", F.col("stated_num")).otherwise(F.col("value"))})
        .filter("rate is not null and figure is not null and not isnan(figure)")
        .withColumns({"used": F.coalesce("factor", best["f"], base), "posterior": F.when(F.col("evidence") != "none", F.lit(1.0)).otherwise(best["p"])})
    )
    doubtful = F.coalesce("posterior", F.lit(0.0)) < DOUBTFUL_BELOW
    used = F.when(doubtful, F.coalesce("factor", base)).otherwise(F.col("used"))
    return rows.select(
        "claim_id",
        "kind",
        F.when(money, "USD").otherwise("bp").alias("unit"),
        F.round(F.round(F.col("figure") * used * F.col("rate"), 4)).cast("long").alias("amount"),
        "evidence",
        used.alias("factor"),
        F.round("posterior", 6).alias("posterior"),
        doubtful.alias("uncertain"),
    )
