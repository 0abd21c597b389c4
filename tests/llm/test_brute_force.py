"""The operators against plain brute force on small data."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docstrata.llm import clusters, features, history, leaks, mixing, readlevel, subjects, survivor


@pytest.fixture(scope="module")
def t(spark, data):
    return lambda n: spark.read.parquet(f"{data}/{n}.parquet")


def words(text):
    return re.findall(r"\w+", features.BROKEN.sub("", (text or "").lower()))


def near(a, b):
    n = max(len(a), len(b), 1)
    wa, wb = ({tuple(x[i : i + 3]) for i in range(len(x) - 2)} for x in (a, b))
    return 1 - sum((Counter(a) & Counter(b)).values()) / n <= history.CHANGED and 1 - len(wa & wb) / max(len(wa), len(wb), 1) <= history.WINDOWS


def test_metric_and_pivots():
    """d is a metric and the pivot bound never exceeds it."""
    import random

    rng = random.Random(0)
    d = lambda x, y: max(sum(x.values()), sum(y.values())) - sum((x & y).values())
    bags = [Counter(rng.choices("abcdefgh", k=rng.randrange(1, 12))) for _ in range(30)]
    for x in bags:
        for y in bags:
            cx, cy = (Counter() for _ in "xy")
            for b, c in ((x, cx), (y, cy)):
                for w, n in b.items():
                    c[ord(w) % 4] += n
            assert max(sum((cx - cy).values()), sum((cy - cx).values())) <= d(x, y)
            assert all(d(x, y) <= d(x, z) + d(z, y) for z in bags)


def test_repeats_against_all_pairs(t):
    docs = {r.item_key: r for r in t("docs").filter("first_seen is not null").collect()}
    texts = {r.item_key: r.text for r in t("documents").collect()}
    rows = sorted((r.first_seen, k) for k, r in docs.items() if len((texts.get(k) or "").strip()) >= features.MIN_CHARS)
    bags = {k: words(texts[k]) for _, k in rows}
    expected = set()
    for i, (_, k) in enumerate(rows):
        same = lambda a, b: "".join(texts[a].lower().split()) == "".join(texts[b].lower().split())
        if any(same(k, o) or near(bags[k], bags[o]) for _, o in rows[:i]):
            expected.add(k)
    got = {r.item_key: r.reason for r in history.repeated_rows(t("docs"), t("documents"), t("claims_done"), t("fulltext_md")).collect()}
    found = {k for k, v in got.items() if "text" in v or "near" in v}
    assert len(found & expected) >= 0.95 * len(expected) and not found - expected


def made_texts(group, own, others=300, seed=4):
    """(key, text): a group of near copies of one body, each with words of its own, and unrelated texts of the same vocabulary."""
    import random

    rng = random.Random(seed)
    made = lambda k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=k))
    vocabulary, usual = [made(rng.randrange(4, 10)) for _ in range(3000)], [made(rng.randrange(2, 8)) for _ in range(200)]
    body = [made(7) for _ in range(70)] + rng.choices(usual, k=70)
    texts = []
    for i in range(group):
        x = list(body)
        for _ in range(own):
            x[rng.randrange(len(x))] = made(9)
        texts.append((f"a{i:06d}", " ".join(x)))
    return texts + [(f"b{i:06d}", " ".join(rng.choices(vocabulary, k=60) + rng.choices(usual, k=70))) for i in range(others)]


def repeats(spark, texts, days=9):
    documents = spark.createDataFrame(texts, "item_key string, text string")
    docs = spark.createDataFrame([(k, f"2026-01-{1 + i % days:02d}", None) for i, (k, _) in enumerate(texts)], "item_key string, first_seen string, text_hash string")
    none = spark.createDataFrame([], "text_hash string, item_key string, md5 string")
    return {r.item_key for r in history.repeated_rows(docs, documents, none.select("text_hash"), none.select("item_key", "md5")).collect()}


@pytest.mark.parametrize("group, own, least", [(30, 1, 1.0), (60, 1, 1.0), (60, 12, 0.95), (500, 8, 0.99), (5000, 6, 0.99)])
def test_repeats_in_groups_of_any_size(spark, group, own, least):
    """Near copies are found in small and in hot groups, whatever words of their own they have; nothing else is.

    With 12 own words of 140 pairs differ by 17 %, where one pair in 40 has no band in common and early members have few partners.
    """
    texts = made_texts(group, own)
    found = repeats(spark, texts)
    assert not {k for k in found if k[0] == "b"}
    want = group - 1
    if group <= 60:  # by all pairs; in larger groups everyone has an earlier partner
        bags = [words(x) for _, x in sorted(((1 + i % 9, k), x) for i, (k, x) in enumerate(texts[:group]))]
        want = sum(any(near(x, y) for y in bags[:i]) for i, x in enumerate(bags))
    assert want >= len(found) >= least * want


def test_window_bands_against_all_pairs(spark):
    """Pairs that only bands can find, from few changes to the bound: as many as stated."""
    import random

    rng = random.Random(7)
    usual = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(400)]
    for share, least in ((0.05, 1.0), (0.10, 0.99), (0.15, 0.97)):
        texts = []
        for i in range(150):
            x = rng.choices(usual, k=200)
            y = list(x)
            for j in rng.sample(range(200), int(200 * share)):
                y[j] = rng.choice(usual)
            texts += [(f"{i:04d}a", " ".join(x)), (f"{i:04d}b", " ".join(y))]
        want = {b for (a, x), (b, y) in zip(texts[::2], texts[1::2], strict=True) if near(words(x), words(y))}
        got = repeats(spark, texts, days=1)
        assert len(got & want) >= least * len(want) and not got - want


def test_batches_go_into_a_table(spark, tmp_path):
    """Batch by batch gives what all at once gives; a later batch reads its own texts and the table, no earlier text."""
    texts = dict(made_texts(60, 6, 60) + [("c1", "one text alone " * 20), ("c2", "One  text alone " * 20)])
    day = {k: f"2026-01-{1 + i % 4:02d}" for i, k in enumerate(sorted(texts))} | {"c1": "2026-01-01", "c2": "2026-01-04"}
    table = lambda keys: spark.createDataFrame([(k, texts[k]) for k in keys], "item_key string, text string")
    rows = lambda keys: spark.createDataFrame([(k, day[k]) for k in keys], "k string, d string").select("k", F.to_date("d").alias("day"))
    at_once = {(r.key, r.reason) for r in history.accept(rows(texts), table(texts), history.PivotTable(spark, str(tmp_path / "one")), "all")[0].collect()}
    t, found = history.PivotTable(spark, str(tmp_path / "more")), set()
    for d in sorted(set(day.values())):
        mine = [k for k in texts if day[k] == d]
        repeated, _, new = history.accept(rows(mine), table(texts), t, d)
        found |= {(r.key, r.reason) for r in repeated.collect()}
        if d != "2026-01-01":
            # the signatures of the batch are made of its own texts alone
            assert {r.k for r in new.select("k").collect()} <= set(mine)
    assert found == at_once and ("c2", "same text") in found
    # a batch run again replaces itself
    again = history.accept(rows(mine), table(texts), t, d)[0]
    assert {(r.key, r.reason) for r in again.collect()} == {x for x in found if day[x[0]] == d}
    assert t.rows().count() == t.rows().select("k").distinct().count()


def test_batch_by_batch_equals_all_at_once(t):
    everything = {r.item_key for r in history.repeated_rows(t("docs"), t("documents"), t("claims_done").limit(0), t("fulltext_md")).filter("reason <> 'same file'").collect()}
    last = t("docs").agg(F.max("first_seen")).first()[0]
    before = {r.item_key for r in history.repeated_rows(t("docs").filter(F.col("first_seen") < last), t("documents"), t("claims_done").limit(0), t("fulltext_md")).filter("reason <> 'same file'").collect()}
    earlier = {r.item_key for r in t("docs").filter(F.col("first_seen") < last).select("item_key").collect()}
    assert before == {k for k in everything if k in earlier}


def test_survivors(spark):
    body = "Many particular words about solar turbines and generators standing beside the harbour of Korvelund. " * 5
    other = "Vollkommen verschiedene Geschichten handeln allein davon, welche Pflanzen irgendwo wachsen werden. " * 5
    m = "ab" * 16
    rows = [
        (1, "A", "Good title", body, "s1", m, None, "Solar", "2001", 100), (2, "B", "scan_12.pdf", body, "s2", m.upper(), None, "(root)", "20xx", 300), (3, "C", "Newer title", body, "s1", None, "A", None, "2003", 200),
        (4, "D", "Alone", body, "s1", None, "NOWHERE", "Solar", "2001", 100), (5, "E", "Self", body, "s1", None, "E", "Solar", "2001", 100),
        (6, "F", "Junk 1", body, "s1", "cd" * 16, None, "x", "2001", 100), (7, "G", "Junk 2", other, "s1", "cd" * 16, None, "y", "2001", 100),
        (8, "H", "Cut o…", body, "s3", None, "I", "pdf", None, None), (9, "I", "Q1W2E3R4_Title", body, "s3", None, None, "zip", " ", 0),
    ]
    d = spark.createDataFrame(rows, "doc_id bigint, item_key string, title string, text string, source string, md5 string, duplicate_of string, topic string, year string, mtime bigint")
    got = {(r.group_doc_id, r.field): r.best for r in survivor.best_values(survivor.values_judged(d)).collect()}
    assert got == {(1, "title"): "Newer title", (1, "topic"): "Solar", (1, "year"): "2003"}


def test_sources_can_veto_the_latest_value(spark):
    """The latest usable value stands against a few other sources, but not where a dozen agree on another one."""
    body = "Many particular words about solar turbines and generators standing beside the harbour of Korvelund. " * 5
    rows = []
    for g, n in ((1, 3), (2, 24)):
        for i in range(n):
            key, first = f"G{g}R{i:02d}", f"G{g}R00"
            year = "1999" if i == n - 1 else "2005"
            rows.append((g * 100 + i, key, "A title", body, f"source {i}", None, None if i == 0 else first, "Solar", year, 1000 + i))
    # elsewhere these sources agree with each other
    for g in range(10, 40):
        rows += [(g * 100 + i, f"G{g}R{i:02d}", "A title", body, f"source {i}", None, None if i == 0 else f"G{g}R00", "Solar", "2001", 1000) for i in range(24)]
    d = spark.createDataFrame(rows, "doc_id bigint, item_key string, title string, text string, source string, md5 string, duplicate_of string, topic string, year string, mtime bigint")
    got = {(r.group_doc_id, r.field): r.best for r in survivor.best_values(survivor.values_judged(d)).collect()}
    assert got[100, "year"] == "1999" and got[200, "year"] == "2005"


def test_components(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(1, 40)] + [(100, 101)], "a bigint, b bigint")
    got = {r.node: r.root for r in survivor.components(edges).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and got[101] == 100


def test_clusters_against_all_pairs(spark, t):
    """Documents whose titles name one series end in one cluster, and no cluster mixes two series."""
    docs = t("documents")
    got = {r.doc_id: r.cluster for r in clusters.similarity_clusters(docs).collect()}
    assert len(got) == docs.count()
    series = re.compile(r"(\w+) (?:series|bulletin|circular|review|digest) no\. \d+", re.I)
    by = defaultdict(set)
    for r in docs.filter(f"length(trim(text)) >= {features.MIN_CHARS}").collect():
        m = series.search((r.text or "")[:300])
        if m:
            by[m.group(1).lower()].add(got[r.doc_id])
    roots = Counter(c for cs in by.values() for c in cs)
    assert all(n == 1 for n in roots.values())
    assert sum(len(c) for c in by.values()) <= 1.05 * len(by)


def test_hot_group_of_near_copies(spark):
    """A third of all rows being near copies of one text does not keep them from one cluster."""
    base = "The harbour of Korvelund keeps seven wooden lighthouses whose keepers write letters about fishing weather every winter evening. " * 6
    rows = [(i, base.replace("seven", f"seven{'abcdefghij'[i % 10] * 3}")) for i in range(100)]
    rows += [(1000 + i, " ".join(f"{chr(97 + (i * 7 + j) % 26)}word{chr(97 + j % 26)}{chr(97 + i % 26)}{chr(97 + i // 26)}" for j in range(60)) + " " * i) for i in range(200)]
    got = {r.doc_id: r.cluster for r in clusters.similarity_clusters(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len({got[i] for i in range(100)}) == 1


def test_hot_group_with_own_words(spark):
    """A third of all rows share a body; each has 5 to 20 % words of its own, some of them shared with another text."""
    import random

    rng = random.Random(4)
    made = lambda k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=k))
    body = [made(8) for _ in range(80)]
    accidental = [made(9) for _ in range(60)]
    rows = []
    for i in range(100):
        own = [made(9) for _ in range(2 + i % 9)] + rng.sample(accidental, 2)
        own += own[: 2 if i % 3 else 0]  # words repeated in the text itself
        kept = rng.sample(body, len(body) - len(own) // 2)
        rows.append((i, " ".join(kept + own)))
    rows += [(1000 + i, " ".join([made(8) for _ in range(60)] + rng.sample(accidental, 2))) for i in range(200)]
    got = {r.doc_id: r.cluster for r in clusters.similarity_clusters(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len({got[i] for i in range(100)}) == 1
    assert len({got[1000 + i] for i in range(200)}) == 200 and not {got[1000 + i] for i in range(200)} & {got[0]}


def test_repeats_beyond_the_broadcast_bound(t, monkeypatch):
    """Beyond MAX_KEYS texts are not shuffled to be joined with keys, and the rows are the same."""
    tables = [t(x) for x in ("docs", "documents", "claims_done", "fulltext_md")]
    want = sorted(map(tuple, history.repeated_rows(*tables).collect()))
    plans, signatures = [], history.signatures

    def seen(texts):
        plans.append(texts._jdf.queryExecution().executedPlan().toString())
        return signatures(texts)

    monkeypatch.setattr(history, "signatures", seen)
    monkeypatch.setattr(history, "MAX_KEYS", 3)
    assert sorted(map(tuple, history.repeated_rows(*tables).collect())) == want
    assert len(plans) == 1 and "Exchange" not in plans[0]


def test_leaks(spark):
    passage = "The committee in Korvelund examined 45 tidal barriers beside the Marnotal ferries. Its report from Zebrinuk says that half of the Ostrelian cables were replaced in 1998 while every Pondaril winch stayed in use."
    items = spark.createDataFrame([(1, f"Read this.\n\n{passage}\n\nWhich is true?"), (2, f"Other.\n\n{passage}\n\nWhy?"), (3, "No passage"), (4, None)], "item_id bigint, text string")
    filler = "Some unrelated lines about gardens and roads that nobody needs to read twice. " * 4
    wrapped = passage.upper().replace(" ", "\n  ").replace("BESIDE", "NEAR")
    half = " ".join(passage.split()[:28])
    short = " ".join(passage.split()[:12])
    other = passage.replace("Korvelund", "Plimthar").replace("Marnotal", "Quexil").replace("Zebrinuk", "Travond").replace("Ostrelian", "Gromund").replace("Pondaril", "Yestrow")
    docs = spark.createDataFrame(list(enumerate([filler + wrapped + filler, filler + half + " " + filler, filler + short + " " + filler, filler + "Read this. Which is true? " + filler, filler + other, None])), "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in leaks.leaked_items(docs, items).collect()}
    assert {k for k, v in got.items() if v == "verbatim"} == {(0, 1), (0, 2), (1, 1), (1, 2)}
    assert {k for k, v in got.items() if v != "verbatim"} == {(4, 1), (4, 2)}


def test_leak_with_changed_names(spark):
    """Two of six names changed in a run that else matches: a leak; stock wording around other names: none."""
    passage = "Whoever needs Zansilo referees should first ask in Yolmip before the fans of Javelb and the authorities of Fikabo resolve to replace the Ossize heats with Bermek controls next year."
    items = spark.createDataFrame([(1, f"Read this.\n\n{passage}\n\nWhich is true?")], "item_id bigint, text string")
    filler = "Some unrelated lines about gardens and roads that nobody needs to read twice. " * 4
    few = passage.replace("Zansilo", "certain").replace("Bermek", "other")
    stock = few.replace("Yolmip", "Travond").replace("Javelb", "Quexil").replace("Ossize", "Gromund")
    docs = spark.createDataFrame(list(enumerate([filler + few + filler, filler + stock + filler])), "doc_id bigint, text string")
    got = leaks.leaked_items(docs, items).filter("kind = 'verbatim'").collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(0, 1)]


def test_leak_with_numbers_changed_throughout(spark):
    """Every window of six words has a changed number; the template with its slots still leads to the run."""
    passage = "near Korvelund people once built 45 tidal barriers close to Zebrinuk 73 cables then reached old Marnotal 19 winters before ferries left Pondaril 31 crews sailed on to Ostrelia 67 days after some engineers 54 of Korvelund had to leave"
    items = spark.createDataFrame([(1, f"Read this.\n\n{passage}\n\nWhich is true?")], "item_id bigint, text string")
    filler = "Some unrelated lines about gardens and roads that nobody needs to read twice. " * 4
    changed = re.sub(r"\d+", lambda m: str(int(m.group()) + 100), passage)
    strange = changed
    for a, b in (("Korvelund", "Plimthar"), ("Marnotal", "Quexil"), ("Zebrinuk", "Travond"), ("Ostrelia", "Gromund"), ("Pondaril", "Yestrow")):
        strange = strange.replace(a, b)
    docs = spark.createDataFrame([(0, filler + changed + ". " + filler), (1, filler + strange + ". " + filler)], "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in leaks.leaked_items(docs, items).collect()}
    assert got == {(0, 1): "verbatim", (1, 1): "re-parameterised"}


def test_leak_without_names(spark):
    """A passage of plain lower-case words copied whole is found; its wording as a phrase in many texts is none."""
    passage = "whoever waters the garden early in the morning saves half of the water because the soil is still cool and the leaves dry slowly while the roots drink what they need before noon comes around again"
    items = spark.createDataFrame([(1, f"Read this.\n\n{passage}\n\nWhich is true?")], "item_id bigint, text string")
    filler = "Some unrelated lines about gates and roads that nobody needs to read twice. " * 4
    phrase = " ".join(passage.split()[:9])
    docs = spark.createDataFrame(list(enumerate([filler + passage + " " + filler, passage.capitalize() + ". " + filler] + [filler + phrase + " and " + filler] * 30)), "doc_id bigint, text string")
    assert {(r.doc_id, r.kind) for r in leaks.leaked_items(docs, items).collect()} == {(0, "verbatim"), (1, "verbatim")}


def test_leak_filter_and_runs():
    import numpy as np

    h = np.array([5, 1 << 40, 2**63 + 7], dtype=np.uint64)
    bits = np.zeros(1 << leaks.FILTER_BITS - 6, dtype=np.uint64)
    mask = (1 << leaks.FILTER_BITS) - 1
    for x in h.tolist():
        for bit in (x & mask, x >> leaks.FILTER_BITS & mask):
            bits[bit >> 6] |= np.uint64(1 << (bit & 63))
    assert leaks.may_have(bits, h).all() and not leaks.may_have(bits, h + np.uint64(1)).any()
    words = np.arange(40)
    assert leaks.runs(words, words, words == 3, [0]) == (40, 0, 0)
    assert leaks.runs(words, words, words < 0, [0]) == (0, 0, 40)


def test_mix_reaches_shares(spark, t):
    r = mixing.mix_report(t("documents"), t("mix_targets")).collect()
    assert all(x.repeats_used <= x.max_repeats for x in r)
    chosen = mixing.mixed_documents(t("documents"), t("mix_targets")).collect()
    rate = {x.source: x.expected_copies for x in r}
    n = Counter()
    for c in chosen:
        assert c.copies in (int(rate[c.source]), int(rate[c.source]) + 1, round(rate[c.source]))
        n[c.source] += c.copies
    assert all(abs(n[x.source] - x.expected_copies * x.n_docs) <= 1.01 for x in r)


def test_mix_prefix_sums_over_buckets(spark, monkeypatch):
    """The sampling does not depend on how many buckets the prefix sums are cut into."""
    counts = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit(10).cast("bigint").alias("n_tokens"))
    rates = spark.createDataFrame([("a", 0.37)], "source string, rate double")
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 300)
    n = mixing.systematic_copies(counts, rates).agg(F.sum("copies")).first()[0]
    assert abs(n - 1850) <= 1


def test_languages_are_learned(spark):
    """Spellings of one language are one, a language is told by its text, and a corpus without codes has one."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profiles = readlevel.language_profiles(documents)
    assert len(profiles) == 4
    number = {lang: readlevel.language(Counter(text.split()), profiles) for lang, text in (("en", "the cat and the dog are in the house that is old"), ("de", "der Hund und die Katze ist in das Haus nicht mit den"), ("fr", "le chat et les chiens dans la maison est que une"), ("es", "el gato y los perros en la casa es que una con por"))}
    assert len(set(number.values())) == 4
    fifth = [(10_000 + i, "xx", "ta ne mi ku so ra " * 40) for i in range(60)]
    more = documents.select("doc_id", "lang", "text").unionByName(spark.createDataFrame(fifth, "doc_id bigint, lang string, text string"))
    assert len(readlevel.language_profiles(more)) == 5
    assert readlevel.language_profiles(documents.drop("lang")) == [{}]


def test_votes_decide_where_the_lexicon_cannot():
    """With few topical words the other functions decide; with many they do not, and silence is no evidence."""
    sure = [((8, 1, 1, 1, 1), 900), ((-8, 0, 0, 0, 2), 9000), ((8, 0, 0, 0, 0), 100), ((-8, 1, 0, 0, 0), 50)]
    post = subjects.fit_votes([*sure, ((-1, 1, 1, 1, 1), 5), ((-1, 0, 0, 0, 0), 5), ((1, 0, 0, 0, 0), 5)])
    assert post[-1, 1, 1, 1, 1] > 0.9 and post[-1, 0, 0, 0, 0] < 0.5 < post[1, 0, 0, 0, 0]
    assert post[8, 0, 0, 0, 0] > 0.99 and post[-8, 1, 0, 0, 0] < 0.5


def test_subjects_and_levels_on_labels(spark):
    """Subjects on labels, which the operator does not read; levels on labels held out from the fit."""
    t = lambda n: spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet")
    labels = t("labels").collect()
    got = {(r.doc_id, r.subject) for r in subjects.document_subjects(t("documents"), t("auto_topics"), t("subjects")).collect()}
    want = {(r.doc_id, r.subject) for r in labels}
    mine = {x for x in got if x[0] in {d for d, _ in want}}
    assert len(mine & want) >= 0.97 * len(want) and len(mine - want) <= 0.03 * len(want)
    held = {r.doc_id: r.reading_level for r in labels if r.reading_level is not None and r.doc_id % 3 == 0}
    level = {r.doc_id: r.reading_level for r in readlevel.reading_levels(t("documents"), t("labels").filter("doc_id % 3 <> 0")).collect()}
    assert sum(level.get(d) == v for d, v in held.items()) >= 0.9 * len(held)


def test_similar_pairs_against_all_pairs(spark):
    """Every pair of a cosine of SIM or more is found, also where each common word has a text of lower rank that is not alike."""
    import random

    rng = random.Random(5)
    weight, texts = {w: 1 + w % 3 for w in range(400)}, {}
    for i in range(120):
        base = texts[i - 1] if i % 2 else rng.sample(range(400), 12)
        texts[i] = [*rng.sample(base, 8), *rng.sample(range(400), 4)] if i % 2 else base
    df = Counter(w for x in texts.values() for w in set(x))
    rows = {}
    for i, x in texts.items():
        norm = sum(weight[w] ** 2 for w in set(x)) ** 0.5
        rows[i] = {w: weight[w] / norm for w in set(x)}
    vectors = spark.createDataFrame([(i, sorted((df[w], w, v) for w, v in x.items())) for i, x in rows.items()], "doc_id bigint, vec array<struct<df bigint, term bigint, w float>>")
    dot = lambda a, b: sum(v * rows[b].get(w, 0.0) for w, v in rows[a].items())
    want = {(a, b) for a in rows for b in rows if a < b and dot(a, b) >= clusters.SIM + 1e-4}
    got = {tuple(sorted((r.doc_id, r.other))) for r in clusters.similar_pairs(vectors).collect()}
    assert len(want) > 50 and want <= got and all(dot(a, b) >= clusters.SIM - 1e-4 for a, b in got)
    # no pivot is left beside a similar text of lower rank that is a pivot, too
    by = {r.doc_id: r.cluster for r in clusters.pivot_rounds(vectors).collect()}
    pivots = set(by.values())
    assert len(by) == len(rows) and not {(a, b) for a, b in want if a in pivots and b in pivots}


def test_near_groups_in_blocks(spark, monkeypatch):
    """More nominees than are sent at once, and more copies than are broadcast, change no cluster."""
    texts = [x for k in range(4) for x in made_texts(30, 4, 10, seed=k)]
    documents = spark.createDataFrame([(i, x) for i, (_, x) in enumerate(texts)] + [(1000 + i, x) for i, (_, x) in enumerate(texts[:9])], "doc_id bigint, text string")
    plain = {tuple(r) for r in clusters.similarity_clusters(documents).select("doc_id", "cluster").collect()}
    bounds = []
    monkeypatch.setattr(clusters, "MAX_NOMINEES", 3)
    monkeypatch.setattr(clusters, "MAX_BROADCAST", 5)
    monkeypatch.setattr(clusters, "bounded_broadcast", lambda df, rows, most: (bounds.append((rows, most)), df)[1])
    monkeypatch.setattr(clusters, "COMMON_AT_LEAST", 10)
    few = clusters.similarity_clusters(documents).select("doc_id", "cluster")
    monkeypatch.setattr(clusters, "MAX_NOMINEES", 50_000)
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in clusters.similarity_clusters(documents).select("doc_id", "cluster").collect()}
    # words are never joined with more nominees than one block has
    assert plain and [x for x in bounds if x[1] == 3] and all(rows <= most for rows, most in bounds if most == 3)


def test_languages_come_from_all_documents(spark):
    """A language of a few documents among many is learned: no document with a code is left out."""
    usual = {"aa": "the and of to in is that it for was ", "bb": "ta ne mi ku so ra pe lo vi du "}
    rows = [(i, "aa", usual["aa"] * 2 + f"x{i % 7}") for i in range(9000)] + [(10_000 + i, "bb", usual["bb"] * 2) for i in range(readlevel.MIN_LANGUAGE_DOCS)]
    profiles = readlevel.language_profiles(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"))
    assert len(profiles) == 2 and any("ku" in p for p in profiles)
