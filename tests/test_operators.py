import io
import random
import zipfile

import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from docstrata.operators import claims, pending, state, units
from docstrata.operators.similarity import near_counts, nearest
from docstrata.operators.text import bm25, tfidf, vocabulary
from docstrata.operators.topics import FEATURES, column_of, topic_clusters
from docstrata.plans import queries as core
from docstrata.sources import landed, tables
from docstrata.sources.tables import attached
from docstrata.streaming.incremental import follow_attempts, merge_batch


def test_claims_in_text():
    t = "The global electric vehicle market size is projected to reach USD 1.5 trillion by 2030 and grow at a CAGR of 12.5%."
    got = claims.claims_in(t)
    assert got[0][:5] == ("market_size", "global electric vehicle", "USD", 1.5e12, 2030)
    assert got[1][:4] == ("cagr_pct", "global electric vehicle", None, 12.5)
    assert claims.claims_in(None) == [] and claims.claims_in("worth USD 5 million") == []
    assert claims.claims_in("The tea market is worth Rs 5 lakh crore.")[0][2:4] == ("INR", 5e12)
    assert len(claims.claims_in(t * 60)) == claims.MAX_CLAIMS


def test_extract_claims_edges(spark):
    rows = [("a", None), ("b", " "), ("c", "The bus market was valued at EUR 3.2 billion in 2024."), ("c", "The bus market was valued at EUR 3.2 billion in 2024.")]
    got = claims.extract_claims(spark.createDataFrame(rows, "item_key string, text string"), "item_key").collect()
    assert [(r.item_key, r.value) for r in got] == [("c", 3.2e9), ("c", 3.2e9)]
    assert claims.extract_claims(spark.createDataFrame([], "item_key string, text string"), "item_key").count() == 0


CLAIMS = "claim_id bigint, kind string, currency string, value double, snippet string, unit string, cur string"


@pytest.mark.parametrize(
    "kind, currency, value, snippet, amount",
    [
        ("market_size", None, 7.0, "valued at seven billion dollars by 2022.", 7_000_000_000),
        ("market_size", "USD", None, "was worth twelve and a half million pounds in 2030.", 15_912_500),
        ("market_size", "EUR", 1.0, "pasó de 58,2 millones de euros en 2022 a 81,3 millones de euros en 2026.", 88_129_200),
        ("market_size", "EUR", 1.0, "to 81.3 million euros by 2026, up from 58.2 million euros in 2022", 88_129_200),
        ("market_size", "USD", 5.0, "market size A$6,687,700,000, estimated for 2022.", 4_420_569_700),
        ("market_size", None, 5099.6, 'market, X, 2030; column heads read "AUD mn".', 3_370_835_600),
        ("market_size", None, 1778.9, "Tabelle 3 (alle Angaben in Mio. EUR): Markt, X, 2028.", 1_928_327_600),
        ("market_size", "USD", 2.0, "projected at (USD '000) 869,710 for 2029", 869_710_000),
        ("market_size", "INR", 1.0, "worth ₹1,277 lakh in 2018", 1_545_170),
        ("market_size", "INR", 1.0, "worth ₹ 28.4 lakh crore for 2021", 343_640_000_000),
        ("market_size", "€", 2e6, "is expected to grow, see the annex for 2033.", 2_168_000),
        ("market_size", "de euros", 2e6, None, 2_168_000),
        ("market_size", None, 2e6, None, None),
        ("market_size", "USD", None, " ", None),
        ("cagr_pct", None, 0.057, "at a CAGR of 5.7% through 2022.", 570),
        ("cagr_pct", None, 1.0, "mit einer CAGR von 3,755 bp.", 3755),
        ("cagr_pct", "pct", 12.5, None, 1250),
        ("other", "USD", 1.0, None, None),
    ],
)
def test_units(spark, kind, currency, value, snippet, amount):
    fx = spark.createDataFrame([("USD", 1.0), ("EUR", 1.084), ("GBP", 1.273), ("AUD", 0.661), ("INR", 0.0121), (None, 2.0)], "currency string, usd_per_unit double")
    rows = spark.createDataFrame([(1, kind, currency, value, snippet, "x", "y")] * 2 + [(None, kind, currency, value, snippet, "x", "y")], CLAIMS)
    got = [r.amount for r in units.convert_units(rows, fx).collect()]
    assert got == ([] if amount is None else [amount])


def test_units_mixture_and_empty(spark):
    fx = spark.createDataFrame([("USD", 1.0)], "currency string, usd_per_unit double")
    assert units.convert_units(spark.createDataFrame([], CLAIMS), fx).count() == 0
    rng = random.Random(1)
    rows = [(i, "cagr_pct", None, v, f"CAGR of {v}%", "", "") for i, v in enumerate(round(rng.uniform(2, 40), 1) for _ in range(300))]
    rows += [(1000 + i, "cagr_pct", None, round(rng.uniform(0.02, 0.05), 4), None, "", "") for i in range(100)]
    got = units.convert_units(spark.createDataFrame(rows, CLAIMS), fx).filter("evidence = 'none'")
    assert got.filter("factor = 10000 and not uncertain").count() == 100
    # the mixture decides the amount: read as it stands, 0.03 would be 3 basis points
    value = {r[0]: r[3] for r in rows}
    assert all(r.amount == round(value[r.claim_id] * 10000) for r in got.collect())


def test_budget_against_fold(spark):
    rng = random.Random(5)
    rows = [(f"s{rng.randrange(3)}", f"k{i:04d}", round(rng.choice([0.5, 1.0, 30.0, 7.25]) * rng.random(), 3)) for i in range(400)]
    for budget in (0.0, 5.0, 60.0, 1e9):
        used, expected = 0.0, set()
        for s, k, size in sorted(rows):
            if used > 0 and used + size > budget:
                continue
            if used == 0 and expected and size > budget:
                continue
            used += size
            expected.add(k)
        got = {r.key for r in pending.admit(spark.createDataFrame(rows, "source string, key string, size_mb double"), budget, ["source", "key"]).collect()}
        assert got == expected, budget
    assert pending.admit(spark.createDataFrame([], "source string, key string, size_mb double"), 5.0, ["source", "key"]).count() == 0


def test_state(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 9)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4), ("c", 5)], "k string, v int")
    assert {tuple(r) for r in state.upsert(old, new.dropDuplicates(["k"]), ["k"]).select("k").collect()} == {("a",), ("b",), ("c",), (None,)}
    assert [tuple(r) for r in state.insert_absent(old, new, ["k"], [F.col("v")]).collect()] == [("c", 4)]
    assert {r.k: r.v for r in state.update_from(old, new.filter("k = 'b'"), "k", "v").collect()} == {"a": 1, "b": 3, None: 9}
    assert "extra" in state.update_from(old, new.select("k", F.lit("x").alias("extra")).filter("k = 'b'"), "k", "extra").columns


def test_publish_and_stream(spark, tmp_path):
    schema = "item_key string, md5 string, title string, source string, status string, chars bigint, converted_at timestamp_ntz"
    rows = [("a", None, None, "s", "failed", 1, "2026-01-01 00:00:00"), ("a", None, None, "s", "ok", 2, "2026-01-02 00:00:00"), ("b", None, None, "s", "ok", 3, None)]
    df = spark.createDataFrame(rows, "item_key string, md5 string, title string, source string, status string, chars bigint, c string").withColumn("converted_at", F.col("c").cast("timestamp_ntz")).drop("c")
    src, st, cp = (str(tmp_path / x) for x in ("in", "state", "cp"))
    df.limit(1).write.parquet(src)
    follow_attempts(spark, src, st, cp, df.schema)
    df.filter("status = 'ok'").write.mode("append").parquet(src)
    follow_attempts(spark, src, st, cp, df.schema)
    follow_attempts(spark, src, st, cp, df.schema)
    got = {r.item_key: r.status for r in state.current(spark, st).collect()}
    assert got == {r.item_key: r.status for r in pending.last_attempts(df).collect()} == {"a": "ok", "b": "ok"}
    assert schema


def test_stream_replay_and_new_checkpoint(spark, tmp_path):
    """A batch run again, before or after it was published, gives the same state; a new checkpoint goes on from it."""
    cols = "item_key string, status string, chars bigint, converted_at timestamp_ntz"
    rows = lambda *x: spark.createDataFrame([(k, s, 1, None) for k, s in x], "item_key string, status string, chars bigint, c string").select("item_key", "status", "chars", F.col("c").cast("timestamp_ntz").alias("converted_at"))
    st = str(tmp_path / "state")
    got = lambda: {r.item_key: r.status for r in state.current(spark, st).collect()}
    merge_batch(spark, rows(("a", "failed"), ("b", "ok")), st, 0)
    merge_batch(spark, rows(("a", "ok"), ("c", "failed")), st, 1)
    want = {"a": "ok", "b": "ok", "c": "failed"}
    assert got() == want
    merge_batch(spark, rows(("a", "ok"), ("c", "failed")), st, 1)
    assert got() == want
    rows(("d", "ok")).write.parquet(str(tmp_path / "in"))
    follow_attempts(spark, str(tmp_path / "in"), st, str(tmp_path / "cp"), rows().schema)
    assert got() == want | {"d": "ok"} and cols
    state.append_log(rows(("a", "ok")), str(tmp_path / "log"), "r1")
    state.append_log(rows(("b", "ok")), str(tmp_path / "log"), "r2")
    assert {(r.item_key, r.run) for r in spark.read.json(str(tmp_path / "log")).collect()} == {("a", "r1"), ("b", "r2")}


def test_near_counts_all_partners(spark):
    """More partners than any list of neighbours holds are all counted."""
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100 + i, [0.0, 1.0]) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    assert {(r.q, r.level): r.n for r in near_counts(df, df.filter("vec_id in (0, 100)"), [0.97]).collect()} == {(0, 0.97): 59, (100, 0.97): 2}


def test_nearest_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(120)] + [(500, None), (501, []), (502, [0.0] * 8), (503, [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = {(r.q, r["rank"]): r.vec_id for r in nearest(df, df.filter("vec_id % 50 = 0"), k=3).collect()}
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5  # noqa: E731, B905
    for q in (0, 50, 100):
        best = sorted((-round(cos(rows[q][1], rows[i][1]), 9), i) for i in range(120) if i != q)[:3]
        assert [got[q, k + 1] for k in range(3)] == [i for _, i in best]


def test_text_edges(spark):
    docs = spark.createDataFrame([("a", "solar panels and solar roofs"), ("b", None), ("c", ""), ("d", "courts")], "k string, text string")
    assert [r.k for r in bm25(docs, "k", ["Solar"]).collect()] == ["a"]
    w = tfidf(docs, "k", vocabulary(docs, min_df=1, max_df=1.0))
    norms = w.groupBy("k").agg(F.round(F.sum(F.col("weight") * F.col("weight")), 9).alias("n")).collect()
    assert {r.k: r.n for r in norms} == {"a": 1.0, "d": 1.0}
    assert tfidf(docs.limit(0), "k").count() == 0
    assert topic_clusters(docs, "k").count() == 0


def test_topics_cover_all(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = topic_clusters(docs, "item_key")
    assert got.count() == got.select("item_key").distinct().count() > 0
    assert got.filter("distance is null or cluster < 0").count() == 0


def test_topics_hash_like_mllib(spark):
    h = HashingTF(numFeatures=FEATURES)
    words = ["sun", "roof", "panel", "courts", "batteries", "strombedarf"]
    assert [column_of(w) for w in words] == [h.indexOf(w) for w in words]


def test_corpus_is_read_once(spark, data):
    """The privacy patterns run over the texts once, whatever reads the corpus, and texts do not move to be joined with it."""
    corpus = core.literature_corpus(spark, data)
    assert "parquet" not in corpus._jdf.queryExecution().toString()
    texts = spark.read.parquet(f"{data}/documents.parquet").select("item_key", "text")
    kinds = corpus.select("item_key", "kind")
    apart = attached(texts, "item_key", kinds, 0)
    assert "Exchange" not in apart._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.item_key for r in apart.collect()) == sorted(r.item_key for r in texts.join(kinds, "item_key").collect())


def test_attached_is_a_join(spark, monkeypatch):
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z"), ("c", "w"), ("a", "v")], "k string, text string")
    facts = spark.createDataFrame([("a", 1), ("a", 2), ("c", None), (None, 4), ("d", 5)], "k string, n int")
    for most in (tables.MAX_ATTACHED, 2):
        monkeypatch.setattr(tables, "MAX_ATTACHED", most)
        for left, how in ((False, "inner"), (True, "left")):
            got, want = attached(rows, "k", facts, 0, left), rows.join(facts, "k", how)
            assert sorted(map(str, got.select("k", "text", "n").collect())) == sorted(map(str, want.collect()))


def test_landed_sources(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("a/b.pdf\t12\t2024-01-02 03:04:05\nbad line\nc\td\te\tf\n")
    assert [tuple(r) for r in landed.read_listing(spark, str(tmp_path / "l.tsv")).collect()] == [("a/b.pdf", 12, 1704164645000)]
    (tmp_path / "log.jsonl").write_text('{"path": "a", "status": "ok"}\nnot json\n{"path": "b", "status": "fail"}\n')
    assert {r.path for r in landed.read_log(spark, str(tmp_path / "log.jsonl")).filter("path is not null").collect()} == {"a", "b"}
    notes = tmp_path / "notes"
    notes.mkdir()
    (notes / "one.md").write_text('---\ndescription: "solar"\n---\nBody')
    (notes / "INDEX.md").write_text("x")
    (notes / "password-list.md").write_text("x")
    assert [(r.name, r.description) for r in landed.read_notes(spark, str(notes)).collect()] == [("one", "solar")]
    arch = tmp_path / "arch"
    arch.mkdir()
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("in/a.txt", "hello")
        z.writestr("inner.zip", b"zz")
    (arch / "p.zip").write_bytes(buf.getvalue())
    (arch / "bad.tar").write_bytes(b"nothing")
    got = {(r.path.rsplit("/arch/", 1)[1], r.status) for r in landed.read_archives(spark, str(arch)).collect()}
    assert got == {("p.zip!in/a.txt", "ok"), ("p.zip!inner.zip", "nested"), ("bad.tar", "unreadable")}
    (tmp_path / "items.json").write_text('{"data": {"key": "K1", "tags": [{"tag": "topic:x"}]}}\n')
    assert [r.tags for r in landed.read_items(spark, str(tmp_path / "items.json")).collect()] == [["topic:x"]]
    items = spark.createDataFrame([("a", "t", 1), ("b", "u", 2)], "k string, title string, year int")
    found = spark.createDataFrame([("a", "better", None)], "k string, title string, year int")
    assert {(r.k, r.title, r.enriched) for r in landed.enriched(items, found, found.limit(0), "k").collect()} == {("a", "better", True), ("b", "u", False)}
