import pytest
from pyspark.sql import functions as F

from docstrata import config
from docstrata.functions import exprs as X
from docstrata.sources.landed import listing_time


def value(spark, column, **cols):
    fields = [F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in cols.items()]
    return spark.range(1).select(*fields).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "path, topic, top",
    [("loose.pdf", "(root)", ""), ("pdf/Steel/x.pdf", "Steel", "pdf"), ("pdf/x.pdf", "pdf", "pdf"), ("Hydrogen/x.pdf", "Hydrogen", "Hydrogen"), ("zip/a.zip!in/b.pdf", "a.zip!in", "zip"), (None, "(root)", "")],
)
def test_topic(spark, path, topic, top):
    assert value(spark, X.path_topic(F.col("p")), p=path) == topic
    assert value(spark, X.top_folder(F.col("p")), p=path) == top


@pytest.mark.parametrize("folder, category", [("Income Tax 2023", "personal"), ("laptop_backup", "backup"), ("Downloads", "uncategorized"), ("", "uncategorized"), (None, "uncategorized"), ("Climate", "research")])
def test_category(spark, folder, category):
    assert value(spark, X.folder_category(F.col("f"), ["Income Tax"]), f=folder) == category


def test_tags(spark):
    tags = value(spark, X.derived_tags(F.col("p"), F.lit(1577836800000), F.lit("dropbox")), p="pdf/Steel/x.PDF")
    assert tags == ["category:research", "topic:Steel", "source:dropbox", "filetype:pdf", "year:2020"]
    assert value(spark, X.derived_tags(F.col("p"), F.lit(0), F.lit("d")), p="x")[-1] == "filetype:unknown"


def test_tag_merge(spark):
    old = F.array(F.lit("topic:a"), F.lit("mine:1"))
    new = F.array(F.lit("topic:b"))
    assert value(spark, X.merge_tags(old, new), x="") == ["mine:1", "topic:b"]
    assert value(spark, X.tags_need_update(old, new), x="") is True
    assert value(spark, X.tag_value(old, "mine:"), x="") == "1"


@pytest.mark.parametrize("title, safe", [("a/b:c?.docx", "a_b_c_"), (None, "untitled"), ("", "untitled"), ("x" * 90, "x" * 80), ("résumé.pdf", "résumé")])
def test_safe_title(spark, title, safe):
    assert value(spark, X.safe_title(F.col("t")), t=title) == safe


@pytest.mark.parametrize("path, ext", [("folder/noext", ".bin"), ("a/b.PDF", ".PDF"), ("a/b.c-d", ".cd"), (None, ".bin")])
def test_extension(spark, path, ext):
    assert value(spark, X.safe_extension(F.col("p")), p=path) == ext


@pytest.mark.parametrize("title, category", [("Machine-Learning notes", "IT / Software / Computer Science"), ("my_sql dump", "Other / Unclassified"), ("Supreme_Court digest", "Law / Legal"), (None, "Other / Unclassified")])
def test_title_category(spark, title, category):
    assert value(spark, X.title_category(F.col("t")), t=title) == category


def test_years(spark):
    assert value(spark, X.catalogue_year(F.col("y"), 2026), y=" 2019 ") == 2019
    assert value(spark, X.catalogue_year(F.col("y"), 2026), y="20xx") is None
    assert value(spark, X.catalogue_year(F.col("y"), 2026), y="99999999999999") is None
    assert value(spark, X.latest_year_named(F.col("t"), 2026), t="1999, 2021 and 2029") == 2021


def test_urls_keys_names(spark):
    assert value(spark, X.url_path(F.col("u")), u="dropbox://a/b://c") == "a/b://c"
    assert value(spark, X.url_source(F.col("u")), u="none") is None
    assert value(spark, X.item_key_for(F.lit("s"), F.lit("p")), x="").startswith("XL_")
    parts = X.parsed_name(F.lit("(Series) Jane Roe and Li Wu, et al - A_Title (2019) - Press.pdf"))
    assert [value(spark, parts[k], x="") for k in ("authors", "title", "year")] == ["Jane Roe; Li Wu", "A Title", 2019]
    assert value(spark, listing_time(F.lit("2024-01-02 03:04:05.678")), x="") == 1704164645000
    assert value(spark, listing_time(F.lit("bad")), x="") is None


def test_sensitive_and_money(spark):
    yes = lambda t, x: value(spark, X.sensitive(F.lit(t), F.lit(x), F.lit("literature"), ["Jane Roe"]), x="")
    assert yes("Bank statement", "") and yes("x", "date of BIRTH: 1") and yes("RÉSUMÉ", "") and yes("x", "by jane roe")
    assert not yes("Agenda", "nothing") and not yes("x", "vandal")
    assert value(spark, X.money_text(F.lit(1.5e12), F.lit("USD")), x="") == "USD 1.5tn"
    assert value(spark, X.money_text(F.lit(950.0), F.lit("USD")), x="") == "USD 950"


@pytest.mark.parametrize(
    "title, text, sensitive",
    [
        ("A bank account statement, March", "", True), ("notes", "number ABCDE1234F is linked", True), ("notes", "card 1234 5678 9012 ending", True), ("Offer Letter", "", True),
        ("Quarterly_Statement_2024", "", True), ("my NDA draft", "", True), ("doc", "see the contract note below", True), ("doc", "a" * 5000 + " bank statement", True),
        ("Market outlook", "valued at USD 20 billion", False), ("Agenda for the meeting", "an agenda of topics", False), ("Calendar", "", False), (None, None, False),
        ("Résumé général", "", True), ("x", "écv éresume", False), ("x", "ORDER ID 7", True),
    ],
)
def test_sensitive_vectors(spark, title, text, sensitive):
    assert value(spark, X.sensitive(F.col("t"), F.col("x"), F.lit("literature")), t=title, x=text) is sensitive


def test_years_beside_letters(spark):
    assert value(spark, X.latest_year_named(F.col("t"), 2026), t="é2021 2019,2020 2022_") == 2020


def test_author_names(spark):
    names = value(spark, F.to_json(X.author_names(F.array(F.lit("Jane van Roe"), F.lit(" Wu "), F.lit("")))), x="")
    assert names == '[{"first":"Jane van","last":"Roe"},{"first":"","last":"Wu"}]'
    assert value(spark, X.suffix(F.col("p")), p="a/..pdf") == "pdf" and value(spark, X.extension(F.col("p")), p="a/.pdf") == "unknown"


def test_config(tmp_path, monkeypatch):
    f = tmp_path / "c.toml"
    f.write_text('privacy_names = ["Jane Roe ", ""]\nown_paths = ["mine"]\n')
    monkeypatch.setenv("DOCSTRATA_OWN_PATHS", "")
    got = config.configured(f)
    assert got.privacy_names == ("Jane Roe",) and got.own_paths == () and got.own_markers == config.Config().own_markers
    monkeypatch.setenv("DOCSTRATA_PERSONAL_KEYWORDS", " income tax, ,passport")
    assert config.configured().personal_keywords == ("income tax", "passport")
    f.write_text('Tea = ["green tea", " "]\nOther = ["x"]\n')
    assert config.title_categories(f) == [("Tea", ["green tea"]), ("Other", ["x"])]


def test_reply(spark):
    parts = X.reply_fields(F.lit('Sure {"category": "research", "topic": "x"} ok'), ["research"])
    assert [value(spark, parts[k], x="") for k in ("category", "topic")] == ["research", "x"]
    bad = X.reply_fields(F.lit("no json"), ["research"])
    assert [value(spark, bad[k], x="") for k in ("category", "topic")] == ["uncategorized", "unclear"]
