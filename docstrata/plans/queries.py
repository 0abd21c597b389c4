"""The core queries: name -> (spark, data directory) -> DataFrame, each with the SQL that must agree.

Every query runs over whole tables.  Queries without SQL (fold over a budget, claims in running text, topic
clusters, units) are tested against brute force instead.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docstrata import config
from docstrata.functions import exprs as X
from docstrata.operators import claims as claim_ops
from docstrata.operators import pending as pend
from docstrata.operators import similarity, state, topics, units
from docstrata.operators import text as text_ops
from docstrata.sources import landed
from docstrata.sources.tables import attached, cut, table

MAX_KEYS = 500_000  # of a broadcast
CFG = config.configured(Path(os.environ["DOCSTRATA_CONFIG"]) if "DOCSTRATA_CONFIG" in os.environ else None)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
HASH = f"sha1(trim(regexp_replace(lower(coalesce(text, '')), '{WS}', ' ', 'g')))"
BACKUP = X.quoted(config.BACKUP_KEYWORDS)
SQL_LIST = lambda xs: ", ".join("'" + x.replace("'", "''") + "'" for x in xs)
TOP = "case when not contains(coalesce(path, ''), '/') then '' else split_part(path, '/', 1) end"
TOPIC = (
    "case when not contains(coalesce(path, ''), '/') then '(root)' "
    f"when lower(split_part(path, '/', 1)) in ({SQL_LIST(config.GENERIC_BUCKETS)}) and len(string_split(path, '/')) > 2 then split_part(path, '/', 2) else split_part(path, '/', 1) end"
)
CATEGORY = (
    f"case when ({TOP}) = '' then 'uncategorized' when regexp_matches(lower({TOP}), '{BACKUP}') then 'backup' "
    f"when lower({TOP}) in ({SQL_LIST(config.UNCATEGORIZED_FOLDERS)}) then 'uncategorized' else 'research' end"
)
FILE = "list_extract(string_split(list_extract(string_split(coalesce(path, ''), '!'), -1), '/'), -1)"
EXT = rf"case when lower(regexp_extract({FILE}, '[^.].*\.([^.]*)$', 1)) = '' then 'unknown' else lower(regexp_extract({FILE}, '[^.].*\.([^.]*)$', 1)) end"
MYEAR = "year(make_timestamp(case when mtime <> 0 then mtime end * 1000))"
TITLE_CASE = " ".join(
    "when regexp_matches(lower(coalesce(title, '')), '(?:^|[^\\p{L}\\p{N}_])(?:" + "|".join(x.replace(" ", "[\\s_-]+") for x in ps) + ")(?:$|[^\\p{L}\\p{N}_])') then '" + n.replace("'", "''") + "'"
    for n, ps in config.TITLE_CATEGORIES
)
TITLE_SQL = f"case {TITLE_CASE} else '{config.UNCLASSIFIED}' end"
LATEST = """(select item_key, r.* from (select item_key, arg_max(struct_pack(md5 := md5, title := title, source := source, catalog_path := catalog_path, status := status,
  chars := chars, source_mb := source_mb, converted_at := converted_at, error := error, cloud_status := cloud_status),
  struct_pack(a := coalesce(converted_at, timestamp '1970-01-01'), b := coalesce(status, ''), c := coalesce(chars, -1))) r from fulltext_md where item_key is not null group by 1))"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# --- overview and duplicates ---------------------------------------------------------------------------


@query(f"""with h as (select {HASH} h from documents), g as (select count(*) docs, count(distinct h) u from h),
c as (select count(distinct claim_id) n, count(distinct case when kind = 'market_size' then claim_id end) m from claims)
select docs, u as unique_texts, docs - u as copies, round(100.0 * (docs - u) / docs, 6) as copies_pct, n as n_claims, m as n_market_size from g, c""")
def corpus_overview(spark, d):
    docs = table(spark, d, "documents").select(X.text_key(F.col("text")).alias("h"))
    # two levels: copies are combined before texts are counted
    g = docs.groupBy("h").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("docs"), F.count(F.lit(1)).alias("unique_texts"))
    c = table(spark, d, "claims").agg(F.count_distinct("claim_id").alias("n_claims"), F.count_distinct(F.when(F.col("kind") == "market_size", F.col("claim_id"))).alias("n_market_size"))
    g = g.withColumns({"copies": F.col("docs") - F.col("unique_texts"), "copies_pct": F.round(100.0 * (F.col("docs") - F.col("unique_texts")) / F.greatest("docs", F.lit(1)), 6)})
    return g.join(F.broadcast(c)).select("docs", "unique_texts", "copies", "copies_pct", "n_claims", "n_market_size")


@query(f"select {HASH} as text_hash, count(*) as n_docs, min(item_key) as first_key from documents group by 1 having count(*) > 1")
def text_copies(spark, d):
    t = table(spark, d, "documents").select("item_key", X.text_key(F.col("text")).alias("text_hash"))
    return t.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n_docs"), F.min("item_key").alias("first_key")).filter("n_docs > 1")


@query("select lower(trim(md5)) as md5, count(*) as n_docs, min(struct_pack(a := coalesce(date_added, ''), k := item_key)).k as canonical from documents where md5 is not null group by 1 having count(*) > 1")
def exact_dup_groups(spark, d):
    t = table(spark, d, "documents").filter("md5 is not null").select(F.lower(F.trim("md5")).alias("md5"), F.struct(F.coalesce("date_added", F.lit("")).alias("a"), F.col("item_key").alias("k")).alias("o"))
    return t.groupBy("md5").agg(F.count(F.lit(1)).alias("n_docs"), F.min("o")["k"].alias("canonical")).filter("n_docs > 1")


@query("""with g as (select lower(trim(md5)) m, count(*) n, min(struct_pack(a := coalesce(date_added, ''), k := item_key)).k c from documents where md5 is not null group by 1 having count(*) > 1)
select item_key, case when item_key = c then 'has-duplicates:' || (n - 1) else 'status:duplicate,duplicate-of:' || c end as tags from documents join g on lower(trim(md5)) = m""")
def duplicate_tags(spark, d):
    groups = exact_dup_groups(spark, d)
    t = table(spark, d, "documents").filter("md5 is not null").select("item_key", F.lower(F.trim("md5")).alias("md5")).join(groups, "md5")
    tags = F.when(F.col("item_key") == F.col("canonical"), F.concat(F.lit("has-duplicates:"), (F.col("n_docs") - 1).cast("string"))).otherwise(F.concat(F.lit("status:duplicate,duplicate-of:"), "canonical"))
    return t.select("item_key", tags.alias("tags"))


def _converted(spark, d):
    ok = pend.last_attempts(table(spark, d, "fulltext_md")).filter("status = 'ok'").select("item_key", "chars")
    docs = table(spark, d, "documents").filter("coalesce(category, '') <> 'personal'").select("item_key", "category", "path", "text", "title")
    return attached(docs, "item_key", cut(ok), MAX_KEYS).select("item_key", "category", "path", "title", "text", "chars", X.text_key(F.col("text")).alias("text_hash"), X.own_kind(F.col("category"), F.col("path"), CFG.own_paths).alias("own_kind"))


KIND = f"case when coalesce(category, '') = 'backup' or regexp_matches(coalesce(path, ''), '(?i){X.quoted(CFG.own_paths)}') then 'own' else 'literature' end"
CONVERTED = f"(select item_key, d.category, d.path, d.title, d.text, f.chars, {HASH} text_hash, {KIND} own_kind from {LATEST} f join documents d using (item_key) where f.status = 'ok' and coalesce(d.category, '') <> 'personal')".replace("coalesce(path", "coalesce(d.path")


@query(f"""with c as {CONVERTED}, g as (select text_hash, arg_min(struct_pack(k := item_key, kind := own_kind), struct_pack(a := own_kind = 'own', b := coalesce(category, '') = 'backup', c := -coalesce(chars, 0), k := item_key)) w from c group by 1)
select item_key, text_hash, w.kind as kind, item_key = w.k as is_canonical from c join g using (text_hash)""")
def canonical_docs(spark, d):
    c = _converted(spark, d).select("item_key", "category", "chars", "text_hash", "own_kind")
    order = F.struct((F.col("own_kind") == "own").alias("a"), (F.coalesce("category", F.lit("")) == "backup").alias("b"), (-F.coalesce("chars", F.lit(0))).alias("c"), F.col("item_key").alias("k"))
    best = c.groupBy("text_hash").agg(F.min_by(F.struct(F.col("item_key").alias("k"), F.col("own_kind").alias("kind")), order).alias("w"))
    return c.join(best, "text_hash").select("item_key", "text_hash", F.col("w.kind").alias("kind"), (F.col("item_key") == F.col("w.k")).alias("is_canonical"))


# --- catalogue columns ----------------------------------------------------------------------------------


@query("""with u as (select item_key, converted_at, source || '://' || catalog_path url from fulltext_md)
select distinct item_key, case when contains(url, '://') then split_part(url, '://', 1) end as source, case when contains(url, '://') then substr(url, instr(url, '://') + 3) end as path from u""")
def source_path_split(spark, d):
    u = table(spark, d, "fulltext_md").select("item_key", F.concat("source", F.lit("://"), "catalog_path").alias("url"))
    return u.select("item_key", X.url_source(F.col("url")).alias("source"), X.url_path(F.col("url")).alias("path")).distinct()


@query(f"select item_key, {TOP} as top_folder, {TOPIC} as topic, {CATEGORY} as category from documents")
def folder_topics(spark, d):
    p = F.col("path")
    return table(spark, d, "documents").select("item_key", X.top_folder(p).alias("top_folder"), X.path_topic(p).alias("topic"), X.folder_category(X.top_folder(p)).alias("category"))


TAGS = f"array_to_string(list_filter(['category:' || ({CATEGORY}), 'topic:' || ({TOPIC}), 'source:' || coalesce(source, ''), 'filetype:' || ({EXT}), 'year:' || {MYEAR}], lambda x: x is not null), '|')"


@query(f"select item_key, {TAGS} as tags from documents")
def derived_tags(spark, d):
    tags = X.derived_tags(F.col("path"), F.col("mtime"), F.col("source"))
    return table(spark, d, "documents").select("item_key", F.array_join(tags, "|").alias("tags"))


OLD_TAGS = "list_filter(['category:' || category, 'topic:' || topic, 'source:' || source, 'filetype:' || filetype, 'note:' || lang], lambda x: x is not null)"


def _old_tags():
    return F.array_compact(F.array(*[F.concat(F.lit(p), F.col(c)) for p, c in (("category:", "category"), ("topic:", "topic"), ("source:", "source"), ("filetype:", "filetype"), ("note:", "lang"))]))


@query(f"""with t as (select item_key, {OLD_TAGS} o, string_split({TAGS}, '|') n from documents)
select item_key, list_sort(list_distinct(list_filter(o, lambda x: not starts_with(x, 'note:')))) <> list_sort(list_distinct(n)) as needs_update,
array_to_string(list_concat(list_filter(o, lambda x: starts_with(x, 'note:')), n), '|') as merged from t""")
def tags_to_update(spark, d):
    old, new = _old_tags(), X.derived_tags(F.col("path"), F.col("mtime"), F.col("source"))
    return table(spark, d, "documents").select("item_key", X.tags_need_update(old, new).alias("needs_update"), F.array_join(X.merge_tags(old, new), "|").alias("merged"))


@query(f"select item_key, {TITLE_SQL} as auto_topic from documents")
def auto_topic(spark, d):
    return table(spark, d, "documents").select("item_key", X.title_category(F.col("title")).alias("auto_topic"))


@query(f"select {TITLE_SQL} as auto_topic, count(*) as n_docs, round(100.0 * count(*) / (select count(*) from documents), 6) as pct from documents group by 1")
def auto_topic_distribution(spark, d):
    g = auto_topic(spark, d).groupBy("auto_topic").agg(F.count(F.lit(1)).alias("n_docs"))
    return g.join(F.broadcast(g.agg(F.sum("n_docs").alias("all")))).select("auto_topic", "n_docs", F.round(100.0 * F.col("n_docs") / F.col("all"), 6).alias("pct"))


@query("select item_key, 'XL_' || substr(md5(coalesce(source, '') || ':' || coalesce(path, '')), 1, 12) as stable_key from documents")
def stable_item_keys(spark, d):
    return table(spark, d, "documents").select("item_key", X.item_key_for(F.coalesce("source", F.lit("")), F.coalesce("path", F.lit(""))).alias("stable_key"))


SAFE_TITLE = rf"substr(regexp_replace(regexp_replace(case when coalesce(title, '') = '' then 'untitled' else title end, '(?i)\.(?:{'|'.join(X.TITLE_EXTENSIONS)})$', ''), '[^\p{{L}}\p{{N}} \-_.]', '_', 'g'), 1, 80)"
BASE = "list_extract(string_split(coalesce(path, ''), '/'), -1)"
SAFE_EXT = rf"substr(regexp_replace(regexp_extract({BASE}, '[^.].*\.([^.]+)$', 1), '[^\p{{L}}\p{{N}}]', '', 'g'), 1, 10)"


@query(f"select item_key, {SAFE_TITLE} as safe_title, case when {SAFE_EXT} = '' then '.bin' else '.' || {SAFE_EXT} end as ext, item_key || '_' || {SAFE_TITLE} || '.md' as md_path from documents")
def safe_names(spark, d):
    t = X.safe_title(F.col("title"))
    return table(spark, d, "documents").select("item_key", t.alias("safe_title"), X.safe_extension(F.col("path")).alias("ext"), F.concat("item_key", F.lit("_"), t, F.lit(".md")).alias("md_path"))


SAFE = lambda c: rf"""case when substr(trim(regexp_replace(coalesce({c}, ''), '[<>:"/\\|?*\x00-\x1f]', '_', 'g')), 1, 150) = '' then 'misc' else substr(trim(regexp_replace(coalesce({c}, ''), '[<>:"/\\|?*\x00-\x1f]', '_', 'g')), 1, 150) end"""


@query(f"""select item_key, 'Organized/' || ({SAFE('category')}) || '/' || ({SAFE("coalesce(topic, 'misc')")}) || '/' || item_key || '_' || ({SAFE(FILE)}) as dest from documents
where lower(regexp_replace(trim(source), '[^A-Za-z0-9]+', '_', 'g')) in ('dropbox', 'googledrive') and category is not null and not coalesce(is_duplicate, false) and not contains(coalesce(path, ''), '!')""")
def copy_manifest(spark, d):
    t = table(spark, d, "documents").filter("category is not null and not coalesce(is_duplicate, false) and not contains(coalesce(path, ''), '!')")
    t = t.filter(F.lower(F.regexp_replace(F.trim("source"), "[^A-Za-z0-9]+", "_")).isin("dropbox", "googledrive"))
    return t.select("item_key", X.destination(F.col("category"), F.col("topic"), F.col("item_key"), F.coalesce("path", F.lit(""))).alias("dest"))


STEM = rf"regexp_replace({BASE}, '\.[^.\s]+$', '')"
SHAPE = X.NAME_SHAPE


@query(rf"""with s as (select item_key, coalesce(title, '') as stem0 from documents), t as (select item_key, regexp_replace(stem0, '\.[^.\s]+$', '') stem, regexp_matches(regexp_replace(stem0, '\.[^.\s]+$', ''), '{SHAPE}') hit from s),
p as (select item_key, stem, hit, regexp_replace(replace(regexp_extract(stem, '{SHAPE}', 2), '_', ' '), '^[ \-_]+|[ \-_]+$', '', 'g') tt, regexp_extract(stem, '{SHAPE}', 3) yy,
array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_extract(stem, '{SHAPE}', 1), ',| and |;'), lambda x: trim(x)), lambda x: x <> '' and lower(x) not in ('et al', 'et al.')), '; ') aa from t)
select item_key, case when hit then aa else '' end as authors, case when hit and tt <> '' then tt else stem end as title, case when hit and yy <> '' then cast(yy as int) end as year from p""")
def filename_parse(spark, d):
    parts = X.parsed_name(F.coalesce("title", F.lit("")))
    return table(spark, d, "documents").select("item_key", *[c.alias(n) for n, c in parts.items()])


@query(rf"select item_key, case when regexp_matches(trim(year), '^[0-9]+$') and try_cast(trim(year) as int) between 1950 and 2026 then try_cast(trim(year) as int) end as year from documents")
def year_normalise(spark, d):
    return table(spark, d, "documents").select("item_key", X.catalogue_year(F.col("year"), CFG.as_of.year).alias("year"))


# every mark is doubled, so that one between two years serves both
DOUBLED = r"regexp_replace(' ' || coalesce(text, '') || ' ', '([^\p{L}\p{M}\p{N}_])', '\1\1', 'g')"


@query(rf"""select item_key, list_max(list_filter(list_transform(regexp_extract_all({DOUBLED}, '[^\p{{L}}\p{{M}}\p{{N}}_](19[5-9][0-9]|20[0-2][0-9])[^\p{{L}}\p{{M}}\p{{N}}_]', 1), lambda y: cast(y as int)), lambda y: y <= 2026)) as guessed_year from documents""")
def guess_year(spark, d):
    return table(spark, d, "documents").select("item_key", X.latest_year_named(F.col("text"), CFG.as_of.year).alias("guessed_year"))


@query("select content_type, count(*) as n_docs from (select case " + " ".join(f"when e = '{e}' then '{m}'" for e, m in {"pdf": "application/pdf", "epub": "application/epub+zip", "html": "text/html", "doc": "application/msword", "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation"}.items()) + f" else 'application/octet-stream' end content_type from (select {EXT} e from documents)) group by 1")
def content_types(spark, d):
    kinds = {"pdf": "application/pdf", "epub": "application/epub+zip", "html": "text/html", "doc": "application/msword", "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation"}
    m = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    t = table(spark, d, "documents").select(F.coalesce(F.try_element_at(m, X.extension(F.col("path"))), F.lit("application/octet-stream")).alias("content_type"))
    return t.groupBy("content_type").agg(F.count(F.lit(1)).alias("n_docs"))


# --- conversion state -----------------------------------------------------------------------------------


@query("select d.item_key, d.source, d.path from documents d where not coalesce(is_duplicate, false) and not exists (select 1 from fulltext_md f where f.item_key = d.item_key)")
def pending_documents(spark, d):
    return pend.pending(table(spark, d, "documents"), table(spark, d, "fulltext_md")).select("item_key", "source", "path")


@query("with p as (select d.* from documents d where not coalesce(is_duplicate, false) and not exists (select 1 from fulltext_md f where f.item_key = d.item_key)) select coalesce(source, '') as source, count(*) as n_pending, count(case when filetype in ('doc', 'pptx') then 1 end) as n_office from p group by 1")
def pending_by_source(spark, d):
    p = pend.pending(table(spark, d, "documents"), table(spark, d, "fulltext_md"))
    return p.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count(F.lit(1)).alias("n_pending"), F.count_if(F.col("filetype").isin("doc", "pptx")).alias("n_office"))


@query(f"select item_key, status, chars, source_mb, cloud_status from {LATEST}")
def latest_attempts(spark, d):
    return pend.last_attempts(table(spark, d, "fulltext_md")).select("item_key", "status", "chars", "source_mb", "cloud_status")


CASCADE = """case when contains(coalesce(d.path, ''), '!') then 'archive_not_persisted' when lower(regexp_replace(trim(d.source), '[^A-Za-z0-9]+', '_', 'g')) not in ('dropbox', 'googledrive', 'dropbox_team', 'gdrive_shared', 'onedrive') or d.source is null then 'unsupported_source'
when f.item_key is null then 'pending' when f.status = 'fetch_failed' then 'fetch_failed' when f.source_mb > 200 then 'too_large' when f.error is not null then 'convert_failed' when length(trim(coalesce(d.text, ''))) = 0 then 'empty_extraction' else 'ok' end"""


@query(f"select d.item_key, {CASCADE} as status from documents d left join {LATEST} f on d.item_key = f.item_key")
def conversion_status(spark, d):
    f = pend.last_attempts(table(spark, d, "fulltext_md")).select("item_key", F.col("status").alias("f_status"), "source_mb", "error", F.lit(True).alias("tried"))
    t = table(spark, d, "documents").select("item_key", "path", "source", F.length(F.trim(F.coalesce("text", F.lit("")))).alias("n")).join(f, "item_key", "left")
    src = F.lower(F.regexp_replace(F.trim("source"), "[^A-Za-z0-9]+", "_"))
    out = (
        F.when(F.coalesce("path", F.lit("")).contains("!"), "archive_not_persisted")
        .when(~src.isin("dropbox", "googledrive", "dropbox_team", "gdrive_shared", "onedrive") | F.col("source").isNull(), "unsupported_source")
        .when(F.col("tried").isNull(), "pending").when(F.col("f_status") == "fetch_failed", "fetch_failed").when(F.col("source_mb") > 200, "too_large")
        .when(F.col("error").isNotNull(), "convert_failed").when(F.col("n") == 0, "empty_extraction").otherwise("ok")
    )
    return t.select("item_key", out.alias("status"))


@query(f"select coalesce(status, '') as status, coalesce(cloud_status, '') as cloud_status, count(*) as n_items, round(avg(chars), 6) as avg_chars, count(case when chars < 200 then 1 end) as near_empty from {LATEST} group by 1, 2")
def status_summary(spark, d):
    t = pend.last_attempts(table(spark, d, "fulltext_md"))
    return t.groupBy(F.coalesce("status", F.lit("")).alias("status"), F.coalesce("cloud_status", F.lit("")).alias("cloud_status")).agg(
        F.count(F.lit(1)).alias("n_items"), F.round(F.avg("chars"), 6).alias("avg_chars"), F.count_if(F.col("chars") < 200).alias("near_empty")
    )


@query("with a as (select count(*) n from documents where not coalesce(is_duplicate, false)), b as (select count(distinct item_key) n from fulltext_md) select a.n as total, b.n as processed, a.n - b.n as remaining from a, b")
def remaining_work(spark, d):
    a = table(spark, d, "documents").filter("not coalesce(is_duplicate, false)").agg(F.count(F.lit(1)).alias("total"))
    b = table(spark, d, "fulltext_md").agg(F.count_distinct("item_key").alias("processed"))
    return a.join(F.broadcast(b)).select("total", "processed", (F.col("total") - F.col("processed")).alias("remaining"))


@query(f"""with recursive t as (select row_number() over (order by coalesce(source, ''), item_key) rn, coalesce(source, '') source, item_key, coalesce(source_mb, 0) size_mb from {LATEST}), h as (select sum(size_mb) / 2 half from t),
f as (select rn, size_mb used, true ok from t where rn = 1 union all
select t.rn, case when round(f.used + t.size_mb, 6) <= half then round(f.used + t.size_mb, 6) else f.used end, round(f.used + t.size_mb, 6) <= half from f join t on t.rn = f.rn + 1, h)
select source, item_key, size_mb from t join f using (rn) where ok""")
def budget_admission(spark, d):
    """The files one run may read: half of all megabytes, in order of source and key."""
    t = pend.last_attempts(table(spark, d, "fulltext_md")).select(F.coalesce("source", F.lit("")).alias("source"), "item_key", F.coalesce("source_mb", F.lit(0.0)).alias("size_mb"))
    half = (t.agg(F.sum("size_mb").alias("s")).first()["s"] or 0.0) / 2
    return pend.admit(t, half, ["source", "item_key"])


@query(f"select item_key, source, chars from {LATEST} where status = 'ok' and coalesce(cloud_status, 'failed') = 'failed'")
def heal_candidates(spark, d):
    return pend.last_attempts(table(spark, d, "fulltext_md")).filter("status = 'ok' and coalesce(cloud_status, 'failed') = 'failed'").select("item_key", "source", "chars")


@query(f"""with l as {LATEST}, s as (select coalesce(source, '') source, count(case when cloud_status = 'failed' then 1 end) = 0 ok from l group by 1)
select item_key, case when status = 'ok' and cloud_status is null then case when ok then 'ok' else 'failed' end else cloud_status end as cloud_status from l join s on coalesce(l.source, '') = s.source""")
def upload_outcomes(spark, d):
    t = pend.last_attempts(table(spark, d, "fulltext_md")).withColumn("src", F.coalesce("source", F.lit("")))
    s = t.groupBy("src").agg((F.count_if(F.col("cloud_status") == "failed") == 0).alias("ok"))
    out = F.when((F.col("status") == "ok") & F.col("cloud_status").isNull(), F.when(F.col("ok"), "ok").otherwise("failed")).otherwise(F.col("cloud_status"))
    return t.join(s, "src").select("item_key", out.alias("cloud_status"))


@query("""select 'p' || user_id as path, case when bool_or(event_type = 'purchase' and value > 50) then 'ok' else arg_max(case when event_type = 'error' then 'fail' else 'other' end, event_id) end as status, count(*) as n_seen,
count(case when event_type = 'error' then 1 end) as n_fail from events group by 1""")
def log_fold(spark, d):
    ok = (F.col("event_type") == "purchase") & (F.col("value") > 50)
    return table(spark, d, "events").groupBy(F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("path")).agg(
        F.when(F.bool_or(ok), "ok").otherwise(F.max_by(F.when(F.col("event_type") == "error", "fail").otherwise("other"), "event_id")).alias("status"),
        F.count(F.lit(1)).alias("n_seen"), F.count_if(F.col("event_type") == "error").alias("n_fail"),
    )


@query("select cast(ts as date) as day, max(event_id) as last_event, arg_max(event_type, event_id) as last_type, count(*) as n_seen, count(case when event_type = 'purchase' then 1 end) as n_ok, count(case when event_type = 'error' then 1 end) as n_fail from events group by 1")
def run_counters(spark, d):
    return table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.max("event_id").alias("last_event"), F.max_by("event_type", "event_id").alias("last_type"), F.count(F.lit(1)).alias("n_seen"),
        F.count_if(F.col("event_type") == "purchase").alias("n_ok"), F.count_if(F.col("event_type") == "error").alias("n_fail"),
    )


# --- table changes ---------------------------------------------------------------------------------------


@query(f"with n as (select item_key, status from {LATEST}) select item_key, coalesce(n.status, 'known') as status, n.item_key is not null as replaced from docs left join n using (item_key) union all select item_key, status, true from n where item_key not in (select item_key from docs)")
def upsert_latest(spark, d):
    new = pend.last_attempts(table(spark, d, "fulltext_md")).select("item_key", F.col("status"), F.lit(True).alias("replaced"))
    old = table(spark, d, "docs").select("item_key", F.lit("known").alias("status"), F.lit(False).alias("replaced"))
    out = state.upsert(old, new, ["item_key"])
    return out.select("item_key", F.when(F.col("replaced"), F.col("status")).otherwise("known").alias("status"), "replaced")


ORACLE["upsert_latest"] = f"with n as (select item_key, status from {LATEST}) select item_key, status, true as replaced from n union all select item_key, 'known', false from docs where item_key not in (select item_key from n)"


@query("select item_key, min(struct_pack(c := coalesce(converted_at, timestamp '1970-01-01'), s := coalesce(source, ''), p := coalesce(catalog_path, ''))).s as source from fulltext_md where item_key is not null and item_key not in (select item_key from docs) group by 1")
def insert_ignore(spark, d):
    new = table(spark, d, "fulltext_md").filter("item_key is not null").select("item_key", F.coalesce("converted_at", F.lit("1970-01-01").cast("timestamp_ntz")).alias("c"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("catalog_path", F.lit("")).alias("p"))
    return state.insert_absent(table(spark, d, "docs"), new, ["item_key"], [F.col("c"), F.col("source"), F.col("p")]).select("item_key", "source")


@query("with a as (select item_key, min(auto_topic) t from auto_topics where auto_topic is not null group by 1) select d.item_key, coalesce(a.t, d.topic) as topic from documents d left join a using (item_key)")
def update_from_join(spark, d):
    a = table(spark, d, "auto_topics").filter("auto_topic is not null").groupBy("item_key").agg(F.min("auto_topic").alias("topic"))
    return state.update_from(table(spark, d, "documents").select("item_key", "topic"), a, "item_key", "topic")


@query(f"select l.item_key, coalesce(d.first_seen, date '2026-08-01') as first_seen from {LATEST} l left join docs d using (item_key) where l.status = 'ok'")
def first_seen_carryover(spark, d):
    ok = pend.last_attempts(table(spark, d, "fulltext_md")).filter("status = 'ok'").select("item_key")
    return ok.join(table(spark, d, "docs").select("item_key", "first_seen"), "item_key", "left").select("item_key", F.coalesce("first_seen", F.lit(CFG.as_of)).alias("first_seen"))


@query("select p.item_key, p.v as base_version, c.v as current_version, case when c.v is null then 'missing' when c.v = p.v then 'ok' else 'skipped' end as outcome from (select item_key, n_chars v from documents) p left join (select item_key, max(chars) v from docs group by 1) c using (item_key)")
def patch_outcomes(spark, d):
    cur = table(spark, d, "docs").groupBy("item_key").agg(F.max("chars").alias("version"))
    out = state.patch_versions(cur, table(spark, d, "documents").select("item_key", F.col("n_chars").alias("version")), "item_key")
    return out.select("item_key", F.col("version").alias("base_version"), "current_version", "outcome")


@query(f"select path, count(*) as n_docs from documents where path not in (select catalog_path from fulltext_md where catalog_path is not null) group by 1")
def new_paths(spark, d):
    seen = table(spark, d, "fulltext_md").filter("catalog_path is not null").select(F.col("catalog_path").alias("path")).distinct()
    return table(spark, d, "documents").filter("path is not null").join(seen, "path", "left_anti").groupBy("path").agg(F.count(F.lit(1)).alias("n_docs"))


@query(f"with t as (select distinct {TOP} f from documents), s as (select distinct case when not contains(coalesce(catalog_path, ''), '/') then '' else split_part(catalog_path, '/', 1) end f from fulltext_md where status = 'ok') select f as folder from t where f <> '' and f not in (select f from s)")
def new_folders(spark, d):
    t = table(spark, d, "documents").select(X.top_folder(F.col("path")).alias("folder")).filter("folder <> ''").distinct()
    s = table(spark, d, "fulltext_md").filter("status = 'ok'").select(X.top_folder(F.col("catalog_path")).alias("folder")).distinct()
    return t.join(s, "folder", "left_anti")


@query("select split_part(path, '!', 1) as archive, count(*) as n_members, count(distinct filetype) as n_types from documents where contains(path, '!') group by 1")
def archive_members(spark, d):
    return table(spark, d, "documents").filter("contains(path, '!')").groupBy(F.split("path", "!", 2)[0].alias("archive")).agg(F.count(F.lit(1)).alias("n_members"), F.count_distinct("filetype").alias("n_types"))


# --- privacy, claims -------------------------------------------------------------------------------------

SENSITIVE = f"(regexp_matches(coalesce(title, '') || ' ' || coalesce(text, ''), '(?i){X.SENSITIVE_TEXT}') or regexp_matches(coalesce(title, ''), '(?i){X.SENSITIVE_TITLE}'))"


@query(f"select item_key, {SENSITIVE} as sensitive from documents")
def privacy_filter(spark, d):
    return table(spark, d, "documents").select("item_key", X.sensitive(F.col("title"), F.col("text"), F.lit("literature"), CFG.privacy_names).alias("sensitive"))


OWN_TEXT = f"case when own_kind = 'own' or regexp_matches(coalesce(text, ''), '(?i){X.quoted(CFG.own_markers)}') then 'own' else 'literature' end"


@query(f"""with c as (select item_key, category, chars, text_hash, text, {OWN_TEXT} k from {CONVERTED} where not {SENSITIVE}),
g as (select text_hash, arg_min(struct_pack(i := item_key, kind := k), struct_pack(a := k = 'own', b := coalesce(category, '') = 'backup', c := -coalesce(chars, 0), k := item_key)) w from c group by 1)
select item_key, w.kind as kind, item_key = w.i as is_canonical, length(trim(regexp_replace(coalesce(text, ''), '{WS}', ' ', 'g'))) >= 400 as substantive from c join g using (text_hash)""")
def literature_corpus(spark, d):
    """What insights are drawn from: kind by place and own marks in the text, then privacy, then one text per group of
    copies with the kind of its best copy, then texts of 400 characters or more."""
    c = _converted(spark, d).filter(~X.sensitive(F.col("title"), F.col("text"), F.lit(""), ()))
    kind = F.when((F.col("own_kind") == "own") | X.own_text(F.col("text"), CFG.own_markers), "own").otherwise("literature")
    size = F.length(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), X.SPACE, " ")))
    c = cut(c.select("item_key", "category", "chars", "text_hash", kind.alias("k"), (size >= 400).alias("substantive")))
    order = F.struct((F.col("k") == "own").alias("a"), (F.coalesce("category", F.lit("")) == "backup").alias("b"), (-F.coalesce("chars", F.lit(0))).alias("c"), F.col("item_key").alias("i"))
    best = c.groupBy("text_hash").agg(F.min_by(F.struct(F.col("item_key").alias("i"), F.col("k").alias("kind")), order).alias("w"))
    return c.join(best, "text_hash").select("item_key", F.col("w.kind").alias("kind"), (F.col("item_key") == F.col("w.i")).alias("is_canonical"), "substantive")


@query(f"select item_key, coalesce(category = 'research' and ({TOP}) not in ({SQL_LIST(CFG.private_folders)}), false) as shareable from documents")
def shareable_docs(spark, d):
    return table(spark, d, "documents").select("item_key", X.shareable(F.col("category"), X.top_folder(F.col("path")), CFG.private_folders).alias("shareable"))


@query()
def text_claims(spark, d):
    """Claims in the texts not yet scanned."""
    docs = table(spark, d, "docs").filter("is_canonical and kind = 'literature' and shareable").join(table(spark, d, "claims_done").filter("text_hash is not null").distinct(), "text_hash", "left_anti")
    texts = table(spark, d, "documents").join(docs.select("item_key", "text_hash"), "item_key")
    return claim_ops.extract_claims(texts, "item_key")


@query("""with m as (select subject, currency, year, text_hash, min(item_key) item_key, median(value) v from claims where kind = 'market_size' and year is not null and value >= 1e7 group by 1, 2, 3, 4),
g as (select subject, currency, year, count(*) n_docs, min(v) lo, max(v) hi, arg_min(item_key, struct_pack(v := v, k := item_key)) lo_key, arg_max(item_key, struct_pack(v := v, k := item_key)) hi_key from m where subject not in ('market', 'global', 'global market') group by 1, 2, 3)
select *, round(hi / lo, 6) as ratio from g where n_docs >= 2 and round(hi / lo, 6) between 2 and 15""")
def contradictions(spark, d):
    return claim_ops.contradictions(table(spark, d, "claims"))


@query("""select currency, year, count(*) as n_claims, case when max(value) >= 1e12 then 'tn' when max(value) >= 1e9 then 'bn' when max(value) >= 1e6 then 'mn' else '' end as scale from claims where kind = 'market_size' and currency is not null group by 1, 2""")
def money_scales(spark, d):
    g = table(spark, d, "claims").filter("kind = 'market_size' and currency is not null").groupBy("currency", "year").agg(F.count(F.lit(1)).alias("n_claims"), F.max("value").alias("v"))
    return g.select("currency", "year", "n_claims", F.coalesce(F.regexp_extract(X.money_text(F.col("v"), F.lit("")), "(tn|bn|mn)$", 1), F.lit("")).alias("scale"))


@query()
def p5_found(spark, d):
    out = units.convert_units(table(spark, d, "claims"), table(spark, d, "fx_rates"))
    return out.select("claim_id", "unit", "amount")


@query()
def p5_units(spark, d):
    return units.convert_units(table(spark, d, "claims"), table(spark, d, "fx_rates"))


# --- digest and reports over clusters --------------------------------------------------------------------


@query("""with n as (select * from docs where first_seen = (select max(first_seen) from docs) and is_canonical and kind = 'literature' and shareable),
c as (select item_key, claim_id, subject, value from (select distinct item_key, claim_id, subject, value from claims where kind = 'market_size') qualify row_number() over (partition by item_key order by claim_id) <= 2)
select n.item_key, n.title, n.category, n.year, l.label, k.claims from n left join clusters l using (cluster) left join (select item_key, string_agg(subject, '; ' order by claim_id) claims from c group by 1) k on n.item_key = k.item_key order by n.item_key limit 200""")
def new_docs_digest(spark, d):
    docs = table(spark, d, "docs")
    newest = docs.agg(F.max("first_seen").alias("first_seen"))
    n = docs.join(F.broadcast(newest), "first_seen").filter("is_canonical and kind = 'literature' and shareable").orderBy("item_key").limit(200)
    c = table(spark, d, "claims").filter("kind = 'market_size'").join(F.broadcast(n.select("item_key")), "item_key", "left_semi").select("item_key", "claim_id", "subject", "value").distinct()
    w = Window.partitionBy("item_key").orderBy("claim_id")
    c = c.withColumn("rn", F.row_number().over(w)).filter("rn <= 2").groupBy("item_key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("claim_id", "subject"))), lambda x: x["subject"]), "; ").alias("claims"))
    return n.join(table(spark, d, "clusters").select("cluster", "label"), "cluster", "left").join(c, "item_key", "left").select("item_key", "title", "category", "year", "label", "claims")


STATS = """(select cluster, count(case when kind <> 'own' then 1 end) n_docs, cast(floor(median(case when kind <> 'own' then year end)) as int) median_year, count(case when kind <> 'own' and year is not null then 1 end) with_year,
round(100.0 * count(case when kind <> 'own' and year >= 2023 then 1 end) / nullif(count(case when kind <> 'own' and year is not null then 1 end), 0), 3) pct_recent, count(case when kind = 'own' then 1 end) n_own from docs where cluster is not null group by 1)"""


def _stats(spark, d):
    lit = F.col("kind") != "own"
    year = F.when(lit, F.col("year"))
    return table(spark, d, "docs").filter("cluster is not null").groupBy("cluster").agg(
        F.count_if(lit).alias("n_docs"), F.floor(F.median(year)).cast("int").alias("median_year"), F.count(year).alias("with_year"),
        F.round(100.0 * F.count_if(year >= 2023) / F.nullif(F.count(year), F.lit(0)), 3).alias("pct_recent"), F.count_if(F.col("kind") == "own").alias("n_own"),
    )


@query(f"select * from {STATS}")
def cluster_stats(spark, d):
    return _stats(spark, d)


@query(f"select s.cluster, label, s.n_docs, s.median_year, s.pct_recent from {STATS} s left join clusters c on s.cluster = c.cluster order by s.n_docs desc, s.cluster limit 15")
def largest_clusters(spark, d):
    return _stats(spark, d).join(table(spark, d, "clusters").select("cluster", "label"), "cluster", "left").orderBy(F.desc("n_docs"), "cluster").limit(15).select("cluster", "label", "n_docs", "median_year", "pct_recent")


def _limits(sql: str) -> tuple[str, str]:
    """The SQL of a cluster report with the published limits, and with those of a small corpus."""
    return tuple(f"with s as {STATS} {sql}".format(**vars(x)) for x in (config.Limits(), config.SMALL_CORPUS))


GROWING = _limits("select cluster, n_docs, median_year, pct_recent from s where with_year >= {with_year} and pct_recent >= {pct_recent} and n_docs <= (select median(n_docs) from s) order by pct_recent desc, n_docs, cluster limit 12")
STALE = _limits("select cluster, n_docs, median_year, pct_recent from s where with_year >= {with_year} and median_year <= {stale_year} and n_docs >= (select median(n_docs) from s) order by median_year, n_docs desc, cluster limit 12")
WRITTEN = _limits("select cluster, n_docs, n_own from s where n_own >= {n_own} and n_own > {own_ratio} * n_docs order by n_own desc, cluster limit 10")
READ = _limits("select cluster, n_docs, n_own from s where n_docs >= {n_docs} and n_own <= n_docs / 20 order by n_docs desc, cluster limit 10")


@query(GROWING[0])
def growing_thin(spark, d, limits=config.Limits()):
    s = _stats(spark, d)
    m = s.agg(F.median("n_docs").alias("m"))
    return s.join(F.broadcast(m)).filter((F.col("with_year") >= limits.with_year) & (F.col("pct_recent") >= limits.pct_recent) & (F.col("n_docs") <= F.col("m"))).orderBy(F.desc("pct_recent"), "n_docs", "cluster").limit(12).select("cluster", "n_docs", "median_year", "pct_recent")


@query(STALE[0])
def stale_clusters(spark, d, limits=config.Limits()):
    s = _stats(spark, d)
    m = s.agg(F.median("n_docs").alias("m"))
    return s.join(F.broadcast(m)).filter((F.col("with_year") >= limits.with_year) & (F.col("median_year") <= limits.stale_year) & (F.col("n_docs") >= F.col("m"))).orderBy("median_year", F.desc("n_docs"), "cluster").limit(12).select("cluster", "n_docs", "median_year", "pct_recent")


@query(WRITTEN[0])
def write_not_read(spark, d, limits=config.Limits()):
    return _stats(spark, d).filter((F.col("n_own") >= limits.n_own) & (F.col("n_own") > limits.own_ratio * F.col("n_docs"))).orderBy(F.desc("n_own"), "cluster").limit(10).select("cluster", "n_docs", "n_own")


@query(READ[0])
def read_not_write(spark, d, limits=config.Limits()):
    return _stats(spark, d).filter((F.col("n_docs") >= limits.n_docs) & (F.col("n_own") <= F.col("n_docs") / 20)).orderBy(F.desc("n_docs"), "cluster").limit(10).select("cluster", "n_docs", "n_own")


@query(GROWING[1])
def growing_thin_small(spark, d):
    return growing_thin(spark, d, config.SMALL_CORPUS)


@query(STALE[1])
def stale_clusters_small(spark, d):
    return stale_clusters(spark, d, config.SMALL_CORPUS)


@query(WRITTEN[1])
def write_not_read_small(spark, d):
    return write_not_read(spark, d, config.SMALL_CORPUS)


@query(READ[1])
def read_not_write_small(spark, d):
    return read_not_write(spark, d, config.SMALL_CORPUS)


# --- discovery and filing ------------------------------------------------------------------------------------


@query(f"""select item_key, {EXT} as ext from documents where {EXT} in ({SQL_LIST(config.IMPORT_EXTENSIONS)}) and lower({TOP}) not in ({SQL_LIST(config.COVERED_FOLDERS)}) and not contains(coalesce(path, ''), '!')
and coalesce(path, '') not in (select catalog_path from fulltext_md where status = 'ok' and catalog_path is not null)""")
def import_candidates(spark, d):
    """Files of an allowed type outside the folders already covered whose path no finished attempt has."""
    ext = X.extension(F.col("path"))
    t = table(spark, d, "documents").select("item_key", F.coalesce("path", F.lit("")).alias("path"), ext.alias("ext"))
    t = t.filter(F.col("ext").isin(config.IMPORT_EXTENSIONS) & ~F.lower(X.top_folder(F.col("path"))).isin(config.COVERED_FOLDERS) & ~F.contains("path", F.lit("!")))
    done = table(spark, d, "fulltext_md").filter("status = 'ok' and catalog_path is not null").select(F.col("catalog_path").alias("path")).distinct()
    return t.join(done, "path", "left_anti").select("item_key", "ext")


@query("""select path, size, modified_ms, count(*) as n_rows from (select catalog_path as path, chars as size, epoch_ms(date_trunc('second', converted_at)) as modified_ms from fulltext_md
where catalog_path is not null and chars is not null and converted_at is not null) group by 1, 2, 3""")
def listing_rows(spark, d):
    """Attempts written as listing lines and read back; lines that lack a field are dropped."""
    t = table(spark, d, "fulltext_md").select(F.concat_ws("\t", "catalog_path", F.col("chars").cast("string"), F.date_format("converted_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("value"))
    return landed.listing(t).groupBy("path", "size", "modified_ms").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""select coalesce(a.path, b.path) as path, a.path is not null as in_catalogue, b.path is not null as in_attempts from (select distinct path from documents where path is not null) a
full join (select distinct catalog_path as path from fulltext_md where catalog_path is not null) b on a.path = b.path""")
def path_union(spark, d):
    """All paths of catalogue and attempts with where they occur."""
    a = table(spark, d, "documents").filter("path is not null").select("path", F.lit(True).alias("a"), F.lit(False).alias("b"))
    b = table(spark, d, "fulltext_md").filter("catalog_path is not null").select(F.col("catalog_path").alias("path"), F.lit(False).alias("a"), F.lit(True).alias("b"))
    return a.unionByName(b).groupBy("path").agg(F.bool_or("a").alias("in_catalogue"), F.bool_or("b").alias("in_attempts"))


@query(f"""with t as (select {TOPIC} topic, count(*) n from documents group by 1), k as (select distinct topic from docs where topic is not null)
select t.topic, 'C_' || substr(md5(t.topic), 1, 8) as collection_key, k.topic is null as created, n as n_docs from t left join k on t.topic = k.topic""")
def topic_collections(spark, d):
    """A collection key per topic, kept where the collection exists and made where it does not."""
    t = table(spark, d, "documents").groupBy(X.path_topic(F.col("path")).alias("topic")).agg(F.count(F.lit(1)).alias("n_docs"))
    known = table(spark, d, "docs").filter("topic is not null").select("topic").distinct().withColumn("known", F.lit(True))
    key = F.concat(F.lit("C_"), F.substring(F.md5("topic"), 1, 8))
    return t.join(known, "topic", "left").select("topic", key.alias("collection_key"), F.col("known").isNull().alias("created"), "n_docs")


@query(f"""select item_key from documents where ({CATEGORY}) = 'uncategorized' and item_key not in (select item_key from auto_topics where item_key is not null and auto_topic is not null and auto_topic <> '{config.UNCLASSIFIED}')""")
def unclassified_items(spark, d):
    """Items without a telling folder that no classifier has named yet."""
    t = table(spark, d, "documents").filter(X.folder_category(X.top_folder(F.col("path"))) == "uncategorized").select("item_key")
    named = table(spark, d, "auto_topics").filter((F.col("auto_topic") != config.UNCLASSIFIED) & F.col("item_key").isNotNull()).select("item_key").distinct()
    return t.join(named, "item_key", "left_anti")


@query("""select item_key, regexp_replace(coalesce(title, ''), '^[A-Z0-9]{8}_', '') as title, coalesce(title, '') <> regexp_replace(coalesce(title, ''), '^[A-Z0-9]{8}_', '') as had_key from documents""")
def clean_titles(spark, d):
    t = X.clean_title(F.col("title"))
    return table(spark, d, "documents").select("item_key", t.alias("title"), (F.coalesce("title", F.lit("")) != t).alias("had_key"))


@query(f"""with c as {CONVERTED}, g as (select text_hash, count(*) n, arg_min(own_kind, struct_pack(a := own_kind = 'own', b := coalesce(category, '') = 'backup', c := -coalesce(chars, 0), k := item_key)) kind from c group by 1)
select kind, sum(n) as n_docs, count(*) as n_texts from g group by 1""")
def kind_counts(spark, d):
    """Documents and distinct texts of each kind after copies took the kind of their best copy."""
    t = canonical_docs(spark, d)
    return t.groupBy("kind").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("is_canonical").alias("n_texts"))


# --- text --------------------------------------------------------------------------------------------------

WORDS = f"list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda x: regexp_matches(x, '^[a-z]{{3,}}$') and not list_contains([{SQL_LIST(config.STOP_WORDS)}], x))"
TF = f"""w as (select item_key, {WORDS} w from documents), t as (select item_key, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) term from w),
tf as (select item_key, term, count(*) tf from t group by 1, 2), n as (select count(*) n from documents),
v as (select term, count(*) df, sum(tf) cf from tf group by 1 having count(*) >= 5 and count(*) <= 0.35 * (select n from n) order by cf desc, term limit 60000),
x as (select item_key, term, (1 + ln(tf)) * (ln((1.0 + n) / (1 + df)) + 1) w from tf join v using (term), n),
u as (select item_key, term, x.w / sqrt(sum(x.w * x.w) over (partition by item_key)) weight from x)"""


@query(f"with {TF} select item_key, count(*) as n_terms, round(max(weight), 6) as top_weight, round(sum(weight), 6) as sum_weight from u group by 1")
def tfidf_terms(spark, d):
    w = text_ops.tfidf(table(spark, d, "documents"), "item_key")
    return w.groupBy("item_key").agg(F.count(F.lit(1)).alias("n_terms"), F.round(F.max("weight"), 6).alias("top_weight"), F.round(F.sum("weight"), 6).alias("sum_weight"))


@query(f"""with {TF}, c as (select cluster, count(*) size from docs where cluster is not null group by 1), g as (select term, sum(weight) / (select n from n) g from u group by 1),
m as (select cluster, term, round(sum(weight) / any_value(size) - any_value(g), 6) lift from u join docs using (item_key) join c using (cluster) join g using (term) group by 1, 2)
select cluster, string_agg(term, ', ' order by lift desc, term) as label from (select * from m qualify row_number() over (partition by cluster order by lift desc, term) <= 6) group by 1""")
def cluster_labels(spark, d):
    return _labels(table(spark, d, "documents"), table(spark, d, "docs").filter("cluster is not null").select("item_key", "cluster"))


def _labels(docs, members):
    """cluster, label: the six terms by which a cluster's mean weights exceed those of all documents most."""
    members = cut(members)
    n = docs.count()
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    # one sum per cluster and term (documents without a cluster under null) gives the clusters' and the corpus' means
    sums = cut(text_ops.term_sums(attached(docs.select("item_key", "text"), "item_key", members, MAX_KEYS, left=True), "cluster"))
    base = sums.groupBy("term").agg((F.sum("s") / n).alias("g"))
    m = sums.join(sizes, "cluster").join(base, "term").select("cluster", "term", F.round(F.col("s") / F.col("size") - F.col("g"), 6).alias("lift"))
    top = m.withColumn("rn", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("lift"), "term"))).filter("rn <= 6")
    return top.groupBy("cluster").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", "term"))), lambda x: x["term"]), ", ").alias("label"))


@query(f"""with w as (select item_key, unnest({WORDS.replace('text', "title || ' ' || coalesce(path, '') || ' ' || coalesce(text, '')")}) term from documents), tf as (select item_key, term, count(*) tf from w group by 1, 2),
l as (select item_key, sum(tf) len from tf group by 1), s as (select count(*) n, avg(len) a from l), h as (select * from tf where term in ('solar', 'batteries', 'courts', 'robots')), f as (select term, count(*) df from h group by 1)
select item_key, round(sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / a))), 6) as score from h join f using (term) join l using (item_key), s group by 1""")
def bm25_search(spark, d):
    docs = table(spark, d, "documents").select("item_key", F.concat("title", F.lit(" "), F.coalesce("path", F.lit("")), F.lit(" "), F.coalesce("text", F.lit(""))).alias("text"))
    return text_ops.bm25(docs, "item_key", ["solar", "batteries", "courts", "robots"])


NOTES = f"""{TF}, e as (select item_id, {WORDS} w from eval_items), et as (select item_id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) term from e),
etf as (select item_id, term, count(*) tf from et group by 1, 2), ex as (select item_id, term, (1 + ln(tf)) * (ln((1.0 + n) / (1 + df)) + 1) w from etf join v using (term), n),
eu as (select item_id, term, ex.w / sqrt(sum(ex.w * ex.w) over (partition by item_id)) weight from ex),
k as (select item_id, item_key, round(sum(eu.weight * u.weight), 6) similarity from eu join u using (term) group by 1, 2),
top as (select k.* from k qualify row_number() over (partition by item_id order by similarity desc, item_key) <= 40),
links as (select top.item_id, top.item_key, top.similarity, docs.cluster from top join docs using (item_key) where shareable qualify row_number() over (partition by top.item_id order by similarity desc, top.item_key) <= 5)"""


def _note_links(spark, d):
    """The five closest shareable documents of each note among its forty closest."""
    notes = table(spark, d, "eval_items").filter("item_id is not null")
    top = text_ops.note_matches(notes, table(spark, d, "documents"), "item_id", "item_key").drop("rank")
    ok = top.join(table(spark, d, "docs").filter("shareable").select("item_key", "cluster"), "item_key")
    best = Window.partitionBy("item_id").orderBy(F.desc("similarity"), "item_key")
    return ok.withColumn("rank", F.row_number().over(best)).filter("rank <= 5")


@query(f"with {NOTES} select item_id, item_key, similarity, cast(row_number() over (partition by item_id order by similarity desc, item_key) as int) as rank from links")
def note_links(spark, d):
    return _note_links(spark, d).select("item_id", "item_key", "similarity", "rank")


@query(f"with {NOTES} select item_id, item_key, similarity from links qualify row_number() over (partition by item_id order by similarity desc, item_key) = 1 order by similarity desc, item_id limit 12")
def best_note_doc(spark, d):
    return _note_links(spark, d).filter("rank = 1").orderBy(F.desc("similarity"), "item_id").limit(12).select("item_id", "item_key", "similarity")


@query(f"with {NOTES} select c.cluster, c.label, c.n_docs from clusters c where c.cluster not in (select cluster from links where similarity >= 0.08 and cluster is not null) order by n_docs desc, cluster limit 12")
def unlinked_clusters(spark, d, least=0.08):
    linked = _note_links(spark, d).filter((F.col("similarity") >= least) & F.col("cluster").isNotNull()).select("cluster").distinct()
    return table(spark, d, "clusters").join(linked, "cluster", "left_anti").orderBy(F.desc("n_docs"), "cluster").limit(12).select("cluster", "label", "n_docs")


@query(ORACLE["unlinked_clusters"].replace("similarity >= 0.08", "similarity >= 0.42"))
def loosely_linked_clusters(spark, d):
    """Clusters no note comes close to."""
    return unlinked_clusters(spark, d, 0.42)


@query("""with v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) e from embeddings), q as (select * from v where vec_id % 50 = 0),
s as (select q.vec_id q, v.vec_id, list_cosine_similarity(q.e, v.e) similarity from q, v where q.vec_id <> v.vec_id)
select q, vec_id, round(similarity, 6) as similarity, cast(row_number() over (partition by q order by round(similarity, 9) desc, vec_id) as int) as rank from s qualify row_number() over (partition by q order by round(similarity, 9) desc, vec_id) <= 5""")
def embedding_neighbours(spark, d):
    """The five nearest rows of every vector whose id is divisible by 50 (the stated query set)."""
    v = table(spark, d, "embeddings")
    return similarity.nearest(v, v.filter("vec_id % 50 = 0")).withColumn("similarity", F.round("similarity", 6))


@query("""with v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) e from embeddings), q as (select * from v where vec_id % 50 = 0),
s as (select q.vec_id q, round(list_cosine_similarity(q.e, v.e), 9) s from q, v where q.vec_id <> v.vec_id), l as (select unnest([0.25, 0.97, 0.995]::double[]) lv)
select lv as at_least, count(*) as n_pairs, count(distinct q) as n_queries from s join l on s >= lv group by 1""")
def neighbour_bands(spark, d):
    """How many pairs of a query vector and another row reach a cosine: copies, near copies, alike; all partners count."""
    v = table(spark, d, "embeddings")
    n = similarity.near_counts(v, v.filter("vec_id % 50 = 0"), [0.25, 0.97, 0.995])
    return n.groupBy(F.col("level").alias("at_least")).agg(F.sum("n").alias("n_pairs"), F.count(F.lit(1)).alias("n_queries"))


@query()
def topic_clusters(spark, d):
    return topics.topic_clusters(table(spark, d, "documents"), "item_key")


@query()
def topic_overview(spark, d):
    """Clusters fitted on the literature with the owner's documents assigned to them: sizes, years and label of each."""
    corpus = literature_corpus(spark, d).filter("is_canonical and substantive").select("item_key", "kind")
    texts = table(spark, d, "documents")
    facts = cut(texts.select("item_key", X.catalogue_year(F.col("year"), CFG.as_of.year).alias("year")).join(corpus, "item_key"))
    lit = F.col("kind") == "literature"
    docs = attached(texts.select("item_key", "text"), "item_key", facts.select("item_key", lit.alias("lit")), MAX_KEYS)
    c = cut(topics.topic_clusters(docs, "item_key", fit=F.col("lit")).select("item_key", "cluster").join(facts, "item_key"))
    year = F.when(lit, F.col("year"))
    g = c.groupBy("cluster").agg(
        F.count_if(lit).alias("n_docs"), F.count_if(~lit).alias("n_own"), F.floor(F.median(year)).cast("int").alias("median_year"),
        F.round(100.0 * F.count_if(year >= 2023) / F.nullif(F.count(year), F.lit(0)), 1).alias("pct_recent"),
    )
    literature = attached(texts.select("item_key", "text"), "item_key", cut(facts.filter(lit).select("item_key")), MAX_KEYS)
    return g.join(_labels(literature, c.filter(lit).select("item_key", "cluster")), "cluster", "left")


# --- gates ---------------------------------------------------------------------------------------------------


@query(f"select count(*) as n_items, count(case when source is null or trim(source) = '' then 1 end) as missing, count(case when source is null or trim(source) = '' then 1 end) = 0 as passed from documents")
def tag_coverage_gate(spark, d):
    tags = X.derived_tags(F.col("path"), F.col("mtime"), F.when(F.trim("source") != "", F.col("source")))
    t = table(spark, d, "documents").select(F.coalesce(F.trim(X.tag_value(tags, "source:")), F.lit("")).alias("s"))
    return t.agg(F.count(F.lit(1)).alias("n_items"), F.count_if(F.col("s") == "").alias("missing")).withColumn("passed", F.col("missing") == 0)


@query("with g as (select lower(trim(md5)) m, count(*) n from documents where md5 is not null group by 1 having count(*) > 1) select count(*) as n_groups, sum(n - 1) as n_duplicates, count(*) > 0 and sum(n - 1) > 0 as passed from g")
def dedupe_gate(spark, d):
    g = exact_dup_groups(spark, d)
    return g.agg(F.count(F.lit(1)).alias("n_groups"), F.sum(F.col("n_docs") - 1).alias("n_duplicates")).withColumn("passed", (F.col("n_groups") > 0) & (F.col("n_duplicates") > 0))


@query(f"with t as (select {TOPIC} topic, count(*) n from documents group by 1), f as (select * from t order by topic limit 5) select (select count(*) from t) as n_topics, sum(n) as in_first_five, (select count(*) from t) > 0 and sum(n) > 0 as passed from f")
def topic_gate(spark, d):
    t = table(spark, d, "documents").groupBy(X.path_topic(F.col("path")).alias("topic")).agg(F.count(F.lit(1)).alias("n"))
    five = t.orderBy("topic").limit(5).agg(F.sum("n").alias("in_first_five"))
    return t.agg(F.count(F.lit(1)).alias("n_topics")).join(F.broadcast(five)).withColumn("passed", (F.col("n_topics") > 0) & (F.col("in_first_five") > 0))


@query("""with l as (select event_id n, event_type || ' ' || coalesce(cast(user_id as varchar), '') as line from events),
m as (select max(case when starts_with(line, 'purchase') then n end) hit, max(n) tail from l) select hit is not null as passed, line from m join l on l.n = coalesce(hit, tail)""")
def completion_gate(spark, d):
    """The last log line with the completion marker, else the last line of all."""
    lines = table(spark, d, "events").select(F.col("event_id").alias("n"), F.concat(F.col("event_type"), F.lit(" "), F.coalesce(F.col("user_id").cast("string"), F.lit(""))).alias("line"))
    return landed.marked_line(lines, "n", "line", F.col("line").startswith("purchase"))


@query("""select catalog_path as path, 'ok' as status, cast(0 as bigint) as size, count(*) as n_rows from fulltext_md where starts_with(source || '://' || catalog_path, 'dropbox://') group by 1""")
def resume_log(spark, d):
    """A log of finished paths made again from the items' addresses."""
    url = F.concat("source", F.lit("://"), "catalog_path")
    t = table(spark, d, "fulltext_md").filter(url.startswith("dropbox://")).select(F.split(url, "://", 2)[1].alias("path"))
    return t.groupBy("path").agg(F.count(F.lit(1)).alias("n_rows")).select("path", F.lit("ok").alias("status"), F.lit(0).cast("bigint").alias("size"), "n_rows")


CREATORS = rf"""select item_key, array_to_string(list_transform(a, lambda x: list_extract(string_split(x, ' '), -1) || ', ' || array_to_string(list_slice(string_split(x, ' '), 1, len(string_split(x, ' ')) - 1), ' ')), '; ') as creators from
(select item_key, list_filter(list_transform(string_split(coalesce(authors, ''), '; '), lambda x: trim(regexp_replace(x, '{WS}', ' ', 'g'))), lambda x: x <> '') a from ({ORACLE['filename_parse']}))"""


@query(CREATORS)
def filename_creators(spark, d):
    """First and last names of the authors named in titles."""
    t = filename_parse(spark, d).select("item_key", X.author_names(F.split("authors", "; ")).alias("a"))
    return t.select("item_key", F.array_join(F.transform("a", lambda x: F.concat(x["last"], F.lit(", "), x["first"])), "; ").alias("creators"))


@query(rf"""select e.ext as extension, e.suffix, count(*) as n_docs from (select {EXT} as ext, case when lower(regexp_extract({BASE}, '^.+\.([^.]+)$', 1)) = '' then 'unknown' else lower(regexp_extract({BASE}, '^.+\.([^.]+)$', 1)) end as suffix from documents) e group by 1, 2""")
def file_types(spark, d):
    """File types by both definitions: of the innermost file, and of the listing."""
    t = table(spark, d, "documents").select(X.extension(F.col("path")).alias("extension"), X.suffix(F.col("path")).alias("suffix"))
    return t.groupBy("extension", "suffix").agg(F.count(F.lit(1)).alias("n_docs"))


REPORT = f"""select 'thick' as section, cast(row_number() over (order by n_docs desc, cluster) as int) as line_no, '- ' || coalesce(label, '?') || ': ' || n_docs || ' documents' as line from ({ORACLE['largest_clusters']})
union all select 'conflicts', cast(row_number() over (order by ratio desc, subject, currency, year) as int), '- ' || subject || ' market, ' || year || ': ' || n_docs || ' texts, ' || cast(round(ratio, 1) as decimal(9,1)) || ' times apart' from (select * from ({ORACLE['contradictions']}) order by ratio desc, subject, currency, year limit 25)
union all select 'unlinked', cast(row_number() over (order by n_docs desc, cluster) as int), '- ' || label || ': ' || n_docs || ' documents' from ({ORACLE['loosely_linked_clusters']})"""


@query(REPORT)
def report_lines(spark, d):
    """The report as lines of text, section by section, from the marts' top rows."""

    def section(name, rows, order, line):
        w = Window.orderBy(*order)  # at most 25 rows
        return rows.select(F.lit(name).alias("section"), F.row_number().over(w).alias("line_no"), line.alias("line"))

    n = F.col("n_docs").cast("string")
    c = contradictions(spark, d).orderBy(F.desc("ratio"), "subject", "currency", "year").limit(25)
    apart = F.concat(F.lit("- "), "subject", F.lit(" market, "), F.col("year").cast("string"), F.lit(": "), n, F.lit(" texts, "), F.round("ratio", 1).cast("decimal(9,1)").cast("string"), F.lit(" times apart"))
    docs = lambda label: F.concat(F.lit("- "), label, F.lit(": "), n, F.lit(" documents"))
    out = section("thick", largest_clusters(spark, d), [F.desc("n_docs"), "cluster"], docs(F.coalesce("label", F.lit("?"))))
    out = out.unionByName(section("conflicts", c, [F.desc("ratio"), "subject", "currency", "year"], apart))
    return out.unionByName(section("unlinked", loosely_linked_clusters(spark, d), [F.desc("n_docs"), "cluster"], docs(F.col("label"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
