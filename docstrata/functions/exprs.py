"""Scalar functions of the catalogue as column expressions (no Python per row).

All are null-safe: a null input gives the result stated for a missing value, never an error.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from docstrata import config

SPACE = r"(?U)\s+"


def quoted(words: Sequence[str]) -> str:
    """Alternation that matches the words literally, in Java and RE2 alike."""
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in words)


def url_source(url: Column) -> Column:
    return F.when(url.contains("://"), F.split(url, "://", 2)[0])


def url_path(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    return F.when(url.contains("://"), F.split(url, "://", 2)[1])


def folder_category(folder: Column, personal: Sequence[str] = ()) -> Column:
    name = F.lower(F.coalesce(folder, F.lit("")))
    out = F.when(name == "", "uncategorized")
    if personal:
        out = out.when(name.rlike(quoted([p.lower() for p in personal])), "personal")
    return out.when(name.rlike(quoted(config.BACKUP_KEYWORDS)), "backup").when(name.isin(config.UNCATEGORIZED_FOLDERS), "uncategorized").otherwise("research")


def top_folder(path: Column) -> Column:
    parts = F.split(F.coalesce(path, F.lit("")), "/", -1)
    return F.when(F.size(parts) == 1, "").otherwise(parts[0])


def path_topic(path: Column) -> Column:
    """Top folder; the second one below generic buckets; ``(root)`` for loose files."""
    parts = F.split(F.coalesce(path, F.lit("")), "/", -1)
    generic = F.lower(parts[0]).isin(config.GENERIC_BUCKETS) & (F.size(parts) > 2)
    return F.when(F.size(parts) == 1, "(root)").when(generic, F.get(parts, F.lit(1))).otherwise(parts[0])


def mtime_year(mtime: Column) -> Column:
    return F.year(F.timestamp_millis(F.when(mtime != 0, mtime)))


def extension(path: Column, default: str = "unknown") -> Column:
    """Lower-case extension of the innermost file name."""
    name = F.element_at(F.split(F.element_at(F.split(F.coalesce(path, F.lit("")), "!", -1), -1), "/", -1), -1)
    ext = F.lower(F.regexp_extract(name, r"[^.].*\.([^.]*)$", 1))
    return F.when(ext == "", default).otherwise(ext)


def suffix(path: Column, default: str = "unknown") -> Column:
    """Lower-case suffix of the last path part as listings name it: an archive's inside is not told apart, dots in front count."""
    name = F.element_at(F.split(F.coalesce(path, F.lit("")), "/", -1), -1)
    ext = F.lower(F.regexp_extract(name, r"^.+\.([^.]+)$", 1))
    return F.when(ext == "", default).otherwise(ext)


def derived_tags(path: Column, mtime: Column, source: Column, personal: Sequence[str] = ()) -> Column:
    year = mtime_year(mtime)
    return F.array_compact(
        F.array(
            F.concat(F.lit("category:"), folder_category(top_folder(path), personal)),
            F.concat(F.lit("topic:"), path_topic(path)),
            F.concat(F.lit("source:"), F.coalesce(source, F.lit(""))),
            F.concat(F.lit("filetype:"), extension(path)),
            F.when(year.isNotNull(), F.concat(F.lit("year:"), year.cast("string"))),
        )
    )


OWNED = ("category:", "topic:", "source:", "filetype:", "year:")


def owned(tags: Column, prefixes: Sequence[str] = OWNED) -> Column:
    return F.filter(tags, lambda t: t.rlike("^(?:" + "|".join(prefixes) + ")"))


def tags_need_update(old: Column, new: Column) -> Column:
    """Whether the owned tags differ as sets."""
    return F.array_sort(F.array_distinct(owned(old))) != F.array_sort(F.array_distinct(new))


def merge_tags(old: Column, new: Column, prefixes: Sequence[str] = OWNED) -> Column:
    return F.concat(F.filter(old, lambda t: ~t.rlike("^(?:" + "|".join(prefixes) + ")")), new)


def tag_value(tags: Column, prefix: str) -> Column:
    """Remainder of the first tag with the prefix."""
    return F.substring(F.get(F.filter(tags, lambda t: t.startswith(prefix)), F.lit(0)), len(prefix) + 1, 1 << 20)


def item_key_for(source: Column, path: Column) -> Column:
    return F.concat(F.lit("XL_"), F.substring(F.md5(F.concat(source, F.lit(":"), path)), 1, 12))


def title_category(title: Column, categories=None) -> Column:
    """First category one of whose phrases stands in the title; spaces, hyphens and underscores are alike."""
    t = F.lower(F.coalesce(title, F.lit("")))
    out = None
    for name, phrases in categories or config.TITLE_CATEGORIES:
        pattern = "(?:^|[^\\p{L}\\p{N}_])(?:" + "|".join(re.sub(r"[\s_\-]+", r"[\\s_-]+", p) for p in phrases) + ")(?:$|[^\\p{L}\\p{N}_])"
        out = F.when(t.rlike(pattern), name) if out is None else out.when(t.rlike(pattern), name)
    return out.otherwise(config.UNCLASSIFIED)


# Extensions that may end a title.
TITLE_EXTENSIONS = ["pdf", "docx", "pptx", "xlsx", "doc", "ppt", "xls", "epub", "mobi", "djvu", "chm", "ris", "html", "htm"]


def safe_title(title: Column) -> Column:
    t = F.when(F.coalesce(title, F.lit("")) == "", "untitled").otherwise(title)
    t = F.regexp_replace(t, r"(?i)\.(?:" + "|".join(TITLE_EXTENSIONS) + ")$", "")
    return F.substring(F.regexp_replace(t, r"[^\p{L}\p{N} \-_.]", "_"), 1, 80)


def safe_extension(path: Column) -> Column:
    name = F.element_at(F.split(F.coalesce(path, F.lit("")), "/", -1), -1)
    ext = F.substring(F.regexp_replace(F.regexp_extract(name, r"[^.].*\.([^.]+)$", 1), r"[^\p{L}\p{N}]", ""), 1, 10)
    return F.when(ext == "", ".bin").otherwise(F.concat(F.lit("."), ext))


def safe_component(name: Column) -> Column:
    clean = F.substring(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r'[<>:"/\\|?*\x00-\x1f]', "_")), 1, 150)
    return F.when(clean == "", "misc").otherwise(clean)


def destination(category: Column, topic: Column, item_key: Column, path: Column) -> Column:
    base = F.element_at(F.split(F.element_at(F.split(path, "!", -1), -1), "/", -1), -1)
    return F.concat_ws("/", F.lit("Organized"), safe_component(category), safe_component(F.coalesce(topic, F.lit("misc"))), F.concat(item_key, F.lit("_"), safe_component(base)))


def catalogue_year(year: Column, as_of_year: int) -> Column:
    y = F.trim(year)
    n = F.when(y.rlike("^[0-9]+$"), y.try_cast("int"))
    return F.when(n.between(1950, as_of_year), n)


def latest_year_named(text: Column, as_of_year: int) -> Column:
    """Largest year from 1950 to ``as_of_year`` that stands alone in the text."""
    years = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?<![\p{L}\p{M}\p{N}_])(19[5-9][0-9]|20[0-2][0-9])(?![\p{L}\p{M}\p{N}_])"), F.lit(1)), lambda y: y.cast("int"))
    return F.array_max(F.filter(years, lambda y: y <= as_of_year))


def text_key(text: Column) -> Column:
    """sha1 of the whole text in lower case with collapsed white space."""
    return F.sha1(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), SPACE, " ")))


def clean_title(title: Column) -> Column:
    return F.regexp_replace(F.coalesce(title, F.lit("")), "^[A-Z0-9]{8}_", "")


WORD_CHAR = r"\p{L}\p{M}\p{N}_"
START, END = f"(?:^|[^{WORD_CHAR}])", f"(?:$|[^{WORD_CHAR}])"
# Fixed patterns of documents that must not surface; whole words stand between START and END, which Java and RE2 read alike.
SENSITIVE_TEXT = "|".join(
    [
        START + "(?:" + "|".join([r"[A-Z]{5}[0-9]{4}[A-Z]", r"[0-9]{4}\s[0-9]{4}\s[0-9]{4}", "IFSC", "PNR", "demat", "CV", "resume", "stmt"]) + ")" + END,
        START + r"(?:form[ -]?16|form ?26as)" + END, r"order (?:id|no)" + END,
        "account statement", "bank statement", r"account (?:no|number)", r"passport (?:no|number)", "salary slip", "payslip", "date of birth",
        "permanent account number", "folio no", "policy number", r"e-?ticket", "boarding pass", "tax invoice", r"invoice (?:no|number)",
        r"booking (?:id|ref)", "client ledger", "ledger statement", "contract note", "tax declaration", "curriculum vitae", "résumé",
        "client id", "nominee", "annexure", r"capital gains? statement", "holding statement",
    ]
)
SENSITIVE_TITLE = "|".join(
    [
        "gpay", "phonepe", "paytm", "hall ticket", "admit card", "ticket confirmation", "invoice", "receipt", "passport", r"(?:^|[^a-z])nda(?:[^a-z]|$)", "agreement",
        r"(?:credit[ _-]?card|" + START + r"cc|account|bank|quarterly|monthly|personal|salary)[ _-]*(?:financial[ _-]*)?statement",
        r"statement[ _-]*(?:of[ _-]*)?(?:account|transactions)", "certificate", START + "visa" + END, START + r"pan[ _-]?card", "aadhaar", "offer letter", "payslip",
        r"itr[ _-]?v?" + END, r"cover[ _-]?letter", START + "cv" + END, r"r[ée]sum[ée]", "ticket", r"reco[ _-]?[0-9]?" + END,
    ]
)


def like(text: Column, pattern: str) -> Column:
    """Whether text has the pattern, whatever the case.  RE2 takes a time of the text's length, Java's engine one of the number of alternatives, too."""

    @F.arrow_udf("boolean")
    def found(x: pa.Array) -> pa.Array:
        return pc.match_substring_regex(x, f"(?i){pattern}")

    return found(text)


def sensitive(title: Column, text: Column, kind: Column, names: Sequence[str] = ()) -> Column:
    t = F.coalesce(title, F.lit(""))
    both = F.concat(t, F.lit(" "), F.coalesce(text, F.lit("")))
    out = like(both, SENSITIVE_TEXT) | like(t, SENSITIVE_TITLE)
    return out | ((kind == "literature") & both.rlike("(?iu)" + quoted(names))) if names else out


def own_kind(category: Column, path: Column, own_paths: Sequence[str]) -> Column:
    own = F.coalesce(category, F.lit("")) == "backup"
    if own_paths:
        own = own | F.coalesce(path, F.lit("")).rlike("(?i)" + quoted(own_paths))
    return F.when(own, "own").otherwise("literature")


def own_text(text: Column, markers: Sequence[str]) -> Column:
    """Whether the text says that it is the owner's own output."""
    return like(F.coalesce(text, F.lit("")), quoted(markers)) if markers else F.lit(False)


def shareable(category: Column, folder: Column, private: Sequence[str]) -> Column:
    return F.coalesce((category == "research") & ~folder.isin(list(private)), F.lit(False))


def money_text(value: Column, currency: Column) -> Column:
    """Amount for reading: one decimal and tn, bn or mn, else whole units."""
    return F.concat(
        currency, F.lit(" "),
        F.when(value >= 1e12, F.concat(F.format_number(value / 1e12, 1), F.lit("tn"))).when(value >= 1e9, F.concat(F.format_number(value / 1e9, 1), F.lit("bn")))
        .when(value >= 1e6, F.concat(F.format_number(value / 1e6, 1), F.lit("mn"))).otherwise(F.format_number(value, 0)),
    )


# Fixed format of file names: ``(series) authors - title (year) - publisher``.
NAME_SHAPE = r"^(?:\([^)]*\)\s*)?([^-]+?)\s*-\s*(.+?)(?:\s*\(((?:19|20)[0-9]{2})\))?(?:\s*-\s*[^-]+)?$"


def author_names(authors: Column) -> Column:
    """array<struct<first, last>> of names: the last word is the last name; ``Last, First`` is not told apart here."""
    words = lambda a: F.filter(F.split(F.trim(a), SPACE), lambda w: w != "")
    kept = F.filter(authors, lambda a: F.size(words(a)) > 0)
    return F.transform(kept, lambda a: F.struct(F.array_join(F.slice(words(a), 1, F.size(words(a)) - 1), " ").alias("first"), F.element_at(words(a), -1).alias("last")))


def parsed_name(name: Column) -> dict[str, Column]:
    """authors, title and year of a file name ``(series) authors - title (year) - publisher.ext``."""
    stem = F.regexp_replace(name, r"\.[^.\s]+$", "")
    shape = NAME_SHAPE
    hit = stem.rlike(shape)
    parts = F.transform(F.split(F.regexp_extract(stem, shape, 1), r",| and |;"), lambda x: F.trim(x))
    authors = F.filter(parts, lambda x: (x != "") & ~F.lower(x).isin("et al", "et al."))
    title = F.regexp_replace(F.replace(F.regexp_extract(stem, shape, 2), F.lit("_"), F.lit(" ")), r"^[ \-_]+|[ \-_]+$", "")
    year = F.regexp_extract(stem, shape, 3)
    return {
        "authors": F.when(hit, F.concat_ws("; ", authors)).otherwise(""),
        "title": F.when(hit & (title != ""), title).otherwise(stem),
        "year": F.when(hit & (year != ""), year.cast("int")),
    }


def reply_fields(reply: Column, categories: Sequence[str]) -> dict[str, Column]:
    """category and topic of a model's reply with a JSON object somewhere in it; ``unclear`` when unusable."""
    obj = F.from_json(F.regexp_extract(F.coalesce(reply, F.lit("")), r"(?s)(\{.*\})", 1), "category string, topic string")
    ok = F.coalesce(obj["category"].isin(list(categories)) & (F.trim(obj["topic"]) != ""), F.lit(False))
    return {"category": F.when(ok, obj["category"]).otherwise("uncategorized"), "topic": F.when(ok, F.trim(obj["topic"])).otherwise("unclear")}
