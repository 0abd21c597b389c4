"""Best representative of each duplicate group, field by field.

Groups: connected components of records with one file checksum (checksums shared by unrelated texts are
void) and of resolvable duplicate_of links.  Components are found by repeated minimum labels with pointer
jumping; lineage is cut every round.

Values: a latent two-sided truth model.  Every value that some record of a group has for a field is a
fact; each record's source either asserts the fact or, having a usable value of its own, denies it.  EM
alternates between the posterior of each fact and each source's sensitivity (share of true facts it
asserts) and specificity (share of false facts it denies), with a prior by form: well-formed values are
believed (``PRIOR``), placeholders, blanks, cut-off values and technical residue are not.  A source counts once
per fact, however many records it has, and the evidence of the sources is summed up: a value that one source
states and many reliable ones contradict is given up, also if it is the latest.  Several values of one field
may be judged true and are all kept (``values_judged``); the surviving record takes, among them, the value
of the record modified last.

Edge results: mtime null or 0 counts as oldest; ties go to the smallest doc_id; a group without a usable
value of a field has no row for it; dangling and self links are ignored; repeated rows count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstrata.llm.features import checksum_members, profiles
from docstrata.sources.tables import bounded_broadcast, cut

# Folders that only collect, as catalogues name them.
CATCH_ALL = [
    "(root)", "pdf", "docx", "pptx", "epub", "doc", "ris", "chm", "mobi", "djvu", "documents", "all unorganised files", "zip", "files",
    "docs", "downloads", "saved from web", "saved from chrome", "attachments", "sent files", "new folder", "type",
]
PLACEHOLDER_TITLE = r"(?i)^(?:unknown|untitled(?: document)?|document|no title|n/?a|none|null|title|(?:scan|img|image|doc|file|dsc)[ _-]?\d+.*|new document.*)$"
RESIDUE_TITLE = r"(?i)^[A-Z0-9]{8}_|^microsoft (?:word|powerpoint|excel) - |~\d+$|\.(?:pdf|docx?|pptx?|xlsx?|epub|html?|txt|indd|qxd|dvi)$|_x000d_|&[a-z]+;"
CUT_OFF = r"(?:…|\.\.\.)\s*$"
ITERATIONS = 4
PRIOR = 0.98  # of a well-formed value: of several, the project takes the latest unless sources speak against it
BELIEVED = 0.5
MAX_SOURCES = 100_000


def usable(field: Column, value: Column, first_year: int = 1950, last_year: int = 2026) -> Column:
    """Whether a value of title, topic or year can stand in the surviving record."""
    v = F.trim(value)
    title = ~v.rlike(PLACEHOLDER_TITLE) & ~v.rlike(RESIDUE_TITLE) & ~v.rlike(CUT_OFF)
    topic = ~F.lower(v).isin(CATCH_ALL) & ~v.contains("!") & ~v.rlike(CUT_OFF)
    year = v.rlike(r"^[0-9]{4}$") & v.try_cast("int").between(first_year, last_year)
    ok = F.when(field == "title", title).when(field == "topic", topic).otherwise(year)
    return F.coalesce((v != "") & ok, F.lit(False))


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node) for undirected edges (a, b) of distinct nodes."""
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
    while True:
        near = both.join(label, both.b == label.node).groupBy("a").agg(F.min("root").alias("m"))
        step = label.join(near, label.node == near.a).select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("far"))
        new = cut(step.join(jump, "root", "left").select("node", "old", F.least(F.coalesce("far", "root"), "root").alias("root")))
        label = new.select("node", "root")
        if new.filter("root <> old").isEmpty():
            return label


def duplicate_groups(documents: DataFrame) -> DataFrame:
    """doc_id, group_doc_id for every record in a duplicate group of two or more."""
    d = documents.filter("doc_id is not null").select("doc_id", "item_key", "duplicate_of", F.lower(F.trim("md5")).alias("md5"))
    links = d.filter("duplicate_of is not null").select(F.col("doc_id").alias("a"), F.trim("duplicate_of").alias("item_key"))
    targets = d.filter("item_key is not null").groupBy("item_key").agg(F.min("doc_id").alias("b"))
    linked = links.join(targets, "item_key").filter("a <> b").select("a", "b")
    sums = d.filter("md5 rlike '^[0-9a-f]{32}$'").select("md5", "doc_id").distinct()
    several = sums.join(sums.groupBy("md5").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("md5"), "md5")
    several = cut(several)
    texts = profiles(documents.join(several.select("doc_id").distinct(), "doc_id", "left_semi"), ["doc_id"])
    members = checksum_members(several.join(texts.select("doc_id", "words").dropDuplicates(["doc_id"]), "doc_id").select("md5", F.col("doc_id").alias("key"), F.col("doc_id").alias("seq"), "words"))
    shared = members.filter("key <> first").select(F.col("key").alias("a"), F.col("first").alias("b"))
    return components(cut(linked.unionByName(shared))).select(F.col("node").alias("doc_id"), F.col("root").alias("group_doc_id"))


def values_judged(documents: DataFrame) -> DataFrame:
    """group_doc_id, field, value, usable, posterior, last (mtime, -doc_id of its latest record), best.

    The values of title, topic and year that occur in each duplicate group with the posterior of being true.
    """
    src = F.coalesce(F.regexp_replace(F.lower(F.trim("source")), "[^a-z0-9]+", "_"), F.lit("(none)"))
    rec = duplicate_groups(documents).join(documents.select("doc_id", "title", "topic", "year", "mtime", src.alias("src")).dropDuplicates(["doc_id"]), "doc_id")
    long = rec.select("group_doc_id", "doc_id", "src", F.coalesce("mtime", F.lit(0)).alias("mtime"), F.explode(F.create_map(*[x for c in ("title", "topic", "year") for x in (F.lit(c), F.col(c).cast("string"))])).alias("field", "value"))
    long = cut(long.filter("value is not null").withColumn("usable", usable(F.col("field"), F.col("value"))))
    facts = long.groupBy("group_doc_id", "field", "value").agg(F.first("usable").alias("usable"), F.max(F.struct("mtime", (-F.col("doc_id")).alias("neg"))).alias("last"))
    # a source votes once on each fact of a group and field it speaks about: yes if any of its records has the value
    speaks = long.filter("usable").select("group_doc_id", "field", "src").distinct()
    says = long.select("group_doc_id", "field", "value", "src").distinct().withColumn("yes", F.lit(True))
    about = facts.select("group_doc_id", "field", "value", "usable").join(speaks, ["group_doc_id", "field"])
    own = says.join(facts.select("group_doc_id", "field", "value", "usable"), ["group_doc_id", "field", "value"])
    votes = about.withColumn("yes", F.lit(False)).unionByName(own.select(*about.columns, "yes")).groupBy(*about.columns).agg(F.bool_or("yes").alias("yes"))
    votes = cut(votes)
    prior = F.when(F.col("usable"), F.lit(PRIOR)).otherwise(F.lit(0.02))
    fact = ["group_doc_id", "field", "value"]
    post = votes.select(*fact, "usable").distinct().withColumn("p", prior)
    for _ in range(ITERATIONS):
        # M: expected counts per source and field with Beta(8,2) / Beta(9,1) priors; one row per source and field
        p, yes = F.col("p"), F.col("yes").cast("double")
        counts = votes.join(post.select(*fact, "p"), fact).groupBy("field", "src").agg(
            F.sum(p * yes).alias("tp"), F.sum(p * (1 - yes)).alias("fn"), F.sum((1 - p) * yes).alias("fp"), F.sum((1 - p) * (1 - yes)).alias("tn")
        )
        quality = cut(counts.select("field", "src", ((F.col("tp") + 8) / (F.col("tp") + F.col("fn") + 10)).alias("sens"), ((F.col("tn") + 9) / (F.col("tn") + F.col("fp") + 10)).alias("spec")))
        # E: log odds of each fact
        odds = F.when(F.col("yes"), F.log(F.col("sens") / (1 - F.col("spec")))).otherwise(F.log((1 - F.col("sens")) / F.col("spec")))
        ll = votes.join(bounded_broadcast(quality, quality.count(), MAX_SOURCES), ["field", "src"]).groupBy(*fact, "usable").agg(F.sum(odds).alias("ll"))
        post = cut(ll.select(*fact, "usable", (1 / (1 + F.exp(-(F.log(prior / (1 - prior)) + F.col("ll"))))).alias("p")))
    judged = facts.join(post.select("group_doc_id", "field", "value", "p"), ["group_doc_id", "field", "value"])
    return judged.select("group_doc_id", "field", "value", "usable", F.round("p", 6).alias("posterior"), "last", (F.col("usable") & (F.col("p") >= BELIEVED)).alias("kept"))


def best_values(judged: DataFrame) -> DataFrame:
    """group_doc_id, field, best: the kept value of the record modified last."""
    return judged.filter("kept").groupBy("group_doc_id", "field").agg(F.max_by("value", "last").alias("best"))
