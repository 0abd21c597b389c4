"""Parameters of the pipeline: keyword lists, thresholds, dates. Owner-specific lists are empty by default."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, field
from datetime import date
from pathlib import Path

# Folder names that mark machine backups.
BACKUP_KEYWORDS = [
    "backup", "kopia", "restic", "market-data", "market_data", "laptop_backup", "google-cloud-sdk", "coldstore", "ec2", "dedup_moved",
    "repo-branch-archives", "mempalace-backup", "avg antivirus", "avg cleaner", "ccleaner", "installer", "my mac", "my pc", "mein pc",
    "other computers", "desktop", "my drive",
]
# Buckets whose sub-folder carries the topic.
GENERIC_BUCKETS = [
    "pdf", "docx", "pptx", "epub", "doc", "ris", "chm", "mobi", "djvu", "documents", "all unorganised files", "zip", "files", "docs",
    "downloads", "saved from web", "saved from chrome", "attachments", "",
]
# Folders that say nothing about their content.
UNCATEGORIZED_FOLDERS = [
    "documents", "all unorganised files", "downloads", "files", "docs", "saved from web", "saved from chrome", "attachments", "sent files",
    "new folder", "type", "",
]
# File types that are imported, and top folders whose files are known already.
IMPORT_EXTENSIONS = ["pdf", "doc", "docx", "ppt", "pptx", "epub", "djvu", "mobi", "chm", "ris"]
COVERED_FOLDERS = ["xlsx", "excel", "word", "pptx", "docx", "pdf"]
# Title categories in order of precedence, each with its leading phrases; ``title_categories`` reads a longer list.
TITLE_CATEGORIES = [
    ("IT / Software / Computer Science", ["software engineering", "computer science", "algorithm", "algorithms", "database", "databases", "programming", "kubernetes", "docker", "devops", "microservices", "machine learning", "sql", "compiler", "python"]),
    ("Finance / Investing / Markets", ["stock market", "equity", "equities", "portfolio", "investment", "investing", "valuation", "mutual fund", "derivatives", "banking", "dividend", "interest rate"]),
    ("Energy (power, fuel, batteries)", ["battery", "batteries", "hydrogen", "ethanol", "biofuel", "solar energy", "solar power", "wind energy", "power grid", "energy storage", "power plant"]),
    ("Automotive & EVs", ["automotive", "electric vehicle", "electric vehicles", "automobile", "car design"]),
    ("Aviation & Aerospace", ["aviation", "aircraft", "aerospace", "airline", "airport"]),
    ("Medical / Healthcare", ["medical", "healthcare", "clinical", "patient", "disease", "hospital", "vaccine", "diagnosis", "therapy"]),
    ("India Trade / Economic Policy", ["trade policy", "export", "import", "tariff", "economic survey", "fiscal deficit", "gst"]),
    ("Agriculture", ["agriculture", "agricultural", "farming", "farmer", "irrigation", "fertilizer", "livestock"]),
    ("Education / Exams", ["cbse", "syllabus", "question paper", "curriculum", "entrance exam"]),
    ("Chemistry / Materials Science", ["chemical engineering", "polymer", "catalysis", "materials science", "organic chemistry"]),
    ("Government / Policy / Regulation", ["ministry of", "gazette", "government scheme", "regulatory framework", "parliament"]),
    ("Law / Legal", ["supreme court", "high court", "statute", "contract law", "arbitration", "litigation", "case law"]),
    ("Engineering (general)", ["mechanical engineering", "electrical engineering", "civil engineering", "thermodynamics", "robotics"]),
    ("Sports / Cricket", ["cricket", "test match", "batting average", "bowling figures"]),
    ("Environment / Climate", ["climate change", "carbon emission", "carbon footprint", "biodiversity", "net zero"]),
    ("Personal & administrative documents", ["resume", "curriculum vitae", "cover letter", "bank statement", "invoice", "receipt", "screenshot"]),
    ("Business, tender & corporate documents", ["tender", "brochure", "press release", "purchase order", "annual report"]),
    ("Reference material (Wikipedia / how-to)", ["wikipedia", "buying guide", "user guide", "how to"]),
    ("Reports & presentations (general)", ["report", "presentation", "overview", "whitepaper", "white paper"]),
]
UNCLASSIFIED = "Other / Unclassified"
STOP_WORDS = (
    "about above after again all also and any are because been before being below between both but can did does doing down during each few "
    "for from further had has have having her here hers him his how into its itself just more most much nor not now off once only other our "
    "out over own same she should some such than that the their them then there these they this those through too under until upon very was "
    "were what when where which while who whom why will with would you your https http www com org pdf doi html fig cid"
).split()


@dataclass(frozen=True)
class Limits:
    """From what size on the cluster reports speak of growth, age, writing and reading."""

    with_year: int = 10
    pct_recent: float = 35
    stale_year: int = 2018
    n_own: int = 15
    own_ratio: float = 2
    n_docs: int = 60


SMALL_CORPUS = Limits(with_year=3, pct_recent=10, n_own=1, own_ratio=0.1, n_docs=20)


@dataclass(frozen=True)
class Config:
    as_of: date = date(2026, 8, 1)
    personal_keywords: tuple[str, ...] = ()
    privacy_names: tuple[str, ...] = ()
    own_paths: tuple[str, ...] = ("laptop_backup", "home-backup", "gh-clones", "Machine_Backup")
    own_markers: tuple[str, ...] = ("daily scan report",)
    private_folders: tuple[str, ...] = ("cv", "Documents", "Attachments", "all unorganised files")
    categories: tuple = field(default_factory=lambda: tuple((n, tuple(p)) for n, p in TITLE_CATEGORIES))


def config_list(key: str, env: str | None = None, toml: Path | None = None) -> list[str]:
    """A list setting: environment variable (even an empty one) before file before nothing; blanks are dropped."""
    if env and env in os.environ:
        raw = os.environ[env].split(",")
    elif toml and toml.exists():
        got = tomllib.loads(toml.read_text()).get(key, [])
        raw = got.split(",") if isinstance(got, str) else got
    else:
        raw = []
    return [x.strip() for x in raw if x.strip()]


def title_categories(toml: Path) -> list[tuple[str, list[str]]]:
    """Categories and their phrases from a file with one list of phrases per category, in order of precedence."""
    return [(name, [p.strip() for p in phrases if p.strip()]) for name, phrases in tomllib.loads(toml.read_text()).items()]


def configured(toml: Path | None = None) -> Config:
    """Parameters with the owner's lists from the environment (DOCSTRATA_<NAME>, split at commas) or the file, where they are set there."""
    known = tomllib.loads(toml.read_text()) if toml and toml.exists() else {}
    names = ("personal_keywords", "privacy_names", "own_paths", "own_markers", "private_folders")
    env = {n: f"DOCSTRATA_{n.upper()}" for n in names}
    return Config(**{n: tuple(config_list(n, env[n], toml)) for n in names if env[n] in os.environ or n in known})
