"""Text normalisation and identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vocabulary import ISSUE_PREFIXES, SEVERITY_RANK

CONTEST_COLUMNS = ("contest", "contest_repo", "contest_name", "contest_id", "contest_slug")
ISSUE_COLUMNS = ("issue_id", "finding_id")
PLATFORM_COLUMNS = ("source_platform", "source", "platform")
DESCRIPTION_COLUMNS = ("description", "description_excerpt")


def text(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def present(c: Column) -> Column:
    """Stripped text; null where it is blank or spells ``nan``."""
    s = strip(c)
    return F.when((s != "") & (F.lower(s) != "nan"), s)


def first_present(df: DataFrame, names: tuple[str, ...]) -> Column:
    """The first of several alias columns that holds something; absent columns are passed over."""
    have = [present(F.col(n)) for n in names if n in df.columns]
    return F.coalesce(*have, F.lit("")) if have else F.lit("")


def capitalised(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1_000_000)))


def contest_slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(strip(c)), r"[^a-z0-9.\-]+", "-"), r"^-+|-+$", "")


def canonical_id(platform: Column, slug: Column, issue: Column, title: Column, description: Column) -> Column:
    """platform:contest:issue where an issue is known, else a hash of the texts."""
    number = F.regexp_replace(issue, r"^#+", "")
    hashed = F.concat(F.lit("unknown:"), F.substring(F.sha2(F.concat(title, F.lit("\n"), description), 256), 1, 16))
    return F.when(number != "", F.concat_ws(":", platform, slug, number)).otherwise(hashed)


def merge_id(source: Column, issue: Column) -> Column:
    return F.substring(F.md5(F.concat_ws(":", source, issue)), 1, 16)


def commit_row_id(wallet: Column, sha: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws(":", wallet, sha)), 1, 16)


def merge_severity(c: Column) -> Column:
    """Only known tiers in their exact spelling pass; ``critical`` of any case is High, the rest Info, blank Unrated."""
    s = F.coalesce(strip(c), F.lit(""))
    known = [k for k in SEVERITY_RANK if k]
    return F.when(s == "", "Unrated").when(s.isin(*known), s).when(F.lower(s) == "critical", "High").otherwise("Info")


def severity_rank(c: Column) -> Column:
    out = F.lit(0)
    for name, rank in SEVERITY_RANK.items():
        if name:
            out = F.when(F.coalesce(c, F.lit("")) == name, rank).otherwise(out)
    return out


def issue_kind(c: Column) -> Column:
    s = text(c)
    out = F.lit("unknown")
    for p in reversed(ISSUE_PREFIXES):
        out = F.when(s.startswith(p), p.rstrip("#-")).otherwise(out)
    return out


def severity_in(c: Column) -> Column:
    """The first severity word of a text; critical counts as High, none as Info."""
    w = F.regexp_extract(c, r"(?iUd)\b(Critical|High|Medium|Low)\b", 1)
    return F.when(w == "", "Info").when(F.lower(w) == "critical", "High").otherwise(capitalised(w))


def title_key(c: Column) -> Column:
    """Lower case without ASCII punctuation, its first 60 characters; null where nothing is left."""
    plain = F.trim(F.translate(F.lower(text(c)), "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", ""))
    key = F.substring(plain, 1, 60)
    return F.when(key != "", key)


def first_semver(c: Column) -> Column:
    """The first part of a version range that starts with a digit once operators are off."""
    parts = F.transform(F.split(text(c), r"[\s,|&]+"), lambda p: F.regexp_replace(p, r"^[<>=^~!]+", ""))
    return F.coalesce(F.try_element_at(F.filter(parts, lambda p: p.rlike(r"^\d")), F.lit(1)), F.lit(""))


def fix_commit(url: Column) -> Column:
    return F.regexp_extract(text(url), r"(?i)/commit/([0-9a-f]{7,40})", 1)


def full_sha(url: Column) -> Column:
    """What stands after the last slash of an address."""
    return F.substring_index(text(url), "/", -1)


def repository(url: Column) -> Column:
    """owner/name of a forge address; null if there is none."""
    return F.nullif(F.regexp_extract(text(url), r"https?://(?:www\.)?[^/]+/([^/]+/[^/?#]+)", 1), F.lit(""))


def classify_403(body: Column) -> Column:
    low = F.lower(text(body))
    return F.when(low.contains("secondary rate limit") | low.contains("abuse"), "secondary").when(low.contains("rate limit"), "primary").otherwise("auth")


def http_status(stderr: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(text(stderr), r"HTTP (\d{3})", 1), F.lit("")), F.nullif(F.regexp_extract(text(stderr), r"\"status\":\s*\"?(\d{3})", 1), F.lit("")))
