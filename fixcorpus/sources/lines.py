"""Security lines of release notes and changelogs, with the lines around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import severity_in, strip
from ..operators.dedup import keep_first

BREAK = r"\r\n|[\n\r]"


def security_lines(notes: DataFrame, key: str, body: str, around: int = 3, skip_urgency: bool = True) -> DataFrame:
    """(key, pos, title, severity, line_hash, context) of every line that speaks of security.

    The line loses its markdown marks and must keep 10 characters; a line is
    kept once per key. The lines around it come from the array of lines of the
    same text, so no window over the exploded table is needed.
    """
    lines = F.split(F.coalesce(F.col(body), F.lit("")), BREAK)
    x = notes.select(F.col(key).alias("key"), lines.alias("lines")).select("key", "lines", F.posexplode("lines").alias("pos", "line"))
    title = strip(F.regexp_replace("line", r"^[#\-*>\s]+", ""))
    x = x.filter(P.hits(F.col("line"), P.SECURITY_LINE))
    if skip_urgency:
        x = x.filter(~P.hits(F.col("line"), P.URGENCY))
    start = F.greatest(F.col("pos") - around + 1, F.lit(1))
    context = F.array_join(F.slice("lines", start, F.col("pos") + around + 2 - start), "\n")
    x = x.select("key", "pos", title.alias("title"), severity_in(F.col("line")).alias("severity"), F.substring(F.sha2(strip(F.col("line")), 256), 1, 16).alias("line_hash"), context.alias("context")).filter(F.length("title") >= 10)
    return keep_first(x, ["key", "line_hash"], [F.asc("pos")])


def release_rows(releases: DataFrame) -> DataFrame:
    """Crawler rows of releases (source, repo, tag_name, body, html_url): a line once per tag, its context after ``[tag] ``."""
    key = F.struct("source", "repo", F.coalesce("tag_name", F.lit("unknown")).alias("tag"), F.coalesce("html_url", F.lit("")).alias("url"))
    x = security_lines(releases.withColumn("_key", key), "_key", "body")
    issue = F.concat(F.lit("RELEASE#"), F.col("key.tag"), F.lit("#"), F.substring("line_hash", 1, 8))
    return x.select(F.col("key.source").alias("source"), F.col("key.repo").alias("contest"), issue.alias("issue_id"), "severity", "title", F.concat(F.lit("["), F.col("key.tag"), F.lit("] "), "context").alias("description"), F.col("key.url").alias("source_url"), F.lit("").alias("introduced_in_commit"))


# fixed value: where a changelog is looked for, in order
CHANGELOG_PATHS = ("CHANGELOG.md", "ChangeLog.md", "docs/CHANGELOG.md", "docs/release.md", "CHANGES.md", "HISTORY.md", "releases/CHANGELOG.md")


def changelog_rows(files: DataFrame) -> DataFrame:
    """Crawler rows of changelogs (source, repo, branch, path, content): of each repository the first path that has any text.

    Unlike in releases, lines on urgency stay; a line is addressed by its number.
    """
    turn = F.array_position(F.array(*[F.lit(p) for p in CHANGELOG_PATHS]), F.col("path"))
    found = files.filter((turn > 0) & (F.coalesce("content", F.lit("")) != "")).withColumn("_turn", turn)
    one = keep_first(found, ["repo"], [F.asc("_turn"), F.asc_nulls_last("source"), F.asc_nulls_last("branch"), F.asc("content")])
    x = security_lines(one.withColumn("_key", F.struct("source", "repo", "branch", "path")), "_key", "content", skip_urgency=False)
    url = F.concat(F.lit("https://github.com/"), F.col("key.repo"), F.lit("/blob/"), F.col("key.branch"), F.lit("/"), F.col("key.path"), F.lit("#L"), (F.col("pos") + 1).cast("string"))
    return x.select(F.col("key.source").alias("source"), F.col("key.repo").alias("contest"), F.concat(F.lit("CHANGELOG#"), "line_hash").alias("issue_id"), "severity", "title", F.col("context").alias("description"), url.alias("source_url"), F.lit("").alias("introduced_in_commit"))


def earliest(lines: DataFrame, published: str, order: list[str]) -> DataFrame:
    """The first publication of each (wallet, title)."""
    return keep_first(lines, ["wallet", "title"], [F.asc_nulls_last(published), *[F.asc_nulls_last(c) for c in order]])
