"""Crawler rows to findings: alias columns, severities, identifiers, merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .dedup import keep_first


def findings(rows: DataFrame, domain: str = "wallet") -> DataFrame:
    """Unified findings of crawler rows; rows without title and description are dropped, an id is kept once.

    Rows of one id are told apart by their time (earliest first) and content,
    as a table has no source order.
    """
    platform = F.lower(T.first_present(rows, T.PLATFORM_COLUMNS))
    x = rows.select(
        platform.alias("source_platform"),
        T.first_present(rows, T.CONTEST_COLUMNS).alias("contest"),
        T.first_present(rows, T.ISSUE_COLUMNS).alias("issue_id"),
        T.capitalised(T.first_present(rows, ("severity",))).alias("severity"),
        T.first_present(rows, ("title",)).alias("title"),
        T.first_present(rows, T.DESCRIPTION_COLUMNS).alias("description"),
        T.first_present(rows, ("source_url",)).alias("source_url"),
        T.first_present(rows, ("introduced_in_commit",)).alias("introduced_in_commit"),
        T.first_present(rows, ("scraped_at",)).alias("scraped_at"),
    ).filter("title <> '' or description <> ''")
    x = x.withColumn("contest_slug", T.contest_slug(F.col("contest"))).withColumn("domain", F.lit(domain))
    x = x.withColumn("id", T.canonical_id(F.col("source_platform"), F.col("contest_slug"), F.col("issue_id"), F.col("title"), F.col("description")))
    return keep_first(x, ["id"], [F.asc(c) for c in ("scraped_at", "title", "description", "severity", "source_url", "introduced_in_commit", "contest", "source_platform", "issue_id")])


def merge_rows(rows: DataFrame, domain: str = "wallet") -> DataFrame:
    """Crawler rows in the merge schema: cut texts, merge id, defaults; rows without source or issue are dropped."""
    source, issue = T.text("source"), T.text("issue_id")
    x = rows.filter((T.strip(source) != "") & (T.strip(issue) != ""))
    return x.select(
        T.merge_id(source, T.strip(issue)).alias("id"),
        F.lower(T.strip(source)).alias("source_platform"),
        T.strip(issue).alias("issue_id"),
        T.merge_severity(F.col("severity")).alias("severity"),
        T.strip(F.substring(T.text("title"), 1, 500)).alias("title"),
        T.strip(F.substring(T.text("description"), 1, 2000)).alias("description"),
        T.text("source_url").alias("source_url"),
        F.lit(domain).alias("domain"),
        F.lit("Other").alias("stride"),
        F.lit("N/A").alias("cwe_top25"),
    )


def merge_new(rows: DataFrame, existing: DataFrame, compat: bool = False) -> DataFrame:
    """Merge rows whose id is not there yet; each new id once unless ``compat``."""
    new = merge_rows(rows)
    if not compat:
        new = keep_first(new, ["id"], [F.asc(c) for c in ("title", "description", "severity", "source_url", "source_platform", "issue_id")])
    return new.join(existing.select("id"), "id", "left_anti")


def single_domain(df: DataFrame) -> str:
    """The one domain a table holds; anything else is an error."""
    found = [r[0] for r in df.filter("domain is not null and trim(domain) <> ''").select("domain").distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"expected one domain, found {found}")
    return found[0]
