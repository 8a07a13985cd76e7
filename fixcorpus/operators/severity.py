"""Where a severity comes from, and what bounds an estimate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import capitalised, text
from ..functions.vocabulary import RATED
from .dedup import keep_first
from .tables import dimension

ESTIMATE_COLUMNS = ("severity_estimated", "severity_source", "impact_type", "reachability", "blast_radius", "severity_why")


def best_estimates(estimates: DataFrame) -> DataFrame:
    """One estimate per id, by a total order of its columns (nulls last)."""
    return keep_first(estimates.filter("id is not null"), ["id"], [F.asc_nulls_last(c) for c in ESTIMATE_COLUMNS])


def is_dependency(title: Column, url: Column) -> Column:
    return P.hits(text(title), P.DEPENDENCY_TITLE) | text(url).rlike(r"CHANGELOG|/releases/|nvd\.nist\.gov|rustsec")


def guardrail(estimate: Column, impact: Column, reach: Column, radius: Column, minor: Column) -> Column:
    """Local or harmless is not eligible; a single project's outage on a minor project is at most medium."""
    est = F.lower(F.trim(text(estimate)))
    local = (reach == "local_internal") | impact.isin("local_only", "none")
    capped = (radius == "client_specific") & est.isin("critical", "high") & (impact == "liveness_dos") & minor
    return F.when(F.coalesce(local, F.lit(False)), "not-eligible").when(F.coalesce(capped, F.lit(False)), "medium").otherwise(F.coalesce(F.nullif(est, F.lit("")), F.lit("not-eligible")))


def provenance(vulns: DataFrame, estimates: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, severity_final, provenance): graded by people, by an upstream score, by estimate, or not at all."""
    est = best_estimates(estimates).select("id", F.col("severity_estimated").alias("est"), "impact_type", "reachability", "blast_radius")
    dims = registry.select(F.lower(F.trim("slug")).alias("slug"), (F.col("tier") >= 3).alias("minor")).dropDuplicates(["slug"])
    x = vulns.select("id", F.lower(F.trim(text("source_platform"))).alias("slug"), "title", "source_url", "severity").join(est, "id", "left").join(dimension(dims), "slug", "left")
    sev = F.lower(F.trim(text("severity")))
    graded, dep = sev.isin(*RATED), is_dependency(F.col("title"), F.col("source_url"))
    bounded = guardrail(F.col("est"), F.col("impact_type"), F.col("reachability"), F.col("blast_radius"), F.coalesce("minor", F.lit(False)))
    has = F.col("est").isNotNull()
    final = F.when(graded & ~dep, sev).when(dep, F.when(graded, sev).otherwise("not-eligible")).when(has, bounded).otherwise("")
    src = F.when(graded & ~dep, "bounty-graded").when(dep, "upstream-cvss").when(has, "llm-estimated").otherwise("unassessed")
    return x.select("id", final.alias("severity_final"), src.alias("provenance"))


def title_case(c: Column) -> Column:
    """The four rated tiers with a capital letter, everything else as it is."""
    return F.when(F.lower(c).isin(*RATED), capitalised(c)).otherwise(c)


def disagreements(vulns: DataFrame, estimates: DataFrame, k: int = 12) -> DataFrame:
    """The most frequent pairs of a graded tier and another estimated one (top k is the feature)."""
    x = vulns.select("id", F.lower(F.trim(text("severity"))).alias("graded")).join(best_estimates(estimates).select("id", F.lower(F.trim(text("severity_estimated"))).alias("estimated")), "id")
    x = x.filter(F.col("graded").isin(*RATED) & (F.col("graded") != F.col("estimated")))
    return x.groupBy("graded", "estimated").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "graded", "estimated").limit(k)


def agreement(vulns: DataFrame, estimates: DataFrame) -> DataFrame:
    """One row: graded findings with an estimate, how many agree exactly and within one tier."""
    rank = {"critical": 4, "high": 3, "medium": 2, "low": 1}

    def tier(c: Column) -> Column:
        out = F.lit(0)
        for name, r in rank.items():
            out = F.when(c == name, r).otherwise(out)
        return out

    x = vulns.select("id", F.lower(F.trim(text("severity"))).alias("a")).join(best_estimates(estimates).select("id", F.lower(F.trim(text("severity_estimated"))).alias("b")), "id").filter(F.col("a").isin(*rank))
    apart = F.abs(tier(F.col("a")) - tier(F.col("b")))
    return x.agg(F.count("*").alias("n"), F.count_if(apart == 0).alias("exact"), F.count_if(apart <= 1).alias("within_one"), F.count_if(tier(F.col("b")) == 0).alias("not_eligible"))
