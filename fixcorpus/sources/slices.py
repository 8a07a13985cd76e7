"""Slices of a crawl: by label, by word in title or body, capped and united."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import vocabulary as V
from ..functions.text import text

# fixed value: what a title must name to be taken where a repository has no labels
SECURITY_TITLE = r"\b(?:security|vuln(?:erability)?|CVE-\d{4}-\d+|DoS|panic|crash|RCE|memory\s+leak|integer\s+overflow|race\s+condition)\b"


def existing_labels(wanted: DataFrame, there: DataFrame, skip: list[str] | None = None) -> DataFrame:
    """(repo, label): wanted labels that a repository has, whatever their case, once, spelled as first wanted.

    wanted: (repo, label, turn), turn being the order in which labels are wanted.
    """
    have = there.select("repo", F.lower("label").alias("low")).distinct()
    first = wanted.groupBy("repo", F.lower("label").alias("low")).agg(F.min(F.struct("turn", "label")).alias("w"))
    x = first.join(have, ["repo", "low"], "left_semi").select("repo", F.col("w.label").alias("label"))
    return x.filter(~F.col("label").isin(*skip)) if skip else x


def by_label(changes: DataFrame, labels: DataFrame) -> DataFrame:
    """Merged changes (repo, number, label, ...) under a label of ``existing_labels``; a number once, ``contest`` the label."""
    x = changes.filter("merged").withColumn("low", F.lower("label")).join(labels.select("repo", F.lower("label").alias("low"), F.col("label").alias("contest")), ["repo", "low"])
    w = Window.partitionBy("repo", "number").orderBy("contest")
    return x.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn", "low", "label")


def by_title(changes: DataFrame, cap: int = 2000) -> DataFrame:
    """Merged changes whose title speaks of security, a number once per repository, the newest ``cap`` (the cap is the feature)."""
    x = changes.filter(F.col("merged") & P.hits(F.col("title"), SECURITY_TITLE)).dropDuplicates(["repo", "number"])
    w = Window.partitionBy("repo").orderBy(F.desc("number"))
    return x.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= cap).drop("rn")


def by_body_word(findings: DataFrame, words: list[str]) -> DataFrame:
    """(id, contest): findings whose description names a word, marked with the first of them."""
    found = P.keyword_list(F.col("description"), words)
    return findings.select("id", F.try_element_at(found, F.lit(1)).alias("word")).filter("word is not null").select("id", F.concat(F.lit("body_kw:"), "word").alias("contest"))


def direct(changes: DataFrame, terms: list[str] | None = None, looked_at: int = 1000) -> DataFrame:
    """Changes whose title or the start of the body (the slice looks no further) names a term as a whole word."""
    hay = F.concat_ws(" ", text("title"), F.substring(text("description"), 1, looked_at))
    return changes.filter(P.hits(hay, P.alternation(terms or V.CORE_TERMS, P.loose)))


def first_term(changes: DataFrame, terms: list[str] | None = None) -> DataFrame:
    """(id, term): each change once, under the first term in order that finds it."""
    found = P.keyword_list(F.concat_ws(" ", text("title"), text("description")), terms or V.CORE_TERMS)
    return changes.select("id", F.try_element_at(found, F.lit(1)).alias("term")).filter("term is not null")


def united(slices: list[DataFrame], key: list[str], order: Column, cap: int | None = None) -> DataFrame:
    """Slices one after the other, a key once (the earlier slice wins), at most ``cap`` rows per source."""
    x = None
    for i, s in enumerate(slices):
        s = s.withColumn("slice", F.lit(i))
        x = s if x is None else x.unionByName(s, allowMissingColumns=True)
    first = Window.partitionBy(*key).orderBy("slice", order)
    x = x.withColumn("rn", F.row_number().over(first)).filter("rn = 1")
    if cap is not None:
        x = x.withColumn("rn", F.row_number().over(Window.partitionBy("source").orderBy("slice", order))).filter(F.col("rn") <= cap)
    return x.drop("rn")


def dominance_cap(rows: DataFrame, dominant: Column, permille: int, key: str, seed: int = 42) -> DataFrame:
    """All other rows, and of the dominant source at most permille/1000 of all, drawn by hash: the draw needs no order of rows."""
    cap = rows.count() * permille // 1000
    some = rows.filter(dominant).withColumn("draw", F.md5(F.concat_ws(":", F.lit(seed), F.col(key))))
    # at most 65,536 counts by the start of the draw tell where the cap falls; only that one start is sorted
    left, edge = cap, "g"
    for start, n in sorted((r[0], r[1]) for r in some.groupBy(F.substring("draw", 1, 4)).agg(F.count("*")).collect()):
        if n > left:
            edge = start
            break
        left -= n
    below = some.filter(F.substring("draw", 1, 4) < edge)
    at = some.filter(F.substring("draw", 1, 4) == edge).orderBy("draw", key).limit(left)
    others = rows.filter(~F.coalesce(dominant, F.lit(False)))
    return others.unionByName(below.drop("draw")).unionByName(at.drop("draw"))
