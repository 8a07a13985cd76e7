"""Cross-reference: clusters of findings that share an advisory id, a title or a commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import severity_rank, text, title_key
from .graph import components
from .tables import join_by_group

CVE_ID, GHSA_ID, SHA = r"(?i)CVE-\d{4}-\d{4,7}", r"(?i)GHSA-[0-9a-z]{4}-[0-9a-z]{4}-[0-9a-z]{4}", r"\b[0-9a-f]{40}\b"


def keys(df: DataFrame, with_sha: bool = True) -> DataFrame:
    """(node, key): ids and title of a row within its platform, full commit hashes across platforms."""
    p = F.coalesce(F.col("source_platform"), F.lit(""))
    ids = F.concat_ws(" ", text("issue_id"), text("description"))

    def named(tag: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(ids, F.lit(pattern), 0), lambda v: F.concat_ws("|", F.lit(tag), p, F.upper(v)))

    own = [named("cve", CVE_ID), named("ghsa", GHSA_ID)]
    titled = F.when(title_key(F.col("title")).isNotNull(), F.array(F.concat_ws("|", F.lit("title"), p, title_key(F.col("title"))))).otherwise(F.array().cast("array<string>"))
    parts = [*own, titled]
    if with_sha:
        where = F.concat_ws(" ", text("introduced_in_commit"), text("source_url"), text("description"))
        parts.append(F.transform(F.regexp_extract_all(where, F.lit(SHA), 0), lambda v: F.concat(F.lit("sha|"), v)))
    return df.select(F.col("id").alias("node"), F.explode(F.array_distinct(F.flatten(F.array(*parts)))).alias("key"))


def clusters(df: DataFrame, with_sha: bool = True) -> DataFrame:
    """(id, cluster): the cluster is the smallest id of all rows linked; rows without any key are their own."""
    comp = components(keys(df, with_sha))
    return df.select("id").distinct().join(comp, F.col("id") == F.col("node"), "left").select("id", F.coalesce("comp", "id").alias("cluster"))


def members(df: DataFrame, with_sha: bool = True) -> DataFrame:
    """(id, rank, url, cluster): the rows as clusters hold them; rows are ordered by id, as tables have no row order."""
    x = df.select("id", severity_rank(F.col("severity")).alias("rank"), text("source_url").alias("url"))
    return x.join(clusters(df, with_sha), "id")


def representatives(df: DataFrame) -> DataFrame:
    """One row per cluster: its most severe row (smaller id on ties), its size, its addresses as JSON.

    Addresses are the distinct non-empty ones in the order of their first row;
    a row that is alone keeps its address even if that is empty. They are told
    apart per (cluster, address) before a cluster is brought together, so a
    cluster of many rows sends each address once per partition.
    """
    x = members(df)
    best = x.groupBy("cluster").agg(F.min(F.struct((-F.col("rank")).alias("r"), "id")).alias("best"), F.count("*").alias("n_rows"), F.min("url").alias("only"))
    urls = x.filter("url <> ''").groupBy("cluster", "url").agg(F.min("id").alias("first"))
    listed = urls.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "url"))), lambda u: u["url"]).alias("urls"))
    out = best.join(listed, "cluster", "left")
    evidence = F.when(F.col("n_rows") == 1, F.array("only")).otherwise(F.coalesce("urls", F.array().cast("array<string>")))
    return out.select("cluster", F.col("best.id").alias("kept_id"), "n_rows", F.to_json(evidence).alias("evidence"))


def deduplicated(df: DataFrame) -> DataFrame:
    """The representatives with all their columns and ``evidence``, in the order of their clusters' first rows."""
    r = representatives(df)
    return df.join(r.select(F.col("kept_id").alias("id"), "cluster", "evidence"), "id").orderBy("cluster").drop("cluster")


def dropped_rows(df: DataFrame) -> DataFrame:
    """(cluster, kept_id, dropped_id) of clusters of two or more: one row per dropped row, so that no cluster is one cell."""
    x = members(df)
    best = x.groupBy("cluster").agg(F.min(F.struct((-F.col("rank")).alias("r"), "id")).alias("best"), F.count("*").alias("n"))
    return join_by_group(x.select("id", "cluster"), best.filter("n > 1"), "cluster", "n").filter("id <> best.id").select("cluster", F.col("best.id").alias("kept_id"), F.col("id").alias("dropped_id"))


def dedup_stats(df: DataFrame) -> DataFrame:
    """One row: input and output rows, duplicates and their rate, clusters of two or more, cross-platform merges by commit."""
    c = clusters(df).groupBy("cluster").agg(F.count("*").alias("n"))
    x = c.agg(F.sum("n").alias("input_rows"), F.count("*").alias("output_rows"), F.sum(F.col("n") - 1).alias("duplicates_removed"), F.count_if(F.col("n") > 1).alias("clusters_deduped"))
    x = x.withColumn("dedup_rate_pct", F.round(F.coalesce(100 * F.try_divide("duplicates_removed", "input_rows"), F.lit(0.0)), 2))
    return x.crossJoin(merged_by_sha(df).select(F.col("merged").alias("sha_merges")))


def merged_by_sha(df: DataFrame) -> DataFrame:
    """How many clusters commit hashes join that ids and titles leave apart (one row)."""
    before, after = clusters(df, with_sha=False), clusters(df)
    return before.agg(F.count_distinct("cluster").alias("before")).crossJoin(after.agg(F.count_distinct("cluster").alias("after"))).withColumn("merged", F.col("before") - F.col("after"))
