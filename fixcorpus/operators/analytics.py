"""Summary tables: yields, matrices, coverage, histograms, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import repository, text
from .code import hunks_of, line_count
from .labels import file_list

LOC_EDGES = [0, 5, 10, 20, 30, 50, 100, 200, 500, 5000]


def top(df: DataFrame, column: str, k: int, without: tuple[str, ...] = ()) -> DataFrame:
    """The most frequent values, ties by name."""
    x = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*without)) if without else df.filter(F.col(column).isNotNull())
    return x.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def repo_yield(scores: DataFrame, least: int = 150) -> DataFrame:
    """Rows and hits per repository; a rate only where enough were judged."""
    x = scores.withColumn("repo", repository(F.col("source_url"))).filter("repo is not null")
    g = x.groupBy("repo").agg(F.count("*").alias("n"), F.count_if(F.col("silent_fix_prob") >= 0.7).alias("hits"))
    return g.withColumn("rate", F.when(F.col("n") >= least, F.round(F.col("hits") / F.col("n"), 6)))


def loc_histogram(vulns: DataFrame) -> DataFrame:
    """Changed code per fix in bins: lines of the side after the fix, clipped into the last bin."""
    x = vulns.select(line_count(hunks_of(F.col("post_fix_code"))).alias("loc")).filter("loc > 0")
    x = x.withColumn("loc", F.least("loc", F.lit(4999)))
    edge = F.lit(None).cast("int")
    for e in LOC_EDGES[:-1]:
        edge = F.when(F.col("loc") >= e, e).otherwise(edge)
    return x.groupBy(edge.alias("bin_from")).agg(F.count("*").alias("n"))


def loc_median(vulns: DataFrame) -> DataFrame:
    """One row: the exact median of lines after the fix, over fixes with code."""
    return vulns.select(line_count(hunks_of(F.col("post_fix_code"))).alias("loc")).filter("loc > 0").agg(F.median("loc").alias("median_loc"), F.count("*").alias("n"))


def counts_by(df: DataFrame, **by: Column) -> DataFrame:
    """(section, value, n) of several columns in one pass."""
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("section"), F.coalesce(c.cast("string"), F.lit("")).alias("value")) for s, c in by.items()])).alias("x")
    return df.select(each).groupBy("x.section", "x.value").agg(F.count("*").alias("n"))


def sets_compared(left: DataFrame, right: DataFrame, key: str, both: str, only_left: str, only_right: str) -> DataFrame:
    """One row: distinct keys in both tables and in one only, by one aggregation (no join)."""
    x = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r")))
    g = x.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return g.agg(F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias(both), F.count_if(F.col("r") == 0).alias(only_left), F.count_if(F.col("l") == 0).alias(only_right))


def files_touched(vulns: DataFrame) -> DataFrame:
    n = F.least(F.size(file_list(F.col("files_changed"))), F.lit(8))
    return vulns.select(n.alias("n_files")).groupBy("n_files").agg(F.count("*").alias("n"))


def matrix(df: DataFrame, row: Column, column: Column) -> DataFrame:
    return df.groupBy(row.alias("row_value"), column.alias("column_value")).agg(F.count("*").alias("n"))


def coverage(vulns: DataFrame) -> DataFrame:
    """One row: per cent of findings with each kind of evidence."""
    def share(c: Column, name: str) -> Column:
        return F.round(100 * F.avg(F.coalesce(c, F.lit(False)).cast("int")), 4).alias(name)

    def filled(c: str) -> Column:
        return F.trim(text(c)) != ""

    return vulns.agg(
        share(filled("fix_commit"), "fix_commit"),
        share(filled("introduced_in_commit"), "introduced_in_commit"),
        share(filled("files_changed") & (F.col("files_changed") != "[]"), "files_changed"),
        share(filled("pre_fix_code") & (F.col("pre_fix_code") != "[]"), "pre_fix_code"),
        share(filled("stride") & (F.col("stride") != "Other"), "stride"),
        share(filled("cwe_top25") & (F.col("cwe_top25") != "N/A"), "cwe_top25"),
        share(F.lower(text("severity")).isin("critical", "high", "medium", "low"), "rated"),
        share(F.col("silent_fix_prob").isNotNull(), "silent_fix_prob"),
    )


def confusion(predicted: Column, actual: Column) -> list[Column]:
    """Counts and ratios of a binary verdict; a ratio without cases is null."""
    tp, fp, fn, tn = F.count_if(predicted & actual), F.count_if(predicted & ~actual), F.count_if(~predicted & actual), F.count_if(~predicted & ~actual)
    return [tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"), F.round(F.try_divide(tp, tp + fp), 6).alias("precision"), F.round(F.try_divide(tp, tp + fn), 6).alias("recall"), F.round(F.try_divide(2 * tp, 2 * tp + fp + fn), 6).alias("f1"), F.round(F.try_divide(tp + tn, F.count("*")), 6).alias("accuracy")]


def dominance(df: DataFrame, column: Column) -> DataFrame:
    """One row: the largest contributor and its share."""
    g = df.groupBy(column.alias("value")).agg(F.count("*").alias("n"))
    return g.agg(F.max("n").alias("largest"), F.sum("n").alias("total"), F.count("*").alias("n_values")).withColumn("share", F.round(F.try_divide("largest", "total"), 6))


def sample_per_class(df: DataFrame, key: str, cls: Column, n: int, seed: int) -> DataFrame:
    """Up to n rows per class in a fixed pseudo-random order; the smallest draws are taken per partition first."""
    x = df.withColumn("class", cls).withColumn("draw", F.md5(F.concat_ws(":", F.lit(seed), F.col(key))))
    w = Window.partitionBy("class").orderBy("draw", key)
    return x.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).drop("rn")


def platform_layers(vulns: DataFrame, layers: list[str], least: int = 5) -> DataFrame:
    """Findings per platform and layer as a table, platforms with more than ``least``."""
    p = F.lower(F.trim(text("source_platform")))
    x = vulns.withColumn("wallet_platform", p).groupBy("wallet_platform").pivot("layer", layers).agg(F.count(F.lit(1)))
    x = x.na.fill(0, layers).withColumn("total", sum((F.col(c) for c in layers), F.lit(0)))
    return x.filter(F.col("total") > least)


def prevalence(vulns: DataFrame) -> DataFrame:
    """One row: per cent of findings with an advisory id, rated without one (never below 0), and silent."""
    named = F.concat_ws(" ", text("title"), text("description")).rlike("CVE-|GHSA-")
    rated = F.lower(text("severity")).isin("critical", "high", "medium", "low")
    x = vulns.agg((100 * F.avg(named.cast("int"))).alias("i"), (100 * F.avg(rated.cast("int"))).alias("r"))
    return x.select(F.round("i", 4).alias("with_id"), F.round(F.greatest(F.col("r") - F.col("i"), F.lit(0.0)), 4).alias("rated_only"), F.round(100 - F.col("r"), 4).alias("silent"))


#: Impact by the area's family, and channels by attack path (parameters of the summaries).
IMPACT = {"key": "funds", "sign": "funds", "approval": "funds", "mpc": "funds", "contract": "funds", "transport": "deception", "ui": "deception", "platform": "exposure", "firmware": "exposure"}
CHANNEL = {
    "malicious_dapp": "web", "phishing_site": "web", "malicious_signing_request": "request", "malicious_deeplink_or_qr": "request", "malicious_pairing_session": "session", "malicious_contract_or_token": "chain",
    "compromised_dependency": "build", "physical_device_access": "device", "compromised_host": "device", "malicious_local_app": "device", "malformed_input": "input", "hostile_network_or_rpc": "network", "malicious_peer": "network",
}


def mapped_counts(df: DataFrame, value: Column, names: dict[str, str], without_rest: bool = True) -> DataFrame:
    """Rows per name of a mapped value; unmapped ones are ``other`` or left out."""
    name = F.lit("other")
    for k, v in names.items():
        name = F.when(value == k, v).otherwise(name)
    x = df.groupBy(name.alias("name")).agg(F.count("*").alias("n"))
    return x.filter("name <> 'other'") if without_rest else x
