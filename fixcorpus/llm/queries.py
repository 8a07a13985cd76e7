"""Queries of the training-data operators: name -> (spark, folder of tables) -> result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import capping, components, mixing, mojibake, nearedit, packing, personal, residue, secrets, truncation
from .common import read

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    found = secrets.secret_values(read(spark, d, "wallet_vulns")).filter("file_path is not null and id is not null")
    return found.select("id", "field_name", "file_path").distinct()


def p1_masked(spark: SparkSession, d: str) -> DataFrame:
    return secrets.redact_code(read(spark, d, "wallet_vulns"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return nearedit.near_pairs(read(spark, d, "wallet_vulns"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return nearedit.near_groups(read(spark, d, "wallet_vulns"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return components.fix_groups(read(spark, d, "wallet_vulns")).select("id", "group_id")


def p3_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    g = components.fix_groups(read(spark, d, "wallet_vulns"))
    return g.select("group_id", "group_size").distinct().groupBy("group_size").agg(F.count("*").alias("n_groups"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return capping.platform_cap(read(spark, d, "wallet_vulns")).filter(~F.col("kept")).select("id").distinct()


def p4_by_year(spark: SparkSession, d: str) -> DataFrame:
    """Kept rows per platform and year, the platform's slots spread evenly over the years."""
    kept = capping.platform_cap(read(spark, d, "wallet_vulns"), stratum=F.substring(F.trim(F.col("scraped_at")), 1, 4), even=True)
    return kept.groupBy("contributor", "stratum").agg(F.count("*").alias("n_rows"), F.count_if("kept").alias("n_kept"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue_fields(read(spark, d, "wallet_vulns")).select("id", "field_name").distinct()


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    return residue.without_residue(read(spark, d, "wallet_vulns"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_values(read(spark, d, "wallet_vulns"))[0].select("id", "field_name").distinct()


def p6_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_rates(read(spark, d, "wallet_vulns"))


def p6_limits(spark: SparkSession, d: str) -> DataFrame:
    limits = truncation.cut_values(read(spark, d, "wallet_vulns"))[1]
    names = F.array(*[F.lit(m) for m in truncation.MEASURES])
    return limits.select("field_name", F.element_at(names, (F.col("measure") + 1).cast("int")).alias("measure"), "length", "n")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    items = personal.personal_items(read(spark, d, "wallet_vulns"), read(spark, d, "name_lexicon"))
    return items.select("id", "field_name", "pii_kind").distinct()


def p7_sanitised(spark: SparkSession, d: str) -> DataFrame:
    return personal.sanitised(read(spark, d, "wallet_vulns"), read(spark, d, "name_lexicon"))


def p8_sequences(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read(spark, d, "documents"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.packing_report(read(spark, d, "documents"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(read(spark, d, "documents"), read(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(read(spark, d, "documents"), read(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.restore(read(spark, d, "documents")).select("doc_id").distinct()


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.restore(read(spark, d, "documents")).select("doc_id", "chains", "text")


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_masked, p2_found, p2_groups, p3_found, p3_group_sizes, p4_found, p4_by_year, p5_found, p5_clean, p6_found, p6_rates, p6_limits, p7_found, p7_sanitised, p8_sequences, p8_report, p9_mix, p9_shares, p10_found, p10_restored)}
