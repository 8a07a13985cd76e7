"""Keep-first and keep-best de-duplication with a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: list[Column | str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (which should be total)."""
    keys = [F.col(k) if isinstance(k, str) else k for k in key]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def fix_commit_key(df: DataFrame) -> DataFrame:
    """Rows of one platform with the same fix commit become one: the row with code, a change's address, a better tier, a longer text.

    Rows without a commit all stay. Score ties go to the smaller id.
    """
    tier = F.when(F.col("authority_tier") == "A_authoritative", 3.0).when(F.col("authority_tier") == "B_corroborated", 2.0).when(F.col("authority_tier") == "A_dependency", 1.5).otherwise(1.0)
    has_code = F.coalesce(F.col("pre_fix_code"), F.lit("")).isin("", "[]")
    score = F.when(has_code, 0.0).otherwise(8.0) + F.when(F.coalesce(F.col("source_url"), F.lit("")).rlike("/(pull|commit)/"), 4.0).otherwise(0.0) + tier + F.least(F.length(F.coalesce(F.col("description"), F.lit(""))), F.lit(2000)) / 1000.0
    key = F.concat(F.col("source_platform"), F.lit("|"), F.nullif(F.col("fix_commit"), F.lit("")))
    scored = df.withColumn("_key", F.coalesce(key, F.concat(F.lit("id|"), F.col("id")))).withColumn("dedup_score", score)
    return keep_first(scored, ["_key"], [F.desc("dedup_score"), F.asc("id")]).drop("_key")
