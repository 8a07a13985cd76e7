"""The gate on a stream of findings: the same row functions, de-duplication inside a watermark, windowed counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import gate


def gated(stream: DataFrame, registry: DataFrame, event_time: str = "scraped_ts", delay: str = "1 day") -> DataFrame:
    """Findings of a stream with their drop stage; an id counts once within the watermark."""
    x = stream.withColumn(event_time, F.try_to_timestamp(F.col("scraped_at"))).withWatermark(event_time, delay)
    x = x.dropDuplicatesWithinWatermark(["id"])
    return gate.judged(x, registry, keep=(event_time,))


def stage_counters(stream: DataFrame, registry: DataFrame, window: str = "30 days", delay: str = "1 day") -> DataFrame:
    """Drop-stage counts per window of event time."""
    x = stream.withColumn("scraped_ts", F.try_to_timestamp(F.col("scraped_at"))).withWatermark("scraped_ts", delay)
    kept = gate.judged(x, registry, keep=("scraped_ts",))
    stage = F.coalesce("drop_stage", F.lit("kept"))
    return kept.groupBy(F.window("scraped_ts", window), stage.alias("stage")).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), "stage", "n")


def late_commits(stream: DataFrame, delay: str = "30 days") -> DataFrame:
    """Commits per wallet and month of commit time from a stream in which rows arrive late."""
    x = stream.withWatermark("committed_at", delay)
    return x.groupBy(F.window("committed_at", "30 days"), "wallet").agg(F.count("*").alias("n"), F.approx_count_distinct("sha").alias("n_commits")).select(F.col("window.start").alias("window_start"), "wallet", "n", "n_commits")
