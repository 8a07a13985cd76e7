"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import HOT_ROWS, join_by_group, materialize, release, scratch_dir, spread

__all__ = ["HOT_ROWS", "join_by_group", "materialize", "norm", "parts", "read", "release", "scratch_dir", "spread"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))
    return spread(df) if table in ("wallet_vulns", "documents") else df


def norm(c: Column) -> Column:
    """Trimmed, lower case."""
    return F.lower(F.trim(c))


def parts(df: DataFrame, rows_each: int, rows: int) -> int:
    """Number of partitions so that each holds about ``rows_each`` rows."""
    return max(1, -(-rows // rows_each))
