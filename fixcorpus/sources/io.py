"""Tables in and out: Parquet, CSV folders, previews, manifests, partitioned publishing."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREVIEW = ("id", "source_platform", "severity", "title", "confidence")


def read_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Crawler files with quoted line breaks and cells up to 8 MiB; all columns are text, ``file_name`` tells the order."""
    df = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("maxCharsPerColumn", 8 << 20).option("unescapedQuoteHandling", "STOP_AT_DELIMITER").csv(paths)
    return df.withColumn("file_name", F.col("_metadata.file_name"))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_csv_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    """All CSV files of the folders that exist, on any file system that Spark reads."""
    found: list[str] = []
    for d in folders:
        fs, p = _fs(spark, d.rstrip("/") + "/*.csv")
        found += [s.getPath().toString() for s in fs.globStatus(p) or []]
    if not found:
        raise FileNotFoundError(f"no CSV in {folders}")
    return read_csv(spark, sorted(found))


def load_findings(spark: SparkSession, path: str, domain: str | None = None, repo: str | None = None, aliases: bool = True) -> DataFrame:
    """Curated findings, optionally of one domain or platform, with ``source`` as an alias of the platform."""
    df = spark.read.parquet(path)
    if domain is not None:
        df = df.filter(F.col("domain") == domain)
    if repo is not None:
        df = df.filter(F.col("source_platform") == repo)
    return df.withColumn("source", F.col("source_platform")) if aliases and "source" not in df.columns else df


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def preview(df: DataFrame) -> DataFrame:
    return df.select(*[F.substring("title", 1, 70).alias("title") if c == "title" else c for c in PREVIEW])


#: Most values of a column that a manifest lists.
MANIFEST_VALUES = 10_000


def manifest(df: DataFrame, columns: list[str]) -> dict:
    """Row count, number of values and counts per value of some low-cardinality columns, in one pass.

    A column with more than MANIFEST_VALUES values is an error, as its counts
    are no summary.
    """
    x = df.select(*columns)
    g = x.groupingSets([*[[c] for c in columns], []], *columns).agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    rows = g.limit(len(columns) * MANIFEST_VALUES + 2).collect()
    out: dict = {c: {} for c in columns}
    for r in sorted(rows, key=lambda r: -r["n"]):
        for i, c in enumerate(columns):
            if r["g"] == (1 << len(columns)) - 1 - (1 << (len(columns) - 1 - i)):
                out[c][str(r[c])] = r["n"]
    if any(len(v) > MANIFEST_VALUES for v in out.values()) or len(rows) > len(columns) * MANIFEST_VALUES + 1:
        raise ValueError(f"a column of {columns} has more than {MANIFEST_VALUES} values")
    out["rows"] = next((r["n"] for r in rows if r["g"] == (1 << len(columns)) - 1), 0)
    return out


def write_manifest(found: dict, path: str, spark: SparkSession | None = None) -> None:
    """Written beside and then renamed, so that no reader sees half of it; on any file system where a session is given."""
    body = json.dumps(found, indent=2, ensure_ascii=False)
    if spark is None:
        p = Path(path)
        part = p.with_suffix(".part")
        part.write_text(body)
        part.replace(p)
        return
    fs, target = _fs(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(path + ".part")
    out = fs.create(part, True)
    out.write(bytearray(body.encode()))
    out.close()
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(part, target)


def card(name: str, found: dict) -> str:
    """A short description of a published table: its name, rows and largest values per column."""
    lines = [f"# {name}", "", f"{found['rows']} rows."]
    for c, values in found.items():
        if isinstance(values, dict):
            lines += ["", f"## {c}", "", *[f"- {k}: {n}" for k, n in list(values.items())[:20]]]
    return "\n".join(lines) + "\n"


_NAME = re.compile(r"^[A-Za-z0-9][\w.-]*/[A-Za-z0-9][\w.-]*$")
_DOMAIN = re.compile(r"^[a-z][a-z0-9_]*$")


def publish(df: DataFrame, folder: str, name: str, owner: str | None = None, dry_run: bool = False) -> list[str]:
    """Rows by domain, only the domains at hand overwritten; the list of them."""
    if not _NAME.match(name) or (owner and name.split("/")[0] != owner):
        raise ValueError(f"not a publishable name: {name}")
    domains = sorted(r[0] for r in df.select("domain").distinct().collect() if r[0])
    if bad := [d for d in domains if not _DOMAIN.match(d)]:
        raise ValueError(f"not domains: {bad}")
    if not dry_run:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("domain").parquet(folder)
    return [f"{folder}/domain={d}" for d in domains]
