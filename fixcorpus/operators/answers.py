"""Answers of a model as a table: extraction, validation, acceptance, alignment. Calls stay outside."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vocabulary import STRIDE


def balanced_object(answer: str | None, field: str) -> str | None:
    """The first balanced JSON object of an answer that has a field; braces inside strings don't count."""
    if not answer:
        return None
    decoder = json.JSONDecoder()
    at = answer.find("{")
    while at >= 0:
        try:
            value, _ = decoder.raw_decode(answer, at)
            if isinstance(value, dict) and field in value:
                return json.dumps(value, separators=(",", ":"), sort_keys=True)
        except ValueError:
            pass
        at = answer.find("{", at + 1)
    return None


def extract(answers: DataFrame, column: str, field: str) -> DataFrame:
    """Adds ``parsed``: the object as text, null where none was found (those are asked again)."""

    @F.pandas_udf("string")
    def found(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            yield s.map(lambda x: balanced_object(x, field))

    return answers.withColumn("parsed", found(F.col(column)))


def accept(parsed: DataFrame) -> DataFrame:
    """Predictions whose verdict agrees with their confidence; the probability is the confidence, never inverted."""
    x = parsed.withColumn("p", F.from_json("parsed", "is_security_fix boolean, confidence double, vuln_class string, reason string")).filter("p.is_security_fix is not null and p.confidence is not null")
    return x.filter(F.col("p.is_security_fix") == (F.col("p.confidence") > 0.5)).select("source_url", F.col("p.confidence").alias("silent_fix_prob"), F.col("p.is_security_fix").cast("int").alias("is_security_fix"), "p.vuln_class", "p.reason", "model")


def flat_answer(answer: Column, labels: list[str]) -> Column:
    """The first object without inner braces that has a label: (label, root_cause, attack_path, cwe); what isn't valid is null."""
    o = F.from_json(F.regexp_extract(F.coalesce(answer, F.lit("")), r'(?s)\{[^{}]*"label"[^{}]*\}', 0), "label string, root_cause string, attack_path string, cwe string")
    cwe = F.when(o["cwe"].rlike(r"(?i)^CWE-\d+$"), o["cwe"])
    return F.struct(F.when(o["label"].isin(*labels), o["label"]).alias("label"), o["root_cause"].alias("root_cause"), o["attack_path"].alias("attack_path"), cwe.alias("cwe"))


def attach(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Rows with the classes of a checkpoint (id, stride, cwe); rows that it lacks have Other and N/A."""
    one = done.groupBy("id").agg(F.min(F.struct(F.coalesce("stride", F.lit("Other")).alias("stride"), F.coalesce("cwe", F.lit("N/A")).alias("cwe"))).alias("d"))
    x = rows.drop("stride", "cwe_top25").join(one, "id", "left")
    return x.withColumn("stride", F.coalesce("d.stride", F.lit("Other"))).withColumn("cwe_top25", F.coalesce("d.cwe", F.lit("N/A"))).drop("d")


def still_to_do(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done.select(key), key, "left_anti")


def enum_answer(answer: Column) -> Column:
    """A fenced single answer as (stride, cwe); unknown values become Other and N/A."""
    plain = F.regexp_replace(F.coalesce(answer, F.lit("")), r"(?m)^\s*```(?:json)?\s*$|```(?:json)?", "")
    o = F.from_json(plain, "stride string, cwe_top25 string", {"mode": "PERMISSIVE"})
    stride = F.when(o["stride"].isin(*STRIDE), o["stride"]).otherwise("Other")
    return F.struct(stride.alias("stride"), F.when(o["cwe_top25"].rlike(r"^CWE-\d+$"), o["cwe_top25"]).otherwise("N/A").alias("cwe_top25"))


def align_batch(batches: DataFrame) -> DataFrame:
    """(batch, i, stride, cwe): exactly n rows per batch; answers by their index or else position, others default."""
    items = F.from_json("answer", "array<struct<i:int,stride:string,cwe_top25:string>>")
    given = batches.select("batch", "n", F.posexplode_outer(items).alias("pos", "x")).select("batch", F.coalesce("x.i", "pos").alias("i"), F.col("x.stride").alias("s"), F.col("x.cwe_top25").alias("c")).filter("i is not null")
    given = given.groupBy("batch", "i").agg(F.min("s").alias("s"), F.min("c").alias("c"))
    rows = batches.select("batch", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    x = rows.join(given, ["batch", "i"], "left")
    return x.select("batch", "i", F.when(F.col("s").isin(*STRIDE), F.col("s")).otherwise("Other").alias("stride"), F.when(F.col("c").rlike(r"^CWE-\d+$"), F.col("c")).otherwise("N/A").alias("cwe_top25"))


def prompt_items(rows: DataFrame, size: int) -> DataFrame:
    """(batch, prompt): numbered, one-line items of cut title and description."""
    one = F.concat(F.regexp_replace(F.substring(F.coalesce("title", F.lit("")), 1, 300), r"\s*\n\s*", " "), F.lit(" | "), F.regexp_replace(F.substring(F.coalesce("description", F.lit("")), 1, 1400), r"\s*\n\s*", " "))
    return rows.withColumn("batch", (F.col("seq") / size).cast("long")).withColumn("line", one).groupBy("batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "line"))), lambda x, i: F.concat_ws(". ", i + 1, x["line"])), "\n").alias("prompt"))
