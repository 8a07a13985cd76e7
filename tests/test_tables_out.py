"""Sinks, late streams, prompts, de-duplicated tables, and the machinery between stages."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixcorpus.operators import answers, graph, normalize, redact, tables, xref
from fixcorpus.plans import gate
from fixcorpus.sources import io
from fixcorpus.streaming.gate import late_commits


def test_sinks(spark, tmp_path):
    x = spark.createDataFrame([("a", "x,\n\"y\" "), ("b", None)], "id string, title string")
    io.write_parquet(x, f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 2
    found = io.manifest(x, ["id"])
    assert found == {"id": {"a": 1, "b": 1}, "rows": 2}
    for session in (None, spark):
        io.write_manifest(found, f"{tmp_path}/m{session is None}.json", session)
        assert json.loads((tmp_path / f"m{session is None}.json").read_text()) == found
    assert "2 rows" in io.card("name", found)
    with pytest.raises(FileNotFoundError):
        io.read_csv_folders(spark, [f"{tmp_path}/none"])


def test_a_manifest_of_a_key_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(io, "MANIFEST_VALUES", 3)
    with pytest.raises(ValueError):
        io.manifest(spark.range(5), ["id"])


def test_late_commits(spark, tmp_path):
    rows = spark.sql("select 'a' as sha, 'w' as wallet, timestamp'2024-01-05 00:00:00' as committed_at union all select 'a', 'w', timestamp'2024-01-06 00:00:00' union all select 'b', 'w', timestamp'2024-01-07 00:00:00'")
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    q = late_commits(stream).writeStream.format("memory").queryName("late").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination(120)
    assert [(r["wallet"], r["n"], r["n_commits"]) for r in spark.table("late").collect()] == [("w", 3, 2)]


def test_prompts(spark):
    x = spark.createDataFrame([(0, "t", "a\n b"), (1, "u", None), (2, "v", "c")], "seq int, title string, description string")
    assert {r["batch"]: r["prompt"] for r in answers.prompt_items(x, 2).collect()} == {0: "1. t | a b\n2. u | ", 1: "1. v | c"}


def test_deduplicated_rows_keep_their_columns(spark):
    x = spark.createDataFrame([("b", "High", "same"), ("a", "Low", "same"), ("c", "Low", "other")], "id string, severity string, title string").withColumns({c: F.lit(None).cast("string") for c in ("source_platform", "issue_id", "description", "introduced_in_commit", "source_url")})
    assert [(r["id"], r["severity"]) for r in xref.deduplicated(x).collect()] == [("b", "High"), ("c", "Low")]


def test_boilerplate_that_got_through_is_an_error(spark):
    x = spark.createDataFrame([("a", "fine", ""), ("b", "Critical update required", "")], "id string, title string, description string")
    assert gate.checked(x.filter("id = 'a'")).count() == 1
    with pytest.raises(Exception, match="boilerplate survived"):
        gate.checked(x).collect()


def test_masking_once_equals_masking_with_kinds(spark):
    x = spark.createDataFrame([("a", "token gh" + "p_" + "aB3" * 8, None), ("b", "plain", "seed phrase: " + " ".join(["apple"] * 12))], "id string, title string, description string")
    one = redact.masked(x).orderBy("id").collect()
    two = redact.redact_columns(x).select("id", "title", "description").orderBy("id").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in two] and "XXXXXXX" in one[0]["title"] and one[0]["description"] is None


def test_slow_levels_are_hooked(spark, monkeypatch):
    """With a forced hooking round after every level, groups are those of a plain union-find."""
    monkeypatch.setattr(graph, "SLOW", 0.0)
    rng = random.Random(3)
    links = [(f"n{rng.randrange(300)}", f"k{rng.randrange(220)}") for _ in range(330)]
    got = {r["node"]: r["comp"] for r in graph.components(spark.createDataFrame(links, "node string, key string").repartition(5), edges_per_piece=12).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for n, k in links:
        parent[find("key " + k)] = find(n)
    groups = {}
    for n in {n for n, _ in links}:
        groups.setdefault(find(n), []).append(n)
    assert got == {n: min(g) for g in groups.values() for n in g}


def test_a_piece_never_exceeds_its_limit():
    rng = np.random.default_rng(2)
    forest = graph.Forest(50)
    out = []
    for _ in range(40):
        out += list(forest.add(rng.integers(0, 900, 30), rng.integers(0, 900, 30)))
    out += list(forest.rest())
    assert forest.largest <= 50 and len(out) > 5


def test_no_local_folder_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"
        applicationId = "a"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        tables.scratch_dir(Session())


def test_domains(spark):
    x = spark.createDataFrame([("wallet",), ("wallet",)], "domain string")
    assert normalize.single_domain(x) == "wallet"
