"""References to commits, and slices of a crawl."""

import pytest
from pyspark.sql import functions as F

from fixcorpus.operators import analytics, refs
from fixcorpus.sources import slices


@pytest.mark.parametrize("text, want", [("see /commit/abcdef1234 and #55", "commit:abcdef1234"), ("fixed (#12)", "pr:12"), ("in [#345]", "pr:345"), ("a #77 b", "pr:77"), ("x#77", ""), (None, "")])
def test_inline_reference(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(refs.inline_reference(F.col("t")).alias("x")).first()["x"] == want


def test_parents(spark):
    rows = [("a", "p", "PR#5", "", None, "old"), ("b", "p", "COMMIT#abcdef123456", "", None, ""), ("c", "p", "GHSA-x", "", "text\npatched_versions: >=1.2.0, 2.0", None), ("d", "p", "ISSUE#1", "", None, "kept"), ("e", "q", "PR#5", "", None, "other")]
    f = spark.createDataFrame(rows, "id string, source_platform string, issue_id string, source_url string, description string, introduced_in_commit string")
    r = spark.createDataFrame([("p", "PR", "5", "p5"), ("p", "COMMIT", "abcdef123456", "pc"), ("p", "RELEASE", "v1.2.0", "pr")], "repo string, kind string, key string, parent_sha string")
    assert {x["id"]: x["introduced_in_commit"] for x in refs.resolve_parents(f, r).collect()} == {"a": "p5", "b": "pc", "c": "pr", "d": "kept", "e": "other"}
    assert {x["issue_kind"] for x in refs.coverage(f).collect()} == {"PR", "COMMIT", "GHSA", "ISSUE"}


def test_closest_commit(spark):
    a = spark.createDataFrame([("g", "v1", "origin check missing in provider"), ("h", "v2", "nothing")], "advisory string, release string, text string")
    c = spark.createDataFrame([("v1", "s1", "Merge origin check provider"), ("v1", "s2", "check the origin of the provider"), ("v1", "s3", "tidy"), ("v2", "s4", "tidy")], "release string, sha string, subject string")
    assert [tuple(r) for r in refs.closest_commit(a, c).collect()] == [("g", "s2", 3)]


def test_slices(spark):
    there = spark.createDataFrame([("r", "Bug"), ("r", "docs")], "repo string, label string")
    wanted = spark.createDataFrame([("r", "bug", 1), ("r", "BUG", 2), ("r", "security", 3), ("r", "docs", 4)], "repo string, label string, turn int")
    assert [tuple(r) for r in slices.existing_labels(wanted, there, skip=["docs"]).collect()] == [("r", "bug")]
    ch = spark.createDataFrame([("r", 1, "fix crash", True), ("r", 1, "fix crash", True), ("r", 2, "docs", True), ("r", 3, "security", False)], "repo string, number int, title string, merged boolean")
    assert [r["number"] for r in slices.by_title(ch).collect()] == [1]
    x = spark.createDataFrame([("1", "seed leak", "s"), ("2", None, "s")], "id string, title string, source string").withColumn("description", F.lit("the overflow"))
    assert {r["id"]: r["term"] for r in slices.first_term(x).collect()} == {"1": "seed", "2": "overflow"}
    u = slices.united([x, x.withColumn("id", F.concat("id", F.lit("b")))], ["id"], F.col("id"), cap=3)
    assert sorted(r["id"] for r in u.collect()) == ["1", "1b", "2"]


def test_dominance_cap_is_exact(spark):
    df = spark.createDataFrame([(str(i), "big" if i % 2 else "s") for i in range(1000)], "id string, p string")
    out = slices.dominance_cap(df, F.col("p") == "big", 100, "id")
    assert {r["p"]: r["n"] for r in out.groupBy("p").agg(F.count("*").alias("n")).collect()} == {"s": 500, "big": 100}


def test_sampling_is_deterministic(spark):
    df = spark.createDataFrame([(str(i), "a" if i % 3 else "b") for i in range(300)], "k string, c string")
    one, two = ({r["k"] for r in analytics.sample_per_class(df.repartition(n), "k", F.col("c"), 7, 1).collect()} for n in (1, 7))
    assert one == two and len(one) == 14
