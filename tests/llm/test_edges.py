"""Every operator on nulls, empty and very long texts, ties, repeated rows, clashing columns, and empty tables."""

import json

import pytest
from pyspark.sql import functions as F

from fixcorpus.llm import capping, components, mixing, mojibake, nearedit, packing, personal, residue, secrets, truncation

VULNS = "id string, source_platform string, contest string, issue_id string, severity string, title string, description string, source_url string, scraped_at string, security_score double, confidence string, pre_fix_code string, post_fix_code string, fix_commit string"
CLASH = "kind int, rid int, root int, n int, pid int, path int, words int, value int, key int, cell int, stratum int, tokens int, size int, rank int"


def vulns(spark, rows):
    df = spark.createDataFrame(rows, VULNS)
    for c in CLASH.split(", "):
        df = df.withColumn(c.split()[0], F.lit(1))
    return df


@pytest.fixture(scope="module")
def odd(spark):
    code = json.dumps([{"file": "a.py", "hunks": [{"start_line": 1, "code": "x = 1\npassword = 'T4mper!river88'\n"}]}])
    long = "a very long text that goes on " * 9000 + "."
    null = (None,) * 14
    rows = [
        null,
        ("r1", None, None, None, None, None, None, None, None, None, None, None, None, None),
        ("r2", "", "", "", "", "", "", "", "", None, "", "", "", ""),
        ("r3", "p", "c", "nan", "High", "nan", "nan", "nan", "x", float("nan"), "nan", "nan", "[]", "nan"),
        ("r4", "P ", "c", "7", "High", "same", long, "http://www.h/x/", "2024", 1.0, "high", code, "{broken", "0" * 12),
        ("r5", "p", "c", "7", "High", "same", long, "https://h/x", "2024", 1.0, " HIGH", code, "[1, null, {}]", "ab" * 6),
        ("r5", "p", "c", "7", "High", "same", long, "https://h/x", "2024", 1.0, " HIGH", code, "plain text", "ab" * 20),
    ]
    return vulns(spark, rows)


LEX = "name_word string, name_kind string"


def operators(df, spark):
    lex = spark.createDataFrame([("Brebekh", "given"), (None, None), ("Fairquist", None)], LEX)
    yield "p1", secrets.secret_values(df)
    yield "p1 masked", secrets.redact_code(df)
    yield "p2", nearedit.near_pairs(df)
    yield "p2 groups", nearedit.near_groups(df)
    yield "p3", components.fix_groups(df)
    yield "p4", capping.platform_cap(df)
    yield "p4 even", capping.platform_cap(df, stratum=F.substring("scraped_at", 1, 4), even=True)
    yield "p5", residue.residue_fields(df)
    yield "p5 clean", residue.without_residue(df)
    yield "p6", truncation.cut_values(df)[0]
    yield "p6 rates", truncation.cut_rates(df)
    yield "p7", personal.personal_items(df, lex)
    yield "p7 clean", personal.sanitised(df, lex)


def test_odd_rows(odd, spark):
    got = {name: out.collect() for name, out in operators(odd, spark)}
    assert {(r["id"], r["field_name"], r["file_path"]) for r in got["p1"]} == {("r4", "pre_fix_code", "a.py"), ("r5", "pre_fix_code", "a.py")}
    assert all("T4mper!river88" not in (r["pre_fix_code"] or "") for r in got["p1 masked"])
    assert {(r["id_a"], r["id_b"]) for r in got["p2"]} == {("r4", "r5")}
    assert {(r["id"], r["group_id"]) for r in got["p3"]} == {("r4", "r4"), ("r5", "r4")}
    assert len(got["p4"]) == odd.count() and len(got["p5 clean"]) >= odd.count() and len(got["p7 clean"]) >= odd.count()


def test_empty_tables(spark):
    for _, out in operators(vulns(spark, []), spark):
        assert out.count() == 0


DOCS = "doc_id long, text string, lang string, source string, n_chars long, pid int, n_tokens int"


def test_documents(spark):
    long = "word " * 9000
    rows = [(1, None, None, None, None, 1, 1), (2, "", "en", "a", 0, 1, 1), (3, long, "en", "a", 9, 1, 1), (3, long, "en", "a", 9, 1, 1), (None, "text", "xx", "b", 4, 1, 1), (5, "OÃ¹ est la clÃ©", "fr", "b", 3, 1, 1)]
    df = spark.createDataFrame(rows, DOCS)
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    seq = packing.pack(df).collect()
    whole = packing.packing_report(df).first()
    assert {r["doc_id"] for r in seq} == {1, 2, 3, None, 5} and whole["largest"] <= packing.CAPACITY
    assert len([r for r in seq if r["doc_id"] == 3]) % 2 == 0 and all(r["sequence_id"] == 0 for r in seq if r["doc_id"] in (1, 2))
    assert mixing.mix_sources(df, targets).count() == 5
    assert {r["source"] for r in mixing.mix_report(df, targets).collect()} >= {"a", "b"}
    assert {r["doc_id"]: r["text"] for r in mojibake.restore(df).collect()} == {5: "Où est la clé"}
    none = spark.createDataFrame([], DOCS)
    assert packing.pack(none).count() == 0 and packing.packing_report(none).first()["n_sequences"] == 0
    assert mixing.mix_sources(none, targets).count() == 0 and mixing.mix_sources(df, targets.limit(0)).count() == 0
    assert mojibake.restore(none).count() == 0
