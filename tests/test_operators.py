"""Operators against small hand-made tables."""

import json
import random

import pytest
from pyspark.sql import functions as F

from fixcorpus.operators import answers, code, dedup, graph, labels, normalize, severity, xref
from fixcorpus.sources import commits, feeds, io, lines

VULN = "id string, source_platform string, issue_id string, severity string, title string, description string, source_url string, introduced_in_commit string"


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    links = [(f"n{rng.randrange(60):02d}", f"k{rng.randrange(50)}") for _ in range(90)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for n, k in links:
        parent[find("key" + k)] = find(n)
    groups = {}
    for n, _ in links:
        groups.setdefault(find(n), set()).add(n)
    want = {n: min(g) for g in groups.values() for n in g}
    got = {r["node"]: r["comp"] for r in graph.components(spark.createDataFrame(links, "node string, key string")).collect()}
    assert got == want


def test_components_of_a_long_chain(spark):
    names = [f"{i:04d}" for i in range(2000)]
    random.Random(5).shuffle(names)
    links = [(n, f"k{i + d}") for i, n in enumerate(names) for d in (0, 1)]
    got = graph.components(spark.createDataFrame(links, "node string, key string"))
    assert got.count() == 2000 and {r["comp"] for r in got.select("comp").distinct().collect()} == {"0000"}


def test_components_of_nothing(spark):
    assert graph.components(spark.createDataFrame([("a", None)], "node string, key string")).count() == 0


def test_cross_reference(spark):
    sha = "0a" * 20
    rows = [
        ("a", "p", "CVE-2024-1234", "Low", "first", "", "u1", ""),
        ("b", "p", "x", "High", "Same title", "see cve-2024-1234", "u2", ""),
        ("c", "p", "y", "High", "same TITLE!", f"fixed by {sha}", "", ""),
        ("d", "q", "z", None, "other", None, f"https://h/commit/{sha}", None),
        ("e", "q", "z", "Low", "same title", "", "", sha.upper()),
    ]
    df = spark.createDataFrame(rows, VULN)
    got = {r["id"]: r["cluster"] for r in xref.clusters(df).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e"}
    rep = {r["cluster"]: (r["kept_id"], r["n_rows"], json.loads(r["evidence"])) for r in xref.representatives(df).collect()}
    assert rep["a"] == ("b", 4, ["u1", "u2", f"https://h/commit/{sha}"]) and rep["e"][0] == "e"
    m = xref.merged_by_sha(df).first()
    assert m["merged"] == 1


def test_normalise(spark):
    schema = "source string, contest string, issue_id string, finding_id string, severity string, title string, description string, description_excerpt string, source_url string, introduced_in_commit string, path_hint string, scraped_at string"
    rows = [
        ("Acme", "Foo/Bar", "nan", "#12", "HIGH", "t", None, "text", "u", None, None, "2024-01-02"),
        ("Acme", "Foo/Bar", "12", None, "low", "later", "x", None, "u", None, None, "2024-01-03"),
        ("acme", "", None, None, None, None, " ", None, None, None, None, None),
        ("acme", None, "", "", "medium", "only title", None, None, None, None, None, None),
    ]
    got = {r["id"]: r for r in normalize.findings(spark.createDataFrame(rows, schema)).collect()}
    assert got["acme:foo-bar:12"]["title"] == "t" and got["acme:foo-bar:12"]["severity"] == "High"
    assert len(got) == 2 and any(k.startswith("unknown:") for k in got)


def test_fix_commit_dedup_order(spark):
    rows = [("a", "p", "c1", "[]", "u", "C_candidate", "x"), ("b", "p", "c1", "[{}]", "u", "C_candidate", "x"), ("c", "p", "", "", "u", "C_candidate", "x"), ("d", "p", None, "", "u", "C_candidate", "x"), ("e", "p", "c2", "", "h/pull/1", "C_candidate", ""), ("f", "p", "c2", "", "h/pull/1", "C_candidate", "")]
    df = spark.createDataFrame(rows, "id string, source_platform string, fix_commit string, pre_fix_code string, source_url string, authority_tier string, description string")
    assert sorted(r["id"] for r in dedup.fix_commit_key(df).collect()) == ["b", "c", "d", "e"]


def test_diff_parsing_and_caps(spark):
    diff = "diff --git a/x.ts b/x.ts\n--- a/x.ts\n+++ b/x.ts\n@@ -1,2 +1,2 @@\n ctx\n-old\n+new\n@@ -9 +9 @@\n+added\ndiff --git a/y.ts b/y.ts\nrename\n"
    files, pre, post = code.parse(diff)
    assert files == ["x.ts", "y.ts"]
    assert pre == [{"file": "x.ts", "hunks": [{"start_line": 1, "code": "ctx\nold"}]}]
    assert post[0]["hunks"] == [{"start_line": 1, "code": "ctx\nnew"}, {"start_line": 9, "code": "added"}]
    long = "diff --git a/z b/z\n" + "".join(f"@@ -{i} +{i} @@\n" + "+l\n" * 399 + ("+" + "x" * 20_000 + "\n" if i == 2 else "") for i in (1, 2, 3))
    hunks = code.parse(long)[2][0]["hunks"]
    assert hunks[1]["code"].endswith(code.CUT) and hunks[2]["code"] == code.CUT
    df = code.parse_diffs(spark.createDataFrame([("u", diff), ("v", None)], "source_url string, diff string"))
    rows = {r["source_url"]: r for r in df.collect()}
    assert rows["u"]["files"] == ["x.ts", "y.ts"] and rows["v"]["files"] == []
    big = json.dumps([{"file": f"f{i}", "hunks": [{"start_line": 1, "code": "y" * 3000}]} for i in range(20)])
    r = spark.createDataFrame([(big,)], "c string").select(F.size(code.row_cap(code.hunks_of(F.col("c")))).alias("n"), code.line_count(code.hunks_of(F.col("c"))).alias("l")).first()
    assert r["n"] == 2 and r["l"] == 20


def test_labels(spark):
    def label(hay, category, files):
        df = spark.createDataFrame([(hay, category, files)], "h string, c string, f array<string>")
        return df.select(labels.assign_label(F.col("h"), F.col("c"), F.col("f")).alias("x")).first()["x"]

    assert label("x", "mobile", [".github/workflows/main_ci.yml", "docs/security.md"]) == "build-ci"
    assert label("x", "mobile", ["test/hdnode.js"]) == "test"
    assert label("src/ecdsa.js deterministic nonce rfc6979", "wallet_sdk", ["src/ecdsa.js", "test/ecdsa.js"]) == "sign:nonce"
    assert label("nothing to see", "nope", []) == "other"


@pytest.mark.parametrize("args, want", [
    (("high", "x", "local_internal", "y", True), "not-eligible"), (("high", "none", "remote", "y", True), "not-eligible"), (("High", "liveness_dos", "remote", "client_specific", True), "medium"),
    (("High", "liveness_dos", "remote", "client_specific", False), "high"), ((None, None, None, None, False), "not-eligible"),
])
def test_guardrail(spark, args, want):
    df = spark.createDataFrame([args], "e string, i string, r string, b string, m boolean")
    assert df.select(severity.guardrail(*[F.col(c) for c in "eirbm"]).alias("x")).first()["x"] == want


def test_answers(spark):
    nested = 'text {"a": {"b": "}"}, "is_security_fix": true, "confidence": 0.9}'
    assert json.loads(answers.balanced_object(nested, "is_security_fix"))["confidence"] == 0.9
    assert answers.balanced_object("{broken", "x") is None and answers.balanced_object(None, "x") is None
    df = spark.createDataFrame([("u", nested, "m"), ("v", '{"is_security_fix": true, "confidence": 0.1}', "m"), ("w", "no", "m")], "source_url string, answer string, model string")
    got = answers.accept(answers.extract(df, "answer", "is_security_fix")).collect()
    assert [(r["source_url"], r["is_security_fix"], r["silent_fix_prob"]) for r in got] == [("u", 1, 0.9)]
    e = spark.createDataFrame([('```json\n{"stride": "Tampering", "cwe_top25": "CWE-79"}\n```',), ("junk",)], "a string").select(answers.enum_answer(F.col("a")).alias("x")).collect()
    assert tuple(e[0]["x"]) == ("Tampering", "CWE-79") and tuple(e[1]["x"]) == ("Other", "N/A")
    b = spark.createDataFrame([(1, 3, '[{"i": 2, "stride": "Spoofing", "cwe_top25": "CWE-20"}, {"i": 9, "stride": "x"}]')], "batch int, n int, answer string")
    assert [(r["i"], r["stride"]) for r in answers.align_batch(b).orderBy("i").collect()] == [(0, "Other"), (1, "Other"), (2, "Spoofing")]


def test_feeds(spark):
    osv = {"id": "GO-1", "aliases": ["GHSA-aaaa-bbbb-cccc", "CVE-2024-1"], "summary": "s", "details": "d", "database_specific": {"severity": "MODERATE"}, "affected": [{"ranges": [{"type": "GIT", "events": [{"introduced": "0"}, {"fixed": "abcdef1234"}]}]}]}
    r = feeds.vulnerabilities(spark.createDataFrame([(json.dumps(osv),), ("{}",)], "value string"), "w", "osv_npm").collect()
    assert len(r) == 1 and r[0]["issue_id"] == "CVE-2024-1" and r[0]["severity"] == "Medium" and "fix_commit: abcdef1234" in r[0]["description"] and r[0]["introduced_in_commit"] == ""
    nvd = {"cve": {"id": "CVE-2024-2", "descriptions": [{"lang": "es", "value": "x"}, {"lang": "en", "value": "Frame wallet leaks"}], "metrics": {"cvssMetricV2": [{"baseSeverity": "HIGH"}], "cvssMetricV31": [{"cvssData": {"baseSeverity": "LOW"}}]}}}
    n = feeds.nvd(spark.createDataFrame([(json.dumps(nvd),)], "value string"), "frame", r"\bframe\b").collect()
    assert n[0]["severity"] == "Low" and feeds.nvd(spark.createDataFrame([(json.dumps(nvd),)], "value string"), "x", "geth").count() == 0
    adv = {"ghsa_id": "GHSA-1", "severity": "critical", "summary": "s", "description": "d", "html_url": "u", "vulnerabilities": [{"patched_versions": "1.2"}, {"patched_versions": None}]}
    a = feeds.advisories(spark.createDataFrame([(json.dumps(adv),)], "value string"), "w").first()
    assert a["severity"] == "Critical" and a["title"] == "s [GHSA-1]" and a["description"].endswith("patched_versions: 1.2")


def test_lines_and_commits(spark):
    body = "# Release\n- Security: fix panic in parser (High)\nmore\n- high-urgency security\n* crash\n- Security: fix panic in parser (High)"
    got = lines.security_lines(spark.createDataFrame([("v1", body), ("v2", None)], "k string, b string"), "k", "b").collect()
    assert [(r["pos"], r["severity"], r["title"]) for r in got] == [(1, "High", "Security: fix panic in parser (High)")]
    assert got[0]["context"].startswith("# Release\n- Security") and got[0]["context"].count("\n") == 4
    m = spark.createDataFrame([("subject\n\nbody\nmore",), ("one\ntwo",), ("alone",)], "m string")
    s, b = commits.split_message(F.col("m"))
    assert [tuple(r) for r in m.select(s, b).collect()] == [("subject", "body\nmore"), ("one", "two"), ("alone", "")]
    f = spark.createDataFrame([(["a.md", "b.TS"],), (["src/x.ts"],), ([],)], "f array<string>")
    assert [r[0] for r in f.select(commits.touches_source(F.col("f"))).collect()] == [False, True, False]


def test_io(spark, tmp_path):
    (tmp_path / "a.csv").write_text('source,contest,issue_id,severity,title,description,source_url,introduced_in_commit\nw,c,PR#1,High,"t ""q""","line1\nline2",u,\n')
    df = io.read_csv_folders(spark, [str(tmp_path), str(tmp_path / "absent")])
    r = df.first()
    assert r["title"] == 't "q"' and r["description"] == "line1\nline2" and r["file_name"].endswith("a.csv")
    x = spark.createDataFrame([("1", "wallet", "p"), ("2", "wallet", "q")], "id string, domain string, source_platform string")
    assert io.publish(x, str(tmp_path / "out"), "org/name", owner="org") == [f"{tmp_path}/out/domain=wallet"]
    assert io.load_findings(spark, str(tmp_path / "out"), "wallet", "p").select("id", "source").collect()[0]["source"] == "p"
    m = io.manifest(x, ["domain", "source_platform"])
    assert m["rows"] == 2 and m["domain"] == {"wallet": 2} and m["source_platform"] == {"p": 1, "q": 1}
    with pytest.raises(ValueError):
        io.publish(x, str(tmp_path / "o2"), "bad name")
