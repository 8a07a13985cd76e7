"""The driver contract."""

import __spark_entry__ as e


def test_entry(spark):
    assert e.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(e.oracle_sql()) <= set(e.queries())


def test_stage_counts_sum_to_the_input(spark):
    d = "/root/testdata/sf0.001"
    n = e.queries()["drop_stage_counts"](spark, d).selectExpr("sum(n)").first()[0]
    assert n == spark.read.parquet(f"{d}/wallet_vulns.parquet").count()


def test_gate_plan_stays_in_the_jvm(spark):
    plan = e.queries()["curated_findings"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_queries_without_the_subpackage(tmp_path):
    """An empty folder left behind, or none, leaves the core's queries."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(e.__file__))
    shutil.copy(e.__file__, tmp_path)
    shutil.copytree(os.path.join(root, "fixcorpus"), tmp_path / "fixcorpus", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    ask = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('p2_') for n in e.queries()))"
    for make in (False, True):
        if make:
            (tmp_path / "fixcorpus" / "llm" / "__pycache__").mkdir(parents=True)
        out = subprocess.run([sys.executable, "-c", ask], cwd=tmp_path, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
        assert out.stdout.split()[-1] == "False" and int(out.stdout.split()[-2]) > 50
