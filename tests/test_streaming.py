"""The gate and the counters on files that arrive as a stream."""

import os

from fixcorpus.plans import gate
from fixcorpus.streaming import gate as stream

SF = "/root/testdata/sf0.001"


def test_gate_on_a_stream_equals_the_batch(spark, tmp_path):
    batch = spark.read.parquet(os.path.join(SF, "wallet_vulns.parquet"))
    registry = spark.read.parquet(os.path.join(SF, "wallet_registry.parquet"))
    folder = str(tmp_path / "in")
    batch.filter("try_to_timestamp(scraped_at) is not null").repartition(2).write.parquet(folder)
    source = spark.readStream.schema(batch.schema).parquet(folder)
    q = stream.gated(source, registry, delay="36500 days").select("id", "drop_stage").writeStream.format("memory").queryName("gated").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r["id"], r["drop_stage"] or "") for r in spark.table("gated").collect())
    want = sorted((r["id"], r["drop_stage"] or "") for r in gate.judged(spark.read.parquet(folder), registry).select("id", "drop_stage").collect())
    assert got == want


def test_stage_counters_add_up(spark, tmp_path):
    batch = spark.read.parquet(os.path.join(SF, "wallet_vulns.parquet")).filter("try_to_timestamp(scraped_at) is not null")
    registry = spark.read.parquet(os.path.join(SF, "wallet_registry.parquet"))
    folder = str(tmp_path / "in")
    batch.write.parquet(folder)
    source = spark.readStream.schema(batch.schema).parquet(folder)
    q = stream.stage_counters(source, registry).writeStream.format("memory").queryName("stages").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("stages").selectExpr("sum(n)").first()[0] == batch.count()
