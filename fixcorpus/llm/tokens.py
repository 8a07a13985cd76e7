"""Sizes of texts in tokens of a public byte-level tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How the vocabulary's texts are split before merging (fixed value of byte-level BPE).
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=2)
def _shipped(session: str, path: str) -> str:
    """The vocabulary file, sent to all executors once per application (it need not lie on them)."""
    from pyspark.sql import SparkSession

    SparkSession.getActiveSession().sparkContext.addFile(path)
    return os.path.basename(path)


@lru_cache(maxsize=2)
def encoding(name: str):
    """The tokenizer of a shipped vocabulary file, on an executor."""
    import tiktoken
    from pyspark import SparkFiles

    with open(SparkFiles.get(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, columns: list[str], vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``columns`` with n_tokens and the partition that counted them; null texts have no tokens."""
    kept = docs.select(*columns, F.coalesce("text", F.lit("")).alias("_text"), F.spark_partition_id().alias("pid"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name not in ("_text", "pid"))
    at = len(columns)
    name = _shipped(docs.sparkSession.sparkContext.applicationId, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(name)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(at)], pa.array(n, pa.int64()), b.column(at + 1)], names=[*columns, "n_tokens", "pid"])

    return kept.mapInArrow(run, f"{fields}, n_tokens long, pid int")
