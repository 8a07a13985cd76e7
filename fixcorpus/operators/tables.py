"""Tables written between stages, and joins with groups that may hold a third of all rows."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []
_CLEANED: set[str] = set()

#: Groups with more rows than this are joined by broadcast; there are at most (all rows / HOT_ROWS) of them.
HOT_ROWS = 200_000


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the session (``spark.checkpoint.dir``), in it a folder of this application.

    Where it is unset, a session in one process (tests) gets a temporary folder
    of its own; on a cluster no local folder will do, and that is an error.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="fixcorpus-"))
            atexit.register(shutil.rmtree, _LOCAL[0], True)
        found = "file://" + _LOCAL[0]
    folder = f"{found.rstrip('/')}/fixcorpus-{sc.applicationId}"
    if folder not in _CLEANED:
        # what is still there when the application ends goes with it
        _CLEANED.add(folder)
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return folder


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives the loss of executors.

    ``release`` deletes it where nothing reads it any more; tables that a
    returned frame still reads are deleted when the application ends.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._fixcorpus_path = path
    return back


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_fixcorpus_path", None)
        if path:
            spark = df.sparkSession
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def join_by_group(rows: DataFrame, groups: DataFrame, key: str, count_col: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of rows to one row per group, where a group may hold a third of all rows.

    ``count_col`` of ``groups`` is the number of rows of the group. Groups above
    ``hot_rows`` are few (all rows / hot_rows) and go by broadcast; the others
    are joined by shuffle, where no key holds more than ``hot_rows`` rows. The
    result is the same either way.
    """
    hot = groups.filter(F.col(count_col) > hot_rows)
    cold = groups.filter(F.col(count_col) <= hot_rows)
    if not hot.take(1):
        return rows.join(cold, key)
    in_hot = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return in_hot.unionByName(rest.join(cold, key))


#: Splits up to which a table is spread, and over how many partitions at most.
SPREAD_SPLITS, SPREAD_TO = 8, 64


def spread(df: DataFrame) -> DataFrame:
    """A table of few splits over the cores; one of more than SPREAD_SPLITS as it lies, so that no large table is shuffled.

    Small files have few row groups, whatever their splits. Results don't depend
    on it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    return df.repartition(min(cores, SPREAD_TO)) if 0 < n <= SPREAD_SPLITS and cores > 1 else df


#: A dimension with more rows than this is joined by shuffle instead of being sent to all executors.
DIMENSION_ROWS = 100_000


def dimension(df: DataFrame) -> DataFrame:
    """A side to send to all executors, if its size allows it (checked on at most DIMENSION_ROWS + 1 rows)."""
    return F.broadcast(df) if df.limit(DIMENSION_ROWS + 1).count() <= DIMENSION_ROWS else df
