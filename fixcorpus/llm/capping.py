"""Problem 4: limit what one contributor gives, keeping its best records.

Method (stratum-aware cap): a contributor's cap is split over its strata
(topics, periods) by largest-remainder apportionment, spare slots of strata
smaller than their part go to the others, and inside each stratum the records
of best quality stay.

Ranking never sorts a contributor in one task: records are counted by quality
cell (contributor, stratum, ordered quality values); cells wholly inside or
outside the slots are decided at once, and only the one cell per stratum that
the limit cuts is ranked by id, over range partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_by_group, materialize, norm


def _slots(sizes: DataFrame, even: bool) -> DataFrame:
    """(contributor, stratum, n, cap) -> slots per stratum, summing to min(cap, n of the contributor).

    Shares are in proportion to n, or with ``even`` the same for every stratum.
    Strata that can't fill their even share are full; what they leave is split
    again among the others (all at once: in order of n, a stratum is full if n
    is at most an even share of what the smaller ones leave). Fractions go by
    largest remainder, ties by stratum.
    """
    w = Window.partitionBy("contributor")
    x = sizes.withColumn("limit", F.least(F.col("cap"), F.sum("n").over(w)))
    if even:
        by_n = w.orderBy("n", F.asc_nulls_first("stratum"))
        smaller = F.coalesce(F.sum("n").over(by_n.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        x = x.withColumn("open", F.count("*").over(w) - F.row_number().over(by_n) + 1)
        x = x.withColumn("full", F.col("n") * F.col("open") <= F.col("limit") - smaller)
    else:
        x = x.withColumn("full", F.lit(False))
    weight = F.when(F.col("full"), 0).otherwise(1 if even else F.col("n")).cast("long")
    x = x.withColumn("weight", weight).withColumn("rest", F.col("limit") - F.sum(F.when(F.col("full"), F.col("n")).otherwise(0)).over(w)).withColumn("weights", F.greatest(F.sum("weight").over(w), F.lit(1)))
    x = x.withColumn("base", F.expr("rest * weight div weights")).withColumn("rem", F.expr("rest * weight % weights"))
    x = x.withColumn("left", F.col("rest") - F.sum("base").over(w))
    turn = F.row_number().over(w.orderBy("full", F.desc("rem"), F.asc_nulls_first("stratum")))
    slots = F.when(F.col("full"), F.col("n")).otherwise(F.col("base") + (turn <= F.col("left")).cast("long"))
    return x.select("contributor", "stratum", slots.alias("slots"))


def cap_contributors(df: DataFrame, id_col: str, contributor: Column, stratum: Column, quality: list[Column], cap: Column, even: bool = False) -> DataFrame:
    """(id, contributor, stratum, kept): which records stay.

    ``quality`` are columns of which smaller is better (nulls last), ties go to
    the smaller id in byte order; ``cap`` is an expression over ``total_rows``,
    the number of rows of ``df``. A null contributor is a contributor of its
    own; repeated ids are ranked one after the other. Columns of ``df`` of any
    name are untouched, as only derived names leave this function. An empty
    table gives an empty result.
    """
    cells = [f"q{i}" for i in range(len(quality))]
    rows = df.select(F.col(id_col).alias("rid"), contributor.alias("contributor"), stratum.alias("stratum"), *[q.alias(n) for q, n in zip(quality, cells)])
    rows = rows.withColumn("rid", F.coalesce(F.col("rid").cast("string"), F.lit("")))
    counts = materialize(rows.groupBy("contributor", "stratum", *cells).agg(F.count("*").alias("n")), "cells")
    total = counts.agg(F.sum("n").alias("total_rows"))
    sizes = counts.groupBy("contributor", "stratum").agg(F.sum("n").alias("n")).crossJoin(F.broadcast(total)).withColumn("cap", cap.cast("long")).drop("total_rows")
    slots = _slots(sizes, even)
    order = [F.asc_nulls_last(c) for c in cells]
    key = F.struct(F.struct(F.col("contributor")).alias("c"), F.struct(F.col("stratum")).alias("s"), *[F.struct(F.col(c)).alias(c) for c in cells])
    hashed = F.xxhash64(key)
    # with continuous scores cells are as many as rows: rows before a cell are summed over range partitions, too
    ordered = before_in_groups(counts.withColumn("group", F.xxhash64(F.struct("contributor").alias("c"), F.struct("stratum").alias("s"))), "group", order, "n", "before").drop("group")
    # strata of contributors are few: one row each
    x = ordered.alias("c").join(slots.alias("s"), F.col("c.contributor").eqNullSafe(F.col("s.contributor")) & F.col("c.stratum").eqNullSafe(F.col("s.stratum"))).select("c.*", "s.slots")
    x = x.withColumn("here", F.col("slots") - F.col("before"))
    x = x.withColumn("verdict", F.when(F.col("here") >= F.col("n"), 1).when(F.col("here") <= 0, 0).otherwise(2)).withColumn("cell", hashed)
    verdicts = materialize(x.select("cell", "n", "here", "verdict"), "verdicts")
    marked = join_by_group(rows.withColumn("cell", hashed), verdicts, "cell", "n")
    decided = marked.filter("verdict <> 2").select("rid", "contributor", "stratum", (F.col("verdict") == 1).alias("kept"))
    cut = marked.filter("verdict = 2").select("rid", "contributor", "stratum", "cell", "here")
    ranked = rank_in_groups(cut, "cell", "rid")
    return decided.unionByName(ranked.select("rid", "contributor", "stratum", (F.col("rank") <= F.col("here")).alias("kept"))).withColumnRenamed("rid", "id")


def before_in_groups(df: DataFrame, group: str, order: list[Column], weight: str, name: str) -> DataFrame:
    """Sum of ``weight`` over the rows before each row of its ``group`` by ``order``, without bringing a group together.

    Rows are range-partitioned by (group, order), summed up inside each
    partition, and moved by the sums of the group in the partitions before.
    """
    placed = materialize(df.repartitionByRange(F.col(group), *order).withColumn("_pid", F.spark_partition_id()), "ranges")
    sums = placed.groupBy(group, "_pid").agg(F.sum(weight).alias("_m"))
    ahead = Window.unboundedPreceding, -1
    moved = sums.withColumn("_far", F.coalesce(F.sum("_m").over(Window.partitionBy(group).orderBy("_pid").rowsBetween(*ahead)), F.lit(0))).drop("_m")
    near = F.coalesce(F.sum(weight).over(Window.partitionBy(group, "_pid").orderBy(*order).rowsBetween(*ahead)), F.lit(0))
    return placed.withColumn("_near", near).join(moved, [group, "_pid"]).withColumn(name, F.col("_near") + F.col("_far")).drop("_near", "_far", "_pid")


def rank_in_groups(df: DataFrame, group: str, order: str) -> DataFrame:
    """Row number by ``order`` inside ``group`` without bringing a group together.

    See ``before_in_groups``; ties of ``order`` get different numbers.
    """
    one = df.withColumn("_one", F.lit(1))
    return before_in_groups(one, group, [F.asc_nulls_last(order)], "_one", "rank").withColumn("rank", F.col("rank") + 1).drop("_one")


#: Share of all rows that one platform may hold.
PLATFORM_SHARE_PERMILLE = 25


def confidence_rank(c: Column) -> Column:
    x = norm(c)
    return F.when(x == "high", 0).when(x == "medium", 1).when(x == "low", 2).otherwise(3)


def platform_cap(vulns: DataFrame, stratum: Column | None = None, permille: int = PLATFORM_SHARE_PERMILLE, even: bool = False) -> DataFrame:
    """Every platform keeps at most floor(permille/1000 of all rows): best confidence, then score, then id."""
    return cap_contributors(
        vulns,
        "id",
        norm(F.col("source_platform")),
        F.lit("all") if stratum is None else stratum,
        [confidence_rank(F.col("confidence")), -F.col("security_score")],
        F.floor(F.expr(f"total_rows * {permille} div 1000")),
        even,
    )
