"""Problem 3: one group identifier for all records linked directly or indirectly.

Method: union-find inside each partition of links, of which only a spanning
forest is kept; the forests are merged level by level through partitions of
bounded size until only global components remain.

A *link* is a record and one of its keys. Level 0 runs where the records lie:
every partition unites the keys of each record and emits one root per record
(which stays in place) and one (key, root) row per distinct key, so that a key
held by a third of all records leaves each partition once. Keys seen under
several roots become edges between roots; these edges are the next level's
links. Its partitions hold at most ``edges_per_partition`` edges each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import Forest, merge_forests
from .common import join_by_group, materialize, norm, release

EDGES_PER_PARTITION = 1_000_000
#: Texts that never link (fixed values).
NO_VALUE = ("", "nan", "n/a", "none", "null", "-")


def _local_level(batches: Iterator[pa.RecordBatch], edges_per_partition: int) -> Iterator[pa.RecordBatch]:
    """(rid, k0..kn) -> kind 0: (rid, root) per record; kind 1: (node, root) per distinct key of a piece."""
    forest = Forest(edges_per_partition)
    step = 100_000
    rids: list[pa.Array] = []
    firsts: list[np.ndarray] = []

    def out(nodes: np.ndarray, roots: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The forest of a piece, and the records waiting whose first key it holds."""
        for i in range(0, len(nodes), step):
            n = len(nodes[i : i + step])
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int8)), pa.nulls(n, pa.string()), pa.array(nodes[i : i + step]), pa.array(roots[i : i + step])], names=["kind", "rid", "node", "root"])
        if not rids:
            return
        rid, first = pa.concat_arrays(rids), np.concatenate(firsts)
        order = np.argsort(nodes)
        at = np.minimum(np.searchsorted(nodes, first, sorter=order), len(nodes) - 1)
        here = nodes[order][at] == first
        own, mine = roots[order][at][here], rid.filter(pa.array(here))
        rids[:], firsts[:] = ([rid.filter(pa.array(~here))], [first[~here]]) if not here.all() else ([], [])
        for i in range(0, len(own), step):
            n = len(own[i : i + step])
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int8)), mine.slice(i, n), pa.nulls(n, pa.int64()), pa.array(own[i : i + step])], names=["kind", "rid", "node", "root"])

    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([np.asarray(b.column(i).fill_null(0)) for i in range(1, b.num_columns)], axis=1)
        has = keys != 0
        first = keys[np.arange(len(keys)), has.argmax(axis=1)]  # every record has its own id as a key
        rids.append(b.column(0))
        firsts.append(first)
        for piece in forest.add(np.broadcast_to(first[:, None], keys.shape)[has], keys[has]):
            yield from out(*piece)
        if sum(map(len, firsts)) > edges_per_partition:
            for piece in forest.rest():
                yield from out(*piece)
    for piece in forest.rest():
        yield from out(*piece)


def link_groups(df: DataFrame, id_col: str, keys: list[Column], edges_per_partition: int = EDGES_PER_PARTITION) -> DataFrame:
    """(id, group_id, group_size): one row per record of a group of two or more records.

    ``keys`` are string columns; records with an equal value in the same key
    column are linked; null never links. ``group_id`` is the smallest id (byte
    order) of the group. Records are told apart by ``id_col`` and rows with a
    null id are left out; a repeated id counts as one record. Keys are compared
    by 64-bit hashes (chance of any false link among n keys about n^2 / 2^65).
    An empty table gives an empty result; extra columns are ignored.
    """
    hashed = [F.when(k.isNotNull(), F.xxhash64(F.lit(i), k)) for i, k in enumerate(keys)]
    links = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("rid"), *[h.alias(f"k{i}") for i, h in enumerate([*hashed, F.xxhash64(F.lit("own id"), F.col(id_col))])])
    level0 = materialize(links.mapInArrow(lambda it: _local_level(it, edges_per_partition), "kind byte, rid string, node long, root long"), "links")
    rows = level0.filter("kind = 0").select("rid", "root")
    merged = merge_forests(level0.filter("kind = 1").select("node", "root"), edges_per_partition)
    roots = rows.groupBy("root").agg(F.count("*").alias("n"), F.min("rid").alias("low"), F.max("rid").alias("high"))
    named = roots.join(merged, "root", "left").withColumn("comp", F.coalesce("comp", "root"))
    named = materialize(named, "roots")
    release(merged)
    groups = named.groupBy("comp").agg(F.sum("n").alias("rows"), F.count("*").alias("roots"), F.min("low").alias("group_id"), F.max("high").alias("last"))
    groups = groups.filter("group_id <> last").drop("last")
    by_root = join_by_group(named.select("root", "n", "comp"), groups, "comp", "roots").select("root", "n", "group_id", F.col("rows").alias("group_size"))
    out = join_by_group(rows, by_root, "root", "n")
    return out.select(F.col("rid").alias("id"), "group_id", "group_size").distinct()


def url_key(c: Column) -> Column:
    """A page's address without scheme, ``www.``, query string and trailing slashes; null where it never links."""
    u = norm(c)
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(u, r"^[a-z][a-z0-9+.-]*://", ""), r"^www\.", ""), r"\?[^#]*", "")
    bare = F.regexp_replace(bare, r"/+$", "")
    return F.when(~u.isin(*NO_VALUE) & ~bare.isin(*NO_VALUE), bare)


def commit_key(c: Column) -> Column:
    x = norm(c)
    return F.when(x.rlike("^[0-9a-f]{12,40}$") & ~x.rlike("^0+$"), F.substring(x, 1, 12))


def issue_key(platform: Column, issue: Column) -> Column:
    p, i = norm(platform), norm(issue)
    return F.when(~p.isin(*NO_VALUE) & ~i.isin(*NO_VALUE), F.concat(p, F.lit("\x01"), i))


def fix_groups(vulns: DataFrame, edges_per_partition: int = EDGES_PER_PARTITION) -> DataFrame:
    """Groups of fix records that agree in page, commit, or platform and issue."""
    keys = [url_key(F.col("source_url")), commit_key(F.col("fix_commit")), issue_key(F.col("source_platform"), F.col("issue_id"))]
    return link_groups(vulns, "id", keys, edges_per_partition)
