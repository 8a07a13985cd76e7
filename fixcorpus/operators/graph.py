"""Connected components: union-find in bounded pieces, spanning forests, hierarchical merging.

Every piece of a partition holds at most ``edges_per_piece`` edges and leaves
its spanning forest as (node, root) rows, so that a node of very many edges
leaves each piece once. Nodes seen under several roots become edges between
roots, the edges of the next level. Where a level shrinks little, each root is
hooked to the neighbour of least priority under a hash of the level, which
halves the roots that still have neighbours (in expectation, whatever the
graph), in joins whose groups are pre-aggregated. The loop ends when no edge is
left; no level brings all edges into one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import join_by_group, materialize, release

EDGES_PER_PIECE = 1_000_000
#: A level that leaves more than this share of its edges is followed by a hooking round.
SLOW = 0.7


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and, for each, the smallest node of its component: array union-find by hooking roots and halving paths."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = inv[: len(a)], inv[len(a) :]
    parent = np.arange(len(nodes))
    while len(u):
        pu, pv = parent[u], parent[v]
        open_ = pu != pv
        if not open_.any():
            break
        u, v, pu, pv = u[open_], v[open_], pu[open_], pv[open_]
        np.minimum.at(parent, np.maximum(pu, pv), np.minimum(pu, pv))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return nodes, nodes[parent]


class Forest:
    """Union-find over a stream of edges that never holds more than ``limit`` of them."""

    def __init__(self, limit: int):
        self.limit = limit
        self.largest = 0
        self.nodes, self.roots = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take edges in; gives the forest so far, and starts anew, whenever it fills half of the limit."""
        while len(a):
            inner = self.nodes != self.roots
            kept = int(inner.sum())
            if 2 * kept > self.limit:
                yield from self.rest()
                continue
            room = max(1, self.limit - kept)
            x, y = np.concatenate([self.nodes[inner], a[:room]]), np.concatenate([self.roots[inner], b[:room]])
            self.largest = max(self.largest, len(x))
            a, b = a[room:], b[room:]
            alone = self.nodes[~inner]
            self.nodes, self.roots = spanning_forest(x, y)
            # nodes linked to nothing but themselves so far
            lone = alone[~np.isin(alone, self.nodes)]
            self.nodes, self.roots = np.concatenate([self.nodes, lone]), np.concatenate([self.roots, lone])
            if len(lone) > self.limit:
                yield from self.rest()

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(self.nodes):
            yield self.nodes, self.roots
        self.nodes, self.roots = np.zeros(0, np.int64), np.zeros(0, np.int64)


def edge_level(batches: Iterator[pa.RecordBatch], edges_per_piece: int) -> Iterator[pa.RecordBatch]:
    """(a, b) edges of a partition -> the forests of its pieces as (node, root)."""
    forest = Forest(edges_per_piece)

    def out(n: np.ndarray, r: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(n), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(n[i : i + 100_000]), pa.array(r[i : i + 100_000])], names=["node", "root"])

    for x in batches:
        for piece in forest.add(np.asarray(x.column(0)), np.asarray(x.column(1))):
            yield from out(*piece)
    for piece in forest.rest():
        yield from out(*piece)


def _root_edges(forest: DataFrame) -> DataFrame:
    """Edges between the roots under which one node stands in several pieces (at most one root per piece)."""
    at = forest.groupBy("node").agg(F.min("root").alias("b"), F.collect_set("root").alias("rs")).filter(F.size("rs") > 1)
    return at.select(F.explode("rs").alias("a"), "b").filter("a <> b").distinct()


def _compose(found: DataFrame | None, up: DataFrame) -> DataFrame:
    """Labels of earlier levels moved along ``up``, and the new ones."""
    if found is None:
        return materialize(up, "merged")
    moved = found.join(up.select(F.col("root").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("root", F.coalesce("to", "comp").alias("comp"))
    out = materialize(moved.unionByName(up.join(found.select("root"), "root", "left_anti")), "merged")
    release(found)
    return out


def _hooked(edges: DataFrame, level: int) -> DataFrame:
    """(root, comp): every node with a neighbour of lower priority goes to the least of them, and on along those that went themselves."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rank = lambda c: F.struct(F.xxhash64(F.lit(level), c).alias("h"), F.col(c).alias("v"))
    least = both.groupBy("a").agg(F.min(rank("b")).alias("low")).filter(F.col("low") < rank("a"))
    up = materialize(least.select(F.col("a").alias("root"), F.col("low.v").alias("comp")), "hooks")
    while True:
        on = up.select(F.col("root").alias("comp"), F.col("comp").alias("to"))
        nxt = materialize(up.join(on, "comp", "left").select("root", F.coalesce("to", "comp").alias("comp"), F.col("to").isNotNull().alias("moved")), "hooks")
        release(up)
        up = nxt
        if not up.filter("moved").take(1):
            return up.select("root", "comp")


def merge_forests(forest: DataFrame, edges_per_piece: int = EDGES_PER_PIECE) -> DataFrame:
    """(node, root) forests of many pieces -> (root, comp) for every root that is not its component's name."""
    edges = materialize(_root_edges(forest), "root-edges")
    found: DataFrame | None = None
    level = 0
    while (n := edges.count()) > 0:
        level += 1
        k = -(-n // edges_per_piece)
        split = edges.repartition(k, F.greatest("a", "b")) if k > 1 else edges.coalesce(1)
        forests = materialize(split.mapInArrow(lambda it: edge_level(it, edges_per_piece), "node long, root long"), "forest")
        up = forests.groupBy("node").agg(F.min("root").alias("root")).filter("node <> root").select(F.col("node").alias("root"), F.col("root").alias("comp"))
        found = _compose(found, up)
        rest = materialize(_root_edges(forests), "root-edges")
        release(edges, forests)
        edges = rest
        left = edges.count() if k > 1 else 0
        if left > SLOW * n:
            up = materialize(_hooked(edges, level), "hooked")
            found = _compose(found, up)
            ends = edges.join(up.select(F.col("root").alias("a"), F.col("comp").alias("x")), "a", "left").join(up.select(F.col("root").alias("b"), F.col("comp").alias("y")), "b", "left")
            rest = materialize(ends.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")).filter("a <> b").distinct(), "root-edges")
            release(edges, up)
            edges = rest
    if found is None:
        return forest.sparkSession.createDataFrame([], "root long, comp long")
    return found


def components(links: DataFrame, edges_per_piece: int = EDGES_PER_PIECE) -> DataFrame:
    """(node, comp): the smallest node of each node's component; links are (node, key), null keys link nothing.

    Nodes and keys are compared by 64-bit hashes (chance of any false link among
    n of them about n^2 / 2^65). A node without keys gives no row; an empty
    table gives an empty result.
    """
    rows = links.filter("node is not null and key is not null").select(F.col("node").cast("string").alias("node"), F.xxhash64(F.lit("node"), F.col("node").cast("string")).alias("a"), F.xxhash64(F.lit("key"), "key").alias("b"))
    rows = materialize(rows, "links")
    forest = materialize(rows.select("a", "b").mapInArrow(lambda it: edge_level(it, edges_per_piece), "node long, root long"), "forest")
    merged = merge_forests(forest, edges_per_piece)
    root = forest.groupBy(F.col("node").alias("a")).agg(F.min("root").alias("root"))
    names = rows.groupBy("a").agg(F.min("node").alias("node"))
    of = names.join(root, "a").join(merged, "root", "left").select("node", F.coalesce("comp", "root").alias("c"))
    of = materialize(of, "labels")
    release(rows, forest, merged)
    groups = materialize(of.groupBy("c").agg(F.min("node").alias("comp"), F.count("*").alias("n")), "groups")
    return join_by_group(of, groups, "c", "n").select("node", "comp")
