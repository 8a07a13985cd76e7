"""Problem 8: put documents into training sequences of fixed capacity.

Method: Martello-Toth dominance reduction fixes small sets of documents that
provably dominate all alternatives; the rest goes by best fit in decreasing
size. Sizes are whole numbers of tokens up to the capacity, so the instance is
its histogram: at most ``capacity`` counts, whatever the number of documents.
The plan (patterns of sizes and how many sequences have each) is made on these
counts; documents then take the slots of their size by their rank in it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .tokens import DEFAULT_VOCABULARY, count_tokens

CAPACITY = 2048

#: (sizes with their multiplicity in one sequence, number of sequences)
Pattern = tuple[tuple[tuple[int, int], ...], int]


def _pattern(*sizes: int) -> tuple[tuple[int, int], ...]:
    return tuple((s, sizes.count(s)) for s in sorted(set(sizes), reverse=True))


def dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sequences that may be fixed without loss, and the counts left.

    For an item of size j, the set {j} dominates if nothing fits beside it;
    {j, k} dominates if it fills the sequence, if only one item fits beside j
    (k the largest that does), or if at most two do and k is at least as large
    as the best two together.
    """
    left = {s: n for s, n in counts.items() if s > 0 and n > 0}
    fixed: list[Pattern] = []

    def take(n: int, *sizes: int) -> None:
        fixed.append((_pattern(*sizes), n))
        for s in sizes:
            left[s] -= n
            if not left[s]:
                del left[s]

    def smallest(k: int, without: int) -> int | None:
        """Sum of the k smallest items beside one of size ``without``; None if there are fewer."""
        total, need = 0, k
        for s in sorted(left):
            n = left[s] - (s == without)
            m = min(n, need)
            total, need = total + m * s, need - m
            if not need:
                return total
        return None

    def largest_pair(room: int, without: int) -> int:
        n = {s: k - (s == without) for s, k in left.items() if k > (s == without)}
        sizes, best = sorted(n), 0
        for i, a in enumerate(sizes):
            j = bisect_right(sizes, room - a) - 1
            if j == i and n[a] < 2:
                j -= 1
            if j >= 0:
                best = max(best, a + sizes[j])
        return best

    again = True
    while again:
        again = False
        for j in sorted(left, reverse=True):
            while left.get(j):
                room = capacity - j
                one = smallest(1, j)
                if one is None or one > room:
                    take(left[j], j)
                elif left.get(room, 0) - (room == j) > 0:
                    take(left[j] // 2 if room == j else min(left[j], left[room]), j, room)
                else:
                    k = max((s for s in left if s <= room and left[s] - (s == j) > 0), default=0)
                    two, three = smallest(2, j), smallest(3, j)
                    if (two is None or two > room) or ((three is None or three > room) and k >= largest_pair(room, j)):
                        # after each set the counts may rule otherwise: only as many as surely keep the premise
                        take(1 if k == j else min(left[j], left[k]), j, k)
                    else:
                        break
                again = True
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit decreasing on counts: equal sizes are placed together."""
    open_: dict[int, list[list]] = {}
    rooms: list[int] = []
    done: list[Pattern] = []

    def put(pattern: tuple[tuple[int, int], ...], room: int, n: int) -> None:
        if room == 0:
            done.append((pattern, n))
        elif room in open_:
            open_[room].append([pattern, n])
        else:
            open_[room] = [[pattern, n]]
            insort(rooms, room)

    for s in sorted((s for s, n in counts.items() if n > 0 and s > 0), reverse=True):
        c = counts[s]
        while c:
            i = bisect_left(rooms, s)
            if i == len(rooms):
                t = capacity // s
                full, rest = divmod(c, t)
                if full:
                    put(((s, t),), capacity - s * t, full)
                if rest:
                    put(((s, rest),), capacity - s * rest, 1)
                break
            room = rooms[i]
            groups = open_[room]
            pattern, n = groups.pop()
            if not groups:
                del open_[room]
                rooms.pop(i)
            each = min(room // s, c)
            k = min(n, c // each)
            if n > k:
                put(pattern, room, n - k)
            put((*pattern, (s, each)), room - s * each, k)
            c -= k * each
    for room in rooms:
        done.extend((p, n) for p, n in open_[room])
    return done


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    fixed, left = dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(sequence_id, doc_id, piece, n_tokens): where every document stands.

    A document larger than the capacity is cut into full pieces and a rest;
    no other is split. Documents without tokens (null or empty text) take no
    room and stand in sequence 0. Every row of ``docs`` is placed, repeated
    rows one by one; a null doc_id stays null; an empty table gives an empty
    result.
    """
    sizes = count_tokens(docs, ["doc_id"], vocabulary)
    pieces = sizes.select("doc_id", "pid", "n_tokens", F.explode(F.expr(f"sequence(0, cast(greatest(ceil(n_tokens / {capacity}) - 1, 0) as int))")).alias("piece"))
    pieces = pieces.select("doc_id", "pid", "piece", F.least(F.lit(capacity), F.col("n_tokens") - F.col("piece") * capacity).cast("int").alias("size"))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for b in batches:
            size, pid = np.asarray(b.column("size")), np.asarray(b.column("pid"))
            near = np.zeros(len(size), np.int64)
            for p in np.unique(pid).tolist():
                n = seen.setdefault(p, np.zeros(capacity + 1, np.int64))
                at = np.flatnonzero(pid == p)
                order = at[np.argsort(size[at], kind="stable")]
                u, first, c = np.unique(size[order], return_index=True, return_counts=True)
                near[order] = np.arange(len(order)) - np.repeat(first, c) + np.repeat(n[u], c)
                n[u] += c
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "pid", "piece", "size")], pa.array(near)], names=["doc_id", "pid", "piece", "size", "near"])

    placed = materialize(pieces.mapInArrow(ranked, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, pid int, piece int, size int, near long"), "pieces")
    parts = materialize(placed.groupBy("size", "pid").agg(F.count("*").alias("n")), "sizes")
    # at most capacity + 1 rows
    counts = {r["size"]: r["n"] for r in parts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    slots: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, n in plan(counts, capacity):
        for s, each in pattern:
            slots.setdefault(s, []).append((ranks.get(s, 0), sequence, each))
            ranks[s] = ranks.get(s, 0) + n * each
        sequence += n
    # the plan has a bounded number of patterns of sizes up to the capacity
    table = docs.sparkSession.sparkContext.broadcast({s: tuple(np.array(c, np.int64) for c in zip(*x)) for s, x in slots.items()})
    before = parts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("size", "pid", "before")
    rank = placed.join(before, ["size", "pid"]).select("doc_id", "piece", "size", (F.col("near") + F.col("before")).alias("rank"))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = table.value
        for b in batches:
            size, rank_ = np.asarray(b.column("size")), np.asarray(b.column("rank"))
            out = np.zeros(len(size), np.int64)
            for s in np.unique(size).tolist():
                if s:
                    start, first, each = slots[s]
                    at = np.flatnonzero(size == s)
                    i = np.searchsorted(start, rank_[at], "right") - 1
                    out[at] = first[i] + (rank_[at] - start[i]) // each[i]
            yield pa.RecordBatch.from_arrays([pa.array(out), b.column("doc_id"), b.column("piece"), b.column("size").cast(pa.int64())], names=["sequence_id", "doc_id", "piece", "n_tokens"])

    return rank.mapInArrow(assigned, f"sequence_id long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, n_tokens long")


def packing_report(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """One row: sequences, their least possible number, tokens, share of room used, largest sequence."""
    seq = pack(docs, capacity, vocabulary).groupBy("sequence_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("pieces"))
    all_ = seq.agg(F.count_if(F.col("used") > 0).alias("n_sequences"), F.coalesce(F.sum("used"), F.lit(0)).alias("n_tokens"), F.coalesce(F.sum("pieces"), F.lit(0)).alias("n_pieces"), F.coalesce(F.max("used"), F.lit(0)).alias("largest"))
    return all_.withColumn("least_sequences", F.ceil(F.col("n_tokens") / capacity)).withColumn("fill", F.round(F.try_divide(F.col("n_tokens"), F.col("n_sequences") * capacity), 6))
