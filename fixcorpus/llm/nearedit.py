"""Problem 2: pairs and groups of records that differ by small edits.

Method (chosen-path join): a record is a set of word triples. In each run a
record follows tokens of its set, each the least one under a hash of (path so
far, choice), so that two sets go on together with a chance of their similarity
whatever their sizes; buckets of at most ``BUCKET`` records are compared by
brute force, those of up to ``BLOCKS`` blocks block against block, larger ones
are split again on further tokens for as long as a split at least halves them.
A bucket of which a split leaves more than half together holds records that are
mostly alike, so that its pairs are mostly results: it is compared in blocks.
Runs are repeated until the target recall holds for pairs at the threshold
however often their buckets are split.

Texts are read once: a table of the shared folder holds the set of every class
(records with the same set, named by a hash of it), and all later stages read
that. Exact copies so meet once in a bucket whatever their number. Bucket rows
carry a minwise sketch of 256 bits; pairs whose sketches rule the threshold out
are not checked further. Remaining pairs are verified on the sets themselves.

A path that one batch alone fills beyond ``BUCKET`` is known to be large there:
its rows are spread over slots instead of meeting in one task, and a mark in the
path's own slot tells those of other batches that they belong to a large bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_ROWS, join_by_group, materialize, parts, release
from .components import link_groups

THRESHOLD = 0.5
WORDS = 3
MIN_DESCRIPTION_WORDS = 30
TARGET_RECALL = 0.999
#: Largest bucket compared by brute force.
BUCKET = 512
#: Records expected in a block (two of them, and five standard deviations, make a bucket); most blocks of a bucket that is compared without further splits.
BLOCK, BLOCKS = 205, 16
#: Tokens a record follows per split after the first two, in which it follows one.
LATER_BRANCH = 4
#: Copies of one set up to this number are listed as all their pairs, above it as pairs with the class's first record (unless ``near_pairs`` is asked for all).
COPIES_AS_PAIRS = 200
#: Records per block where all pairs of a large class are asked for.
COPY_BLOCK = 500
#: Bucket rows per partition of a shuffle: tasks keep their size whatever the number of records.
ROWS_EACH = 400_000
#: Stands for no record: marks a path that is large in another slot.
MARK = -1
#: Positions of a sketch, of two bits each.
SKETCH = 128
COLUMNS = SKETCH // 32
SKETCH_FIELDS = [f"s{i}" for i in range(COLUMNS)]
#: Classes up to this number are sent to all executors (8 bytes each) to filter the sets before they are shuffled.
BROADCAST_CLASSES = 500_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def runs_for(threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold is met with the target recall, whatever the sizes of its sets and however often its buckets are split."""
    stays = 1.0
    for _ in range(100):  # the chance of staying together through any number of later splits (its fixed point)
        stays = 1 - (1 - threshold * stays) ** LATER_BRANCH
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**2 * stays)))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_POWERS = np.cumprod(np.full(64, np.uint64(0x100000001B3), np.uint64))
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(97, 123)]] = True


def _string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column one after the other, and the offsets of its rows."""
    col = col.cast(pa.large_string())
    buf = col.buffers()
    offsets = np.frombuffer(buf[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(buf[2], np.uint8)[offsets[0] : offsets[-1]] if buf[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def shingle_sets(text: pa.Array, lo: np.ndarray | None, hi: np.ndarray | None, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct word n-grams of each (lower-case) text: values, row offsets, words starting in [lo, hi) of each text."""
    data, offsets = _string_bytes(text)
    n = len(text)
    word = _IS_WORD[data] if len(data) else np.zeros(0, bool)
    # a word ends with its row
    prev = np.concatenate([[False], word[:-1]]) if len(word) else word
    starts_row = np.zeros(len(data) + 1, bool)
    starts_row[offsets[:-1]] = True
    starts = np.flatnonzero(word & (~prev | starts_row[:-1])) if len(word) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), np.zeros(n, np.int64)
    at = np.flatnonzero(word)
    of = np.searchsorted(starts, at, "right") - 1
    pos = at - starts[of]
    coeff = _POWERS[pos & 63] ^ (pos >> 6).astype(np.uint64)
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    hashes = mix(np.add.reduceat(data[at].astype(np.uint64) * coeff + (coeff >> np.uint64(7)), first))
    row = np.searchsorted(offsets, starts, "right") - 1
    inside = np.zeros(n, np.int64)
    if lo is not None:
        rel = starts - offsets[row]
        inside = np.bincount(row[(rel >= lo[row]) & (rel < hi[row])], minlength=n)
    k = words
    if len(hashes) < k:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), inside
    g = hashes[: len(hashes) - k + 1].copy()
    for j in range(1, k):
        g = mix(g + np.uint64(j * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) + hashes[j : len(hashes) - k + 1 + j]
    whole = row[: len(g)] == row[k - 1 :]
    g, grow = mix(g[whole]), row[: len(g)][whole]
    order = np.lexsort((g, grow))
    g, grow = g[order], grow[order]
    keep = np.concatenate([[True], (g[1:] != g[:-1]) | (grow[1:] != grow[:-1])]) if len(g) else np.zeros(0, bool)
    g, grow = g[keep], grow[keep]
    return g, np.concatenate([[0], np.cumsum(np.bincount(grow, minlength=n))]), inside


def set_names(g: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A 63-bit name of each set."""
    size = np.diff(off).astype(np.uint64)
    full = size > 0
    out = np.zeros(len(size), np.uint64)
    if full.any():
        out[full] = mix(np.add.reduceat(mix(g ^ _BASE), off[:-1][full]) + size[full])
    return (out >> np.uint64(1)).astype(np.int64)


_PAIRS = np.uint64(0x5555555555555555)


def _minima(g: np.ndarray, off: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Least hash of each (non-empty) set under each of n hash functions."""
    out = np.zeros((n, len(off) - 1), np.uint32)
    low = ((mix(g ^ np.uint64(seed)) if seed else g) >> np.uint64(32)).astype(np.uint32)
    for k in range(n):
        h = low * np.uint32((0x9E3779B1 * (2 * k + 1)) & 0xFFFFFFFF | 1)
        h ^= h >> np.uint32(15)
        h *= np.uint32((0x2C1B3C6D * (2 * k + 3)) & 0xFFFFFFFF | 1)
        out[k] = np.minimum.reduceat(h, off[:-1])
    return out


def _sketches(minima: np.ndarray) -> np.ndarray:
    """Two-bit minwise hashing per set: 128 positions in four columns of 64 bits."""
    out = np.zeros((minima.shape[1], COLUMNS), np.uint64)
    for k in range(SKETCH):
        bits = ((minima[k] * np.uint32(0x297A2D39)) >> np.uint32(30)).astype(np.uint64)
        out[:, k // 32] |= bits << np.uint64(2 * (k % 32))
    return out


def _paths(minima: np.ndarray, runs: int) -> np.ndarray:
    """Bucket of every set after two splits in each run: runs x sets."""
    first, second = minima[: 2 * runs : 2].astype(np.uint64), minima[1 : 2 * runs : 2].astype(np.uint64)
    return mix(mix((first << np.uint64(32)) | second) + np.arange(1, runs + 1, dtype=np.uint64)[:, None] * _BASE)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Positions in which two columns of sketches differ."""
    d = x ^ y
    return np.bitwise_count((d | (d >> np.uint64(1))) & _PAIRS)


def least_agreement(threshold: float) -> int:
    """Agreeing positions below which a pair is ruled out: 4 standard deviations under the mean at the threshold."""
    p = threshold + (1 - threshold) / 4
    return math.floor(SKETCH * p - 4 * math.sqrt(SKETCH * p * (1 - p)))


def _spread(path: np.ndarray, rid: np.ndarray, sketch: np.ndarray, up: np.ndarray) -> pa.RecordBatch:
    """Bucket rows with their slot: 0, or where this batch alone makes a bucket large one of many, besides a mark in slot 0."""
    paths, inv, n = np.unique(path, return_inverse=True, return_counts=True)
    large = n > BUCKET
    slot = np.where(large[inv], (mix(rid.view(np.uint64)) >> np.uint64(44)).astype(np.int32) + 1, 0).astype(np.int32)
    if large.any():
        k = int(large.sum())
        ups = np.zeros(len(paths), up.dtype)
        ups[inv] = up
        path, rid, slot = np.concatenate([path, paths[large]]), np.concatenate([rid, np.full(k, MARK)]), np.concatenate([slot, np.zeros(k, np.int32)])
        sketch, up = np.concatenate([sketch, np.zeros((k, COLUMNS), np.uint64)]), np.concatenate([up, ups[large]])
    return pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(slot), pa.array(rid), pa.array(up), *[pa.array(sketch[:, i].view(np.int64)) for i in range(COLUMNS)]], names=["path", "slot", "rid", "up", *SKETCH_FIELDS])


def _list_values(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row offsets of a column of sets."""
    off = np.asarray(col.offsets).astype(np.int64)
    return np.asarray(col.values)[off[0] : off[-1]].view(np.uint64), off - off[0]


def _bucket_rows(batches: Iterator[pa.RecordBatch], runs: int, seed: int) -> Iterator[pa.RecordBatch]:
    """(rid, tokens) -> a row per run with the bucket after two splits."""
    for b in batches:
        if not b.num_rows:
            continue
        names = np.asarray(b.column("rid"))
        g, off = _list_values(b.column("tokens"))
        minima = _minima(g, off, max(SKETCH, 2 * runs), seed)
        sk = _sketches(minima)
        path, rec = _paths(minima, runs).ravel(), np.tile(np.arange(len(names)), runs)
        yield _spread(path, names[rec], sk[rec], np.zeros(len(rec), np.int64))


def _compare_sorted(path: np.ndarray, rid: np.ndarray, sketch: list[np.ndarray], least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in buckets (equal, adjacent paths) whose sketches agree in enough bits."""
    a, b = [], []
    for d in range(1, most):
        same = np.flatnonzero(path[d:] == path[:-d])
        if not len(same):
            break
        apart = sum(_apart(s[same], s[same + d]).astype(np.int64) for s in sketch)
        near = same[SKETCH - apart >= least]
        a.append(rid[near])
        b.append(rid[near + d])
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(a), np.concatenate(b)
    return np.minimum(a, b), np.maximum(a, b)


def _buckets(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (path, slot, rid) -> kind 0: candidate pair (a, b); kind 1: row (rid, path) of a large bucket, and the size ``up`` of the bucket it was split from."""
    carry: list[np.ndarray] | None = None
    large_path: int | None = None
    done: set[tuple[int, int]] = set()

    def out(kind: int, a: np.ndarray, b: np.ndarray, up: np.ndarray | None = None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(a), pa.array(b), pa.array(np.zeros(len(a), np.int64) if up is None else up)], names=["kind", "a", "b", "up"])

    def work(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        path, rid, up, *sketch = cols
        start = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
        n = np.diff(np.concatenate([start, [len(path)]]))
        # a mark is the first row of its path, as records have names from 0 on
        big = np.repeat((n > BUCKET) | (rid[start] == MARK), n)
        if big.any():
            real = big & (rid != MARK)
            yield out(1, rid[real], path[real], up[real])
        small = ~big & np.repeat(n > 1, n)
        a, b = _compare_sorted(path[small], rid[small], [s[small] for s in sketch], least, BUCKET)
        if len(a):
            pairs = np.unique(np.stack([a, b]), axis=1)
            fresh = [i for i, p in enumerate(zip(pairs[0].tolist(), pairs[1].tolist())) if p not in done]
            if len(done) < 500_000:
                done.update(zip(pairs[0].tolist(), pairs[1].tolist()))
            yield out(0, pairs[0][fresh], pairs[1][fresh])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(c)) for c in ("path", "rid", "up", *SKETCH_FIELDS)]
        cols[3:] = [c.view(np.uint64) for c in cols[3:]]
        slot = np.asarray(batch.column("slot"))
        if slot.any():
            # known to be large where they come from
            far = slot > 0
            yield out(1, cols[1][far], cols[0][far], cols[2][far])
            cols = [c[~far] for c in cols]
            if not len(cols[0]):
                continue
        if carry is not None:
            cols = [np.concatenate([x, y]) for x, y in zip(carry, cols)]
            carry = None
        path, rid = cols[0], cols[1]
        fresh = np.concatenate([[True], (path[1:] != path[:-1]) | (rid[1:] != rid[:-1])])
        cols = [c[fresh] for c in cols]
        if large_path is not None:
            same = cols[0] == large_path
            if same.any():
                yield out(1, cols[1][same], cols[0][same], cols[2][same])
                cols = [c[~same] for c in cols]
            if not len(cols[0]):
                continue
            large_path = None
        last = np.searchsorted(cols[0], cols[0][-1])
        if len(cols[0]) - last > BUCKET:
            large_path = int(cols[0][-1])
            yield from work(cols)
        else:
            carry = [c[last:] for c in cols]
            if last:
                yield from work([c[:last] for c in cols])
    if carry is not None:
        yield from work(carry)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, lo, hi) -> (id, rid, tokens) of every record taking part; tokens are null where the partition has met the class."""
    seen: set[int] = set()
    for b in batches:
        if not b.num_rows:
            continue
        g, off, inside = shingle_sets(b.column("text"), np.asarray(b.column("lo")).astype(np.int64), np.asarray(b.column("hi")).astype(np.int64))
        ok = np.flatnonzero((inside >= MIN_DESCRIPTION_WORDS) & (np.diff(off) > 0))
        if not len(ok):
            continue
        names = set_names(g, off)[ok]
        fresh = np.zeros(len(ok), bool)
        for i, x in enumerate(names.tolist()):
            if x not in seen:
                seen.add(x)
                fresh[i] = True
        tokens = pa.LargeListArray.from_arrays(pa.array(off), pa.array(g.view(np.int64))).cast(pa.list_(pa.int64())).take(pa.array(np.where(fresh, ok, -1), mask=~fresh))
        yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(ok)), pa.array(names), tokens], names=["id", "rid", "tokens"])


def _split(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """(path, rid, n, blocks, tokens) of large buckets of n records -> rows of their pairs of blocks, or where blocks is 0 of their children."""
    for b in batches:
        if not b.num_rows:
            continue
        g, off = _list_values(b.column("tokens"))
        size = np.diff(off)
        sk = _sketches(_minima(g, off, SKETCH))
        path = np.asarray(b.column("path")).view(np.uint64)
        rid, n_records = np.asarray(b.column("rid")), np.asarray(b.column("n"))
        blocks = np.asarray(b.column("blocks")).astype(np.int64)
        parts = []
        deep = np.flatnonzero(blocks == 0)
        if len(deep):
            inner, start = g[np.repeat(blocks == 0, size)], np.concatenate([[0], np.cumsum(size[deep])])
            for j in range(LATER_BRANCH):
                salt = mix(path[deep] * _M2 + np.uint64(level * LATER_BRANCH + j + 1))
                least = np.minimum.reduceat(mix(inner ^ np.repeat(salt, size[deep])), start[:-1])
                parts.append((mix(salt * _M1 + least), deep))
        flat = np.flatnonzero(blocks > 0)
        if len(flat):
            n = blocks[flat]
            rec = np.repeat(flat, n)
            other = np.arange(len(rec)) - np.repeat(np.cumsum(n) - n, n)
            own = (mix(rid[rec].view(np.uint64) ^ path[rec]) % blocks[rec].astype(np.uint64)).astype(np.int64)
            low, high = np.minimum(own, other).astype(np.uint64), np.maximum(own, other).astype(np.uint64)
            parts.append((mix(mix(path[rec] + low * _BASE) + high * _M1 + np.uint64(level)), rec))
        for to, rec in parts:
            for i in range(0, len(rec), 100_000):
                r = rec[i : i + 100_000]
                yield _spread(to[i : i + 100_000], rid[r], sk[r], n_records[r])


def _sets_of(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rid, tokens) of the wanted classes; filtered before the shuffle where their number is small enough to be sent to all."""
    if wanted.count() <= BROADCAST_CLASSES:
        sets = sets.join(F.broadcast(wanted), "rid", "left_semi")
    return sets.dropDuplicates(["rid"])


_ROWS = "path long, slot int, rid long, up long, " + ", ".join(f"{c} long" for c in SKETCH_FIELDS)


def _prepared(vulns: DataFrame) -> DataFrame:
    t, d, u = (F.lower(F.coalesce(F.col(c), F.lit(""))) for c in ("title", "description", "source_url"))
    lo = F.octet_length(t) + 1
    return vulns.filter(F.col("id").isNotNull()).select(F.col("id").cast("string").alias("id"), F.concat(t, F.lit(" "), d, F.lit(" "), u).alias("text"), lo.alias("lo"), (lo + F.octet_length(d)).alias("hi"))


def class_pairs(vulns: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): verified pairs (a, b, similarity) of different sets, and (id, rid) of every record taking part.

    Nulls count as empty text; records whose description has fewer than
    MIN_DESCRIPTION_WORDS words take no part; rows with a null id are left out;
    an empty table gives empty results.
    """
    least = least_agreement(threshold)
    runs = runs_for(threshold, recall)
    base = materialize(_prepared(vulns).mapInArrow(_sets, "id string, rid long, tokens array<long>"), "sets")
    sets = base.filter("tokens is not null").select("rid", "tokens")
    rows = sets.mapInArrow(lambda it: _bucket_rows(it, runs, seed), _ROWS)
    found: list[DataFrame] = []
    level = 2
    expected = base.count() * runs
    while True:
        by_path = rows.repartition(parts(rows, ROWS_EACH, expected), "path", "slot").sortWithinPartitions("path", "slot", "rid")
        out = materialize(by_path.mapInArrow(lambda it: _buckets(it, least), "kind byte, a long, b long, up long"), "buckets")
        found.append(out)
        # records of one class may come from several partitions of the table
        large = out.filter("kind = 1").select(F.col("a").alias("rid"), F.col("b").alias("path"), "up")
        if not large.take(1):
            break
        sized = large.groupBy("path").agg(F.count("*").alias("n"), F.max("up").alias("up"))
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        alike = (F.col("up") > 0) & (2 * F.col("n") > F.col("up"))
        sized = materialize(sized.select("path", "n", F.when((blocks <= BLOCKS) | alike, blocks).otherwise(0).alias("blocks")), "sized")
        expected = sized.agg(F.sum(F.col("n") * F.greatest("blocks", F.when(F.col("blocks") == 0, LATER_BRANCH).otherwise(0)))).first()[0]
        level += 1
        wanted = large.select("rid").distinct()
        tokens = join_by_group(large.select("path", "rid"), sized, "path", "n").join(_sets_of(sets, wanted), "rid").select("path", "rid", "n", "blocks", "tokens")
        rows = tokens.mapInArrow(lambda it, lv=level: _split(it, lv), _ROWS)
    pairs = found[0].filter("kind = 0")
    for f in found[1:]:
        pairs = pairs.unionByName(f.filter("kind = 0"))
    pairs = materialize(pairs.select("a", "b").distinct(), "candidates")
    for f in found:
        release(f)
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("rid"))
    wanted = materialize(sides.select("rid").distinct(), "wanted")
    both = sides.join(_sets_of(sets, wanted), "rid").groupBy("a", "b").agg(F.collect_list("tokens").alias("t"))
    shared = F.size(F.array_intersect(F.col("t")[0], F.col("t")[1]))
    both = both.withColumn("shared", shared).withColumn("united", F.size(F.col("t")[0]) + F.size(F.col("t")[1]) - F.col("shared"))
    good = both.filter(F.col("shared") >= F.lit(threshold) * F.col("united")).select("a", "b", (F.col("shared") / F.col("united")).alias("similarity"))
    verified, members = materialize(good, "pairs"), materialize(base.select("id", "rid").distinct(), "members")
    for x in (pairs, wanted, base):
        release(x)
    return verified, members


def _all_copies(members: DataFrame, sized: DataFrame) -> DataFrame:
    """(id_a, id_b): all pairs of records of one class, block against block, so that no task holds more than two blocks of a class."""
    blocked = sized.filter("n > 1").select("rid", "n", F.ceil(F.col("n") / COPY_BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")
    x = join_by_group(members, blocked, "rid", "n").select("rid", "id", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    x = x.select("rid", "id", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    left, right = x.alias("x"), x.alias("y")
    meet = (F.col("x.rid") == F.col("y.rid")) & (F.col("x.low") == F.col("y.low")) & (F.col("x.high") == F.col("y.high")) & (F.col("x.id") < F.col("y.id"))
    # records of one block meet in the row of that block only
    once = (F.col("x.low") == F.col("x.high")) | (F.col("x.own") != F.col("y.own"))
    return left.join(right, meet & once).select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))


def near_pairs(vulns: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, copies_as_pairs: int | None = COPIES_AS_PAIRS) -> DataFrame:
    """(id_a, id_b), id_a < id_b: pairs of records with similarity at or above the threshold.

    Records of two similar sets are paired one by one. Copies of one set are
    paired with each other up to ``copies_as_pairs`` copies; a larger class gives
    the pairs of its first record with all others (no link is lost), and so do
    pairs of classes of which one is that large. With ``copies_as_pairs`` None
    every pair is listed, also of large classes.
    """
    pairs, members = class_pairs(vulns, threshold, recall)
    sized = materialize(members.groupBy("rid").agg(F.count("*").alias("n"), F.min("id").alias("first")), "classes")
    if copies_as_pairs is None:
        sides = pairs.select("a", "b").join(sized.select(F.col("rid").alias("a"), F.col("n").alias("na")), "a").join(sized.select(F.col("rid").alias("b"), F.col("n").alias("nb")), "b")
        # the records of the smaller class stand beside the pair, those of the larger one are joined to them
        small, large = F.when(F.col("na") <= F.col("nb"), F.col("a")).otherwise(F.col("b")), F.when(F.col("na") <= F.col("nb"), F.col("b")).otherwise(F.col("a"))
        sides = sides.select(small.alias("s"), large.alias("l"), F.greatest("na", "nb").alias("n"))
        one = sides.join(members.select(F.col("rid").alias("s"), F.col("id").alias("ia")), "s")
        across = one.join(members.select(F.col("rid").alias("l"), F.col("id").alias("ib")), "l")
        return across.select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b")).unionByName(_all_copies(members, sized)).filter("id_a <> id_b").distinct()
    many = sized.filter(F.col("n") > copies_as_pairs)
    star = join_by_group(members, many, "rid", "n").filter("id > first").select(F.col("first").alias("id_a"), F.col("id").alias("id_b"))
    # the records of huge classes (at most all rows / HOT_ROWS classes) stay out of the shuffle by class
    huge = sized.filter(F.col("n") > HOT_ROWS).select("rid")
    cool = members.join(F.broadcast(huge), "rid", "left_anti") if huge.take(1) else members
    small = cool.join(sized.filter(F.col("n") <= copies_as_pairs).select("rid", "n"), "rid")
    few = small.filter("n > 1")
    within = few.alias("x").join(few.alias("y"), (F.col("x.rid") == F.col("y.rid")) & (F.col("x.id") < F.col("y.id"))).select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))
    # what stands for a class in pairs of classes: its records, or the first where there are many
    stand = small.select("rid", "id").unionByName(many.select("rid", F.col("first").alias("id")))
    across = pairs.select("a", "b").join(stand.select(F.col("rid").alias("a"), F.col("id").alias("ia")), "a").join(stand.select(F.col("rid").alias("b"), F.col("id").alias("ib")), "b")
    across = across.select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"))
    return across.unionByName(within).unionByName(star).filter("id_a <> id_b").distinct()


def near_groups(vulns: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """(id, class_id, group_id, links): every record taking part, its class of equal sets, its group, its number of similar other classes."""
    pairs, members = class_pairs(vulns, threshold, recall)
    ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = ends.groupBy("a").agg(F.count("*").alias("links")).withColumnRenamed("a", "rid")
    edge = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.hash("a", "b").alias("salt"), F.col("a"), F.col("b")), F.struct(F.col("b").alias("node"), F.hash("a", "b").alias("salt"), F.col("a"), F.col("b")))).alias("e"))
    own = edge.select(F.col("e.node").cast("string").alias("id"), F.concat_ws("-", "e.a", "e.b").alias("key"))
    comp = link_groups(own, "id", [F.col("key")]).select(F.col("id").cast("long").alias("rid"), F.col("group_id").cast("long").alias("comp"))
    classes = members.groupBy("rid").agg(F.min("id").alias("class_id"), F.count("*").alias("n")).join(comp, "rid", "left").join(links, "rid", "left")
    classes = classes.withColumn("comp", F.coalesce("comp", "rid"))
    first = classes.groupBy("comp").agg(F.min("class_id").alias("group_id"))
    classes = classes.join(first, "comp").select("rid", "class_id", "group_id", F.coalesce("links", F.lit(0)).alias("links"), "n")
    out = join_by_group(members, materialize(classes, "classes"), "rid", "n")
    return out.select("id", "class_id", "group_id", "links")
