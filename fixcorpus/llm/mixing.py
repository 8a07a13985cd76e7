"""Problem 9: combine sources so that each has its target share of the tokens.

Method (entropy balancing): rates of use w_d of documents stay as close to 1 as
their Kullback-Leibler divergence allows while each source's tokens meet the
target. The optimum is an exponential tilt, w_d = min(max_repeats, exp(l_s t_d)),
whose multipliers l_s solve a convex dual, one equation per source, by Newton
steps over distributed sums (kept inside a shrinking bracket). Rates are then
rounded to whole copies over the histogram of sizes, so that the rounding error
of a source stays below half of its smallest document, however many partitions
there are.
"""

from __future__ import annotations

import math
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_by_group, materialize
from .tokens import DEFAULT_VOCABULARY, count_tokens

MAX_STEPS = 60
TOLERANCE = 1e-9


def _targets(targets: DataFrame) -> dict[str, tuple[float, int]]:
    """The mix is a parameter table of one row per source."""
    out: dict[str, tuple[float, int]] = {}
    for r in targets.filter("source is not null and target_share > 0").collect():
        out.setdefault(r["source"], (float(r["target_share"]), int(r["max_repeats"] or 1)))
    return out


def solve_rates(sizes: DataFrame, mix: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, tuple[float, float]]:
    """source -> (multiplier per token, target in tokens); sizes: (source, n_tokens, n).

    The total is ``total`` or all tokens there are, less where the scarcest
    source with all its repeats could not reach its share of it.
    """
    have = {r["source"]: (float(r["t"]), float(r["m"])) for r in sizes.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n")).alias("t"), F.max("n_tokens").alias("m")).collect()}
    use = {s: v for s, v in mix.items() if have.get(s, (0, 0))[0] > 0}
    if not use:
        return {}
    scale = sum(v[0] for v in use.values())
    most = min(cap * have[s][0] / (share / scale) for s, (share, cap) in use.items())
    t = min(total or sum(have[s][0] for s in use), most)
    goal = {s: share / scale * t for s, (share, _) in use.items()}
    lam: dict[str, float] = {}
    bracket: dict[str, list[float]] = {}
    for s, (_, cap) in use.items():
        if goal[s] >= cap * have[s][0] * (1 - 1e-12):
            lam[s] = math.inf  # every document with all its repeats
        else:
            lam[s] = 0.0
            bracket[s] = [-50.0, math.log(max(cap, 2))]  # per token of the smallest document: beyond these all rates are at their bounds
    todo = {s for s in lam if lam[s] != math.inf and abs(have[s][0] - goal[s]) > TOLERANCE * goal[s]}
    for _ in range(MAX_STEPS):
        if not todo:
            break
        at = F.create_map(*[x for s in sorted(todo) for x in (F.lit(s), F.lit(lam[s]))])[F.col("source")]
        cap = F.create_map(*[x for s in sorted(todo) for x in (F.lit(s), F.lit(float(use[s][1])))])[F.col("source")]
        free = F.exp(F.least(at * F.col("n_tokens"), F.lit(700.0)))
        used, slope = F.sum(F.least(cap, free) * F.col("n_tokens") * F.col("n")), F.sum(F.when(free < cap, free * F.col("n_tokens") * F.col("n_tokens") * F.col("n")).otherwise(0.0))
        for r in sizes.filter(F.col("source").isin(*todo) & (F.col("n_tokens") > 0)).groupBy("source").agg(used.alias("used"), slope.alias("slope")).collect():
            s, miss = r["source"], r["used"] - goal[r["source"]]
            if abs(miss) <= TOLERANCE * goal[s]:
                todo.discard(s)
                continue
            lo, hi = bracket[s]
            bracket[s] = [lo, min(hi, lam[s])] if miss > 0 else [max(lo, lam[s]), hi]
            lo, hi = bracket[s]
            step = lam[s] - miss / r["slope"] if r["slope"] > 0 else math.nan
            # outside the bracket: halve it, by magnitude where it spans several
            if not lo < step < hi:
                m = have[s][1]
                step = (max(lo, -20 / m) + min(hi, 20 / m)) / 2 if lo < (max(lo, -20 / m) + min(hi, 20 / m)) / 2 < hi else (lo + hi) / 2
            lam[s] = step
    return {s: (lam[s], goal[s]) for s in lam}


def mix_sources(docs: DataFrame, targets: DataFrame, total: float | None = None, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens, rate, copies) of every document of the targets' sources; copies may be 0.

    Documents without tokens (null or empty text) have rate and copies 0; rows
    of other sources or of none give no row; a source without documents leaves
    its share to the others; repeated rows count one by one; empty tables give
    an empty result.
    """
    mix = _targets(targets)
    mine = docs.filter(F.col("source").isin(*mix)) if mix else docs.filter(F.lit(False))
    sizes = materialize(count_tokens(mine, ["doc_id", "source"], vocabulary), "tokens")
    histogram = materialize(sizes.groupBy("source", "n_tokens").agg(F.count("*").alias("n")), "histogram")
    rates = solve_rates(histogram, mix, total)
    cells = round_cells([(r["source"], r["n_tokens"], r["n"]) for r in histogram.collect()], rates, mix)  # a row per source and size
    key = F.xxhash64("source", "n_tokens")
    plan = docs.sparkSession.createDataFrame(cells, "source string, n_tokens long, n long, rate double, low long, extra long").withColumn("key", key).drop("source", "n_tokens")
    # which documents of a cell get one copy more: the first by partition and id; a cell may hold a third of all documents
    counts = sizes.groupBy("source", "n_tokens", "pid").agg(F.count("*").alias("m"))
    before = counts.withColumn("before", F.coalesce(F.sum("m").over(Window.partitionBy("source", "n_tokens").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("m")
    near = F.row_number().over(Window.partitionBy("source", "n_tokens", "pid").orderBy("doc_id"))
    placed = sizes.withColumn("near", near).join(before, ["source", "n_tokens", "pid"]).withColumn("rank", F.col("near") + F.col("before")).withColumn("key", key)
    out = join_by_group(placed, plan, "key", "n")
    return out.select("doc_id", "source", "n_tokens", "rate", (F.col("low") + (F.col("rank") <= F.col("extra")).cast("long")).alias("copies"))


def round_cells(cells: list[tuple[str, int, int]], rates: dict[str, tuple[float, float]], mix: dict[str, tuple[float, int]]) -> list[tuple[str, int, int, float, int, int]]:
    """(source, n_tokens, n, rate, low, extra): every document of a cell gets ``low`` copies, ``extra`` of them one more.

    Cells are taken from the largest documents on; what rounding leaves of a
    source's tokens goes on to its next cell.
    """
    out = []
    error: dict[str, float] = {}
    for s, t, n in sorted(cells, key=lambda c: (c[0], -c[1])):
        if s not in rates or not t:
            out.append((s, t, n, 0.0, 0, 0))
            continue
        lam, cap = rates[s][0], mix[s][1]
        w = float(cap) if lam == math.inf else min(float(cap), math.exp(min(lam * t, 700.0)))
        low = math.floor(w)
        e = error.get(s, 0.0) + (w - low) * n * t
        extra = min(n, max(0, math.floor(e / t + 0.5))) if low < cap else 0
        error[s] = e - extra * t
        out.append((s, t, n, w, low, extra))
    return out


def mix_report(docs: DataFrame, targets: DataFrame, total: float | None = None, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(source, target_share, max_repeats, n_docs, n_used, most_copies, n_tokens, used_tokens, actual_share) per source of the targets."""
    mixed = mix_sources(docs, targets, total, vocabulary)
    per = mixed.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if(F.col("copies") > 0).alias("n_used"), F.max("copies").alias("most_copies"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_tokens") * F.col("copies")).alias("used_tokens"))
    per = materialize(per, "mix")
    whole = per.agg(F.sum("used_tokens").alias("all_tokens"))
    out = F.broadcast(targets.select("source", "target_share", "max_repeats").dropDuplicates(["source"])).join(per, "source", "left").crossJoin(F.broadcast(whole))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_docs", "n_used", "most_copies", "n_tokens", "used_tokens")]
    return out.select("source", "target_share", "max_repeats", *zero, F.round(F.coalesce(F.try_divide("used_tokens", "all_tokens"), F.lit(0.0)), 6).alias("actual_share"))
