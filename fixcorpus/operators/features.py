"""Signals of a finding: regex booleans computed once and reused by score, tier and gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import vocabulary as V
from ..functions.text import text

SCORE_ADMITS, PROBABILITY_ADMITS = 0.5, 0.70


def fresh_path(blob: Column) -> tuple[Column, Column]:
    """A sensitive area is named that no matched keyword already contains.

    An area spelled like a keyword can't be fresh; for each other one, the
    keywords that contain it block it.
    """
    keywords = list(dict.fromkeys(k for g in V.GROUPS.values() for k in g))
    lower = [k.lower() for k in keywords]
    able = [p for p in V.SENSITIVE_PATHS if p.lower() not in lower]
    # every area is looked for in one pass; blockers only where their area was found
    named = F.transform(F.regexp_extract_all(blob, F.lit(P.FLAGS + "(" + P.alternation(able, P.loose) + ")"), 1), F.lower)
    any_fresh = F.lit(False)
    for p in able:
        blockers = [k for k, low in zip(keywords, lower) if p.lower() in low]
        hit = F.array_contains(F.col("named_paths"), p.lower())
        any_fresh = any_fresh | (hit & ~P.hits(blob, P.alternation(blockers, P.loose)) if blockers else hit)
    return named, F.coalesce(any_fresh, F.lit(False))


#: Longer than any keyword of STRONG and MODERATE: what may lie across the end of the title and the start of the description.
ACROSS = 80


def with_features(df: DataFrame) -> DataFrame:
    """Adds ``f_*`` booleans and the normalised texts they rest on."""
    x = df.withColumns({"t": text("title"), "d": text("description"), "sev": F.lower(F.trim(text("severity")))})
    x = x.withColumn("blob", F.concat_ws(" ", "t", "d"))
    blob, t, d = F.col("blob"), F.col("t"), F.col("d")
    # words cut at the ends of this stretch are left out: they'd begin or end where no word does
    head, tail = F.substring(t, -ACROSS, ACROSS), F.substring(d, 1, ACROSS)
    across = F.concat_ws(" ", F.when(F.length(t) > ACROSS, F.regexp_replace(head, r"(?U)^\w+", "")).otherwise(head), F.when(F.length(d) > ACROSS, F.regexp_replace(tail, r"(?U)\w+$", "")).otherwise(tail))
    x = x.withColumns({"f_strong_t": P.hits(t, P.STRONG), "f_strong_d": P.hits(d, P.STRONG), "f_moderate_t": P.hits(t, P.MODERATE), "f_moderate_d": P.hits(d, P.MODERATE)})
    return x.withColumns(
        {
            "f_cve": P.hits(blob, P.CVE),
            "f_advisory": P.hits(blob, P.ADVISORY_ID),
            "f_rated": F.col("sev").isin(*V.RATED),
            "f_high": F.col("sev").isin(*V.HIGH),
            "f_strong": F.col("f_strong_t") | F.col("f_strong_d") | P.hits(across, P.STRONG),
            "f_moderate": F.col("f_moderate_t") | F.col("f_moderate_d") | P.hits(across, P.MODERATE),
            "f_impact_t": P.hits(t, P.FIX_IMPACT),
            "f_impact": P.hits(blob, P.FIX_IMPACT),
            "f_stride": ~F.coalesce(F.nullif(F.trim("stride"), F.lit("")), F.lit("Other")).isin("Other", "nan"),
            "f_cwe": ~F.coalesce(F.nullif(F.trim("cwe_top25"), F.lit("")), F.lit("N/A")).isin("N/A", "nan"),
            "f_silent": F.coalesce(F.col("silent_fix_prob") >= PROBABILITY_ADMITS, F.lit(False)),
        }
    )


def score() -> Column:
    return F.when(F.col("f_cve") | F.col("f_high"), 1.0).when(F.col("f_strong_t"), 0.9).when(F.col("f_strong_d"), 0.8).when(F.col("f_moderate_t"), 0.5).when(F.col("f_moderate_d"), 0.3).otherwise(0.0)


def confidence() -> Column:
    return F.when(F.col("f_cve") | F.col("f_high") | F.col("f_strong_t"), "high").when(F.col("f_cwe") | (F.col("sev") == "medium") | (F.col("score") >= SCORE_ADMITS), "medium").otherwise("low")


#: Columns of evidence that other stages may have added: anything but blanks in one is a signal.
EXTRA_SIGNALS = ("comment_signal", "linked_issue_signal", "backport_signal")


def signals() -> Column:
    """How many of twelve independent signs speak for the finding (the last three are ``EXTRA_SIGNALS``)."""
    each = [F.col(c) for c in ("f_cve", "f_rated", "f_strong", "f_moderate", "f_fresh", "f_impact", "f_stride", "f_cwe", "f_silent")]
    each += [F.trim(text(c)) != "" for c in EXTRA_SIGNALS]
    total = F.lit(0)
    for c in each:
        total = total + c.cast("int")
    return total


def advisory_scope(title: Column) -> Column:
    return F.when(P.hits(title, P.DEP_BUMP) | P.hits(title, P.DEP_ADVISORY), "dependency").otherwise("own_code")


def authority_tier() -> Column:
    contest = F.lower(text("contest"))
    authority = F.col("f_cve") | F.col("f_rated") | contest.contains("advisory") | contest.contains("cve")
    return F.when(authority & (F.col("scope") == "dependency"), "A_dependency").when(authority, "A_authoritative").when(F.col("signal_count") >= 2, "B_corroborated").otherwise("C_candidate")


def verdict(is_fix: Column) -> Column:
    return F.when(is_fix.isNull(), "unassessed").when((is_fix == 0) & ~F.col("f_stride"), "refuted").otherwise("assessed")


def vocabulary_hits(blob: Column) -> dict[str, Column]:
    return {g: P.hits(blob, P.alternation(k, P.loose)) for g, k in V.GROUPS.items()}


def vocabulary_score(hit: dict[str, Column]) -> Column:
    """Largest weight of the groups hit, a little more for each further group, at most 1."""
    fired = sum((c.cast("int") for c in hit.values()), F.lit(0))
    best = F.greatest(*[F.when(c, V.WEIGHTS[g]).otherwise(0.0) for g, c in hit.items()])
    return F.when(fired > 0, F.least(F.lit(1.0), F.round(best + 0.05 * (fired - 1), 3))).otherwise(0.0)


def path_hint(blob: Column) -> Column:
    return F.array_join(P.keyword_list(blob, V.SENSITIVE_PATHS), ",")
