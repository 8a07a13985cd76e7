"""Which findings a later stage works on: allow-lists, classifier and estimation targets, evaluation classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import text
from ..functions.vocabulary import RATED
from .severity import is_dependency
from .tables import dimension

# fixed values: titles of clear fixes and of clear non-fixes, and what is neither
CHANGE_URL = r"/pull/|/commit/"
FIX_TITLE = (
    r"\b(?:fix|fixes|fixed|prevent|guard|avoid|patch|resolve)\w*\b[^.\n]{0,45}\b(?:crash|panic|segfault|deadlock|hang|oom|out.of.memory|overflow|underflow|use.after.free|nil (?:pointer|deref)|null (?:pointer|deref)"
    r"|data race|race condition|reorg|consensus|invalid block|dos|denial.of.service|memory leak|infinite loop|out.of.bounds)\b"
)
NON_FIX_TITLE = r"\b(?:feat|feature|refactor|perf|rename|cleanup|clean up|implement|add support|introduce|improve|optimi[sz]e|simplify|migrate|style|move)\b"
BUMP_TITLE = r"\bbump\b|chore\(deps|dependabot|renovate"
NOT_CLEAN = r"^\s*(?:vendor|revert|ci)\b|vendored|third.party|\btest(?:s|ing)?\b|\bsim\b|simulator|evmtool|\binspect\b|pprof|\bflak"
ANY_ID = r"CVE-\d{4}-\d{4,7}|GHSA-"


def allowed(findings: DataFrame, platforms: list[str] | None = None, severities: list[str] | None = None, max_rows: int | None = None, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """Findings of the platforms and severities, the first ``max_rows`` by ``order`` (a limit is the feature)."""
    x = findings
    if platforms is not None:
        x = x.filter(F.col("source_platform").isin(*platforms))
    if severities:
        x = x.filter(F.col("severity").isin(*severities))
    return x.orderBy(*order).limit(max_rows) if max_rows else x


def to_classify(findings: DataFrame, tier: str | None = None) -> DataFrame:
    """Findings that point to a change, optionally of one tier."""
    x = findings.filter(text("source_url").rlike(CHANGE_URL))
    return x.filter(F.col("authority_tier") == tier) if tier is not None else x


def to_estimate(findings: DataFrame, registry: DataFrame, validate: bool = False) -> DataFrame:
    """Findings whose severity is to be estimated: graded own code to validate on, else ungraded own code of known projects."""
    graded, dep = F.lower(text("severity")).isin(*RATED), is_dependency(F.col("title"), F.col("source_url"))
    if validate:
        return findings.filter(graded & ~dep)
    known = registry.select(F.col("slug").alias("source_platform")).dropDuplicates()
    return findings.filter(~graded & ~dep).join(dimension(known), "source_platform", "left_semi")


def eval_class(title: Column, description: Column, url: Column) -> Column:
    """``fix`` by a title that names what it fixes, ``other`` by one that fixes nothing, null where neither is clear."""
    t = text(title)
    change = text(url).rlike(CHANGE_URL)
    fix, bump = P.hits(t, FIX_TITLE), P.hits(t, BUMP_TITLE)
    named = P.hits(F.concat_ws(" ", t, text(description)), ANY_ID)
    return F.when(change & fix & ~bump & ~P.hits(t, NOT_CLEAN), "fix").when(change & P.hits(t, NON_FIX_TITLE) & ~fix & ~bump & ~named, "other")
