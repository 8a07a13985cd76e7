"""The gate: ordered drop stages, relevance, and what is known of the survivors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import fix_commit, text
from ..operators import features as X
from ..operators.dedup import fix_commit_key, keep_first
from ..operators.redact import masked
from ..operators.severity import best_estimates, title_case
from ..operators.tables import dimension

STAGES = ("off_registry", "boilerplate", "meta_work", "version_bump", "meta_prefix", "nvd_identity", "low_signal")


def best_scores(scores: DataFrame) -> DataFrame:
    """One classifier row per address: the highest probability, then a total order of the rest; blank addresses go."""
    order = [F.desc_nulls_last("silent_fix_prob"), F.desc_nulls_last("is_security_fix"), *[F.asc_nulls_last(c) for c in ("vuln_class", "model", "prompt_version", "reason")]]
    kept = keep_first(scores.filter("source_url is not null and trim(source_url) <> ''"), ["source_url"], order)
    return kept.select("source_url", F.col("silent_fix_prob").alias("scored_prob"), F.col("is_security_fix").alias("scored_fix"), "vuln_class", F.col("reason").alias("scored_reason"))


def identity_patterns(registry: DataFrame, identities: DataFrame | None = None) -> DataFrame:
    """slug -> pattern that names the project: that of the identity table (slug, pattern), else from the slug itself.

    A slug that neither table knows has none and so fails closed.
    """
    loose = F.regexp_replace(F.lower("slug"), r"[-_ ]+", "[-_ ]?")
    own = registry.select(F.lower(F.trim("slug")).alias("slug"), F.concat(F.lit(r"\b"), loose, F.lit(r"\b")).alias("identity"))
    if identities is None:
        return own
    given = identities.groupBy(F.lower(F.trim("slug")).alias("slug")).agg(F.min("pattern").alias("given"))
    return own.join(given, "slug", "left").select("slug", F.coalesce("given", "identity").alias("identity"))


def predicates() -> dict[str, Column]:
    """What each stage drops, regardless of order (feature columns, ``known`` and ``identity`` must be there)."""
    t = F.col("t")
    bare = P.hits(t, P.BARE_CVE_TITLE)
    return {
        "off_registry": ~F.col("known"),
        "boilerplate": P.hits(F.col("blob"), P.BOILERPLATE),
        "meta_work": P.hits(t, P.NOISE_TITLE) & ~(F.col("f_advisory") | F.col("f_strong_t") | F.col("f_rated")),
        "version_bump": P.hits(t, P.DEP_BUMP) & ~F.col("f_advisory"),
        "meta_prefix": P.hits(t, P.META_PREFIX) & ~F.col("f_advisory") & ~P.hits(F.col("blob"), P.SUPPLY_CHAIN),
        "nvd_identity": bare & ~F.coalesce(F.rlike("d", F.concat(F.lit("(?i)"), "identity")), F.lit(False)),
    }


def relevant() -> Column:
    return F.col("f_cve") | F.col("f_rated") | (F.col("score") >= X.SCORE_ADMITS) | F.col("f_stride") | F.col("f_cwe") | F.col("f_impact_t") | F.col("f_silent")


def judged(vulns: DataFrame, registry: DataFrame, scores: DataFrame | None = None, keep: tuple[str, ...] = (), identities: DataFrame | None = None) -> DataFrame:
    """Every finding with features, ``drop_stage`` (null for survivors) and what the gate derives.

    Credentials are masked first, so that what is scored is what is given out.
    The registry goes to all executors while it is small (see ``dimension``); the
    scores grow with the data and are joined by shuffle. Columns of ``keep`` are
    carried along. Signal columns that the findings lack count as blank.
    """
    extra = [F.col(c) if c in vulns.columns else F.lit(None).cast("string").alias(c) for c in X.EXTRA_SIGNALS]
    vulns = masked(vulns.select(*extra, "id", "source_platform", "contest", "issue_id", "severity", "title", "description", "source_url", "stride", "cwe_top25", "silent_fix_prob", "scraped_at", *keep))
    x = vulns.select(*X.EXTRA_SIGNALS, "id", F.lower(F.trim(text("source_platform"))).alias("source_platform"), "contest", "issue_id", "severity", "title", "description", "source_url", "stride", "cwe_top25", "silent_fix_prob", "scraped_at", *keep)
    if scores is not None:
        x = x.join(best_scores(scores), "source_url", "left").withColumn("silent_fix_prob", F.coalesce("scored_prob", "silent_fix_prob"))
    else:
        x = x.withColumns({"scored_fix": F.lit(None).cast("double"), "vuln_class": F.lit(None).cast("string"), "scored_reason": F.lit(None).cast("string")})
    dims = identity_patterns(registry, identities).dropDuplicates(["slug"]).withColumnRenamed("slug", "source_platform").withColumn("known", F.lit(True))
    x = x.join(dimension(dims), "source_platform", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    x = X.with_features(x)
    named, fresh = X.fresh_path(F.col("blob"))
    x = x.withColumn("named_paths", named)
    x = x.withColumns({"score": X.score(), "f_fresh": fresh, "scope": X.advisory_scope(F.col("t"))})
    x = x.withColumns({"confidence_tier": X.confidence(), "signal_count": X.signals()})
    x = x.withColumns({"authority_tier": X.authority_tier(), "verdict": X.verdict(F.col("scored_fix")), "relevant": relevant(), "fix_commit": fix_commit(F.col("source_url"))})
    stage = F.when(~F.col("relevant"), "low_signal")
    for name, drops in reversed(predicates().items()):
        stage = F.when(drops, name).otherwise(stage)
    return x.withColumn("drop_stage", stage)


#: Columns that the labelling stage gives, of which the first three replace what the gate derived.
LABEL_COLUMNS = ("fix_commit", "introduced_in_commit", "cwe_top25", "layer", "label", "root_cause", "attack_path", "files_changed", "pre_fix_code", "post_fix_code")


def with_labels(x: DataFrame, labels: DataFrame) -> DataFrame:
    """Findings with the labels of their id (kept first by a total order); a blank weakness class is ``N/A``."""
    one = keep_first(labels.filter("id is not null").select("id", *LABEL_COLUMNS), ["id"], [F.asc_nulls_last(c) for c in LABEL_COLUMNS])
    joined = x.drop(*[c for c in LABEL_COLUMNS if c in x.columns]).join(one, "id", "left")
    return joined.withColumn("cwe_top25", F.coalesce(F.nullif("cwe_top25", F.lit("")), F.lit("N/A")))


def with_estimates(x: DataFrame, estimates: DataFrame) -> DataFrame:
    """Findings with the severity estimated for their id, its tiers with a capital letter."""
    est = best_estimates(estimates).withColumn("severity_estimated", title_case(F.col("severity_estimated")))
    return x.join(est, "id", "left")


def curated(vulns: DataFrame, registry: DataFrame, scores: DataFrame | None = None, labels: DataFrame | None = None, estimates: DataFrame | None = None) -> DataFrame:
    """The findings that pass, with what the gate knows of them.

    With ``labels``, rows of one platform that resolve to the same fix commit
    become one, the richest; with ``estimates``, estimated severities follow.
    """
    kept = judged(vulns, registry, scores).filter("drop_stage is null")
    x = kept.select("id", "source_platform", "contest", "issue_id", "severity", "title", "description", "source_url", "stride", "cwe_top25", "silent_fix_prob", "score", "confidence_tier", "signal_count", "authority_tier", "verdict", "fix_commit")
    if labels is not None:
        x = fix_commit_key(with_labels(x, labels)).drop("dedup_score")
    return with_estimates(x, estimates) if estimates is not None else x


def checked(x: DataFrame) -> DataFrame:
    """The same rows; fails on the first one in which a boilerplate notice got through."""
    blob = F.concat_ws(" ", text("title"), text("description"))
    return x.filter(F.when(P.hits(blob, P.BOILERPLATE), F.raise_error(F.concat(F.lit("boilerplate survived: "), F.coalesce("id", F.lit("?"))))).otherwise(F.lit(True)).cast("boolean"))


def report(x: DataFrame, kept: DataFrame) -> DataFrame:
    """(section, value, n): the counts of a build; x is what ``judged`` gives, kept what ``curated`` gives with labels."""
    def counts(df: DataFrame, **by: Column) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit(s).alias("section"), F.coalesce(c.cast("string"), F.lit("")).alias("value")) for s, c in by.items()])).alias("x")
        return df.select(each).groupBy("x.section", "x.value").agg(F.count("*").alias("n"))

    own = F.col("source_platform")
    stages = counts(x, dropped_at=F.coalesce("drop_stage", F.lit("kept")), off_registry_by_source=F.when(F.col("drop_stage") == "off_registry", own), boilerplate_by_source=F.when(F.col("drop_stage") == "boilerplate", own))
    passed = x.filter("drop_stage is null")
    before = counts(passed, by_confidence=F.col("confidence_tier"), by_n_signals=F.col("signal_count"), by_source=own, by_severity=F.col("severity"), by_score=F.bround("score", 1), residual_boilerplate=P.hits(F.col("blob"), P.BOILERPLATE))
    after = counts(kept, by_authority_tier=F.col("authority_tier"), labelled=F.coalesce("label", F.lit("other")) != "other")
    return stages.filter("section = 'dropped_at' or value <> ''").unionByName(before).unionByName(after)


def models(scores: DataFrame) -> DataFrame:
    """One row: the models that scores come from, and whether they are more than one (their thresholds don't compare)."""
    found = F.array_sort(F.collect_set(F.when(F.trim(text("model")) != "", F.trim(text("model")))))
    return scores.agg(found.alias("m")).select(F.array_join("m", ",").alias("models"), (F.size("m") > 1).alias("mixed"))


def stage_counts(x: DataFrame) -> DataFrame:
    return x.groupBy(F.coalesce("drop_stage", F.lit("kept")).alias("stage")).agg(F.count("*").alias("n"))
