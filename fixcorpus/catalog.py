"""All queries by name, and for each the equivalent SQL over the same tables."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import patterns as P
from .functions import text as T
from .functions import vocabulary as V
from .operators import analytics, answers, code, features, labels, normalize, redact, refs, registry, severity, targets, xref
from .operators.dedup import fix_commit_key
from .operators.tables import scratch_dir, spread
from .plans import gate
from .sources import commits, feeds, io, lines, slices

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


#: Tables with texts, of which one or two splits are worth spreading.
TEXTS = ("wallet_vulns", "crawl_rows", "commit_history", "documents")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(d, f"{name}.parquet"))
    return spread(df) if name in TEXTS else df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


# ---------------------------------------------------------------- SQL pieces


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(column: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({column}, {q(pattern)}, 'i'), false)"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def rules(column: str, table_: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {rx(column, p)} THEN {q(n)}" for p, n in table_) + f" ELSE {default} END"


_KEYWORDS = list(dict.fromkeys(k for g in V.GROUPS.values() for k in g))


def _fresh_sql(blob: str) -> str:
    lower = [k.lower() for k in _KEYWORDS]
    parts = []
    for p in V.SENSITIVE_PATHS:
        if p.lower() in lower:
            continue
        blockers = [k for k, low in zip(_KEYWORDS, lower) if p.lower() in low]
        hit = rx(blob, P.alternation([p], P.loose))
        parts.append(f"({hit} AND NOT {rx(blob, P.alternation(blockers, P.loose))})" if blockers else hit)
    return "(" + " OR ".join(parts) + ")"


_SCORES = """
scores AS (
  SELECT source_url, silent_fix_prob AS scored_prob, is_security_fix AS scored_fix FROM (
    SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY silent_fix_prob DESC NULLS LAST, is_security_fix DESC NULLS LAST, vuln_class NULLS LAST, model NULLS LAST, prompt_version NULLS LAST, reason NULLS LAST) AS rn
    FROM silent_fix_scores WHERE source_url IS NOT NULL AND trim(source_url) <> ''
  ) WHERE rn = 1
)"""
#: The shapes as SQL: a neighbour that is no key character is taken along and put back instead of being looked at.
_SECRET_SQL = "(?i)(aws|secret|access[_ -]?key|api[_ -]?key|token|password|credential)([^\\n]{0,39}?[^A-Za-z0-9/+=\\n])[A-Za-z0-9/+=]{40}([^A-Za-z0-9/+=]|$)"


def _masked_sql(column: str) -> str:
    out = column
    for _, shape in redact.SHAPES[:-1]:
        out = f"regexp_replace({out}, {q(shape)}, '{redact.MASK}', 'g')"
    return f"regexp_replace({out}, {q(_SECRET_SQL)}, '{redact.MASK}\\3', 'g')"


def _phrase_sql(column: str) -> str:
    return f"CASE WHEN regexp_matches({column}, {q(redact.PHRASE_CONTEXT)}) AND regexp_matches({column}, {q(redact.WORD_RUN)}) THEN regexp_replace({column}, {q(redact.WORD_RUN)}, '{redact.MASK}', 'g') ELSE {column} END"


_MASKED = f"""
masked0 AS (SELECT * REPLACE ({_masked_sql('title')} AS title, {_masked_sql('description')} AS description) FROM wallet_vulns),
masked AS (SELECT * REPLACE ({_phrase_sql('title')} AS title, {_phrase_sql('description')} AS description) FROM masked0)"""
_BASE = f"""
WITH {_SCORES}, {_MASKED}, base AS (
  SELECT v.id, lower(trim(coalesce(source_platform, ''))) AS source_platform, contest, severity, coalesce(title, '') AS t, coalesce(description, '') AS d, v.source_url,
    coalesce(title, '') || ' ' || coalesce(description, '') AS blob, lower(trim(coalesce(severity, ''))) AS sev, stride, cwe_top25,
    coalesce(s.scored_prob, v.silent_fix_prob) AS prob, s.scored_fix, r.slug IS NOT NULL AS known,
    '\\b' || regexp_replace(r.slug, '[-_ ]+', '[-_ ]?', 'g') || '\\b' AS ident
  FROM masked v LEFT JOIN scores s ON v.source_url = s.source_url
  LEFT JOIN (SELECT DISTINCT lower(trim(slug)) AS slug FROM wallet_registry) r ON r.slug = lower(trim(coalesce(v.source_platform, '')))
), feat AS (
  SELECT *, {rx('blob', P.CVE)} AS f_cve, {rx('blob', P.ADVISORY_ID)} AS f_advisory, sev IN {in_list(V.RATED)} AS f_rated, sev IN {in_list(V.HIGH)} AS f_high,
    {rx('t', P.STRONG)} AS f_strong_t, {rx('d', P.STRONG)} AS f_strong_d, {rx('blob', P.STRONG)} AS f_strong,
    {rx('t', P.MODERATE)} AS f_moderate_t, {rx('d', P.MODERATE)} AS f_moderate_d, {rx('blob', P.MODERATE)} AS f_moderate,
    {rx('t', P.FIX_IMPACT)} AS f_impact_t, {rx('blob', P.FIX_IMPACT)} AS f_impact,
    coalesce(nullif(trim(stride), ''), 'Other') NOT IN ('Other', 'nan') AS f_stride, coalesce(nullif(trim(cwe_top25), ''), 'N/A') NOT IN ('N/A', 'nan') AS f_cwe,
    coalesce(prob >= 0.7, false) AS f_silent, {_fresh_sql('blob')} AS f_fresh,
    CASE WHEN {rx('t', P.DEP_BUMP)} OR {rx('t', P.DEP_ADVISORY)} THEN 'dependency' ELSE 'own_code' END AS scope
  FROM base
), scored AS (
  SELECT *, CASE WHEN f_cve OR f_high THEN 1.0 WHEN f_strong_t THEN 0.9 WHEN f_strong_d THEN 0.8 WHEN f_moderate_t THEN 0.5 WHEN f_moderate_d THEN 0.3 ELSE 0.0 END::DOUBLE AS score,
    (f_cve::INT + f_rated::INT + f_strong::INT + f_moderate::INT + f_fresh::INT + f_impact::INT + f_stride::INT + f_cwe::INT + f_silent::INT) AS signal_count
  FROM feat
), judged AS (
  SELECT *, CASE WHEN f_cve OR f_high OR f_strong_t THEN 'high' WHEN f_cwe OR sev = 'medium' OR score >= 0.5 THEN 'medium' ELSE 'low' END AS confidence_tier,
    CASE WHEN (f_cve OR f_rated OR contains(lower(coalesce(contest, '')), 'advisory') OR contains(lower(coalesce(contest, '')), 'cve')) THEN CASE WHEN scope = 'dependency' THEN 'A_dependency' ELSE 'A_authoritative' END
      WHEN signal_count >= 2 THEN 'B_corroborated' ELSE 'C_candidate' END AS authority_tier,
    CASE WHEN scored_fix IS NULL THEN 'unassessed' WHEN scored_fix = 0 AND NOT f_stride THEN 'refuted' ELSE 'assessed' END AS verdict,
    (f_cve OR f_rated OR score >= 0.5 OR f_stride OR f_cwe OR f_impact_t OR f_silent) AS relevant,
    regexp_extract(coalesce(source_url, ''), '/commit/([0-9a-f]{{7,40}})', 1, 'i') AS fix_commit,
    NOT known AS off_registry, {rx('blob', P.BOILERPLATE)} AS boilerplate,
    {rx('t', P.NOISE_TITLE)} AND NOT (f_advisory OR f_strong_t OR f_rated) AS meta_work,
    {rx('t', P.DEP_BUMP)} AND NOT f_advisory AS version_bump,
    {rx('t', P.META_PREFIX)} AND NOT f_advisory AND NOT {rx('blob', P.SUPPLY_CHAIN)} AS meta_prefix,
    {rx('t', P.BARE_CVE_TITLE)} AND NOT coalesce(regexp_matches(d, ident, 'i'), false) AS nvd_identity
  FROM scored
), staged AS (
  SELECT *, CASE {' '.join(f"WHEN {s} THEN '{s}'" for s in gate.STAGES[:-1])} WHEN NOT relevant THEN 'low_signal' END AS drop_stage FROM judged
), labels AS (
  SELECT * FROM (SELECT id, fix_commit, introduced_in_commit, coalesce(nullif(cwe_top25, ''), 'N/A') AS cwe_top25, label, pre_fix_code, row_number() OVER (PARTITION BY id ORDER BY {', '.join(f'{c} NULLS LAST' for c in gate.LABEL_COLUMNS)}) AS rn FROM wallet_vulns WHERE id IS NOT NULL) WHERE rn = 1
), ranked AS (
  SELECT s.* EXCLUDE (fix_commit), l.fix_commit, l.label,
    CASE WHEN coalesce(l.pre_fix_code, '') IN ('', '[]') THEN 0.0 ELSE 8.0 END + CASE WHEN regexp_matches(coalesce(s.source_url, ''), '/(pull|commit)/') THEN 4.0 ELSE 0.0 END
      + CASE authority_tier WHEN 'A_authoritative' THEN 3.0 WHEN 'B_corroborated' THEN 2.0 WHEN 'A_dependency' THEN 1.5 ELSE 1.0 END + least(length(s.d), 2000) / 1000.0 AS richness,
    coalesce(s.source_platform || '|' || nullif(l.fix_commit, ''), 'id|' || s.id) AS k
  FROM staged s LEFT JOIN labels l ON l.id = s.id WHERE drop_stage IS NULL
), curated AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY richness DESC, id) AS rn FROM ranked) WHERE rn = 1)
"""


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return gate.judged(table(spark, d, "wallet_vulns"), table(spark, d, "wallet_registry"), table(spark, d, "silent_fix_scores"))


def _curated(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "wallet_vulns")
    return gate.curated(v, table(spark, d, "wallet_registry"), table(spark, d, "silent_fix_scores"), labels=v)


def _feature_query(name: str, *columns: str) -> None:
    @query(name, _BASE + f"SELECT id, {', '.join(columns)} FROM staged")
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _judged(spark, d).select("id", *columns)


# ---------------------------------------------------------------- the gate

for _stage in gate.STAGES[:-1]:

    def _predicate(stage: str) -> Query:
        return lambda spark, d: _judged(spark, d).filter(gate.predicates()[stage]).select("id")

    query(f"{ {'off_registry': 'registry', 'boilerplate': 'boilerplate', 'meta_work': 'noise', 'version_bump': 'dep_bump', 'meta_prefix': 'meta_prefix', 'nvd_identity': 'nvd_identity'}[_stage] }_filter", _BASE + f"SELECT id FROM staged WHERE {_stage}")(_predicate(_stage))

_feature_query("security_score", "score")
_feature_query("gate_relevance", "relevant")
_feature_query("confidence_tier", "confidence_tier")
_feature_query("signal_count", "signal_count")
_feature_query("advisory_scope", "scope")
_feature_query("authority_tier", "authority_tier")
_feature_query("security_verdict", "verdict")
_feature_query("fix_commit_extract", "fix_commit")
_feature_query("fresh_path_signal", "f_fresh")


@query("drop_stage_counts", _BASE + "SELECT coalesce(drop_stage, 'kept') AS stage, count(*) AS n FROM staged GROUP BY ALL")
def drop_stage_counts(spark: SparkSession, d: str) -> DataFrame:
    return gate.stage_counts(_judged(spark, d))


@query("curated_findings", _BASE + "SELECT id, source_platform, severity, t AS title, score, confidence_tier, signal_count, authority_tier, verdict, fix_commit FROM curated")
def curated_findings(spark: SparkSession, d: str) -> DataFrame:
    kept = gate.checked(_curated(spark, d))
    return kept.select("id", "source_platform", "severity", T.text("title").alias("title"), "score", "confidence_tier", "signal_count", "authority_tier", "verdict", "fix_commit")


@query("gate_tier_counts", _BASE + "SELECT authority_tier, confidence_tier, count(*) AS n FROM curated GROUP BY ALL")
def gate_tier_counts(spark: SparkSession, d: str) -> DataFrame:
    return _curated(spark, d).groupBy("authority_tier", "confidence_tier").agg(F.count("*").alias("n"))


@query("manifest_counts", _BASE + "SELECT authority_tier, confidence_tier, verdict, grouping_id(authority_tier, confidence_tier, verdict)::INT AS which, count(*) AS n FROM curated GROUP BY GROUPING SETS ((authority_tier), (confidence_tier), (verdict), ())")
def manifest_counts(spark: SparkSession, d: str) -> DataFrame:
    x = _curated(spark, d).select("authority_tier", "confidence_tier", "verdict")
    g = x.groupingSets([["authority_tier"], ["confidence_tier"], ["verdict"], []], "authority_tier", "confidence_tier", "verdict")
    return g.agg(F.grouping_id().cast("int").alias("which"), F.count("*").alias("n"))


def _section(name: str, value: str, source: str, where: str = "") -> str:
    return f"SELECT '{name}' AS section, coalesce(({value})::VARCHAR, '') AS value, count(*) AS n FROM {source} {where} GROUP BY ALL"


@query(
    "build_report",
    _BASE
    + " UNION ALL ".join([
        _section("dropped_at", "coalesce(drop_stage, 'kept')", "staged"),
        _section("off_registry_by_source", "source_platform", "staged", "WHERE drop_stage = 'off_registry' AND source_platform <> ''"),
        _section("boilerplate_by_source", "source_platform", "staged", "WHERE drop_stage = 'boilerplate' AND source_platform <> ''"),
        _section("by_confidence", "confidence_tier", "staged", "WHERE drop_stage IS NULL"), _section("by_n_signals", "signal_count", "staged", "WHERE drop_stage IS NULL"), _section("by_source", "source_platform", "staged", "WHERE drop_stage IS NULL"),
        _section("by_severity", "severity", "staged", "WHERE drop_stage IS NULL"), _section("by_score", "round_even(score, 1)", "staged", "WHERE drop_stage IS NULL"), _section("residual_boilerplate", "boilerplate", "staged", "WHERE drop_stage IS NULL"),
        _section("by_authority_tier", "authority_tier", "curated"), _section("labelled", "coalesce(label, 'other') <> 'other'", "curated"),
    ]),
)
def build_report(spark: SparkSession, d: str) -> DataFrame:
    return gate.report(_judged(spark, d), _curated(spark, d))


@query("score_models", "WITH m AS (SELECT DISTINCT trim(model) AS m FROM silent_fix_scores WHERE trim(coalesce(model, '')) <> '') SELECT coalesce(string_agg(m, ',' ORDER BY m), '') AS models, count(*) > 1 AS mixed FROM m")
def score_models(spark: SparkSession, d: str) -> DataFrame:
    return gate.models(table(spark, d, "silent_fix_scores"))


@query("labels_join", f"WITH l AS (SELECT * FROM (SELECT id, fix_commit, introduced_in_commit, cwe_top25, label, row_number() OVER (PARTITION BY id ORDER BY {', '.join(f'{c} NULLS LAST' for c in gate.LABEL_COLUMNS)}) AS rn FROM wallet_vulns WHERE id IS NOT NULL) WHERE rn = 1) SELECT v.id, l.fix_commit, l.introduced_in_commit, coalesce(nullif(l.cwe_top25, ''), 'N/A') AS cwe_top25, l.label FROM wallet_vulns v LEFT JOIN l ON l.id = v.id")
def labels_join(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "wallet_vulns")
    return gate.with_labels(v.select("id"), v).select("id", "fix_commit", "introduced_in_commit", "cwe_top25", "label")


@query("silent_fix_left_join", f"WITH {_SCORES} SELECT v.id, s.scored_prob, s.scored_fix FROM wallet_vulns v LEFT JOIN scores s ON v.source_url = s.source_url")
def silent_fix_left_join(spark: SparkSession, d: str) -> DataFrame:
    scores = gate.best_scores(table(spark, d, "silent_fix_scores"))
    return table(spark, d, "wallet_vulns").select("id", "source_url").join(scores, "source_url", "left").select("id", "scored_prob", "scored_fix")


@query(
    "fix_commit_dedup",
    """WITH s AS (SELECT id, source_platform, CASE WHEN coalesce(pre_fix_code, '') IN ('', '[]') THEN 0.0 ELSE 8.0 END + CASE WHEN regexp_matches(coalesce(source_url, ''), '/(pull|commit)/') THEN 4.0 ELSE 0.0 END
      + CASE authority_tier WHEN 'A_authoritative' THEN 3.0 WHEN 'B_corroborated' THEN 2.0 WHEN 'A_dependency' THEN 1.5 ELSE 1.0 END + least(length(coalesce(description, '')), 2000) / 1000.0 AS dedup_score,
      coalesce(source_platform || '|' || nullif(fix_commit, ''), 'id|' || id) AS k FROM wallet_vulns)
    SELECT id, round(dedup_score, 6)::DOUBLE AS dedup_score FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY dedup_score DESC, id) AS rn FROM s) WHERE rn = 1""",
)
def fix_commit_dedup(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "wallet_vulns").select("id", "source_platform", "pre_fix_code", "source_url", "authority_tier", "description", "fix_commit")
    return fix_commit_key(x).select("id", F.round("dedup_score", 6).alias("dedup_score"))


# ---------------------------------------------------------------- vocabulary

_TEXTS = "SELECT id, coalesce(title, '') || ' ' || coalesce(description, '') AS blob FROM wallet_vulns"
_GROUP_HITS = f"WITH b AS ({_TEXTS}), h AS (SELECT id, {', '.join(f'{rx("blob", P.alternation(k, P.loose))} AS {g}' for g, k in V.GROUPS.items())} FROM b) "


def _blob() -> F.Column:
    return F.concat_ws(" ", T.text("title"), T.text("description"))


@query("vocab_group_hits", _GROUP_HITS + " UNION ALL ".join(f"SELECT '{g}' AS vocab_group, count(*) FILTER ({g}) AS n FROM h" for g in V.GROUPS))
def vocab_group_hits(spark: SparkSession, d: str) -> DataFrame:
    hit = features.vocabulary_hits(_blob())
    one = table(spark, d, "wallet_vulns").agg(*[F.count_if(c).alias(g) for g, c in hit.items()])
    return one.select(F.explode(F.map_from_arrays(F.array(*[F.lit(g) for g in hit]), F.array(*hit))).alias("vocab_group", "n"))


@query(
    "vocab_score",
    _GROUP_HITS
    + f"SELECT id, CASE WHEN {' + '.join(f'{g}::INT' for g in V.GROUPS)} = 0 THEN 0.0 ELSE least(1.0, round(greatest({', '.join(f'CASE WHEN {g} THEN {w} ELSE 0.0 END' for g, w in V.WEIGHTS.items())})::DOUBLE + 0.05 * ({' + '.join(f'{g}::INT' for g in V.GROUPS)} - 1), 3)) END::DOUBLE AS vocab_score FROM h",
)
def vocab_score(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wallet_vulns").select("id", features.vocabulary_score(features.vocabulary_hits(_blob())).alias("vocab_score"))


@query("standards_coverage", f"WITH b AS ({_TEXTS}) " + " UNION ALL ".join(f"SELECT '{s}' AS standard, count(*) FILTER ({rx('blob', P.alternation(k, P.loose))}) AS n FROM b" for s, k in V.STANDARDS.items()))
def standards_coverage(spark: SparkSession, d: str) -> DataFrame:
    one = table(spark, d, "wallet_vulns").agg(*[F.count_if(P.hits(_blob(), P.alternation(k, P.loose))).alias(s) for s, k in V.STANDARDS.items()])
    return one.select(F.explode(F.map_from_arrays(F.array(*[F.lit(s) for s in V.STANDARDS]), F.array(*V.STANDARDS))).alias("standard", "n"))


@query("path_hint", f"WITH b AS ({_TEXTS}) SELECT id, array_to_string(list_filter([{', '.join(f'CASE WHEN {rx("blob", P.alternation([k], P.loose))} THEN {q(k)} END' for k in V.SENSITIVE_PATHS)}], lambda x: x IS NOT NULL), ',') AS path_hint FROM b")
def path_hint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wallet_vulns").select("id", features.path_hint(_blob()).alias("path_hint"))


_TERMS = "SELECT slug, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS terms FROM (SELECT slug, list_concat(" + f"[{', '.join(q(t) for t in V.CORE_TERMS)}], CASE category {' '.join(f'WHEN {q(c)} THEN [{", ".join(q(t) for t in ts)}]' for c, ts in V.CATEGORY_TERMS.items())} ELSE [] END, CASE {{0}} {' '.join(f'WHEN {q(c)} THEN [{", ".join(q(t) for t in ts)}]' for c, ts in V.LANGUAGE_TERMS.items())} ELSE [] END) AS l FROM {{1}})"


@query("search_terms", _TERMS.format("'js'", "wallet_registry"))
def search_terms(spark: SparkSession, d: str) -> DataFrame:
    return commits.search_terms(table(spark, d, "wallet_registry"))


def _languages(spark: SparkSession, d: str) -> DataFrame:
    """Languages told apart by ecosystem, for the tables name none; a third of the projects stay without."""
    lang = F.create_map(*[F.lit(x) for x in ("evm", "solidity", "bitcoin", "cpp", "cosmos", "go", "solana", "rust")])
    return table(spark, d, "wallet_registry").select("slug", lang[F.col("ecosystem")].alias("language")).filter("language is not null")


_LANG = "CASE ecosystem WHEN 'evm' THEN 'solidity' WHEN 'bitcoin' THEN 'cpp' WHEN 'cosmos' THEN 'go' WHEN 'solana' THEN 'rust' ELSE 'js' END"


@query("search_terms_by_language", _TERMS.format(_LANG, "wallet_registry"))
def search_terms_by_language(spark: SparkSession, d: str) -> DataFrame:
    return commits.search_terms(table(spark, d, "wallet_registry"), _languages(spark, d))


@query("project_languages", f"SELECT slug, {_LANG} AS language FROM wallet_registry")
def project_languages(spark: SparkSession, d: str) -> DataFrame:
    return registry.with_language(table(spark, d, "wallet_registry"), _languages(spark, d)).select("slug", "language")


@query("projects_selected", "SELECT slug FROM wallet_registry WHERE coalesce(tier, 3) <= 1 AND category = 'mobile'")
def projects_selected(spark: SparkSession, d: str) -> DataFrame:
    return registry.selected(table(spark, d, "wallet_registry"), tier=1, category="mobile").select("slug")


@query("project_names", "WITH n AS (SELECT lower(trim(slug)) AS slug, unnest([lower(trim(slug)), replace(lower(trim(slug)), '-', ' '), lower(split_part(repo, '/', -1)), replace(lower(split_part(repo, '/', -1)), '-', ' '), lower(split_part(repo, '/', 1))]) AS name FROM wallet_registry) SELECT DISTINCT slug, name FROM n WHERE length(name) > 3")
def project_names(spark: SparkSession, d: str) -> DataFrame:
    return registry.names(table(spark, d, "wallet_registry"))


@query("project_search_names", "SELECT slug, array_to_string(list_sort(list_distinct(list_filter([replace(slug, '-', ' '), replace(lower(split_part(repo, '/', -1)), '-', ' '), replace(lower(split_part(repo, '/', 1)) || ' ' || lower(split_part(repo, '/', -1)), '-', ' ')], lambda n: length(n) >= 4))), '|') AS names FROM wallet_registry")
def project_search_names(spark: SparkSession, d: str) -> DataFrame:
    return registry.search_names(table(spark, d, "wallet_registry"))


@query("registry_counts", " UNION ALL ".join(f"SELECT '{c}' AS section, coalesce({c}::VARCHAR, '') AS value, count(*) AS n FROM wallet_registry GROUP BY ALL" for c in ("category", "ecosystem", "custody", "tier")))
def registry_counts(spark: SparkSession, d: str) -> DataFrame:
    return registry.introspection(table(spark, d, "wallet_registry"))


@query("label_strategies", "SELECT slug, CASE coalesce(category, 'wallet_sdk') WHEN 'browser_extension' THEN 'signing,transaction,permissions,phishing,connect,provider,keyring,network' WHEN 'mobile' THEN 'signing,transaction,keychain,biometrics,deeplink,webview,backup' WHEN 'desktop' THEN 'signing,transaction,storage,rpc,backup' WHEN 'hardware_firmware' THEN 'crypto,signing,bootloader,secure-element,u2f,display,pin,seed' WHEN 'smart_account' THEN 'validation,signature,module,upgrade,guard,audit' WHEN 'mpc_tss' THEN 'crypto,protocol,share,signing,audit' WHEN 'wallet_sdk' THEN 'crypto,signing,encoding,abi,provider' WHEN 'node_wallet' THEN 'wallet,rpc,consensus,p2p' WHEN 'infra' THEN 'protocol,session,pairing,relay,crypto' ELSE '' END AS areas, CASE WHEN slug = 'nimbus-keys' THEN 'labels_primary' WHEN coalesce(category, '') IN ('hardware_firmware', 'mpc_tss', 'smart_account') THEN 'body_keyword_primary' ELSE 'labels_primary' END AS strategy FROM wallet_registry")
def label_strategies(spark: SparkSession, d: str) -> DataFrame:
    """With one project's strategy overridden."""
    over = spark.createDataFrame([("nimbus-keys", "labels_primary")], "slug string, strategy string")
    return registry.label_strategy(table(spark, d, "wallet_registry"), over).select("slug", F.array_join("area_labels", ",").alias("areas"), "strategy")


@query(
    "project_priorities",
    "WITH y AS (SELECT nullif(regexp_extract(coalesce(source_url, ''), 'https?://(?:www\\.)?[^/]+/([^/]+/[^/?#]+)', 1), '') AS repo, count(*) AS n, count(*) FILTER (silent_fix_prob >= 0.7) AS hits FROM silent_fix_scores GROUP BY 1), c AS (SELECT wallet AS slug, count(DISTINCT sha) AS commits FROM commit_history GROUP BY 1) SELECT r.slug, r.repo, -1 AS stars, coalesce(n, 0) AS judged, coalesce(hits, 0) AS hits, CASE WHEN coalesce(n, 0) >= 5 THEN round(hits / n, 6) END AS rate, CASE WHEN commits > 0 THEN round_even(commits * 0.54::DOUBLE, 0)::BIGINT END AS cost FROM wallet_registry r LEFT JOIN y ON y.repo = r.repo LEFT JOIN c ON c.slug = r.slug",
)
def project_priorities(spark: SparkSession, d: str) -> DataFrame:
    none = spark.createDataFrame([], "slug string, stars int")
    commits_ = table(spark, d, "commit_history").groupBy(F.col("wallet").alias("slug")).agg(F.count_distinct("sha").alias("commits"))
    return registry.priorities(table(spark, d, "wallet_registry"), none, analytics.repo_yield(table(spark, d, "silent_fix_scores")), commits_, least=5)


# ---------------------------------------------------------------- targets


_DEP = f"({rx("coalesce(title, '')", P.DEPENDENCY_TITLE)} OR regexp_matches(coalesce(source_url, ''), 'CHANGELOG|/releases/|nvd\\.nist\\.gov|rustsec'))"
_RATED = "lower(coalesce(severity, '')) IN ('critical', 'high', 'medium', 'low')"


@query("allowed_findings", "SELECT id FROM wallet_vulns WHERE severity IN ('High', 'Critical') ORDER BY id LIMIT 25")
def allowed_findings(spark: SparkSession, d: str) -> DataFrame:
    """The limit is the feature."""
    return targets.allowed(table(spark, d, "wallet_vulns"), severities=["High", "Critical"], max_rows=25).select("id")


@query("classify_targets", "SELECT id FROM wallet_vulns WHERE regexp_matches(coalesce(source_url, ''), '/pull/|/commit/') AND authority_tier = 'B_corroborated'")
def classify_targets(spark: SparkSession, d: str) -> DataFrame:
    return targets.to_classify(table(spark, d, "wallet_vulns"), "B_corroborated").select("id")


@query("estimate_targets", f"SELECT id FROM wallet_vulns WHERE NOT {_RATED} AND NOT {_DEP} AND source_platform IN (SELECT slug FROM wallet_registry)")
def estimate_targets(spark: SparkSession, d: str) -> DataFrame:
    return targets.to_estimate(table(spark, d, "wallet_vulns"), table(spark, d, "wallet_registry")).select("id")


@query("validate_targets", f"SELECT id FROM wallet_vulns WHERE {_RATED} AND NOT {_DEP}")
def validate_targets(spark: SparkSession, d: str) -> DataFrame:
    return targets.to_estimate(table(spark, d, "wallet_vulns"), table(spark, d, "wallet_registry"), validate=True).select("id")


@query(
    "eval_classes",
    f"WITH x AS (SELECT id, coalesce(title, '') AS t, coalesce(title, '') || ' ' || coalesce(description, '') AS b, regexp_matches(coalesce(source_url, ''), '/pull/|/commit/') AS c FROM wallet_vulns) SELECT id, CASE WHEN c AND {rx('t', targets.FIX_TITLE)} AND NOT {rx('t', targets.BUMP_TITLE)} AND NOT {rx('t', targets.NOT_CLEAN)} THEN 'fix' WHEN c AND {rx('t', targets.NON_FIX_TITLE)} AND NOT {rx('t', targets.FIX_TITLE)} AND NOT {rx('t', targets.BUMP_TITLE)} AND NOT {rx('b', targets.ANY_ID)} THEN 'other' END AS class FROM x",
)
def eval_classes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wallet_vulns").select("id", targets.eval_class(F.col("title"), F.col("description"), F.col("source_url")).alias("class"))


# ---------------------------------------------------------------- redaction

def _kind_sql(column: str) -> str:
    """Kinds found, each looked for in what the shapes before it left."""
    parts, out = [], column
    for kind, shape in redact.SHAPES[:-1]:
        parts.append(f"CASE WHEN regexp_matches({out}, {q(shape)}) THEN '{kind}' END")
        out = f"regexp_replace({out}, {q(shape)}, '{redact.MASK}', 'g')"
    parts.append(f"CASE WHEN regexp_matches({out}, {q(_SECRET_SQL)}) THEN 'SECRET' END")
    out = f"regexp_replace({out}, {q(_SECRET_SQL)}, '{redact.MASK}\\3', 'g')"
    parts.append(f"CASE WHEN regexp_matches({out}, {q(redact.PHRASE_CONTEXT)}) AND regexp_matches({out}, {q(redact.WORD_RUN)}) THEN 'MNEMONIC' END")
    return f"coalesce(array_to_string(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL), ','), '')"


def _secrets(spark: SparkSession) -> DataFrame:
    """Made-up secrets, put together here so that no file holds one."""
    hexes, base = "0123456789abcdef" * 4, "Abc123+/" * 5
    words = "copper quiet garlic falcon forest yonder lemon lantern temple acorn glade basin"
    rows = [
        ("s01", "key AKIA" + "ABCDEFGH" * 2, None), ("s02", "", "token gh" + "p_" + "aB3" * 8 + " leaked"), ("s03", "xox" + "b-1234567890-abc", "sk" + "_live_" + "a1" * 10), ("s04", "SG" + "." + "a" * 20 + "." + "b" * 20, "AIza" + "x" * 35),
        ("s05", "sk" + "-" + "a1" * 12, "-----BEGIN EC PRIVATE" + " KEY-----\nabc\n-----END EC PRIVATE" + " KEY-----"), ("s06", "ey" + "J" + "a" * 10 + "." + "b" * 10 + "." + "c" * 10, "xpr" + "v" + "A1b2" * 20), ("s07", "5" + "K1b2" * 12 + "ab", "private key 0x" + hexes),
        ("s08", "aws key: " + base, "password" + base), ("s09", "Seed phrase " + words, words), ("s10", "nothing here", "commit " + hexes[:40]), ("s11", "seed " + hexes + " and token = " + base, "both"),
    ]
    return spark.createDataFrame(rows, "id string, title string, description string")


def _secrets_sql() -> str:
    h, b, w = "repeat('0123456789abcdef', 4)", "repeat('Abc123+/', 5)", "'copper quiet garlic falcon forest yonder lemon lantern temple acorn glade basin'"
    rows = [
        ("s01", "'key AKIA' || repeat('ABCDEFGH', 2)", "NULL"), ("s02", "''", "'token gh' || 'p_' || repeat('aB3', 8) || ' leaked'"), ("s03", "'xox' || 'b-1234567890-abc'", "'sk' || '_live_' || repeat('a1', 10)"), ("s04", "'SG' || '.' || repeat('a', 20) || '.' || repeat('b', 20)", "'AIza' || repeat('x', 35)"),
        ("s05", "'sk' || '-' || repeat('a1', 12)", "'-----BEGIN EC PRIVATE' || ' KEY-----' || chr(10) || 'abc' || chr(10) || '-----END EC PRIVATE' || ' KEY-----'"), ("s06", "'ey' || 'J' || repeat('a', 10) || '.' || repeat('b', 10) || '.' || repeat('c', 10)", "'xpr' || 'v' || repeat('A1b2', 20)"), ("s07", "'5' || repeat('K1b2', 12) || 'ab'", f"'private key 0x' || {h}"),
        ("s08", f"'aws key: ' || {b}", f"'password' || {b}"), ("s09", f"'Seed phrase ' || {w}", w), ("s10", "'nothing here'", f"'commit ' || substr({h}, 1, 40)"), ("s11", f"'seed ' || {h} || ' and token = ' || {b}", "'both'"),
    ]
    return "WITH v(id, title, description) AS (VALUES " + ", ".join(f"('{i}', {t}, {x})" for i, t, x in rows) + ")"


@query("redaction_kinds", f"{_secrets_sql()}, m AS (SELECT id, {_masked_sql('title')} AS title, {_masked_sql('description')} AS description, {_kind_sql('title')} AS title_kinds, {_kind_sql('description')} AS description_kinds FROM v) SELECT id, {_phrase_sql('title')} AS title, {_phrase_sql('description')} AS description, title_kinds, description_kinds FROM m")
def redaction_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Every shape on an inline table, as the curated tables hold none of them."""
    x = redact.redact_columns(_secrets(spark))
    return x.select("id", "title", "description", F.array_join("title_kinds", ",").alias("title_kinds"), F.array_join("description_kinds", ",").alias("description_kinds"))


_TALLY = "k AS (SELECT 'title' AS column_name, unnest(string_split(t, ',')) AS kind FROM f UNION ALL SELECT 'description', unnest(string_split(d, ',')) FROM f) SELECT column_name, kind, count(*) AS n_rows FROM k WHERE kind <> '' GROUP BY ALL"


@query("redaction_tally_inline", f"{_secrets_sql()}, f AS (SELECT {_kind_sql('title')} AS t, {_kind_sql('description')} AS d FROM v), {_TALLY}")
def redaction_tally_inline(spark: SparkSession, d: str) -> DataFrame:
    return redact.tally(_secrets(spark))


@query("redaction_tally", f"WITH f AS (SELECT {_kind_sql('title')} AS t, {_kind_sql('description')} AS d FROM wallet_vulns), {_TALLY}")
def redaction_tally(spark: SparkSession, d: str) -> DataFrame:
    return redact.tally(table(spark, d, "wallet_vulns").select("title", "description"))


@query("redaction_rows", f"WITH f AS (SELECT {_kind_sql('title')} AS t, {_kind_sql('description')} AS d FROM wallet_vulns) SELECT count(*) FILTER (t <> '') AS title_rows, count(*) FILTER (d <> '') AS description_rows FROM f")
def redaction_rows(spark: SparkSession, d: str) -> DataFrame:
    return redact.rows_touched(table(spark, d, "wallet_vulns"))


@query("redact_findings", f"WITH {_MASKED} SELECT id, title, description FROM masked")
def redact_findings(spark: SparkSession, d: str) -> DataFrame:
    return redact.redact_columns(table(spark, d, "wallet_vulns").select("id", "title", "description")).select("id", "title", "description")


# ---------------------------------------------------------------- normalisation


def _present_sql(*columns: str) -> str:
    def one(c: str) -> str:
        s = f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
        return f"CASE WHEN {s} <> '' AND lower({s}) <> 'nan' THEN {s} END"

    return f"coalesce({', '.join(one(c) for c in columns)}, '')"


_SLUG = "regexp_replace(regexp_replace(lower({0}), '[^a-z0-9.\\-]+', '-', 'g'), '^-+|-+$', '', 'g')"
_CRAWL = f"""
WITH n AS (SELECT lower({_present_sql('source')}) AS source_platform, {_present_sql('contest')} AS contest, {_present_sql('issue_id', 'finding_id')} AS issue_id, {_present_sql('severity')} AS sev0,
  {_present_sql('title')} AS title, {_present_sql('description', 'description_excerpt')} AS description, {_present_sql('source_url')} AS source_url, {_present_sql('introduced_in_commit')} AS introduced_in_commit, {_present_sql('scraped_at')} AS scraped_at FROM crawl_rows),
u AS (SELECT *, upper(substr(sev0, 1, 1)) || lower(substr(sev0, 2)) AS severity, {_SLUG.format('contest')} AS contest_slug FROM n WHERE title <> '' OR description <> ''),
w AS (SELECT *, CASE WHEN regexp_replace(issue_id, '^#+', '') <> '' THEN source_platform || ':' || contest_slug || ':' || regexp_replace(issue_id, '^#+', '') ELSE 'unknown:' || substr(sha256(title || chr(10) || description), 1, 16) END AS id FROM u),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY scraped_at, title, description, severity, source_url, introduced_in_commit, contest, source_platform, issue_id) AS rn FROM w) WHERE rn = 1)
"""


@query("keep_first_dedup", _CRAWL + "SELECT id, source_platform, contest_slug, issue_id, severity, title, description, source_url, introduced_in_commit, scraped_at FROM f")
def keep_first_dedup(spark: SparkSession, d: str) -> DataFrame:
    return normalize.findings(table(spark, d, "crawl_rows")).select("id", "source_platform", "contest_slug", "issue_id", "severity", "title", "description", "source_url", "introduced_in_commit", "scraped_at")


@query("severity_normalise", _CRAWL + "SELECT severity, count(*) AS n FROM u GROUP BY ALL")
def severity_normalise(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "crawl_rows")
    kept = x.filter((T.first_present(x, ("title",)) != "") | (T.first_present(x, T.DESCRIPTION_COLUMNS) != ""))
    return kept.groupBy(T.capitalised(T.first_present(x, ("severity",))).alias("severity")).agg(F.count("*").alias("n"))


@query("contest_slug", f"SELECT {_SLUG.format('trim(coalesce(contest, chr(32)))')} AS contest_slug, count(*) AS n FROM wallet_vulns GROUP BY ALL")
def contest_slug(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wallet_vulns").groupBy(T.contest_slug(T.text("contest")).alias("contest_slug")).agg(F.count("*").alias("n"))


_MERGED = """
m AS (SELECT substr(md5(source || ':' || trim(issue_id)), 1, 16) AS id, lower(trim(source)) AS source_platform, trim(issue_id) AS issue_id,
  CASE WHEN trim(coalesce(severity, '')) = '' THEN 'Unrated' WHEN trim(severity) IN ('Unrated', 'Info', 'Low', 'Medium', 'High', 'Critical') THEN trim(severity) WHEN lower(trim(severity)) = 'critical' THEN 'High' ELSE 'Info' END AS severity,
  trim(substr(coalesce(title, ''), 1, 500)) AS title, trim(substr(coalesce(description, ''), 1, 2000)) AS description, coalesce(source_url, '') AS source_url
  FROM crawl_rows WHERE trim(coalesce(source, '')) <> '' AND trim(coalesce(issue_id, '')) <> ''),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY title, description, severity, source_url, source_platform, issue_id) AS rn FROM m) WHERE rn = 1)
"""


@query("merge_rows", f"WITH {_MERGED} SELECT id, source_platform, issue_id, severity, title FROM k")
def merge_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "crawl_rows")
    return normalize.merge_new(rows, normalize.merge_rows(rows).limit(0)).select("id", "source_platform", "issue_id", "severity", "title")


@query("merge_anti_join", f"WITH {_MERGED}, e AS (SELECT DISTINCT substr(md5(source_platform || ':' || issue_id), 1, 16) AS id FROM wallet_vulns) SELECT id, source_platform, issue_id FROM k WHERE id NOT IN (SELECT id FROM e WHERE id IS NOT NULL)")
def merge_anti_join(spark: SparkSession, d: str) -> DataFrame:
    there = table(spark, d, "wallet_vulns").select(T.merge_id(F.col("source_platform"), F.col("issue_id")).alias("id"))
    there = table(spark, d, "wallet_vulns").filter("source_platform is not null and issue_id is not null").select(T.merge_id(F.col("source_platform"), F.col("issue_id")).alias("id"))
    return normalize.merge_new(table(spark, d, "crawl_rows"), there).select("id", "source_platform", "issue_id")


# ---------------------------------------------------------------- cross-reference

_TITLE_KEY = "substr(trim(translate(lower(coalesce(title, '')), {0}, '')), 1, 60)".format(q("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
_XREF = f"""
WITH RECURSIVE src AS (SELECT id, coalesce(source_platform, '') AS p, coalesce(issue_id, '') || ' ' || coalesce(description, '') AS ids, {_TITLE_KEY} AS tk,
  coalesce(introduced_in_commit, '') || ' ' || coalesce(source_url, '') || ' ' || coalesce(description, '') AS w, severity, coalesce(source_url, '') AS url FROM wallet_vulns),
ks AS (SELECT id, 'cve|' || p || '|' || upper(unnest(regexp_extract_all(ids, '(?i)CVE-\\d{{4}}-\\d{{4,7}}'))) AS k FROM src
  UNION SELECT id, 'ghsa|' || p || '|' || upper(unnest(regexp_extract_all(ids, '(?i)GHSA-[0-9a-z]{{4}}-[0-9a-z]{{4}}-[0-9a-z]{{4}}'))) FROM src
  UNION SELECT id, 'title|' || p || '|' || tk FROM src WHERE tk <> ''
  UNION SELECT id, 'sha|' || unnest(regexp_extract_all(w, '\\b[0-9a-f]{{40}}\\b')) FROM src),
star AS (SELECT k, min(id) AS m FROM ks GROUP BY k HAVING count(DISTINCT id) > 1),
e AS (SELECT DISTINCT ks.id AS a, star.m AS b FROM ks JOIN star USING (k) WHERE ks.id <> star.m),
e2 AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS id, b AS other FROM e2 UNION SELECT r.id, e2.b FROM r JOIN e2 ON e2.a = r.other),
c AS (SELECT src.id, least(src.id, coalesce(min(r.other), src.id)) AS cluster FROM src LEFT JOIN r USING (id) GROUP BY src.id)
"""


@query("xref_components", _XREF + "SELECT id, cluster FROM c")
def xref_components(spark: SparkSession, d: str) -> DataFrame:
    return xref.clusters(table(spark, d, "wallet_vulns"))


@query("xref_cluster_sizes", _XREF + ", n AS (SELECT cluster, count(*) AS n_rows FROM c GROUP BY cluster) SELECT n_rows, count(*) AS n_clusters FROM n GROUP BY n_rows")
def xref_cluster_sizes(spark: SparkSession, d: str) -> DataFrame:
    return xref.clusters(table(spark, d, "wallet_vulns")).groupBy("cluster").agg(F.count("*").alias("n_rows")).groupBy("n_rows").agg(F.count("*").alias("n_clusters"))


_RANK = "CASE severity WHEN 'Unrated' THEN 1 WHEN 'Info' THEN 2 WHEN 'Low' THEN 3 WHEN 'Medium' THEN 4 WHEN 'High' THEN 5 WHEN 'Critical' THEN 6 ELSE 0 END"


_REPS = f""", x AS (SELECT c.cluster, c.id, {_RANK} AS rk, url FROM c JOIN src USING (id)),
b AS (SELECT cluster, id AS kept_id, row_number() OVER (PARTITION BY cluster ORDER BY rk DESC, id) AS rn, count(*) OVER (PARTITION BY cluster) AS n_rows, url FROM x),
u AS (SELECT cluster, url, min(id) AS f FROM x WHERE url <> '' GROUP BY ALL), l AS (SELECT cluster, list(url ORDER BY f, url) AS urls FROM u GROUP BY cluster)"""


@query("xref_representative", _XREF + _REPS + " SELECT b.cluster, kept_id, n_rows, array_to_string(CASE WHEN n_rows = 1 THEN [url] ELSE coalesce(urls, []) END, ' ') AS urls FROM b LEFT JOIN l USING (cluster) WHERE rn = 1")
def xref_representative(spark: SparkSession, d: str) -> DataFrame:
    x = xref.representatives(table(spark, d, "wallet_vulns"))
    return x.select("cluster", "kept_id", "n_rows", F.array_join(F.from_json("evidence", "array<string>"), " ").alias("urls"))


@query("xref_dropped", _XREF + _REPS + " SELECT cluster, k.kept_id, x.id AS dropped_id FROM x JOIN (SELECT cluster, kept_id FROM b WHERE rn = 1 AND n_rows > 1) k USING (cluster) WHERE x.id <> k.kept_id")
def xref_dropped(spark: SparkSession, d: str) -> DataFrame:
    return xref.dropped_rows(table(spark, d, "wallet_vulns"))


@query("xref_stats", _XREF.replace("ks AS (", "ks0 AS (").replace("star AS (", "ks AS (SELECT * FROM ks0), star AS (") + ", n AS (SELECT cluster, count(*) AS n FROM c GROUP BY cluster) SELECT sum(n)::BIGINT AS input_rows, count(*) AS output_rows, sum(n - 1)::BIGINT AS duplicates_removed, count(*) FILTER (n > 1) AS clusters_deduped, round(100 * sum(n - 1) / sum(n), 2) AS dedup_rate_pct FROM n")
def xref_stats(spark: SparkSession, d: str) -> DataFrame:
    return xref.dedup_stats(table(spark, d, "wallet_vulns")).drop("sha_merges")


def _ties(spark: SparkSession) -> DataFrame:
    """Ids of which one begins another, equal severities, empty addresses, one address twice."""
    rows = [("x10", "p", "Low", "same title", "http://h/2"), ("x1", "p", "Low", "same title", "http://h/3"), ("x2", "p", "Info", "same title", "http://h/2"), ("y", "p", "High", "alone", ""), ("z1", "q", "Low", "pair", ""), ("z2", "q", "High", "pair", None)]
    return spark.createDataFrame(rows, "id string, source_platform string, severity string, title string, source_url string").withColumns({c: F.lit(None).cast("string") for c in ("issue_id", "description", "introduced_in_commit")})


@query("xref_ties", "SELECT * FROM (VALUES ('x1', 'x1', 3::BIGINT, '[\"http://h/3\",\"http://h/2\"]'), ('y', 'y', 1, '[\"\"]'), ('z1', 'z2', 2, '[]')) AS t(cluster, kept_id, n_rows, evidence)")
def xref_ties(spark: SparkSession, d: str) -> DataFrame:
    return xref.representatives(_ties(spark))


@query("title_key_clusters", f"WITH k AS (SELECT {_TITLE_KEY} AS title_key FROM wallet_vulns) SELECT title_key, count(*) AS n FROM k WHERE title_key <> '' GROUP BY title_key HAVING count(*) > 1")
def title_key_clusters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wallet_vulns").groupBy(T.title_key(F.col("title")).alias("title_key")).agg(F.count("*").alias("n")).filter("title_key is not null and n > 1")


# ---------------------------------------------------------------- labels

_HAY = """
WITH r AS (SELECT lower(trim(slug)) AS slug, category FROM wallet_registry), x AS (
  SELECT id, coalesce(category, '') AS category, coalesce(TRY_CAST(files_changed AS JSON)::VARCHAR[], []) AS files, coalesce(title, '') AS t, coalesce(description, '') AS d
  FROM wallet_vulns v LEFT JOIN r ON r.slug = lower(trim(coalesce(v.source_platform, '')))
), h AS (SELECT *, array_to_string(files, ' ') || ' ' || t || ' ' || d AS hay FROM x)
"""


def _files_all(p: str) -> str:
    return f"(len(files) > 0 AND len(list_filter(files, lambda f: NOT {rx('f', p)})) = 0)"


_LABEL = f"CASE WHEN {_files_all(P.NON_PRODUCT_FILE)} THEN CASE WHEN len(list_filter(files, lambda f: {rx('f', 'tests?/|__tests__|[._-]test\\.|[._-]spec\\.|fixtures?/')})) > 0 THEN 'test' ELSE 'build-ci' END ELSE coalesce(CASE category {' '.join(f'WHEN {q(c)} THEN {rules("hay", [r for t in ts for r in t], "NULL")}' for c, ts in labels.BY_CATEGORY.items())} ELSE {rules('hay', [r for t in labels.DEFAULT_TABLES for r in t], 'NULL')} END, {rules('hay', labels.CROSS, 'NULL')}, 'other') END"


@query("label_assign", _HAY + f"SELECT id, {_LABEL} AS area_label FROM h")
def label_assign(spark: SparkSession, d: str) -> DataFrame:
    return labels.labelled(table(spark, d, "wallet_vulns"), table(spark, d, "wallet_registry")).select("id", "area_label")


_WHY = _HAY.replace("WITH r AS", f"WITH {_SCORES.replace('SELECT source_url, silent_fix_prob', 'SELECT source_url, vuln_class, reason, silent_fix_prob')}, r AS").replace("coalesce(title, '') AS t", "s.vuln_class, coalesce(s.reason, '') AS reason, coalesce(title, '') AS t").replace("FROM wallet_vulns v LEFT JOIN r", "FROM wallet_vulns v LEFT JOIN scores s ON s.source_url = v.source_url LEFT JOIN r").replace("SELECT *, array_to_string", "SELECT *, reason || ' ' || array_to_string(files, ' ') || ' ' || t || ' ' || d AS why, array_to_string")
_BY_CLASS = "CASE vuln_class WHEN 'dos' THEN 'resource_exhaustion' WHEN 'memory' THEN 'missing_bounds_check' WHEN 'overflow' THEN 'integer_overflow_underflow' WHEN 'crypto' THEN 'crypto_misuse' WHEN 'validation' THEN 'missing_input_validation' WHEN 'auth' THEN 'broken_access_control' ELSE 'other' END"


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return labels.labelled(table(spark, d, "wallet_vulns"), table(spark, d, "wallet_registry"), gate.best_scores(table(spark, d, "silent_fix_scores")))


@query("root_cause", _WHY + f"SELECT id, {rules('why', labels.ROOT_CAUSES, _BY_CLASS)} AS cause FROM h")
def root_cause(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d).select("id", "cause")


@query("attack_path", _WHY + f"SELECT id, {rules('why', labels.ATTACK_PATHS, q('unknown'))} AS path FROM h")
def attack_path(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d).select("id", "path")


@query("cause_rules_inline", "SELECT * FROM (VALUES ('a', 'build-ci', 'resource_exhaustion', 'unknown'), ('b', 'test', 'other', 'unknown'), ('c', 'key:seed-mnemonic', 'weak_key_generation', 'malicious_peer'), ('d', 'other', 'race_condition', 'unknown')) AS t(id, area_label, cause, path)")
def cause_rules_inline(spark: SparkSession, d: str) -> DataFrame:
    rows = [("a", '["docs/a.md"]', "notes", "u1"), ("b", '["fixtures/x.json"]', "notes", "u2"), ("c", '["src/a.rs"]', "seed phrase seen by a peer", "u3"), ("d", None, "tidy", "u4")]
    v = spark.createDataFrame(rows, "id string, files_changed string, title string, source_url string").withColumns({"source_platform": F.lit("none"), "description": F.lit(None).cast("string")})
    scores = spark.createDataFrame([("u1", "dos", None), ("u2", "odd", "nothing"), ("u4", "dos", "a race between two writers")], "source_url string, vuln_class string, scored_reason string")
    return labels.labelled(v, table(spark, d, "wallet_registry"), scores).drop("non_product")


@query("non_product_only", _HAY + f"SELECT {_files_all(P.NON_PRODUCT_FILE)} AS non_product, count(*) AS n FROM h GROUP BY ALL")
def non_product_only(spark: SparkSession, d: str) -> DataFrame:
    return labels.labelled(table(spark, d, "wallet_vulns"), table(spark, d, "wallet_registry")).groupBy("non_product").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- code


def _hunks_sql(column: str) -> str:
    """Rows (id, i, file, h, code) of all hunks; documents that are none give no row."""
    return f"""j AS (SELECT id, TRY_CAST({column} AS JSON) AS doc FROM wallet_vulns WHERE starts_with(trim({column}), '[')),
f AS (SELECT id, unnest(range(1, json_array_length(doc)::BIGINT + 1)) AS i, doc FROM j WHERE doc IS NOT NULL AND json_type(doc) = 'ARRAY'),
e AS (SELECT id, i, json_extract(doc, '$[' || (i - 1) || ']') AS entry FROM f),
h AS (SELECT id, i, entry ->> '$.file' AS file, unnest(CASE WHEN json_array_length(entry, '$.hunks') > 0 THEN json_extract(entry, '$.hunks[*]') ELSE [NULL] END) AS hunk FROM e),
n AS (SELECT id, sum(CASE WHEN hunk ->> '$.code' IS NULL THEN NULL ELSE length(hunk ->> '$.code') - length(replace(hunk ->> '$.code', chr(10), '')) + 1 END)::INT AS n_lines FROM h GROUP BY id)"""


@query("loc_histogram", f"WITH {_hunks_sql('post_fix_code')}, b AS (SELECT least(n_lines, 4999) AS loc FROM n WHERE n_lines > 0) SELECT CASE WHEN loc >= 500 THEN 500 WHEN loc >= 200 THEN 200 WHEN loc >= 100 THEN 100 WHEN loc >= 50 THEN 50 WHEN loc >= 30 THEN 30 WHEN loc >= 20 THEN 20 WHEN loc >= 10 THEN 10 WHEN loc >= 5 THEN 5 ELSE 0 END AS bin_from, count(*) AS n FROM b GROUP BY 1")
def loc_histogram(spark: SparkSession, d: str) -> DataFrame:
    return analytics.loc_histogram(table(spark, d, "wallet_vulns"))


@query("loc_median", f"WITH {_hunks_sql('post_fix_code')} SELECT median(n_lines)::DOUBLE AS median_loc, count(*) AS n FROM n WHERE n_lines > 0")
def loc_median(spark: SparkSession, d: str) -> DataFrame:
    return analytics.loc_median(table(spark, d, "wallet_vulns"))


@query("hunk_row_cap")
def hunk_row_cap(spark: SparkSession, d: str) -> DataFrame:
    """Files and lines of both sides, and how many files the row's limit keeps (their JSON's length is that of this engine's writer)."""
    sides = [(c, code.hunks_of(F.col(f"{c}_fix_code"))) for c in ("pre", "post")]
    return table(spark, d, "wallet_vulns").select("id", *[x for c, s in sides for x in (F.size(s).alias(f"{c}_files"), F.size(code.row_cap(s)).alias(f"{c}_kept"), code.line_count(s).alias(f"{c}_lines"))])


@query("changed_lines", f"WITH {_hunks_sql('pre_fix_code').replace('n AS (', 'pre AS (')}, {_hunks_sql('post_fix_code').replace('j AS (', 'j2 AS (').replace('FROM j ', 'FROM j2 ').replace('f AS (', 'f2 AS (').replace('FROM f)', 'FROM f2)').replace('e AS (', 'e2 AS (').replace('FROM e)', 'FROM e2)').replace('h AS (', 'h2 AS (').replace('FROM h ', 'FROM h2 ').replace('n AS (', 'post AS (')} SELECT v.id, coalesce(pre.n_lines, 0) AS pre_lines, coalesce(post.n_lines, 0) AS post_lines FROM wallet_vulns v LEFT JOIN pre USING (id) LEFT JOIN post USING (id)")
def changed_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wallet_vulns").select("id", *[F.coalesce(code.line_count(code.hunks_of(F.col(f"{c}_fix_code"))), F.lit(0)).alias(f"{c}_lines") for c in ("pre", "post")])


_DIFF = "diff --git a/src/a.rs b/src/a.rs\n--- a/src/a.rs\n+++ b/src/a.rs\n@@ -1,3 +1,3 @@ fn x\n keep\n-old\n+new\n+more\n@@ -9 +10 @@\n-gone\ndiff --git a/b.md b/b.md\n@@ -0,0 +1 @@\n+text"


def _diffs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("u1", _DIFF), ("u2", ""), ("u3", None)], "source_url string, diff string")


@query("diff_hunks", "SELECT * FROM (VALUES ('u1', 'src/a.rs,b.md', 'before', 'src/a.rs', 1, 'keep' || chr(10) || 'old'), ('u1', 'src/a.rs,b.md', 'before', 'src/a.rs', 9, 'gone'), ('u1', 'src/a.rs,b.md', 'after', 'src/a.rs', 1, 'keep' || chr(10) || 'new' || chr(10) || 'more'), ('u1', 'src/a.rs,b.md', 'after', 'b.md', 1, 'text')) AS t(source_url, files, side, file, start_line, code)")
def diff_hunks(spark: SparkSession, d: str) -> DataFrame:
    x = code.parse_diffs(_diffs(spark))
    side = F.explode(F.array(F.struct(F.lit("before").alias("side"), F.col("pre").alias("f")), F.struct(F.lit("after").alias("side"), F.col("post").alias("f")))).alias("s")
    x = x.select("source_url", F.array_join("files", ",").alias("files"), side).select("source_url", "files", "s.side", F.explode("s.f").alias("f"))
    return x.select("source_url", "files", "side", "f.file", F.explode("f.hunks").alias("h")).select("source_url", "files", "side", "file", "h.start_line", "h.code")


@query("diff_condensed", "SELECT * FROM (VALUES ('u1', 'diff --git a/src/a.rs b/src/a.rs' || chr(10) || '@@ -1,3 +1,3 @@ fn x' || chr(10) || '-old' || chr(10) || '+new' || chr(10) || '+more' || chr(10) || '@@ -9 +10 @@' || chr(10) || '-gone' || chr(10) || 'diff --git a/b.md b/b.md' || chr(10) || '@@ -0,0 +1 @@' || chr(10) || '+text'), ('u2', ''), ('u3', NULL)) AS t(source_url, short)")
def diff_condensed(spark: SparkSession, d: str) -> DataFrame:
    return _diffs(spark).select("source_url", code.condensed(F.col("diff")).alias("short"))


@query("diffs_join", "SELECT id, CASE WHEN source_url IS NULL THEN NULL WHEN id LIKE '%1' THEN 'd' WHEN id LIKE '%2' THEN '' END AS diff FROM wallet_vulns WHERE source_url IS NULL OR source_url IN (SELECT source_url FROM wallet_vulns GROUP BY 1 HAVING count(*) = 1)")
def diffs_join(spark: SparkSession, d: str) -> DataFrame:
    """Diffs of findings that are alone at their address: some there, some known to be missing, the rest not looked for."""
    v = table(spark, d, "wallet_vulns").select("id", "source_url")
    alone = v.groupBy("source_url").agg(F.count("*").alias("n")).filter("n = 1 and source_url is not null").select("source_url")
    one = v.join(alone, "source_url", "left_semi")
    diffs = one.select("source_url", F.when(F.col("id").endswith("1"), "d").when(F.col("id").endswith("2"), "").alias("diff")).filter("diff is not null")
    return code.with_diffs(one.unionByName(v.filter("source_url is null")), diffs).select("id", "diff")


@query("files_touched", "SELECT least(len(coalesce(TRY_CAST(files_changed AS JSON)::VARCHAR[], [])), 8)::INT AS n_files, count(*) AS n FROM wallet_vulns GROUP BY ALL")
def files_touched(spark: SparkSession, d: str) -> DataFrame:
    return analytics.files_touched(table(spark, d, "wallet_vulns"))


# ---------------------------------------------------------------- severity

_EST = """
est AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY severity_estimated NULLS LAST, severity_source NULLS LAST, impact_type NULLS LAST, reachability NULLS LAST, blast_radius NULLS LAST, severity_why NULLS LAST) AS rn FROM severity_estimates WHERE id IS NOT NULL) WHERE rn = 1)
"""
_GUARD = "CASE WHEN coalesce(reachability = 'local_internal' OR impact_type IN ('local_only', 'none'), false) THEN 'not-eligible' WHEN coalesce(blast_radius = 'client_specific' AND lower(trim(coalesce(severity_estimated, ''))) IN ('critical', 'high') AND impact_type = 'liveness_dos' AND minor, false) THEN 'medium' ELSE coalesce(nullif(lower(trim(coalesce(severity_estimated, ''))), ''), 'not-eligible') END"
_PROV = f"""
WITH {_EST}, x AS (SELECT v.id, lower(trim(coalesce(v.severity, ''))) AS sev, ({rx('v.title', P.DEPENDENCY_TITLE)} OR coalesce(regexp_matches(coalesce(v.source_url, ''), 'CHANGELOG|/releases/|nvd\\.nist\\.gov|rustsec'), false)) AS dep,
  e.id IS NOT NULL AND e.severity_estimated IS NOT NULL AS has, e.severity_estimated, e.impact_type, e.reachability, e.blast_radius, coalesce(r.tier >= 3, false) AS minor
  FROM wallet_vulns v LEFT JOIN est e ON e.id = v.id LEFT JOIN wallet_registry r ON lower(trim(r.slug)) = lower(trim(coalesce(v.source_platform, ''))))
"""


@query("severity_provenance", _PROV + f"SELECT id, CASE WHEN sev IN {in_list(V.RATED)} AND NOT dep THEN sev WHEN dep THEN CASE WHEN sev IN {in_list(V.RATED)} THEN sev ELSE 'not-eligible' END WHEN has THEN {_GUARD} ELSE '' END AS severity_final, CASE WHEN sev IN {in_list(V.RATED)} AND NOT dep THEN 'bounty-graded' WHEN dep THEN 'upstream-cvss' WHEN has THEN 'llm-estimated' ELSE 'unassessed' END AS provenance FROM x")
def severity_provenance(spark: SparkSession, d: str) -> DataFrame:
    return severity.provenance(table(spark, d, "wallet_vulns"), table(spark, d, "severity_estimates"), table(spark, d, "wallet_registry"))


@query("severity_guardrail", f"WITH {_EST}, x AS (SELECT *, true AS minor FROM est) SELECT id, {_GUARD} AS bounded FROM x")
def severity_guardrail(spark: SparkSession, d: str) -> DataFrame:
    e = severity.best_estimates(table(spark, d, "severity_estimates"))
    return e.select("id", severity.guardrail(F.col("severity_estimated"), F.col("impact_type"), F.col("reachability"), F.col("blast_radius"), F.lit(True)).alias("bounded"))


_TIER = "CASE {0} WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END"


@query("tier_agreement", f"WITH {_EST}, x AS (SELECT {_TIER.format('lower(trim(v.severity))')} AS a, {_TIER.format("lower(trim(coalesce(e.severity_estimated, '')))")} AS b FROM wallet_vulns v JOIN est e USING (id) WHERE lower(trim(v.severity)) IN {in_list(V.RATED)}) SELECT count(*) AS n, count(*) FILTER (a = b) AS exact, count(*) FILTER (abs(a - b) <= 1) AS within_one, count(*) FILTER (b = 0) AS not_eligible FROM x")
def tier_agreement(spark: SparkSession, d: str) -> DataFrame:
    return severity.agreement(table(spark, d, "wallet_vulns"), table(spark, d, "severity_estimates"))


@query("confusion_metrics", f"WITH {_SCORES}, x AS (SELECT coalesce(scored_prob >= 0.5, false) AS p, coalesce(scored_fix = 1, false) AS a FROM scores), c AS (SELECT count(*) FILTER (p AND a) AS tp, count(*) FILTER (p AND NOT a) AS fp, count(*) FILTER (NOT p AND a) AS fn, count(*) FILTER (NOT p AND NOT a) AS tn FROM x) SELECT *, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1, round((tp + tn) / nullif(tp + fp + fn + tn, 0), 6) AS accuracy FROM c")
def confusion_metrics(spark: SparkSession, d: str) -> DataFrame:
    x = gate.best_scores(table(spark, d, "silent_fix_scores"))
    return x.agg(*analytics.confusion(F.coalesce(F.col("scored_prob") >= 0.5, F.lit(False)), F.coalesce(F.col("scored_fix") == 1, F.lit(False))))


# ---------------------------------------------------------------- lines and commits

_LINES = f"""
WITH l AS (SELECT doc_id, wallet, published_at, str_split_regex(coalesce(text, ''), '\\r\\n|[\\n\\r]') AS ls FROM documents WHERE doc_kind = 'release_notes'),
p AS (SELECT doc_id, wallet, published_at, ls, unnest(range(1, len(ls) + 1)) AS i FROM l), s AS (SELECT doc_id, wallet, published_at, i - 1 AS pos, ls[i] AS line, array_to_string(ls[greatest(i - 3, 1):i + 3], chr(10)) AS context FROM p),
m AS (SELECT *, regexp_replace(regexp_replace(line, '^[#\\-*>\\s]+', ''), '^\\s+|\\s+$', '', 'g') AS title, substr(sha256(regexp_replace(line, '^\\s+|\\s+$', '', 'g')), 1, 16) AS line_hash, regexp_extract(line, '{P.SEVERITY_WORD}', 1, 'i') AS w FROM s WHERE {rx('line', P.SECURITY_LINE)} AND NOT {rx('line', P.URGENCY)}),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line_hash ORDER BY pos) AS rn FROM m WHERE length(title) >= 10)
"""
_SEV_WORD = "CASE WHEN w = '' THEN 'Info' WHEN lower(w) = 'critical' THEN 'High' ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END"


def _release_lines(spark: SparkSession, d: str) -> DataFrame:
    notes = table(spark, d, "documents").filter("doc_kind = 'release_notes'")
    return lines.security_lines(notes, "doc_id", "text")


@query("release_lines", _LINES + f"SELECT doc_id, pos::INT AS pos, title, {_SEV_WORD} AS severity, line_hash FROM k WHERE rn = 1")
def release_lines(spark: SparkSession, d: str) -> DataFrame:
    return _release_lines(spark, d).select(F.col("key").alias("doc_id"), "pos", "title", "severity", "line_hash")


@query("release_context", _LINES + "SELECT doc_id, pos::INT AS pos, context FROM k WHERE rn = 1")
def release_context(spark: SparkSession, d: str) -> DataFrame:
    return _release_lines(spark, d).select(F.col("key").alias("doc_id"), "pos", "context")


@query("changelog_lines", _LINES.replace(f" AND NOT {rx('line', P.URGENCY)}", "") + f"SELECT doc_id, pos::INT AS pos, title, {_SEV_WORD} AS severity, 'CHANGELOG#' || line_hash AS issue_id FROM k WHERE rn = 1")
def changelog_lines(spark: SparkSession, d: str) -> DataFrame:
    """The changelog's rule (lines on urgency stay) over the release notes."""
    notes = table(spark, d, "documents").filter("doc_kind = 'release_notes'")
    x = lines.security_lines(notes, "doc_id", "text", skip_urgency=False)
    return x.select(F.col("key").alias("doc_id"), "pos", "title", "severity", F.concat(F.lit("CHANGELOG#"), "line_hash").alias("issue_id"))


_LINE = "chr(10) || '- Critical security fix of the parser' || chr(10) || 'end'"


@query("changelog_rows", f"SELECT 'w' AS source, 'o/r' AS contest, 'CHANGELOG#' || substr(sha256('- Critical security fix of the parser'), 1, 16) AS issue_id, 'High' AS severity, 'Critical security fix of the parser' AS title, '# 1.0' || {_LINE} || chr(10) || 'x' || chr(10) || 'high-urgency security release here' AS description, 'https://github.com/o/r/blob/main/ChangeLog.md#L2' AS source_url, '' AS introduced_in_commit UNION ALL SELECT 'w', 'o/r', 'CHANGELOG#' || substr(sha256('high-urgency security release here'), 1, 16), 'High', 'high-urgency security release here', '- Critical security fix of the parser' || chr(10) || 'end' || chr(10) || 'x' || chr(10) || 'high-urgency security release here', 'https://github.com/o/r/blob/main/ChangeLog.md#L5', ''")
def changelog_rows(spark: SparkSession, d: str) -> DataFrame:
    body = "# 1.0\n- Critical security fix of the parser\nend\nx\nhigh-urgency security release here"
    rows = [("w", "o/r", "main", "HISTORY.md", "a panic in the other file"), ("w", "o/r", "main", "ChangeLog.md", body), ("w", "o/r", "main", "CHANGELOG.md", ""), ("w", "o/q", "main", "notes.txt", "a panic in the wrong file")]
    return lines.changelog_rows(spark.createDataFrame(rows, "source string, repo string, branch string, path string, content string"))


@query("release_rows", f"SELECT 'w' AS source, 'o/r' AS contest, 'RELEASE#v1#' || substr(sha256('- Critical security fix of the parser'), 1, 8) AS issue_id, 'High' AS severity, 'Critical security fix of the parser' AS title, '[v1] # 1.0' || {_LINE} || chr(10) || 'x' || chr(10) || 'high-urgency security release here' AS description, 'u' AS source_url, '' AS introduced_in_commit")
def release_rows(spark: SparkSession, d: str) -> DataFrame:
    body = "# 1.0\n- Critical security fix of the parser\nend\nx\nhigh-urgency security release here"
    return lines.release_rows(spark.createDataFrame([("w", "o/r", "v1", body, "u"), ("w", "o/r", "v2", None, "u")], "source string, repo string, tag_name string, body string, html_url string"))


@query("release_earliest", _LINES + "SELECT wallet, title, published_at, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY wallet, title ORDER BY published_at NULLS LAST, doc_id, pos) AS r2 FROM k WHERE rn = 1) WHERE r2 = 1")
def release_earliest(spark: SparkSession, d: str) -> DataFrame:
    notes = table(spark, d, "documents").select(F.col("doc_id").alias("key"), "wallet", "published_at")
    x = _release_lines(spark, d).join(notes, "key")
    return lines.earliest(x, "published_at", ["key", "pos"]).select("wallet", "title", "published_at", F.col("key").alias("doc_id"))


_COMMITS = "c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY ingested_at NULLS LAST, committed_at NULLS LAST, wallet NULLS LAST, subject NULLS LAST, body NULLS LAST, patch_id NULLS LAST) AS rn FROM commit_history WHERE sha IS NOT NULL) WHERE rn = 1)"


@query("commit_rows", f"WITH {_COMMITS}, m AS (SELECT *, regexp_extract(subject, '{P.SEVERITY_WORD}', 1, 'i') AS w FROM c WHERE trim(coalesce(subject, '')) <> '' AND NOT regexp_matches(subject, '^(Merge|Revert) ')) SELECT wallet AS source, 'COMMIT#' || substr(sha, 1, 12) AS issue_id, {_SEV_WORD} AS severity, substr(subject, 1, 120) AS title, coalesce(body, '') AS description FROM m")
def commit_rows(spark: SparkSession, d: str) -> DataFrame:
    return commits.commit_rows(table(spark, d, "commit_history"))


@query("backport_flag", "WITH p AS (SELECT DISTINCT sha, patch_id FROM commit_history WHERE sha IS NOT NULL AND coalesce(patch_id, '') <> ''), m AS (SELECT patch_id FROM p GROUP BY patch_id HAVING count(*) > 1), b AS (SELECT DISTINCT sha FROM p JOIN m USING (patch_id)) SELECT sha, sha IN (SELECT sha FROM b) AS is_backport FROM (SELECT DISTINCT sha FROM commit_history WHERE sha IS NOT NULL)")
def backport_flag(spark: SparkSession, d: str) -> DataFrame:
    return commits.backports(table(spark, d, "commit_history"))


@query("source_ext_filter", f"WITH {_COMMITS} SELECT substr(sha1(wallet || ':' || sha), 1, 16) AS id, substr(sha, 1, 12) AS issue_id, len(files)::INT AS n_files FROM c WHERE coalesce(len(files), 0) BETWEEN 1 AND 60 AND NOT regexp_matches(coalesce(subject, ''), '^Merge ') AND len(list_filter(files, lambda f: regexp_extract(f, '[^/.][^/]*?(\\.[^./]*)$', 1) IN {in_list(V.SOURCE_EXTENSIONS)})) > 0")
def source_ext_filter(spark: SparkSession, d: str) -> DataFrame:
    return commits.source_commits(table(spark, d, "commit_history")).select("id", "issue_id", "n_files")


@query("commit_term_hits", f"WITH {_COMMITS}, b AS (SELECT wallet, sha, committed_at, coalesce(subject, '') || chr(10) || coalesce(body, '') AS msg FROM c), t AS (" + " UNION ALL ".join(f"SELECT wallet, sha, committed_at, {q(k)} AS term FROM b WHERE {rx('msg', P.alternation([k], P.loose))}" for k in V.CORE_TERMS) + ") SELECT wallet, term, sha FROM (SELECT *, row_number() OVER (PARTITION BY wallet, term ORDER BY committed_at DESC NULLS LAST, sha) AS rn FROM t) WHERE rn <= 200")
def commit_term_hits(spark: SparkSession, d: str) -> DataFrame:
    return commits.term_hits(table(spark, d, "commit_history"))


_NAMES = "n AS (SELECT DISTINCT slug, name FROM (SELECT lower(trim(slug)) AS slug, unnest([lower(trim(slug)), replace(lower(trim(slug)), '-', ' '), lower(split_part(repo, '/', -1)), replace(lower(split_part(repo, '/', -1)), '-', ' '), lower(split_part(repo, '/', 1))]) AS name FROM wallet_registry) WHERE length(name) > 3)"


@query("cross_mentions", f"WITH {_COMMITS}, {_NAMES}, t AS (SELECT sha, lower(coalesce(wallet, '')) AS own, lower(coalesce(subject, '') || ' ' || substr(coalesce(body, ''), 1, 2000)) AS txt FROM c), m AS (SELECT DISTINCT sha, slug FROM t JOIN n ON contains(txt, name) AND own <> slug) SELECT sha, string_agg(slug, ', ' ORDER BY slug) AS mentions FROM m GROUP BY sha")
def cross_mentions(spark: SparkSession, d: str) -> DataFrame:
    return commits.cross_mentions(table(spark, d, "commit_history"), table(spark, d, "wallet_registry"))


@query("mention_rows", "SELECT * FROM (VALUES ('opal-keys', 'cross_client', 'PR#1', 'High', 'Same seed phrase bug', '[cross-wallet: juniper-vault, nimbus-keys] As in Nimbus Keys and juniper-vault', 'u1', ''), ('opal-keys', 'cross_client', 'PR#2', 'Medium', 'Port from nimbuslabs', '[cross-wallet: nimbus-keys] ', 'u2', '')) AS t(source, contest, issue_id, severity, title, description, source_url, introduced_in_commit)")
def mention_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = [("opal-keys", 1, "Same seed phrase bug", "As in Nimbus Keys and juniper-vault", "u1"), ("opal-keys", 1, "Same seed phrase bug", "As in Nimbus Keys and juniper-vault", "u1"), ("opal-keys", 2, "Port from nimbuslabs", None, "u2"), ("opal-keys", 3, "Only opal-keys here", "", "u3")]
    return commits.mention_rows(spark.createDataFrame(rows, "source string, number int, title string, body string, url string"), table(spark, d, "wallet_registry").filter(F.col("slug").isin("nimbus-keys", "juniper-vault", "opal-keys")))


@query("issue_kind_counts", "SELECT CASE " + " ".join(f"WHEN starts_with(coalesce(issue_id, ''), '{p}') THEN '{p.rstrip('#-')}'" for p in V.ISSUE_PREFIXES) + " ELSE 'unknown' END AS issue_kind, count(*) AS n FROM wallet_vulns GROUP BY ALL")
def issue_kind_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wallet_vulns").groupBy(T.issue_kind(F.col("issue_id")).alias("issue_kind")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- analytics


@query("repo_yield", "WITH x AS (SELECT nullif(regexp_extract(coalesce(source_url, ''), 'https?://(?:www\\.)?[^/]+/([^/]+/[^/?#]+)', 1), '') AS repo, silent_fix_prob AS p FROM silent_fix_scores) SELECT repo, count(*) AS n, count(*) FILTER (p >= 0.7) AS hits, CASE WHEN count(*) >= 150 THEN round(count(*) FILTER (p >= 0.7) / count(*), 6) END AS rate FROM x WHERE repo IS NOT NULL GROUP BY repo")
def repo_yield(spark: SparkSession, d: str) -> DataFrame:
    return analytics.repo_yield(table(spark, d, "silent_fix_scores"))


_LAYERS = ["key", "sign", "transport", "platform", "ui", "approval", "contract", "mpc", "firmware", "other"]


@query("platform_layer_pivot", "WITH x AS (SELECT lower(trim(coalesce(source_platform, ''))) AS wallet_platform, " + ", ".join(f"count(*) FILTER (layer = '{x}') AS \"{x}\"" for x in _LAYERS) + " FROM wallet_vulns GROUP BY 1), y AS (SELECT *, " + " + ".join(f'"{x}"' for x in _LAYERS) + " AS total FROM x) SELECT * FROM y WHERE total > 5")
def platform_layer_pivot(spark: SparkSession, d: str) -> DataFrame:
    return analytics.platform_layers(table(spark, d, "wallet_vulns"), _LAYERS)


@query("area_severity_matrix", "SELECT coalesce(label, '') AS row_value, lower(trim(coalesce(severity, ''))) AS column_value, count(*) AS n FROM wallet_vulns GROUP BY ALL")
def area_severity_matrix(spark: SparkSession, d: str) -> DataFrame:
    return analytics.matrix(table(spark, d, "wallet_vulns"), T.text("label"), F.lower(F.trim(T.text("severity"))))


@query("top_root_causes", "SELECT root_cause AS value, count(*) AS n FROM wallet_vulns WHERE root_cause IS NOT NULL AND root_cause NOT IN ('other') GROUP BY 1 ORDER BY n DESC, value LIMIT 9")
def top_root_causes(spark: SparkSession, d: str) -> DataFrame:
    return analytics.top(table(spark, d, "wallet_vulns"), "root_cause", 9, ("other",))


@query("top_attack_paths", "SELECT attack_path AS value, count(*) AS n FROM wallet_vulns WHERE attack_path IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 8")
def top_attack_paths(spark: SparkSession, d: str) -> DataFrame:
    return analytics.top(table(spark, d, "wallet_vulns"), "attack_path", 8)


@query("top_labels", "SELECT label AS value, count(*) AS n FROM wallet_vulns WHERE label IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 14")
def top_labels(spark: SparkSession, d: str) -> DataFrame:
    return analytics.top(table(spark, d, "wallet_vulns"), "label", 14)


@query("cause_tier_matrix", "SELECT coalesce(root_cause, '') AS row_value, coalesce(authority_tier, '') AS column_value, count(*) AS n FROM wallet_vulns GROUP BY ALL")
def cause_tier_matrix(spark: SparkSession, d: str) -> DataFrame:
    return analytics.matrix(table(spark, d, "wallet_vulns"), T.text("root_cause"), T.text("authority_tier"))


@query("rows_by_column", " UNION ALL ".join(f"SELECT '{c}' AS section, coalesce({c}::VARCHAR, '') AS value, count(*) AS n FROM wallet_vulns GROUP BY ALL" for c in ("source_platform", "severity", "stride")))
def rows_by_column(spark: SparkSession, d: str) -> DataFrame:
    return analytics.counts_by(table(spark, d, "wallet_vulns"), **{c: F.col(c) for c in ("source_platform", "severity", "stride")})


@query("tier_disagreements", f"WITH {_EST}, x AS (SELECT lower(trim(coalesce(v.severity, ''))) AS graded, lower(trim(coalesce(e.severity_estimated, ''))) AS estimated FROM wallet_vulns v JOIN est e USING (id)) SELECT graded, estimated, count(*) AS n FROM x WHERE graded IN ('critical', 'high', 'medium', 'low') AND graded <> estimated GROUP BY ALL ORDER BY n DESC, graded, estimated LIMIT 12")
def tier_disagreements(spark: SparkSession, d: str) -> DataFrame:
    return severity.disagreements(table(spark, d, "wallet_vulns"), table(spark, d, "severity_estimates"))


@query("unresolved_sample", "WITH x AS (SELECT id, CASE " + " ".join(f"WHEN starts_with(coalesce(issue_id, ''), '{p}') THEN '{p.rstrip('#-')}'" for p in V.ISSUE_PREFIXES) + " ELSE 'unknown' END AS issue_kind FROM wallet_vulns WHERE NOT regexp_full_match(trim(coalesce(introduced_in_commit, '')), '[0-9a-fA-F]{7,40}')) SELECT issue_kind, id FROM (SELECT *, row_number() OVER (PARTITION BY issue_kind ORDER BY id) AS rn FROM x) WHERE rn <= 10")
def unresolved_sample(spark: SparkSession, d: str) -> DataFrame:
    return refs.unresolved(table(spark, d, "wallet_vulns"))


def _cov(c: str, name: str) -> str:
    return f"round(100 * avg(coalesce({c}, false)::INT), 4) AS {name}"


@query("coverage_metrics", "SELECT " + ", ".join([_cov("trim(fix_commit) <> ''", "fix_commit"), _cov("trim(introduced_in_commit) <> ''", "introduced_in_commit"), _cov("trim(files_changed) <> '' AND files_changed <> '[]'", "files_changed"), _cov("trim(pre_fix_code) <> '' AND pre_fix_code <> '[]'", "pre_fix_code"), _cov("trim(stride) <> '' AND stride <> 'Other'", "stride"), _cov("trim(cwe_top25) <> '' AND cwe_top25 <> 'N/A'", "cwe_top25"), _cov("lower(severity) IN ('critical', 'high', 'medium', 'low')", "rated"), _cov("silent_fix_prob IS NOT NULL", "silent_fix_prob")]) + " FROM wallet_vulns")
def coverage_metrics(spark: SparkSession, d: str) -> DataFrame:
    return analytics.coverage(table(spark, d, "wallet_vulns"))


@query("dominance_share", "WITH g AS (SELECT lower(trim(coalesce(source_platform, ''))) AS v, count(*) AS n FROM wallet_vulns GROUP BY 1) SELECT max(n) AS largest, sum(n)::BIGINT AS total, count(*) AS n_values, round(max(n) / sum(n), 6) AS share FROM g")
def dominance_share(spark: SparkSession, d: str) -> DataFrame:
    return analytics.dominance(table(spark, d, "wallet_vulns"), F.lower(F.trim(T.text("source_platform"))))


@query("class_sample", f"WITH {_SCORES}, x AS (SELECT source_url, CASE WHEN scored_fix = 1 THEN 'fix' ELSE 'other' END AS class FROM scores) SELECT source_url, class FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY md5('7:' || source_url), source_url) AS rn FROM x) WHERE rn <= 40")
def class_sample(spark: SparkSession, d: str) -> DataFrame:
    x = gate.best_scores(table(spark, d, "silent_fix_scores"))
    return analytics.sample_per_class(x, "source_url", F.when(F.col("scored_fix") == 1, "fix").otherwise("other"), 40, 7).select("source_url", "class")


@query("preview_projection", "SELECT id, source_platform, severity, substr(title, 1, 70) AS title, confidence FROM wallet_vulns")
def preview_projection(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wallet_vulns").select("id", "source_platform", "severity", F.substring("title", 1, 70).alias("title"), "confidence")


_KIND = "CASE " + " ".join(f"WHEN starts_with(coalesce(issue_id, ''), '{p}') THEN '{p.rstrip('#-')}'" for p in V.ISSUE_PREFIXES) + " ELSE 'unknown' END"
_NUMBER = "coalesce(" + ", ".join(f"nullif(regexp_extract(coalesce(description, ''), {q(refs.CHANGE)}, {i}), '')" for i in (1, 2, 3, 4)) + ")"


@query("inline_reference", f"SELECT id, CASE WHEN regexp_extract(coalesce(description, ''), '/commit/([0-9a-f]{{7,40}})', 1) <> '' THEN 'commit:' || regexp_extract(description, '/commit/([0-9a-f]{{7,40}})', 1) WHEN {_NUMBER} IS NOT NULL THEN 'pr:' || {_NUMBER} ELSE '' END AS reference FROM wallet_vulns")
def inline_reference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wallet_vulns").select("id", refs.inline_reference(F.col("description")).alias("reference"))


@query("blame_coverage", f"SELECT {_KIND} AS issue_kind, count(*) AS n, count(*) FILTER (regexp_full_match(trim(coalesce(introduced_in_commit, '')), '[0-9a-fA-F]{{7,40}}')) AS resolved, round(100 * count(*) FILTER (regexp_full_match(trim(coalesce(introduced_in_commit, '')), '[0-9a-fA-F]{{7,40}}')) / count(*), 4) AS coverage FROM wallet_vulns GROUP BY 1")
def blame_coverage(spark: SparkSession, d: str) -> DataFrame:
    return refs.coverage(table(spark, d, "wallet_vulns"))


@query("parent_resolution", "SELECT * FROM (VALUES ('a', 'p1'), ('b', 'p2'), ('c', 'p3'), ('d', 'old'), ('e', 'p4'), ('f', NULL), ('g', 'old')) AS t(id, introduced_in_commit)")
def parent_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Every kind of reference on inline tables, as the tables have no parents."""
    rows = [("a", "w", "PR#12", "", "", None), ("b", "w", "COMMIT#0123456789ab", "http://h/commit/0123456789abcdef", "", "old"), ("c", "w", "RELEASE#1.2.0#89abcdef", "", "", None), ("d", "w", "PR#99", "", "", "old"), ("e", "w", "GHSA-aaaa-bbbb-cccc", "", "patched_versions: >= 2.0.1", ""), ("f", "x", "PR#12", "", "", None), ("g", "w", "ISSUE#12", "", "", "old")]
    v = spark.createDataFrame(rows, "id string, source_platform string, issue_id string, source_url string, description string, introduced_in_commit string")
    known = spark.createDataFrame([("w", "PR", "12", "p1"), ("w", "COMMIT", "0123456789abcdef", "p2"), ("w", "RELEASE", "v1.2.0", "p3"), ("w", "RELEASE", "2.0.1", "p4"), ("y", "PR", "12", "p9")], "repo string, kind string, key string, parent_sha string")
    return refs.resolve_parents(v, known)


@query("advisory_commits", "SELECT * FROM (VALUES ('g1', 's2')) AS t(advisory, sha)")
def advisory_commits(spark: SparkSession, d: str) -> DataFrame:
    """g1: a small release; g2: the first tag; g3: too many commits; g4: no version."""
    adv = spark.createDataFrame([("g1", "r", ">= 1.1.0", "seed leaks through the log"), ("g2", "r", "1.0.0", "x"), ("g3", "r", "1.2.0", "x"), ("g4", "r", None, "x")], "advisory string, repo string, patched string, summary string")
    tags = spark.createDataFrame([("r", "v1.0.0", 1), ("r", "v1.1.0", 2), ("r", "nightly", 3), ("r", "v1.2.0", 4)], "repo string, tag string, turn int")
    rows = [("r", "v1.1.0", "s1", "tidy readme", [], 1), ("r", "v1.1.0", "s2", "stop seed leaks", ["log.rs"], 2), ("r", "v1.1.0", "s3", "Prepare release", [], 3)] + [("r", "v1.2.0", f"t{i}", "change", [], i) for i in range(7)]
    return refs.advisory_commits(adv, tags, spark.createDataFrame(rows, "repo string, tag string, sha string, subject string, files array<string>, seq int"))


@query("body_keyword_slice", "WITH x AS (SELECT id, CASE " + " ".join(f"WHEN {rx('description', P.alternation([k], P.loose))} THEN {q(k)}" for k in V.CORE_TERMS) + " END AS word FROM wallet_vulns) SELECT id, 'body_kw:' || word AS contest FROM x WHERE word IS NOT NULL")
def body_keyword_slice(spark: SparkSession, d: str) -> DataFrame:
    return slices.by_body_word(table(spark, d, "wallet_vulns"), V.CORE_TERMS)


@query("direct_slice", f"SELECT id FROM wallet_vulns WHERE {rx("coalesce(title, '') || ' ' || substr(coalesce(description, ''), 1, 1000)", P.alternation(V.CORE_TERMS, P.loose))}")
def direct_slice(spark: SparkSession, d: str) -> DataFrame:
    return slices.direct(table(spark, d, "wallet_vulns")).select("id")


@query("silent_prevalence", "WITH x AS (SELECT 100 * avg(regexp_matches(coalesce(title, '') || ' ' || coalesce(description, ''), 'CVE-|GHSA-')::INT) AS i, 100 * avg((lower(coalesce(severity, '')) IN ('critical', 'high', 'medium', 'low'))::INT) AS r FROM wallet_vulns) SELECT round(i, 4) AS with_id, round(greatest(r - i, 0), 4) AS rated_only, round(100 - r, 4) AS silent FROM x")
def silent_prevalence(spark: SparkSession, d: str) -> DataFrame:
    return analytics.prevalence(table(spark, d, "wallet_vulns"))


def _map_sql(value: str, names: dict[str, str]) -> str:
    return f"CASE {value} {' '.join(f'WHEN {q(k)} THEN {q(v)}' for k, v in names.items())} ELSE 'other' END"


@query("impact_classes", f"SELECT {_map_sql("split_part(coalesce(label, ''), ':', 1)", analytics.IMPACT)} AS name, count(*) AS n FROM wallet_vulns GROUP BY 1")
def impact_classes(spark: SparkSession, d: str) -> DataFrame:
    return analytics.mapped_counts(table(spark, d, "wallet_vulns"), F.element_at(F.split(T.text("label"), ":"), 1), analytics.IMPACT, without_rest=False)


@query("entry_channels", f"SELECT * FROM (SELECT {_map_sql("coalesce(attack_path, '')", analytics.CHANNEL)} AS name, count(*) AS n FROM wallet_vulns GROUP BY 1) WHERE name <> 'other'")
def entry_channels(spark: SparkSession, d: str) -> DataFrame:
    return analytics.mapped_counts(table(spark, d, "wallet_vulns"), T.text("attack_path"), analytics.CHANNEL)


DOMINANCE_PERMILLE = 50


@query("dominance_cap", f"WITH p AS (SELECT source_platform AS p FROM wallet_vulns WHERE source_platform IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), c AS (SELECT count(*) * {DOMINANCE_PERMILLE} // 1000 AS cap FROM wallet_vulns), s AS (SELECT id, row_number() OVER (ORDER BY md5('42:' || id), id) AS rn FROM wallet_vulns WHERE source_platform = (SELECT p FROM p)) SELECT id FROM wallet_vulns WHERE NOT coalesce(source_platform = (SELECT p FROM p), false) UNION ALL SELECT id FROM s, c WHERE rn <= cap")
def dominance_cap(spark: SparkSession, d: str) -> DataFrame:
    """The largest platform held to its share."""
    v = table(spark, d, "wallet_vulns").select("id", "source_platform")
    largest = analytics.top(v, "source_platform", 1).first()
    return slices.dominance_cap(v, F.col("source_platform") == (largest["value"] if largest else None), DOMINANCE_PERMILLE, "id").select("id")


# ---------------------------------------------------------------- slices


@query("label_slice", "SELECT * FROM (VALUES ('r', 1, 'Bug'), ('r', 2, 'sec')) AS t(repo, number, contest)")
def label_slice(spark: SparkSession, d: str) -> DataFrame:
    wanted = spark.createDataFrame([("r", "Bug", 1), ("r", "bug", 2), ("r", "sec", 3), ("r", "docs", 4), ("r", "phantom", 5)], "repo string, label string, turn int")
    there = spark.createDataFrame([("r", "BUG"), ("r", "sec"), ("r", "docs"), ("q", "phantom")], "repo string, label string")
    labels_ = slices.existing_labels(wanted, there, skip=["docs"])
    changes = spark.createDataFrame([("r", 1, "bug", True), ("r", 1, "sec", True), ("r", 2, "SEC", True), ("r", 3, "bug", False), ("r", 4, "docs", True)], "repo string, number int, label string, merged boolean")
    return slices.by_label(changes, labels_).select("repo", "number", "contest")


@query("title_slice", "SELECT * FROM (VALUES ('r', 9), ('r', 7)) AS t(repo, number)")
def title_slice(spark: SparkSession, d: str) -> DataFrame:
    rows = [("r", 9, "Fix panic", True), ("r", 9, "Fix panic", True), ("r", 8, "Fix panic", False), ("r", 7, "CVE-2024-11", True), ("r", 6, "tidy", True), ("r", 5, "a crash", True)]
    return slices.by_title(spark.createDataFrame(rows, "repo string, number int, title string, merged boolean"), cap=2).select("repo", "number")


@query("united_slices", "SELECT * FROM (VALUES ('a', 1, 0), ('a', 2, 0), ('b', 1, 1)) AS t(source, number, slice)")
def united_slices(spark: SparkSession, d: str) -> DataFrame:
    one = spark.createDataFrame([("a", 1), ("a", 2)], "source string, number int")
    two = spark.createDataFrame([("a", 2), ("a", 3), ("b", 1)], "source string, number int")
    return slices.united([one, two], ["source", "number"], F.col("number"), cap=2)


@query("stealth_terms", f"WITH x AS (SELECT id, coalesce(title, '') || ' ' || coalesce(description, '') AS b FROM wallet_vulns), t AS (SELECT id, CASE " + " ".join(f"WHEN {rx('b', P.alternation([k], P.loose))} THEN {q(k)}" for k in [*V.CORE_TERMS, *V.LANGUAGE_TERMS["rust"]]) + " END AS term FROM x) SELECT id, term FROM t WHERE term IS NOT NULL")
def stealth_terms(spark: SparkSession, d: str) -> DataFrame:
    return slices.first_term(table(spark, d, "wallet_vulns"), [*V.CORE_TERMS, *V.LANGUAGE_TERMS["rust"]])


@query("registry_filter_crawl", "SELECT source, count(*) AS n FROM crawl_rows WHERE lower(trim(coalesce(source, ''))) NOT IN (SELECT lower(trim(slug)) FROM wallet_registry) GROUP BY source")
def registry_filter_crawl(spark: SparkSession, d: str) -> DataFrame:
    """Raw rows of platforms off the registry (the curated table has none)."""
    known = table(spark, d, "wallet_registry").select(F.lower(F.trim("slug")).alias("p"))
    return table(spark, d, "crawl_rows").withColumn("p", F.lower(F.trim(T.text("source")))).join(known, "p", "left_anti").groupBy("source").agg(F.count("*").alias("n"))


@query("gate_stages_inline", "SELECT * FROM (VALUES ('a', 'off_registry'), ('b', 'boilerplate'), ('c', 'meta_work'), ('d', 'version_bump'), ('e', 'meta_prefix'), ('f', 'nvd_identity'), ('g', 'low_signal'), ('h', NULL), ('i', NULL)) AS t(id, drop_stage)")
def gate_stages_inline(spark: SparkSession, d: str) -> DataFrame:
    """Each stage of the gate on a row of its own; i names its project by a pattern of the identity table."""
    rows = [("a", "nobody", "t", "", ""), ("b", "opal-keys", "Critical update required", "", ""), ("c", "opal-keys", "Update README", "", ""), ("d", "opal-keys", "Upgrade foo from 1.0 to 1.1", "", ""), ("e", "opal-keys", "refactor: move the button", "", ""), ("f", "opal-keys", "CVE-2024-12345", "a flaw in something else", ""), ("g", "opal-keys", "move the button", "", ""), ("h", "opal-keys", "CVE-2024-12345", "a flaw in opal keys", ""), ("i", "nimbus-keys", "CVE-2024-12345", "a flaw in the Nimbus mobile wallet", "")]
    v = spark.createDataFrame(rows, "id string, source_platform string, title string, description string, severity string").withColumns({c: F.lit(None).cast("string") for c in ("contest", "issue_id", "source_url", "stride", "cwe_top25", "scraped_at")}).withColumn("silent_fix_prob", F.lit(None).cast("double"))
    own = spark.createDataFrame([("nimbus-keys", r"\bnimbus\b.{0,40}wallet")], "slug string, pattern string")
    return gate.judged(v, table(spark, d, "wallet_registry"), identities=own).select("id", "drop_stage")


@query("signals_inline", "SELECT * FROM (VALUES ('a', 0, 'C_candidate'), ('b', 1, 'C_candidate'), ('c', 2, 'B_corroborated'), ('d', 3, 'B_corroborated')) AS t(id, signal_count, authority_tier)")
def signals_inline(spark: SparkSession, d: str) -> DataFrame:
    """The three signals that other stages add."""
    rows = [("a", None, " ", ""), ("b", "said so", None, None), ("c", "said so", "#12", ""), ("d", "x", "y", "z")]
    v = spark.createDataFrame(rows, "id string, comment_signal string, linked_issue_signal string, backport_signal string").withColumns({c: F.lit("" if c != "source_platform" else "opal-keys") for c in ("source_platform", "contest", "issue_id", "severity", "title", "description", "source_url", "stride", "cwe_top25", "scraped_at")}).withColumn("silent_fix_prob", F.lit(None).cast("double"))
    return gate.judged(v, table(spark, d, "wallet_registry")).select("id", "signal_count", "authority_tier")


# ---------------------------------------------------------------- feeds


def _feed(spark: SparkSession, *records: dict) -> DataFrame:
    return spark.createDataFrame([(json.dumps(r),) for r in records], "value string")


_CRAWL_COLUMNS = "t(source, contest, issue_id, severity, title, description, source_url, introduced_in_commit)"


@query("feed_advisories", f"SELECT * FROM (VALUES ('w', 'ghsa_advisory', 'GHSA-1', 'Critical', 'Leak [GHSA-1, CVE-2024-0001]', 'text' || chr(10) || 'patched_versions: >= 1.2, 2.0', 'u', ''), ('w', 'ghsa_advisory', 'CVE-2024-0002', 'Medium', ' [CVE-2024-0002]', '', '', '')) AS {_CRAWL_COLUMNS}")
def feed_advisories(spark: SparkSession, d: str) -> DataFrame:
    return feeds.advisories(_feed(spark, {"ghsa_id": "GHSA-1", "cve_id": "CVE-2024-0001", "severity": "critical", "summary": "Leak", "description": "text", "html_url": "u", "vulnerabilities": [{"patched_versions": ">= 1.2"}, {"patched_versions": "2.0"}, {"patched_versions": None}]}, {"cve_id": "CVE-2024-0002", "severity": "moderate"}, {"summary": "no id"}), "w")


@query("feed_canonical", f"SELECT * FROM (VALUES ('w', 'o/r', 'GHSA-1', 'High', 'Leak', 'text', 'u', ''), ('w', 'o/r', 'GHSA-2', 'Info', 'x', '', '', '')) AS {_CRAWL_COLUMNS}")
def feed_canonical(spark: SparkSession, d: str) -> DataFrame:
    return feeds.canonical(_feed(spark, {"ghsa_id": " GHSA-1 ", "severity": "Critical", "summary": "Leak", "description": "text", "html_url": "u"}, {"ghsa_id": "GHSA-2", "severity": "odd", "summary": "x"}, {"ghsa_id": "GHSA-3"}, {"summary": "no id"}), "w", "o/r")


@query("feed_osv", f"SELECT * FROM (VALUES ('w', 'osv_npm', 'CVE-2024-0009', 'High', 'Title', 'body' || chr(10) || 'fixed_version: 1.3', 'https://osv.dev/vulnerability/GHSA-9', 'abc'), ('w', 'osv_npm', 'X-1', 'Unrated', 'X-1', '' || chr(10) || 'fix_commit: 0123456789', 'https://osv.dev/vulnerability/X-1', '')) AS {_CRAWL_COLUMNS}")
def feed_osv(spark: SparkSession, d: str) -> DataFrame:
    a = {"id": "GHSA-9", "aliases": ["CVE-2024-0009"], "summary": "Title", "details": "body", "severity": [{"type": "CVSS_V3", "score": "CVSS:3.1/AV:N/C:H/I:H/A:H"}], "affected": [{"ranges": [{"type": "GIT", "events": [{"introduced": "0"}, {"introduced": "abc"}]}, {"type": "SEMVER", "events": [{"fixed": "1.3"}]}]}]}
    return feeds.vulnerabilities(_feed(spark, a, a, {"id": "X-1", "affected": [{"ranges": [{"type": "GIT", "events": [{"introduced": "0"}, {"fixed": "0123456789"}]}]}]}), "w", "osv_npm")


@query("feed_rustsec", f"SELECT * FROM (VALUES ('w', 'rustsec', 'RUSTSEC-2024-0001', 'High', 'Unsound', 'why', 'https://rustsec.org/advisories/RUSTSEC-2024-0001.html', ''), ('w', 'rustsec', 'GHSA-5', 'Unrated', 'GHSA-5', 'why', 'https://osv.dev/vulnerability/GHSA-5', '')) AS {_CRAWL_COLUMNS}")
def feed_rustsec(spark: SparkSession, d: str) -> DataFrame:
    return feeds.rustsec(_feed(spark, {"id": "GHSA-4", "aliases": ["RUSTSEC-2024-0001"], "summary": "Unsound", "details": "why", "severity": [{"type": "x", "score": ""}], "database_specific": {"severity": "CRITICAL"}}, {"id": "GHSA-5", "details": "why", "database_specific": {"severity": "HIGH"}}, {"id": "GHSA-6"}), "w")


@query("feed_go", f"SELECT * FROM (VALUES ('w', 'govulncheck', 'CVE-2024-0003', 'Unrated', 'Panic', 'why', 'https://pkg.go.dev/vuln/GHSA-3', ''), ('w', 'govulncheck', 'GO-2024-9', 'Low', 'GO-2024-9', '', 'https://pkg.go.dev/vuln/GO-2024-9', '')) AS {_CRAWL_COLUMNS}")
def feed_go(spark: SparkSession, d: str) -> DataFrame:
    return feeds.go_vulnerabilities(_feed(spark, {"id": "GO-2024-1", "aliases": ["CVE-2024-0003", "GHSA-3"], "summary": "same"}, {"id": "GHSA-3", "aliases": ["CVE-2024-0003"], "summary": "Panic", "details": "why"}, {"id": "GO-2024-9", "database_specific": {"severity": "low"}}), "w")


@query("feed_nvd", f"SELECT * FROM (VALUES ('w', 'nvd', 'CVE-2024-0004', 'High', 'CVE-2024-0004', 'a flaw in opal keys', 'https://nvd.nist.gov/vuln/detail/CVE-2024-0004', '')) AS {_CRAWL_COLUMNS}")
def feed_nvd(spark: SparkSession, d: str) -> DataFrame:
    def record(i: str, text_: str) -> dict:
        return {"cve": {"id": i, "descriptions": [{"lang": "es", "value": "x"}, {"lang": "en", "value": text_}], "metrics": {"cvssMetricV31": [{"cvssData": {"baseSeverity": "HIGH"}}], "cvssMetricV2": [{"baseSeverity": "LOW"}]}}}

    return feeds.nvd(_feed(spark, record("CVE-2024-0004", "a flaw in opal keys"), record("CVE-2024-0005", "a flaw elsewhere")), "w", r"\bopal[-_ ]?keys\b")


@query("feed_changes", f"SELECT * FROM (VALUES ('w', 'w', 'PR#1', 'Unrated', 'T', '', 'u', ''), ('w', 'w', 'ISSUE#2', 'Unrated', '', 'B', '', '')) AS {_CRAWL_COLUMNS}")
def feed_changes(spark: SparkSession, d: str) -> DataFrame:
    return feeds.changes(spark.createDataFrame([(1, "pull", "T", None, "u"), (2, "issue", None, "B", None), (3, "pull", "", "", "u")], "number int, kind string, title string, body string, url string"), "w")


# ---------------------------------------------------------------- answers


def _answers(spark: SparkSession) -> DataFrame:
    rows = [("u1", 'so {"x": {"y": "}"}} then {"is_security_fix": true, "confidence": 0.9, "vuln_class": "dos", "reason": "r"} end', "m"), ("u2", '{"is_security_fix": true, "confidence": 0.2}', "m"), ("u3", "no object {", "m"), ("u4", '{"is_security_fix": false, "confidence": 0.1, "reason": "q"}', "m"), ("u5", None, "m")]
    return spark.createDataFrame(rows, "source_url string, answer string, model string")


@query("answers_accepted", "SELECT * FROM (VALUES ('u1', 0.9::DOUBLE, 1, 'dos', 'r', 'm'), ('u4', 0.1, 0, NULL, 'q', 'm')) AS t(source_url, silent_fix_prob, is_security_fix, vuln_class, reason, model)")
def answers_accepted(spark: SparkSession, d: str) -> DataFrame:
    return answers.accept(answers.extract(_answers(spark), "answer", "is_security_fix"))


@query("answers_to_ask_again", "SELECT * FROM (VALUES ('u3'), ('u5')) AS t(source_url)")
def answers_to_ask_again(spark: SparkSession, d: str) -> DataFrame:
    """Failed calls are never cached: what gave no object is still to do."""
    x = answers.extract(_answers(spark), "answer", "is_security_fix")
    return answers.still_to_do(x.select("source_url"), x.filter("parsed is not null"), "source_url")


@query("answers_flat", "SELECT * FROM (VALUES ('a', 'ui', 'c1', NULL, 'CWE-79'), ('b', NULL, NULL, 'p', NULL), ('c', NULL, NULL, NULL, NULL)) AS t(id, label, root_cause, attack_path, cwe)")
def answers_flat(spark: SparkSession, d: str) -> DataFrame:
    rows = [("a", 'x {"label": "ui", "root_cause": "c1", "cwe": "CWE-79"}'), ("b", '{"label": "nowhere",\n "attack_path": "p", "cwe": "79"}'), ("c", "none")]
    x = spark.createDataFrame(rows, "id string, answer string").select("id", answers.flat_answer(F.col("answer"), ["ui", "key"]).alias("o"))
    return x.select("id", "o.*")


@query("answers_enum", "SELECT * FROM (VALUES ('a', 'Tampering', 'CWE-20'), ('b', 'Other', 'N/A'), ('c', 'Other', 'N/A')) AS t(id, stride, cwe_top25)")
def answers_enum(spark: SparkSession, d: str) -> DataFrame:
    rows = [("a", '```json\n{"stride": "Tampering", "cwe_top25": "CWE-20"}\n```'), ("b", '{"stride": "Odd", "cwe_top25": "20"}'), ("c", None)]
    return spark.createDataFrame(rows, "id string, answer string").select("id", answers.enum_answer(F.col("answer")).alias("o")).select("id", "o.*")


@query("answers_batch", "SELECT * FROM (VALUES (1, 0, 'Spoofing', 'N/A'), (1, 1, 'Other', 'CWE-1'), (1, 2, 'Other', 'N/A'), (2, 0, 'Other', 'N/A')) AS t(batch, i, stride, cwe_top25)")
def answers_batch(spark: SparkSession, d: str) -> DataFrame:
    rows = [(1, 3, '[{"i": 0, "stride": "Spoofing"}, {"stride": "?", "cwe_top25": "CWE-1"}, {"i": 9, "stride": "Tampering"}]'), (2, 1, "broken")]
    return answers.align_batch(spark.createDataFrame(rows, "batch int, n int, answer string"))


@query("checkpoint_attach", "SELECT id, CASE WHEN id LIKE '%1' THEN 'Tampering' ELSE 'Other' END AS stride, CASE WHEN id LIKE '%1' THEN 'CWE-20' ELSE 'N/A' END AS cwe_top25 FROM wallet_vulns")
def checkpoint_attach(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "wallet_vulns").select("id", "stride", "cwe_top25")
    done = v.filter(F.col("id").endswith("1")).select("id", F.lit("Tampering").alias("stride"), F.lit("CWE-20").alias("cwe"))
    return answers.attach(v, done)


# ---------------------------------------------------------------- tables in and out


@query("csv_round_trip", "SELECT source, contest, issue_id, title, description FROM crawl_rows")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Written as CSV and read again, line breaks and quotes included; blanks come back as they went."""
    x = table(spark, d, "crawl_rows").select("source", "contest", "issue_id", "title", "description")
    path = f"{scratch_dir(spark)}/csv-{uuid.uuid4().hex}"
    io.write_csv(x.select(*[F.concat(F.lit("="), c).alias(c) if c in x.columns else c for c in x.columns]), path)
    back = io.read_csv_folders(spark, [path])
    return back.select(*[F.when(F.col(c).startswith("="), F.expr(f"substring({c}, 2)")).alias(c) for c in x.columns])


@query("address_parts", "SELECT id, regexp_replace(coalesce(source_url, ''), '^.*/', '') AS sha, nullif(regexp_extract(coalesce(source_url, ''), 'https?://(?:www\\.)?[^/]+/([^/]+/[^/?#]+)', 1), '') AS repo FROM wallet_vulns")
def address_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wallet_vulns").select("id", T.full_sha(F.col("source_url")).alias("sha"), T.repository(F.col("source_url")).alias("repo"))


@query("synthetic_urls", "SELECT * FROM (VALUES ('a', 'https://github.com/code-423n4/2024-01-x/issues/7'), ('b', ''), ('c', ''), ('d', '')) AS t(id, url)")
def synthetic_urls(spark: SparkSession, d: str) -> DataFrame:
    rows = [("a", "code4rena", "2024-01-x", "#7"), ("b", "sherlock", "2024-01-x", "7"), ("c", "code4rena", "", "7"), ("d", "code4rena", "x", None)]
    return spark.createDataFrame(rows, "id string, platform string, slug string, issue string").select("id", registry.synthetic_url(F.col("platform"), F.col("slug"), F.col("issue")).alias("url"))


@query("call_failures", "SELECT * FROM (VALUES ('a', 'secondary', '403'), ('b', 'primary', '403'), ('c', 'auth', '401'), ('d', 'auth', NULL)) AS t(id, kind, status)")
def call_failures(spark: SparkSession, d: str) -> DataFrame:
    rows = [("a", "You have exceeded a secondary rate limit", "gh: HTTP 403"), ("b", "API rate limit exceeded", '{"status": "403"}'), ("c", "Bad credentials", "HTTP 401"), ("d", None, None)]
    return spark.createDataFrame(rows, "id string, body string, stderr string").select("id", T.classify_403(F.col("body")).alias("kind"), T.http_status(F.col("stderr")).alias("status"))


@query("semver_first", "SELECT * FROM (VALUES ('>= 1.2.0, < 2', '1.2.0'), ('^0.3 || 1', '0.3'), ('any', ''), (NULL, '')) AS t(range, version)")
def semver_first(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(">= 1.2.0, < 2",), ("^0.3 || 1",), ("any",), (None,)], "range string").select("range", T.first_semver(F.col("range")).alias("version"))


@query("sets_compared", "SELECT count(*) FILTER (v AND c) AS both_, count(*) FILTER (v AND NOT c) AS only_findings, count(*) FILTER (NOT v AND c) AS only_history FROM (SELECT sha, max(v) AS v, max(c) AS c FROM (SELECT DISTINCT lower(fix_commit) AS sha, true AS v, false AS c FROM wallet_vulns WHERE regexp_full_match(coalesce(fix_commit, ''), '[0-9a-fA-F]{40}') UNION ALL SELECT DISTINCT lower(sha), false, true FROM commit_history WHERE sha IS NOT NULL) GROUP BY sha)")
def sets_compared(spark: SparkSession, d: str) -> DataFrame:
    """Commits in both tables, and in one only."""
    v = table(spark, d, "wallet_vulns").filter(F.col("fix_commit").rlike("^[0-9a-fA-F]{40}$")).select(F.lower("fix_commit").alias("sha"))
    h = table(spark, d, "commit_history").filter("sha is not null").select(F.lower("sha").alias("sha"))
    return analytics.sets_compared(v, h, "sha", "both_", "only_findings", "only_history")
