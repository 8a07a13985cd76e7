"""The registry of projects as a dimension: selection, names, languages, label strategies, counts, priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text
from .analytics import counts_by

# fixed values: labels looked for in every repository, those passed over, and areas by category
BUG_LABELS = ["bug", "type:bug", "type: bug", "kind/bug", "C-bug", "Bug", "bug-fix", "defect", "regression"]
SECURITY_LABELS = ["security", "Security", "C-security", "A-security", "type:security", "sec", "vulnerability"]
SKIP_LABELS = ["documentation", "docs", "dependencies", "chore", "enhancement", "feature", "question"]
AREA_LABELS = {
    "browser_extension": ["signing", "transaction", "permissions", "phishing", "connect", "provider", "keyring", "network"],
    "mobile": ["signing", "transaction", "keychain", "biometrics", "deeplink", "webview", "backup"],
    "desktop": ["signing", "transaction", "storage", "rpc", "backup"],
    "hardware_firmware": ["crypto", "signing", "bootloader", "secure-element", "u2f", "display", "pin", "seed"],
    "smart_account": ["validation", "signature", "module", "upgrade", "guard", "audit"],
    "mpc_tss": ["crypto", "protocol", "share", "signing", "audit"],
    "wallet_sdk": ["crypto", "signing", "encoding", "abi", "provider"],
    "node_wallet": ["wallet", "rpc", "consensus", "p2p"],
    "infra": ["protocol", "session", "pairing", "relay", "crypto"],
}
BODY_FIRST = ("hardware_firmware", "mpc_tss", "smart_account")
NO_TIER, DEFAULT_LANGUAGE, DEFAULT_CATEGORY = 3, "js", "wallet_sdk"


def selected(registry: DataFrame, tier: int | None = None, category: str | None = None) -> DataFrame:
    """Projects up to a tier (a missing tier is the lowest) and of a category."""
    x = registry
    if tier is not None:
        x = x.filter(F.coalesce(F.col("tier"), F.lit(NO_TIER)) <= tier)
    return x.filter(F.col("category") == category) if category is not None else x


def with_language(registry: DataFrame, languages: DataFrame) -> DataFrame:
    """The registry with each project's language, from a table (slug, language); unknown ones have the default."""
    one = languages.groupBy(F.lower(F.trim("slug")).alias("_slug")).agg(F.min("language").alias("language"))
    x = registry.drop("language").join(one, F.lower(F.trim("slug")) == F.col("_slug"), "left").drop("_slug")
    return x.withColumn("language", F.coalesce("language", F.lit(DEFAULT_LANGUAGE)))


def _spaced(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(" "))


def names(registry: DataFrame) -> DataFrame:
    """(slug, name): what a project is called by: slug, repository and owner, hyphens also as spaces; longer than 3 letters."""
    owner, repo = F.lower(F.split("repo", "/")[0]), F.lower(F.substring_index("repo", "/", -1))
    slug = F.lower(F.trim("slug"))
    every = F.array_distinct(F.array_compact(F.array(slug, _spaced(slug), repo, _spaced(repo), owner)))
    return registry.select(slug.alias("slug"), F.explode(F.filter(every, lambda n: F.length(n) > 3)).alias("name")).distinct()


def search_names(registry: DataFrame) -> DataFrame:
    """(slug, names): spaced names that a database of vulnerabilities is searched by, at least 4 letters, sorted."""
    owner, repo = F.lower(F.split("repo", "/")[0]), F.lower(F.substring_index("repo", "/", -1))
    every = F.array(_spaced(F.col("slug")), _spaced(repo), _spaced(F.concat_ws(" ", owner, repo)))
    return registry.select("slug", F.array_join(F.array_sort(F.array_distinct(F.filter(every, lambda n: F.length(n) >= 4))), "|").alias("names"))


def label_strategy(registry: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(slug, bug_labels, sec_labels, area_labels, skip_labels, strategy) per project.

    General labels, areas by category, and where custody code is rarely labelled
    bodies first; non-null columns of the override table (slug and any of these)
    replace the derived ones.
    """
    def listed(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    category = F.coalesce("category", F.lit(DEFAULT_CATEGORY))
    areas = F.array().cast("array<string>")
    for k, v in AREA_LABELS.items():
        areas = F.when(category == k, listed(v)).otherwise(areas)
    strategy = F.when(category.isin(*BODY_FIRST), "body_keyword_primary").otherwise("labels_primary")
    x = registry.select("slug", listed(BUG_LABELS).alias("bug_labels"), listed(SECURITY_LABELS).alias("sec_labels"), areas.alias("area_labels"), listed(SKIP_LABELS).alias("skip_labels"), strategy.alias("strategy"))
    if overrides is None:
        return x
    given = [c for c in x.columns[1:] if c in overrides.columns]
    o = overrides.select("slug", *[F.col(c).alias(f"_{c}") for c in given]).dropDuplicates(["slug"])
    return x.join(o, "slug", "left").select("slug", *[F.coalesce(f"_{c}", c).alias(c) if c in given else c for c in x.columns[1:]])


def introspection(registry: DataFrame) -> DataFrame:
    """(section, value, n): projects by category, ecosystem, custody and tier."""
    return counts_by(registry, **{c: F.col(c) for c in ("category", "ecosystem", "custody", "tier")})


def priorities(registry: DataFrame, stars: DataFrame, yields: DataFrame, commits: DataFrame, least: int = 150, keep_share: float = 0.54) -> DataFrame:
    """(slug, repo, stars, judged, hits, rate, cost): what a project promises and costs.

    stars: (slug, stars); yields: (repo, n, hits); commits: (slug, commits). A
    rate needs ``least`` judged rows, a cost any commits; unknown stars are -1.
    """
    x = registry.select("slug", "repo").join(stars.groupBy("slug").agg(F.max("stars").alias("stars")), "slug", "left")
    x = x.join(yields.groupBy("repo").agg(F.sum("n").alias("judged"), F.sum("hits").alias("hits")), "repo", "left")
    x = x.join(commits.groupBy("slug").agg(F.max("commits").alias("commits")), "slug", "left")
    n, hits = F.coalesce("judged", F.lit(0)), F.coalesce("hits", F.lit(0))
    cost = F.when(F.col("commits") > 0, F.bround(F.col("commits") * keep_share).cast("long"))
    return x.select("slug", "repo", F.coalesce("stars", F.lit(-1)).alias("stars"), n.alias("judged"), hits.alias("hits"), F.when(n >= least, F.round(hits / n, 6)).alias("rate"), cost.alias("cost"))


def synthetic_url(platform: Column, contest_slug: Column, issue: Column) -> Column:
    """The address of an issue where the platform's form is known, else empty."""
    number = F.trim(F.regexp_replace(text(issue), "^#+", ""))
    known = (platform == "code4rena") & (F.coalesce(contest_slug, F.lit("")) != "") & (number != "")
    return F.when(known, F.concat(F.lit("https://github.com/code-423n4/"), contest_slug, F.lit("/issues/"), number)).otherwise("")
