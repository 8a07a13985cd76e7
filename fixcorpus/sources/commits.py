"""Commit histories: messages, source files, back-ports, terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import vocabulary as V
from ..functions.text import commit_row_id, severity_in, text
from ..operators.dedup import keep_first
from ..operators.registry import DEFAULT_LANGUAGE, names, with_language
from ..operators.tables import DIMENSION_ROWS

MAX_FILES = 60


def distinct_commits(history: DataFrame) -> DataFrame:
    """One row per commit: the first that arrived, by a total order."""
    return keep_first(history.filter("sha is not null"), ["sha"], [F.asc_nulls_last("ingested_at"), F.asc_nulls_last("committed_at"), *[F.asc_nulls_last(c) for c in ("wallet", "subject", "body", "patch_id")]])


def touches_source(files: Column) -> Column:
    """Any file ends in a source extension (case matters)."""
    ext = F.transform(files, lambda f: F.regexp_extract(f, r"[^/.][^/]*?(\.[^./]*)$", 1))
    return F.arrays_overlap(ext, F.array(*[F.lit(e) for e in V.SOURCE_EXTENSIONS]))


def source_commits(history: DataFrame) -> DataFrame:
    """Commits that change source and aren't merges, empty or sweeping, in the all-commits schema."""
    x = distinct_commits(history).filter(F.coalesce(F.size("files"), F.lit(0)).between(1, MAX_FILES) & ~text("subject").rlike("^Merge ") & touches_source(F.col("files")))
    return x.select(commit_row_id(F.col("wallet"), F.col("sha")).alias("id"), F.col("wallet").alias("source_platform"), F.substring("sha", 1, 12).alias("issue_id"), F.substring(text("subject"), 1, 500).alias("title"), F.substring(text("body"), 1, 2000).alias("description"), F.size("files").alias("n_files"))


def backports(history: DataFrame) -> DataFrame:
    """(sha, is_backport): the patch stands under more than one commit; counted by patch, joined back, no hot window."""
    pairs = history.filter("sha is not null and coalesce(patch_id, '') <> ''").select("sha", "patch_id").distinct()
    many = pairs.groupBy("patch_id").agg(F.count("*").alias("n")).filter("n > 1")
    ported = pairs.join(many, "patch_id").select("sha").distinct().withColumn("is_backport", F.lit(True))
    return history.filter("sha is not null").select("sha").distinct().join(ported, "sha", "left").select("sha", F.coalesce("is_backport", F.lit(False)).alias("is_backport"))


def split_message(message: Column) -> tuple[Column, Column]:
    """Subject and body of a whole message, parted by the first blank line or else the first line end."""
    blank = message.contains("\n\n")
    subject = F.when(blank, F.split(message, "\n\n", 2)[0]).otherwise(F.split(message, "\n", 2)[0])
    rest = F.when(blank, F.try_element_at(F.split(message, "\n\n", 2), F.lit(2))).otherwise(F.try_element_at(F.split(message, "\n", 2), F.lit(2)))
    return F.trim(subject), F.trim(F.coalesce(rest, F.lit("")))


def commit_rows(history: DataFrame) -> DataFrame:
    """Crawler rows of commits: no empty subject, merge or revert; severity from the subject."""
    x = distinct_commits(history).filter((F.trim(text("subject")) != "") & ~F.col("subject").rlike("^(Merge|Revert) "))
    return x.select(F.col("wallet").alias("source"), F.concat(F.lit("COMMIT#"), F.substring("sha", 1, 12)).alias("issue_id"), severity_in(F.col("subject")).alias("severity"), F.substring("subject", 1, 120).alias("title"), text("body").alias("description"))


def term_hits(history: DataFrame, cap: int = 200) -> DataFrame:
    """(wallet, term, sha): commits that name a core term, the newest ``cap`` per wallet and term (the cap is the feature)."""
    x = distinct_commits(history).withColumn("message", F.concat_ws("\n", text("subject"), text("body")))
    x = x.select("wallet", "sha", "committed_at", F.explode(P.keyword_list(F.col("message"), V.CORE_TERMS)).alias("term"))
    w = Window.partitionBy("wallet", "term").orderBy(F.desc_nulls_last("committed_at"), "sha")
    return x.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= cap).select("wallet", "term", "sha")


# fixed value: how much of a text is looked at for mentions
LOOKED_AT = 2000


def mentions(texts: DataFrame, registry: DataFrame, own: Column, text_: Column) -> DataFrame:
    """``texts`` with ``mentioned``: the other projects whose names stand in the text, sorted; rows without any are left out.

    The registry is a dimension (its names are collected, at most DIMENSION_ROWS
    of them): one alternation of all names rules most texts out, and only the
    others are held against each name. No join is made.
    """
    dims = names(registry).limit(DIMENSION_ROWS + 1).collect()
    if len(dims) > DIMENSION_ROWS:
        raise ValueError(f"more than {DIMENSION_ROWS} names are no dimension")
    if not dims:
        return texts.withColumn("mentioned", F.array().cast("array<string>")).filter(F.lit(False))
    any_name = "|".join(P.literal(n) for n in sorted({r["name"] for r in dims}))
    by_slug: dict[str, list[str]] = {}
    for r in dims:
        by_slug.setdefault(r["slug"], []).append(P.literal(r["name"]))
    each = F.array_compact(F.array(*[F.when((own != slug) & text_.rlike("|".join(sorted(ns))), F.lit(slug)) for slug, ns in sorted(by_slug.items())]))
    return texts.filter(text_.rlike(any_name)).withColumn("mentioned", each).filter(F.size("mentioned") > 0)


def _custody(text_: Column) -> Column:
    words = sorted({k.lower() for g in ("key_material", "signing", "mpc", "approval") for k in V.GROUPS[g]})
    return text_.rlike("|".join(P.literal(w) for w in words))


def cross_mentions(history: DataFrame, registry: DataFrame) -> DataFrame:
    """(sha, mentions): commits of one project that name another by slug, repository or owner (more than 3 letters)."""
    x = distinct_commits(history).select("sha", F.lower(text("wallet")).alias("own"), F.lower(F.concat_ws(" ", text("subject"), F.substring(text("body"), 1, LOOKED_AT))).alias("text"))
    return mentions(x, registry, F.col("own"), F.col("text")).select("sha", F.array_join("mentioned", ", ").alias("mentions"))


def mention_rows(changes: DataFrame, registry: DataFrame) -> DataFrame:
    """Crawler rows of changes (source, number, title, body, url) that name another project, a change once.

    High where custody words stand beside, else Medium; the projects named lead the description.
    """
    x = changes.withColumn("_own", F.lower(F.trim(text("source")))).withColumn("_text", F.lower(F.concat_ws(" ", text("title"), F.substring(text("body"), 1, LOOKED_AT))))
    x = mentions(x, registry, F.col("_own"), F.col("_text"))
    x = keep_first(x, ["source", "number"], [F.asc_nulls_last("title"), F.asc_nulls_last("body"), F.asc_nulls_last("url")])
    sev = F.when(_custody(F.col("_text")), "High").otherwise("Medium")
    lead = F.concat(F.lit("[cross-wallet: "), F.array_join("mentioned", ", "), F.lit("] "))
    return x.select("source", F.lit("cross_client").alias("contest"), F.concat(F.lit("PR#"), "number").alias("issue_id"), sev.alias("severity"), F.substring(F.trim(text("title")), 1, 500).alias("title"), F.substring(F.concat(lead, F.trim(text("body"))), 1, 2000).alias("description"), F.trim(text("url")).alias("source_url"), F.lit("").alias("introduced_in_commit"))


def search_terms(registry: DataFrame, languages: DataFrame | None = None) -> DataFrame:
    """(slug, terms): core, category and language terms, each once and in order; languages: (slug, language)."""
    def mapped(table: dict[str, list[str]], key: Column) -> Column:
        out = F.array().cast("array<string>")
        for k, terms in table.items():
            out = F.when(key == k, F.array(*[F.lit(t) for t in terms])).otherwise(out)
        return out

    x = with_language(registry, languages) if languages is not None else registry.withColumn("language", F.lit(DEFAULT_LANGUAGE))
    core = F.array(*[F.lit(t) for t in V.CORE_TERMS])
    return x.select("slug", F.array_join(F.array_distinct(F.concat(core, mapped(V.CATEGORY_TERMS, F.col("category")), mapped(V.LANGUAGE_TERMS, F.col("language")))), "|").alias("terms"))
