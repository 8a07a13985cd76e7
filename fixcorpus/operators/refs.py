"""References from findings to commits, and parents of fixing commits, as joins against tables of references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_semver, fix_commit, issue_kind, text

# fixed value: the spellings of a change's number
CHANGE = r"/pull/(\d+)|\(#(\d+)\)|\[#?(\d{2,})\]|(?:^|\s)#(\d{2,})\b"


def inline_reference(c: Column) -> Column:
    """commit:<sha> if the text links one, else pr:<number> from its first mention, else empty."""
    sha = F.regexp_extract(text(c), r"/commit/([0-9a-f]{7,40})", 1)
    number = F.coalesce(*[F.nullif(F.regexp_extract(text(c), CHANGE, i), F.lit("")) for i in (1, 2, 3, 4)])
    return F.when(sha != "", F.concat(F.lit("commit:"), sha)).when(number.isNotNull(), F.concat(F.lit("pr:"), number)).otherwise("")


def reference_keys(findings: DataFrame) -> DataFrame:
    """(id, repo, kind, key): what a finding's parent is looked up by; issues and changelog lines have none."""
    kind = issue_kind(F.col("issue_id"))
    after = F.regexp_replace(text("issue_id"), r"^[A-Z]+[#-]", "")
    version = first_semver(F.regexp_extract(text("description"), r"patched_versions: ([^\n]*)", 1))
    key = F.when(kind == "PR", after).when(kind == "COMMIT", F.coalesce(F.nullif(fix_commit(F.col("source_url")), F.lit("")), after)).when(kind == "RELEASE", F.element_at(F.split(after, "#"), 1)).when(kind == "GHSA", version)
    return findings.select("id", F.col("source_platform").alias("repo"), F.when(kind == "GHSA", "RELEASE").otherwise(kind).alias("kind"), key.alias("key")).filter("coalesce(key, '') <> ''")


def resolve_parents(findings: DataFrame, refs: DataFrame) -> DataFrame:
    """(id, introduced_in_commit): the parent of what fixed it, where a table (repo, kind, key, parent_sha) knows it.

    Tags are tried as they are and with a leading ``v``. What a row held before
    stays where nothing is found.
    """
    keys = reference_keys(findings)
    tries = keys.withColumn("turn", F.lit(0)).unionByName(keys.filter("kind = 'RELEASE'").withColumn("key", F.concat(F.lit("v"), "key")).withColumn("turn", F.lit(1)))
    known = refs.groupBy("repo", "kind", "key").agg(F.min("parent_sha").alias("parent_sha"))
    found = tries.join(known, ["repo", "kind", "key"]).groupBy("id").agg(F.min_by("parent_sha", "turn").alias("parent_sha"))
    x = findings.select("id", "introduced_in_commit").join(found, "id", "left")
    return x.select("id", F.coalesce(F.nullif("parent_sha", F.lit("")), "introduced_in_commit").alias("introduced_in_commit"))


def unresolved(findings: DataFrame, k: int = 10) -> DataFrame:
    """(issue_kind, id): up to k findings per kind whose introducing commit is unknown (a sample is the feature)."""
    x = findings.filter(~F.trim(text("introduced_in_commit")).rlike("^[0-9a-fA-F]{7,40}$")).select(issue_kind(F.col("issue_id")).alias("issue_kind"), "id")
    w = Window.partitionBy("issue_kind").orderBy("id")
    return x.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k).drop("rn")


def coverage(findings: DataFrame) -> DataFrame:
    """(issue_kind, n, resolved, coverage) of the column that names what introduced a defect."""
    g = findings.groupBy(issue_kind(F.col("issue_id")).alias("issue_kind")).agg(F.count("*").alias("n"), F.count_if(F.trim(text("introduced_in_commit")).rlike("^[0-9a-fA-F]{7,40}$")).alias("resolved"))
    return g.withColumn("coverage", F.round(100 * F.try_divide("resolved", "n"), 4))


# fixed value: subjects of commits that only make a release
SKIP_COMMIT = r"(?i)^(?:params: (?:release|begin)|version:|build:|ci:|Merge branch .*release|.*\bPPA\b|chore(?:\(release\))?: release|Prepare(?: for)? release)"


def advisory_commits(advisories: DataFrame, tags: DataFrame, commits: DataFrame, most: int = 6) -> DataFrame:
    """(advisory, sha): the fix of an advisory whose patched version is a small release.

    advisories: (advisory, repo, patched, summary); tags: (repo, tag, turn) in
    version order; commits: (repo, tag, sha, subject, files, seq), each under the
    first tag that holds it. The release needs a tag before it and 1 to ``most``
    commits that aren't release work; the one that shares most words with the
    advisory wins, ties by ``seq``.
    """
    def words(c: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.lower(text(c)), F.lit("[a-z]{3,}"), 0))

    version = F.regexp_extract(text("patched"), r"(\d+\.\d+\.\d+)", 1)
    known = tags.filter(F.col("tag").rlike(r"^v?\d+\.\d+\.\d+$")).withColumn("place", F.row_number().over(Window.partitionBy("repo").orderBy("turn")))
    a = advisories.withColumn("version", version).filter("version <> ''").join(known, "repo").filter((F.col("tag") == F.col("version")) | (F.col("tag") == F.concat(F.lit("v"), F.col("version"))))
    a = a.groupBy("advisory", "repo").agg(F.max_by(F.struct("tag", "place", "summary"), F.col("tag").startswith("v")).alias("t")).select("advisory", "repo", "t.*").filter("place > 1")
    real = commits.filter(~text("subject").rlike(SKIP_COMMIT))
    small = real.groupBy("repo", "tag").agg(F.count("*").alias("m")).filter(F.col("m").between(1, most))
    x = a.join(small, ["repo", "tag"]).join(real, ["repo", "tag"])
    shared = F.size(F.array_intersect(words(F.col("summary")), words(F.concat_ws(" ", "subject", F.array_join("files", " ")))))
    w = Window.partitionBy("advisory").orderBy(F.desc("shared"), "seq")
    return x.withColumn("shared", shared).withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("advisory", "sha")


def closest_commit(advisories: DataFrame, commits: DataFrame) -> DataFrame:
    """(advisory, sha, shared): of a release's commits the one that shares most words with the advisory.

    advisories: (advisory, release, text); commits: (release, sha, subject), of
    which release, merge and version commits are left out. Ties go to the smaller sha.
    """
    def words(c: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.lower(text(c)), F.lit("[a-z]{3,}"), 0))

    real = commits.filter(~text("subject").rlike(r"(?i)^(?:merge|release|bump|v?\d+\.\d)|changelog"))
    x = advisories.join(real, "release").withColumn("shared", F.size(F.array_intersect(words(F.col("text")), words(F.col("subject"))))).filter("shared > 0")
    w = Window.partitionBy("advisory").orderBy(F.desc("shared"), "sha")
    return x.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("advisory", "sha", "shared")
