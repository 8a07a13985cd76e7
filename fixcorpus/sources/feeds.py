"""Records of advisory feeds (JSON lines) to crawler rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import capitalised, text
from ..operators.graph import components

OSV = "id string, aliases array<string>, summary string, details string, severity array<struct<type:string,score:string>>, database_specific struct<severity:string,cvss:string>, affected array<struct<ranges:array<struct<type:string,events:array<struct<introduced:string,fixed:string>>>>>>"
_CVSS = "array<struct<cvssData:struct<baseSeverity:string>,baseSeverity:string>>"
NVD = f"cve struct<id:string,descriptions:array<struct<lang:string,value:string>>,metrics:struct<cvssMetricV31:{_CVSS},cvssMetricV30:{_CVSS},cvssMetricV2:{_CVSS}>>"
ADVISORY = "ghsa_id string, cve_id string, severity string, summary string, description string, html_url string, vulnerabilities array<struct<patched_versions:string>>"


def _row(df: DataFrame, **cols: Column) -> DataFrame:
    names = ("source", "contest", "issue_id", "severity", "title", "description", "source_url", "introduced_in_commit")
    return df.select(*[cols.get(n, F.lit("")).alias(n) for n in names])


def feed_severity(c: Column) -> Column:
    """moderate is Medium; the four tiers with a capital letter; the rest Unrated."""
    s = F.lower(F.trim(text(c)))
    return F.when(s == "moderate", "Medium").when(s.isin("critical", "high", "medium", "low"), capitalised(s)).otherwise("Unrated")


def _first(a: Column, wanted) -> Column:
    return F.try_element_at(F.filter(a, wanted), F.lit(1))


def advisories(feed: DataFrame, source: str) -> DataFrame:
    """Repository advisories; an id is required, versions that fix it are appended to the description."""
    x = feed.select(F.from_json("value", ADVISORY).alias("a")).select("a.*").filter("coalesce(ghsa_id, cve_id, '') <> ''")
    ids = F.array_join(F.filter(F.array("ghsa_id", "cve_id"), lambda v: F.coalesce(v, F.lit("")) != ""), ", ")
    fixed = F.array_join(F.filter(F.transform("vulnerabilities", lambda v: v["patched_versions"]), lambda v: F.coalesce(v, F.lit("")) != ""), ", ")
    described = F.concat(text("description"), F.when(F.coalesce(fixed, F.lit("")) != "", F.concat(F.lit("\npatched_versions: "), fixed)).otherwise(""))
    return _row(x, source=F.lit(source), contest=F.lit("ghsa_advisory"), issue_id=F.coalesce("ghsa_id", "cve_id"), severity=feed_severity(F.col("severity")), title=F.substring(F.concat(text("summary"), F.lit(" ["), ids, F.lit("]")), 1, 500), description=F.substring(described, 1, 1500), source_url=text("html_url"))


def canonical(feed: DataFrame, source: str, repo: str) -> DataFrame:
    """Repository advisories as findings: an id and a text are required, critical counts as High, what is no tier as Info."""
    x = feed.select(F.from_json("value", ADVISORY).alias("a")).select("a.*")
    blank = lambda c: F.trim(text(c))
    s = F.lower(blank("severity"))
    sev = F.when(s.isin("critical", "high"), "High").when(s.isin("medium", "moderate"), "Medium").when(s == "low", "Low").otherwise("Info")
    x = x.filter((blank("ghsa_id") != "") & ((blank("summary") != "") | (blank("description") != "")))
    return _row(x, source=F.lit(source), contest=F.lit(repo), issue_id=blank("ghsa_id"), severity=sev, title=blank("summary"), description=blank("description"), source_url=blank("html_url"))


def rustsec(feed: DataFrame, source: str) -> DataFrame:
    """Crate advisories: a RUSTSEC alias before the id, a severity only where the record scores one, the advisory's own page."""
    x = feed.select(F.from_json("value", OSV).alias("v")).select("v.*").filter("id is not null")
    best = F.coalesce(_first(F.col("aliases"), lambda v: v.startswith("RUSTSEC-")), F.col("id"))
    word = F.upper(F.coalesce(F.nullif("database_specific.cvss", F.lit("")), "database_specific.severity", F.lit("")))
    vector = F.upper(F.array_join(F.transform("severity", lambda s: F.coalesce(s["score"], F.lit(""))), " "))
    said = F.when(word.isin("CRITICAL", "HIGH"), "High").when(word.isin("MEDIUM", "MODERATE"), "Medium").when(word == "LOW", "Low")
    scored = F.when(vector.contains("CRITICAL") | vector.contains("HIGH"), "High").when(vector.contains("MEDIUM"), "Medium").when(vector.contains("LOW"), "Low")
    sev = F.when(F.coalesce(F.size("severity"), F.lit(0)) > 0, F.coalesce(said, scored, F.lit("Unrated"))).otherwise("Unrated")
    page = F.when(best.startswith("RUSTSEC-"), F.concat(F.lit("https://rustsec.org/advisories/"), best, F.lit(".html"))).otherwise(F.concat(F.lit("https://osv.dev/vulnerability/"), best))
    title, described = F.trim(text("summary")), F.substring(F.trim(text("details")), 1, 500)
    x = x.filter((title != "") | (described != ""))
    return _row(x, source=F.lit(source), contest=F.lit("rustsec"), issue_id=best, severity=sev, title=F.when(title != "", title).otherwise(best), description=described, source_url=page)


def go_vulnerabilities(feed: DataFrame, source: str) -> DataFrame:
    """Go records: CVE before GHSA before GO ids; records that share any id or alias are one (the smallest id stays)."""
    x = feed.select(F.from_json("value", OSV).alias("v")).select("v.*").filter("id is not null")
    x = x.withColumn("ids", F.array_distinct(F.concat(F.array("id"), F.coalesce("aliases", F.array().cast("array<string>")))))
    comp = components(x.select(F.col("id").alias("node"), F.explode("ids").alias("key")))
    x = x.join(comp.filter("node = comp").select(F.col("node").alias("id")), "id", "left_semi").dropDuplicates(["id"])
    best = best_id(F.col("id"), F.col("aliases"), ("CVE-", "GHSA-", "GO-"))
    title = F.trim(text("summary"))
    return _row(x, source=F.lit(source), contest=F.lit("govulncheck"), issue_id=best, severity=feed_severity(F.col("database_specific.severity")), title=F.when(title != "", title).otherwise(best), description=F.substring(F.trim(text("details")), 1, 500), source_url=F.concat(F.lit("https://pkg.go.dev/vuln/"), F.col("id")))


def best_id(id_: Column, aliases: Column, order: tuple[str, ...]) -> Column:
    """The id or alias of the best kind, the kinds in order; else the id itself."""
    every = F.concat(F.array(id_), F.coalesce(aliases, F.array().cast("array<string>")))
    def of_kind(prefix: str) -> Column:
        return _first(every, lambda v: v.startswith(prefix))

    return F.coalesce(*[of_kind(p) for p in order], id_)


def _fix(affected: Column) -> tuple[Column, Column]:
    """(introduced, fixed): the first known of each over all ranges."""
    ranges = F.flatten(F.transform(affected, lambda a: a["ranges"]))
    events = F.flatten(F.transform(ranges, lambda r: F.transform(r["events"], lambda e: F.struct(r["type"].alias("type"), e["introduced"].alias("introduced"), e["fixed"].alias("fixed")))))
    introduced = _first(events, lambda e: (e["type"] == "GIT") & (F.coalesce(e["introduced"], F.lit("0")) != "0"))["introduced"]
    return introduced, _first(events, lambda e: e["fixed"].isNotNull())["fixed"]


def vulnerabilities(feed: DataFrame, source: str, contest: str, order: tuple[str, ...] = ("CVE-", "GHSA-", "RUSTSEC-")) -> DataFrame:
    """Open vulnerability records: best id, severity, what introduced and what fixed it; an id is kept once."""
    x = feed.select(F.from_json("value", OSV).alias("v")).select("v.*").filter("id is not null")
    introduced, fixed = _fix(F.col("affected"))
    tag = F.when(fixed.rlike("^[0-9a-f]{7,40}$"), F.concat(F.lit("\nfix_commit: "), fixed)).when(fixed.isNotNull(), F.concat(F.lit("\nfixed_version: "), fixed)).otherwise("")
    vector = F.array_join(F.transform("severity", lambda s: F.upper(F.coalesce(s["score"], F.lit("")))), " ")
    word = feed_severity(F.col("database_specific.severity"))
    sev = F.when(word != "Unrated", word).when(vector.contains("C:H") & vector.contains("I:H") & vector.contains("A:H"), "High").otherwise("Unrated")
    x = x.withColumn("best", best_id(F.col("id"), F.col("aliases"), order)).withColumn("sev", sev).withColumn("introduced", introduced).withColumn("tag", tag)
    x = x.groupBy("best").agg(F.min_by(F.struct("id", "summary", "details", "sev", "introduced", "tag"), "id").alias("v")).select("best", "v.*")
    described = F.substring(F.concat(F.substring(text("details"), 1, 500), "tag"), 1, 600)
    return _row(x, source=F.lit(source), contest=F.lit(contest), issue_id=F.col("best"), severity=F.col("sev"), title=F.when(text("summary") != "", text("summary")).otherwise(F.col("best")), description=described, source_url=F.concat(F.lit("https://osv.dev/vulnerability/"), F.col("id")), introduced_in_commit=text("introduced"))


def nvd(feed: DataFrame, source: str, identity: str) -> DataFrame:
    """National database records that name the project: newest score version first, English text, an id once."""
    x = feed.select(F.from_json("value", NVD).alias("v")).select("v.cve.*").filter("id is not null")

    def base(c: str) -> Column:
        first = F.try_element_at(F.col(f"metrics.{c}"), F.lit(1))
        return F.coalesce(first["cvssData"]["baseSeverity"], first["baseSeverity"])

    english = _first(F.col("descriptions"), lambda d: d["lang"] == "en")["value"]
    x = x.withColumn("text", english).filter(F.col("text").rlike("(?i)" + identity))
    x = x.groupBy("id").agg(F.min("text").alias("text"), F.max(feed_severity(F.coalesce(*[base(c) for c in ("cvssMetricV31", "cvssMetricV30", "cvssMetricV2")]))).alias("sev"))
    return _row(x, source=F.lit(source), contest=F.lit("nvd"), issue_id=F.col("id"), severity=F.col("sev"), title=F.col("id"), description=F.col("text"), source_url=F.concat(F.lit("https://nvd.nist.gov/vuln/detail/"), F.col("id")))


def changes(feed: DataFrame, source: str) -> DataFrame:
    """Pull requests and issues (number, kind, title, body, url): both texts empty is no row."""
    kind = F.when(F.col("kind") == "pull", F.concat(F.lit("PR#"), "number")).otherwise(F.concat(F.lit("ISSUE#"), "number"))
    x = feed.filter("coalesce(title, '') <> '' or coalesce(body, '') <> ''")
    return _row(x, source=F.lit(source), contest=F.lit(source), issue_id=kind, severity=F.lit("Unrated"), title=text("title"), description=text("body"), source_url=text("url"))
