"""Equivalent SQL of the queries that SQL can express on whole tables."""

_NO = "('', 'nan', 'n/a', 'none', 'null', '-')"

P2_FOUND = r"""
WITH t AS (
  SELECT id, regexp_extract_all(lower(coalesce(title, '') || ' ' || coalesce(description, '') || ' ' || coalesce(source_url, '')), '[a-z0-9]+') AS w
  FROM wallet_vulns
  WHERE len(regexp_extract_all(lower(coalesce(description, '')), '[a-z0-9]+')) >= 30
), g AS (
  SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM t
), n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
c AS (
  SELECT x.id AS id_a, y.id AS id_b, count(*) AS shared
  FROM g x JOIN g y ON x.s = y.s AND x.id < y.id
  GROUP BY x.id, y.id
)
SELECT id_a, id_b FROM c JOIN n a ON a.id = id_a JOIN n b ON b.id = id_b
WHERE shared >= 0.5 * (a.n + b.n - shared)
"""

_P3_GROUPS = rf"""
WITH RECURSIVE v AS (
  SELECT id, lower(trim(source_url)) AS u, lower(trim(fix_commit)) AS c, lower(trim(source_platform)) AS p, lower(trim(issue_id)) AS i FROM wallet_vulns
), b AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(u, '^[a-z][a-z0-9+.-]*://', ''), '^www\.', ''), '\?[^#]*', '', 'g'), '/+$', '') AS bare FROM v
), k AS (
  SELECT id, 'u' || bare AS key FROM b WHERE u NOT IN {_NO} AND bare NOT IN {_NO}
  UNION SELECT id, 'c' || substr(c, 1, 12) FROM b WHERE regexp_full_match(c, '[0-9a-f]{{12,40}}') AND NOT regexp_full_match(c, '0+')
  UNION SELECT id, 'i' || p || chr(1) || i FROM b WHERE p NOT IN {_NO} AND i NOT IN {_NO}
), e AS (SELECT DISTINCT x.id AS a, y.id AS b FROM k x JOIN k y ON x.key = y.key AND x.id <> y.id),
r AS (SELECT a AS id, b AS other FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other)
, g AS (SELECT id, least(id, min(other)) AS group_id FROM r GROUP BY id)
"""
P3_FOUND = _P3_GROUPS + "SELECT id, group_id FROM g"
P3_GROUP_SIZES = _P3_GROUPS + ", s AS (SELECT group_id, count(*) AS group_size FROM g GROUP BY group_id) SELECT group_size, count(*) AS n_groups FROM s GROUP BY group_size"

P4_FOUND = """
WITH r AS (
  SELECT id, row_number() OVER (
    PARTITION BY lower(trim(source_platform))
    ORDER BY CASE lower(trim(confidence)) WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 ELSE 3 END, security_score DESC NULLS LAST, id
  ) AS n FROM wallet_vulns
)
SELECT id FROM r WHERE n > (SELECT count(*) * 25 // 1000 FROM wallet_vulns)
"""

P4_BY_YEAR = """
WITH c AS (SELECT lower(trim(source_platform)) AS contributor, substr(trim(scraped_at), 1, 4) AS stratum, count(*) AS n FROM wallet_vulns GROUP BY ALL),
t AS (SELECT *, least((SELECT count(*) * 25 // 1000 FROM wallet_vulns), sum(n) OVER (PARTITION BY contributor)) AS most,
  coalesce(sum(n) OVER (PARTITION BY contributor ORDER BY n, stratum NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS smaller,
  count(*) OVER (PARTITION BY contributor) - row_number() OVER (PARTITION BY contributor ORDER BY n, stratum NULLS FIRST) + 1 AS still FROM c),
f AS (SELECT *, n * still <= most - smaller AS filled FROM t),
r AS (SELECT *, most - coalesce(sum(n) FILTER (filled) OVER (PARTITION BY contributor), 0) AS rest, count(*) FILTER (NOT filled) OVER (PARTITION BY contributor) AS others FROM f),
b AS (SELECT *, CASE WHEN filled THEN 0 ELSE rest // others END AS base, CASE WHEN filled THEN 0 ELSE rest % others END AS remainder FROM r),
s AS (SELECT *, rest - sum(base) OVER (PARTITION BY contributor) AS spare, row_number() OVER (PARTITION BY contributor ORDER BY filled, remainder DESC, stratum NULLS FIRST) AS turn FROM b)
SELECT contributor, stratum, n AS n_rows, (CASE WHEN filled THEN n ELSE base + (turn <= spare)::INT END)::BIGINT AS n_kept FROM s
"""

P2_GROUPS = P2_FOUND.split(", n AS (")[0] + """, k AS (SELECT id, md5(string_agg(s, '|' ORDER BY s)) AS key FROM g GROUP BY id),
m AS (SELECT id, min(id) OVER (PARTITION BY key) AS class_id FROM k), q AS (SELECT g.* FROM g WHERE id IN (SELECT class_id FROM m)),
n AS (SELECT id, count(*) AS n FROM q GROUP BY id),
c AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM q x JOIN q y ON x.s = y.s AND x.id <> y.id GROUP BY x.id, y.id),
e AS (SELECT a, b FROM c JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE shared >= 0.5 * (x.n + y.n - shared)),
r AS (SELECT a AS id, b AS other FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other),
h AS (SELECT class_id, least(class_id, coalesce(min(other), class_id)) AS group_id FROM (SELECT DISTINCT class_id FROM m) LEFT JOIN r ON r.id = class_id GROUP BY class_id),
l AS (SELECT a, count(*) AS links FROM e GROUP BY a)
SELECT m.id, m.class_id, h.group_id, coalesce(l.links, 0) AS links FROM m JOIN h USING (class_id) LEFT JOIN l ON l.a = m.class_id
"""
P2_GROUPS = P2_GROUPS.replace("WITH t AS", "WITH RECURSIVE t AS", 1)

ORACLE_SQL: dict[str, str] = {"p2_found": P2_FOUND, "p2_groups": P2_GROUPS, "p3_found": P3_FOUND, "p3_group_sizes": P3_GROUP_SIZES, "p4_found": P4_FOUND, "p4_by_year": P4_BY_YEAR}
