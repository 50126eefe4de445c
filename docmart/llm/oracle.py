"""DuckDB SQL for the queries of this subpackage that SQL can express.

Every statement works the plain way: all rules on every url, the whole order of
a source in one window, all pairs of documents that share a shingle.
"""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

_WORD = r"[^\x20\x09-\x0D]+"

# ---- op6: every rule on every url; the patterns restate url_rules.PATTERN_RULES ----
ORACLE_SQL["op6_url_rules"] = r"""
WITH cut AS (
  SELECT page_id, url,
    CASE WHEN url IS NOT NULL AND strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
matched AS (
  SELECT *,
    (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') AS r1,
    (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') AS r2,
    (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') AS r3,
    (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') AS r4,
    least(""" + ",\n      ".join(
    f"CASE WHEN regexp_matches(lowered, '(^|[^a-z0-9]){body}([^a-z0-9]|$)') THEN '{name}' END" for name, body in (
        ("ads", "ads"), ("adult", "xxx"), ("betting", "bet[^a-z0-9]+online"), ("casino", "casino"),
        ("login", "wp[^a-z0-9]+login"), ("pills", "viagra"), ("porn", "porn"), ("spam", "spam"),
        ("torrent", "torrent"), ("tracker", "track[^a-z0-9]+click"), ("warez", "warez"))) + r""") AS pattern
  FROM parts),
ruled AS (
  SELECT *, CASE WHEN r2 THEN 'example.net/en/' WHEN r3 THEN 'example.com/de/' WHEN r4 THEN 'org/fr/'
                 WHEN r1 THEN 'net/' END AS rule
  FROM matched)
SELECT page_id, host, path, rule, pattern,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""

# ---- op7: pairs of documents by shared shingles, reachability by recursion ---------
ORACLE_SQL["op7_jaccard_groups"] = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM worded),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
  WHERE 100 * common >= 90 * (sa.n + sb.n - common)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) c ON c.doc_id = d.doc_id"""

# ---- op8: the level of the targets over sources by cap, one window over a source ---
ORACLE_SQL["op8_mix"] = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
    (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 12) AS BIGINT) AS DOUBLE) + 0.5)
      / CAST(281474976710656 AS DOUBLE) AS u
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) AS cap,
    (sum(source_size) OVER ()
     - coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM src),
goal AS (
  SELECT source, source_size, least(weight * (SELECT max(level) FROM filled), cap) AS target,
    CASE WHEN source_size > 0 THEN least(weight * (SELECT max(level) FROM filled), cap) / source_size ELSE 0.0::DOUBLE END AS ratio
  FROM filled),
mean AS (
  SELECT source, sum(greatest(floor(sqrt(size)), 1) * size) / sum(size) AS mean_w FROM sized GROUP BY source),
ranked AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, floor(g.ratio) AS whole, s.source,
    g.ratio - floor(g.ratio) > 0 AND s.size > 0 AS open_row, g.target - floor(g.ratio) * g.source_size AS left0,
    least(greatest((g.ratio - floor(g.ratio)) * greatest(floor(sqrt(s.size)), 1) / coalesce(m.mean_w, 1.0::DOUBLE), 1e-9::DOUBLE),
          1 - 1e-9::DOUBLE) AS p, s.u
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source JOIN mean m ON s.source IS NOT DISTINCT FROM m.source),
odds AS (
  SELECT * EXCLUDE (u, p), ((u / (1 - u)) / (p / (1 - p))) / (1 + (u / (1 - u)) / (p / (1 - p))) AS place FROM ranked),
first AS (
  SELECT *, open_row AND size <= left0 AS tries0, sum(size) OVER (PARTITION BY source, open_row AND size <= left0
      ORDER BY place, doc_id, size) AS upto0 FROM odds),
first_done AS (
  SELECT *, tries0 AND upto0 <= left0 AS took0,
    left0 - coalesce(sum(CASE WHEN tries0 AND upto0 <= left0 THEN size END) OVER (PARTITION BY source), 0) AS left1 FROM first),
second AS (
  SELECT *, open_row AND NOT took0 AND size <= left1 AS tries1,
    sum(size) OVER (PARTITION BY source, open_row AND NOT took0 AND size <= left1 ORDER BY place, doc_id, size) AS upto1
  FROM first_done),
second_done AS (
  SELECT *, tries1 AND upto1 <= left1 AS took1,
    left1 - coalesce(sum(CASE WHEN tries1 AND upto1 <= left1 THEN size END) OVER (PARTITION BY source), 0) AS left2 FROM second),
third AS (
  SELECT *, open_row AND NOT took0 AND NOT took1 AND size <= 2 * left2 AS tries2,
    sum(size) OVER (PARTITION BY source, open_row AND NOT took0 AND NOT took1 AND size <= 2 * left2
      ORDER BY place, doc_id, size) AS upto2 FROM second_done),
done AS (
  SELECT *, CAST(whole + CASE WHEN took0 OR took1 OR (tries2 AND upto2 - size / 2 <= left2) THEN 1 ELSE 0 END AS INTEGER) AS copies
  FROM third)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, copies FROM done"""

# ---- op11: every failure pattern under every order, step by step ------------------
ORACLE_SQL["op11_filter_audit"] = rf"""
WITH worded AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents),
failing AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) THEN 'E' ELSE '' END AS fails
  FROM worded),
known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
patterns AS (
  SELECT part, fails, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, count(*) AS n
  FROM failing LEFT JOIN known USING (doc_id) GROUP BY 1, 2, 3, 4),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT p.*, filter_order, step, filter_order[step] AS l,
    least(CASE WHEN contains(fails, 'A') THEN strpos(filter_order, 'A') END,
          CASE WHEN contains(fails, 'B') THEN strpos(filter_order, 'B') END,
          CASE WHEN contains(fails, 'C') THEN strpos(filter_order, 'C') END,
          CASE WHEN contains(fails, 'D') THEN strpos(filter_order, 'D') END,
          CASE WHEN contains(fails, 'E') THEN strpos(filter_order, 'E') END) AS gone
  FROM patterns p, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT part, filter_order, step, l,
    coalesce(sum(n) FILTER (gone IS NULL OR gone > step), 0) AS kept,
    coalesce(sum(n) FILTER (gone = step), 0) AS removed,
    coalesce(sum(n) FILTER (contains(fails, l) AND gone < step), 0) AS redundant,
    coalesce(sum(n) FILTER (fails = l), 0) AS unique_fails,
    coalesce(sum(n) FILTER (gone = step AND good = 1), 0) AS good_lost,
    coalesce(sum(n) FILTER (gone = step AND bad = 1), 0) AS toxic_lost
  FROM steps GROUP BY part, filter_order, step, l)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM counted"""

# ---- op12: all pairs of one label, reachability by recursion -----------------------
ORACLE_SQL["op12_embedding_dedup"] = """
WITH RECURSIVE numbered AS (SELECT *, row_number() OVER () AS r FROM embeddings),
usable AS MATERIALIZED (
  SELECT r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v
  FROM numbered
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT x.r, x.vec_id AS a, y.vec_id AS b
  FROM usable x JOIN usable y ON x.label = y.label AND len(x.v) = len(y.v) AND x.r <> y.r
  WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT c.vec_id, l.b FROM reach c JOIN links l ON l.a = c.other)
SELECT n.vec_id, CAST((SELECT count(*) FROM links l WHERE l.r = n.r) AS BIGINT) AS n_links, c.component_id,
  coalesce(n.vec_id = c.component_id, false) AS kept
FROM numbered n LEFT JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) c ON c.vec_id = n.vec_id"""
