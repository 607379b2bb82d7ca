"""DuckDB SQL for the queries of this folder that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op5_minhash_neardup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
           WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, CAST(len(w) - 2 AS BIGINT)), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (
  SELECT doc_id AS id, doc_id AS r FROM documents
  UNION SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.id),
lowest AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, l.component_id,
       coalesce(d.doc_id = l.component_id, false) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN lowest l ON l.id = d.doc_id
"""

ORACLE["op2_host_reputation"] = r"""
WITH parsed AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^(.*?)://([^/?#]*)([^?#]*)', 2), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^(.*?)://([^/?#]*)([^?#]*)', 3), '') AS path
  FROM pages),
known AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
h AS (
  SELECT host, count(k.bad) AS n, coalesce(sum(k.bad), 0) AS bad, string_split(host, '.')[-1] AS suffix,
         array_to_string(string_split(host, '.')[-2:], '.') AS domain
  FROM parsed LEFT JOIN known k ON page_id = k.doc_id GROUP BY host),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY suffix),
levels AS (
  SELECT 's' AS level, n, bad FROM s WHERE n > 0 UNION ALL SELECT 'd', n, bad FROM d WHERE n > 0
  UNION ALL SELECT 'h', n, bad FROM h WHERE n > 0),
sums AS (
  SELECT level, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad, sum(bad * bad / CAST(n AS DOUBLE)) AS q,
         CAST(sum(n * n) AS DOUBLE) AS n2, count(*) AS g FROM levels GROUP BY level),
strength AS (
  SELECT level, bad / n AS m,
         1 / least(greatest(CASE WHEN n - n2 / n > 0 AND (bad / n) * (1 - bad / n) > 0
           THEN (q - 2 * (bad / n) * bad + (bad / n) * (bad / n) * n - (g - 1) * (bad / n) * (1 - bad / n))
                / ((n - n2 / n) * (bad / n) * (1 - bad / n)) ELSE 0.001 END, 0.001), 0.9) - 1 AS k
  FROM sums),
ms AS (SELECT suffix, (bad + k * m) / (n + k) AS ms FROM s JOIN strength ON level = 's'),
md AS (SELECT domain, (bad + k * ms) / (n + k) AS md FROM d JOIN ms USING (suffix) JOIN strength ON level = 'd'),
rep AS (
  SELECT host, n, bad + k * md AS a, n - bad + k * (1 - md) AS b, n + k AS t FROM h JOIN md USING (domain) JOIN strength ON level = 'h'),
bounds AS (
  SELECT host, a / t AS bad_mean, a / t - 1.645 * sqrt(greatest(a * b, 0) / (t * t * (t + 1))) AS bad_low FROM rep),
rules AS (
  SELECT * FROM (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block'))
    AS t(rule, rule_host, rule_path, verdict)),
fits AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parsed) p
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY host, path)
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.verdict, CASE WHEN coalesce(b.bad_low, 0) > 0.25 THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(h.n AS BIGINT) AS n_labelled, round(coalesce(b.bad_mean, 0), 6) AS bad_mean, round(coalesce(b.bad_low, 0), 6) AS bad_low
FROM parsed p JOIN h ON h.host = p.host LEFT JOIN bounds b ON b.host = p.host
LEFT JOIN fits f ON f.host = p.host AND f.path = p.path
"""

ORACLE["op1_nn_descent"] = r"""
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
valid AS (
  SELECT r, e, len(e) AS n FROM vectors
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM valid a JOIN valid b ON a.n = b.n
  WHERE a.r <> b.r AND CASE WHEN a.n = b.n THEN list_cosine_similarity(a.e, b.e) >= 0.9 ELSE false END),
reach AS (
  SELECT r AS id, vec_id AS v FROM vectors
  UNION SELECT links.b, reach.v FROM reach JOIN links ON links.a = reach.id),
lowest AS (SELECT id, min(v) AS component_id FROM reach GROUP BY id),
counts AS (SELECT a, count(*) AS k FROM links GROUP BY a)
SELECT v.vec_id, coalesce(k, 0) AS n_links, l.component_id, coalesce(v.vec_id = l.component_id, false) AS kept
FROM vectors v LEFT JOIN lowest l ON l.id = v.r LEFT JOIN counts ON counts.a = v.r
"""

ORACLE["op13_bloom_lines"] = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
frequent AS (
  SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, pos, line, f.top IS NOT NULL AND f.top <> doc_id AS gone FROM keyed LEFT JOIN frequent f ON f.k = keyed.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
