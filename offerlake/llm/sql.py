"""DuckDB SQL for the queries of this folder that SQL can express."""

A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP1 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{A_Z}', '{A_Z.lower()}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
                      ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM s JOIN least ON s.doc_id = least.a
"""

OP5 = rf"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{A_Z}', '{A_Z.lower()}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (
  SELECT p.host, p.path, arg_max(r.host || r.path, length(r.host) + length(r.path)) AS rule,
         arg_max(r.verdict, length(r.host) + length(r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM p) p
  JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.host, p.path)
SELECT p.page_id, p.host, p.path, fit.rule, coalesce(fit.verdict, 'allow') AS verdict
FROM p LEFT JOIN fit ON p.host = fit.host AND p.path = fit.path
"""

OP11 = rf"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
d AS (
  SELECT w.doc_id, part,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(text) - length(translate(text, '{A_Z}', ''))) > 3 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 16 ELSE 0 END AS bits
  FROM w),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, bits, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id GROUP BY part, bits),
f(x, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT f1.x || f2.x || f3.x || f4.x || f5.x AS filter_order, [f1.b, f2.b, f3.b, f4.b, f5.b] AS b
  FROM f f1, f f2, f f3, f f4, f f5
  WHERE len(list_distinct([f1.b, f2.b, f3.b, f4.b, f5.b])) = 5),
s AS (SELECT filter_order, k AS step, b[k] AS bit, CAST(coalesce(list_sum(b[1:k - 1]), 0) AS INT) AS before FROM o, range(1, 6) r(k))
SELECT part, filter_order, CAST(step AS INT) AS step,
       CAST(sum(CASE WHEN bits & bit = 0 AND bits & before = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN bits & bit <> 0 AND bits & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN bits & bit <> 0 AND bits & before <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN bits = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN bits & bit <> 0 AND bits & before = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN bits & bit <> 0 AND bits & before = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(sum(CASE WHEN bits & bit <> 0 AND bits & before = 0 THEN n ELSE 0 END)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM c, s
GROUP BY part, filter_order, step, bit
"""

OP13 = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''), '{A_Z}', '{A_Z.lower()}'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM p, range(1, 5) r(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 30),
cuts AS (SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS p1, array_to_string(w[cut + 1:], ' ') AS p2
         FROM c, range(1, 4) r(cut) WHERE cut < k),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r, (2000000 :: HUGEINT * a) // (x.f + y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p1 JOIN f y ON y.lang = cuts.lang AND y.phrase = p2),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
held AS (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM c, range(2, 4) r(m), range(1, 4) q(i) WHERE m < k AND i <= k - m + 1),
cover AS (SELECT lang, phrase, max(a) AS most FROM held GROUP BY lang, phrase),
kept AS (SELECT low.* FROM low LEFT JOIN cover ON low.lang = cover.lang AND low.phrase = cover.phrase
         WHERE most IS NULL OR 100 * most < 80 * low.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n.n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n ON ranked.lang = n.lang WHERE rank <= 2000
"""

ORACLES = {"op1_minhash_dedup": OP1, "op5_url_filter": OP5, "op11_filter_audit": OP11, "op13_phrases": OP13}
