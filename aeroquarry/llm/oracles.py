"""SQL of the operators that SQL can express.

The others draw by a hash that other engines lack (mixing), train models
(classifier, personal data), or write files and sort suffixes (media, packing,
substring dedup); tests hold those against brute force.
"""

from __future__ import annotations

WORDS = "list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

OP1 = f"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT *, {WORDS} AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT r, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
twice AS (SELECT r, unnest(list(i)) AS i FROM g GROUP BY r, words[i : i + 4] HAVING count(*) > 1),
hit AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(5) s(k) GROUP BY r),
m AS (
  SELECT doc_id, host, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN hit USING (r)
),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
e AS (
  SELECT host, unnest([n_words < 10, 100 * n_repeat_words > 20 * n_words, 100 * n_symbols > 10 * word_chars, 100 * n_dup_lines > 10 * n_words]) AS failed, unnest([1, 2, 3, 4]) AS rule
  FROM f WHERE host IS NOT NULL
),
h AS (SELECT host, rule, count(*)::DOUBLE AS n, count(*) FILTER (WHERE failed)::DOUBLE AS k FROM e GROUP BY host, rule),
p AS (SELECT rule, sum(k) / sum(n) AS mean, avg(k / n) AS m, coalesce(var_samp(k / n), 0) - avg(k / n) * (1 - avg(k / n)) * avg(1 / n) AS b FROM h GROUP BY rule),
s AS (SELECT rule, mean, least(greatest(CASE WHEN b > 0 THEN m * (1 - m) / b - 1 ELSE 1e4 END, 20), 1e4) AS strength FROM p),
out AS (SELECT host FROM h JOIN s USING (rule) WHERE (k + mean * strength) / (n + strength) > greatest(least(4 * mean, (1 + mean) / 2), 0.25))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (host IS NULL OR host NOT IN (SELECT host FROM out)) AS kept
FROM f"""

OP2 = """
WITH u AS (SELECT page_id, url, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substring(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u
),
o AS (
  SELECT host, coalesce(quality = 0, false) OR coalesce(toxic = 1, false) AS bad
  FROM p JOIN labels ON try_cast(regexp_extract(path, '/([0-9]{1,18})([.]html)?/?$', 1) AS BIGINT) = doc_id
  WHERE host <> '' AND (quality IS NOT NULL OR toxic IS NOT NULL)
),
every AS (
  SELECT host, array_to_string(parts[-n:], '.') AS suffix, array_to_string(parts[-n - 1:], '.') AS domain
  FROM (SELECT host, string_split(host, '.') AS parts, CASE WHEN array_to_string(string_split(host, '.')[-2:], '.') IN
    ('co.uk', 'org.uk', 'com.au', 'co.jp', 'co.nz', 'com.br', 'co.za', 'co.in', 'com.mx', 'com.cn') THEN 2 ELSE 1 END AS n FROM (SELECT DISTINCT host FROM p WHERE host <> ''))
),
h AS (SELECT e.host, e.suffix, e.domain, count(o.host)::DOUBLE AS n, count(*) FILTER (WHERE o.bad)::DOUBLE AS k FROM every e LEFT JOIN o USING (host) GROUP BY ALL),
d AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM h WHERE n > 0 GROUP BY suffix, domain),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY suffix),
levels AS (SELECT 's' AS level, n, k FROM s UNION ALL SELECT 'd', n, k FROM d UNION ALL SELECT 'h', n, k FROM h WHERE n > 0),
v AS (SELECT level, avg(k / n) AS m, coalesce(var_samp(k / n), 0) - avg(k / n) * (1 - avg(k / n)) * avg(1 / n) AS b FROM levels GROUP BY level),
strength AS (SELECT level, CASE WHEN b > 0 THEN least(greatest(m * (1 - m) / b - 1, 2), 1e4) ELSE 1e4 END AS t FROM v),
ts AS (SELECT max(t) FILTER (WHERE level = 's') AS s, max(t) FILTER (WHERE level = 'd') AS d, max(t) FILTER (WHERE level = 'h') AS h, (SELECT sum(k) / sum(n) FROM s) AS mean FROM strength),
ab AS (
  SELECT host, k + ts.h * r AS a, n - k + ts.h * (1 - r) AS b, least(2 * mean, 0.95) AS x FROM (
    SELECT h.host, h.n, h.k, greatest(least(coalesce((d.k + ts.d * rs) / (d.n + ts.d), rs), 1 - 1e-6), 1e-6) AS r FROM (
      SELECT h.*, coalesce((s.k + ts.s * ts.mean) / (s.n + ts.s), ts.mean) AS rs FROM h LEFT JOIN s USING (suffix), ts
    ) h LEFT JOIN d USING (suffix, domain), ts
  ), ts
),
-- The density above x is summed over 20000 strips that narrow towards 1: t = 1 - (1 - x) * w ** 8.
blocked AS (
  SELECT host FROM (SELECT host, a, b, x, ln((i + 0.5) / 20000) AS w FROM ab, range(20000) g(i))
  GROUP BY host HAVING sum(exp((a - 1) * ln(1 - (1 - x) * exp(8 * w)) + (b - 1) * (ln(1 - x) + 8 * w) + lgamma(a + b) - lgamma(a) - lgamma(b) + ln(8 * (1 - x)) + 7 * w) / 20000) >= 0.95
),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule
  FROM p
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict
FROM r"""

OP4 = r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, sha256(text)) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, sha256(text)) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(15 + length(role) + length(text) + length(regexp_replace(role, '[^\\<' || chr(10) || ']', '', 'g')) + length(regexp_replace(text, '[^\\<]', '', 'g'))) AS chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars FROM g"""

OP9 = f"""
WITH RECURSIVE t AS (SELECT DISTINCT coalesce(text, '') AS t FROM documents),
w AS (SELECT t AS raw, {WORDS.replace("(t,", "(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),")} AS words FROM t),
n AS (SELECT row_number() OVER (ORDER BY raw) AS id, raw, words FROM w),
g AS (
  SELECT DISTINCT id, array_to_string(words[i : i + 3], ' ') AS g FROM (SELECT id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM n WHERE len(words) > 0)
),
size AS (SELECT id, count(*) AS n FROM g GROUP BY id),
common AS (SELECT id, g FROM g WHERE g IN (SELECT g FROM g GROUP BY g HAVING count(*) > 1)),
pair AS (SELECT a.id AS a, b.id AS b, count(*) AS common_n FROM common a JOIN common b ON a.g = b.g AND a.id <> b.id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN size x ON x.id = a JOIN size y ON y.id = b WHERE 100 * common_n >= 85 * (x.n + y.n - common_n)),
reach(a, b) AS (SELECT id, id FROM size UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
first AS (SELECT n.id, min(doc_id) AS doc FROM documents JOIN n ON coalesce(text, '') = raw GROUP BY n.id),
comp AS (SELECT a AS id, min(doc) AS component FROM reach JOIN first ON first.id = b GROUP BY a),
degree AS (SELECT a AS id, count(*) AS n FROM link GROUP BY a)
SELECT doc_id, coalesce(size.n, 0)::BIGINT AS n_shingles, coalesce(comp.component, doc_id) AS component_id, coalesce(degree.n, 0)::BIGINT AS n_links
FROM documents JOIN n ON coalesce(text, '') = raw LEFT JOIN size USING (id) LEFT JOIN comp USING (id) LEFT JOIN degree USING (id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": OP1, "op2_url_filters": OP2, "op4_chat_formatting": OP4, "op9_ngram_jaccard_join": OP9}
