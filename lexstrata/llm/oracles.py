"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOW = f"translate(text, '{_UPPER}', '{_LOWER}')"


def _runs(source: str, n: str) -> str:
    """(.., i, k): every run of ``n`` words of the list w, as text."""
    return f"SELECT * EXCLUDE (w), array_to_string(w[i:i + {n} - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - {n} + 2)) AS i FROM {source} WHERE len(w) >= {n})"


SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
r AS ({_runs('d', '50')}),
f AS (SELECT k, min(doc_id) AS owner FROM r GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM r JOIN f USING (k) WHERE doc_id > owner),
kept AS (SELECT doc_id, count(g.i) AS n_removed, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (WHERE g.i IS NULL), '') AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) a LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

JACCARD_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({_WORDS.format(_LOW)}, []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, k FROM ({_runs('d', '5')} UNION ALL SELECT doc_id, 1, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM reach r JOIN u ON r.b = u.a)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON a = d.doc_id GROUP BY d.doc_id"""

QUALITY_RULES = f"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
r AS ({_runs('(SELECT doc_id, w FROM d)', '5')}),
twice AS (SELECT doc_id, k FROM r GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM r JOIN twice USING (doc_id, k)) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
c AS (SELECT doc_id, host, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
  coalesce(lines.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
h AS (SELECT host, count(*) AS n, sum(base_failed::INT) AS failed FROM b WHERE host IS NOT NULL GROUP BY host),
m AS (SELECT least(greatest(sum(failed) / sum(n), 1e-6), 1 - 1e-6) AS mean FROM h),
q AS (SELECT any_value(mean) AS mean, sum((failed - n * mean) ** 2 - n * (mean * (1 - mean))) / (any_value(mean) * (1 - any_value(mean)) * nullif(sum(n::DOUBLE * (n - 1)), 0)) AS r FROM h, m),
k AS (SELECT mean, CASE WHEN coalesce(r, 0) <= 1 / (1e6 + 1) THEN 1e6 ELSE greatest(1 / r - 1, 1.0) END AS weight FROM q),
rate AS (SELECT host, (failed + mean * weight) / (n + weight) AS rate FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(rate, 0) < 0.5 AS kept FROM b LEFT JOIN rate USING (host)"""

# Pages of the driver's tables declare no aliases, so the rules alone decide there.
URL_FILTERS = f"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(v, h, q) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (SELECT page_id, arg_max(h || q, length(h || q)) AS rule, arg_max(v, length(h || q)) AS v FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN f USING (page_id)"""

_ALNUM = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, coalesce({_ALNUM}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS n FROM (SELECT item_id, coalesce({_ALNUM}, []) AS w FROM benchmark) WHERE len(w) > 0),
t AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
r AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM t) WHERE len(w) >= n)),
f AS (SELECT doc_id, r.n, i, item FROM r JOIN t ON r.k = t.k AND r.n = t.n),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM f) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM f) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

ORACLES = {
    "op1_substring_dedup": SUBSTRING_DEDUP,
    "op5_jaccard_join": JACCARD_JOIN,
    "op7_quality_rules": QUALITY_RULES,
    "op8_url_filters": URL_FILTERS,
    "op10_decontamination": DECONTAMINATION,
}
