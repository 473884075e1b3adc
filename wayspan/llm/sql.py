"""SQL of the queries that SQL can express (DuckDB)."""

from __future__ import annotations

from . import urls

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest AS digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND (page_id IS NULL OR page_id > first) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS NULL OR page_id > first THEN first END AS refers_to
FROM d LEFT JOIN f ON digest = payload_digest"""

_fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
_longest_first = sorted(urls.RULES, key=lambda r: -len(r.text))
_rule = " ".join(f"WHEN {_fits(r)} THEN '{r.text}'" for r in _longest_first)
_verdict = " ".join(f"WHEN {_fits(r)} THEN '{'allow' if r.allow else 'block'}'" for r in _longest_first)

URLS = f"""
WITH u AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
k AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':(80|443)?$', ''), '\\.$', ''), '^www\\.', '') || regexp_replace(path, '/+$', '') END AS key FROM u),
l AS (SELECT key AS listed FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(*) >= {urls.LISTED_PAGES})
SELECT page_id, host, path, CASE {_rule} END AS rule, CASE {_verdict} WHEN listed IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM k LEFT JOIN l ON key = listed"""

_words = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_words.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {_words.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, list_aggregate(w[i : i + least(10, len(w)) - 1], 'string_agg', ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, i, k, list_aggregate(w[i : i + k - 1], 'string_agg', ' ') AS g FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT r, i, dw.k, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
h AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM m) GROUP BY r),
n AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM m GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(n.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM d LEFT JOIN h ON h.r = d.r LEFT JOIN n ON n.r = d.r"""

# Windows as hex, two digits a byte; a byte is cut if a window over it starts in a smaller document.
SUFFIX = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT r, doc_id, i, substr(x, 2 * i - 1, 100) AS s FROM (SELECT r, doc_id, x, unnest(range(1, len(x) // 2 - 48)) AS i FROM d WHERE len(x) >= 100)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
c AS (SELECT r, i FROM w JOIN f USING (s) WHERE first < doc_id),
g AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM c),
n AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS span FROM g),
s AS (SELECT r, span, min(i) AS a, max(i) + 49 AS z FROM n GROUP BY r, span),
k AS (SELECT r, count(*) AS n_spans, sum(z - a + 1) AS n_removed, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z FROM s GROUP BY r)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN a IS NULL THEN x ELSE list_aggregate(list_transform(range(0, len(a) + 1), lambda j: substr(x, CASE WHEN j = 0 THEN 1 ELSE 2 * z[j] + 1 END,
    CASE WHEN j < len(a) THEN 2 * a[j + 1] - 1 ELSE len(x) + 1 END - CASE WHEN j = 0 THEN 1 ELSE 2 * z[j] + 1 END)), 'string_agg', '') END)) AS kept_sha256
FROM d LEFT JOIN k USING (r)"""

ORACLES: dict[str, str] = {
    "op2_suffix_dedup": SUFFIX,
    "op3_warc_archive": WARC,
    "op4_url_filter": URLS,
    "op9_decontamination": DECONTAMINATION,
}
