"""DuckDB SQL of the registered queries that SQL can express."""

from .url_filter import DOMAIN_PATTERN, SUFFIX_PATTERN

SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH raw AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents
), bare AS (
  SELECT doc_id, line_no, trim(line, {SPACE}) AS line,
         row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos
  FROM raw WHERE trim(line, {SPACE}) <> ''
), three AS (
  SELECT doc_id, pos, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c
  FROM bare WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, pos,
         row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS occurrence
  FROM three WHERE c IS NOT NULL
), covered AS (
  SELECT DISTINCT doc_id, pos + k AS pos
  FROM later, (SELECT unnest([0, 1, 2]) AS k) WHERE occurrence > 1
), gone AS (
  SELECT b.doc_id, b.line_no, b.pos, lead(b.line_no) OVER w AS next_at, lead(b.pos) OVER w AS next_pos
  FROM bare b JOIN covered USING (doc_id, pos) WINDOW w AS (PARTITION BY b.doc_id ORDER BY b.pos)
), kept AS (
  SELECT r.doc_id, string_agg(r.line, chr(10) ORDER BY r.line_no) AS text
  FROM raw r LEFT JOIN gone g
    ON r.doc_id = g.doc_id AND (r.line_no = g.line_no OR (g.next_pos = g.pos + 1 AND r.line_no > g.line_no AND r.line_no < g.next_at))
  WHERE g.doc_id IS NULL GROUP BY r.doc_id
), counted AS (
  SELECT doc_id, count(*)::INTEGER AS n FROM covered GROUP BY doc_id
)
SELECT d.doc_id,
       CASE WHEN counted.n IS NULL THEN d.text ELSE coalesce(kept.text, '') END AS text,
       coalesce(counted.n, 0) AS lines_removed
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)
"""

UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def _shrunk(name: str, groups: str, key: str) -> str:
    return f"""
{name}_rho AS (
  SELECT greatest(0.001, least(0.9, coalesce(
    sum(CASE WHEN n > 0 THEN n * power(good::DOUBLE / n - above, 2) - above * (1 - above) END)
    / nullif(sum(CASE WHEN n > 0 THEN above * (1 - above) * (n - 1) END), 0), 0.001))) AS rho
  FROM {groups}
), {name} AS (
  SELECT {key}, ((1 / rho - 1) * above + good) / (1 / rho - 1 + n) AS mean, 1 / rho - 1 + n AS strength
  FROM {groups}, {name}_rho
)"""


URL_FILTER = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), {UPPER}, {LOWER}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), outcomes AS (
  SELECT p.host, l.quality AS good FROM parts p
  LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) l
    ON try_cast(regexp_extract(p.path, '^/[^/]*/([0-9]+)', 1) AS BIGINT) = l.doc_id
), hosts AS (
  SELECT host, regexp_extract(host, '{DOMAIN_PATTERN}', 1) AS domain,
         coalesce(sum(good), 0) AS good, count(good) AS n
  FROM outcomes GROUP BY host
), domains AS (
  SELECT domain, regexp_extract(domain, '{SUFFIX_PATTERN}', 1) AS suffix, sum(good) AS good, sum(n) AS n FROM hosts GROUP BY domain
), suffixes AS (
  SELECT suffix, sum(good) AS good, sum(n) AS n FROM domains GROUP BY suffix
), suffix_in AS (
  SELECT *, (SELECT (sum(good) + 1.0) / (sum(n) + 2) FROM suffixes)::DOUBLE AS above FROM suffixes
), {_shrunk('by_suffix', 'suffix_in', 'suffix')}, domain_in AS (
  SELECT d.*, s.mean AS above FROM domains d JOIN by_suffix s USING (suffix)
), {_shrunk('by_domain', 'domain_in', 'domain')}, host_in AS (
  SELECT h.*, d.mean AS above FROM hosts h JOIN by_domain d USING (domain)
), {_shrunk('by_host', 'host_in', 'host')}, bounds AS (
  SELECT host, mean - 1.28 * sqrt(mean * (1 - mean) / (strength + 1)) AS bound FROM by_host
), rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), ruled AS (
  SELECT a.host, a.path, arg_max(r.h || r.p, length(r.h || r.p)) AS rule,
         arg_max(r.verdict, length(r.h || r.p)) AS says
  FROM (SELECT DISTINCT host, path FROM parts) a JOIN rules r
    ON (a.host = r.h OR ends_with(a.host, '.' || r.h)) AND starts_with(a.path, r.p)
  GROUP BY a.host, a.path
)
SELECT p.page_id, p.host, p.path, u.rule,
       coalesce(u.says, CASE WHEN b.bound >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict
FROM parts p JOIN bounds b USING (host) LEFT JOIN ruled u USING (host, path)
"""


WARC = f"""
WITH base AS (
  SELECT page_id AS p, url, html, '"' || md5(coalesce(html, '')) || '"' AS tag,
         'Mon, 01 Jan 2024 00:00:' || lpad((page_id % 60)::VARCHAR, 2, '0') || ' GMT' AS first
  FROM pages
), caps AS (
  SELECT b.*, k, k = 0 OR (k = 2 AND p % 3 = 0) AS is_full,
         1704067200 + (p % 1000) * 60 + k * 86400 AS seen
  FROM base b, (SELECT unnest([0, 1, 2, 3, -1]) AS k) WHERE k >= 0 OR p % 11 = 0
), recs AS (
  SELECT 'urn:' || p || ':' || k AS record_id, seen, is_full, k,
         CASE WHEN k = 0 THEN tag WHEN k = 1 AND p % 5 = 0 THEN '"other"' WHEN k = 1 THEN tag WHEN k >= 3 THEN 'W/' || tag END AS etag,
         CASE WHEN k = 0 THEN first WHEN k = 2 AND (p % 2 = 0 OR is_full) THEN first END AS changed,
         CASE WHEN k > 0 THEN 'max-age=' || k ELSE 'no-cache' END AS cache,
         CASE WHEN is_full THEN 'text/html' ELSE 'text/plain' END AS type,
         CASE WHEN is_full THEN 'origin' END AS server,
         CASE WHEN is_full THEN html || CASE WHEN k = 0 THEN '' ELSE '<!-- 2 -->' END END AS body,
         regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)([^#]*)', ['s', 'h', 'p', 'q']) AS u
  FROM caps
), keyed AS (
  SELECT *, translate(u.s, {UPPER}, {LOWER}) AS scheme, translate(u.h, {UPPER}, {LOWER}) AS host FROM recs
), canon AS (
  SELECT *, CASE WHEN scheme <> '' THEN scheme || '://'
    || CASE scheme WHEN 'http' THEN regexp_replace(host, ':80$', '') WHEN 'https' THEN regexp_replace(host, ':443$', '') ELSE host END
    || CASE WHEN u.p = '' THEN '/' ELSE u.p END || u.q END AS key
  FROM keyed
), found AS (
  SELECT n.*, o.record_id AS old_id, o.etag AS old_etag, o.changed AS old_changed, o.server AS old_server, o.body AS old_body, o.type AS old_type
  FROM canon n LEFT JOIN canon o ON NOT n.is_full AND o.record_id = (
    SELECT arg_max(r.record_id, (r.seen, r.record_id)) FROM canon r WHERE r.is_full AND r.key = n.key AND r.seen < n.seen)
), judged AS (
  SELECT *, CASE WHEN is_full THEN 'full' WHEN old_id IS NULL THEN 'orphan'
    WHEN etag IS NULL AND changed IS NULL THEN 'no validator'
    WHEN coalesce(CASE WHEN etag IS NOT NULL THEN regexp_replace(etag, '^W/', '') = regexp_replace(old_etag, '^W/', '')
                       ELSE changed = old_changed END, false) THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM found
), merged AS (
  SELECT *, outcome = 'resolved' AS done FROM judged
)
SELECT record_id, outcome, CASE WHEN done THEN old_id END AS refers_to,
       concat_ws(chr(10), 'cache-control: ' || cache,
         'content-type: ' || CASE WHEN done THEN old_type ELSE type END,
         'etag: ' || CASE WHEN done THEN coalesce(etag, old_etag) ELSE etag END,
         'last-modified: ' || CASE WHEN done THEN coalesce(changed, old_changed) ELSE changed END,
         'server: ' || CASE WHEN done THEN old_server ELSE server END) AS headers,
       md5(CASE WHEN done THEN old_body ELSE body END) AS payload_md5,
       length(CASE WHEN done THEN old_body ELSE body END) AS payload_chars
FROM merged
"""
