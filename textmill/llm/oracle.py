"""DuckDB SQL for the queries that SQL can express."""

from .revisits import NOT_MERGED

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1]::HUGEINT * p[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(3 * source_size) OVER (
      ORDER BY (3 * source_size) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (
      ORDER BY (3 * source_size) / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s
), t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * max(level) OVER ()) AS target FROM l
), p AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0 THEN (budget // source_size) * size
     + greatest(0, least(size, budget % source_size - start)) ELSE 0 END)::BIGINT AS taken
FROM p
"""

REVISITS = f"""
WITH raw AS (
  SELECT page_id * 2 AS record_id, url, page_id * 10 AS time, 'response' AS kind,
    CASE WHEN page_id % 11 = 0 THEN 503 ELSE 200 END AS status,
    '"' || md5(coalesce(html, '')) || '"' AS etag, sha256(coalesce(html, '')) AS digest,
    [{{'name': 'Content-Type', 'value': 'text/html'}}, {{'name': 'Content-Length', 'value': length(html)::VARCHAR}},
     {{'name': 'Cache-Control', 'value': 'max-age=60'}}] AS headers
  FROM pages
  UNION ALL
  SELECT page_id * 2 + 1, CASE WHEN page_id % 2 = 0 THEN url || '#seen' ELSE regexp_replace(url, '^https?://', 'HTTP://www.') END,
    page_id * 10 + (page_id * 7919 % 4001) * 10 - 4005, 'revisit', 304,
    CASE WHEN page_id % 5 = 0 THEN '"stale"' WHEN page_id % 7 = 0 THEN NULL ELSE 'W/"' || md5(coalesce(html, '')) || '"' END,
    sha256(coalesce(html, '')),
    [{{'name': 'cache-control', 'value': 'max-age=90'}}, {{'name': 'Content-Length', 'value': '0'}},
     {{'name': 'X-Seen', 'value': page_id::VARCHAR}}]
  FROM pages
), cut AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM raw
), keyed AS (
  SELECT *,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^.*@', ''), '^(www|m)[.]', ''), ':(80|443)$', '')
    || regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
         regexp_replace(bare, '^[^/?]*', ''),
         '([?&])(utm_[a-z]+|ref)=[^&]*', '\\1', 'g'), '&+', '&', 'g'), '[?]&', '?', 'g'), '[?&]+$', ''), '/+$', ''), '/+[?]', '?', 'g') AS key
  FROM cut
), asked AS (SELECT * FROM keyed WHERE kind = 'revisit'),
answers AS (SELECT * FROM keyed WHERE kind = 'response' AND status = 200),
matched AS (
  SELECT a.*, r.record_id AS r_id, r.time AS r_time, r.digest AS r_digest, r.etag AS r_etag, r.headers AS r_headers,
    row_number() OVER (PARTITION BY a.record_id ORDER BY r.time DESC NULLS LAST, r.record_id DESC NULLS LAST) AS n
  FROM asked a LEFT JOIN answers r ON r.key = a.key AND r.time < a.time
), judged AS (
  SELECT *, CASE WHEN r_id IS NULL THEN 'unresolved'
    WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(r_etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
    WHEN digest = r_digest THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM matched WHERE n = 1
), merged AS (
  SELECT *, list_filter(headers, lambda f: NOT list_contains({list(NOT_MERGED)}, lower(f.name))) AS fresh FROM judged
)
SELECT record_id AS revisit_id, url, key AS canonical_url, time, outcome,
  CASE WHEN outcome = 'resolved' THEN r_id END AS response_id,
  CASE WHEN outcome = 'resolved' THEN r_time END AS response_time,
  CASE WHEN outcome = 'resolved' THEN r_digest END AS digest,
  array_to_string(list_transform(CASE WHEN outcome = 'resolved' THEN
    list_concat(list_filter(r_headers, lambda h: NOT list_contains(list_transform(fresh, lambda g: lower(g.name)), lower(h.name))), fresh)
    ELSE headers END, lambda h: h.name || ': ' || h.value), chr(10)) AS headers
FROM merged
"""

AUDIT = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), uses AS (
  SELECT lang, source, row, term, count(*) AS n FROM (SELECT lang, source, row, unnest(terms) AS term FROM d) GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n)::HUGEINT AS lang_n FROM uses GROUP BY lang, term HAVING count(*) >= 3
), langs AS (
  SELECT lang, sum(lang_n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), here AS (
  SELECT lang, source, term, sum(n)::HUGEINT AS n FROM uses JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
    LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS total FROM here GROUP BY ALL) USING (lang, source)
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
    1 + 1000000000 * (coalesce(h.n, 0) + 1) // (g.total + l.v) AS p,
    1 + 1000000000 * (k.lang_n + 1) // (l.total + l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN here h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(p.value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 200
"""

FILL_IN_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(lines) AS n, ('0x' || h[1:8])::BIGINT % (len(lines) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(lines) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), cut AS (
  SELECT *, coalesce(array_to_string(lines[1:least(a, b)], ''), '') AS prefix,
    coalesce(array_to_string(lines[least(a, b) + 1:greatest(a, b)], ''), '') AS middle,
    coalesce(array_to_string(lines[greatest(a, b) + 1:], ''), '') AS suffix
  FROM drawn
), put AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
  FROM cut
), found AS (
  SELECT *, strpos(output, '<P>') AS p, strpos(output, '<S>') AS s, strpos(output, '<M>') AS m FROM put
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN substr(output, p + 3, s - p - 3) || substr(output, m + 3) || substr(output, s + 3, m - s - 3)
    ELSE substr(output, p + 3, m - p - 3) || substr(output, m + 3) || substr(output, s + 3, p - s - 3) END) AS restored_sha256
FROM found
"""
