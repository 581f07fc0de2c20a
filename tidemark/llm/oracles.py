"""DuckDB SQL for the queries that SQL can express."""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS run
  FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS t(i) WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM windows), runs AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS run
  FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)
), hits AS (SELECT doc_id, i, n, item_id FROM runs JOIN windows USING (n, run)),
places AS (SELECT DISTINCT doc_id, p FROM hits, unnest(range(i, i + n)) AS t(p)),
counted AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), q AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM q
"""

_DIGIT = "('0x' || substr(md5(entry), {}, 2))::BIGINT"
_D = [_DIGIT.format(2 * i + 1) for i in range(6)]

URL_FILTER = rf"""
WITH p AS (
  SELECT page_id, url, 1704067200 + page_id * 60 AS fetched_at,
    rtrim(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:@]*)', 1)), '.') AS host,
    list_filter(string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS path
  FROM pages
), k AS (
  SELECT page_id, fetched_at, array_to_string(l[len(l) - i + 1 :], '.') AS entry
  FROM (SELECT *, string_split(host, '.') AS l FROM p WHERE host <> ''), unnest(range(1, least(len(l), 3) + 1)) AS t(i)
  UNION
  SELECT page_id, fetched_at, host || '/' || path[1] FROM p WHERE host <> '' AND len(path) > 0
), e AS (
  SELECT DISTINCT entry, 1704067200 + {_D[1]} * 21600 AS added FROM k WHERE {_D[0]} < 64 AND contains(entry, '.')
), r AS (SELECT *, added + ({_D[2]} + 1) * 43200 AS removed FROM e), spans AS (
  SELECT entry, added AS since, removed AS until FROM r
  UNION ALL SELECT entry, removed + ({_D[3]} + 1) * 43200, NULL FROM r WHERE {_D[5]} % 2 = 0
), met AS (
  SELECT page_id, entry, since, until, row_number() OVER (PARTITION BY page_id ORDER BY length(entry) DESC, entry DESC) AS n
  FROM k JOIN spans USING (entry) WHERE since <= fetched_at AND (until IS NULL OR fetched_at < until)
)
SELECT p.page_id, p.url, p.fetched_at, entry IS NOT NULL AS blocked, entry,
  CASE WHEN {_D[4]} % 2 = 0 THEN 'spam' WHEN entry IS NOT NULL THEN 'adult' END AS category, since, until
FROM p LEFT JOIN (SELECT * FROM met WHERE n = 1) m ON p.page_id = m.page_id
"""

JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS run
  FROM d, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS t(i) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.run = y.run AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)
), reach AS (SELECT doc_id AS node, doc_id AS other FROM d UNION SELECT node, b FROM reach JOIN links ON a = other)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(other) FROM reach WHERE node = d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id)
"""

OWNERS = f"""
WITH d AS (SELECT doc_id, {_FOLDED} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

INFILL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l, sha256('7:' || doc_id) AS h FROM documents
), e AS (
  SELECT *, len(l) AS n, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS r FROM d
), f AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
      WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM e
), g AS (
  SELECT *, coalesce(array_to_string(l[1 : a], ''), '') AS p, coalesce(array_to_string(l[a + 1 : b], ''), '') AS m,
    coalesce(array_to_string(l[b + 1 : n], ''), '') AS s FROM f
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM g
"""
