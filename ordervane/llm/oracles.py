"""The same results in plain SQL, where SQL can say it."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_LOWER_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                r"'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')")

ORACLES["op7_hyperminhash"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0),
shingles AS (SELECT DISTINCT s.doc_id, md5(array_to_string(d.w[s.i:s.i + 3], ' ')) AS h FROM starts s JOIN d USING (doc_id)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id <> b.doc_id
           GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id, n
"""

ORACLES["op8_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first_id FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (payload_digest)
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES["op5_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
windows AS (SELECT s.doc_id, s.i, md5(array_to_string(d.w[s.i:s.i + 49], ' ')) AS h FROM starts s JOIN d USING (doc_id)),
firsts AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (h) WHERE doc_id > first_id),
positions AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT p.doc_id, string_agg(d.w[p.p], ' ' ORDER BY p.p) AS k, count(*) AS n
         FROM positions p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.p = g.p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLES["op9_suffix_array"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
starts AS (SELECT doc_id, unnest(range(1, n - 198)) AS i FROM d WHERE n >= 200),
windows AS (SELECT s.doc_id, s.i, md5(substr(d.h, 2 * s.i - 1, 400)) AS w FROM starts s JOIN d USING (doc_id)),
often AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hits AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 200, true) AS opens
         FROM windows JOIN often USING (w)),
runs AS (SELECT doc_id, i, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS before FROM spans),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
                string_agg(substr(h, 2 * before - 1, 2 * (a - before)), '' ORDER BY a) AS head
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN head IS NULL THEN h ELSE head || substr(h, 2 * tail - 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

# Within one edit is spelled out on characters, as the other engine's edit distance counts bytes.
ORACLES["op10_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(range(0, len(l))) AS i, unnest(l) AS t FROM d),
filled AS (SELECT t, min((doc_id, i)) AS first_at FROM lines WHERE regexp_matches(t, '[^\x20\x09-\x0D]') GROUP BY t),
judged AS (SELECT * FROM filled WHERE length(t) >= 20),
keys AS (SELECT t, first_at, n, unnest(['p' || left(t, n // 2), 's' || right(t, n // 2)]) AS k
         FROM (SELECT t, first_at, unnest([length(t), length(t) - 1]) AS n FROM judged)),
near AS (SELECT DISTINCT y.t FROM keys x JOIN keys y ON x.n = y.n AND x.k = y.k AND x.t <> y.t AND x.first_at < y.first_at
         WHERE abs(length(x.t) - length(y.t)) <= 1 AND (
           length(x.t) = length(y.t) AND list_sum([CASE WHEN a[1] <> a[2] THEN 1 ELSE 0 END
             FOR a IN list_zip(string_split(x.t, ''), string_split(y.t, ''))]) <= 1
           OR length(x.t) + 1 = length(y.t) AND len([j FOR j IN range(1, length(y.t) + 1)
             IF left(y.t, j - 1) || substr(y.t, j + 1) = x.t]) > 0
           OR length(y.t) + 1 = length(x.t) AND len([j FOR j IN range(1, length(x.t) + 1)
             IF left(x.t, j - 1) || substr(x.t, j + 1) = y.t]) > 0)),
kept AS (SELECT doc_id, string_agg(t, chr(10) ORDER BY i) AS k, count(*) AS n FROM lines LEFT JOIN filled USING (t)
         WHERE first_at IS NULL OR ((doc_id, i) = first_at AND t NOT IN (SELECT t FROM near)) GROUP BY doc_id)
SELECT o.doc_id, CAST(coalesce(len(d.l), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(d.l), 0) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM documents o LEFT JOIN d USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _rounds(n: int) -> str:
    """Assignments ``a0`` .. ``a<n>`` to the centroids ``c0`` .. ``c<n>``, a component per row."""
    parts = []
    for i in range(n + 1):
        parts.append(f"""
a{i} AS (SELECT id, k, d FROM (
  SELECT id, k, d, row_number() OVER (PARTITION BY id ORDER BY d, k) AS r FROM (
    SELECT v.id, c.k, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN c{i} c USING (j) GROUP BY v.id, c.k)) WHERE r = 1)""")
        if i < n:
            parts.append(f"""
c{i + 1} AS (SELECT c.k, c.j, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
  SELECT a.k, v.j, CAST((sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
  FROM a{i} a JOIN v USING (id) GROUP BY a.k, v.j) m USING (k, j))""")
    return ",".join(parts)


ORACLES["op13_va_clusters"] = f"""
WITH v AS (SELECT vec_id AS id, unnest(range(64)) AS j, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
           FROM embeddings WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
firsts AS (SELECT id, row_number() OVER (ORDER BY sha256('1:' || id)) - 1 AS k FROM (SELECT DISTINCT id FROM v)
           QUALIFY k < 16),
c0 AS (SELECT k, j, x FROM firsts JOIN v USING (id)),{_rounds(3)}
SELECT id AS vec_id, CAST(a.k AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a3 a JOIN (SELECT k, sha256(string_agg(x, ',' ORDER BY j)) AS digest FROM c3 GROUP BY k) USING (k)
"""
