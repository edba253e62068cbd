"""DuckDB counterparts of the training-data queries that SQL can express."""

from __future__ import annotations

DOUBTFUL = r"(?i)\b(example|sample|dummy|test|version|isbn|invoice|order)\b"
_PII_KINDS = (
    (1, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 90, r"(?i)\b(e-?mail|mail|contact|write)\b", "true"),
    (
        2,
        "ip",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        60,
        r"(?i)\b(ip|host|server|address|login)\b",
        "list_max([coalesce(try_cast(x AS HUGEINT), 999) FOR x IN string_split(hit, '.')]) <= 255",
    ),
    (
        3,
        "card",
        r"[0-9]([\x20-]?[0-9])+",
        80,
        r"(?i)\b(card|visa|mastercard|credit|debit|payment)\b",
        "length(digits) BETWEEN 16 AND 19 AND list_sum([CASE WHEN i % 2 = 1 THEN CAST(reverse(digits)[i] AS INT) "
        "ELSE CAST(reverse(digits)[i] AS INT) * 2 // 10 + CAST(reverse(digits)[i] AS INT) * 2 % 10 END "
        "FOR i IN generate_series(1, length(digits))]) % 10 = 0",
    ),
    (
        4,
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        70,
        r"(?i)\b(phone|tel|telephone|call|mobile|fax)\b",
        "length(digits) BETWEEN 8 AND 15",
    ),
    (
        5,
        "iban",
        r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
        80,
        r"(?i)\b(iban|bank|account|konto)\b",
        "points >= 50 AND length(code) BETWEEN 15 AND 34 AND CAST(array_to_string([CASE WHEN ascii(c) >= 65 "
        "THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END FOR c IN string_split(code[5:] || code[1:4], '')], '') AS DOUBLE) IS NOT NULL "
        "AND list_reduce(list_prepend(0, [CASE WHEN ascii(c) >= 65 THEN 1000 + ascii(c) - 55 ELSE ascii(c) - 48 END "
        "FOR c IN string_split(code[5:] || code[1:4], '')]), lambda a, b: CASE WHEN b >= 1000 THEN (a * 100 + b - 1000) % 97 "
        "ELSE (a * 10 + b) % 97 END) = 1",
    ),
    (
        6,
        "local_phone",
        r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
        40,
        r"(?i)\b(phone|tel|telephone|call|mobile|fax)\b",
        r"points >= 50 AND NOT regexp_matches(right(before, 6), '[0-9+][\x20().-]*$')",
    ),
)


def _kind(number: int, name: str, pattern: str, prior: int, hints: str, check: str) -> str:
    return f"""
    SELECT rid, {number} AS k, '{name}' AS kind, stop - length(hit) AS start, stop, points FROM (
      SELECT *, replace(hit, ' ', '') AS code, regexp_replace(hit, '[^0-9]', '', 'g') AS digits,
        least(100, {prior} + CASE WHEN regexp_matches(near, '{hints}') THEN 20 ELSE 0 END
          - CASE WHEN regexp_matches(near, '{DOUBTFUL}') THEN 30 ELSE 0 END) AS points
      FROM (
        SELECT rid, hits[i] AS hit, pieces[i] AS before,
          right(pieces[i], 40) || ' ' || left(pieces[i + 1], 40) AS near,
          sum(length(pieces[i]) + length(hits[i])) OVER (PARTITION BY rid ORDER BY i) AS stop
        FROM (
          SELECT rid, string_split_regex(body, '{pattern}') AS pieces, regexp_extract_all(body, '{pattern}') AS hits,
            unnest(generate_series(1, len(regexp_extract_all(body, '{pattern}')))) AS i
          FROM base)))
    WHERE {check}"""


OP2 = f"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
found AS ({" UNION ALL ".join(_kind(*k) for k in _PII_KINDS)}),
per AS (
  SELECT rid,
    {", ".join(f"count(*) FILTER (k = {k[0]}) AS n_{k[1]}" for k in _PII_KINDS)},
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) FILTER (k <= 4) AS base_spans,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) AS spans,
    string_agg(kind || ':' || start || ':' || points, ',' ORDER BY k, start) AS scores
  FROM found GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k[1]}, 0) AS n_{k[1]}" for k in _PII_KINDS)},
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM base LEFT JOIN per USING (rid)"""

OP8 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to,
  true AS verified
FROM f"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '~' ELSE 's' || source END AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
s AS (
  SELECT key, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY key) - 1) % 3 + 1 AS weight FROM d GROUP BY key),
rounds AS (
  SELECT 0 AS n, sum(source_size)::BIGINT AS total, sum(source_size)::BIGINT AS rest, sum(weight)::BIGINT AS shares FROM s
  UNION ALL
  SELECT n + 1, total,
    total - (SELECT coalesce(sum(3 * source_size), 0)::BIGINT FROM s WHERE rest::DOUBLE * weight / greatest(shares, 1)::DOUBLE > 3 * source_size),
    (SELECT coalesce(sum(weight), 0)::BIGINT FROM s WHERE NOT rest::DOUBLE * weight / greatest(shares, 1)::DOUBLE > 3 * source_size)
  FROM rounds WHERE n < 60),
last AS (SELECT rest, shares FROM rounds ORDER BY n DESC LIMIT 1),
t AS (
  SELECT key, source_size, least(3.0::DOUBLE * source_size, rest::DOUBLE * weight / greatest(shares, 1)::DOUBLE) AS target FROM s, last),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN ('0x' || md5('mix-1:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT::DOUBLE / 4294967296 < rate - floor(rate)
    THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r USING (key)"""

# A line goes if a stretch of lines around it, with at least 50 words, stands earlier. The shortest such stretches suffice.
OP4 = r"""
WITH k AS (
  SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
cut AS (SELECT rid, doc_id, string_split(text, chr(10)) AS lines FROM k WHERE text IS NOT NULL),
l AS (
  SELECT rid, doc_id, i - 1 AS line, lines[i] AS content, len(regexp_extract_all(lines[i], '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT *, unnest(generate_series(1, len(lines))) AS i FROM cut)),
s AS (
  SELECT *, sum(words) OVER (PARTITION BY rid ORDER BY line) AS upto,
    row_number() OVER (PARTITION BY rid ORDER BY line) AS n FROM l WHERE words > 0),
w AS (
  SELECT a.rid, a.doc_id, a.line AS anchor, min(b.line) AS begin, max(b.line) AS last, string_agg(b.content, chr(10) ORDER BY b.line) AS body
  FROM s a JOIN s b ON a.rid = b.rid AND b.n BETWEEN a.n AND a.n + 49 AND b.upto - b.words < a.upto - a.words + 50
  GROUP BY ALL HAVING sum(b.words) >= 50
  UNION ALL
  SELECT a.rid, a.doc_id, a.line, min(b.line), max(b.line), string_agg(b.content, chr(10) ORDER BY b.line)
  FROM s a JOIN s b ON a.rid = b.rid AND b.n BETWEEN a.n - 49 AND a.n AND b.upto > a.upto - 50
  GROUP BY ALL HAVING sum(b.words) >= 50),
later AS (
  SELECT rid, unnest(generate_series(begin, last)) AS line
  FROM (SELECT *, min((doc_id, begin)) OVER (PARTITION BY md5(body)) AS first FROM w) WHERE (doc_id, begin) > first),
gone AS (SELECT DISTINCT rid, line FROM later),
kept AS (
  SELECT l.rid, string_agg(content, chr(10) ORDER BY line) FILTER (g.rid IS NULL) AS text, count(*) AS n_lines, count(g.rid) AS n_deleted
  FROM l LEFT JOIN gone g USING (rid, line) GROUP BY l.rid)
SELECT k.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
  CASE WHEN k.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM k LEFT JOIN kept USING (rid)"""

OP3 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS (
  SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.rid AS x, b.rid AS y FROM u a JOIN u b ON a.label = b.label AND a.rid <> b.rid AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(node, root) AS (SELECT rid, vec_id FROM v UNION SELECT y, root FROM reach JOIN links ON x = node),
roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
counts AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN roots ON node = rid LEFT JOIN counts ON x = rid"""

OP6 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 2 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS shingle
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 1, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
half AS (
  SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * common >= 80 * (p.size + q.size - common)),
links AS (SELECT x, y FROM half UNION ALL SELECT y, x FROM half),
reach(node, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT y, root FROM reach JOIN links ON x = node),
roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(size, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN roots ON node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM starts, (VALUES (1), (2), (3), (4), (5)) AS sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM grams WHERE k > 1 AND f >= 100
), kept AS (
  SELECT * FROM candidates AS c WHERE NOT EXISTS (
    SELECT 1 FROM candidates AS o
    WHERE o.lang = c.lang AND o.k > c.k AND o.f >= c.f AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT lang, phrase, f, unnest(range(1, k)) AS part, string_split(phrase, ' ') AS w FROM kept
), scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.f AS a, n, h.f AS l, t.f AS r, part,
    CAST(1000::HUGEINT * cuts.f * n // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts JOIN totals USING (lang)
  JOIN grams AS h ON h.lang = cuts.lang AND h.phrase = array_to_string(w[1:part], ' ')
  JOIN grams AS t ON t.lang = cuts.lang AND t.phrase = array_to_string(w[part + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, part) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000
"""

OP12 = r"""
WITH even AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), owned AS (
  SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM even
)
SELECT doc_id, keep_id, group_size, keep_id IS NULL OR coalesce(doc_id = keep_id, false) AS kept, sha256(t) AS text_sha256 FROM owned
"""
