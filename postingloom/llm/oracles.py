"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import math

from postingloom.llm import license_scan
from postingloom.llm.parameters import LICENCES

_WORD = r"[^\x20\x09-\x0D]+"
_BLANKS = r"[\x20\x09-\x0D]+"

_QUALITY = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), texts AS (
  SELECT *, regexp_extract_all(t, '{_WORD}') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM docs
), grams AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM texts)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM repeated, range(5) AS o(k) GROUP BY r
), line_rows AS (
  SELECT r, source, t, trim(translate(regexp_replace(l, '{_BLANKS}', ' ', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS line
  FROM (SELECT r, source, t, unnest(ls) AS l FROM texts)
), per_line AS (
  SELECT source, line, count(DISTINCT t) AS n FROM line_rows GROUP BY source, line
), per_host AS (
  SELECT source, count(DISTINCT t) AS n FROM docs GROUP BY source
), frequent AS (
  SELECT l.source, l.line FROM per_line l JOIN per_host h ON l.source IS NOT DISTINCT FROM h.source
  WHERE l.n > 10 AND 100 * l.n > 5 * h.n
), gone AS (
  SELECT r, sum(len(string_split(x.line, ' '))) AS n
  FROM line_rows x JOIN frequent f ON x.line = f.line AND x.source IS NOT DISTINCT FROM f.source GROUP BY r
), measured AS (
  SELECT t.r, t.doc_id, len(w) AS n_words, length(regexp_replace(t, '{_BLANKS}', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, len(w) - coalesce(g.n, 0) AS n_kept_words
  FROM texts t LEFT JOIN covered c USING (r) LEFT JOIN gone g USING (r)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND n_kept_words >= 10 AND 100 * n_kept_words >= 30 * n_words AS kept,
  CAST(n_kept_words AS BIGINT) AS n_kept_words
FROM measured
"""

_LINES = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, text,
    row(coalesce(doc_id, 9223372036854775807), substr(md5(coalesce(text, '')), 1, 15)) AS id,
    string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT r, id, i, regexp_replace(ls[i], '^{_BLANKS}|{_BLANKS}$', '', 'g') AS line
  FROM (SELECT r, id, ls, unnest(range(1, len(ls) + 1)) AS i FROM docs)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY i) AS p FROM lines WHERE line <> ''
), windows AS (
  SELECT r, id, p, line || chr(10) || lead(line, 1) OVER o || chr(10) || lead(line, 2) OVER o AS w
  FROM placed WINDOW o AS (PARTITION BY r ORDER BY p)
), ranked AS (
  SELECT *, id = min(id) OVER (PARTITION BY w) AS first, min(p) OVER (PARTITION BY w, r) AS first_p
  FROM windows WHERE w IS NOT NULL
), covered AS (
  SELECT DISTINCT r, p + k AS p FROM ranked, range(3) AS o(k)
  WHERE NOT first OR (p > first_p AND p + k >= first_p + 3)
), gone AS (
  SELECT c.r, list(i) AS taken_out, count(*) AS n FROM covered c JOIN placed USING (r, p) GROUP BY c.r
)
SELECT doc_id, CASE WHEN n IS NULL THEN text ELSE
    array_to_string(list_transform(list_filter(range(1, len(ls) + 1), lambda i: NOT list_contains(taken_out, i)), lambda i: ls[i]), chr(10))
  END AS text, CAST(coalesce(n, 0) AS BIGINT) AS n_removed
FROM docs LEFT JOIN gone USING (r)
"""

_MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size, text FROM documents
), sources AS (
  SELECT source, sum(size) AS s FROM sized GROUP BY source
), weighted AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sources
), turns AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM weighted
), tried AS (
  SELECT *, CAST(150 * sum(s) OVER () - 200 * coalesce(sum(s) OVER earlier, 0) AS DOUBLE)
      / CAST(100 * (sum(w) OVER () - coalesce(sum(w) OVER earlier, 0)) AS DOUBLE) * w >= 2 * s AS capped
  FROM turns
  WINDOW earlier AS (ORDER BY CAST(s AS DOUBLE) / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, s, CASE WHEN capped THEN CAST(2 * s AS DOUBLE) ELSE
      CAST(150 * sum(s) OVER () - 200 * sum(CASE WHEN capped THEN s ELSE 0 END) OVER () AS DOUBLE)
      / CAST(nullif(100 * (sum(w) OVER () - sum(CASE WHEN capped THEN w ELSE 0 END) OVER ()), 0) AS DOUBLE) * w
    END AS target
  FROM tried
), rates AS (
  SELECT *, CASE WHEN s > 0 THEN target / CAST(s AS DOUBLE) ELSE 0.0 END AS rate,
    CAST(('0x' || substr(md5('mix' || coalesce(source, '')), 1, 8)) AS BIGINT) / 4294967296.0 AS o
  FROM targets
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY
    length(CAST(size AS VARCHAR)) * 100 + CAST(substr(CAST(size AS VARCHAR), 1, 2) AS INTEGER),
    substr(md5(CAST(doc_id AS VARCHAR)), 1, 2), size, doc_id) AS k
  FROM sized
), counted AS (
  SELECT doc_id, size, s, target, floor(rate) + floor(CAST(o AS DOUBLE) + k * (rate - floor(rate)))
    - floor(CAST(o AS DOUBLE) + (k - 1) * (rate - floor(rate))) AS copies
  FROM placed p JOIN rates r ON p.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(s AS BIGINT) AS source_size, target,
  CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies
FROM counted
"""


_CHAT = r"""
WITH messages AS (
  SELECT DISTINCT conv_id, coalesce(turn, 9223372036854775807) AS turn, coalesce(role, 'unknown') AS role,
    coalesce(text, '') AS text FROM conversations
), speakers AS (
  SELECT DISTINCT conv_id, role AS perspective FROM messages WHERE role <> 'system'
), lines AS (
  SELECT m.conv_id, s.perspective, m.turn, m.role = s.perspective AS own,
    '<|im_start|>' || CASE WHEN m.role = s.perspective THEN 'assistant' WHEN m.role = 'system' THEN 'system'
      ELSE 'user name=' || m.role END || chr(10) AS head, m.text || '<|im_end|>' || chr(10) AS body
  FROM messages m JOIN speakers s ON m.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective ORDER BY turn) AS until FROM lines
)
SELECT conv_id, perspective, CAST(0 AS BIGINT) AS part, count(*) AS n_turns,
  string_agg(head || body, '' ORDER BY turn) AS rendered,
  coalesce(string_agg(CAST(until - length(body) AS BIGINT) || ':' || CAST(until AS BIGINT), ',' ORDER BY turn)
    FILTER (WHERE own), '') AS trained
FROM placed GROUP BY conv_id, perspective
"""

_EMBEDDINGS = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
    coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS usable
  FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND a.usable AND b.usable
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM vectors
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT vec_id, CAST((SELECT count(*) FROM links WHERE a = vec_id) AS BIGINT) AS n_links,
  (SELECT min(b) FROM reached WHERE a = vec_id) AS component_id,
  vec_id = (SELECT min(b) FROM reached WHERE a = vec_id) AS kept
FROM vectors
"""

_WARC = r"""
WITH made AS (
  SELECT page_id, url, coalesce(html, '') AS html,
    CAST(('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '')), 1, 8)) AS BIGINT)
      % (SELECT greatest(1, CAST(ceil(count(*) / 256.0) AS BIGINT)) FROM pages) AS file,
    CAST(('0x' || substr(md5('altered' || page_id), 1, 8)) AS BIGINT) % 97 = 0 AS altered,
    CAST(('0x' || substr(md5('missing' || page_id), 1, 8)) AS BIGINT) % 101 = 0 AS missing
  FROM pages
), measured AS (
  SELECT *, strlen('WARC/1.1' || 'WARC-Type: response' || 'WARC-Target-URI: ' || coalesce(url, '')
      || 'WARC-Date: 2026-01-01T00:00:00Z' || 'Content-Type: text/html; charset=utf-8'
      || 'Content-Length: ' || strlen(html)) + 14 + strlen(html) + 4 AS length
  FROM made
), placed AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id, url
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins FROM measured
)
SELECT file, CAST(begins AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length,
  CASE WHEN missing THEN 'missing' ELSE 'altered' END AS kind
FROM placed WHERE missing OR (altered AND html <> '' AND substr(html, 1, 1) <> '~')
"""


_MANIFEST = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents
), crcs AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(unicode(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda s, e: xor(xor(s, e) >> 1, 3988292384 * (xor(s, e) % 2))), 4294967295) AS crc FROM docs
), leaves AS (
  SELECT r, doc_id, source,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) AS shown
  FROM (SELECT *, CASE WHEN crc % 5 = 0 THEN low ELSE text END AS shown,
      coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
    FROM crcs)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), levels AS (
  SELECT source, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY source
  UNION ALL
  SELECT source, level + 1,
    list_transform(range(0, len(nodes), 16), lambda i: sha256(array_to_string(nodes[i + 1:i + 16], ''))) FROM levels WHERE len(nodes) > 1
), subroots AS (
  SELECT source, level, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS source_place
  FROM levels WHERE len(nodes) = 1
), tops AS (
  SELECT 0 AS level, list(subroot ORDER BY source_place) AS nodes FROM subroots HAVING count(*) > 0
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 16), lambda i: sha256(array_to_string(nodes[i + 1:i + 16], ''))) FROM tops WHERE len(nodes) > 1
), steps AS (
  SELECT r, l.level AS step, nodes, CAST(place // CAST(pow(16, l.level) AS BIGINT) AS BIGINT) AS pos
  FROM placed p JOIN levels l ON p.source IS NOT DISTINCT FROM l.source WHERE len(nodes) > 1
  UNION ALL
  SELECT r, s.level + t.level, nodes, CAST(source_place // CAST(pow(16, t.level) AS BIGINT) AS BIGINT)
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source CROSS JOIN tops t WHERE len(nodes) > 1
), cut AS (
  SELECT r, step, array_to_string(nodes[pos // 16 * 16 + 1:pos], '') AS before, array_to_string(nodes[pos + 2:pos // 16 * 16 + 16], '') AS after FROM steps
), proofs AS (
  SELECT r, sha256(string_agg(before || after, '' ORDER BY step)) AS proof FROM cut GROUP BY r
), folded AS (
  SELECT r, CAST(0 AS BIGINT) AS step, shown AS digest FROM placed
  UNION ALL
  SELECT f.r, f.step + 1, sha256(before || digest || after) FROM folded f JOIN cut c ON f.r = c.r AND f.step = c.step
), ends AS (
  SELECT r, arg_max(digest, step) AS digest FROM folded GROUP BY r
), root AS (
  SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1
)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, digest AS folded_root, digest = root AS verified
FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source JOIN ends USING (r) LEFT JOIN proofs USING (r) CROSS JOIN root
"""


_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), words AS (
  SELECT r, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), counts AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source
), groups AS (
  SELECT g.lang, g.source, coalesce(s.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes s USING (lang, source)
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (CAST(g.n AS HUGEINT) + 2 * l.v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (k.total + 2) // (CAST(l.n AS HUGEINT) + 2 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def _licences() -> str:
    """Every place of every template compared; no choice of rare words."""

    def listed(rows: list[tuple]) -> str:
        return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)

    templates = list(enumerate(license_scan.TEMPLATES))
    share, drift = LICENCES["share"], LICENCES["drift"]
    sizes = listed([(k, t.label, len(t.passage.split()), math.ceil(share * len(t.passage.split()))) for k, t in templates])
    postings = listed([(word, k, q) for k, t in templates for q, word in enumerate(t.passage.split())])
    asked = listed([(k, phrase) for k, t in templates for phrase in t.phrases])
    bases = listed(list(license_scan.PHRASES.items()))
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), words AS (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS pos FROM docs
), sizes(t, label, length, needed) AS (VALUES {sizes}
), postings(word, t, q) AS (VALUES {postings}
), asked(t, phrase) AS (VALUES {asked}
), bases(phrase, label) AS (VALUES {bases}
), wanted AS (
  SELECT phrase, string_split(phrase, ' ') AS p FROM (SELECT phrase FROM asked UNION SELECT phrase FROM bases)
), stands AS (
  SELECT s.r, phrase, len(p) AS n, s.pos FROM wanted JOIN words s ON s.word = p[1] JOIN docs d ON d.r = s.r
  WHERE d.w[s.pos + 1:s.pos + len(p)] = p
), tallied AS (
  SELECT r, t, pos - q + d AS at, count(DISTINCT q) AS n
  FROM words JOIN postings USING (word), range(-{drift}, {drift + 1}) AS o(d) GROUP BY ALL
), found AS (
  SELECT r, label, n / length AS share FROM tallied x JOIN sizes z USING (t)
  WHERE n >= needed AND NOT EXISTS (SELECT 1 FROM asked a WHERE a.t = x.t AND NOT EXISTS (
    SELECT 1 FROM stands s WHERE s.r = x.r AND s.phrase = a.phrase AND s.pos >= x.at - {drift} AND s.pos + s.n <= x.at + length + {drift}))
), per_base AS (
  SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels
  FROM stands JOIN bases USING (phrase) GROUP BY r
), per_found AS (
  SELECT r, list(DISTINCT label) AS labels, max(share) AS share FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(coalesce(b.labels, []) || coalesce(f.labels, []))), ',') AS labels,
  CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(share, 0) END AS DOUBLE) AS score
FROM docs LEFT JOIN per_base b USING (r) LEFT JOIN per_found f USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": _LINES,
        "op4_quality_rules": _QUALITY,
        "op6_chat_format": _CHAT,
        "op7_embeddings": _EMBEDDINGS,
        "op8_warc_audit": _WARC,
        "op10_source_mix": _MIX,
        "op11_merkle_manifest": _MANIFEST,
        "op12_source_divergence": _DIVERGENCE,
        "op13_license_scan": _licences(),
    }
