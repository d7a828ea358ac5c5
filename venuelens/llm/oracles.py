"""DuckDB statements of the queries that SQL can express, over the registered table views."""

from __future__ import annotations

from .lexical_search import LOWER, TERM, UPPER

# op11: every (item, document) score summed from joined terms; ranks by window.
LEXICAL_SEARCH = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS terms FROM documents
), sized AS (
  SELECT row_number() OVER () AS place, doc_id, terms, len(terms) AS n FROM doc WHERE len(terms) > 0
), collection AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sized
), tf AS (
  SELECT place, doc_id, n, term, count(*) AS tf FROM (SELECT place, doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark
), weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), collection
), scored AS (
  SELECT item_id, place, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term), collection
  GROUP BY item_id, place, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# op12: prefixes as the joined digests of their turns, ancestors as all their cuts; crc32 bit by bit.
PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) - 1 AS i, k, b FROM (
    SELECT conv_id, turn, strlen(coalesce(text, '')) AS b,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
    FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT c, c - c % 5 AS g, CASE WHEN c % 5 = 0 THEN 0 ELSE xor(list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [1000 + ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0]))),
    lambda acc, x: CASE WHEN x >= 1000 THEN xor(acc, x - 1000) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END), 4294967295) % 9 END AS h
  FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, i) AS d, k, b FROM (
    SELECT convs.c, 0 AS own, i, k, b FROM convs JOIN turns ON turns.c = g WHERE i < h
    UNION ALL SELECT c, 1, i, k, b FROM turns JOIN convs USING (c) WHERE i >= h)
), paths AS (
  SELECT c, d, b, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS key FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs
), ends AS (
  SELECT key, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
  FROM (SELECT c, arg_max(key, d) AS key FROM paths GROUP BY c) GROUP BY key
), nodes AS (
  SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, max(b) AS b, left(key, greatest(64 * d - 64, 0)) AS up FROM paths GROUP BY key, d
), children AS (
  SELECT up AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY up
), subtree AS (
  SELECT left(key, 64 * a) AS key, sum(CASE WHEN n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * b) AS saved
  FROM (SELECT nodes.*, n, unnest(range(0, d + 1)) AS a FROM nodes LEFT JOIN children USING (key)) GROUP BY 1
)
SELECT v.conv_id, v.d AS depth, CASE WHEN v.d > 0 THEN u.conv_id END AS parent_conv_id, v.n_convs, coalesce(children.n, 0) AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes v JOIN nodes u ON u.key = v.up AND u.d = greatest(v.d - 1, 0) JOIN subtree ON subtree.key = v.key
LEFT JOIN children ON children.key = v.key LEFT JOIN ends ON ends.key = v.key
"""

# op13: SHA-1 in base32, five hexadecimal digits (20 bits) to four letters.
WARC = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), kept AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS keeper FROM hashed
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, (i // 4 * 5 + 1)::INTEGER, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN keeper IS DISTINCT FROM page_id AND keeper IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper IS DISTINCT FROM page_id THEN keeper END AS refers_to
FROM kept
"""

# The columns of op2, op6, op9 and op10 that SQL can follow, under keys of their own.
LICENSE_BASE = """
WITH doc AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), word AS (
  SELECT place, unnest(w) AS a, generate_subscripts(w, 1) - 1 AS i FROM doc
), four AS (
  SELECT place, i, a, lead(a) OVER s AS b, lead(a, 2) OVER s AS c, lead(a, 3) OVER s AS d FROM word WINDOW s AS (PARTITION BY place ORDER BY i)
), found AS (
  SELECT place, i, CASE WHEN a = 'gnu' AND b = 'general' AND c = 'public' AND d = 'license' THEN 'gpl' WHEN a = 'apache' AND b = 'license' THEN 'apache'
                        WHEN a = 'cc' AND b = 'by' THEN 'cc-by' WHEN a = 'mit' AND b = 'license' THEN 'mit' END AS label FROM four
), base AS (
  SELECT place, count(*) AS n, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM found WHERE label IS NOT NULL GROUP BY place
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(labels, '') AS base_labels
FROM doc LEFT JOIN base USING (place)
"""

EDITED_TEXTS = """
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, lead(coalesce(text, '')) OVER s AS after, first_value(coalesce(text, '')) OVER s AS head
  FROM documents WINDOW s AS (ORDER BY doc_id DESC NULLS LAST)
)
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(left(t, length(t) - length(t) // 2) || left(coalesce(after, head), length(t) // 2)) AS edited_sha256 FROM doc
"""

QUALITY_BASE = """
WITH doc AS (
  SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), line AS (
  SELECT place, count(*) - count(DISTINCT l) AS n FROM (SELECT place, unnest(string_split(t, chr(10))) AS l FROM doc)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY place
), word AS (
  SELECT place, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM doc
), three AS (
  SELECT place, i, [a, lead(a) OVER s, lead(a, 2) OVER s] AS g, lead(a, 2) OVER s IS NOT NULL AS whole FROM word WINDOW s AS (PARTITION BY place ORDER BY i)
), again AS (
  SELECT place, i FROM (SELECT place, i, count(*) OVER (PARTITION BY place, g) AS n FROM three WHERE whole) WHERE n > 1
), covered AS (
  SELECT place, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) step(k) GROUP BY place
)
SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
       (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(line.n, 0)::BIGINT AS n_dup_lines,
       coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(w) < 50 OR 100 * coalesce(covered.n, 0) > 50 * len(w) AS base_failed
FROM doc LEFT JOIN line USING (place) LEFT JOIN covered USING (place)
"""

MIXTURE_SIZES = """
WITH doc AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents)
SELECT doc_id, size, sum(size) OVER (PARTITION BY source)::BIGINT AS source_size FROM doc
"""
