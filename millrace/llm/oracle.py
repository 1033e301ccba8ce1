"""The operators that SQL can express, stated from their meaning: every window, shingle and prefix written out.

None of this is how the operators work; it is quadratic or worse where they are not, and meant
for small tables.
"""

from __future__ import annotations

WORDS = r"'[^\x20\x09-\x0D]+'"

#: Bytes as hexadecimal digits, in blocks of 500 with the 399 that follow, so that a string starts near the start of its block.
OP2 = """
WITH coded AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents),
blocks AS (
    SELECT doc_id, b, substr(digits, 1000 * b + 1, 1798) AS part
    FROM (SELECT doc_id, digits, unnest(range((len(digits) + 999) // 1000)) AS b FROM coded)),
bytes AS (
    SELECT doc_id, 500 * b + j AS pos, substr(part, 2 * j + 1, 2) AS digits,
           CASE WHEN len(part) >= 2 * j + 800 THEN sha256(substr(part, 2 * j + 1, 800)) END AS string
    FROM (SELECT doc_id, b, part, unnest(range(least(500, len(part) // 2))) AS j FROM blocks)),
repeated AS (
    SELECT string FROM bytes WHERE string IS NOT NULL GROUP BY string HAVING count(*) > 1),
marked AS (
    SELECT doc_id, pos, digits,
           coalesce(max(CASE WHEN r.string IS NOT NULL THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos) > pos - 400, false) AS gone
    FROM bytes LEFT JOIN repeated r USING (string)),
runs AS (
    SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY pos) AS opens FROM marked),
spoilt AS (
    SELECT doc_id, count_if(gone) AS n_removed, count_if(opens) AS n_spans,
           string_agg(digits, '' ORDER BY pos) FILTER (NOT gone) AS kept
    FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(len(c.digits) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM coded c LEFT JOIN spoilt USING (doc_id)"""

OP4 = f"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
words AS (
    SELECT doc_id, pos, w[pos] AS word, CASE WHEN pos + 49 <= len(w) THEN sha256(array_to_string(w[pos:pos + 49], ' ')) END AS passage
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM texts)),
holders AS (
    SELECT passage, min(doc_id) AS holder FROM words WHERE passage IS NOT NULL GROUP BY passage),
marked AS (
    SELECT doc_id, pos, word,
           coalesce(max(CASE WHEN holder < doc_id THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos) > pos - 50, false) AS gone
    FROM words LEFT JOIN holders USING (passage)),
left_over AS (
    SELECT doc_id, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM marked GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN left_over USING (doc_id)"""

OP10 = f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[pos:pos + 2], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS pos FROM texts WHERE len(w) > 0)),
sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
    WHERE 100 * least(p.n, q.n) >= 90 * greatest(p.n, q.n)
    GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))),
reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT x AS doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(y) AS component_id
FROM reached LEFT JOIN sizes ON sizes.doc_id = x GROUP BY x"""

#: CRC-32 has no function here: its table follows from the polynomial 3988292384 (0xEDB88320).
OP12 = """
WITH crc AS (
    SELECT [list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
            FOR n IN range(256)] AS entries),
named AS (
    SELECT conv_id, [ascii(x) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')] AS codes
    FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (
    SELECT conv_id, conv_id - conv_id % 5 AS family,
           xor(list_reduce(list_prepend(4294967295, codes), lambda c, b: xor(entries[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 9 AS h
    FROM named, crc),
turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
    SELECT h.conv_id, 0 AS half, i, role, text FROM heads h JOIN turns t ON t.conv_id = h.family AND t.i <= h.h
    UNION ALL
    SELECT h.conv_id, 1, i, role, text FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.i > h.h),
sequences AS (
    SELECT conv_id, count(i) AS n, list(sha256(strlen(role) || ':' || role || text) ORDER BY half, i) FILTER (i IS NOT NULL) AS path,
           list(strlen(text) ORDER BY half, i) FILTER (i IS NOT NULL) AS n_bytes
    FROM heads LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
members AS (
    SELECT conv_id, n, d, CASE WHEN d = 0 THEN '' ELSE sha256(array_to_string(path[1:d], '')) END AS node,
           CASE WHEN d = 1 THEN '' WHEN d > 1 THEN sha256(array_to_string(path[1:d - 1], '')) END AS parent,
           CASE WHEN d = 0 THEN 0 ELSE n_bytes[d] END AS bytes
    FROM (SELECT *, unnest(range(n + 1)) AS d FROM sequences)),
nodes AS (
    SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = n), '')) AS ends_sha256
    FROM members GROUP BY node, d),
children AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes GROUP BY parent),
subtrees AS (
    SELECT a.node, sum(saved) AS saved_tokens, count_if(c.node IS NULL) AS n_leaves
    FROM nodes b JOIN members a ON a.conv_id = b.conv_id AND a.d <= b.d LEFT JOIN children c ON c.node = b.node
    GROUP BY a.node)
SELECT CAST(x.conv_id AS BIGINT) AS conv_id, CAST(x.d AS BIGINT) AS depth, CAST(p.conv_id AS BIGINT) AS parent_conv_id,
       CAST(x.n_convs AS BIGINT) AS n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
FROM nodes x LEFT JOIN nodes p ON p.node = x.parent LEFT JOIN children c ON c.node = x.node JOIN subtrees s ON s.node = x.node"""

SQL = {"op2_suffix_dedup": OP2, "op4_substring_dedup": OP4, "op10_jaccard_join": OP10, "op12_prefix_trie": OP12}
