"""The same results in DuckDB SQL, where SQL can state them."""

from __future__ import annotations

OP6 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT norm, count(*) AS group_size,
         first(doc_id ORDER BY length(text) DESC, doc_id ASC) AS keep_id
  FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)
"""

OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
l AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - 3),
                                         lambda i: array_to_string(ws[i : i + 4], ' '))) END AS shingles
  FROM w),
g AS (  -- equal sets need no comparison
  SELECT list_sort(shingles) AS shingles, min(doc_id) AS node, len(shingles) AS n FROM l GROUP BY ALL),
s AS (SELECT node, n, unnest(shingles) AS shingle FROM g),
pairs AS (
  SELECT a.node AS a, b.node AS b
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT node, node AS other FROM g WHERE n > 0
  UNION SELECT node, b FROM reach JOIN edges ON a = other),
component AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, len(l.shingles) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM l LEFT JOIN g ON g.n > 0 AND g.shingles = list_sort(l.shingles) LEFT JOIN component USING (node)
"""

OP2 = r"""
WITH t AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM t),
p AS (SELECT doc_id, i, word, lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM w),
own1 AS (SELECT doc_id, word, count(*) AS n FROM p GROUP BY ALL),
all1 AS (SELECT word, sum(n) AS n FROM own1 GROUP BY word),
own2 AS (SELECT doc_id, before, word, count(*) AS n FROM p WHERE before IS NOT NULL GROUP BY ALL),
all2 AS (SELECT before, word, sum(n) AS n FROM own2 GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS own, (SELECT count(*) FROM w) AS total FROM w GROUP BY doc_id),
c AS (
  SELECT p.doc_id, p.before, greatest(total - own, 1)::DOUBLE AS rest,
         coalesce(all2.n - own2.n, 0)::DOUBLE AS pair,
         coalesce(ctx.n - octx.n, 0)::DOUBLE AS context,
         (all1.n - own1.n)::DOUBLE AS single
  FROM p JOIN size USING (doc_id) JOIN all1 USING (word)
  JOIN own1 ON own1.doc_id = p.doc_id AND own1.word = p.word
  LEFT JOIN all2 ON all2.before = p.before AND all2.word = p.word
  LEFT JOIN own2 ON own2.doc_id = p.doc_id AND own2.before = p.before AND own2.word = p.word
  LEFT JOIN all1 ctx ON ctx.word = p.before
  LEFT JOIN own1 octx ON octx.doc_id = p.doc_id AND octx.word = p.before),
s AS (
  SELECT doc_id, (before IS NULL AND single = 0) OR (before IS NOT NULL AND pair = 0) AS backed,
         CASE WHEN pair > 0 THEN pair / context
              ELSE (CASE WHEN before IS NULL THEN 1 ELSE 0.4 END) *
                   (CASE WHEN single > 0 THEN single ELSE 0.4 END) / rest END AS score
  FROM c)
SELECT doc_id, coalesce(any_value(len(ws)), 0) AS n_words, coalesce(sum(backed::BIGINT), 0)::BIGINT AS n_backoff,
       round(avg(ln(score)), 6) AS score
FROM t LEFT JOIN s USING (doc_id) GROUP BY doc_id
"""

#: zlib's crc32, byte by byte; the table follows from the polynomial.
OP11 = r"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, step + 1 FROM bits WHERE step < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
each AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
digits AS (SELECT run, times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hex FROM each),
bytes AS (
  SELECT run, times, list_transform(range(1, length(hex), 2), lambda i: ('0x' || substring(hex, i, 2))::BIGINT) AS b
  FROM digits),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
           lambda c, x: xor(t[xor(c, x) % 256 + 1], c // 256)), 4294967295) AS h
  FROM bytes, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2)
              ELSE run END AS word, sum(times)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(times) >= 3),
holes AS (  -- each word without one of its letters
  SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b, b.n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN holes b ON a.word = b.rest
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word),
near AS (
  SELECT a AS word, count(*) AS n_near, max(n) AS most, first(b ORDER BY n DESC, encode(b)) AS best FROM pairs GROUP BY a),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * w.n THEN best END AS form,
         CASE WHEN most >= 2 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN near USING (word)),
chain AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents),
h AS (
  SELECT *, ('0x' || substring(digest, 1, 8))::BIGINT % (n + 1) AS x, ('0x' || substring(digest, 9, 8))::BIGINT % (n + 1) AS y,
         ('0x' || substring(digest, 17, 8))::BIGINT AS h3, ('0x' || substring(digest, 25, 8))::BIGINT AS h4
  FROM d),
k AS (
  SELECT *, least(x, y) AS a, greatest(x, y) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
o AS (
  SELECT *, substring(text, 1, a) AS p, substring(text, a + 1, b - a) AS m, substring(text, b + 1) AS s FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM o
"""

ORACLE = {
    "op2_lm_scoring": OP2,
    "op5_minhash_near_dedup": OP5,
    "op6_exact_dedup": OP6,
    "op11_spelling_variants": OP11,
    "op12_fill_in_middle": OP12,
}
