"""DuckDB SQL for the queries whose operators SQL can express, written from the contracts alone."""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, s, list_slice(w, s, s + 19) AS seq
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS s FROM d) x),
repeated AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) AS k FROM windows) r WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM repeated) g),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(cut.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)
"""

OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(""" + LOWERED + r""", '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, list_slice(w, s, s + 3) AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM d WHERE len(w) > 0) x),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
both_in AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM both_in JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * k >= 80 * (a.n + b.n - k)),
sym AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, s.y FROM reach r JOIN sym s ON s.x = r.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, comp.component_id, d.doc_id = comp.component_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN comp USING (doc_id)
"""

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(""" + LOWERED + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(""" + LOWERED + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, s, s + 12) AS seq
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM items WHERE len(w) > 0) x),
hits AS (
  SELECT p.doc_id, p.s, p.n, i.item_id
  FROM (SELECT doc_id, n, s, list_slice(w, s, s + n - 1) AS seq
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
              FROM d, (SELECT DISTINCT n FROM item_windows) l WHERE len(w) >= n) x) p
  JOIN item_windows i ON i.n = p.n AND i.seq = p.seq),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) c GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) f GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n, 0) AS BIGINT) AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

#: States of a repair: 0 nothing read, 1 system, 2 user, 3 assistant. ``crc32`` is computed by its table, as DuckDB has none.
OP12_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                        lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
  FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, text,
         xor(4294967295, list_reduce(list_concat([4294967295], bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM keyed, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, (VALUES (1), (2)) copy(k) WHERE kind <> 0 AND (k = 1 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM damaged),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'duplicate'
                 WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
                 ELSE 'none' END AS fault,
         left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY rn) AS before
  FROM placed),
numbers AS (
  SELECT conv_id, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (rn > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(rn) AS n
  FROM faulty GROUP BY conv_id),
inserted(s, k, mid, letters, lines) AS (
  SELECT s, 0, s, '', '' FROM (VALUES (0), (1), (2), (3)) v(s)
  UNION ALL SELECT s, 1, CASE s WHEN 2 THEN 3 ELSE 2 END, 'I', CASE s WHEN 2 THEN E'assistant:\n' ELSE E'user:\n' END
            FROM (VALUES (0), (1), (2), (3)) v(s)
  UNION ALL SELECT s, 2, CASE s WHEN 2 THEN 2 ELSE 3 END, 'II',
                   CASE s WHEN 2 THEN E'assistant:\nuser:\n' ELSE E'user:\nassistant:\n' END FROM (VALUES (0), (1), (2), (3)) v(s)),
edits AS (
  SELECT f.conv_id, f.rn, i.s, e.op, i.letters || e.op AS letters,
         CASE e.op WHEN 'D' THEN i.mid WHEN 'R' THEN CASE i.mid WHEN 2 THEN 3 ELSE 2 END
                   ELSE CASE f.c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS t,
         2 * i.k + CASE e.op WHEN 'D' THEN 3 ELSE CASE e.op WHEN 'R' THEN 2 ELSE 0 END + CASE fault WHEN 'truncated' THEN 1 ELSE 0 END END AS cost,
         i.lines || CASE e.op WHEN 'D' THEN '' WHEN 'R' THEN CASE i.mid WHEN 2 THEN 'assistant:' ELSE 'user:' END || f.text || E'\n'
                    ELSE f.role || ':' || f.text || E'\n' END AS lines
  FROM faulty f, inserted i, (VALUES ('D'), ('R'), ('K')) e(op)
  WHERE e.op = 'D' OR (fault NOT IN ('blank', 'duplicate')
        AND (e.op = 'R' OR (f.c = 's' AND i.mid = 0) OR (f.c = 'u' AND i.mid IN (0, 1, 3)) OR (f.c = 'a' AND i.mid = 2)))),
steps(conv_id, rn, s, cost, audit, lines) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, 0, '', '' FROM numbers
  UNION ALL
  SELECT conv_id, rn, t, cost, audit, lines
  FROM (SELECT e.conv_id, e.rn, e.t, p.cost + e.cost AS cost, p.audit || e.letters AS audit, p.lines || e.lines AS lines,
               row_number() OVER (PARTITION BY e.conv_id, e.rn, e.t ORDER BY p.cost + e.cost, p.audit || e.letters) AS k
        FROM steps p JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.rn = p.rn + 1 AND e.s = p.s) x
  WHERE k = 1),
ends AS (
  SELECT p.conv_id, p.cost + len(c.letters) * 2 AS cost, p.audit || c.letters AS audit, p.lines || c.lines AS lines,
         row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + len(c.letters) * 2, p.audit || c.letters) AS k
  FROM steps p JOIN numbers m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.n = p.rn
  JOIN (VALUES (0, '', ''), (1, 'II', E'user:\nassistant:\n'), (2, 'I', E'assistant:\n'), (3, '', '')) c(s, letters, lines) ON c.s = p.s)
SELECT o.conv_id, CAST(coalesce(m.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(m.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(m.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(m.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(m.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(e.cost, 0) AS BIGINT) AS cost, coalesce(e.audit, '') AS audit,
       sha256(CASE WHEN coalesce(e.lines, '') = '' THEN '' ELSE left(e.lines, length(e.lines) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN numbers m ON m.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id AND e.k = 1
"""
