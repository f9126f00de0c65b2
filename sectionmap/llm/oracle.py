"""DuckDB SQL for the queries that SQL can express."""

SQL = {
    "op3_decontaminate": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
il AS (SELECT item_id, w, least(len(w), 10) AS n FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, w[i:i + n - 1] AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM il)),
size AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, n, i, w[i:i + n - 1] AS g
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, size WHERE len(w) >= n)),
occ AS (SELECT doc_id, item_id, g.n, i FROM grams g JOIN win USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op4_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marks AS (
  SELECT *, len(text) + len(text) - len(replace(text, '\', ''))
    + list_sum(list_transform(['<<SYS>>', '[INST]', '[/INST]', '[ROLE]', '[/ROLE]', '</s>'],
                              lambda c: (len(text) - len(replace(text, c, ''))) // len(c))) AS escaped,
    CASE role WHEN 'system' THEN 7 WHEN 'user' THEN 6 WHEN 'assistant' THEN 7 ELSE 13 + len(role) END AS opening,
    coalesce(lag(role) OVER t, 'start') || '>' || role IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') AS legal,
    row_number() OVER t AS place
  FROM turns WINDOW t AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(escaped + opening + 4) AS BIGINT) AS formatted_chars,
       bool_and(legal) AND arg_max(role, place) = 'assistant' AS valid,
       coalesce(count(*) + 1 - min(place) FILTER (NOT legal), 0) AS n_rejected
FROM marks GROUP BY conv_id""",
    "op6_suffix_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, j, substr(h, 2 * j + 1, 2 * (250 + 49)) AS h
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49, 250)) AS j FROM d WHERE len(h) >= 100)),
s AS (SELECT doc_id, j + i AS i, substr(h, 2 * i + 1, 100) AS g
      FROM (SELECT doc_id, j, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM p)),
f AS (SELECT g, min(doc_id) AS first FROM s GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
r AS (SELECT doc_id, i FROM s JOIN f USING (g) WHERE first < doc_id),
m AS (SELECT doc_id, i, sum(CASE WHEN i <= p + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k
      FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM r)),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM m GROUP BY 1, 2),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
         UNION ALL SELECT doc_id, max(b), 1000000000 FROM spans GROUP BY 1),
kept AS (SELECT doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS h
         FROM gaps JOIN d USING (doc_id) GROUP BY 1),
n AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY 1)
SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op7_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (SELECT key FROM keyed WHERE len(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, CAST(count(often.key) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (often.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often ON keyed.key = often.key GROUP BY doc_id""",
}
