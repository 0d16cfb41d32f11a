"""DuckDB SQL for the corpus queries that SQL can express.

Each statement is written from the contract, not from the Spark code: windows
and strings where the operators use hashes, bytes or votes.
"""

from __future__ import annotations

from adfuse.llm.license_scan import BAND, COVER, NEAR, TEMPLATES
from adfuse.llm.tables import UPPER

_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"

# CRC-32 (reflected polynomial 0xEDB88320), its table built by rule.
_CRC = """
  crc_step(i, k, v) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL
    SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM crc_step WHERE k < 8
  ),
  crc AS (SELECT list(v ORDER BY i) AS t FROM crc_step WHERE k = 8)"""

SQL: dict[str, str] = {}

SQL["op10_byte_shards"] = f"""
WITH RECURSIVE {_CRC},
  texts AS (SELECT DISTINCT coalesce(text, '') AS t FROM documents),
  sums AS (
    SELECT texts.t, xor(4294967295, list_reduce(
      list_transform(range(strlen(texts.t)), lambda b: CAST(('0x' || substr(hex(encode(texts.t)), CAST(2 * b + 1 AS INT), 2)) AS BIGINT)),
      lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]), 4294967295)) AS text_crc32
    FROM texts, crc
  ),
  ordered AS (
    SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, '')) + 1 AS size, md5(coalesce(text, '')) AS g,
           row_number() OVER (ORDER BY md5(coalesce(text, '')), doc_id NULLS FIRST) - 1 AS r
    FROM documents
  ),
  run AS (SELECT *, CAST(sum(size) OVER (ORDER BY r) - size AS BIGINT) AS pre, CAST(sum(size) OVER () AS BIGINT) AS total FROM ordered),
  grp AS (SELECT g, min(pre) AS lo, max(pre + size) AS hi, any_value(total) AS total FROM run GROUP BY g),
  goal AS (SELECT k, (SELECT any_value(total) FROM run) * k // 16 AS goal FROM range(1, 16) AS x(k)),
  edges AS (
    SELECT lo AS e FROM grp JOIN goal ON lo <= goal AND goal < hi
    UNION SELECT hi FROM grp JOIN goal ON lo <= goal AND goal < hi
  ),
  near AS (SELECT k, goal, arg_min(e, (abs(e - goal), e)) AS e FROM goal, edges GROUP BY k, goal),
  cuts AS (
    SELECT CASE WHEN abs(e - goal) <= 0.02 * (SELECT any_value(total) FROM run) / 16 THEN e ELSE goal END AS cut FROM near
  ),
  placed AS (SELECT run.*, (SELECT count(*) FROM cuts WHERE 2 * pre + size >= 2 * cut) AS s FROM run)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, CAST(s AS INTEGER) AS shard,
       r - min(r) OVER (PARTITION BY s) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed JOIN sums USING (t)
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TEMPLATES = ", ".join(
    f"({i}, '{t.label}', '{t.family}', {str(t.exact).lower()}, '{t.text.lower()}')" for i, t in enumerate(TEMPLATES)
)

SQL["op2_license_scan"] = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents
  ),
  grams AS (SELECT r, p, w[p+1] || ' ' || w[p+2] || ' ' || w[p+3] AS g FROM (SELECT r, w, unnest(range(len(w) - 2)) AS p FROM docs)),
  templates AS (SELECT tid, label, family, exact, regexp_extract_all(t, '{_ALNUM}') AS w FROM (VALUES {_TEMPLATES}) AS x(tid, label, family, exact, t)),
  tgrams AS (
    SELECT tid, label, family, exact, len(w) - 2 AS n, q, w[q+1] || ' ' || w[q+2] || ' ' || w[q+3] AS g
    FROM (SELECT *, unnest(range(len(w) - 2)) AS q FROM templates)
  ),
  hits AS (SELECT r, tid, label, family, exact, n, q, p, p - q AS d FROM grams JOIN tgrams USING (g)),
  diagonals AS (SELECT DISTINCT r, tid, exact, d FROM hits),
  marked AS (
    SELECT *, d - lag(d) OVER (PARTITION BY r, tid ORDER BY d) AS gap FROM diagonals
  ),
  runs AS (
    SELECT r, tid, d, sum(CASE WHEN exact OR gap IS NULL OR gap > {BAND} THEN 1 ELSE 0 END) OVER (PARTITION BY r, tid ORDER BY d) AS run
    FROM marked
  ),
  merged AS (
    SELECT r, tid, label, family, exact, run, min(p) AS first, max(p) + 2 AS last, count(DISTINCT q) / n AS cover
    FROM hits JOIN runs USING (r, tid, d) GROUP BY r, tid, label, family, exact, run, n
  ),
  best AS (
    SELECT *, max(cover) OVER (PARTITION BY r, family, exact ORDER BY first RANGE BETWEEN {NEAR} PRECEDING AND {NEAR} FOLLOWING) AS most
    FROM merged
  ),
  verified AS (SELECT * FROM best WHERE CASE WHEN exact THEN cover >= 1.0 ELSE cover >= {COVER} AND cover >= most END),
  found AS (
    SELECT * FROM verified v WHERE exact OR NOT EXISTS (
      SELECT 1 FROM verified h WHERE h.r = v.r AND NOT h.exact AND h.first <= v.first AND h.last >= v.last
        AND (h.first < v.first OR h.last > v.last))
  ),
  scored AS (
    SELECT r, count(*) FILTER (exact) AS n_base, min(first) FILTER (exact) AS first_word, max(first) FILTER (exact) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score
    FROM found GROUP BY r
  )
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM docs LEFT JOIN scored USING (r)
"""

SQL["op6_chat_format"] = r"""
WITH raw AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
  ),
  turns AS (
    SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
           15 + length(role || text) + length(regexp_replace(role || text, '[^\\<>]', '', 'g')) AS chars
    FROM raw WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
  ),
  ends AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM ends GROUP BY conv_id
"""

SQL["op8_decontaminate"] = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents
  ),
  items AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
  known AS (
    SELECT DISTINCT item_id, n, array_to_string(w[p+1:p+n], ' ') AS g
    FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(len(w) - least(len(w), 10) + 1)) AS p FROM items WHERE len(w) > 0)
  ),
  places AS (
    SELECT r, n, p, array_to_string(w[p+1:p+n], ' ') AS g
    FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS p FROM docs, (SELECT DISTINCT n FROM known) WHERE len(w) >= n)
  ),
  hits AS (SELECT r, p, n, item_id FROM places JOIN known USING (n, g)),
  covered AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS place FROM hits) GROUP BY r),
  listed AS (
    SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM hits GROUP BY r
  )
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)
"""

SQL["op5_near_dedup"] = f"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
  ),
  shingles AS (
    SELECT DISTINCT r, array_to_string(w[p+1:p+n], ' ') AS s
    FROM (SELECT r, w, least(len(w), 4) AS n, unnest(range(len(w) - least(len(w), 4) + 1)) AS p FROM docs WHERE len(w) > 0)
  ),
  sets AS (SELECT r, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS k FROM shingles GROUP BY r),
  classes AS (SELECT k, min(r) AS r, any_value(n) AS n FROM sets GROUP BY k),
  of_class AS (SELECT r, n, s FROM shingles JOIN classes USING (r)),
  links AS (
    SELECT a.r AS x, b.r AS y FROM of_class a JOIN of_class b ON a.s = b.s AND a.r <> b.r
    GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
  ),
  reach(x, y) AS (SELECT r, r FROM classes UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
  root AS (SELECT x AS r, min(y) AS root FROM reach GROUP BY x),
  member AS (SELECT sets.r, sets.n, root FROM sets JOIN classes USING (k) JOIN root ON root.r = classes.r),
  lowest AS (SELECT root, min(doc_id) AS low FROM member JOIN docs USING (r) GROUP BY root)
SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN root IS NULL THEN doc_id ELSE low END AS component_id,
       doc_id IS NOT DISTINCT FROM CASE WHEN root IS NULL THEN doc_id ELSE low END AS kept
FROM docs LEFT JOIN member USING (r) LEFT JOIN lowest USING (root)
"""

SQL["op11_repair"] = r"""
WITH RECURSIVE """ + _CRC.strip() + r""",
  raw AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
  ),
  keys AS (
    SELECT k, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ord(k[i]) AS BIGINT))),
             lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]))) % 20 AS fault
    FROM (SELECT DISTINCT k FROM raw), crc
  ),
  damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM raw JOIN keys USING (k) WHERE fault <> 0
  ),
  placed AS (
    SELECT *, coalesce(conv_id, CAST('-9223372036854775808' AS BIGINT)) AS c,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body
    FROM damaged
  ),
  marked AS (
    SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS r,
           CASE WHEN body = '' THEN 'b' WHEN i > min(i) OVER (PARTITION BY c, role, text) THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
    FROM placed
  ),
  ins(q, k, p) AS (VALUES (0,0,0),(1,0,1),(2,0,2),(3,0,3),(0,1,2),(1,1,2),(2,1,3),(3,1,2),(0,2,3),(1,2,3)),
  moves(p, r, letter, cost, q2) AS (
    VALUES (0,'s','K',0,1),(0,'u','K',0,2),(1,'u','K',0,2),(3,'u','K',0,2),(2,'a','K',0,3),
           (0,'*','R',3,2),(1,'*','R',3,2),(2,'*','R',3,3),(3,'*','R',3,2),
           (0,'*','D',4,0),(1,'*','D',4,1),(2,'*','D',4,2),(3,'*','D',4,3)
  ),
  steps AS (
    SELECT ins.q, m.r, m.letter, repeat('I', k) || m.letter AS letters, 3 * k + m.cost AS cost, m.q2 FROM ins JOIN moves m ON ins.p = m.p
  ),
  best(c, i, q, cost, audit) AS (
    SELECT DISTINCT c, CAST(0 AS BIGINT), 0, 0, '' FROM placed
    UNION ALL
    SELECT c, i, q2, way.cost, way.audit FROM (
      SELECT b.c, b.i + 1 AS i, s.q2,
             min({'cost': b.cost + s.cost + CASE WHEN m.fault = 't' AND s.letter <> 'D' THEN 3 ELSE 0 END, 'audit': b.audit || s.letters}) AS way
      FROM best b JOIN marked m ON m.c = b.c AND m.i = b.i + 1
        JOIN steps s ON s.q = b.q AND s.r IN (m.r, '*') AND (s.letter = 'D' OR m.fault IN ('', 't'))
      GROUP BY b.c, b.i, s.q2)
  ),
  ends(q, more, cost) AS (VALUES (0, '', 0), (1, 'II', 6), (2, 'I', 3), (3, '', 0)),
  chosen AS (
    SELECT c, min({'cost': b.cost + e.cost, 'audit': b.audit || e.more}) AS way
    FROM best b JOIN ends e USING (q) JOIN (SELECT c, max(i) AS i FROM placed GROUP BY c) USING (c, i) GROUP BY c
  ),
  letters AS (SELECT c, way.audit AS audit, unnest(range(1, length(way.audit) + 1)) AS j FROM chosen),
  spelt AS (
    SELECT c, j, audit[j] AS e,
           length(replace(audit[1:j], 'I', '')) AS i, length(replace(audit[1:j], 'D', '')) - 1 AS place,
           length(replace(audit, 'D', '')) AS total
    FROM letters
  ),
  lines AS (
    SELECT s.c, s.place, CASE WHEN e = 'K' THEN m.role WHEN (place + total) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
           CASE WHEN e = 'I' THEN '' ELSE m.text END AS line
    FROM spelt s LEFT JOIN marked m ON m.c = s.c AND m.i = s.i WHERE e <> 'D'
  ),
  hashes AS (SELECT c, sha256(string_agg(line, chr(10) ORDER BY place)) AS h FROM lines GROUP BY c),
  counts AS (
    SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT *, lag(r) OVER (PARTITION BY c ORDER BY i) || r AS pair FROM marked) GROUP BY c
  )
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(way.cost, 0) AS BIGINT) AS cost,
       coalesce(way.audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id, CAST('-9223372036854775808' AS BIGINT)) AS c FROM raw) a
  LEFT JOIN counts USING (c) LEFT JOIN chosen USING (c) LEFT JOIN hashes USING (c)
"""

SQL["op12_collocations"] = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
  ),
  words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
  total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
  places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
  f AS (
    SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase, count(*) AS f
    FROM places, range(1, 5) AS x(k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30
  ),
  many AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
  cuts AS (
    SELECT m.lang, m.phrase, a, c, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS c FROM many) m
      JOIN f l ON l.lang = m.lang AND l.phrase = array_to_string(m.w[1:c], ' ')
      JOIN f r ON r.lang = m.lang AND r.phrase = array_to_string(m.w[c+1:], ' ')
  ),
  weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
  inner_phrases AS (
    SELECT lang, a, array_to_string(w[i:i+n-1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, k)) AS i FROM many), range(2, 4) AS x(n) WHERE n < k AND i + n - 1 <= k
  ),
  longer AS (SELECT lang, phrase, max(a) AS most FROM inner_phrases GROUP BY ALL),
  ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
    FROM weakest LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * a
  )
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
