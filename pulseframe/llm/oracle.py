"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP4 = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS body, {_WORDS} AS words FROM documents),
m AS (
  SELECT doc_id, body, words, len(words)::BIGINT AS n_words,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
tri AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM rep, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
f AS (
  SELECT m.doc_id, n_words,
    length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
    length(body) - length(regexp_replace(body, '[A-Za-z]', '', 'g')) AS n_letters,
    length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')) AS n_capitals
  FROM m LEFT JOIN cov USING (doc_id)),
b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
    + 4 * (10 * n_symbols > 2 * n_words)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT
    + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 15 * n_words)::BIGINT
    + 64 * (n_letters > 0 AND 10 * n_capitals > 6 * n_letters)::BIGINT AS failures FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failures & 3) <> 0 AS base_failed, failures = 0 AS kept, failures FROM b"""

OP7 = r"""
WITH t AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
  UNION ALL SELECT -1, v.turn, v.role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
l AS (SELECT *, CASE WHEN role = 'assistant' THEN body ELSE '' END AS loss,
  length(replace(replace(body, '\', '\\'), '<|', '<\|')) + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\n'))
    + 24 AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
  sum(length(loss))::BIGINT AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn, role, body)) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM l GROUP BY conv_id"""

OP8 = r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, ls[i] AS line, i, translate(regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM s)),
r AS (SELECT k, min(doc_id) AS first FROM l WHERE length(k) >= 10 GROUP BY k HAVING min(doc_id) < max(doc_id))
SELECT doc_id, count(*) AS n_lines, (count(*) FILTER (r.first < doc_id))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (r.first IS NULL OR r.first >= doc_id), '')) AS kept_sha256
FROM l LEFT JOIN r USING (k) GROUP BY doc_id"""

OP6 = """
WITH v AS (SELECT vec_id::BIGINT AS vec_id, row_number() OVER () AS r,
    list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS f FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding)),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.f, c.f)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.f) = len(c.f) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""

OP1 = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
p AS (SELECT doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 48, 1))) AS i FROM w)),
f AS (SELECT h, min(doc_id) AS first FROM p GROUP BY h),
d AS (SELECT p.doc_id, p.i FROM p JOIN f USING (h) WHERE f.first < p.doc_id),
g AS (SELECT DISTINCT doc_id, i + k AS j FROM (SELECT doc_id, i, unnest(range(0, 50)) AS k FROM d)),
e AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS j FROM w),
k AS (SELECT e.doc_id, count(g.j)::BIGINT AS n_removed, string_agg(e.word, ' ' ORDER BY e.j) FILTER (g.j IS NULL) AS kept
  FROM e LEFT JOIN g ON e.doc_id = g.doc_id AND e.j = g.j GROUP BY e.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text"

OP5 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS words FROM (SELECT doc_id, {_LOW} FROM documents)),
s AS (
  SELECT DISTINCT doc_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS sh
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM w)
  UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) IN (1, 2)),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(sh, '|' ORDER BY sh)) AS h FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, t.b FROM r JOIN both_ways t ON t.a = r.reach),
m AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept,
  coalesce(min(n.doc_id) OVER (PARTITION BY n.h), m.doc_id) AS class_id
FROM m LEFT JOIN n USING (doc_id)"""

OP13 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body, {_WORDS} AS words FROM documents),
e AS (SELECT *, coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS copied FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
      + 4 * (100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 10 * length(body))::INT
      + 8 * regexp_matches(body, '[#$%&*|]')::INT + 16 * copied::INT AS mask,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM e LEFT JOIN l USING (doc_id) GROUP BY ALL),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.letter || b.letter || c.letter || g.letter || h.letter AS filter_order FROM f a, f b, f c, f g, f h
  WHERE a.bit + b.bit + c.bit + g.bit + h.bit = 31 AND a.bit | b.bit | c.bit | g.bit | h.bit = 31),
s AS (SELECT filter_order, step::INT AS step, letter, bit,
    coalesce(sum(bit) OVER (PARTITION BY filter_order ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS earlier
  FROM o, range(1, 6) r(step) JOIN f ON letter = substr(filter_order, step::INT, 1)),
r AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM r"""

# crc32 of the decimal id, byte by byte and bit by bit
_CRC = """4294967295 - list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))"""

# A run holds two neighbouring multiples of its period with equal words after them, eight at least: such (text, distance) are
# compared word by word.
OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words, CASE WHEN doc_id IS NULL THEN 1 ELSE {_CRC} END AS h FROM documents),
a AS (SELECT r, doc_id, words, len(words) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM d),
t AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN words ELSE list_transform(range(n),
    lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w FROM a),
e AS MATERIALIZED (SELECT r, i, n, w[i + 1] AS word, hash(w[i + 1 : i + 8]) AS gram FROM (SELECT r, w, n, unnest(range(n)) AS i FROM t)),
m AS (SELECT r, q, unnest(range(0, n - q, q)) AS i FROM (SELECT r, n, unnest(range(1, n // 3 + 1)) AS q FROM t WHERE n >= 24)),
c AS (SELECT DISTINCT m.r, q FROM m JOIN e x ON x.r = m.r AND x.i = m.i JOIN e y ON y.r = m.r AND y.i = m.i + q WHERE x.gram = y.gram),
s AS (SELECT c.r, q, x.i, x.i - row_number() OVER (PARTITION BY c.r, q ORDER BY x.i) AS island
  FROM c JOIN e x ON x.r = c.r JOIN e y ON y.r = c.r AND y.i = x.i + q WHERE x.word = y.word),
u AS (SELECT r, start, stop, min(q) AS period FROM (
    SELECT r, q, min(i) AS start, max(i) + 1 + q AS stop FROM s GROUP BY r, q, island HAVING max(i) + 1 + q - min(i) >= greatest(24, 3 * q))
  GROUP BY r, start, stop),
runs AS (SELECT r, start, stop - start AS length, period FROM u),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) = 1),
listed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT e.r, string_agg(word, ' ' ORDER BY e.i) AS text FROM e ANTI JOIN gone ON gone.r = e.r AND gone.i = e.i GROUP BY e.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM t LEFT JOIN best USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)"""

ORACLE = {"op11_periodic_runs": OP11, "op13_filter_audit": OP13, "op1_substring_dedup": OP1, "op5_near_dedup": OP5, "op6_top_k": OP6, "op4_quality_rules": OP4, "op7_chat": OP7, "op8_line_dedup": OP8}
