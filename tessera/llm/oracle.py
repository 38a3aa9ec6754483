"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_ROWS = "rows AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)"
_SPLIT_WORDS = r"list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP6 = f"""
WITH {_ROWS},
parts AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM rows),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos FROM parts),
keyed AS (
  SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, f.key IS NOT NULL AS drop_it FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (drop_it) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop_it), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP10 = rf"""
WITH {_ROWS},
w AS (SELECT doc_id, text, {_SPLIT_WORDS} AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM rows),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM win) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(length(array_to_string(words, '')), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id
),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (word_chars < 3 * n_words OR word_chars > 15 * n_words) AND NOT (10 * n_symbols > n_words)
       AND NOT (n_dup_lines >= 5 AND 10 * n_dup_lines > 3 * n_lines) AS kept
FROM b
"""

_ALNUM_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP3 = f"""
WITH {_ROWS},
d AS (SELECT doc_id, {_ALNUM_WORDS} AS words FROM rows),
items AS (SELECT item_id, {_ALNUM_WORDS} AS words FROM (SELECT item_id, coalesce(text, '') AS text FROM benchmark)),
iw AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS len, array_to_string(list_slice(words, i, i + least(len(words), 13) - 1), ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM items WHERE len(words) > 0)
),
lens AS (SELECT DISTINCT len FROM iw),
dw AS (
  SELECT doc_id, len, i, array_to_string(list_slice(words, i, i + len - 1), ' ') AS win
  FROM (SELECT doc_id, words, len, unnest(range(1, len(words) - len + 2)) AS i FROM d, lens WHERE len(words) >= len)
),
hits AS (SELECT doc_id, dw.len, i, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.len = iw.len),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + len)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP7 = f"""
WITH {_ROWS},
d AS (SELECT doc_id, {_SPLIT_WORDS} AS words FROM rows),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 19), ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20)
),
placed AS (SELECT doc_id, i, min({{'d': doc_id, 'i': i}}) OVER (PARTITION BY win) AS first FROM win),
gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT doc_id, unnest(range(i, i + 20)) AS p FROM placed WHERE first.d < doc_id OR (first.d = doc_id AND first.i < i)
  )
),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d),
kept AS (
  SELECT w.doc_id, count(*) AS n_words, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY w.p) FILTER (gone.p IS NULL) AS kept
  FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.p = gone.p GROUP BY w.doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _escaped(x: str) -> str:
    return f"replace(replace(replace({x}, '\\', '\\\\'), '### ', '\\h'), '</turn>', '\\t')"


OP8 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length(replace({_escaped('role')}, ':', '\c')) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP11 = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (SELECT *, CAST(CASE k % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight, CAST(2 * source_size AS DOUBLE) AS cap FROM s),
o AS (
  SELECT *, sum(cap) OVER o - cap AS full_before, sum(weight) OVER () - sum(weight) OVER o + weight AS open, CAST(1.5 AS DOUBLE) * sum(source_size) OVER () AS total,
         row_number() OVER o AS i
  FROM w WINDOW o AS (ORDER BY cap / weight, k ROWS UNBOUNDED PRECEDING)
),
level AS (SELECT arg_min((total - full_before) / open, i) AS level FROM o WHERE (total - full_before) / open * weight <= cap),
t AS (SELECT source, source_size, least(cap, level * weight) AS target FROM w, level),
u AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS words FROM t),
v AS (
  SELECT d.*, u.source_size, u.target, coalesce(words // nullif(u.source_size, 0), 0) AS epochs, words,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR))), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
)
SELECT doc_id, size, source, source_size, target, CAST(epochs * size + greatest(0, least(size, words - epochs * source_size - start)) AS BIGINT) AS taken FROM v
"""

OP12 = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

_CRC32 = """xor(list_reduce(
  list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda s, z: CASE WHEN s % 2 = 1 THEN xor(s // 2, CAST(3988292384 AS BIGINT)) ELSE s // 2 END)
), CAST(4294967295 AS BIGINT))"""
OP13 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT *, md5(length(role) || ':' || role || text) AS id FROM t),
n AS (SELECT conv_id, id, strlen(text) AS bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, id) AS pos FROM i),
m AS (SELECT conv_id, count(*) AS many FROM n GROUP BY conv_id),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC32} % 9 AS h FROM m),
b AS (
  SELECT c.conv_id, n.pos AS depth, id, bytes FROM c JOIN n ON n.conv_id = c.base AND n.pos <= c.h
  UNION ALL
  SELECT c.conv_id, n.pos - c.h + least(c.h, coalesce(m.many, 0)), id, bytes FROM c JOIN n ON n.conv_id = c.conv_id AND n.pos > c.h LEFT JOIN m ON m.conv_id = c.base
),
s AS (
  SELECT c.conv_id, coalesce(string_agg(id, '' ORDER BY depth), '') AS path, list(bytes ORDER BY depth) AS bytes, count(id) AS size FROM c LEFT JOIN b ON b.conv_id = c.conv_id GROUP BY c.conv_id
),
cells AS (SELECT conv_id, d AS depth, substr(path, 1, 32 * d) AS path, size, CASE WHEN d > 0 THEN bytes[d] ELSE 0 END AS bytes FROM (SELECT *, unnest(range(0, size + 1)) AS d FROM s)),
nodes AS (
  SELECT depth, path, substr(path, 1, 32 * (depth - 1)) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth) AS ends
  FROM cells GROUP BY depth, path
),
kids AS (SELECT depth - 1 AS depth, up AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY depth, up),
own AS (SELECT x.depth, x.path, (n_convs - 1) * bytes AS saved, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf FROM nodes x LEFT JOIN kids k ON k.depth = x.depth AND k.path = x.path),
sub AS (SELECT d AS depth, substr(path, 1, 32 * d) AS path, sum(saved) AS saved, sum(leaf) AS leaves FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM own) GROUP BY 1, 2)
SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(sub.leaves AS BIGINT) AS n_leaves,
       CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
FROM nodes x JOIN sub ON sub.depth = x.depth AND sub.path = x.path LEFT JOIN kids k ON k.depth = x.depth AND k.path = x.path
LEFT JOIN nodes p ON p.depth = x.depth - 1 AND p.path = x.up
"""

ORACLE: dict[str, str] = {"op3_decontaminate": OP3, "op6_line_dedup": OP6, "op7_phrase_dedup": OP7, "op8_chat_format": OP8, "op10_quality_rules": OP10, "op11_source_mixing": OP11, "op12_hard_negatives": OP12, "op13_prefix_trie": OP13}
