"""DuckDB SQL of the queries that SQL can express: the rule ledger, the positional index, ranked search and the manifest."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"
_FAILS = (
    "n_words < 50", "100 * n_repeat_words > 50 * n_words", "10 * n_symbols > n_words", "100 * n_mark_words > 20 * n_words", "100 * n_caps_words > 30 * n_words", "100 * n_dup_lines > 30 * n_lines", "word_chars < 3 * n_words",
    "word_chars > 12 * n_words", "100 * n_alpha_words < 70 * n_words",
)

RULES_SQL = rf"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {_WORD})) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM texts),
windows AS (SELECT doc_id, i, a, lead(a) OVER w AS b, lead(a, 2) OVER w AS c FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM windows WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) t(k) GROUP BY 1),
measured AS (SELECT t.doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, len(list_filter(words, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_caps_words, len(list_filter(words, lambda x: regexp_matches(x, '[#*$%&|<>!]'))) AS n_mark_words,
    len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z\x{{80}}-\x{{10FFFF}}]'))) AS n_alpha_words FROM texts t LEFT JOIN covered USING (doc_id)),
told AS (SELECT *, ({' + '.join(f'CASE WHEN {f} THEN {1 << i} ELSE 0 END' for i, f in enumerate(_FAILS))})::BIGINT AS failures FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures FROM told"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATION_SQL = rf"""WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_TERM}) AS words FROM documents),
items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, {_TERM}) AS words FROM benchmark),
windows AS (SELECT item, least(13, len(words)) AS size, words[pos0 : pos0 + least(13, len(words)) - 1] AS words, pos0 FROM (SELECT *, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS pos0 FROM items WHERE len(words) > 0)),
places AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
grams AS (SELECT doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') AS gram FROM (SELECT d.*, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs d, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
found AS (SELECT doc_id, i, g.size, item FROM grams g JOIN windows w ON g.size = w.size AND gram = array_to_string(w.words, ' ')),
hits AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, size)) AS k FROM found) GROUP BY 1),
owners AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS joined FROM found GROUP BY 1),
frequency AS (SELECT word, count(*) AS f FROM places GROUP BY 1),
terms AS (SELECT item, pos0, word, k, coalesce(f, 0) AS f, row_number() OVER (PARTITION BY item, pos0 ORDER BY coalesce(f, 0), word, k) AS r FROM (SELECT item, pos0, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM windows) LEFT JOIN frequency USING (word)),
rare AS (SELECT t.item, t.pos0, t.word, t.k, p.doc_id, p.i FROM terms t JOIN places p USING (word) WHERE t.r = 1 AND t.f > 0),
wanted AS (SELECT item, pos0, count(*) AS n FROM terms WHERE r BETWEEN 2 AND 4 GROUP BY 1, 2),
beside AS (SELECT x.item, x.pos0, x.doc_id, x.i, t.r FROM rare x JOIN terms t ON t.item = x.item AND t.pos0 = x.pos0 AND t.r BETWEEN 2 AND 4 JOIN places p ON p.doc_id = x.doc_id AND p.word = t.word AND abs(p.i - x.i) <= abs(t.k - x.k) + 8 GROUP BY ALL),
near AS (SELECT x.doc_id, x.item FROM rare x LEFT JOIN wanted w ON w.item = x.item AND w.pos0 = x.pos0 LEFT JOIN (SELECT item, pos0, doc_id, i, count(*) AS n FROM beside GROUP BY 1, 2, 3, 4) c ON c.item = x.item AND c.pos0 = x.pos0 AND c.doc_id = x.doc_id AND c.i = x.i WHERE coalesce(c.n, 0) = coalesce(w.n, 0)),
by_doc AS (SELECT doc_id, count(DISTINCT item) AS n_near_items FROM near GROUP BY 1)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(words) AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id) LEFT JOIN by_doc USING (doc_id)"""

SEARCH_SQL = rf"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_TERM}) AS words FROM documents),
items AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_LOWER}, {_TERM}) AS words FROM benchmark),
totals AS (SELECT count(*)::BIGINT AS n, sum(len(words))::BIGINT AS l FROM docs WHERE len(words) > 0),
asked AS (SELECT q, word, count(*) AS times FROM (SELECT q, unnest(words) AS word FROM items) GROUP BY ALL),
places AS (SELECT r, word, count(*)::BIGINT AS tf FROM (SELECT r, unnest(words) AS word FROM docs) WHERE word IN (SELECT word FROM asked) GROUP BY ALL),
weights AS (SELECT word, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT word, count(*) AS df FROM places GROUP BY 1), totals),
sizes AS (SELECT r, doc_id, 75 + (25 * len(words)::BIGINT * n) // l AS m FROM docs, totals),
scores AS (SELECT q, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM places JOIN sizes USING (r) JOIN weights USING (word) JOIN asked USING (word) GROUP BY ALL),
ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scores JOIN docs USING (r) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked JOIN items USING (q) WHERE rank <= 20"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR END"
_LEAF = "sha256(concat(" + ", ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + "))"
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT)"

MERKLE_SQL = rf"""WITH RECURSIVE rows AS (SELECT doc_id, coalesce('=' || lang, '') AS part, {_LEAF.format(text="text")} AS leaf, {_LEAF.format(text="told")} AS claim FROM (
    SELECT *, CASE WHEN text IS NOT NULL AND {_CRC} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS told FROM documents)),
leaves AS (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM rows),
below AS (SELECT part, 0 AS level, i, leaf AS h FROM leaves UNION ALL
    SELECT part, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY part) AS n FROM below) WHERE n > 1 GROUP BY part, level, i // 8),
subroots AS (SELECT part, max(level) AS depth, arg_max(h, level) AS subroot, row_number() OVER (ORDER BY part) - 1 AS place FROM below GROUP BY part),
above AS (SELECT 0 AS level, place AS i, subroot AS h FROM subroots UNION ALL
    SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS n FROM above) WHERE n > 1 GROUP BY level, i // 8),
top AS (SELECT max(level) AS height, arg_max(h, level) AS root FROM above),
spots AS (SELECT r, part, level, i // (8 ** level)::BIGINT AS i, false AS up FROM (SELECT r, part, i, unnest(range(depth)) AS level FROM leaves JOIN subroots USING (part)) UNION ALL
    SELECT r, part, level, place // (8 ** level)::BIGINT, true FROM (SELECT r, part, place, unnest(range(height)) AS level FROM leaves JOIN subroots USING (part), top)),
steps AS (SELECT s.r, s.up, s.level, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < s.i), '') AS pre, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > s.i), '') AS post
    FROM spots s JOIN (SELECT part, level, i, h, false AS up FROM below UNION ALL SELECT p.part, a.level, a.i, a.h, true FROM above a, subroots p) n ON n.part = s.part AND n.up = s.up AND n.level = s.level AND n.i // 8 = s.i // 8 GROUP BY ALL),
walk AS (SELECT r, pre, post, row_number() OVER (PARTITION BY r ORDER BY up, level) AS step FROM (SELECT s.r, s.up, s.level, s.pre, s.post FROM steps s)),
folds AS (SELECT r, 0::BIGINT AS step, claim AS h FROM leaves UNION ALL SELECT f.r, w.step, sha256(concat(w.pre, f.h, w.post)) FROM folds f JOIN walk w ON w.r = f.r AND w.step = f.step + 1),
roots AS (SELECT r, arg_max(h, step) AS folded_root FROM folds GROUP BY r),
proofs AS (SELECT r, sha256(string_agg(pre || post, '' ORDER BY step)) AS proof_sha256 FROM walk GROUP BY r)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (part) JOIN roots USING (r) LEFT JOIN proofs USING (r), top"""
