"""DuckDB SQL for the queries that SQL can express.

Left out, and tested against brute force, round trips or held-out rows instead: trained models (op3, op5), the drawn mix
(op7), main texts of trees (op8) and token counts (op10).
"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_OP1 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACED.format(_LOW)} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS i FROM w)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
edges AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reached JOIN edges ON other = a
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

_OP2 = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
c AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learnt,
    sum(24 + length(replace(replace(replace(role, '%', '%25'), '<|', '<%7C'), chr(10), '%0A'))
      + length(replace(replace(text, '%', '%25'), '<|', '<%7C')))::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars
FROM c
"""

_OP4 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents
),
g AS (SELECT plain, first(doc_id ORDER BY length(text) DESC, doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY plain)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM d JOIN g USING (plain)
"""

_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 11, least(len(w), 1) + 1))) AS i FROM b)
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
hits AS (SELECT doc_id, item_id, i, n FROM places JOIN windows USING (n, words)),
found AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN found USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP9 = rf"""
WITH d AS (SELECT doc_id, {_SPACED.format("coalesce(text, '')")} AS w FROM documents),
places AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
),
firsts AS (SELECT words, min(doc_id) AS first FROM places GROUP BY words HAVING min(doc_id) <> max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(range(i, i + 13)) AS k FROM places JOIN firsts USING (words) WHERE doc_id > first)
),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d) ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_OP11 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array({_LOW}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 5) AS t(k)) GROUP BY ALL
),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, c.cut, x.f AS l, y.f AS r,
    (2000000::HUGEINT * c.f) // (x.f::HUGEINT + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.k = c.cut AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - c.cut AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')
),
inside AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM candidates, range(2, 4) AS t(s) WHERE s < k) GROUP BY ALL
)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1) JOIN n USING (lang)
LEFT JOIN inside USING (lang, phrase)
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase))
QUALIFY row_number() OVER w <= 2000
"""

_OP13 = """
WITH v AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""

ORACLE: dict[str, str] = {
    "op1_near_dedup": _OP1,
    "op2_chat_formatting": _OP2,
    "op4_exact_dedup": _OP4,
    "op6_decontamination": _OP6,
    "op9_substring_dedup": _OP9,
    "op11_collocations": _OP11,
    "op13_hard_negatives": _OP13,
}
