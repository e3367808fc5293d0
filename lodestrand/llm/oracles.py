"""DuckDB statements for the queries that SQL can express over whole tables."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP4 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
k AS (SELECT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g, unnest(range(0, greatest(1, len(w) - 4))) AS i FROM d),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS o FROM k),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.o = b.o AND a.doc_id < b.doc_id GROUP BY 1, 2),
p AS (SELECT a, b, x.n + y.n AS n FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c)),
m AS (SELECT a, b, n, list([y.i] ORDER BY x.i) AS places FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.g = x.g AND y.o = x.o GROUP BY a, b, n),
l AS (SELECT a, b, n, len(CASE WHEN list_sort(places) = places THEN places[1:] ELSE list_transform(list_reduce(places, lambda t, x: list_concat(t[:len(list_filter(t, lambda y: y < x[1]))], x, t[len(list_filter(t, lambda y: y < x[1])) + 2:])), lambda x: [x]) END) AS c FROM m),
e AS (SELECT a, b FROM l WHERE c >= 0.8 * (n - c)),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e UNION SELECT doc_id, doc_id FROM d),
r(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, k.b FROM r JOIN both_ways k ON r.b = k.a)
SELECT a AS doc_id, min(b) AS class_id, a = min(b) AS kept FROM r GROUP BY a
"""

_ESCAPED = r"replace(replace(replace({0}, '\', '\e'), '<', '\l'), '[', '\b')"
OP5 = rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + 8 + 8 + 7) AS chars
  FROM r GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g
"""

OP7 = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
k AS (SELECT a, b FROM l UNION SELECT vec_id, vec_id FROM embeddings),
r(a, b) AS (SELECT a, b FROM k UNION SELECT r.a, k.b FROM r JOIN k ON r.b = k.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT r.a AS vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept FROM r LEFT JOIN n ON n.a = r.a GROUP BY r.a
"""

OP8 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, unnest(list_transform(range(1, len(w) - 18), lambda j: md5(array_to_string(w[j:j + 19], ' ')))) AS h FROM d WHERE len(w) >= 20),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM late),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS t, count(*) AS n FROM each e ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

_GRID = """VALUES
  (1, 'symbols', [0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0]), (2, 'dup_lines', [0.1, 0.2, 0.3, 0.5, 0.7]),
  (3, 'long_words', [8.0, 9.0, 10.0, 12.0, 16.0]), (4, 'repeats', [0.02, 0.05, 0.1, 0.2, 0.3])"""
OP10 = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text, {WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda j: array_to_string(w[j:j + 7], ' '))) AS h FROM d WHERE len(w) >= 8),
often AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS k FROM win) WHERE k > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM often) GROUP BY doc_id),
s AS (SELECT d.doc_id, lang, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines FROM d LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, [CAST(n_symbols AS DOUBLE) / greatest(n_words, 1), CAST(n_dup_lines AS DOUBLE) / greatest(n_lines, 1), CAST(word_chars AS DOUBLE) / greatest(n_words, 1), CAST(n_repeat_words AS DOUBLE) / greatest(n_words, 1)] AS score FROM s),
grid AS (SELECT r, rule, CAST(unnest(cuts) AS DOUBLE) AS cut FROM ({_GRID}) g(r, rule, cuts)),
held AS (SELECT lang, score FROM b WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
counts AS (SELECT lang, r, rule, cut, count(*) AS n, count_if(score[r] >= cut) AS k FROM held, grid GROUP BY ALL),
strata AS (SELECT count(DISTINCT coalesce(lang, chr(0))) AS m FROM held),
tails AS (SELECT lang, r, rule, cut, list_sum(list_transform(range(0, CAST(k AS BIGINT) + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.005) + (n - j) * ln(1 - 0.005)))) AS p FROM counts WHERE k <= ceil(0.005 * n)),
best AS (SELECT lang, r, rule, min(cut) AS cut FROM tails, strata WHERE p <= 0.05 / (22 * m) GROUP BY ALL),
bad AS (SELECT b.doc_id, string_agg(rule, ',' ORDER BY r) AS failed FROM b JOIN best ON b.lang IS NOT DISTINCT FROM best.lang AND b.score[r] >= cut GROUP BY b.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed IS NULL AS kept, coalesce(failed, '') AS failed_rules FROM b LEFT JOIN bad USING (doc_id)
"""

OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE_SQL = {"op4_near_text": OP4, "op5_chat_format": OP5, "op7_near_vectors": OP7, "op8_substring_dedup": OP8, "op10_quality_rules": OP10, "op11_hard_negatives": OP11}
