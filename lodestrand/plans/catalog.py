"""Registered queries over the driver's tables, each with its DuckDB counterpart where SQL can express it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import answers as A
from ..functions import text as T
from ..operators import curate, dedup, passages, planner, questions, records, registry, retrieval, sampling
from ..session import ship, spread
from ..sources import extract

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TOK = r"regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+(?:[''’.-][\p{{L}}\p{{N}}_]+)*')"
FOLD = "replace(lower({0}), 'ß', 'ss')"
SHINGLES = "CASE WHEN len({0}) = 0 THEN [] WHEN len({0}) < {1} THEN [array_to_string({0}, ' ')] ELSE list_distinct(list_transform(range(1, len({0}) - {1} + 2), lambda i: array_to_string({0}[i:i + {1} - 1], ' '))) END"


#: Tables of long texts, whose rows are worth a core each.
TEXTS = ("documents", "pages", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in TEXTS else rows


def query(sql: str | None = None):
    """Register a query under its own name, with its DuckDB statement."""

    def add(f):
        @functools.wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return run

    return add


_HASHED = rf"SELECT *, sha256(trim(regexp_replace({FOLD.format('text')}, '\s+', ' ', 'g'))) AS h FROM documents"
_LINES = r"list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
_FLAGS = rf"""list_filter([
  CASE WHEN n > 20000 THEN 'oversized_document' END,
  CASE WHEN n > 1000 AND len(list_filter(lines, lambda x: regexp_matches(x, '^-\s+'))) / greatest(len(lines), 1) > 0.75 THEN 'list_heavy_document' END,
  CASE WHEN len(longs) >= 20 AND 1 - len(list_distinct(longs)) / len(longs) > 0.15 THEN 'excessive_duplicate_lines' END,
  CASE WHEN n < 10 THEN 'very_short' END,
  CASE WHEN (length(text) - length(replace(text, chr(65533), ''))) / greatest(length(text), 1) > 0.001 THEN 'encoding_replacement_noise' END], lambda x: x IS NOT NULL)"""
_BASE = rf"""WITH t AS (SELECT *, len({TOK.format('text')}) AS n, {_LINES} AS lines FROM ({_HASHED})),
u AS (SELECT *, list_filter(lines, lambda x: length(x) >= 60) AS longs, min(doc_id) OVER (PARTITION BY h) AS owner FROM t),
f AS (SELECT doc_id, lang, source, n, text, h, CASE WHEN owner <> doc_id THEN owner END AS dup, {_FLAGS} AS q,
  regexp_matches(text, '(?i)\b[\w.+-]+@[\w.-]+\.[A-Za-z]{{2,}}\b') OR regexp_matches(text, '(?i)\b(?:T\.?C\.?\s*)?(?:kimlik|identity)\s*(?:no|number|numarası)?\s*[:#]?\s*\d{{11}}\b') OR regexp_matches(text, '(?i)\b(?:home|residential|ev)\s+address\b') AS pii FROM u),
c AS (SELECT *, list_concat(q, list_filter([CASE WHEN dup IS NOT NULL THEN 'exact_duplicate' END, CASE WHEN pii THEN 'possible_personal_data' END], lambda x: x IS NOT NULL)) AS flags FROM f)"""
_BLOCK = "[" + ", ".join(f"'{b}'" for b in curate.BLOCKING) + "]"


@query(_BASE + f""", d AS (SELECT *, NOT list_has_any(flags, {_BLOCK}) AS ok FROM c),
s AS (SELECT lang, count(*) AS documents, count_if(ok) AS accepted, count_if(dup IS NOT NULL) AS duplicates, CAST(sum(n) AS BIGINT) AS tokens, CAST(coalesce(sum(n) FILTER (ok), 0) AS BIGINT) AS accepted_tokens FROM d GROUP BY lang)
SELECT *, round(accepted_tokens / sum(accepted_tokens) OVER (), 6) AS share FROM s""")
def corpus_quality_summary(spark, sf_dir):
    return curate.summary(table(spark, sf_dir, "documents"))


@query(_BASE + f" SELECT doc_id, dup AS duplicate_of, n AS n_tokens, array_to_string(flags, ',') AS flags, NOT list_has_any(flags, {_BLOCK}) AS accepted FROM c")
def curated_documents(spark, sf_dir):
    held = curate.curate(table(spark, sf_dir, "documents"))
    return held.select("doc_id", "duplicate_of", "n_tokens", F.array_join("flags", ",").alias("flags"), "accepted")


@query(f"SELECT doc_id, len(w) AS n_tokens, len(list_distinct(w)) AS n_distinct, len(list_distinct(list_transform(w, lambda x: {FOLD.format('x')}))) AS n_folded FROM (SELECT doc_id, {TOK.format('text')} AS w FROM documents)")
def token_stats(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", T.tokens(F.col("text")).alias("w"))
    return rows.select("doc_id", F.size("w").alias("n_tokens"), F.size(F.array_distinct("w")).alias("n_distinct"), F.size(F.array_distinct(F.transform("w", T.fold))).alias("n_folded"))


@query(_BASE + " SELECT doc_id, dup AS duplicate_of FROM c WHERE dup IS NOT NULL")
def exact_duplicates(spark, sf_dir):
    return curate.exact_duplicates(table(spark, sf_dir, "documents")).filter("duplicate_of is not null").select("doc_id", "duplicate_of")


@query(_BASE + " SELECT flag, lang, count(*) AS n FROM (SELECT lang, unnest(flags) AS flag FROM c) GROUP BY ALL")
def flag_breakdown(spark, sf_dir):
    held = curate.curate(table(spark, sf_dir, "documents"))
    return held.select("lang", F.explode("flags").alias("flag")).groupBy("flag", "lang").agg(F.count(F.lit(1)).alias("n"))


_TR = " + ".join(f"length(t) - length(replace(t, '{c}', ''))" for c in T.TURKISH_LETTERS)
_WORDSQL = "len(list_filter(w, lambda x: x IN ({0})))"


@query(rf"""WITH d AS (SELECT doc_id, {FOLD.format('text')} AS t FROM documents), e AS (SELECT doc_id, t, regexp_extract_all(t, '[\p{{L}}\p{{M}}\p{{N}}_]+') AS w FROM d)
SELECT doc_id, CASE WHEN ({_TR}) + {_WORDSQL.format(', '.join(f"'{x}'" for x in T.TURKISH_WORDS))} > {_WORDSQL.format(', '.join(f"'{x}'" for x in T.ENGLISH_WORDS))} THEN 'tr'
WHEN {_WORDSQL.format(', '.join(f"'{x}'" for x in T.ENGLISH_WORDS))} > 0 THEN 'en' ELSE 'und' END AS detected FROM e""")
def detected_language(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.detect_language(F.col("text")).alias("detected"))


@query(f"WITH d AS (SELECT source, len({TOK.format('text')}) AS n FROM documents), s AS (SELECT source AS key, count(*) AS documents, CAST(sum(n) AS BIGINT) AS tokens FROM d GROUP BY source) SELECT *, round(tokens / sum(tokens) OVER (), 6) AS share FROM s")
def family_token_shares(spark, sf_dir):
    return curate.shares(table(spark, sf_dir, "documents").withColumn("n", F.size(T.tokens(F.col("text")))), "source", "n")


@query(rf"""WITH d AS (SELECT lang, source, len({TOK.format('text')}) AS n FROM documents),
l AS (SELECT lang AS key, round(sum(n) / (SELECT sum(n) FROM d), 6) AS share FROM d GROUP BY lang), s AS (SELECT source AS key, round(sum(n) / (SELECT sum(n) FROM d), 6) AS share FROM d GROUP BY source)
SELECT 'topic_minimum' AS code, k AS key, 0.2 AS target, coalesce(share, 0.0) AS actual FROM (SELECT unnest(['en', 'de', 'fr', 'es', 'tr']) AS k) LEFT JOIN l ON l.key = k WHERE coalesce(share, 0.0) < 0.2
UNION ALL SELECT 'source_family_cap', key, 0.06, share FROM s WHERE share > 0.06""")
def quota_issues(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("n", F.size(T.tokens(F.col("text")))).withColumn("topics", F.array("lang"))
    return curate.quota_issues(curate.topic_shares(docs, "topics", "n"), curate.shares(docs, "source", "n"), ["en", "de", "fr", "es", "tr"], 0.2, 0.06)


@query(f"WITH d AS (SELECT lang, len({TOK.format('text')}) AS n FROM documents), l AS (SELECT lang, round(sum(n) / (SELECT sum(n) FROM d), 6) AS s FROM d GROUP BY lang) SELECT k AS key, t AS target, coalesce(s, 0.0) AS share, abs(coalesce(s, 0.0) - t) <= 0.05 AS within FROM (VALUES ('en', 0.7), ('tr', 0.3)) v(k, t) LEFT JOIN l ON l.lang = k")
def language_tolerance(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("n", F.size(T.tokens(F.col("text"))))
    return curate.within_tolerance(curate.shares(docs, "lang", "n"), {"en": 0.7, "tr": 0.3})


@query("WITH s AS (SELECT CAST(year(o_orderdate) // 10 * 10 AS VARCHAR) || 's' AS period, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1) SELECT period, n, round(total / sum(total) OVER (), 6) AS share FROM s")
def decade_shares(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").groupBy(curate.decade(F.col("o_orderdate")).alias("period")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("t"))
    return rows.select("period", "n", F.round(F.col("t") / F.sum("t").over(Window.partitionBy(F.lit(0))), 6).alias("share"))


@query("SELECT source, doc_id, n_chars FROM (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id DESC) AS r FROM documents) WHERE r = 1")
def group_representatives(spark, sf_dir):
    return curate.representatives(table(spark, sf_dir, "documents"), "source", "n_chars", "doc_id").select("source", "doc_id", "n_chars")


_NEAR = rf"""WITH RECURSIVE d AS (SELECT doc_id, {TOK.format(FOLD.format('text'))} AS w FROM documents),
s AS (SELECT doc_id, unnest({SHINGLES.format('w', 5)}) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c / (x.n + y.n - c) >= 0.85),
k AS (SELECT a, b FROM e UNION SELECT b, a FROM e UNION SELECT doc_id, doc_id FROM d),
r(a, b) AS (SELECT a, b FROM k UNION SELECT r.a, k.b FROM r JOIN k ON r.b = k.a),
m AS (SELECT a AS doc_id, min(b) AS component FROM r GROUP BY a)"""


@query(_NEAR + """, i AS (SELECT component, count(*) AS group_size, 'dupe_' || substr(sha256('["' || string_agg(CAST(doc_id AS VARCHAR), '","' ORDER BY CAST(doc_id AS VARCHAR)) || '"]'), 1, 24) AS duplicate_group_id FROM m GROUP BY 1)
SELECT doc_id, component, group_size, duplicate_group_id FROM m JOIN i USING (component)""")
def near_duplicate_groups(spark, sf_dir):
    return dedup.near_duplicate_groups(table(spark, sf_dir, "documents"))


_SIGSQL = "CASE WHEN len(s) = 0 THEN '0000000000000000' ELSE list_min(list_transform(s, lambda x: sha256({0} || ':' || x)[1:16])) END"


@query(rf"""WITH d AS (SELECT conv_id, turn, {TOK.format(FOLD.format('text'))} AS w FROM conversations WHERE role = 'user'), q AS (SELECT conv_id, turn, {SHINGLES.format('w', 3)} AS s FROM d)
SELECT conv_id, turn, array_to_string([{', '.join(_SIGSQL.format(i) for i in range(16))}], ',') AS signature FROM q""")
def question_signatures(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").filter("role = 'user'")
    return rows.select("conv_id", "turn", F.array_join(dedup.sha_signature(T.shingles(T.normalized_tokens(F.col("text")), 3)), ",").alias("signature"))


@query("SELECT doc_id, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'validation' ELSE 'test' END AS split FROM (SELECT doc_id, CAST('0x' || sha256('doc-' || doc_id)[1:8] AS BIGINT) % 100 AS b FROM documents)")
def split_assignment(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", dedup.assign_split(F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))).alias("split"))


@query("SELECT s_suppkey, count(DISTINCT p) AS groups, min(p) AS least FROM (SELECT s_suppkey, s_nationkey % 5 AS p FROM supplier) GROUP BY 1")
def distinct_sets(spark, sf_dir):
    return table(spark, sf_dir, "supplier").groupBy("s_suppkey").agg(F.countDistinct(F.col("s_nationkey") % 5).alias("groups"), F.min(F.col("s_nationkey") % 5).alias("least"))


_BM25 = rf"""WITH d AS (SELECT doc_id, {TOK.format(FOLD.format('text'))} AS w FROM documents), st AS (SELECT count(*) AS n, greatest(avg(len(w)), 1.0) AS mean FROM d),
q AS (SELECT item_id, word, count(*) AS times FROM (SELECT item_id, unnest({TOK.format(FOLD.format('text'))}) AS word FROM benchmark) GROUP BY ALL),
h AS (SELECT doc_id, len, word, count(*) AS tf FROM (SELECT doc_id, len(w) AS len, unnest(w) AS word FROM d) WHERE word IN (SELECT word FROM q) GROUP BY ALL),
f AS (SELECT word, count(*) AS df FROM h GROUP BY word),
s AS (SELECT doc_id, word, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / greatest(tf + 1.2 * (1 - 0.75 + 0.75 * len / mean), 1e-12) AS s FROM h JOIN f USING (word), st),
r AS (SELECT item_id, doc_id, round(sum(s * times), 9) AS score FROM s JOIN q USING (word) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r QUALIFY rank <= 20)"""


def _bm25(spark, sf_dir):
    return retrieval.bm25(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "item_id")


@query(_BM25 + " SELECT item_id, doc_id, round(score, 6) AS score, rank FROM k")
def bm25_top20(spark, sf_dir):
    return _bm25(spark, sf_dir).withColumn("score", F.round("score", 6))


_REL = "rel AS (SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)), need AS (SELECT item_id, count(*) AS need FROM rel GROUP BY item_id)"
_MET = f"""{_BM25}, {_REL}, hits AS (SELECT item_id, rank FROM k JOIN rel USING (item_id, doc_id)),
g AS (SELECT item_id, count_if(rank <= 5) AS h5, count_if(rank <= 10) AS h10, count_if(rank <= 20) AS h20, min(rank) FILTER (rank <= 10) AS first, sum(1 / log2(rank + 1)) FILTER (rank <= 10) AS dcg FROM hits GROUP BY item_id),
met AS (SELECT item_id, coalesce(h5 / need, 0) AS "recall@5", coalesce(h10 / need, 0) AS "recall@10", coalesce(h20 / need, 0) AS "recall@20", coalesce(1 / first, 0) AS "mrr@10", coalesce(dcg / list_sum(list_transform(range(1, least(10, need) + 1), lambda r: 1 / log2(r + 1))), 0) AS "ndcg@10" FROM need LEFT JOIN g USING (item_id))"""


@query(_MET + """, x AS (SELECT *, CASE WHEN item_id % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM met)
SELECT dimension, key, count(*) AS items, round(avg("recall@5"), 6) AS "recall@5", round(avg("recall@10"), 6) AS "recall@10", round(avg("recall@20"), 6) AS "recall@20", round(avg("mrr@10"), 6) AS "mrr@10", round(avg("ndcg@10"), 6) AS "ndcg@10"
FROM (SELECT 'overall' AS dimension, 'all' AS key, * FROM x UNION ALL SELECT 'parity', parity, * FROM x) GROUP BY 1, 2""")
def retrieval_report(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = retrieval.contains(docs, items, "doc_id", "item_id")
    per = retrieval.retrieval_metrics(_bm25(spark, sf_dir), found, "item_id", "doc_id")
    per = per.withColumn("parity", F.when(F.col("item_id") % 2 == 0, "even").otherwise("odd"))
    return retrieval.breakdown(per, ["parity"], list(retrieval.METRICS))


@query("SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def benchmark_contamination(spark, sf_dir):
    return retrieval.contains(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "item_id")


@query(rf"""WITH d AS (SELECT doc_id, unnest({SHINGLES.format('w', 8)}) AS g FROM (SELECT doc_id, {TOK.format(FOLD.format('text'))} AS w FROM documents)),
b AS (SELECT item_id, unnest({SHINGLES.format('w', 8)}) AS g FROM (SELECT item_id, {TOK.format(FOLD.format('text'))} AS w FROM benchmark))
SELECT doc_id, item_id, count(*) AS shared FROM d JOIN b USING (g) GROUP BY ALL""")
def shingle_contamination(spark, sf_dir):
    return retrieval.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "item_id")


@query("""WITH p AS (SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(list_transform(a.embedding, lambda x: CAST(x AS DOUBLE)), list_transform(b.embedding, lambda x: CAST(x AS DOUBLE))), 9) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
SELECT query_id, vec_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p QUALIFY rank <= 10""")
def cosine_top10(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    asked = rows.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.dense(rows, asked, "vec_id", "query_id", "embedding").withColumn("score", F.round("score", 6))


_PAIRS = "WITH p AS (SELECT conv_id, turn, text AS prediction, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS reference FROM conversations)"


@query(rf"""{_PAIRS}, w AS (SELECT conv_id, turn, {TOK.format(FOLD.format('prediction'))} AS p, {TOK.format(FOLD.format('reference'))} AS r FROM p WHERE reference IS NOT NULL),
e AS (SELECT conv_id, turn, 'p' AS side, unnest(p) AS x FROM w UNION ALL SELECT conv_id, turn, 'r', unnest(r) FROM w),
m AS (SELECT conv_id, turn, x, least(count_if(side = 'p'), count_if(side = 'r')) AS k FROM e GROUP BY ALL),
o AS (SELECT conv_id, turn, sum(k) AS o FROM m GROUP BY ALL)
SELECT conv_id, turn, round(CASE WHEN len(p) = 0 OR len(r) = 0 THEN CAST(len(p) = len(r) AS DOUBLE) ELSE 2 * coalesce(o, 0) / (len(p) + len(r)) END, 9) AS f1 FROM w LEFT JOIN o USING (conv_id, turn)""")
def turn_token_f1(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("reference", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))).filter("reference is not null")
    return rows.select("conv_id", "turn", F.round(A.token_f1(F.col("text"), F.col("reference")), 9).alias("f1"))


_BEFORE, _AFTER = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def _between(x: str, words: str, by: str) -> str:
    """Whole words replaced, twice, as two of them may share the blank between."""
    for _ in range(2):
        x = f"regexp_replace({x}, '{_BEFORE}({words}){_AFTER}', '\\1{by}\\3', 'g')"
    return x


def _normal(x: str) -> str:
    """An answer as it is compared."""
    bare = f"regexp_replace({FOLD.format(x)}, '[^\\p{{L}}\\p{{N}}_\\s.,/-]', ' ', 'g')"
    return f"trim(regexp_replace({_between(bare, 'a|an|the|bir', ' ')}, '\\s+', ' ', 'g'))"


def _items(x: str) -> str:
    return f"list_distinct(list_filter(list_transform(regexp_split_to_array({_between(x, 'and|ve', ';')}, '[,;]'), lambda y: {_normal('y')}), lambda z: z <> ''))"


def _numbers(x: str) -> str:
    return f"list_transform(regexp_extract_all({x}, '\\b\\d+(?:[.,]\\d+)?\\b'), lambda y: replace(y, ',', '.'))"


@query(rf"""{_PAIRS}, w AS (SELECT conv_id, turn, prediction AS a, reference AS b, {TOK.format(FOLD.format('prediction'))} AS p, {TOK.format(FOLD.format('reference'))} AS r FROM p WHERE reference IS NOT NULL),
e AS (SELECT conv_id, turn, 'p' AS side, unnest(p) AS x FROM w UNION ALL SELECT conv_id, turn, 'r', unnest(r) FROM w), m AS (SELECT conv_id, turn, x, least(count_if(side = 'p'), count_if(side = 'r')) AS k FROM e GROUP BY ALL), o AS (SELECT conv_id, turn, sum(k) AS o FROM m GROUP BY ALL),
f AS (SELECT turn, {_normal('a')} = {_normal('b')} AS same, CASE WHEN len(p) = 0 OR len(r) = 0 THEN CAST(len(p) = len(r) AS DOUBLE) ELSE 2 * coalesce(o, 0) / (len(p) + len(r)) END AS f1, {_numbers('a')} AS na, {_numbers('b')} AS nb, {_items('a')} AS ia, {_items('b')} AS ib FROM w LEFT JOIN o USING (conv_id, turn)),
s AS (SELECT unnest(['exact_match', 'token_f1', 'numeric_date_equivalence', 'list_set_f1']) AS metric, unnest([CAST(same AS DOUBLE), f1, CASE WHEN len(nb) > 0 THEN CAST(na = nb AS DOUBLE) END,
  CASE WHEN turn % 2 = 0 THEN CASE WHEN len(ia) + len(ib) = 0 THEN 0 ELSE 2 * len(list_intersect(ia, ib)) / (len(ia) + len(ib)) END END]) AS v FROM f)
SELECT metric, round(coalesce(avg(v), 0), 6) AS score, count(v) AS items FROM s GROUP BY 1""")
def answer_metrics(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("reference", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))).filter("reference is not null")
    scores = A.answer_scores(F.col("text"), F.array("reference"), F.col("turn") % 2 == 0)
    per = rows.select("conv_id", *(c.alias(n) for n, c in scores.items()))
    stacked = per.select(F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("v")) for n in scores))).alias("m")).select("m.*")
    return stacked.groupBy("metric").agg(F.round(F.coalesce(F.avg("v"), F.lit(0.0)), 6).alias("score"), F.count("v").alias("items"))


@query("""WITH r AS (SELECT doc_id, quality = 1 AS a, toxic = 0 AS b FROM labels), s AS (SELECT 2 * count(*) AS n, count_if(a) + count_if(b) AS y, avg(CAST(a = b AS DOUBLE)) AS o, avg(CAST(a AS DOUBLE)) AS l, avg(CAST(b AS DOUBLE)) AS r, count(*) AS k FROM r),
i AS (SELECT *, (y / n + 3.8416 / (2 * n)) / (1 + 3.8416 / n) AS c, 1.96 * sqrt(y / n * (1 - y / n) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n) AS m, l * r + (1 - l) * (1 - r) AS e FROM s)
SELECT n AS review_rows, k AS reviewed_items, k AS double_reviewed_items, round(y / n, 6) AS rate, round(1 - (c + m), 6) AS error_low, round(1 - (c - m), 6) AS error_high, round((o - e) / (1 - e), 6) AS kappa FROM i""")
def reviewer_agreement(spark, sf_dir):
    rows = table(spark, sf_dir, "labels")
    votes = rows.select("doc_id", F.explode(F.array(F.struct(F.lit("A").alias("slot"), (F.col("quality") == 1).alias("vote")), F.struct(F.lit("B").alias("slot"), (F.col("toxic") == 0).alias("vote")))).alias("v")).select("doc_id", "v.*")
    return sampling.agreement(votes, "doc_id", "slot", "vote")


@query("WITH s AS (SELECT doc_id, lang, source, count(*) OVER (PARTITION BY lang, source) AS n, row_number() OVER (PARTITION BY lang, source ORDER BY sha256('extraction-review:' || doc_id), doc_id) AS r FROM documents) SELECT doc_id, lang, source FROM s WHERE r <= greatest(1, ceil(n * 0.1))")
def extraction_review_sample(spark, sf_dir):
    return sampling.sample_per_stratum(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), ["lang", "source"], "doc_id", 0.1)


@query("""WITH g AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL), a AS (SELECT *, floor(n * 0.15) AS f, ceil(sum(n) OVER () * 0.15) - sum(floor(n * 0.15)) OVER () AS spare, row_number() OVER (ORDER BY n * 0.15::DOUBLE - floor(n * 0.15::DOUBLE) DESC, o_orderstatus, o_orderpriority) AS p FROM g),
t AS (SELECT o_orderstatus, o_orderpriority, f + CASE WHEN p <= spare THEN 1 ELSE 0 END AS take FROM a),
o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY sha256('review:' || o_orderkey), o_orderkey) AS r FROM orders)
SELECT o_orderkey, o.o_orderstatus, o.o_orderpriority, unnest(['A', 'B']) AS reviewer_slot FROM o JOIN t ON o.o_orderstatus = t.o_orderstatus AND o.o_orderpriority = t.o_orderpriority WHERE r <= take""")
def review_sample(spark, sf_dir):
    return sampling.review_sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_orderstatus", "o_orderpriority"], "o_orderkey", 0.15)


@query("""WITH g AS (SELECT c_mktsegment AS key, count(*) / (SELECT count(*) FROM customer) AS w FROM customer GROUP BY 1), a AS (SELECT *, floor(w * 1000) AS f, row_number() OVER (ORDER BY w * 1000 - floor(w * 1000) DESC, key) AS p, 1000 - sum(floor(w * 1000)) OVER () AS spare FROM g)
SELECT key, CAST(f + CASE WHEN p <= spare THEN 1 ELSE 0 END AS BIGINT) AS quota FROM a""")
def segment_quotas(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    weights = rows.groupBy(F.col("c_mktsegment").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    weights = weights.withColumn("w", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))
    return sampling.largest_remainder(weights, "key", "w", 1000).select("key", F.col("quota").cast("long").alias("quota"))


@query()
def quota_plan(spark, sf_dir):
    return sampling.quota_table(spark, _target(table(spark, sf_dir, "documents")))


@query("SELECT o_orderkey, o_orderstatus FROM (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r <= CASE o_orderstatus WHEN 'F' THEN 300 WHEN 'O' THEN 200 ELSE 50 END AND o_orderstatus IN ('F', 'O', 'P')")
def quota_select(spark, sf_dir):
    quotas = spark.createDataFrame([("F", 300), ("O", 200), ("P", 50)], "o_orderstatus string, count long")
    return sampling.quota_select(table(spark, sf_dir, "orders"), quotas, ["o_orderstatus"], ["o_orderdate", "o_orderkey"])[0].select("o_orderkey", "o_orderstatus")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def latest_record(spark, sf_dir):
    return dedup.latest(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS turn FROM part QUALIFY turn <= 5")
def round_robin_candidates(spark, sf_dir):
    return dedup.round_robin(table(spark, sf_dir, "part"), "p_brand", ["p_retailprice", "p_partkey"]).filter("turn <= 5").select("p_partkey", "p_brand", "turn")


@query("SELECT page_id, sha256(html) AS sha256, CASE WHEN starts_with(lower(ltrim(html)), '<!doctype html') OR starts_with(lower(ltrim(html)), '<html') THEN 'text/html' ELSE 'application/octet-stream' END AS mime FROM pages")
def page_checksums(spark, sf_dir):
    content = F.col("html").cast("binary")
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(content, 256).alias("sha256"), T.detect_mime(content, F.lit("page")).alias("mime"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as document records; the planner knows two languages, so all but English count as the second."""
    rows = table(spark, sf_dir, "documents")
    key = F.col("doc_id").cast("string")
    return rows.select(key.alias("document_id"), F.lit("1").alias("document_version"), key.alias("variant_group_id"), F.when(F.col("lang") == "en", "en").otherwise("tr").alias("language"), "text", F.lit("open").alias("rights_state"), F.lit(True).alias("release_qa"), F.lit(True).alias("release_derived_text"))


#: The documents of the tables have no blank lines, so each is one block; word places are running sums of words and what is between.
_CUT = rf"""WITH d AS (SELECT doc_id, lang, text, {TOK.format('text')} AS w, string_split_regex(text, '[\p{{L}}\p{{N}}_]+(?:[''’.-][\p{{L}}\p{{N}}_]+)*') AS g, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines FROM documents),
t AS (SELECT doc_id, unnest(range(0, len(w))) AS i, unnest(w) AS tok, unnest(g[1:len(w)]) AS gap FROM d),
p AS (SELECT doc_id, i, sum(length(gap) + length(tok)) OVER (PARTITION BY doc_id ORDER BY i) AS b, length(tok) AS n FROM t),
e AS (SELECT doc_id, lang, text, len(w) AS n, length(text) - length(ltrim(text, ' ' || chr(9) || chr(10) || chr(13))) AS lo, length(rtrim(text, ' ' || chr(9) || chr(10) || chr(13))) AS hi, len(lines) > 1 AND len(list_filter(lines, lambda x: NOT (starts_with(x, '|') AND ends_with(x, '|')))) = 0 AS piped FROM d WHERE len(lines) > 0),
s AS (SELECT *, CASE WHEN piped THEN 1200 ELSE 900 END AS size FROM e), k AS (SELECT *, 1 + greatest(0, CAST(ceil((n - size) / (size - 80)) AS BIGINT)) AS m FROM s),
c AS (SELECT *, unnest(range(0, m)) AS k FROM k),
r AS (SELECT c.*, CAST(CASE WHEN k = 0 THEN lo ELSE x.b - x.n END AS INTEGER) AS a, CAST(CASE WHEN k = m - 1 THEN hi ELSE y.b END AS INTEGER) AS b, CASE WHEN k = m - 1 THEN c.n - k * (size - 80) ELSE size END AS words
  FROM c LEFT JOIN p x ON x.doc_id = c.doc_id AND x.i = k * (size - 80) LEFT JOIN p y ON y.doc_id = c.doc_id AND y.i = k * (size - 80) + size - 1),
passage AS (SELECT *, sha256(substr(text, a + 1, b - a)) AS checksum FROM r)"""


@query(_CUT + """ SELECT 'passage_' || substr(sha256('["' || doc_id || '","1",' || a || ',' || b || ',"' || checksum || '"]'), 1, 32) AS passage_id, CAST(doc_id AS VARCHAR) AS document_id, '1' AS document_version, CAST(doc_id AS VARCHAR) AS variant_group_id,
CASE WHEN lang = 'en' THEN 'en' ELSE 'tr' END AS language, CAST(NULL AS INTEGER) AS page_number, CASE WHEN piped THEN 'table-1' END AS table_id, a AS canonical_char_start, b AS canonical_char_end, CAST(words AS INTEGER) AS token_count, checksum FROM passage""")
def passage_table(spark, sf_dir):
    return passages.passages(passages.releasable(_documents(spark, sf_dir))).drop("text", "section_path")


@query(_CUT + " SELECT count(*) AS passages, round(coalesce(avg(words), 0), 2) AS average_tokens, CAST(coalesce(max(words), 0) AS INTEGER) AS maximum_tokens, count(CASE WHEN piped THEN 1 END) AS table_passages FROM passage")
def passage_stats(spark, sf_dir):
    return passages.passage_stats(passages.passages(passages.releasable(_documents(spark, sf_dir))))


def _target(docs: DataFrame) -> int:
    """Questions to plan: sixty, and one more for each hundred documents."""
    return 60 + docs.count() // 100


def _candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = passages.releasable(_documents(spark, sf_dir))
    rows = dedup.stored(passages.passages(docs))
    return docs, rows, dedup.stored(passages.evidence_candidates(rows))


@query()
def evidence_candidates(spark, sf_dir):
    # Read from documents to candidates in one go, and only what is asked for is kept.
    found = passages.evidence_candidates(passages.passages(passages.releasable(_documents(spark, sf_dir))))
    return dedup.stored(found.select("anchor_id", "passage_id", "language", F.array_join("compatible_types", ",").alias("types"), "passage_char_start", "passage_char_end", "token_count", F.size("mutation_terms").alias("terms")))


@query()
def candidate_capacity(spark, sf_dir):
    return passages.capacity(_candidates(spark, sf_dir)[2])


@query()
def planned_tasks(spark, sf_dir):
    docs = passages.releasable(_documents(spark, sf_dir))
    found = dedup.stored(passages.evidence_candidates(passages.passages(docs)))  # a plan reads no passage
    return planner.plan_tasks(found, _target(docs), 7, strict=False)[0]


@query()
def validated_questions(spark, sf_dir):
    docs, rows, found = _candidates(spark, sf_dir)
    tasks = planner.plan_tasks(found, _target(docs), 7, strict=False)[0]
    held = questions.validate(questions.generate(tasks, found), rows, docs, found)
    return held.select("qa_id", "question", "primary_type", "question_language", F.array_join("reasons", ",").alias("reasons"))


@query()
def unanswerable_questions(spark, sf_dir):
    docs, rows, found = _candidates(spark, sf_dir)
    tasks = planner.plan_tasks(found, _target(docs), 7, strict=False)[0]
    made = dedup.cut(questions.mutate(tasks, questions.generate(tasks, found), found))
    return made.join(questions.joint_support(made.filter("error is null"), rows), "qa_id", "left").select("qa_id", "question", "mutation_kind", "source_value", "replacement_value", "error", F.array_join("reasons", ",").alias("reasons"))


@query("SELECT event_id, unnest(json_keys(props)) AS path, json_extract_string(props, '$.' || unnest(json_keys(props))) AS value FROM events")
def json_flatten(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.explode(extract.json_leaves(F.col("props"))).alias("path", "value"))


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))")
def rights_closure(spark, sf_dir):
    allowed = spark.createDataFrame([("F",), ("O",)], "o_orderstatus string")
    return registry.all_of(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", allowed)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("SELECT page_id, len(regexp_extract_all(html, '<a ')) AS links, len(regexp_extract_all(html, '<h[1-6][ >]')) AS headings, len(regexp_extract_all(html, '<table')) AS tables FROM pages")
def page_tag_counts(spark, sf_dir):
    n = lambda p: F.regexp_count("html", F.lit(p))
    return table(spark, sf_dir, "pages").select("page_id", n("<a ").alias("links"), n("<h[1-6][ >]").alias("headings"), n("<table").alias("tables"))


@query()
def page_markdown(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), F.lit("text/html").alias("mime"), F.col("html").cast("binary").alias("content"))
    return extract.extract(files).select(F.col("path").cast("long").alias("page_id"), "markdown", F.array_join("kinds", ",").alias("kinds"), "headings_first", "error")


@query("SELECT regexp_replace(regexp_replace(source, '[^A-Za-z0-9_.-]+', '_', 'g'), '^_+|_+$', '', 'g') AS shard, count(*) AS documents FROM documents GROUP BY 1")
def license_shards(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(T.safe_shard(F.col("source")).alias("shard")).agg(F.count(F.lit(1)).alias("documents"))


@query(_BASE + f""", d AS (SELECT *, NOT list_has_any(flags, {_BLOCK}) AS ok FROM c), g AS (SELECT 'accepted_document_count' AS gate, CAST(count_if(ok) AS DOUBLE) AS actual, 500.0 AS threshold FROM d
UNION ALL SELECT 'duplicate_share', count_if(dup IS NOT NULL) / count(*), 0.05 FROM d UNION ALL SELECT 'human_correctness_and_grounding', NULL, 0.95)
SELECT gate, actual, threshold, CASE WHEN actual IS NULL THEN 'not_evaluated' WHEN gate = 'duplicate_share' AND actual <= threshold OR gate <> 'duplicate_share' AND actual >= threshold THEN 'pass' ELSE 'fail' END AS status FROM g""")
def release_gates(spark, sf_dir):
    held = curate.curate(table(spark, sf_dir, "documents")).agg(F.count_if("accepted").cast("double").alias("n"), (F.count_if(F.col("duplicate_of").isNotNull()) / F.count(F.lit(1))).alias("d"))
    rows = held.select(F.explode(F.array(
        F.struct(F.lit("accepted_document_count").alias("gate"), F.col("n").alias("actual"), F.lit(">=").alias("op"), F.lit(500.0).alias("threshold"), F.lit(False).alias("nullable")),
        F.struct(F.lit("duplicate_share").alias("gate"), F.col("d").alias("actual"), F.lit("<=").alias("op"), F.lit(0.05).alias("threshold"), F.lit(False).alias("nullable")),
        F.struct(F.lit("human_correctness_and_grounding").alias("gate"), F.lit(None).cast("double").alias("actual"), F.lit(">=").alias("op"), F.lit(0.95).alias("threshold"), F.lit(True).alias("nullable")),
    )).alias("g")).select("g.*")
    return sampling.gates(rows).select("gate", "actual", "threshold", "status")


@query()
def rejections(spark, sf_dir):
    docs, rows, found = _candidates(spark, sf_dir)
    tasks = planner.plan_tasks(found, _target(docs), 7, strict=False)[0]
    held = questions.validate(questions.generate(tasks, found), rows, docs, found)
    return questions.rejection_breakdown(held.filter(F.size("reasons") > 0))


@query("""WITH h AS (SELECT doc_id, (quality + 1 - toxic) * 2 >= 2 AS h, quality * 2 + (1 - toxic) * 2 - (doc_id % 2) AS score FROM labels), j AS (SELECT score >= 3 AS j, h FROM h),
s AS (SELECT count(*) AS n, avg(CAST(j AS DOUBLE)) AS p, avg(CAST(j = h AS DOUBLE)) AS o, avg(CAST(h AS DOUBLE)) AS r FROM j)
SELECT n AS items, round(p, 6) AS pass_rate, n AS compared, round(o, 6) AS agreement, round((o - (p * r + (1 - p) * (1 - r))) / (1 - (p * r + (1 - p) * (1 - r))), 6) AS kappa FROM s""")
def judge_agreement(spark, sf_dir):
    rows = table(spark, sf_dir, "labels")
    votes = rows.select("doc_id", F.explode(F.array(F.col("quality") == 1, F.col("toxic") == 0)).alias("vote"))
    judged = rows.select("doc_id", (F.col("quality") * 2 + (1 - F.col("toxic")) * 2 - F.col("doc_id") % 2).alias("score"))
    return sampling.judge_report(judged, votes, "doc_id", "score", "vote")


@query("""WITH d AS (SELECT doc_id AS k, lang, text, length(text) AS n FROM documents WHERE text IS NOT NULL)
SELECT k AS doc_id, array_to_string(list_filter([CASE WHEN lang NOT IN ('en', 'tr', 'mul', 'und') THEN 'unknown_language' END, CASE WHEN k % 6 = 5 THEN 'unknown_rights' END, CASE WHEN k % 7 = 0 THEN 'negative_count' END,
  CASE WHEN k % 5 = 0 THEN 'checksum_mismatch' END, CASE WHEN k % 4 = 0 THEN 'char_count_mismatch' END, CASE WHEN k % 9 = 0 THEN 'duplicate_key' END], lambda x: x IS NOT NULL), ',') AS violations, CASE WHEN k % 9 = 0 THEN 2 ELSE 1 END AS times FROM d""")
def document_violations(spark, sf_dir):
    k = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").filter("text is not null").select(
        k.cast("string").alias("document_id"), F.col("lang").alias("language"), F.when(k % 6 == 5, "unclear").otherwise("open").alias("rights_state"), "text", (F.length("text") + F.when(k % 4 == 0, 1).otherwise(0)).cast("long").alias("canonical_char_count"),
        F.when(k % 7 == 0, -1).otherwise(1).cast("long").alias("canonical_token_count"), F.when(k % 5 == 0, "x").otherwise(F.sha2("text", 256)).alias("canonical_sha256"),
    )
    rows = rows.unionByName(rows.filter("cast(document_id as long) % 9 = 0"))
    return records.check(rows, "document", "document_id").groupBy(F.col("document_id").cast("long").alias("doc_id"), F.array_join("violations", ",").alias("violations")).agg(F.count(F.lit(1)).cast("int").alias("times"))
