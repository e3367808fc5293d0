"""Registered queries of sources, acquisition, releases, reviews and question checks, each with its DuckDB counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import answers as A
from ..functions import text as T
from ..operators import acquire, curate, dedup, passages, planner, questions, registry, report, retrieval, sampling
from ..sources import registry_file, tables
from ..streaming import ingest
from .catalog import FOLD, SHINGLES, TOK, query, table


def folder(spark: SparkSession, tag: str) -> str:
    """A new folder that driver and executors share."""
    import uuid

    dedup.shared(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{tag}-{uuid.uuid4().hex}"


# ---- record files -------------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def jsonl_records(spark, sf_dir):
    path = folder(spark, "jsonl")
    tables.write_records(table(spark, sf_dir, "customer"), path)
    return tables.read_records(spark, path, "c_custkey long, c_name string, c_mktsegment string, c_acctbal double")


@query("SELECT CAST(conv_id AS VARCHAR) || '-' || turn AS qa_id, 'en' AS question_language, role AS primary_type, 'd' || conv_id || '|d' || turn AS source_document_ids FROM conversations")
def qa_csv(spark, sf_dir):
    key = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    rows = table(spark, sf_dir, "conversations").select(
        key.alias("qa_id"), F.regexp_replace("text", r"\s+", " ").alias("question"), F.lit("x").alias("answer"), F.lit("en").alias("question_language"), F.col("role").alias("primary_type"), F.lit("answerable").alias("answerability"),
        F.lit("y").alias("reference_answer"), F.lit("train").alias("split"), F.array(F.concat(F.lit("d"), F.col("conv_id").cast("string")), F.concat(F.lit("d"), F.col("turn").cast("string"))).alias("source_document_ids"), F.lit("not exported").alias("more"),
    )
    path = folder(spark, "qa-csv")
    tables.write_qa_csv(rows, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == list(tables.QA_CSV)
    return back.select("qa_id", "question_language", "primary_type", "source_document_ids")


@query("SELECT regexp_replace(regexp_replace(source, '[^A-Za-z0-9_.-]+', '_', 'g'), '^_+|_+$', '', 'g') AS shard, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1")
def license_folders(spark, sf_dir):
    path = folder(spark, "shards")
    tables.write_shards(table(spark, sf_dir, "documents"), path, "source")
    return spark.read.parquet(path).groupBy(F.col("shard").cast("string").alias("shard")).agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("chars"))


@query("""WITH o AS (SELECT user_id, ts, value, 0 AS fresh FROM events WHERE event_id % 2 = 0 UNION ALL SELECT user_id, ts, value + 1, 1 FROM events WHERE event_id % 3 = 0)
SELECT user_id, max(ts) AS ts, round(arg_max(value, (ts, fresh, value)), 6) AS value FROM o GROUP BY user_id""")
def manifest_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.struct("ts", "value").alias("at"), "value", "ts")
    old, new = rows.filter("event_id % 2 = 0").drop("event_id"), rows.filter("event_id % 3 = 0").drop("event_id").withColumn("value", F.col("value") + 1)
    return tables.merge_manifest(old, new, "user_id", "ts").select("user_id", "ts", F.round("value", 6).alias("value"))


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders a WHERE o_orderkey % 2 = 1 AND NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_orderkey % 2 = 0 AND b.o_custkey = a.o_custkey AND b.o_orderpriority = a.o_orderpriority)")
def new_versions(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return tables.new_versions(rows.filter("o_orderkey % 2 = 1"), rows.filter("o_orderkey % 2 = 0"), ("o_custkey", "o_orderpriority")).select("o_orderkey", "o_custkey", "o_orderpriority")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def promoted_version(spark, sf_dir):
    base, rows = folder(spark, "versions"), table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    for version, region in (("v1", 0), ("v2", 1)):
        tables.promote(rows.filter(F.col("n_regionkey") == region).drop("n_regionkey"), base, version, f"{base}/pointers")
    return tables.current(spark, f"{base}/pointers", base)


@query("""SELECT event_id, coalesce(CASE WHEN event_id % 5 = 0 THEN event_type END, CASE WHEN event_id % 5 = 1 THEN 'h' || user_id END, CASE WHEN event_id % 5 = 2 THEN 'e' || user_id END, substr(sha256(props), 1, 16)) AS version FROM events""")
def record_versions(spark, sf_dir):
    k = F.col("event_id") % 5
    rows = table(spark, sf_dir, "events").select("event_id", F.when(k == 0, F.col("event_type")).otherwise("").alias("a"), F.when(k == 1, F.concat(F.lit("h"), "user_id")).alias("b"), F.when(k == 2, F.concat(F.lit("e"), "user_id")).otherwise("").alias("c"), F.lit(None).cast("string").alias("d"), F.sha2("props", 256).alias("sha"))
    return rows.select("event_id", tables.record_version("a", "b", "c", "d", F.col("sha")).alias("version"))


# ---- acquisition --------------------------------------------------------------------------------------------------------------


def _responses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "events").withColumn("url", F.concat(F.lit("u"), F.col("user_id").cast("string"))).withColumn("k", F.col("event_id") % 7)
    none = F.lit(None).cast("string")
    body = F.concat("event_type", F.lit(":"), "props")
    known = rows.filter("event_id % 4 = 0").select(F.lit("s").alias("source_id"), "url", F.lit("v0").alias("source_version"), F.sha2(body, 256).alias("sha256"), F.length(body).cast("long").alias("byte_size"), none.alias("etag"), none.alias("last_modified"), F.col("ts").alias("retrieved_at"))
    status = F.when(F.col("k") < 3, 200).when(F.col("k") < 5, 304).when(F.col("k") == 5, 404).otherwise(503)
    got = rows.filter("event_id % 4 = 1").select(F.lit("s").alias("source_id"), "url", status.alias("status"), none.alias("version"), none.alias("source_header"), F.concat(F.lit("t"), F.col("k").cast("string")).alias("etag"), none.alias("last_modified"), body.cast("binary").alias("content"), F.col("ts").alias("retrieved_at"), F.when((F.col("k") == 6) & (F.col("value") > 50), "timeout").alias("error"))
    return known, got


_FETCH = """WITH k AS (SELECT 'u' || user_id AS url, sha256(event_type || ':' || props) AS sha, length(event_type || ':' || props) AS size, ts FROM events WHERE event_id % 4 = 0),
l AS (SELECT url, arg_max(sha, (ts, sha)) AS sha, arg_max(size, (ts, sha)) AS size FROM k GROUP BY url),
g AS (SELECT 'u' || user_id AS url, event_type || ':' || props AS body, ts, event_id % 7 AS k, value FROM events WHERE event_id % 4 = 1),
j AS (SELECT g.*, l.sha, l.size, CASE WHEN k = 6 AND value > 50 THEN 'timeout' WHEN k < 3 AND length(body) > 15 THEN 'byte_cap_exceeded' WHEN k < 3 THEN NULL WHEN k < 5 AND l.url IS NULL THEN 'not_modified_without_record' WHEN k < 5 THEN NULL WHEN k = 5 THEN 'http_404' ELSE 'http_503' END AS reason FROM g LEFT JOIN l ON l.url = g.url)"""


@query(_FETCH + " SELECT url, CASE WHEN k < 3 THEN 't' || k ELSE 'v0' END AS source_version, CASE WHEN k < 3 THEN sha256(body) ELSE sha END AS sha256, CAST(CASE WHEN k < 3 THEN length(body) ELSE size END AS BIGINT) AS byte_size, ts AS retrieved_at FROM j WHERE reason IS NULL")
def fetched_records(spark, sf_dir):
    return acquire.apply_responses(*_responses(spark, sf_dir), 15)[0].select("url", "source_version", "sha256", "byte_size", "retrieved_at")


@query(_FETCH + " SELECT reason AS error, count(*) AS n FROM j WHERE reason IS NOT NULL GROUP BY 1")
def fetch_errors(spark, sf_dir):
    return acquire.apply_responses(*_responses(spark, sf_dir), 15)[1].groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_custkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) / 0.5 AS wait FROM orders")
def host_schedule(spark, sf_dir):
    return acquire.scheduled(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey", 0.5)


_RULES = [("Brand#1", "/e", False), ("Brand#1", "/economy/a", True), ("Brand#2", "/", False), ("Brand#2", "/p", True), ("Brand#3", "/promo", False)]


@query("""WITH r(host, prefix, allow) AS (VALUES ('Brand#1', '/e', false), ('Brand#1', '/economy/a', true), ('Brand#2', '/', false), ('Brand#2', '/p', true), ('Brand#3', '/promo', false)),
u AS (SELECT DISTINCT substr(p_brand, 1, 7) AS host, '/' || lower(replace(p_type, ' ', '/')) AS path FROM part)
SELECT u.host, path, coalesce(arg_max(allow, (length(prefix), allow)) FILTER (starts_with(path, prefix)), true) AS allowed FROM u LEFT JOIN r ON r.host = u.host GROUP BY ALL""")
def robots(spark, sf_dir):
    urls = table(spark, sf_dir, "part").select(F.substring("p_brand", 1, 7).alias("host"), F.concat(F.lit("/"), F.lower(F.replace(F.col("p_type"), F.lit(" "), F.lit("/")))).alias("path")).distinct()
    return acquire.robots_allowed(urls, spark.createDataFrame(_RULES, "host string, prefix string, allow boolean"))


@query("SELECT user_id, array_to_string(list_sort(list_distinct(list(event_type))), ',') AS types, bool_or(value > 99) AS explicit FROM events GROUP BY user_id")
def merged_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.array("event_type").alias("types"), (F.col("value") > 99).alias("explicit"))
    return acquire.merge_pages(rows, "user_id", "types").select("user_id", F.array_join("types", ",").alias("types"), "explicit")


@query("SELECT p_partkey AS page_id, p_name AS title, p_partkey * 10 AS revision_id, 'https://x.example/w/index.php?oldid=' || p_partkey * 10 AS permanent_url FROM part WHERE p_partkey % 5 NOT IN (0, 1)")
def api_pages(spark, sf_dir):
    k = F.col("p_partkey")
    revisions = F.when(k % 5 == 1, F.array()).otherwise(F.array(F.struct((k * 10).alias("revid"), F.lit("2024-01-01").alias("timestamp"))))
    page = F.struct(k.alias("pageid"), F.col("p_name").alias("title"), F.when(k % 5 == 0, True).alias("missing"), revisions.alias("revisions"))
    answers = table(spark, sf_dir, "part").withColumn("p", page).groupBy(F.col("p_partkey") % 40).agg(F.to_json(F.collect_list("p")).alias("json"))
    return acquire.pages_of(answers, "json", "https://x.example").select("page_id", "title", "revision_id", "permanent_url")


@query("""WITH f AS (SELECT p_partkey AS page_id, p_name AS title, p_brand AS category, p_partkey % 97 = 0 AS explicit FROM part WHERE p_partkey % 97 = 0 OR p_size <> 7),
t AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY explicit DESC, lower(title), page_id) AS turn FROM f),
k AS (SELECT * FROM t ORDER BY explicit DESC, turn, category, page_id LIMIT 60) SELECT page_id, title, category, explicit FROM k""")
def discovered_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("category"), (F.col("p_partkey") % 97 == 0).alias("explicit"), "p_size")
    return acquire.discovered(rows, F.col("p_size") == 7, 60).select("page_id", "title", "category", "explicit")


@query("SELECT doc_id, source, CAST(total AS BIGINT) AS total FROM (SELECT doc_id, source, sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS total FROM documents) WHERE total <= 20000")
def byte_capped_documents(spark, sf_dir):
    return acquire.capped(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "source", ["doc_id"], "n_chars", 20000).select("doc_id", "source", F.col("total").cast("long").alias("total"))


@query("SELECT vec_id, CAST((row_number() OVER (ORDER BY vec_id) - 1) // 64 AS BIGINT) AS batch FROM embeddings")
def embedding_batches(spark, sf_dir):
    return acquire.batched(table(spark, sf_dir, "embeddings").select("vec_id"), ["vec_id"], 64)


@query("SELECT DISTINCT sha256(p_brand || p_type) AS sha256, substr(sha256(p_brand || p_type), 1, 2) || '/' || sha256(p_brand || p_type) AS path, CAST(length(p_brand || p_type) AS INTEGER) AS size FROM part")
def content_store(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.concat("p_brand", "p_type").cast("binary").alias("content"), "p_partkey")
    path = folder(spark, "contents")
    acquire.store_content(rows.filter("p_partkey % 2 = 0"), path)
    return acquire.store_content(rows, path).select("sha256", "path", F.length("content").alias("size"))


@query("SELECT p_partkey FROM part WHERE lower(replace(p_brand, '#', ' ')) IN ('brand 12', 'brand 34') OR regexp_matches(p_type, '^PROMO.*(TIN|STEEL)$')")
def category_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.array(F.concat(F.lit("Category:"), F.replace(F.col("p_brand"), F.lit("#"), F.lit("_"))), "p_type").alias("c"))
    return rows.filter(registry.category_matches(F.col("c"), ["brand 12", "Brand_34"], ["^PROMO.*(TIN|STEEL)$"])).select("p_partkey")


# ---- registry and releases ----------------------------------------------------------------------------------------------------


@query("""SELECT source, count(*) AS records, CASE WHEN source IN (SELECT source FROM documents GROUP BY 1 ORDER BY 1 LIMIT 7) THEN NULL ELSE 'source_not_registered' END AS error FROM documents GROUP BY 1""")
def registered_records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_id"))
    names = docs.select("source_id").distinct().orderBy("source_id").limit(7)  # the registry of this query: seven sources
    known, errors = registry_file.with_sources(docs, names.withColumn("adapter", F.lit("file")))
    rows = known.select("source_id", F.lit(None).cast("string").alias("error")).unionByName(errors.select("source_id", "error"))
    return rows.groupBy(F.col("source_id").alias("source"), "error").agg(F.count(F.lit(1)).alias("records"))


@query("""WITH s AS (SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN 'blocked' WHEN 1 THEN 'manifest_only' ELSE 'open' END AS state, s_suppkey % 3 > 0 AS rs, s_suppkey % 5 > 0 AS rd, s_suppkey % 2 = 0 AS rq,
  ['file', 'direct', 'local_glob', 'mediawiki_api', 'ftp'][s_suppkey % 5 + 1] AS adapter, s_suppkey % 7 > 0 AS enabled, s_suppkey % 6 AS n, s_suppkey % 11 = 0 AS wiki, CASE WHEN s_suppkey % 13 = 0 THEN '' ELSE 'u' END AS url FROM supplier),
c AS (SELECT k, unnest(list_filter([
  CASE WHEN enabled AND adapter = 'ftp' THEN 'adapter_not_implemented' END, CASE WHEN enabled AND state = 'blocked' THEN 'blocked_enabled' END,
  CASE WHEN state = 'open' AND NOT (rs AND rd) THEN 'inconsistent_open_rights' END, CASE WHEN state <> 'open' AND (rs OR rd OR rq) THEN 'restricted_release_flag' END,
  CASE WHEN enabled AND n = 0 THEN 'missing_seed' END, CASE WHEN adapter = 'mediawiki_api' AND NOT wiki THEN 'missing_mediawiki_config' END,
  CASE WHEN adapter = 'mediawiki_api' AND n <> 1 THEN 'invalid_mediawiki_endpoint_count' END, CASE WHEN adapter = 'mediawiki_api' THEN 'missing_mediawiki_extraction_profile' END,
  CASE WHEN adapter <> 'mediawiki_api' AND wiki THEN 'unexpected_mediawiki_config' END, CASE WHEN url = '' THEN 'incomplete_rights_evidence' END], lambda x: x IS NOT NULL)) AS code FROM s
  UNION ALL SELECT k, 'unsafe_local_glob' FROM s, range(n) r(i) WHERE adapter = 'local_glob' AND i % 2 = 1)
SELECT 'error' AS severity, 's' || k AS source_id, code FROM c UNION ALL SELECT 'warning', '_project', 'placeholder_contact'""")
def registry_audit(spark, sf_dir):
    k = F.col("s_suppkey")
    state = F.when(k % 4 == 0, "blocked").when(k % 4 == 1, "manifest_only").otherwise("open")
    adapters = F.array(*map(F.lit, ("file", "direct", "local_glob", "mediawiki_api", "ftp")))
    seeds = F.transform(F.slice(F.sequence(F.lit(0), F.lit(9)), 1, (k % 6).cast("int")), lambda i: F.when(i % 2 == 1, F.concat(F.lit("../"), i.cast("string"))).otherwise(F.concat(F.lit("files/"), i.cast("string"))))
    rights = F.struct(state.alias("state"), F.lit("CC").alias("license_id"), F.when(k % 13 == 0, "").otherwise("u").alias("license_url"), F.lit("t").alias("terms_url"), F.lit("a").alias("attribution"), (k % 3 > 0).alias("release_source"), (k % 5 > 0).alias("release_derived_text"), (k % 2 == 0).alias("release_qa"))
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), k.cast("string")).alias("source_id"), F.element_at(adapters, (k % 5 + 1).cast("int")).alias("adapter"), (k % 7 > 0).alias("enabled"), seeds.alias("seed_urls"), (k % 11 == 0).alias("has_mediawiki"), F.lit(None).cast("string").alias("extraction_profile"), rights.alias("rights"))
    return registry.audit(rows, "replace-with@me")


@query("""WITH s AS (SELECT source, source <> (SELECT min(source) FROM documents) AS ok FROM documents GROUP BY 1 HAVING source <> (SELECT max(source) FROM documents)),
d AS (SELECT doc_id, source, doc_id % 5 <> 0 AND doc_id % 7 <> 0 AS open FROM documents),
p AS (SELECT doc_id FROM labels), q AS (SELECT DISTINCT conv_id, conv_id % (SELECT count(*) FROM documents) AS a, (conv_id * 3 + 1) % (SELECT count(*) FROM documents) AS b FROM conversations),
pub AS (SELECT doc_id FROM p JOIN d USING (doc_id) WHERE open), oq AS (SELECT * FROM q WHERE a IN (SELECT doc_id FROM d WHERE open) AND b IN (SELECT doc_id FROM d WHERE open))
SELECT 'documents' AS part, count(*) AS n FROM d WHERE open UNION ALL SELECT 'passages', count(*) FROM pub UNION ALL SELECT 'questions', count(*) FROM oq
UNION ALL SELECT 'sources', count(*) FROM s WHERE source IN (SELECT source FROM d WHERE open)
UNION ALL SELECT 'source_missing', count(*) FROM d WHERE open AND source NOT IN (SELECT source FROM s)
UNION ALL SELECT 'inconsistent_open_rights', count(*) FROM d WHERE open AND source IN (SELECT source FROM s WHERE NOT ok)
UNION ALL SELECT 'evidence_not_public', count(*) FROM oq WHERE a NOT IN (SELECT doc_id FROM pub)""")
def public_release(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.col("source").alias("source_record_id"), F.when(F.col("doc_id") % 5 == 0, "blocked").otherwise("open").alias("rights_state"), (F.col("doc_id") % 7 != 0).alias("release_derived_text"), F.lit(True).alias("release_qa"))
    ends = docs.agg(F.min("source_record_id").alias("lo"), F.max("source_record_id").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    state = F.when(F.col("source_record_id") == ends.lo, "manifest_only").otherwise("open")
    sources = docs.filter(F.col("source_record_id") != ends.hi).select("source_record_id").distinct().withColumn("rights", F.struct(state.alias("state"), F.lit(True).alias("release_source"), F.lit(True).alias("release_derived_text")))
    own = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("passage_id"), F.col("doc_id").alias("document_id"))
    a, b = F.col("conv_id") % ends.n, (F.col("conv_id") * 3 + 1) % ends.n
    asked = table(spark, sf_dir, "conversations").select("conv_id").distinct().select(F.col("conv_id").alias("qa_id"), F.array(a, b).alias("source_document_ids"), F.array(F.struct(a.alias("passage_id"))).alias("evidence"))
    out = registry.release(docs, sources, own, asked)
    counts = [out[k].agg(F.lit(k).alias("part"), F.count(F.lit(1)).alias("n")) for k in ("documents", "passages", "questions", "sources")]
    kinds = spark.createDataFrame([("source_missing",), ("inconsistent_open_rights",), ("evidence_not_public",)], "kind string")
    counts.append(kinds.join(out["violations"], "kind", "left").groupBy(F.col("kind").alias("part")).agg(F.count("id").alias("n")))
    rows = counts[0]
    for c in counts[1:]:
        rows = rows.unionByName(c)
    return rows


@query("SELECT l.doc_id AS passage_id FROM labels l JOIN documents d USING (doc_id) WHERE d.doc_id % 5 <> 0 AND d.doc_id % 3 > 0 AND d.lang IN ('en', 'fr')")
def eligible_passages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.when(F.col("doc_id") % 5 == 0, "blocked").otherwise("open").alias("rights_state"), F.lit(True).alias("release_derived_text"), F.lit(True).alias("release_qa"), F.col("lang").alias("language"), (F.col("doc_id") % 3 > 0).alias("accepted"))
    rows = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("passage_id"), F.col("doc_id").alias("document_id"))
    return passages.eligible(rows, docs, ("en", "fr")).select("passage_id")


@query("SELECT o_orderstatus AS status, count_if(c_custkey IS NULL) AS stale, count(*) AS rows FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') c ON c_custkey = o_custkey GROUP BY 1")
def stale_reviews(spark, sf_dir):
    live = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return report.stale(table(spark, sf_dir, "orders"), live, ["o_custkey"], "o_orderstatus").withColumnRenamed("o_orderstatus", "status")


@query("""WITH d AS (SELECT o_custkey, o_orderstatus, CASE WHEN o_orderkey % 3 > 0 THEN 1 ELSE 0 END - CASE WHEN o_orderkey % 4 > 0 THEN 1 ELSE 0 END AS x FROM orders), g AS (SELECT sum(x) AS x FROM d GROUP BY o_custkey, o_orderstatus)
SELECT CAST(sum(greatest(x, 0)) AS BIGINT) AS missing, CAST(sum(greatest(-x, 0)) AS BIGINT) AS extra FROM g""")
def review_multisets(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return report.reviews_match(rows.filter("o_orderkey % 3 > 0"), rows.filter("o_orderkey % 4 > 0"), ["o_custkey", "o_orderstatus"])


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 1 THEN 'blocked' ELSE 'manifest_only' END AS state, count(l_orderkey) AS objects, coalesce(string_agg(l_orderkey || ':' || l_linenumber, ',' ORDER BY l_orderkey, l_linenumber), '') AS listed
FROM supplier LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 49) ON l_suppkey = s_suppkey WHERE s_suppkey % 3 > 0 GROUP BY ALL""")
def restricted_objects(spark, sf_dir):
    sources = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, "open").when(F.col("s_suppkey") % 3 == 1, "blocked").otherwise("manifest_only").alias("state"))
    objects = table(spark, sf_dir, "lineitem").filter("l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey"), "l_orderkey", "l_linenumber")
    out = report.restricted_manifest(sources, objects, "s_suppkey", "state", ["l_orderkey", "l_linenumber"])
    return out.select("s_suppkey", "state", F.size("objects").cast("long").alias("objects"), F.array_join(F.transform("objects", lambda o: F.concat(o["l_orderkey"].cast("string"), F.lit(":"), o["l_linenumber"].cast("string"))), ",").alias("listed"))


@query("""WITH f AS (SELECT count_if(quality = 1) AS n, avg(CAST(regexp_matches(sha256(CAST(doc_id AS VARCHAR)), '^[a-f0-9]{64}$') AND doc_id % 50 <> 3 AS DOUBLE)) AS c, avg(CAST(doc_id % 20 <> 0 AS DOUBLE)) AS e FROM labels)
SELECT gate, CAST(actual AS DOUBLE) AS actual, CAST(threshold AS DOUBLE) AS threshold, status FROM f, LATERAL (VALUES
  ('schema_and_checksum_coverage', round(c, 6), 1.0, CASE WHEN round(c, 6) = 1 THEN 'pass' ELSE 'fail' END), ('accepted_document_count', CAST(n AS DOUBLE), 500.0, CASE WHEN n >= 500 THEN 'pass' ELSE 'fail' END),
  ('usable_extraction_manual_sample', NULL, 0.95, 'not_evaluated'), ('structured_generation_success', 1.0, 0.99, 'pass'), ('accepted_qa_count', CAST(n AS DOUBLE), 1500.0, CASE WHEN n = 1500 THEN 'pass' ELSE 'fail' END),
  ('exact_evidence_offset_validity', round(e, 6), 1.0, CASE WHEN round(e, 6) = 1 THEN 'pass' ELSE 'fail' END), ('production_tokenizer_pinned', 1.0, 1.0, 'pass'), ('topic_and_releasable_source_family_gates', 2.0, 0.0, 'fail'),
  ('qa_balance_quotas', 0.0, 0.0, 'pass'), ('double_review_complete', NULL, 1.0, 'fail'), ('airline_cohort_frozen', NULL, 1.0, 'fail'), ('human_correctness_and_grounding', NULL, 0.95, 'not_evaluated'), ('reviewer_agreement_kappa', 0.8, 0.7, 'pass')) g(gate, actual, threshold, status)""")
def pilot_gates(spark, sf_dir):
    rows = table(spark, sf_dir, "labels")
    digest = F.when(F.col("doc_id") % 50 == 3, "none").otherwise(F.sha2(F.col("doc_id").cast("string"), 256))
    reasons = F.when(F.col("doc_id") % 20 == 0, F.array(F.lit("evidence_checksum_mismatch"))).otherwise(F.array(F.lit("unsupported_name")))
    facts = rows.agg(F.count_if(F.col("quality") == 1).alias("accepted_document_count")).crossJoin(report.coverage(rows.select(digest.alias("d")), "d")).crossJoin(report.evidence_validity(rows.select(reasons.alias("reasons"))))
    facts = facts.withColumns({"accepted_qa_count": F.col("accepted_document_count"), "structured_generation_success": F.lit(1.0), "production_tokenizer_pinned": F.lit(report.pinned("0" * 40)), "topic_and_releasable_source_family_gates": F.lit(2), "qa_balance_quotas": F.lit(0), "reviewer_agreement_kappa": F.lit(0.8)})
    return report.gate_rows(facts)


@query("SELECT o_orderstatus, o_orderpriority, CAST(5000 AS BIGINT) AS count, least(n, 5000) AS actual, 5000 - least(n, 5000) AS deficit FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) WHERE n < 5000")
def stratum_deficits(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    quotas = rows.select("o_orderstatus", "o_orderpriority").distinct().withColumn("count", F.lit(5000).cast("long"))
    return sampling.quota_select(rows, quotas, ["o_orderstatus", "o_orderpriority"], ["o_orderkey"])[2]


# ---- texts and answers --------------------------------------------------------------------------------------------------------


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[ \t]+(\n|$)', '\1', 'g'), ' ' || chr(9) || chr(10) || chr(13)) || chr(10) AS text FROM documents")
def normalized_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("text"))


@query("""SELECT c_custkey, 'cust_' || substr(sha256('["' || c_name || '",' || c_custkey || ',"' || c_mktsegment || '"]'), 1, 24) AS id FROM customer""")
def stable_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", T.stable_id("cust", F.col("c_name"), F.col("c_custkey"), F.col("c_mktsegment")).alias("id"))


@query(r"""WITH t AS (SELECT event_id, event_type || ' 12.5 and 7,25 on ' || strftime(ts, '%Y-%m-%d') || ' or 31.02.2024; ' || strftime(ts, '%-d/%-m/%Y') || ' ' || user_id AS t FROM events)
SELECT event_id, array_to_string(list_transform(regexp_extract_all(t, '\b\d+(?:[.,]\d+)?\b'), lambda x: replace(x, ',', '.')), ' ') AS numbers,
  array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(t, '\b(?:\d{4}-\d{2}-\d{2}|\d{1,2}[./]\d{1,2}[./]\d{4})\b'), lambda x: strftime(coalesce(try_strptime(x, '%Y-%m-%d'), try_strptime(x, '%d/%m/%Y'), try_strptime(x, '%d.%m.%Y')), '%Y-%m-%d')), lambda x: x IS NOT NULL))), ' ') AS dates FROM t""")
def numbers_and_dates(spark, sf_dir):
    t = F.concat("event_type", F.lit(" 12.5 and 7,25 on "), F.date_format("ts", "yyyy-MM-dd"), F.lit(" or 31.02.2024; "), F.date_format("ts", "d/M/yyyy"), F.lit(" "), F.col("user_id").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", t.alias("t"))
    return rows.select("event_id", F.array_join(A.numbers(F.col("t")), " ").alias("numbers"), F.array_join(F.transform(A.dates(F.col("t")), lambda d: d.cast("string")), " ").alias("dates"))


_STOP = "[" + ", ".join(f"'{w}'" for w in questions.STOPWORDS) + "]"


@query(rf"""WITH u AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations),
w AS (SELECT conv_id, turn, list_distinct(list_filter({TOK.format(FOLD.format('text'))}, lambda x: NOT list_contains({_STOP}, x) AND length(x) > 2)) AS q, {TOK.format(FOLD.format('answer'))} AS a FROM u WHERE answer IS NOT NULL)
SELECT conv_id, turn, round(CASE WHEN len(q) = 0 THEN 0 ELSE len(list_filter(q, lambda x: list_contains(a, x))) / len(q) END, 9) AS support FROM w""")
def lexical_support(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("answer", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))).filter("answer is not null")
    return rows.select("conv_id", "turn", F.round(questions.lexical_support(F.col("text"), F.col("answer")), 9).alias("support"))


_TRQ = " + ".join(f"CAST(list_contains(w, '{x}') AS INTEGER)" for x in questions.TURKISH_ASKS)
_ENQ = " + ".join(f"CAST(list_contains(w, '{x}') AS INTEGER)" for x in questions.ENGLISH_ASKS)
_TRL = " + ".join(f"length(t) - length(replace(t, '{c}', ''))" for c in T.TURKISH_LETTERS)


@query(rf"""WITH d AS (SELECT doc_id, lang, {FOLD.format('text')} AS t FROM documents), e AS (SELECT *, regexp_extract_all(t, '[\p{{L}}\p{{M}}\p{{N}}_]+') AS w FROM d), s AS (SELECT doc_id, lang, {_TRQ} + {_TRL} AS tr, {_ENQ} AS en FROM e)
SELECT doc_id, en >= tr AS is_english, tr >= en AS is_turkish FROM s""")
def language_matches(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", questions.language_matches(t, F.lit("en")).alias("is_english"), questions.language_matches(t, F.lit("tr")).alias("is_turkish"))


@query(rf"""WITH b AS (SELECT item_id, ' ' || array_to_string({TOK.format(FOLD.format('text'))}[1:6], ' ') || ' ' AS n FROM benchmark), d AS (SELECT doc_id, ' ' || array_to_string({TOK.format(FOLD.format('text'))}, ' ') || ' ' AS h FROM documents)
SELECT item_id, count(doc_id) AS documents FROM b LEFT JOIN d ON contains(h, n) GROUP BY 1""")
def token_sequences(spark, sf_dir):
    spaced = lambda w: F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
    items = table(spark, sf_dir, "benchmark").select("item_id", spaced(F.slice(T.normalized_tokens(F.col("text")), 1, 6)).alias("text"))
    docs = table(spark, sf_dir, "documents").select("doc_id", spaced(T.normalized_tokens(F.col("text"))).alias("text"))
    hits = retrieval.contains(docs, items, "doc_id", "item_id", width=2)
    return items.select("item_id").join(hits, "item_id", "left").groupBy("item_id").agg(F.count("doc_id").alias("documents"))


@query(f"WITH d AS (SELECT doc_id, len({TOK.format('text')}) AS n, CASE doc_id % 3 WHEN 0 THEN ['a'] WHEN 1 THEN ['a', 'b'] ELSE ['b', 'c', 'd'] END AS topics FROM documents) SELECT k AS key, round(sum(n / len(topics)) / (SELECT sum(n) FROM d), 6) AS share FROM (SELECT unnest(topics) AS k, n, topics FROM d) GROUP BY 1")
def fractional_topics(spark, sf_dir):
    topics = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("a"))).when(F.col("doc_id") % 3 == 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b"), F.lit("c"), F.lit("d")))
    docs = table(spark, sf_dir, "documents").select(F.size(T.tokens(F.col("text"))).alias("n"), topics.alias("topics"))
    return curate.topic_shares(docs, "topics", "n").select("key", "share")


@query(r"SELECT doc_id FROM documents WHERE doc_id % 2 = 0 AND doc_id % 3 > 0 AND regexp_matches(text || CASE WHEN doc_id % 5 = 0 THEN ' the current fleet' ELSE '' END, '(?i)(^|[^\p{L}\p{M}\p{N}_])(current|fleet|filo|mevcut|güncel)($|[^\p{L}\p{M}\p{N}_])')")
def stale_claims(spark, sf_dir):
    k = F.col("doc_id")
    topics, as_of = F.when(k % 2 == 0, F.array(F.lit("airlines"))).otherwise(F.array(F.lit("airports"))), F.when(k % 3 == 0, F.lit("2024-01-01")).cast("date")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.when(k % 5 == 0, " the current fleet").otherwise("")).alias("text"), topics.alias("topics"), as_of.alias("as_of"))
    return curate.curate(docs).filter(F.array_contains("flags", "current_airline_claim_missing_as_of")).select("doc_id")


# ---- questions ----------------------------------------------------------------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, kinds = F.col("event_id"), F.array(*map(F.lit, ("factual", "temporal", "list_table", "definition", "comparison")))
    kind = F.element_at(kinds, (k % 5 + 1).cast("int"))
    items = F.slice(F.array(F.col("event_type"), F.lit("b  c"), F.lit("d")), 1, (k % 4).cast("int"))
    joined = F.array_join(items, "; ")
    answer = F.when(k % 7 == 0, "other").when(F.size(items) == 0, F.lit("free text")).otherwise(joined)
    return table(spark, sf_dir, "events").select("event_id", kind.alias("primary_type"), items.alias("answer_items"), answer.alias("answer"), F.when(k % 3 == 0, "free text").otherwise(answer).alias("reference_answer"), F.when(k % 6 == 0, F.array()).when(k % 6 == 1, F.array(F.lit(" "))).otherwise(F.array(F.lit("r"))).alias("rubric"), F.when(k % 8 == 0, F.array(F.lit("x"))).otherwise(questions.joined_variants(items)).alias("acceptable_variants"), F.when(k % 11 == 0, "corpus_unanswerable").otherwise("answerable").alias("answerability"))


@query("""WITH e AS (SELECT event_id AS k, ['factual', 'temporal', 'list_table', 'definition', 'comparison'][event_id % 5 + 1] AS kind, [event_type, 'b  c', 'd'][1:event_id % 4] AS items FROM events),
a AS (SELECT *, CASE WHEN k % 7 = 0 THEN 'other' WHEN len(items) = 0 THEN 'free text' ELSE array_to_string(items, '; ') END AS answer FROM e), b AS (SELECT *, CASE WHEN k % 3 = 0 THEN 'free text' ELSE answer END AS ref, kind IN ('factual', 'temporal') AS single, kind = 'list_table' AS listed FROM a)
SELECT k AS event_id, CASE WHEN k % 11 = 0 THEN '' ELSE array_to_string(list_filter([
  CASE WHEN single AND NOT (len(items) = 1 AND answer = items[1]) THEN 'closed_single_item_contract' END, CASE WHEN listed AND (len(items) = 0 OR answer <> array_to_string(items, '; ')) THEN 'list_answer_items_contract' END,
  CASE WHEN NOT single AND NOT listed AND len(items) > 0 THEN 'explanatory_answer_items_not_empty' END, CASE WHEN NOT single AND NOT listed AND answer <> ref THEN 'explanatory_answer_reference_mismatch' END,
  CASE WHEN NOT single AND NOT listed AND k % 6 <= 1 THEN 'explanatory_rubric_missing' END, CASE WHEN k % 8 = 0 THEN 'non_deterministic_acceptable_variants' END], lambda x: x IS NOT NULL), ',') END AS reasons FROM b""")
def type_contracts(spark, sf_dir):
    return _records(spark, sf_dir).select("event_id", F.array_join(questions.contract_reasons(), ",").alias("reasons"))


@query("""WITH e AS (SELECT doc_id, doc_id % 4 AS k, 5 + doc_id % 6 AS lo, text FROM documents WHERE length(text) > 60),
q AS (SELECT *, substr(text, CAST(lo + CASE WHEN k = 1 THEN 1 ELSE 0 END + 1 AS INTEGER), 30) AS quote FROM e)
SELECT doc_id, array_to_string(list_filter(CASE WHEN doc_id % 9 = 0 THEN ['evidence_passage_missing'] ELSE [
  CASE WHEN doc_id % 10 = 0 THEN 'evidence_document_mismatch' END, CASE WHEN quote <> substr(text, CAST(lo + 1 AS INTEGER), 30) THEN 'passage_evidence_offset_mismatch' END,
  CASE WHEN quote <> substr(text, CAST(lo + 1 AS INTEGER), 30) THEN 'canonical_evidence_offset_mismatch' END, CASE WHEN k = 2 THEN 'evidence_checksum_mismatch' END, CASE WHEN doc_id % 5 = 0 THEN 'evidence_not_publicly_releasable' END,
  CASE WHEN doc_id % 6 = 0 OR quote <> substr(text, CAST(lo + 1 AS INTEGER), 30) THEN 'evidence_anchor_not_generation_candidate' WHEN doc_id % 7 = 0 THEN 'evidence_anchor_type_incompatible' END] END, lambda x: x IS NOT NULL), ',') AS reasons FROM q""")
def evidence_checks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter(F.length("text") > 60).select("doc_id", "text", (F.lit(5) + F.col("doc_id") % 6).cast("int").alias("lo"), (F.col("doc_id") % 4).alias("k"))
    key, lo = F.col("doc_id").cast("string"), F.col("lo")
    quote = F.substring(F.col("text"), lo + F.when(F.col("k") == 1, 1).otherwise(0) + 1, F.lit(30))
    digest = F.when(F.col("k") == 2, "none").otherwise(F.sha2(quote, 256))
    e = F.struct(key.alias("passage_id"), key.alias("document_id"), lo.alias("passage_char_start"), (lo + 30).alias("passage_char_end"), lo.alias("canonical_char_start"), (lo + 30).alias("canonical_char_end"), quote.alias("quote"), digest.alias("quote_sha256"))
    rows = docs.select(key.alias("qa_id"), F.lit("factual").alias("primary_type"), F.array(e).alias("evidence"))
    held = docs.filter("doc_id % 9 <> 0").select(key.alias("passage_id"), F.when(F.col("doc_id") % 10 == 0, "none").otherwise(key).alias("document_id"), "text")
    known = docs.select(key.alias("document_id"), "text", F.when(F.col("doc_id") % 5 == 0, "blocked").otherwise("open").alias("rights_state"), F.lit(True).alias("release_qa"), F.lit(True).alias("release_derived_text"))
    found = docs.filter("doc_id % 6 <> 0").select(key.alias("passage_id"), lo.alias("passage_char_start"), (lo + 30).alias("passage_char_end"), F.substring(F.col("text"), lo + 1, F.lit(30)).alias("anchor_text"), F.array(F.when(F.col("doc_id") % 7 == 0, "temporal").otherwise("factual")).alias("compatible_types"))
    return questions.evidence_reasons(rows, held, known, found).select(F.col("qa_id").cast("long").alias("doc_id"), F.array_join("reasons", ",").alias("reasons"))


@query("""WITH c AS (SELECT c_custkey AS a, c_nationkey AS d, c_name || ' of ' || c_mktsegment AS t, [c_mktsegment, CAST(c_custkey % 50 AS VARCHAR)] AS terms FROM customer),
p AS (SELECT *, 't' || a AS task FROM c WHERE a <= 40), s AS (SELECT task, d, lower(t) AS t, unnest(terms) AS source, unnest([0, 1]) AS pos, unnest(['entity', 'number']) AS kind FROM p),
o AS (SELECT a, d, unnest(terms) AS value, unnest(['entity', 'number']) AS kind FROM c),
j AS (SELECT s.task, pos, s.kind, source, value, o.d, sha256('mutation-donor:7:' || task || ':' || source || ':' || value || ':' || o.a) AS h FROM s JOIN o ON o.kind = s.kind AND o.d <> s.d AND lower(value) <> lower(source) AND NOT contains(s.t, lower(value))),
b AS (SELECT task, pos, kind, source, arg_min(value, h) AS value, arg_min(d, h) AS donor FROM j GROUP BY ALL)
SELECT task AS task_id, arg_min(kind, pos) AS kind, arg_min(source, pos) AS source, arg_min(value, pos) AS value, CAST(arg_min(donor, pos) AS VARCHAR) AS donor_document_id FROM b GROUP BY 1""")
def mutation_donors(spark, sf_dir):
    terms = F.array(F.struct(F.lit("entity").alias("kind"), F.col("c_mktsegment").alias("value")), F.struct(F.lit("number").alias("kind"), (F.col("c_custkey") % 50).cast("string").alias("value")))
    found = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("anchor_id"), F.col("c_nationkey").cast("string").alias("document_id"), F.concat("c_name", F.lit(" of "), "c_mktsegment").alias("anchor_text"), terms.alias("mutation_terms"))
    parents = found.filter("cast(anchor_id as int) <= 40").select(F.concat(F.lit("t"), "anchor_id").alias("task_id"), "anchor_id")  # a plan's tasks
    return planner.donors(found, parents, 7).select("task_id", "kind", "source", "value", "donor_document_id")


_SIG = "CASE WHEN len(s) = 0 THEN '0000000000000000' ELSE list_min(list_transform(s, lambda x: sha256({0} || ':' || x)[1:16])) END"
QDUP = rf"""WITH RECURSIVE q0 AS (SELECT conv_id * 1000 + turn AS key, {TOK.format(FOLD.format('text'))} AS w, trim(regexp_replace({FOLD.format('text')}, '\s+', ' ', 'g')) AS h FROM conversations WHERE role = 'user'),
q AS (SELECT key, h, {SHINGLES.format('w', 3)} AS s FROM q0), sg AS (SELECT key, h, s, [{', '.join(_SIG.format(i) for i in range(16))}] AS v FROM q),
b AS (SELECT key, unnest([0, 1, 2, 3]) AS band, unnest([v[1:4], v[5:8], v[9:12], v[13:16]]) AS sig FROM sg),
cand AS (SELECT DISTINCT x.key AS a, y.key AS b FROM b x JOIN b y ON x.band = y.band AND x.sig = y.sig AND x.key < y.key),
j AS (SELECT a, b, len(list_intersect(x.s, y.s)) AS i, len(x.s) AS n, len(y.s) AS m, x.h = y.h AS same FROM cand JOIN sg x ON x.key = a JOIN sg y ON y.key = b),
e AS (SELECT a, b, same FROM j WHERE same OR CASE WHEN n + m - i = 0 THEN 1 ELSE i / (n + m - i) END >= 0.9),
n AS (SELECT key, row_number() OVER (ORDER BY key) AS r, coalesce((SELECT list(a) FROM e WHERE e.b = q.key), []) AS near FROM q),
go(r, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT n.r, CASE WHEN len(list_intersect(kept, near)) > 0 THEN kept ELSE list_append(kept, key) END FROM go JOIN n ON n.r = go.r + 1),
fin AS (SELECT kept FROM go ORDER BY r DESC LIMIT 1),
reasons AS (SELECT q.key, CASE WHEN list_contains((SELECT kept FROM fin), q.key) THEN NULL WHEN EXISTS (SELECT 1 FROM e WHERE e.b = q.key AND same AND list_contains((SELECT kept FROM fin), e.a)) THEN 'duplicate_question' ELSE 'near_duplicate_question' END AS reason FROM q)"""


@query(QDUP + " SELECT key, reason FROM reasons")
def question_duplicates(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").filter("role = 'user'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("key"), "text")
    return dedup.question_filter(rows)


@query(QDUP + """, v AS (SELECT key, key // 1000 % 3 AS g, reason FROM reasons WHERE key % 10 <> 4), f AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY key) AS k FROM v WHERE reason IS NULL)
SELECT 'accepted' AS part, count(*) AS n, CAST(sum(key) AS BIGINT) AS keys FROM f WHERE k <= 40 UNION ALL SELECT 'overflow', count(*), CAST(coalesce(sum(key), 0) AS BIGINT) FROM f WHERE k > 40 UNION ALL SELECT 'rejected', count(*), CAST(coalesce(sum(key), 0) AS BIGINT) FROM (SELECT key FROM v WHERE reason IS NOT NULL)""")
def settled_questions(spark, sf_dir):
    key = F.col("conv_id") * 1000 + F.col("turn")
    rows = table(spark, sf_dir, "conversations").filter("role = 'user'").withColumn("key", key).filter("key % 10 <> 4")
    judged = rows.select(F.lpad(F.col("key").cast("string"), 12, "0").alias("qa_id"), F.col("text").alias("question"), F.expr("cast(array() as array<string>)").alias("reasons"), (F.floor(F.col("key") / 1000) % 3).alias("g"))
    order = judged.select("qa_id", F.col("qa_id").cast("long").alias("task_index"))
    quotas = spark.createDataFrame([(i, 40) for i in range(3)], "g long, count long")
    parts = questions.settle(judged, order, quotas, ["g"])
    out = [parts[p].agg(F.lit(p).alias("part"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("qa_id").cast("long")), F.lit(0)).alias("keys")) for p in ("accepted", "overflow", "rejected")]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("""WITH RECURSIVE d AS (SELECT doc_id, 'variant:' || lang || '-' || doc_id AS v FROM documents), c AS (SELECT 'q' || doc_id // 3 AS qa, doc_id FROM labels),
h AS (SELECT qa, min(doc_id) AS doc_id FROM c GROUP BY qa), f AS (SELECT qa, v AS first FROM h JOIN d USING (doc_id)), e AS (SELECT first AS a, v AS b FROM c JOIN d USING (doc_id) JOIN f USING (qa)),
k AS (SELECT a, b FROM e UNION SELECT b, a FROM e UNION SELECT v, v FROM d), r(a, b) AS (SELECT a, b FROM k UNION SELECT r.a, k.b FROM r JOIN k ON r.b = k.a),
g AS (SELECT a, 'splitgroup_' || substr(sha256('["' || string_agg(b, '","' ORDER BY b) || '"]'), 1, 24) AS id FROM (SELECT DISTINCT a, b FROM r) GROUP BY a), o AS (SELECT qa AS qa_id, id AS split_group_id, CAST('0x' || sha256(id)[1:8] AS BIGINT) % 100 AS m FROM f JOIN g ON g.a = f.first)
SELECT qa_id, split_group_id, CASE WHEN m < 70 THEN 'train' WHEN m < 85 THEN 'validation' ELSE 'test' END AS split FROM o""")
def split_components(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.concat("lang", F.lit("-"), F.col("doc_id").cast("string")).alias("variant_group_id"), F.lit(None).cast("string").alias("entity_group_id"))
    cited = table(spark, sf_dir, "labels").select(F.concat(F.lit("q"), (F.floor(F.col("doc_id") / 3)).cast("string")).alias("qa_id"), F.col("doc_id").cast("string").alias("document_id"), F.col("doc_id").alias("position"))
    return dedup.split_components(docs, cited)


# ---- streaming ----------------------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT user_id, event_type FROM events")
def streamed_records(spark, sf_dir):
    base = folder(spark, "stream")
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").alias("retrieved_at"))
    for part in (0, 1):
        rows.filter(F.pmod(F.col("user_id"), F.lit(2)) >= part).write.mode("append").json(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).json(f"{base}/in")
        ingest.append(stream, f"{base}/table", f"{base}/checkpoint", ("user_id", "event_type")).awaitTermination()
    return spark.read.parquet(f"{base}/table").select("user_id", "event_type")


@query("SELECT date_trunc('hour', ts) AS hour, event_type AS source_id, count(*) AS records, CAST(sum(length(props)) AS BIGINT) AS bytes FROM events GROUP BY ALL")
def hourly_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("ts").alias("retrieved_at"), F.col("event_type").alias("source_id"), F.length("props").cast("long").alias("byte_size"))
    return ingest.counts(rows).select(F.col("window.start").alias("hour"), "source_id", "records", "bytes")
