"""Acquisition without a network: what responses make of a manifest, page discovery, caps, content stores and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import record_version
from .dedup import cut
from .ordered import numbered, running_sum

RESPONSE = "source_id string, url string, status int, version string, source_header string, etag string, last_modified string, content binary, retrieved_at timestamp, error string"
RECORD = ("source_id", "url", "source_version", "sha256", "byte_size", "etag", "last_modified", "retrieved_at")


def apply_responses(known: DataFrame, responses: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, errors) of fetched URLs.  known: earlier records (``RECORD``).

    A body is a new record; not-modified is the last known record at its new time, and an error if nothing is known; a body larger than
    ``limit`` and any other status is an error.
    """
    last = known.groupBy("source_id", "url").agg(F.max_by(F.struct(*RECORD), F.struct("retrieved_at", "sha256")).alias("_last"))
    rows = responses.join(last, ["source_id", "url"], "left")
    large = F.lit(False) if limit is None else F.length("content") > limit
    body = F.col("status").isin(200, 206) & F.col("content").isNotNull()
    reason = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(body & large, "byte_cap_exceeded")
        .when(body, None)
        .when((F.col("status") == 304) & F.col("_last").isNull(), "not_modified_without_record")
        .when(F.col("status") == 304, None)
        .otherwise(F.concat(F.lit("http_"), F.col("status").cast("string")))
    )
    rows = rows.withColumn("_reason", reason)
    digest = F.sha2("content", 256)
    made = F.struct(
        "source_id", "url", record_version("version", "source_header", "etag", "last_modified", digest).alias("source_version"), digest.alias("sha256"),
        F.length("content").cast("long").alias("byte_size"), "etag", "last_modified", "retrieved_at",
    )
    again = F.struct(*(F.col(c if c == "retrieved_at" else f"_last.{c}").alias(c) for c in RECORD))
    records = rows.filter("_reason is null").select(F.when(F.col("status") == 304, again).otherwise(made).alias("r")).select("r.*")
    return records, rows.filter("_reason is not null").select("source_id", "url", F.col("_reason").alias("error"))


def scheduled(urls: DataFrame, host: str, order: str, per_second: float) -> DataFrame:
    """urls with ``wait``: seconds until each may be asked for, so that no host is asked faster than its rate."""
    return numbered(urls, [host], [order], "_n").withColumn("wait", (F.col("_n") - 1) / per_second).drop("_n")


def robots_allowed(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls (host, path) with ``allowed``: by the longest rule (host, prefix, allow) that fits, an allowing one first; without one, yes."""
    hits = urls.join(rules, "host", "left").withColumn("_fits", F.col("path").startswith(F.col("prefix")))
    best = F.max_by("allow", F.when(F.col("_fits"), F.struct(F.length("prefix"), F.col("allow"))))
    return hits.groupBy("host", "path").agg(F.coalesce(best, F.lit(True)).alias("allowed"))


PAGE = "array<struct<pageid:bigint,title:string,missing:boolean,revisions:array<struct<revid:bigint,timestamp:string>>>>"


def pages_of(answers: DataFrame, json: str, base: str) -> DataFrame:
    """page_id, title, revision_id, revised_at, url, permanent_url, history_url of an API's answers; pages without a revision are left out."""
    p = answers.select(F.explode(F.from_json(json, PAGE)).alias("p")).filter(~F.coalesce("p.missing", F.lit(False)) & (F.size("p.revisions") > 0))
    name = F.url_encode(F.replace(F.col("p.title"), F.lit(" "), F.lit("_")))
    last = F.element_at("p.revisions", 1)
    return p.select(
        F.col("p.pageid").alias("page_id"), F.col("p.title").alias("title"), last["revid"].alias("revision_id"), last["timestamp"].alias("revised_at"),
        F.concat(F.lit(f"{base}/wiki/"), name).alias("url"), F.concat(F.lit(f"{base}/w/index.php?oldid="), last["revid"].cast("string")).alias("permanent_url"),
        F.concat(F.lit(f"{base}/w/index.php?title="), name, F.lit("&action=history")).alias("history_url"),
    )


def merge_pages(found: DataFrame, page: str = "page_id", categories: str = "categories", explicit: str = "explicit") -> DataFrame:
    """One row a page: the sorted union of the categories it was found by, and whether it was ever asked for by name."""
    return found.groupBy(page).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set(categories)))).alias(categories), F.bool_or(explicit).alias(explicit))


def discovered(found: DataFrame, excluded: Column, limit: int, category: str = "category", page: str = "page_id", title: str = "title") -> DataFrame:
    """Up to ``limit`` pages, one of each category in turn, explicit ones first; then by title in any case, and id.

    found: page, title, category, explicit.  A page is its first row; excluded ones that were not asked for by name go.
    """
    kept = found.filter(F.col("explicit") | ~F.coalesce(excluded, F.lit(False)))
    placed = kept.withColumns({"_late": ~F.col("explicit"), "_low": F.lower(title)})
    first = numbered(placed, [category], ["_late", "_low", page], "_turn").groupBy(page).agg(F.min_by(F.struct(title, category, "explicit", "_turn"), F.struct(~F.col("explicit"), "_turn", category)).alias("r")).select(page, "r.*")
    best = first.orderBy(~F.col("explicit"), "_turn", category, page).limit(limit)
    return best.drop("_turn").orderBy(F.lower(title), page)


def capped(rows: DataFrame, by: str, order: list[str], size: str, cap: int) -> DataFrame:
    """The rows of each group up to a total size."""
    return running_sum(rows, by, order, size).filter(F.col("total") <= cap)


def batched(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """rows with ``batch``: runs of ``size`` rows in order, from 0."""
    return numbered(rows, [], order, "_n").withColumn("batch", F.floor((F.col("_n") - 1) / size).cast("long")).drop("_n")


def content_path(sha256: Column) -> Column:
    return F.concat(F.substring(sha256, 1, 2), F.lit("/"), sha256)


def store_content(rows: DataFrame, folder: str, content: str = "content") -> DataFrame:
    """Adds contents that the store (sha256, path, content; a Parquet folder) lacks, each once; again with the same rows it adds nothing.

    Returns the store.
    """
    spark = rows.sparkSession
    digest = F.sha2(content, 256)
    fresh = rows.filter(F.col(content).isNotNull()).select(digest.alias("sha256"), content_path(digest).alias("path"), F.col(content).alias("content")).dropDuplicates(["sha256"])
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        fresh = cut(fresh.join(spark.read.parquet(folder).select("sha256"), "sha256", "left_anti"))
    fresh.write.mode("append").parquet(folder)
    return spark.read.parquet(folder)
