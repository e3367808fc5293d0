"""Curation: flags, exact duplicates, acceptance, and quota reports over token shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Flags that keep a document out.
BLOCKING = ("very_short", "encoding_replacement_noise", "detached_heading_run", "excessive_duplicate_lines", "exact_duplicate", "html_boilerplate_remaining", "oversized_document", "possible_personal_data", "current_airline_claim_missing_as_of")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", exact: bool = False) -> DataFrame:
    """docs and duplicate_of: the least key whose normalised text is equal, null for that one itself.

    The owner is found by a grouped minimum (map-side partial results), so no window holds a group of copies.
    """
    hashed = docs.withColumn("content_hash", T.content_hash(F.col(text), exact))
    owner = hashed.groupBy("content_hash").agg(F.min(key).alias("owner"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("content_hash", "owner")
    out = hashed.join(owner, "content_hash", "left")
    return out.withColumn("duplicate_of", F.when(F.col("owner") != F.col(key), F.col("owner"))).drop("owner")


def stale_claim(topics: Column, as_of: Column, text: Column) -> Column:
    return F.array_contains(topics, "airlines") & as_of.isNull() & text.rlike(T.CURRENT_CLAIM)


def accepted(flags: Column) -> Column:
    return ~F.arrays_overlap(flags, F.array(*map(F.lit, BLOCKING)))


def curate(docs: DataFrame, key: str = "doc_id", text: str = "text", exact: bool = False) -> DataFrame:
    """docs with duplicate_of, token count, flags and accepted.  Columns topics and as_of, if there, add the stale-claim flag."""
    body = F.col(text)
    # What a text shows is found where it is read, so a step that asks for no text sends none to the join with its owner.
    shown = [F.when(T.personal_data(body), "possible_personal_data")]
    if {"topics", "as_of"} <= set(docs.columns):
        shown.append(F.when(stale_claim(F.col("topics"), F.col("as_of"), body), "current_airline_claim_missing_as_of"))
    read = docs.withColumn("n_tokens", F.size(T.tokens(body)))
    read = read.withColumn("_quality", T.quality_flags(body, n=F.col("n_tokens"))).withColumn("_shown", F.array_compact(F.array(*shown)))
    held = exact_duplicates(read, key, text, exact)
    copy = F.array_compact(F.array(F.when(F.col("duplicate_of").isNotNull(), "exact_duplicate")))
    return held.withColumn("flags", F.concat("_quality", copy, "_shown")).drop("_quality", "_shown").withColumn("accepted", accepted(F.col("flags")))


def representatives(docs: DataFrame, group: str, tokens: str, key: str) -> DataFrame:
    """The largest document of each group (by tokens, then key)."""
    best = docs.groupBy(group).agg(F.max_by(F.struct("*"), F.struct(tokens, key)).alias("r"))
    return best.select("r.*")


def shares(docs: DataFrame, by: str, tokens: str) -> DataFrame:
    """key, documents, tokens and share (6 places) of the total, 0 where there is nothing."""
    sums = docs.groupBy(F.col(by).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("documents"), F.sum(tokens).alias("tokens"))
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0)))  # one row a key
    return sums.withColumn("share", F.when(total == 0, F.lit(0.0)).otherwise(F.round(F.col("tokens") / total, 6)))


def topic_shares(docs: DataFrame, topics: str, tokens: str) -> DataFrame:
    """As ``shares``, a document's tokens divided evenly among its topics; the total counts each document once."""
    one = docs.select(F.explode(topics).alias("key"), (F.col(tokens) / F.size(topics)).alias("t"))
    total = docs.agg(F.sum(tokens).alias("total"))
    sums = one.groupBy("key").agg(F.sum("t").alias("tokens"))
    return sums.crossJoin(F.broadcast(total)).select("key", "tokens", F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.round(F.col("tokens") / F.col("total"), 6)).alias("share"))


def within_tolerance(share_rows: DataFrame, targets: dict[str, float], tolerance: float = 0.05) -> DataFrame:
    """key, target, share (0 where absent), within: one row a target."""
    spark = share_rows.sparkSession
    want = spark.createDataFrame(list(targets.items()), "key string, target double")
    out = want.join(share_rows.select("key", "share"), "key", "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    return out.withColumn("within", F.abs(F.col("share") - F.col("target")) <= tolerance)


def quota_issues(topics: DataFrame, families: DataFrame, names: list[str], minimum: float = 0.05, cap: float = 0.4) -> DataFrame:
    """code, key, target, actual: topics below the minimum (an absent one has share 0) and families above the cap."""
    spark = topics.sparkSession
    want = spark.createDataFrame([(n,) for n in names], "key string")
    low = want.join(topics, "key", "left").select(F.lit("topic_minimum").alias("code"), "key", F.lit(minimum).alias("target"), F.coalesce("share", F.lit(0.0)).alias("actual")).filter(F.col("actual") < minimum)
    high = families.filter(F.col("share") > cap).select(F.lit("source_family_cap").alias("code"), "key", F.lit(cap).alias("target"), F.col("share").alias("actual"))
    return low.unionByName(high)


def decade(day: Column) -> Column:
    return F.when(day.isNull(), "unknown").otherwise(F.concat((F.floor(F.year(day) / 10) * 10).cast("string"), F.lit("s")))


def summary(docs: DataFrame, by: str = "lang") -> DataFrame:
    """Documents, accepted ones, tokens and share of accepted tokens by a column."""
    held = curate(docs)
    sums = held.groupBy(by).agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if("accepted").alias("accepted"),
        F.count_if(F.col("duplicate_of").isNotNull()).alias("duplicates"),
        F.sum("n_tokens").alias("tokens"),
        F.coalesce(F.sum(F.when(F.col("accepted"), F.col("n_tokens"))), F.lit(0)).alias("accepted_tokens"),
    )
    total = F.sum("accepted_tokens").over(Window.partitionBy(F.lit(0)))
    return sums.withColumn("share", F.when(total == 0, F.lit(0.0)).otherwise(F.round(F.col("accepted_tokens") / total, 6)))
