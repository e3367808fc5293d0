"""Source registry audit and rights closure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RIGHTS = "struct<state:string,license_id:string,license_url:string,terms_url:string,attribution:string,release_source:boolean,release_derived_text:boolean,release_qa:boolean>"
SOURCE = f"source_id string, adapter string, enabled boolean, seed_urls array<string>, has_mediawiki boolean, extraction_profile string, rights {RIGHTS}"
ADAPTERS = ("file", "direct", "local_glob", "mediawiki_api")


def audit(sources: DataFrame, contact: str) -> DataFrame:
    """severity, source_id, code: every rule that a source breaks, in one pass over the registry."""
    r, wiki = F.col("rights"), F.col("adapter") == "mediawiki_api"
    seeds = F.coalesce("seed_urls", F.expr("cast(array() as array<string>)"))
    released = r["release_source"] | r["release_derived_text"] | r["release_qa"]
    rules: list[tuple[str, Column]] = [
        ("adapter_not_implemented", F.col("enabled") & ~F.col("adapter").isin(*ADAPTERS)),
        ("blocked_enabled", F.col("enabled") & (r["state"] == "blocked")),
        ("inconsistent_open_rights", (r["state"] == "open") & ~(r["release_source"] & r["release_derived_text"])),
        ("restricted_release_flag", (r["state"] != "open") & released),
        ("missing_seed", F.col("enabled") & (F.size(seeds) == 0)),
        ("missing_mediawiki_config", wiki & ~F.col("has_mediawiki")),
        ("invalid_mediawiki_endpoint_count", wiki & (F.size(seeds) != 1)),
        ("missing_mediawiki_extraction_profile", wiki & (F.coalesce("extraction_profile", F.lit("")) != "mediawiki_article_v1")),
        ("unexpected_mediawiki_config", ~wiki & F.col("has_mediawiki")),
        ("incomplete_rights_evidence", F.exists(F.array(r["license_url"], r["terms_url"], r["attribution"]), lambda x: F.coalesce(x, F.lit("")) == "")),
    ]
    unsafe = F.when(F.col("adapter") == "local_glob", F.transform(F.filter(seeds, lambda s: s.startswith("/") | F.array_contains(F.split(s, "/"), "..")), lambda s: F.lit("unsafe_local_glob")))
    codes = F.concat(F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), code) for code, c in rules))), F.coalesce(unsafe, F.expr("cast(array() as array<string>)")))
    out = sources.select(F.lit("error").alias("severity"), "source_id", F.explode(codes).alias("code"))
    if "replace-with" in contact.casefold() or contact.casefold().endswith("@example.org"):
        out = out.unionByName(sources.sparkSession.createDataFrame([("warning", "_project", "placeholder_contact")], out.schema))
    return out


def release(documents: DataFrame, sources: DataFrame, passages: DataFrame, questions: DataFrame) -> dict[str, DataFrame]:
    """The public part of each table, and ``violations`` (kind, id), which must be empty.

    A document is public if its state is open and both flags allow it; its source must agree.  A question is public if all its
    documents are; its quotes must then be public too.
    """
    open_docs = documents.filter((F.col("rights_state") == "open") & F.col("release_derived_text") & F.col("release_qa"))
    joined = open_docs.join(sources.select(F.col("source_record_id"), F.col("rights").alias("_r")), "source_record_id", "left")
    consistent = F.coalesce((F.col("_r.state") == "open") & F.col("_r.release_source") & F.col("_r.release_derived_text"), F.lit(False))
    wrong = joined.filter(~consistent).select(F.when(F.col("_r").isNull(), "source_missing").otherwise("inconsistent_open_rights").alias("kind"), F.col("document_id").alias("id"))
    public = passages.join(open_docs.select("document_id"), "document_id", "left_semi")
    cited = questions.select("qa_id", F.explode("source_document_ids").alias("document_id"))
    closed = cited.join(open_docs.select("document_id"), "document_id", "left_anti").select("qa_id").distinct()
    open_qa = questions.join(closed, "qa_id", "left_anti")
    quotes = open_qa.select("qa_id", F.explode("evidence").alias("e")).select("qa_id", F.col("e.passage_id").alias("passage_id"))
    lost = quotes.join(public.select("passage_id"), "passage_id", "left_anti").select(F.lit("evidence_not_public").alias("kind"), F.col("qa_id").alias("id"))
    return {"sources": sources.join(open_docs.select("source_record_id"), "source_record_id", "left_semi"), "documents": open_docs, "passages": public, "questions": open_qa, "violations": wrong.unionByName(lost)}


def all_of(rows: DataFrame, key: str, member: str, allowed: DataFrame) -> DataFrame:
    """Keys all of whose members are allowed (relational division)."""
    missed = rows.join(allowed.select(member), member, "left_anti").select(key).distinct()
    return rows.select(key).distinct().join(missed, key, "left_anti")


def category_matches(categories: Column, titles: list[str], patterns: list[str]) -> Column:
    """Whether a page's categories hold one of the titles (any case, prefix and underscores aside) or match a pattern."""
    fold = lambda c: F.lower(F.trim(F.regexp_replace(F.regexp_replace(c, "_", " "), r"(?i)^(?:category|kategori):", "")))
    wanted = [t.replace("_", " ").strip().casefold() for t in titles]
    return F.exists(categories, lambda c: fold(c).isin(*wanted) if wanted else F.lit(False)) | (F.exists(categories, lambda c: c.rlike("|".join(f"(?:{p})" for p in patterns))) if patterns else F.lit(False))
