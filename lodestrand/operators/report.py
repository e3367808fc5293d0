"""The release report: thirteen gates over counts, stale rows, and what may not be published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sampling

# Gate, comparison, threshold, and whether a gate without a value waits (else it fails).
GATES = (
    ("schema_and_checksum_coverage", "==", 1.0, False),
    ("accepted_document_count", ">=", 500.0, False),
    ("usable_extraction_manual_sample", ">=", 0.95, True),
    ("structured_generation_success", ">=", 0.99, False),
    ("accepted_qa_count", "==", 1500.0, False),
    ("exact_evidence_offset_validity", "==", 1.0, False),
    ("production_tokenizer_pinned", "==", 1.0, False),
    ("topic_and_releasable_source_family_gates", "==", 0.0, False),
    ("qa_balance_quotas", "==", 0.0, False),
    ("double_review_complete", "==", 1.0, False),
    ("airline_cohort_frozen", "==", 1.0, False),
    ("human_correctness_and_grounding", ">=", 0.95, True),
    ("reviewer_agreement_kappa", ">=", 0.70, True),
)
EVIDENCE_ERRORS = ("evidence_passage_missing", "evidence_document_missing", "evidence_document_mismatch", "passage_evidence_offset_mismatch", "canonical_evidence_offset_mismatch", "evidence_checksum_mismatch")
SHA256, REVISION = "^[a-f0-9]{64}$", "^[a-f0-9]{40}$"


def gate_rows(facts: DataFrame) -> DataFrame:
    """gate, actual, threshold, status of the thirteen gates.  facts: one row, a column a gate (yes and no as booleans); absent ones have no value."""
    value = {c: F.col(c).cast("double") for c in facts.columns}
    gates = [
        F.struct(F.lit(g).alias("gate"), F.round(value.get(g, F.lit(None).cast("double")), 6).alias("actual"), F.lit(op).alias("op"), F.lit(t).alias("threshold"), F.lit(waits).alias("nullable"))
        for g, op, t, waits in GATES
    ]
    return sampling.gates(facts.select(F.explode(F.array(*gates)).alias("g")).select("g.*")).select("gate", "actual", "threshold", "status")


def coverage(rows: DataFrame, checksum: str) -> DataFrame:
    """schema_and_checksum_coverage: the share of rows with a well-formed checksum (0 without rows)."""
    return rows.agg(F.coalesce(F.avg(F.coalesce(F.col(checksum).rlike(SHA256), F.lit(False)).cast("double")), F.lit(0.0)).alias("schema_and_checksum_coverage"))


def pinned(revision: str) -> bool:
    """Whether a model's revision is a commit and not a moving name."""
    import re

    return re.fullmatch(REVISION, revision) is not None


def evidence_validity(questions: DataFrame) -> DataFrame:
    """exact_evidence_offset_validity: one minus the share of questions (qa_id, reasons) with an evidence fault."""
    bad = F.arrays_overlap("reasons", F.array(*map(F.lit, EVIDENCE_ERRORS)))
    return questions.agg(F.coalesce(1 - F.avg(bad.cast("double")), F.lit(0.0)).alias("exact_evidence_offset_validity"))


def stale(rows: DataFrame, current: DataFrame, keys: list[str], by: str) -> DataFrame:
    """by, stale, rows: how many rows refer to what is no longer there."""
    live = current.select(*keys).distinct().withColumn("_live", F.lit(True))
    return rows.join(live, keys, "left").groupBy(by).agg(F.count_if(F.col("_live").isNull()).alias("stale"), F.count(F.lit(1)).alias("rows"))


def reviews_match(assigned: DataFrame, submitted: DataFrame, keys: list[str]) -> DataFrame:
    """missing, extra: assigned rows that were not submitted as often, and the other way round (multisets)."""
    both = assigned.select(*keys, F.lit(1).alias("_d")).unionAll(submitted.select(*keys, F.lit(-1).alias("_d"))).groupBy(*keys).agg(F.sum("_d").alias("_d"))
    return both.agg(F.coalesce(F.sum(F.greatest("_d", F.lit(0))), F.lit(0)).alias("missing"), F.coalesce(F.sum(F.greatest(-F.col("_d"), F.lit(0))), F.lit(0)).alias("extra"))


def restricted_manifest(sources: DataFrame, objects: DataFrame, key: str, state: str, fields: list[str]) -> DataFrame:
    """key, state, objects: every source that is not open, with what was fetched of it (an empty list for nothing), in order.

    A source's objects are one row's list; ``fields`` are a few short columns of each.
    """
    held = objects.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("objects"))
    out = sources.filter(F.col(state) != "open").select(key, state).join(held, key, "left")
    return out.withColumn("objects", F.coalesce("objects", F.filter(F.array(F.struct(*(F.lit(None).cast(objects.schema[f].dataType).alias(f) for f in fields))), lambda x: F.lit(False))))
