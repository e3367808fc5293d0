"""Record schemas and their integrity rules as arrays of violations, so that bad rows are rows, not exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Members of the closed sets.
RIGHTS_STATES = ("open", "manifest_only", "blocked")
LANGUAGES = ("en", "tr", "mul", "und")
TYPES = ("factual", "definition", "list_table", "comparison", "temporal")
SHA256 = "^[a-f0-9]{64}$"

SPAN = "struct<passage_id:string,document_id:string,passage_char_start:int,passage_char_end:int,canonical_char_start:int,canonical_char_end:int,quote:string,quote_sha256:string>"
SCHEMAS = {
    "source": "source_record_id string, registry_source_id string, canonical_url string, source_version string, sha256 string, byte_size bigint, detected_mime string, native_format string, title string, languages array<string>, topics array<string>, rights_state string, retrieved_at timestamp, snapshot_date date",
    "document": "document_id string, document_version string, variant_group_id string, entity_group_id string, title string, language string, topics array<string>, as_of date, publisher string, source_family string, authority_level string, source_record_id string, native_format string, license_id string, rights_state string, release_derived_text boolean, release_qa boolean, text string, canonical_sha256 string, canonical_char_count bigint, canonical_token_count bigint, quality_flags array<string>, duplicate_of string, accepted boolean",
    "passage": "passage_id string, document_id string, document_version string, variant_group_id string, language string, section_path array<string>, page_number int, table_id string, canonical_char_start int, canonical_char_end int, text string, token_count int, checksum string",
    "question": f"qa_id string, question string, answer string, answer_items array<string>, reference_answer string, rubric array<string>, question_language string, evidence_languages array<string>, cross_lingual boolean, primary_type string, answerability string, evidence array<{SPAN}>, acceptable_variants array<string>, provenance_passage_ids array<string>, source_document_ids array<string>, split_group_id string",
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def export(name: str) -> dict:
    """The schema as JSON."""
    return schema(name).jsonValue()


def _empty(column: str) -> Column:
    return F.coalesce(F.size(column), F.lit(0)) <= 0


def _rules(name: str) -> dict[str, Column]:
    """code -> condition that holds for a bad row."""
    c = F.col
    if name == "source":
        return {"bad_sha256": ~c("sha256").rlike(SHA256), "negative_size": c("byte_size") < 0, "unknown_rights": ~c("rights_state").isin(*RIGHTS_STATES)}
    if name == "document":
        return {
            "unknown_language": ~c("language").isin(*LANGUAGES),
            "unknown_rights": ~c("rights_state").isin(*RIGHTS_STATES),
            "negative_count": (c("canonical_char_count") < 0) | (c("canonical_token_count") < 0),
            "checksum_mismatch": F.sha2("text", 256) != c("canonical_sha256"),
            "char_count_mismatch": F.length("text") != c("canonical_char_count"),
        }
    if name == "passage":
        return {"bad_offsets": c("canonical_char_end") <= c("canonical_char_start"), "length_mismatch": c("canonical_char_end") - c("canonical_char_start") != F.length("text"), "checksum_mismatch": F.sha2("text", 256) != c("checksum")}
    answered, kind = c("answerability") == "answerable", c("primary_type")
    closed = kind.isin("factual", "temporal", "list_table")
    foreign = F.exists("evidence_languages", lambda x: x != c("question_language"))
    return {
        "unknown_type": ~kind.isin(*TYPES),
        "span_length_mismatch": F.exists("evidence", lambda e: (e["passage_char_end"] - e["passage_char_start"] != F.length(e["quote"])) | (e["canonical_char_end"] - e["canonical_char_start"] != F.length(e["quote"]))),
        "answer_missing": answered & c("answer").isNull(),
        "evidence_missing": answered & _empty("evidence"),
        "single_item_expected": answered & kind.isin("factual", "temporal") & ~((F.size("answer_items") == 1) & c("answer").eqNullSafe(F.get("answer_items", F.lit(0)))),
        "joined_items_expected": answered & (kind == "list_table") & (_empty("answer_items") | ~c("answer").eqNullSafe(F.array_join("answer_items", "; "))),
        "reference_expected": answered & ~closed & (~_empty("answer_items") | ~c("answer").eqNullSafe(c("reference_answer")) | _empty("rubric")),
        "unanswerable_holds_answer": ~answered & (c("answer").isNotNull() | ~_empty("evidence") | ~_empty("answer_items") | ~_empty("acceptable_variants") | ~_empty("provenance_passage_ids") | ~_empty("source_document_ids")),
        "cross_lingual_mismatch": answered & (c("cross_lingual") != foreign),
    }


def check(rows: DataFrame, name: str, key: str | None = None) -> DataFrame:
    """rows with violations: the codes of every rule broken; with a key also ``duplicate_key``."""
    codes = [F.when(F.coalesce(bad, F.lit(False)), code) for code, bad in _rules(name).items()]
    if key:
        many = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        rows = rows.join(many, key, "left")
        codes.append(F.when(F.col("_n").isNotNull(), "duplicate_key"))
    out = rows.withColumn("violations", F.array_compact(F.array(*codes)))
    return out.drop("_n") if key else out
