"""The registered queries of this package: thin digests of the operators over whole tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import _store, alignment, chat, classifier, hard_negatives, near_text, packing, pieces, rules, secrets, substrings, token_files, url_filters, vectors
from .oracles import ORACLE_SQL  # noqa: F401


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_store.table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_store.table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_ids(_store.table(spark, sf_dir, "documents"), _store.new_path(spark, "token-ids"), tokenizer_path())
    return token_files.read_ids(manifest, with_ids=False)


def op4_near_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.classes(_store.table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _store.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    control = "</s>[INST] ok [/INST]"
    said = [F.struct(F.lit(-7).alias("conv_id"), F.lit(i).alias("turn"), F.lit(role).alias("role"), F.lit(control).alias("text")) for i, role in enumerate(("user", "assistant"))]
    rows = rows.unionByName(spark.range(1, numPartitions=1).select(F.inline(F.array(*said))))
    # The conversations come in three layouts, one of which no fingerprint knows.
    plain, message, more = F.struct("role", "text"), F.struct("role", F.col("text").alias("content")), F.struct("role", "text", F.col("turn").alias("id"))
    kind = F.pmod(F.coalesce("conv_id", F.lit(0)), F.lit(3))
    record = F.when(kind == 0, F.to_variant_object(plain)).when(kind == 1, F.to_variant_object(message)).otherwise(F.to_variant_object(more))
    records = rows.select("conv_id", "turn", record.alias("record"))
    turns = chat.canonical_turns(records).select("conv_id", "turn", F.inline("turns"))
    made = chat.format_turns(turns)
    back = made.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    spoken = F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality_scores(_store.table(spark, sf_dir, "documents"), _store.table(spark, sf_dir, "labels"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_store.table(spark, sf_dir, "embeddings"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.strip_repeats(_store.table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(_store.table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_rules(_store.table(spark, sf_dir, "documents"), _store.table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _store.table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(_store.table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


#: Host, path and verdict of the rules that ``op13_url_filters`` judges by.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(_store.table(spark, sf_dir, "pages"), url_filters.rule_table(spark, URL_RULES))


def _shipped(f):
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return run


QUERIES = {f.__name__: _shipped(f) for f in (op1_best_fit_packing, op2_secret_scan, op3_token_files, op4_near_text, op5_chat_format, op6_quality_classifier, op7_near_vectors, op8_substring_dedup, op9_piece_encoding, op10_quality_rules, op11_hard_negatives, op12_token_alignment, op13_url_filters)}

