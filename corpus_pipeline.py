"""A corpus through the training-data operators: classify, remove near copies, remove repeated passages, redact, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared folder and
reads it again as the next stage's documents; the one before is removed then.  All stages but the last return the columns of ``documents``.

Defined results: a null text is empty for every decision; texts of any length are taken whole; rows without a doc_id are documents, before
all others in order; rows that repeat a doc_id are separate documents, but rows that repeat doc_id and text are one from
the near-duplicate stage on; a document whose every word is a repeat goes with them; ties between near copies fall to the least
doc_id; an empty table gives no row; further columns of documents pass through, whatever their names, as far as the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrand.llm import _store, classifier, near_text, packing, secrets, substrings
from lodestrand.llm.queries import tokenizer_path
from lodestrand.session import ship

#: Documents that score below this go.
QUALITY = 0.5
#: Chunks that the tokenizer keeps in a worker, which other stages' workers share memory with.
MEMO = 150_000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled documents of the input; keep what scores at least ``QUALITY``."""
    ship(spark)
    model = classifier.fit(classifier.document_stats(docs), _store.table(spark, sf_dir, "labels"))
    (score,) = _store.fresh(docs, "score")
    return classifier.score_texts(docs, model, score).filter(F.col(score) >= QUALITY).drop(score)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least doc_id of each class of near copies."""
    ship(spark)
    kept = near_text.classes(docs).filter("kept").select(F.col("doc_id").alias("kept_id"), "key").distinct()
    rows = docs.select(F.struct("*").alias("row"), "doc_id", near_text.text_key().alias("own"))
    held = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("own") == F.col("key")), "left_semi")
    return held.dropDuplicates(["doc_id", "own"]).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated passages; texts that repeat nothing stay as they are."""
    ship(spark)
    return substrings.without_repeats(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every found secret replaced."""
    ship(spark)
    clean = secrets.redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in the training sequences, ids included."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path(), with_ids=True, memo=MEMO)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL for run()'s rows: the classifier's fit and the tokenizer have none; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _store.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        after = _store.materialize(stage(spark, docs, sf_dir), name)
        _store.discard(docs)
        docs = after
    return docs.drop("ids")
