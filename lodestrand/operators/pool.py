"""Question duplicates against a stored pool of accepted questions, batch by batch.

The pool is a folder: what each batch accepted (``accepted``), an index of their text hashes and band hashes (``index``), laid out
by slots of the hash, and what was decided of each batch (``decided``).  A batch reads the slots that its own hashes fall into, and of the
pool's questions those alone that share a hash with one of it.  What the pool rejects is out; the rest is decided in order, in
rounds on undecided rows.  As all of an earlier batch comes before all of a later one, batches give the rows that one run over
all of them gives.

A batch counts once its decisions are committed, which is done last; one that was killed is done anew over what it left, and one that
is sent again gives its stored decisions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import small
from .build import committed
from .dedup import bands, cut, question_filter, question_keys, sha_signature

#: Parts of the index; a batch with few hashes reads few of them.
SLOTS = 256


def _batches(spark: SparkSession, base: str, before: int) -> list[int]:
    """Committed batches ahead of one, in order."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/decided")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    known = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
    return [b for b in known if b < before and committed(spark, f"{base}/decided/batch={b}")]


def _hashes(rows: DataFrame) -> DataFrame:
    """k, kind (text or band), hash, slot of questions (k, s, h; bands, if they are made)."""
    held = F.col("bands") if "bands" in rows.columns else bands(sha_signature(F.col("s")))
    met = rows.select("k", F.lit("band").alias("kind"), F.explode(held).alias("hash"))
    both = rows.select("k", F.lit("text").alias("kind"), F.xxhash64("h").alias("hash")).unionByName(met)
    return both.withColumn("slot", F.pmod("hash", F.lit(SLOTS)).cast("int"))


def add(base: str, batch: int, questions: DataFrame, key: str = "key", text: str = "text", threshold: float = 0.9) -> DataFrame:
    """key, reason of a batch's questions as ``question_filter`` gives them, with the pool's questions before them.

    Batches are numbered in the order in which they count; adding one ahead of a committed one is an error.
    """
    spark = questions.sparkSession
    decided = f"{base}/decided/batch={batch}"
    if committed(spark, decided):
        return spark.read.parquet(decided)
    if _batches(spark, base, 1 << 62)[-1:] > [batch]:
        raise ValueError(f"a later batch than {batch} has been added")
    rows = cut(question_keys(questions, key, text))
    rest = rows
    told = rows.select("k", F.lit(None).cast("string").alias("reason")).limit(0)
    earlier = _batches(spark, base, batch)
    if earlier:
        asked = _hashes(rows)
        slots = [r.slot for r in asked.select("slot").distinct().collect()]  # at most SLOTS
        index = spark.read.parquet(f"{base}/index").filter(F.col("batch").isin(earlier) & F.col("slot").isin(slots))
        met = cut(index.select(F.col("k").alias("p"), "kind", "hash").join(small(asked.drop("slot")), ["kind", "hash"]).select("p", "k").distinct())
        near = small(met)
        pool = spark.read.parquet(f"{base}/accepted").filter(F.col("batch").isin(earlier)).select(F.col("k").alias("p"), F.col("s").alias("ps"), F.col("h").alias("ph"))
        pairs = pool.join(near, "p").join(rows.select("k", "s", "h"), "k")
        same, alike = F.col("h") == F.col("ph"), T.jaccard(F.col("s"), F.col("ps")) >= threshold
        hits = pairs.filter(same | alike).groupBy("k").agg(F.bool_or(same).alias("same"))
        told = cut(hits.select("k", F.when(F.col("same"), "duplicate_question").otherwise("near_duplicate_question").alias("reason")))
        rest = cut(rows.join(told, "k", "left_anti"))
    out = cut(told.unionByName(question_filter(rest, "k", None, threshold)))
    fresh = f"{base}/accepted/batch={batch}"
    rest.join(out.filter("reason is null"), "k", "left_semi").write.mode("overwrite").parquet(fresh)
    # A number of parts of one's own is not joined into few again: a slot's folder is slow to make, not to fill.
    _hashes(spark.read.parquet(fresh)).repartition(spark.sparkContext.defaultParallelism, "slot").write.mode("overwrite").partitionBy("slot").parquet(f"{base}/index/batch={batch}")
    out.select(F.col("k").alias(key), "reason").write.mode("overwrite").parquet(decided)
    return spark.read.parquet(decided)
