"""Incremental ingest: a file stream of fetched records, new versions only, merged into a table batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_records(spark: SparkSession, folder: str, schema: str, keys: tuple[str, ...] = ("source_id", "sha256"), delay: str = "1 day", at: str = "retrieved_at") -> DataFrame:
    """A stream of records, each (source, content) once; state older than the delay is dropped."""
    stream = spark.readStream.schema(schema).json(folder)
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def counts(stream: DataFrame, at: str = "retrieved_at", window: str = "1 hour", by: str = "source_id") -> DataFrame:
    """Records and bytes of each source and hour."""
    return stream.groupBy(F.window(at, window), by).agg(F.count(F.lit(1)).alias("records"), F.sum("byte_size").alias("bytes"))


#: Folders of the table by a hash of the keys: a batch reads the keys of those it touches.
BUCKETS = 64


def append(stream: DataFrame, table: str, checkpoint: str, keys: tuple[str, ...] = ("source_id", "sha256")):
    """Run what has arrived into a Parquet table.  A batch that is run again after a failure adds nothing: its rows are known by then."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(list(keys)).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))
        touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most BUCKETS
        try:
            known = spark.read.parquet(table).filter(F.col("bucket").isin(touched)).select("bucket", *keys)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        else:
            fresh = fresh.join(known, ["bucket", *keys], "left_anti")
        fresh.write.mode("append").partitionBy("bucket").parquet(table)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
