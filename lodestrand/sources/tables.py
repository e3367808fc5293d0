"""Record files: JSON lines, Parquet, CSV and versioned outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import detect_mime, safe_shard


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_records(spark: SparkSession, path: str, schema: str | StructType, kind: str = "json") -> DataFrame:
    """A record file under a fixed schema.  A missing path is the empty table; a line that does not fit fails the read."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return reader.option("mode", "FAILFAST").json(path) if kind == "json" else reader.format(kind).load(path)


def write_records(df: DataFrame, path: str, kind: str = "json", mode: str = "overwrite") -> None:
    """JSON lines, zstd Parquet, or CSV with a header and arrays joined by ``|``."""
    if kind == "csv":
        flat = [F.array_join(c, "|").alias(c) if t.startswith("array<string") else F.col(c) for c, t in df.dtypes]
        df.select(*flat).write.mode(mode).option("header", True).csv(path)
    elif kind == "parquet":
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    else:
        df.write.mode(mode).json(path)


# Columns of the question export, in order.
QA_CSV = ("qa_id", "question", "answer", "reference_answer", "question_language", "answerability", "primary_type", "split", "source_document_ids")


def write_qa_csv(df: DataFrame, path: str) -> None:
    """The nine columns of the question export, whatever else the records hold; several documents are joined by ``|``."""
    write_records(df.select(*QA_CSV), path, "csv")


def write_shards(df: DataFrame, path: str, by: str) -> None:
    """One folder for each license (or other name)."""
    df.withColumn("shard", safe_shard(F.col(by))).write.mode("overwrite").partitionBy("shard").parquet(path)


def read_files(spark: SparkSession, pattern: str, limit: int | None = None) -> DataFrame:
    """path, sha256, byte_size, mime and content of files, first path of equal contents.  ``..`` is refused; larger files than ``limit`` are left out."""
    if ".." in pattern.split("/"):
        raise ValueError("patterns may not leave their folder")
    rows = spark.read.format("binaryFile").load(pattern)
    if limit is not None:
        rows = rows.filter(F.col("length") <= limit)  # pushed to the file listing: such files are never opened
    out = rows.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_size"), detect_mime(F.col("content"), F.col("path")).alias("mime"), "content")
    first = F.row_number().over(Window.partitionBy("sha256").orderBy("path"))
    return out.withColumn("_r", first).filter("_r = 1").drop("_r")


def new_versions(fetched: DataFrame, known: DataFrame, keys: tuple[str, ...] = ("source_id", "sha256")) -> DataFrame:
    """What is not known yet."""
    return fetched.join(known.select(*keys).distinct(), list(keys), "left_anti")


def merge_manifest(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Old and new rows, the last of each key by ``order``, new ones winning ties."""
    rows = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order), F.desc("_new")))
    return rows.withColumn("_r", last).filter("_r = 1").drop("_r", "_new")


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """path and sha256 of all files below a folder, by path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.sha2("content", 256).alias("sha256")).orderBy("path")


def promote(df: DataFrame, base: str, version: str, pointers: str) -> None:
    """Write a new version's folder, then append it to the pointer table: readers see all of it or none."""
    df.write.mode("error").parquet(f"{base}/{version}")
    df.sparkSession.createDataFrame([(base, version)], "base string, version string").withColumn("at", F.current_timestamp()).write.mode("append").parquet(pointers)


def current(spark: SparkSession, pointers: str, base: str) -> DataFrame:
    """The version that was promoted last."""
    row = spark.read.parquet(pointers).filter(F.col("base") == base).orderBy(F.desc("at")).first()
    if row is None:
        raise FileNotFoundError(f"nothing promoted at {base}")
    return spark.read.parquet(f"{base}/{row.version}")


def record_version(explicit, header, etag, modified, sha256):
    """A fetched record's version: what was given, else the best of what the server said, else the start of its checksum."""
    return F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in (explicit, header, etag, modified)), F.substring(sha256, 1, 16))
