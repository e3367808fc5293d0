"""Shared storage for intermediate tables.

Intermediate results are written as Parquet below the folder named by ``spark.checkpoint.dir``, which driver and
executors share.  A written table cuts the lineage, survives lost executors and is computed once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the session; a local session that names none (tests) gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lodestrand-")
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._shared_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``materialize`` that no later plan reads."""
    for df in tables:
        path = getattr(df, "_shared_path", None)
        if not path:
            continue
        jvm, sc = df.sparkSession._jvm, df.sparkSession._jsc.sc()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def id_text(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and the named further columns; any other column is pruned at the scan."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out
