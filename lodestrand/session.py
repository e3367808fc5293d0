"""Sessions: building one for local use, and shipping this package to executors that have no copy of it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = Path(__file__).resolve().parent


def local_session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session on this machine, with adaptive execution and UTC timestamps."""
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    return SparkSession.builder.master(f"local[{cpus}]").config(map=settings).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, once an application; a zip of a few dozen modules."""
    sc = spark.sparkContext
    if getattr(sc, "_lodestrand_shipped", False):
        return
    fd, path = tempfile.mkstemp(prefix="lodestrand-", suffix=".zip")
    with os.fdopen(fd, "wb") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(_HERE.rglob("*.py")):
            z.write(p, f"{_HERE.name}/{p.relative_to(_HERE)}")
    sc.addPyFile(path)
    sc._lodestrand_shipped = True


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, where a table comes in fewer splits than there are cores (a small file is one row group, which
    one task reads); larger tables stay as they are read, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def small(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """The rows with a broadcast hint if they are few, by a count that stops there; else as they are."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
