"""Running sums and row numbers inside groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dedup import cut


def running_sum(rows: DataFrame, by: str, order: list[str], value: str, name: str = "total") -> DataFrame:
    """rows with the running sum of ``value`` in each group, in order.

    Rows are dealt by range of (group, order), so a group of any size is spread over tasks: each task sums its own stretch, and the
    sums of the stretches before it, one row a task and group, are added.
    """
    dealt = cut(rows.repartitionByRange(by, *order).withColumn("_part", F.spark_partition_id()))
    sums = dealt.groupBy(by, "_part").agg(F.sum(value).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(F.col(by).alias("_by"), F.col("_part").alias("_p"), before.alias("_before"))
    own = F.sum(value).over(Window.partitionBy(by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    out = dealt.withColumn("_own", own).join(offsets, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_p")))
    return out.withColumn(name, F.col("_own") + F.col("_before")).drop("_part", "_own", "_by", "_p", "_before")


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """rows with their number, from 1, in their group (of all, for no columns), in order."""
    one = rows.withColumn("_group", F.struct(*by) if by else F.lit(0)).withColumn("_one", F.lit(1).cast("long"))
    return running_sum(one, "_group", order, "_one", name).drop("_group", "_one")
