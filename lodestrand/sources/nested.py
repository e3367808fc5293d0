"""JSON of any depth as rows of paths and leaves, by rounds over VARIANT values in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import cut


def leaf_text(value: Column) -> Column:
    """A leaf as text: null is empty, booleans are capitalised, numbers and strings as they are."""
    kind = F.schema_of_variant(value)
    return F.when(F.is_variant_null(value), "").when(kind == "BOOLEAN", F.initcap(F.variant_get(value, "$", "string"))).otherwise(F.variant_get(value, "$", "string"))


def flatten(rows: DataFrame, json: str, *, path: str = "path", value: str = "value") -> DataFrame:
    """The other columns of ``rows`` with a row for every leaf of the JSON text: its path (``a.b[0]``; empty for a text that is a leaf) and text.

    Every round opens objects and arrays by one level and sets leaves aside; it ends when nothing is open, after as many rounds as the
    deepest text has levels.  A text with many members is spread as rows, from the second round on over all tasks that the table has.

    Defined results: a text that is null or no JSON has no rows; empty objects and arrays have none; of a key that an object
    repeats, and of texts that exceed a VARIANT's size, the text has no rows; keys hold any characters and are not quoted.
    """
    keep = [c for c in rows.columns if c != json]
    own = F.struct(*(F.col(f"`{c}`") for c in keep)) if keep else F.lit(None).cast("string")  # kept apart from names of this function
    open_ = rows.select(own.alias("_own"), F.lit("").alias("_path"), F.try_parse_json(F.col(f"`{json}`")).alias("_v")).filter("_v is not null")
    out = []
    while True:
        kind = F.schema_of_variant("_v")
        split = cut(open_.withColumn("_open", kind.startswith("OBJECT") | kind.startswith("ARRAY")))
        out.append(split.filter("not _open").select(*(F.col("_own")[c].alias(c) for c in keep), F.col("_path").alias(path), leaf_text(F.col("_v")).alias(value)))
        nested = split.filter("_open")
        if not nested.limit(1).count():
            return reduce(DataFrame.unionByName, out)
        inner = nested.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("_v").outer()))
        longer = F.when(F.col("key").isNull(), F.concat("_path", F.lit("["), F.col("pos").cast("string"), F.lit("]"))).when(F.col("_path") == "", F.col("key")).otherwise(F.concat("_path", F.lit("."), "key"))
        open_ = inner.select("_own", longer.alias("_path"), F.col("value").alias("_v"))
