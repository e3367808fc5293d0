"""The source registry as a file (YAML or JSON), and records joined to it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.registry import SOURCE


def _fitted(value, kind):
    """A parsed value in the shape of a schema: what is absent is null."""
    if isinstance(kind, StructType):
        return tuple(_fitted((value or {}).get(f.name), f.dataType) for f in kind)
    return value


def load_registry(spark: SparkSession, path: str, schema: str = SOURCE) -> DataFrame:
    """The rows under ``sources`` of a registry file, a few entries that people write.  An entry without ``source_id`` or a repeated one fails."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("a YAML registry needs PyYAML; JSON needs nothing") from e
        parsed = yaml.safe_load(text)
    else:
        parsed = json.loads(text)
    entries = parsed["sources"] if isinstance(parsed, dict) else parsed
    names = [e.get("source_id") for e in entries]
    if None in names or len(set(names)) < len(names):
        raise ValueError("every source needs a source_id of its own")
    shape = StructType.fromDDL(schema)
    rows = [{**e, "has_mediawiki": bool(e.get("mediawiki", e.get("has_mediawiki", False))), "enabled": bool(e.get("enabled", True))} for e in entries]
    return spark.createDataFrame([_fitted(r, shape) for r in rows], shape)


def with_sources(records: DataFrame, registry: DataFrame, key: str = "source_id") -> tuple[DataFrame, DataFrame]:
    """(records with their source's columns, errors): a record whose source is not registered is an error row, the others go on."""
    own = registry.select(F.col(key).alias("_key"), F.struct("*").alias("_source"))
    joined = records.join(own, F.col(key) == F.col("_key"), "left")
    more = [c for c in registry.columns if c != key]
    known = joined.filter("_key is not null").select(*records.columns, *(F.col(f"_source.{c}").alias(c) for c in more if c not in records.columns))
    return known, joined.filter("_key is null").select(*records.columns, F.lit("source_not_registered").alias("error"))
