"""Promotion of reviewed results: gates, and a log of versions to which one writer at a time can add.

A version is a set of written tables and an entry of the log that names them.  Tables are written first, below a name of their
own; the entry is then created under the next number, which only one writer can do.  Who loses sees a ``Conflict`` and nothing
changes for readers, who take the last entry and so see all of a version or none of it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What a review holds, and who reviews an item.
DIMENSIONS, SLOTS = ("clarity", "correctness", "evidence_sufficiency", "language_quality"), ("A", "B")
DIGITS = 20


class Conflict(RuntimeError):
    """Another writer has added the version that was to be added."""


class NotReady(ValueError):
    """Gates or reviews stand against a promotion; ``issues`` says which."""

    def __init__(self, issues: list[str]):
        super().__init__("; ".join(issues))
        self.issues = issues


def review_issues(sample: DataFrame, reviews: DataFrame) -> DataFrame:
    """issue, items: what of a double review is not as it must be, with the number of items; no row: nothing.

    sample: qa_id, reviewer_slot.  reviews: those, reviewer_id and the boolean ``DIMENSIONS``.  Assignments and reviews
    are compared as multisets, so a review that is there twice, or for nobody's slot, counts.
    """
    key = ["qa_id", "reviewer_slot"]
    assigned = sample.groupBy(*key).agg(F.count(F.lit(1)).alias("a"))
    given = reviews.groupBy(*key).agg(F.count(F.lit(1)).alias("g"))
    met = assigned.alias("x").join(given.alias("y"), F.col("x.qa_id").eqNullSafe(F.col("y.qa_id")) & F.col("x.reviewer_slot").eqNullSafe(F.col("y.reviewer_slot")), "full")
    unlike = met.filter(~F.coalesce("a", F.lit(0)).eqNullSafe(F.coalesce("g", F.lit(0)))).select(F.coalesce("x.qa_id", "y.qa_id").alias("qa_id"), F.lit("reviews_do_not_match_assignments").alias("issue"))
    slots = sample.groupBy("qa_id").agg(F.sort_array(F.collect_set("reviewer_slot")).alias("s")).filter(F.col("s") != F.array(*map(F.lit, SLOTS)))
    name = F.trim(F.coalesce("reviewer_id", F.lit("")))
    whole = F.lit(True)
    for d in DIMENSIONS:
        whole = whole & F.col(d).isNotNull()
    alone = reviews.groupBy("qa_id").agg(F.countDistinct(name).alias("n")).filter("n <> 2")
    found = unlike.unionByName(slots.select("qa_id", F.lit("item_lacks_a_slot").alias("issue")))
    found = found.unionByName(reviews.filter(name == "").select("qa_id", F.lit("reviewer_unnamed").alias("issue"))).unionByName(reviews.filter(~whole).select("qa_id", F.lit("review_incomplete").alias("issue")))
    found = found.unionByName(alone.select("qa_id", F.lit("reviewers_not_two").alias("issue")))
    return found.groupBy("issue").agg(F.countDistinct(F.coalesce(F.col("qa_id").cast("string"), F.lit(""))).alias("items"))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def entries(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the log's entries, in order."""
    fs, p = _fs(spark, f"{base}/log")
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(int(n) for n in names if len(n) == DIGITS and n.isdigit())


def entry(spark: SparkSession, base: str, number: int) -> dict:
    fs, p = _fs(spark, f"{base}/log/{number:0{DIGITS}d}")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _created(spark: SparkSession, base: str, number: int, value: dict) -> bool:
    """Whether the entry is now there with this value; False if another is.  It appears whole or not at all."""
    fs, part = _fs(spark, f"{base}/log/.{uuid.uuid4().hex}")
    _, final = _fs(spark, f"{base}/log/{number:0{DIGITS}d}")
    out = fs.create(part, False)
    out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    out.close()
    try:
        if fs.getScheme() == "file":  # a local rename replaces what is there; a link does not
            try:
                spark._jvm.java.nio.file.Files.createLink(*(spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (final, part)))
                return True
            except Exception as e:
                if "FileAlreadyExistsException" in str(e):
                    return False
                raise
        return bool(fs.rename(part, final))
    finally:
        fs.delete(part, False)


def commit(spark: SparkSession, base: str, tables: dict[str, DataFrame], expected: int, **note: str) -> int:
    """Write the tables and add them as the version after ``expected`` (0: the first); returns its number.

    Of several writers that expect the same version one succeeds; the tables of the others are removed.
    """
    place = f"{base}/data/{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{place}/{name}")
    last = max(entries(spark, base), default=0)
    if last == expected and _created(spark, base, expected + 1, {"tables": {n: f"{place}/{n}" for n in tables}, **note}):
        return expected + 1
    fs, p = _fs(spark, place)
    fs.delete(p, True)
    raise Conflict(f"version {expected + 1} of {base} is there already")


def current(spark: SparkSession, base: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the last version, or of a stated one."""
    have = entries(spark, base)
    if not have or (version is not None and version not in have):
        raise FileNotFoundError(f"no version {version or ''} of {base}")
    return spark.read.parquet(entry(spark, base, version or have[-1])["tables"][name])


def promote(spark: SparkSession, base: str, tables: dict[str, DataFrame], gates: DataFrame, sample: DataFrame, reviews: DataFrame, expected: int, required: list[str] | None = None, **note: str) -> int:
    """``commit``, if all required gates (gate, status; all, if none are named) pass and the reviews are as assigned."""
    held = {r.gate: r.status for r in gates.select("gate", "status").collect()}  # a handful
    issues = [f"gate {g}: {held.get(g, 'missing')}" for g in sorted(required if required is not None else held) if held.get(g) != "pass"]
    issues += [f"{r.issue}: {r['items']}" for r in review_issues(sample, reviews).orderBy("issue").collect()]  # at most five
    if issues:
        raise NotReady(issues)
    return commit(spark, base, tables, expected, **note)
