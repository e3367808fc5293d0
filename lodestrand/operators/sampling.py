"""Quotas, largest remainders, review samples and their agreement statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import small
from .ordered import numbered

# The shares of question types, languages and answerability.
TYPE_WEIGHTS = (("factual", 0.40), ("definition", 0.30), ("list_table", 0.15), ("comparison", 0.10), ("temporal", 0.05))
LANGUAGES = ("en", "tr")
UNANSWERABLE, CROSS_LINGUAL = 0.1, 0.1
Z = 1.96


def apportion(total: int, weights: list[tuple[str, float]]) -> dict[str, int]:
    """``total`` shared out by weights: floors first, then one each by the largest fraction, earlier ones first on ties."""
    exact = {k: total * w for k, w in weights}
    out = {k: math.floor(x) for k, x in exact.items()}
    by_fraction = sorted(exact, key=lambda k: out[k] - exact[k])  # a stable sort keeps the order of ties
    for k in by_fraction[: total - sum(out.values())]:
        out[k] += 1
    return out


def largest_remainder(rows: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """rows with quota, as ``apportion``, ties by key; one row a key."""
    exact = F.col(weight) * total
    floors = rows.withColumn("_floor", F.floor(exact)).withColumn("_left", exact - F.floor(exact))
    spare = F.lit(total) - F.sum("_floor").over(Window.partitionBy(F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("_left"), key))
    return floors.withColumn("quota", F.col("_floor") + F.when(rank <= spare, 1).otherwise(0)).drop("_floor", "_left")


def quota_plan(target: int) -> dict:
    """Counts of a question set of ``target`` by language, answerability, type and cross-lingual share."""
    if target < 1:
        raise ValueError("target must be positive")
    halves = [(lang, 1 / len(LANGUAGES)) for lang in LANGUAGES]
    languages = apportion(target, halves)
    kinds = apportion(target, [("answerable", 1 - UNANSWERABLE), ("corpus_unanswerable", UNANSWERABLE)])
    without = apportion(kinds["corpus_unanswerable"], halves)
    open_ = {lang: languages[lang] - without[lang] for lang in LANGUAGES}
    n = kinds["answerable"]
    types = apportion(n, list(TYPE_WEIGHTS))
    first, second = LANGUAGES
    # The first language takes its share of every type, the second what is left.
    exact = {t: types[t] * open_[first] / max(1, n) for t in types}
    cells = {first: {t: math.floor(x) for t, x in exact.items()}}
    for t in sorted(exact, key=lambda t: math.floor(exact[t]) - exact[t])[: open_[first] - sum(cells[first].values())]:
        cells[first][t] += 1
    cells[second] = {t: types[t] - cells[first][t] for t in types}
    cross = math.ceil(n * CROSS_LINGUAL)
    cross_of = apportion(cross, [(lang, open_[lang] / max(1, n)) for lang in LANGUAGES])
    strata = []
    for lang in LANGUAGES:
        own, size = cells[lang], max(1, sum(cells[lang].values()))
        crossed = apportion(cross_of[lang], [(t, own[t] / size) for t in own])
        for t in own:
            over = min(own[t], crossed[t])
            strata += [{"question_language": lang, "primary_type": t, "cross_lingual": c, "count": k} for c, k in ((False, own[t] - over), (True, over)) if k]
    return {"target": target, "question_language": languages, "answerability": kinds, "unanswerable_by_language": without, "answerable_by_language": open_, "answerable_types": types, "answerable_cross_lingual": cross, "answerable_strata": strata}


def quota_table(spark: SparkSession, target: int) -> DataFrame:
    """The plan as rows: place, answerability, question_language, primary_type, cross_lingual, count."""
    p = quota_plan(target)
    rows = [(i, "answerable", s["question_language"], s["primary_type"], s["cross_lingual"], s["count"]) for i, s in enumerate(p["answerable_strata"])]
    rows += [(len(rows) + i, "corpus_unanswerable", lang, None, None, k) for i, (lang, k) in enumerate(p["unanswerable_by_language"].items())]
    return spark.createDataFrame(rows, "place int, answerability string, question_language string, primary_type string, cross_lingual boolean, count long")


def quota_select(valid: DataFrame, quotas: DataFrame, strata: list[str], order: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(selected, overflow, deficits): the first ``count`` rows of each stratum in order.  Strata are disjoint, so numbering them does."""
    ranked = numbered(valid, strata, order, "_rn")
    limits = quotas.select(*(F.col(c).alias(f"_q_{c}") for c in strata), F.col("count").alias("_q"))
    joined = ranked.join(small(limits), [F.col(c).eqNullSafe(F.col(f"_q_{c}")) for c in strata], "left")
    held = joined.select(*valid.columns, (F.col("_rn") <= F.coalesce("_q", F.lit(0))).alias("_in"))
    counts = valid.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    short = quotas.join(counts, [quotas[c].eqNullSafe(counts[c]) for c in strata], "left")
    actual = F.least(F.coalesce("_n", F.lit(0)), quotas["count"])
    deficits = short.select(*(quotas[c] for c in quotas.columns), actual.alias("actual"), (quotas["count"] - actual).alias("deficit")).filter("deficit > 0")
    return held.filter("_in").drop("_in"), held.filter(~F.col("_in")).drop("_in"), deficits


def by_hash(prefix: str, key: str) -> Column:
    """A reproducible random order."""
    return F.sha2(F.concat(F.lit(prefix), F.col(key).cast("string")), 256)


def sample_per_stratum(rows: DataFrame, strata: list[str], key: str, rate: float, prefix: str = "extraction-review:") -> DataFrame:
    """At least one and ceil(n * rate) rows of every stratum, by hash order."""
    if not 0 < rate <= 1:
        raise ValueError("rate must be in (0, 1]")
    sizes = rows.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))  # one row a stratum
    ranked = numbered(rows.withColumn("_hash", by_hash(prefix, key)), strata, ["_hash", key], "_rank")
    want = F.greatest(F.lit(1), F.ceil(F.col("_n") * rate))
    both = ranked.join(small(sizes), [ranked[c].eqNullSafe(sizes[c]) for c in strata])
    return both.filter(F.col("_rank") <= want).select(*(ranked[c] for c in rows.columns))


def review_sample(rows: DataFrame, strata: list[str], key: str, rate: float, slots: tuple[str, ...] = ("A", "B"), prefix: str = "review:") -> DataFrame:
    """Exactly ceil(N * rate) rows shared out over strata by largest remainder, each once a reviewer slot."""
    if not 0 < rate <= 1:
        raise ValueError("rate must be in (0, 1]")
    sizes = rows.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))  # one row a stratum
    exact = F.col("_n") * rate
    total = F.ceil(F.sum("_n").over(Window.partitionBy(F.lit(0))) * rate)
    sizes = sizes.withColumn("_floor", F.floor(exact)).withColumn("_spare", total - F.sum(F.floor(exact)).over(Window.partitionBy(F.lit(0))))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(exact - F.floor(exact)), *(F.asc_nulls_first(c) for c in strata)))
    sizes = sizes.withColumn("_take", F.col("_floor") + F.when(place <= F.col("_spare"), 1).otherwise(0)).select(*strata, "_take")
    ranked = numbered(rows.withColumn("_hash", by_hash(prefix, key)), strata, ["_hash", key], "_rank")
    both = ranked.join(small(sizes), [ranked[c].eqNullSafe(sizes[c]) for c in strata]).filter("_rank <= _take").select(*(ranked[c] for c in rows.columns))
    return both.withColumn("reviewer_slot", F.explode(F.array(*map(F.lit, slots))))


def wilson(successes: Column, n: Column) -> tuple[Column, Column]:
    """95% interval of a rate."""
    p, zz = successes / n, Z * Z
    center = (p + zz / (2 * n)) / (1 + zz / n)
    margin = Z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    return center - margin, center + margin


def kappa(observed: Column, left: Column, right: Column) -> Column:
    """Cohen's kappa of two raters from their agreement and their rates of yes; 1 where chance agreement is certain."""
    chance = left * right + (1 - left) * (1 - right)
    return F.when(chance >= 1, F.lit(1.0)).otherwise((observed - chance) / (1 - chance))


def agreement(rows: DataFrame, item: str, order: str, vote: str) -> DataFrame:
    """review_rows, reviewed_items, double_reviewed_items, rate, error_low, error_high, kappa (6 places; null without pairs).

    The first two votes of an item, by ``order``, are its pair; the interval is that of the error, 1 - rate.
    """
    rank = F.row_number().over(Window.partitionBy(item).orderBy(order))
    one = rows.withColumn("_r", rank).groupBy(item).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(vote)).alias("yes"), F.max(F.when(F.col("_r") == 1, F.col(vote))).alias("a"), F.max(F.when(F.col("_r") == 2, F.col(vote))).alias("b")
    )
    pair = F.col("n") >= 2

    def mean(c: Column) -> Column:
        return F.avg(F.when(pair, c.cast("double")))

    sums = one.agg(F.sum("n").alias("review_rows"), F.count(F.lit(1)).alias("reviewed_items"), F.count_if(pair).alias("double_reviewed_items"), F.sum("yes").alias("yes"), mean(F.col("a") == F.col("b")).alias("o"), mean(F.col("a")).alias("l"), mean(F.col("b")).alias("r"))
    low, high = wilson(F.col("yes"), F.col("review_rows"))
    return sums.select("review_rows", "reviewed_items", "double_reviewed_items", F.round(F.col("yes") / F.col("review_rows"), 6).alias("rate"), F.round(1 - high, 6).alias("error_low"), F.round(1 - low, 6).alias("error_high"), F.round(kappa(F.col("o"), F.col("l"), F.col("r")), 6).alias("kappa"))


def gates(rows: DataFrame) -> DataFrame:
    """gate rows (gate, actual, op, threshold, nullable) with status: a null actual is not_evaluated where allowed, else fail."""
    a, t = F.col("actual"), F.col("threshold")
    ok = F.when(F.col("op") == "==", a == t).when(F.col("op") == "<=", a <= t).otherwise(a >= t)
    return rows.withColumn("status", F.when(a.isNull(), F.when(F.col("nullable"), "not_evaluated").otherwise("fail")).when(ok, "pass").otherwise("fail"))


def verdict(gate_rows: DataFrame) -> DataFrame:
    """fail if any gate fails, else not_evaluated if any is, else pass."""
    return gate_rows.agg(F.when(F.bool_or(F.col("status") == "fail"), "fail").when(F.bool_or(F.col("status") == "not_evaluated"), "not_evaluated").otherwise("pass").alias("verdict"))


def judge_report(judged: DataFrame, votes: DataFrame, item: str, score: str, vote: str, passing: int = 3) -> DataFrame:
    """items, pass_rate, compared, agreement, kappa of a judge (score >= ``passing``) against the majority of human votes (ties pass)."""
    human = votes.groupBy(item).agg((2 * F.count_if(vote) >= F.count(F.lit(1))).alias("_h"))
    both = judged.select(item, (F.col(score) >= passing).alias("_j")).join(human, item, "left")
    there = F.col("_h").isNotNull()

    def mean(c: Column) -> Column:
        return F.avg(F.when(there, c.cast("double")))

    s = both.agg(F.count(F.lit(1)).alias("items"), F.avg(F.col("_j").cast("double")).alias("p"), F.count_if(there).alias("compared"), mean(F.col("_j") == F.col("_h")).alias("o"), mean(F.col("_j")).alias("l"), mean(F.col("_h")).alias("r"))
    return s.select("items", F.round("p", 6).alias("pass_rate"), "compared", F.round("o", 6).alias("agreement"), F.round(kappa(F.col("o"), F.col("l"), F.col("r")), 6).alias("kappa"))
