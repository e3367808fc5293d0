"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every text gets counts (words, symbols, repeated lines and windows).  Each rule is a score of those counts with a grid of
cutoffs.  On labelled holdouts a cutoff's false rejections among good documents are binomial; a cutoff is valid in a
stratum if seeing so few of them has a probability of at most ``delta`` (shared by Bonferroni among all rules, cutoffs
and strata) were the true rate above ``alpha``: the exact binomial tail.  Of a rule's valid cutoffs the strictest is used.
A stratum with too few labels gets no cutoff, and so no rejections beyond the base rule.

The alpha of a stratum is shared by its rules, so that all rules together falsely reject at most ``alpha`` of its good
documents, with confidence 1 - ``delta`` over all strata at once.

Defined results: a null text has no words; texts of any length are counted whole, each as one row; null strata are one stratum; a
document with several labels counts as good if any of them is; rows without a doc_id have no label and are judged; rows that
repeat a doc_id are judged each; an empty table gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _store

# The word and symbol classes of the base counts.
WORD_BREAK, BREAKS, SYMBOLS = r"[\x20\x09-\x0D]+", " \t\n\x0b\x0c\r", "#*$%&|<>"
WINDOW = 8
#: Rule -> (score, which gets larger as a text gets worse, cutoffs).
GRID = {
    "symbols": ("n_symbols / greatest(n_words, 1)", (0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0)),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", (0.1, 0.2, 0.3, 0.5, 0.7)),
    "long_words": ("word_chars / greatest(n_words, 1)", (8.0, 9.0, 10.0, 12.0, 16.0)),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", (0.02, 0.05, 0.1, 0.2, 0.3)),
}


def _repeat_words(words: Column) -> Column:
    """Words inside ``WINDOW``-word windows whose words occur in two or more windows.

    A set of hashes of the windows tells for most texts that there is no repeat.  The others sort (hash, second hash of the words
    themselves, place), keep the places whose neighbours agree in both, 128 bits, and add up the covered words.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    n = F.size(words)
    places = F.when(n >= WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1))).otherwise(F.expr("cast(array() as array<int>)"))

    def covered(pairs: Column) -> Column:
        def same(p: Column, q: Column) -> Column:
            return (p["h"] == q["h"]) & (p["g"] == q["g"])

        equal = F.filter(pairs, lambda p, i: F.coalesce(same(F.get(pairs, i - 1), p), F.lit(False)) | F.coalesce(same(F.get(pairs, i + 1), p), F.lit(False)))
        at = F.sort_array(F.transform(equal, lambda p: p["i"]))
        return F.aggregate(at, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-WINDOW).alias("last")), lambda acc, i: F.struct((acc["sum"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("sum"), i.alias("last")), lambda acc: acc["sum"])

    def of(wins: Column) -> Column:
        pairs = F.sort_array(F.transform(wins, lambda h, i: F.struct(h.alias("h"), F.xxhash64(F.lit(7), F.slice(words, i + 1, WINDOW)).alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(wins)) == F.size(wins), F.lit(0).cast("long")).otherwise(_let(pairs, covered))

    return _let(hashes, lambda hs: _let(F.transform(places, lambda i: F.xxhash64(F.slice(hs, i, WINDOW))), of))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda over a one-element array."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_stats(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, the named columns and the base counts of every whole text."""
    text = F.col("text")
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, BREAKS, "")) > 0)
    rows = _store.id_text(docs, *more).withColumn("_counts", _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r"))))
    rows = rows.withColumn("_lines", _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d"))))
    return rows.select(
        "doc_id",
        *more,
        F.col("_counts.n").alias("n_words"),
        F.length(F.translate(text, BREAKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.col("_lines.d").alias("n_dup_lines"),
        F.col("_counts.r").alias("n_repeat_words"),
        F.col("_lines.n").alias("n_lines"),
    )


def base_failed(min_words: int = 20, repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def _scores() -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, GRID)), F.array(*(F.expr(f"double({e})") for e, _ in GRID.values())))


def _log_gamma(x: Column) -> Column:
    """log of the gamma function from 1 on, to about twelve places: Stirling's series eight above, and back."""
    import math

    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z) - 1 / (1680 * z * z * z * z * z * z * z)
    back = F.log(x * (x + 1) * (x + 2) * (x + 3)) + F.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - back


def _log_tail(k: Column, n: Column, rate: float) -> Column:
    """log P(X <= k) for X ~ Binomial(n, rate).

    The terms are summed from k down, relative to the first; up to the mean that is the largest.  They fall off as a normal density does, so those
    more than 40 standard deviations away cannot show in a double: their number grows with the root of n only.
    """
    import math

    n, k = n.cast("double"), k.cast("double")
    top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * F.lit(math.log(rate)) + (n - k) * F.lit(math.log1p(-rate))
    odds = F.lit(math.log1p(-rate) - math.log(rate))

    def step(acc: Column, j: Column) -> Column:
        term = acc["term"] + F.log(j / (n - j + 1)) + odds
        high, low = F.greatest(acc["sum"], term), F.least(acc["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    steps = F.least(k, F.ceil(40 * F.sqrt(n * rate) + F.greatest(k - n * rate, F.lit(0.0))) + 40).cast("long")
    js = F.when(k >= 1, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(steps - 1, F.lit(0))), lambda i: k - i)).otherwise(F.expr("cast(array() as array<double>)"))
    zero = F.lit(0.0)
    return top + F.aggregate(js, F.struct(zero.alias("term"), zero.alias("sum")), step, lambda acc: acc["sum"])


def cutoffs(stats: DataFrame, labels: DataFrame, stratum: str, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """stratum, rule, cutoff, n_good, n_rejected: the strictest valid cutoff of each rule and stratum."""
    import math

    n_cut = sum(len(c) for _, c in GRID.values())
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    held = stats.filter(~base_failed()).join(good, "doc_id", "left_semi").select(F.col(stratum).alias("_s"), _scores().alias("_m"))
    grid = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff")) for r, (_, cs) in GRID.items() for c in cs))
    # One row a document, one column a cutoff: partial sums leave one row a stratum and task.
    flat = [(r, float(c)) for r, (_, cs) in GRID.items() for c in cs]
    sums = held.groupBy("_s").agg(F.count(F.lit(1)).alias("n_good"), F.array(*(F.count_if(F.col("_m")[r] >= c) for r, c in flat)).alias("_k"))
    sums = sums.withColumn("_strata", F.count(F.lit(1)).over(_all()))  # one row a stratum
    rows = sums.select("_s", "n_good", "_strata", F.explode(F.arrays_zip(grid.alias("g"), F.col("_k").alias("k"))).alias("_z"))
    rows = rows.select("_s", "n_good", F.col("_z.g.rule").alias("rule"), F.col("_z.g.cutoff").alias("cutoff"), F.col("_z.k").alias("n_rejected"), "_strata")
    # Beyond the expected count the tail exceeds any delta in use: no need to sum it.
    share = alpha / len(GRID)
    valid = rows.filter(F.col("n_rejected") <= F.ceil(share * F.col("n_good"))).filter(_log_tail(F.col("n_rejected"), F.col("n_good"), share) <= F.lit(math.log(delta / n_cut)) - F.log("_strata"))
    best = valid.groupBy("_s", "rule").agg(F.min_by(F.struct("cutoff", "n_good", "n_rejected"), "cutoff").alias("b"))
    return best.select(F.col("_s").alias(stratum), "rule", "b.*")


def _all():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0))


def judge(stats: DataFrame, chosen: DataFrame, stratum: str) -> DataFrame:
    """stats with base_failed, failed_rules and kept."""
    per = chosen.groupBy(F.col(stratum).alias("_s")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cut"))  # a stratum has as many rows as there are rules
    rows = stats.withColumn("base_failed", base_failed()).join(per, F.col(stratum).eqNullSafe(F.col("_s")), "left").withColumn("_m", _scores())
    failed = F.filter(F.array(*map(F.lit, GRID)), lambda r: F.coalesce(F.col("_m")[r] >= F.col("_cut")[r], F.lit(False)))
    return rows.withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("_s", "_cut", "_m")


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Counts and verdict of every document.  The counts are made once, as a written table of one small row a document."""
    stats = _store.materialize(text_stats(docs, stratum), "rule-stats")
    return judge(stats, cutoffs(stats, labels, stratum, alpha, delta), stratum)
