"""URL filters: host and path rules first, then templates of each host's paths, rejected where what is labelled of them is bad.

The urls that rules decide are the labelled ones, besides any that the caller labels.  A host's paths form a tree of
segments.  Level by level, a segment that many of its siblings' urls share stays literal; all others become one of three
wildcards by their form: ``{n}`` (digits), ``{x}`` (with digits), ``{w}`` (without).  Branches of one parent whose labels
no test of two proportions tells apart are then merged into one, ``{a|b}``; so are those without any label, but never a
labelled one with an unlabelled one.  A template's purity is the share of bad urls among its labelled ones, drawn towards
the corpus's share by a fixed weight; templates that reach ``reject`` are blocked where no rule decides.

Everything runs on distinct (host, path) rows with counts, in grouped sums and equi-joins, so a host or url with a third of
all rows is summed before it is shuffled, and joins on it can be split.  A parent has at most 1 / ``share`` literal branches
and three wildcards, so merging sees a short list.  Templates name the first ``depth`` segments; deeper ones end in ``{**}``.

Defined results: a url that is null or has no ``://`` has an empty host and path, which are a host and path like any
other; an empty table gives no row; rows that repeat an id are judged each; an id may be null; other columns are
ignored; of two rules of one host and path the one that sorts last by verdict (block) holds; without any label nothing is rejected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small
from . import _store

#: A segment stays literal with this share of its parent's urls and this many of them.
SHARE, LEAST = 0.05, 3
#: Segments that a template names.
DEPTH = 12
#: Labelled urls that a branch needs to be compared, and the deviation up to which two shares count as alike.
COMPARED, ALIKE = 5, 1.96
#: Weight of the corpus's share in a template's, and the share at which a template is rejected.
WEIGHT, REJECT = 5.0, 0.8
KEY = ("host", "template")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(_rest(url), "^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) as a table for ``judge_urls``."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _ruled(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path and its longest rule (rule, verdict; null: none), by equal keys only.

    A path is cut at the lengths that the rules of a host suffix have, so that a suffix with many rules costs its lengths.
    """
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    lengths = rules.groupBy(F.col("host").alias("suffix")).agg(F.collect_set(F.length("path")).alias("cuts"))
    labels = F.split("host", "[.]")
    at = F.sequence(F.lit(1), F.size(labels))
    suffixes = F.transform(at, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cut = paths.select("host", "path", F.explode(suffixes).alias("suffix")).join(small(lengths), "suffix")
    cut = cut.select("host", "path", "suffix", F.explode(F.filter("cuts", lambda n: n <= F.length("path"))).alias("n"))
    cut = cut.withColumn("prefix", F.substr("path", F.lit(1), F.col("n")))
    named = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), F.concat("host", "path").alias("rule"), "verdict")
    found = cut.join(small(named), ["suffix", "prefix"])
    return found.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "rule")).alias("r")).select("host", "path", "r.rule", "r.verdict")


def _form(seg: Column) -> Column:
    """The wildcard of a segment."""
    return F.when(seg.rlike("^[0-9]+$"), "{n}").when(seg.rlike("[0-9]"), "{x}").otherwise("{w}")


def _literal(seg: Column) -> Column:
    return F.when(seg.startswith("{"), F.concat(F.lit("{"), seg)).otherwise(seg)


def _merged(branches: Column) -> Column:
    """Branches (branch, labelled, bad) with the name of their group, merged along the order of their shares."""
    enough = F.when(F.lit(True), F.lit(0))  # keeps the struct's type free of nulls

    def ranked(b: Column) -> Column:
        kind = F.when(b["labelled"] == 0, 0).when(b["labelled"] < COMPARED, 1).otherwise(2)
        return F.struct(kind.alias("kind"), ((b["bad"] + 1) / (b["labelled"] + 2)).alias("p"), b["branch"].alias("branch"), b["labelled"].alias("n"), b["bad"].alias("k"), enough.alias("g"))

    def alike(acc: Column, x: Column) -> Column:
        n, k = acc["n"], acc["k"]
        pooled = (k + x["k"]) / (n + x["n"])
        near = F.abs(k / n - x["k"] / x["n"]) <= ALIKE * F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / x["n"]))
        return (acc["kind"] == x["kind"]) & F.when(x["kind"] == 0, True).when(x["kind"] == 1, False).otherwise(near)

    def fold(acc: Column, x: Column) -> Column:
        same = F.coalesce(alike(acc, x), F.lit(False))
        g = F.when(same, acc["g"]).otherwise(acc["g"] + 1)
        n, k = F.when(same, acc["n"]).otherwise(0) + x["n"], F.when(same, acc["k"]).otherwise(0) + x["k"]
        out = F.array_append(acc["out"], F.struct(x["branch"].alias("branch"), g.alias("g")))
        return F.struct(x["kind"].alias("kind"), n.alias("n"), k.alias("k"), g.alias("g"), out.alias("out"))

    start = F.struct(F.lit(-1).alias("kind"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).alias("g"), F.array().cast("array<struct<branch:string,g:int>>").alias("out"))
    done = F.aggregate(F.array_sort(F.transform(branches, ranked)), start, fold)["out"]

    def name(x: Column) -> Column:
        members = F.array_sort(F.transform(F.filter(done, lambda y: y["g"] == x["g"]), lambda y: y["branch"]))
        return F.struct(x["branch"].alias("branch"), F.when(F.size(members) == 1, members[0]).otherwise(F.concat(F.lit("{"), F.array_join(members, "|"), F.lit("}"))).alias("name"))

    return F.transform(done, name)


def _descend(state: DataFrame, level: int, share: float, least: int) -> DataFrame:
    """Extend every path's template by its segment of this level."""
    seg = F.get("segs", F.lit(level))
    live = state.filter(F.size("segs") > level)
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    kids = _store.materialize(live.groupBy(*KEY, seg.alias("seg")).agg(*sums), "url-branches")
    whole = kids.groupBy(*KEY).agg(F.sum("n").alias("all"))
    stays = (F.col("n") >= least) & (F.col("n") >= share * F.col("all"))
    named = kids.join(small(whole), [*KEY]).select(*KEY, F.when(stays, F.col("seg")).alias("seg"), F.when(stays, _literal(F.col("seg"))).otherwise(_form(F.col("seg"))).alias("branch"), "n", "labelled", "bad")
    few = named.groupBy(*KEY, "seg", "branch").agg(*sums)
    lists = few.groupBy(*KEY).agg(F.collect_list(F.struct("branch", "labelled", "bad")).alias("b"))
    names = lists.select(*KEY, F.inline(_merged(F.col("b"))))
    literal = few.filter("seg is not null").select(*KEY, "branch", "seg").join(names, [*KEY, "branch"])
    names = _store.materialize(names.filter(F.col("branch").isin("{n}", "{x}", "{w}")).select(*KEY, F.lit(None).cast("string").alias("seg"), "branch", "name").unionByName(literal.select(*KEY, "seg", "branch", "name")), "url-names")
    by_seg = names.filter("seg is not null").select(*KEY, "seg", F.col("name").alias("a"))
    by_form = names.filter("seg is null").select(*KEY, F.col("branch").alias("form"), F.col("name").alias("b"))
    joined = state.withColumn("seg", seg).withColumn("form", _form(seg)).join(small(by_seg), [*KEY, "seg"], "left").join(small(by_form), [*KEY, "form"], "left")
    longer = F.when(F.size("segs") > level, F.concat_ws("/", "template", F.coalesce("a", "b"))).otherwise(F.col("template"))
    out = _store.materialize(joined.withColumn("template", longer).drop("seg", "form", "a", "b"), "url-templates")
    _store.discard(kids, names, state)
    return out


def templates(paths: DataFrame, depth: int = DEPTH, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """The distinct paths (host, path, n, labelled, bad, and any further columns) with their template."""
    segs = F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(F.split(F.substr("path", F.lit(2)), "/"))
    state = paths.withColumn("segs", F.when(F.size(segs) > depth, F.slice(segs, 1, depth)).otherwise(segs)).withColumn("rest", F.size(segs) > depth).withColumn("template", F.lit(""))
    state = _store.materialize(state, "url-templates")
    deepest = state.agg(F.max(F.size("segs"))).first()[0] or 0
    for level in range(deepest):
        state = _descend(state, level, share, least)
    return state.withColumn("template", F.when(F.col("rest"), F.concat("template", F.lit("/{**}"))).otherwise(F.col("template"))).drop("segs", "rest")


def judge_urls(pages: DataFrame, rules: DataFrame, labelled: DataFrame | None = None, *, id: str = "page_id", url: str = "url", depth: int = DEPTH, share: float = SHARE, least: int = LEAST, weight: float = WEIGHT, reject: float = REJECT) -> DataFrame:
    """id, host, path, rule (null: none), verdict, template, purity of every page.

    rules: host, path, verdict (allow or block).  labelled: host, path, labelled, bad of further known urls (counts); they
    shape the templates too.
    """
    rows = pages.select(F.col(id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    paths = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    if labelled is not None:
        more = labelled.groupBy("host", "path").agg(F.sum("labelled").alias("more"), F.sum("bad").alias("worse"))
    else:
        more = paths.select("host", "path", F.lit(0).cast("long").alias("more"), F.lit(0).cast("long").alias("worse")).limit(0)
    paths = paths.join(_ruled(paths, rules), ["host", "path"], "left")
    paths = paths.join(more, ["host", "path"], "full" if labelled is not None else "left")
    known = F.when(F.col("verdict").isNotNull(), F.coalesce("n", F.lit(0))).otherwise(0) + F.coalesce("more", F.lit(0))
    bad = F.when(F.col("verdict") == "block", F.coalesce("n", F.lit(0))).otherwise(0) + F.coalesce("worse", F.lit(0))
    paths = paths.select("host", "path", F.coalesce("n", "more").alias("n"), "rule", "verdict", known.cast("long").alias("labelled"), bad.cast("long").alias("bad"))
    state = templates(paths, depth, share, least)
    sums = _store.materialize(state.groupBy(*KEY).agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")), "url-purity")
    n, k = sums.agg(F.sum("labelled"), F.sum("bad")).first()
    prior = (k / n) if n else 0.0
    pure = sums.select(*KEY, ((F.col("bad") + weight * prior) / (F.col("labelled") + weight)).alias("purity"))
    own = F.when(F.col("purity") >= reject, "block").otherwise("allow")
    judged = state.join(small(pure), [*KEY]).select("host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "template", "purity")
    return rows.join(judged, ["host", "path"], "left").select("page_id", "host", "path", "rule", "verdict", "template", "purity")
