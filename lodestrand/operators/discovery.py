"""Discovery of pages over a category graph, whose members an API gives out in parts.

The frontier is a table of requests: a category, what is asked of it (its pages or its subcategories), where to go on, and how many members it
has given already.  A round sends all open requests at once; an answer that names a continuation opens the next request of
its category, and a subcategory that was not seen before opens its own.  So a level takes as many rounds as its longest
category has parts, cycles end by the set of categories seen, and what is known lies in written tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import cut
from .ordered import numbered

#: Answers requests (kind, category, start, got, size) with those columns, members (array of id, title) and next (null: the end).
Ask = Callable[[DataFrame], DataFrame]
#: Members that one request may ask for.
PART = 500
PAGES, SUBCATEGORIES = "page", "subcat"


def _requests(categories: DataFrame, kinds: list[str], most: int | None, part: int) -> DataFrame:
    size = F.lit(part if most is None else min(part, most))
    return categories.select(F.explode(F.array(*map(F.lit, kinds))).alias("kind"), "category", F.lit(None).cast("string").alias("start"), F.lit(0).alias("got"), size.cast("int").alias("size"))


def gather(ask: Ask, requests: DataFrame, most: int | None, part: int = PART) -> DataFrame:
    """kind, category, n (place in the API's order, from 1), id, title of all that the requests and their continuations give."""
    out, open_ = [], cut(requests)
    while open_.limit(1).count():
        answers = cut(ask(open_))
        out.append(answers.select("kind", "category", "got", F.posexplode("members").alias("p", "m")).select("kind", "category", (F.col("got") + F.col("p") + 1).alias("n"), "m.id", "m.title"))
        after = answers.filter("next is not null").select("kind", "category", F.col("next").alias("start"), (F.col("got") + F.size("members")).alias("got"))
        if most is None:
            open_ = cut(after.withColumn("size", F.lit(part)))
        else:  # pages only: a category's subcategories are asked for in full
            left = F.when(F.col("kind") == PAGES, F.lit(most) - F.col("got")).otherwise(part)
            open_ = cut(after.withColumn("size", F.least(F.lit(part), left)).filter("size > 0"))
    none = requests.select("kind", "category", F.lit(0).alias("n"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("title")).limit(0)
    return reduce(DataFrame.unionByName, out, none)


def discover(ask: Ask, seeds: DataFrame, excluded: Callable[[Column], Column], *, depth: int = 1, max_subcategories: int | None = None, max_pages: int | None = None, part: int = PART) -> tuple[DataFrame, DataFrame]:
    """(pages, categories): category, n, id, title of every page found, and category, depth of every category asked.

    seeds: category.  Excluded categories are neither asked nor passed through.  depth: levels of subcategories below the seeds.
    max_subcategories: new categories of a level, the first by title in any case.  max_pages: of a category, the first that the API names.
    """
    known = cut(seeds.select("category").filter("category is not null").filter(~F.coalesce(excluded(F.col("category")), F.lit(False))).distinct().withColumn("depth", F.lit(0)))
    level, pages = known, []
    for d in range(depth + 1):
        kinds = [PAGES, SUBCATEGORIES] if d < depth else [PAGES]
        got = gather(ask, _requests(level, kinds, max_pages, part), max_pages, part)
        pages.append(got.filter(F.col("kind") == PAGES).drop("kind"))
        if d == depth:
            break
        below = got.filter((F.col("kind") == SUBCATEGORIES) & F.col("title").isNotNull()).select(F.col("title").alias("category")).distinct()
        below = below.filter(~F.coalesce(excluded(F.col("category")), F.lit(False))).join(known, "category", "left_anti")
        if max_subcategories is not None:
            below = numbered(below.withColumn("_low", F.lower("category")), [], ["_low", "category"], "_n").filter(F.col("_n") <= max_subcategories).drop("_low", "_n")
        level = cut(below.withColumn("depth", F.lit(d + 1)))
        if not level.limit(1).count():
            break
        known = cut(known.unionByName(level))
    return reduce(DataFrame.unionByName, pages), known


def table_api(members: DataFrame) -> Ask:
    """An API over a table (kind, category, n from 1, id, title): continuations are places.  For offline runs and tests."""
    sizes = members.groupBy("kind", "category").agg(F.max("n").alias("_all"))

    def ask(requests: DataFrame) -> DataFrame:
        asked = requests.withColumn("_from", F.coalesce(F.col("start").cast("int"), F.lit(0)))
        rows = asked.join(members, ["kind", "category"]).filter((F.col("n") > F.col("_from")) & (F.col("n") <= F.col("_from") + F.col("size")))
        part = rows.groupBy("kind", "category").agg(F.sort_array(F.collect_list(F.struct("n", "id", "title"))).alias("m"))  # at most ``size``
        out = asked.join(part, ["kind", "category"], "left").join(sizes, ["kind", "category"], "left")
        given = F.coalesce(F.transform("m", lambda x: F.struct(x["id"].alias("id"), x["title"].alias("title"))), F.expr("cast(array() as array<struct<id:bigint,title:string>>)"))
        end = F.col("_from") + F.size(given)
        return out.select("kind", "category", "start", "got", "size", given.alias("members"), F.when(end < F.col("_all"), end.cast("string")).alias("next"))

    return ask
