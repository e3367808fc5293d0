"""Sections of documents by their bookmarks, over rows of layout: intervals of (page, y) and the blocks that lie in them.

bookmarks: path, n (order), level, title, page, y.  blocks: path, page, y, text.  A section begins at its bookmark and ends at the next one of
its level or above.  Intervals meet blocks page by page, by equal keys, so a section costs its own pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Levels and titles of sections that may be chosen, and the words that one needs.
LEVELS, TITLE, EXCLUDED, WORDS = (2, 3), r"(?i)^(?:CS-E|AMC)\b", "appendix", 5


def intervals(bookmarks: DataFrame) -> DataFrame:
    """The bookmarks with the place where their section ends (end_page, end_y; null: the document's end)."""
    after = Window.partitionBy("path").orderBy("n").rowsBetween(1, Window.unboundedFollowing)
    levels = {n: F.first(F.when((F.col("level") <= n) & (F.col("page") >= 0), F.struct("page", "y")), ignorenulls=True).over(after) for n in range(1, 7)}
    end = None
    for n, next_ in levels.items():
        end = F.when(F.col("level") == n, next_) if end is None else end.when(F.col("level") == n, next_)
    return bookmarks.withColumn("_end", end.otherwise(levels[6])).withColumn("end_page", F.col("_end.page")).withColumn("end_y", F.col("_end.y")).drop("_end")


def remainder(hex_digits: Column, by: Column) -> Column:
    """A number of any length in hex digits modulo a small one, digit by digit."""
    digits = F.transform(F.sequence(F.lit(1), F.length(hex_digits)), lambda i: F.instr(F.lit("0123456789abcdef"), F.substr(hex_digits, i, F.lit(1))) - 1)
    return F.aggregate(digits, F.lit(0).cast("long"), lambda a, d: (a * 16 + d) % by)


def chosen(bookmarks: DataFrame, documents: DataFrame, seed: int) -> DataFrame:
    """path, chosen, eligible, level, title, page, y, end_page, end_y: of each document with eligible sections the one that seed and checksum draw.

    documents: path, checksum.
    """
    fit = F.col("level").isin(*LEVELS) & T.strip(F.col("title")).rlike(TITLE) & ~F.contains(F.lower("title"), F.lit(EXCLUDED))
    rows = intervals(bookmarks).filter(fit).withColumn("place", F.row_number().over(Window.partitionBy("path").orderBy("n")) - 1)
    drawn = rows.groupBy("path").agg(F.count(F.lit(1)).alias("eligible")).join(documents.select("path", "checksum"), "path")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), "checksum"), 256)
    drawn = drawn.select("path", "eligible", remainder(digest, F.col("eligible")).alias("chosen"))
    title = T.strip(F.regexp_replace("title", r"(?U)[\s\x1C-\x1F]+", " "))
    return rows.join(drawn, "path").filter("place = chosen").select("path", "chosen", "eligible", "level", title.alias("title"), "page", "y", "end_page", "end_y")


def texts(blocks: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """The keys with the text of each span (path, page, y, end_page, end_y): the blocks from its start up to its end, by page and height.

    A page's blocks are lines, pages are parted by a blank line; a span without a block has no row.
    """
    last = blocks.groupBy("path").agg(F.max("page").alias("_last"))
    until = F.least("_last", F.coalesce("end_page", "_last"))
    pages = spans.join(last, "path").filter(until >= F.col("page")).withColumn("_p", F.explode(F.sequence("page", until)))
    body = T.strip(F.col("text"))
    lines = blocks.select("path", F.col("page").alias("_p"), F.col("y").alias("_y"), body.alias("_t")).filter("_t <> ''")
    inside = ((F.col("_p") > F.col("page")) | (F.col("_y") >= F.col("y"))) & (F.col("end_page").isNull() | (F.col("_p") < F.col("end_page")) | (F.col("_y") < F.col("end_y")))
    met = pages.join(lines, ["path", "_p"]).filter(inside)
    own = [*dict.fromkeys(["path", *keys])]
    page = met.groupBy(*own, "_p").agg(F.sort_array(F.collect_list(F.struct("_y", "_t"))).alias("_b"))  # a page's blocks
    page = page.select(*own, "_p", F.array_join(F.transform("_b", lambda b: b["_t"]), "\n").alias("_t"))
    whole = page.groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("_p", "_t"))).alias("_b"))  # a section's pages
    return whole.select(*own, F.array_join(F.transform("_b", lambda b: b["_t"]), "\n\n").alias("text"))


def drawn_sections(documents: DataFrame, bookmarks: DataFrame, blocks: DataFrame, seed: int = 0) -> DataFrame:
    """path, title, chosen, eligible, markdown, error of every document: its drawn section as markdown, or why there is none."""
    picked = chosen(bookmarks, documents, seed)
    read = texts(blocks, picked, ["path"])
    rows = documents.select("path").join(picked, "path", "left").join(read, "path", "left")
    few = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"(?U)\w+")) < WORDS
    error = F.when(F.col("chosen").isNull(), "no eligible section among the bookmarks").when(few, F.concat("title", F.lit(" section is empty")))
    return rows.select("path", "title", "chosen", "eligible", F.when(error.isNull(), F.concat(F.lit("# "), "title", F.lit("\n\n"), "text")).alias("markdown"), error.alias("error"))
