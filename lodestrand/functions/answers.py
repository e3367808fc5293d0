"""Answer comparison functions: exact match, token F1, numbers and dates, list sets; and vector cosine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import DATE, NUMBER, fold, let, normalized_tokens

# Dropped articles and the words that separate list items.
ARTICLES = r"(?U)\b(?:a|an|the|bir)\b"
ITEM_BREAK = r"(?U)[,;]|\band\b|\bve\b"


def _tidy(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalize_answer(text: Column) -> Column:
    """Folded, punctuation but ``. , / -`` dropped, articles dropped, blanks collapsed."""
    bare = F.regexp_replace(fold(text), r"[^\p{L}\p{N}_\s.,/-]", " ")
    return _tidy(F.regexp_replace(bare, ARTICLES, " "))


def _bag(words: Column) -> Column:
    """word#n for the n-th occurrence of each word: multisets become sets."""
    return let(F.sort_array(words), lambda o: F.transform(o, lambda w, i: F.concat(w, F.lit("#"), (i - F.array_position(o, w)).cast("string"))))


def token_f1(prediction: Column, reference: Column) -> Column:
    """Multiset F1 of folded words; two empty sides agree."""

    def of(x: Column) -> Column:
        p, r = x["p"], x["r"]
        both = F.size(F.array_intersect(_bag(p), _bag(r)))
        return F.when((F.size(p) == 0) | (F.size(r) == 0), (F.size(p) == F.size(r)).cast("double")).otherwise(2 * both / (F.size(p) + F.size(r)))

    return let(F.struct(normalized_tokens(prediction).alias("p"), normalized_tokens(reference).alias("r")), of)


def numbers(text: Column) -> Column:
    """Numbers in order, the decimal comma written as a point."""
    return F.transform(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0)), lambda x: F.replace(x, F.lit(","), F.lit(".")))


def dates(text: Column) -> Column:
    """The set of calendar dates, ascending; what is no date of the three forms is left out."""
    found = F.regexp_extract_all(text, F.lit(DATE), F.lit(0))
    parsed = F.transform(found, lambda d: F.coalesce(*(F.try_to_timestamp(d, F.lit(f)).cast("date") for f in ("yyyy-MM-dd", "d/M/yyyy", "d.M.yyyy"))))
    return F.sort_array(F.array_distinct(F.array_compact(parsed)))


def list_items(text: Column) -> Column:
    """The set of normalised items of a list."""
    return F.array_distinct(F.filter(F.transform(F.split(text, ITEM_BREAK, -1), normalize_answer), lambda x: x != ""))


def set_f1(predicted: Column, expected: Column) -> Column:
    """Two empty sets score nothing."""
    n, both = F.size(predicted) + F.size(expected), F.size(F.array_intersect(predicted, expected))
    return F.when(n == 0, F.lit(0.0)).otherwise(2 * both / n)


def best(references: Column, score) -> Column:
    """The highest score over an array of references."""
    return F.array_max(F.transform(references, score))


def answer_scores(prediction: Column, references: Column, is_list: Column) -> dict[str, Column]:
    """The four scores; numbers and dates are null where no reference holds any, list sets where it is no list."""
    has = F.exists(references, lambda r: (F.size(numbers(r)) > 0) | (F.size(dates(r)) > 0))
    same = best(references, lambda r: ((numbers(prediction) == numbers(r)) & (dates(prediction) == dates(r))).cast("double"))
    return {
        "exact_match": let(normalize_answer(prediction), lambda said: best(references, lambda r: (said == normalize_answer(r)).cast("double"))),
        "token_f1": best(references, lambda r: token_f1(prediction, r)),
        "numeric_date_equivalence": F.when(has, same),
        "list_set_f1": F.when(is_list, let(list_items(prediction), lambda items: best(references, lambda r: set_f1(items, list_items(r))))),
    }


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 where a norm is 0."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
