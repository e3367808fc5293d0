"""Text functions as column expressions, with exact Unicode folding as Arrow UDFs where the JVM has no equal.

Words are ``[\\p{L}\\p{N}_]+`` runs joined by single apostrophes, dots or hyphens; lengths and offsets are in code points.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Patterns, word lists and limits that results depend on.
TOKEN = r"[\p{L}\p{N}_]+(?:['’.-][\p{L}\p{N}_]+)*"
EMAIL = r"(?i)\b[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}\b"
IDENTITY_NUMBER = r"(?i)\b(?:T\.?C\.?\s*)?(?:kimlik|identity)\s*(?:no|number|numarası)?\s*[:#]?\s*\d{11}\b"
HOME_ADDRESS = r"(?i)\b(?:home|residential|ev)\s+address\b"
CURRENT_CLAIM = r"(?i)\b(?:current|fleet|filo|mevcut|güncel)\b"
BOILERPLATE = r"(?i)\b(?:Authority control databases|Otorite kontrolü)\b"
TURKISH_WORDS = ("bir", "ve", "için", "hava", "olan", "ile", "pist")
ENGLISH_WORDS = ("the", "and", "for", "aircraft", "runway", "with")
TURKISH_LETTERS = "çğıöşü"
OVERSIZED, LIST_HEAVY_TOKENS, LIST_HEAVY_SHARE = 20_000, 1_000, 0.75
LONG_LINE, LONG_LINES, DUPLICATE_SHARE, HEADING_RUN = 60, 20, 0.15, 2
VERY_SHORT, REPLACEMENT_SHARE = 10, 0.001
NUMBER = r"\b\d+(?:[.,]\d+)?\b"
DATE = r"\b(?:\d{4}-\d{2}-\d{2}|\d{1,2}[./]\d{1,2}[./]\d{4})\b"


#: Texts made at a time: a batch's texts are never all Python objects at once.
PART = 64


def _by_parts(texts: pa.Array, change) -> pa.Array:
    parts = [pa.array([t and change(t) for t in texts.slice(i, PART).to_pylist()], pa.string()) for i in range(0, len(texts), PART)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


@F.arrow_udf(StringType())
def nfkc(texts: pa.Array) -> pa.Array:
    """Unicode NFKC."""
    return _by_parts(texts, lambda t: unicodedata.normalize("NFKC", t))


@F.arrow_udf(StringType())
def nfkc_casefold(texts: pa.Array) -> pa.Array:
    """Unicode NFKC, then full case folding."""
    return _by_parts(texts, lambda t: unicodedata.normalize("NFKC", t).casefold())


def fold(text: Column) -> Column:
    """Case folding on the JVM: exact for all letters but a few rare scripts; ``nfkc_casefold`` is exact for all."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def normalized_tokens(text: Column, exact: bool = False) -> Column:
    return tokens(nfkc_casefold(text) if exact else fold(text))


def normalize_text(text: Column, exact: bool = True) -> Column:
    """Compatibility form, Unix line ends, no trailing blanks, one newline at the end."""
    out = F.regexp_replace(nfkc(text) if exact else text, r"\r\n?", "\n")
    out = F.regexp_replace(out, r"(?U)[\s\x1C-\x1F&&[^\n]]+(?=\n|\z)", "")
    return F.concat(strip(out), F.lit("\n"))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+\z", "")


def normalized_for_hash(text: Column, exact: bool = False) -> Column:
    """What equal texts have in common: folded, white space collapsed."""
    folded = nfkc_casefold(text) if exact else fold(text)
    return strip(F.regexp_replace(folded, r"(?U)[\s\x1C-\x1F]+", " "))


def content_hash(text: Column, exact: bool = False) -> Column:
    return F.sha2(normalized_for_hash(text, exact), 256)


def stable_id(prefix: str, *parts: Column | str | int, length: int = 24) -> Column:
    """prefix_ and the start of the SHA-256 of the parts as a compact JSON array."""
    pieces = []
    for p in parts:
        c = p if isinstance(p, Column) else F.lit(p)
        # A string becomes its JSON literal; numbers and booleans their own.
        pieces.append(F.regexp_replace(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', "$1"))
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.concat(F.lit("["), F.concat_ws(",", *pieces), F.lit("]")), 256), 1, length))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once.  An expression that a lambda names is else computed for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingles(words: Column, width: int, hashed: bool = False) -> Column:
    """Distinct runs of ``width`` words; a shorter text is one run, none if it has no word.  hashed: a hash of each run, not yet distinct."""

    def of(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(1))), lambda i: (F.xxhash64 if hashed else lambda x: x)(F.array_join(F.slice(w, i, width), " ")))
        return F.when(F.size(w) == 0, F.expr(f"cast(array() as array<{'bigint' if hashed else 'string'}>)")).otherwise(runs if hashed else F.array_distinct(runs))

    return let(words, of)


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets; two empty sets are alike."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _count(text: Column, word: str) -> Column:
    return F.regexp_count(text, F.lit(rf"(?U)\b{word}\b"))


def _letters(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def detect_language(text: Column, declared: Column | None = None) -> Column:
    """The one declared language, else the one whose letters and words the text shows; ``und`` for neither."""
    low = fold(text)
    turkish = sum((_count(low, w) for w in TURKISH_WORDS), _letters(low, TURKISH_LETTERS))
    english = sum((_count(low, w) for w in ENGLISH_WORDS[1:]), _count(low, ENGLISH_WORDS[0]))
    seen = F.when(turkish > english, "tr").when(english > 0, "en").otherwise("und")
    return seen if declared is None else F.when(F.size(declared) == 1, F.element_at(declared, 1)).otherwise(seen)


def personal_data(text: Column) -> Column:
    return (text.contains("@") & text.rlike(EMAIL)) | text.rlike(IDENTITY_NUMBER) | text.rlike(HOME_ADDRESS)


def quality_flags(text: Column, headings_first: Column | None = None, article: Column | None = None, n: Column | None = None) -> Column:
    """Extraction flags of a canonical text, as an array; n: its number of words, where it is known.

    The lines and the long ones among them are bound once; what tells an unlikely flag early is asked first.
    """
    size = F.length(text)
    lines = F.filter(F.transform(F.split(text, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]", -1), strip), lambda x: x != "")
    listed = lambda x: F.size(F.filter(x, lambda y: y.startswith("-") & y.rlike(r"^-\s+")))

    def repeated(x: Column) -> Column:
        return let(F.filter(x, lambda y: F.length(y) >= LONG_LINE), lambda long: F.when((F.size(long) >= LONG_LINES) & (1 - F.size(F.array_distinct(long)) / F.size(long) > DUPLICATE_SHARE), "excessive_duplicate_lines"))

    def of(v: Column) -> Column:
        words, rows = v["n"], v["lines"]
        found = [
            F.when(words > OVERSIZED, "oversized_document"),
            F.when((words > LIST_HEAVY_TOKENS) & (listed(rows) / F.greatest(F.size(rows), F.lit(1)) > LIST_HEAVY_SHARE), "list_heavy_document"),
            repeated(rows),
            F.when(words < VERY_SHORT, "very_short"),
            F.when((size > 0) & text.contains("\ufffd") & (_letters(text, "\ufffd") / size > REPLACEMENT_SHARE), "encoding_replacement_noise"),
        ]
        if headings_first is not None:
            found.append(F.when(headings_first > HEADING_RUN, "detached_heading_run"))
        if article is not None:
            found.append(F.when(article & text.rlike(BOILERPLATE), "html_boilerplate_remaining"))
        return F.array_compact(F.array(*found))

    return let(F.struct((F.size(tokens(text)) if n is None else n).alias("n"), lines.alias("lines")), of)


def safe_shard(name: Column) -> Column:
    """A name fit for a folder; ``unknown`` if nothing of it is."""
    kept = F.regexp_replace(F.regexp_replace(F.coalesce(name, F.lit("")), r"[^A-Za-z0-9_.-]+", "_"), r"^_+|_+$", "")
    return F.when(kept == "", "unknown").otherwise(kept)


def detect_mime(content: Column, path: Column, declared: Column | None = None) -> Column:
    """A content type: spreadsheet by name and magic, then what was declared, magic bytes, looks, and the name's ending."""
    head = F.lower(F.trim(F.decode(F.substring(content, 1, 256), "ISO-8859-1")))
    name = F.lower(path)
    magic = F.decode(F.substring(content, 1, 4), "ISO-8859-1")
    said = F.lit(None).cast("string") if declared is None else F.trim(F.lower(F.substring_index(declared, ";", 1)))
    word, sheet = "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
    by_name = F.when(name.endswith(".csv"), "text/csv").when(name.endswith(".md"), "text/markdown").when(name.endswith(".txt"), "text/plain").when(name.endswith(".json"), "application/json").when(name.endswith(".xml"), "application/xml").when(name.rlike(r"\.html?$"), "text/html")
    return (
        F.when(name.endswith(".xlsx") & (F.substring(magic, 1, 2) == "PK"), sheet)
        .when(said.isNotNull() & ~said.isin("", "application/octet-stream"), said)
        .when(magic == "%PDF", "application/pdf")
        .when((F.substring(magic, 1, 2) == "PK") & name.endswith(".docx"), word)
        .when(F.substring(magic, 1, 2) == "PK", "application/zip")
        .when(head.startswith("<!doctype html") | head.startswith("<html"), "text/html")
        .when(head.startswith("<?xml"), "application/xml")
        .when(head.rlike(r"^[{\[]"), "application/json")
        .otherwise(F.coalesce(by_name, F.lit("application/octet-stream")))
    )
