"""String, boolean and hash functions. All are plain Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python counts as white space, as a regex class and
# as the set of single characters.
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
WS_CHARS = "".join(
    chr(n)
    for n in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    )
)

# Accepted spellings of booleans.
TRUE_WORDS = ("true", "yes", "1", "y", "on")
FALSE_WORDS = ("false", "no", "0", "n", "off")

# Fixed value: an address after trimming and lower-casing.
EMAIL = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"

# Words that hide a text, looked for in this order.
REDACTED_WORDS = ("password", "token", "secret", "api_key", "ssn", "credit_card")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to a value that is computed once, however often it is used.

    The body runs outside generated code, so it is meant for rare, long branches.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Drop white space at both ends. Spark's ``trim`` alone drops only spaces.

    Texts that start and end with a visible ASCII character, most of them, are passed
    through without looking for the white space characters.
    """
    first, last = F.substring(c, 1, 1), F.substring(c, -1, 1)
    tight = (first > " ") & (first < "\x7f") & (last > " ") & (last < "\x7f")
    return F.when(tight, c).otherwise(F.btrim(c, F.lit(WS_CHARS)))


def strip_or_null(c: Column) -> Column:
    """Trim; what is empty afterwards becomes null."""
    return F.nullif(strip(c), F.lit(""))


def normalize_email(c: Column) -> Column:
    """Trimmed lower-case address, or null when it does not look like one."""
    low = F.lower(strip(c))
    return F.when(low.rlike(EMAIL), low)


def normalize_phone(c: Column) -> Column:
    """Digits and plus signs only; null when nothing is left."""
    return F.nullif(F.regexp_replace(c, "[^0-9+]", ""), F.lit(""))


def normalize_boolean(c: Column, dtype: str = "string") -> Column:
    """Boolean from words, or from a number by being non-zero; null otherwise."""
    if dtype == "boolean":
        return c
    if dtype != "string":
        return c != F.lit(0)
    word = F.lower(strip(c))
    # usual spellings first: lower-casing takes longer than all the rest
    true, false = (sorted({f(w) for w in words for f in (str, str.upper, str.title)}) for words in (TRUE_WORDS, FALSE_WORDS))
    return (
        F.when(c.isin(*true), F.lit(True))
        .when(c.isin(*false), F.lit(False))
        .when(word.isin(*TRUE_WORDS), F.lit(True))
        .when(word.isin(*FALSE_WORDS), F.lit(False))
    )


def collapse_text(c: Column, max_length: int | None = None) -> Column:
    """Trim, turn each run of white space into one space, optionally cut; empty is null."""
    text = F.regexp_replace(strip(c), f"{WS}+", " ")
    if max_length:
        text = F.left(text, F.lit(max_length))
    return F.nullif(text, F.lit(""))


def truncate(c: Column, max_length: int = 100) -> Column:
    """Cut longer texts so that they end in three dots and have ``max_length`` characters."""
    if max_length < 3:
        raise ValueError("max_length must be at least 3")
    return F.when(F.length(c) <= max_length, c).otherwise(
        F.concat(F.left(c, F.lit(max_length - 3)), F.lit("..."))
    )


def content_hash(c: Column, algorithm: str = "sha256") -> Column:
    """Hex digest of a binary or string column."""
    if algorithm == "sha256":
        return F.sha2(c, 256)
    if algorithm == "md5":
        return F.md5(c)
    if algorithm == "sha1":
        return F.sha1(c)
    if algorithm in ("sha224", "sha384", "sha512"):
        return F.sha2(c, int(algorithm[3:]))
    raise ValueError(f"unsupported hash: {algorithm}")


def redact(c: Column) -> Column:
    """Replace the whole text when it contains one of the hidden words."""
    low = F.lower(c)
    out = None
    for word in REDACTED_WORDS:
        hit = F.contains(low, F.lit(word))
        label = F.lit(f"[REDACTED: {word}]")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(c)


# Fixed value: what a header is freed of.
HEADER_MARKS = r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x85\p{Z}]"


def normalize_header(c: Column) -> Column:
    """Lower-case header without punctuation; letters, digits, underscore and space stay."""
    return F.lower(F.regexp_replace(c, HEADER_MARKS, ""))


def normal_header(name: str) -> str:
    """The same of a name that is known when the plan is made."""
    return "".join(x for x in name if x == "_" or x.isspace() or unicodedata.category(x)[0] in "LN" or unicodedata.category(x)[0] == "Z").lower()
