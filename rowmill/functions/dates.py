"""Dates and moments written as text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowmill.functions.text import WS, let, strip

# Date formats tried in this order after the ISO prefix test.
DATE_FORMATS = (
    "%Y-%m-%d",
    "%Y/%m/%d",
    "%d-%m-%Y",
    "%d/%m/%Y",
    "%m-%d-%Y",
    "%m/%d/%Y",
    "%Y%m%d",
    "%d.%m.%Y",
    "%Y-%m-%d %H:%M:%S",
    "%d/%m/%Y %H:%M:%S",
)

# What each directive of a date format matches.
DIRECTIVES = {
    "Y": r"([0-9]{4})",
    "y": r"([0-9]{2})",
    "m": r"(1[0-2]|0[1-9]|[1-9])",
    "d": r"(3[0-1]|[1-2][0-9]|0[1-9]|[1-9]| [1-9])",
    "H": r"(?:2[0-3]|[0-1][0-9]|[0-9])",
    "M": r"(?:[0-5][0-9]|[0-9])",
    "S": r"(?:[0-5][0-9]|[0-9])",
    "f": r"(?:[0-9]{1,6})",
    "b": r"((?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec))",
    "B": r"((?i:january|february|march|april|may|june|july|august|september|october|november|december))",
    "%": r"%",
}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _compile_format(fmt: str) -> tuple[str, dict[str, int]]:
    """Regex of a date format, and the group numbers of its year, month and day."""
    regex, groups, count, i = "", {}, 0, 0
    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            directive = fmt[i + 1]
            if directive not in DIRECTIVES:
                raise ValueError(f"unsupported directive %{directive} in {fmt!r}")
            if directive in "Yymdb" or directive == "B":
                count += 1
                groups[directive] = count
            regex += DIRECTIVES[directive]
            i += 2
        elif fmt[i].isspace():
            while i < len(fmt) and fmt[i].isspace():
                i += 1
            regex += f"{WS}+"
        else:
            regex += re.escape(fmt[i])
            i += 1
    return f"^{regex}$", groups


def parse_date(c: Column, fmt: str) -> Column:
    """Date of a text in a ``%``-style format, null when it does not fit."""
    regex, groups = _compile_format(fmt)

    def number(directive):
        return F.trim(F.regexp_extract(c, regex, groups[directive]))

    if "Y" in groups:
        year = number("Y")
    elif "y" in groups:
        short = number("y")
        year = F.concat(F.when(short >= "69", F.lit("19")).otherwise(F.lit("20")), short)
    else:
        year = F.lit("1900")
    if "m" in groups:
        month = number("m")
    elif "b" in groups or "B" in groups:
        name = F.lower(F.left(number("b" if "b" in groups else "B"), F.lit(3)))
        month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name).cast("string")
    else:
        month = F.lit("1")
    day = number("d") if "d" in groups else F.lit("1")
    built = F.concat_ws("-", year, month, day).try_cast("date")
    return F.when(c.rlike(regex) & (year != "0000"), built)


ISO_START = f"^{WS}*[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}"


def normalize_date(c: Column, source_format: str | None = None) -> Column:
    """``yyyy-MM-dd`` text.

    A text that starts like an ISO date is cut to it unchecked; else the source
    format is tried, then the known formats in order; else null. Formats are tried
    only on texts holding their separator. For whole columns
    ``operators.normalize.normalise_dates`` does the same in generated code.
    """
    # ISO texts stay inside generated code, the others are looked at one format at a time
    return F.when(c.rlike(ISO_START), F.left(strip(c), F.lit(10))).otherwise(let(strip(c), lambda t: by_format(t, source_format)))


def date_stages(c: Column, name: str, source_format: str | None = None) -> list[dict[str, Column]]:
    """``normalize_date`` of a text column in two projections, so that the text is trimmed
    once and all is generated code."""
    text = f"__text_{name}"
    bare = F.col("`" + text.replace("`", "``") + "`")
    # the text before trimming may start with white space; after it, with the year
    iso = bare.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}")
    return [{text: strip(c)}, {name: F.when(iso, F.left(bare, F.lit(10))).otherwise(by_format(bare, source_format))}]


def by_format(text: Column, source_format: str | None = None) -> Column:
    """A trimmed text by the source format and the known ones."""
    formats = ([source_format] if source_format else []) + list(DATE_FORMATS)
    tries = {sep: [f for f in formats if sep in f] for sep in ("/", "-", ".")}
    compact = [f for f in formats if not re.search(r"[-/.]", f)]

    def first_of(candidates):
        return F.coalesce(*[parse_date(text, f) for f in candidates]).cast("string")

    out = None
    if source_format and sum(sep in source_format for sep in tries) > 1:
        # a source format that mixes separators is tried before the grouped formats
        mixed = first_of([source_format])
        out = F.when(mixed.isNotNull(), mixed)
    for sep, candidates in tries.items():
        holds, parsed = F.contains(text, F.lit(sep)), first_of(candidates)
        out = F.when(holds, parsed) if out is None else out.when(holds, parsed)
    return out.otherwise(first_of(compact))


_TIME = (
    r"(?:(?:[01][0-9]|2[0-3])(?::[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]+)?)?)?"
    r"|(?:[01][0-9]|2[0-3])[0-5][0-9](?:[0-5][0-9](?:[.,][0-9]+)?)?)"
)
_MONTH, _DAY = r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12][0-9]|3[01])"
_WEEK, _WEEKDAY = r"(?:0[1-9]|[1-4][0-9]|5[0-3])", r"[1-7]"
_TAIL = rf"(?s:.({_TIME})(?:Z|[+-]{_TIME})?)?\z"
ISO_CALENDAR = rf"^([0-9]{{4}})(?:-({_MONTH})-({_DAY})|({_MONTH})({_DAY})){_TAIL}"
ISO_WEEK = rf"^([0-9]{{4}})(?:-W({_WEEK})(?:-({_WEEKDAY}))?|W({_WEEK})({_WEEKDAY})?){_TAIL}"


def is_iso_moment(c: Column) -> Column:
    """Whether a text is an ISO 8601 date or date-time; null and other texts are false."""
    year = F.left(c, F.lit(4))
    extended = F.left(c, F.lit(10)).try_cast("date").isNotNull()
    compact = (
        F.concat_ws("-", year, F.substring(c, 5, 2), F.substring(c, 7, 2)).try_cast("date").isNotNull()
    )
    calendar = F.when(F.substring(c, 5, 1) == "-", extended).otherwise(compact)
    week = F.greatest(
        F.regexp_extract(c, ISO_WEEK, 2).try_cast("int"),
        F.regexp_extract(c, ISO_WEEK, 4).try_cast("int"),
    )
    last_week = F.weekofyear(F.concat(year, F.lit("-12-28")).try_cast("date"))
    return F.coalesce(
        F.when(year == "0000", F.lit(False))
        .when(c.rlike(ISO_CALENDAR), calendar)
        .when(c.rlike(ISO_WEEK), week <= last_week),
        F.lit(False),
    )


def iso_hour(c: Column) -> Column:
    """Hour as written in an ISO moment, 0 for a bare date, null for other texts."""
    clock = (
        F.when(F.substring(c, 5, 1) != "-", F.substring(c, 10, 2))
        .when(F.substring(c, 6, 1) != "W", F.substring(c, 12, 2))
        .otherwise(F.regexp_extract(c, ISO_WEEK, 6))
    )
    clock = F.when(F.substring(c, 5, 1) == "W", F.regexp_extract(c, ISO_WEEK, 6)).otherwise(clock)
    # a cast that fails costs an exception, so a bare date is told before
    hour = F.coalesce(F.when(clock != "", F.left(clock, F.lit(2)).try_cast("int")), F.lit(0))
    return F.when(is_iso_moment(c), hour)
