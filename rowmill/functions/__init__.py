from rowmill.functions.dates import iso_hour, is_iso_moment, normalize_date
from rowmill.functions.numbers import detect_separators, normalize_decimal, to_double
from rowmill.functions.text import (
    collapse_text,
    content_hash,
    normalize_boolean,
    normalize_email,
    normalize_header,
    normalize_phone,
    redact,
    strip,
    strip_or_null,
    truncate,
)

__all__ = [
    "collapse_text",
    "content_hash",
    "detect_separators",
    "is_iso_moment",
    "iso_hour",
    "normalize_boolean",
    "normalize_date",
    "normalize_decimal",
    "normalize_email",
    "normalize_header",
    "normalize_phone",
    "redact",
    "strip",
    "strip_or_null",
    "to_double",
    "truncate",
]
