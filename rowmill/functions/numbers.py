"""Numbers written as text: separators, canonical decimal text, guarded casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowmill.functions.text import WS_CHARS, let, strip

# The number grammars accepted in text (after trimming).
PLAIN_DECIMAL = r"^-?(0|[1-9][0-9]*)(\.[0-9]{1,6})?$"
WRITTEN_OUT = r"^[+-]?(?!0*\.0{6}[0-9])([0-9]+\.?[0-9]*|\.[0-9]+)$"
FINITE_DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SPECIAL_DECIMAL = r"^(?i)[+-]?(inf|infinity|s?nan[0-9]*)$"
ANY_DECIMAL = (
    r"^(?i)[+-]?(?:(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|s?nan[0-9]*)$"
)
SIMPLE_NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"
INTEGER = r"^[+-]?[0-9]+(_[0-9]+)*$"
FLOAT = (
    r"^(?i)[+-]?(?:(?:[0-9]+(?:_[0-9]+)*(?:\.(?:[0-9]+(?:_[0-9]+)*)?)?|\.[0-9]+(?:_[0-9]+)*)"
    r"(?:e[+-]?[0-9]+(?:_[0-9]+)*)?|inf|infinity|nan)$"
)

_DECIMAL_PARTS = r"^([+-]?)([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"


def _count(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def detect_separators(c: Column) -> Column:
    """``struct<decimal, thousands>`` guessed from the marks in a number text.

    Both marks: the rightmost is the decimal one. Several marks of one kind group
    thousands. One mark alone stays what it is, so a single comma separates nothing.
    """
    dots, commas = _count(c, "."), _count(c, ",")
    dot_last = F.contains(F.substring_index(c, ",", -1), F.lit("."))
    dot, comma, none = F.lit("."), F.lit(","), F.lit(None).cast("string")

    def pair(decimal, thousands):
        return F.struct(decimal.alias("decimal"), thousands.alias("thousands"))

    return (
        F.when((dots > 0) & (commas > 0) & dot_last, pair(dot, comma))
        .when((dots > 0) & (commas > 0), pair(comma, dot))
        .when(commas > 1, pair(dot, comma))
        .when(dots > 1, pair(comma, dot))
        .otherwise(pair(dot, none))
    )


def _unify_separators(c: Column) -> Column:
    """The same guess applied: grouping marks gone, a dot as decimal mark."""

    def without(mark: str) -> Column:
        return F.replace(c, F.lit(mark), F.lit(""))

    def repeated(mark: str) -> Column:
        return F.substring_index(c, mark, 2) != c

    comma, dot = F.contains(c, F.lit(",")), F.contains(c, F.lit("."))
    dot_last = F.contains(F.substring_index(c, ",", -1), F.lit("."))
    return (
        F.when(comma & dot, F.when(dot_last, without(",")).otherwise(F.replace(without("."), F.lit(","), F.lit("."))))
        .when(comma, F.when(repeated(","), without(",")).otherwise(c))
        .when(repeated("."), without("."))
        .otherwise(c)
    )


def _unsigned(bare: Column) -> Column:
    """Plus sign and leading zeros dropped; most texts have neither."""
    zeros = F.startswith(bare, F.lit("0")) | F.startswith(bare, F.lit("+")) | F.startswith(bare, F.lit("-0"))
    return F.when(zeros, F.regexp_replace(bare, r"^\+?(-?)0*(?=[0-9.])", "$1")).otherwise(bare)


def _written_out(unsigned: Column) -> Column:
    """A zero before and no bare dot at the end."""
    return (
        F.when(unsigned.isin(".", "-."), F.replace(unsigned, F.lit("."), F.lit("0")))
        .when(F.endswith(unsigned, F.lit(".")), F.left(unsigned, F.length(unsigned) - 1))
        .when(F.startswith(unsigned, F.lit(".")), F.concat(F.lit("0"), unsigned))
        .when(F.startswith(unsigned, F.lit("-.")), F.concat(F.lit("-0."), F.substring(unsigned, 3, 1 << 30)))
        .otherwise(unsigned)
    )


def _exponent_parts(bare: Column) -> tuple[Column, Column]:
    """Digits without leading zeros, and the exponent of the last, of a finite number."""

    def part(i):
        return F.regexp_extract(bare, _DECIMAL_PARTS, i)

    digits = F.ltrim(F.concat(part(2), part(3)), F.lit("0"))
    exponent = F.coalesce(part(4).try_cast("int"), F.lit(0)) - F.length(part(3))
    return F.when(digits == "", F.lit("0")).otherwise(digits), exponent


def _scientific(bare: Column, digits: Column, exponent: Column, finite: Column) -> Column:
    """Text of a number with an exponent or a very small fraction, or a special value."""
    left = exponent + F.length(digits)
    plain = (exponent <= 0) & (left > -6)
    point = F.when(plain, left).otherwise(F.lit(1))
    shift = left - point
    body = F.concat(
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= F.length(digits), digits)
        .otherwise(
            F.concat(F.left(digits, point), F.lit("."), F.substring(digits, point + 1, F.length(digits)))
        ),
        F.when(shift == 0, F.lit(""))
        .when(shift > 0, F.concat(F.lit("E+"), shift.cast("string")))
        .otherwise(F.concat(F.lit("E"), shift.cast("string"))),
    )
    low = F.lower(bare)
    sign = F.when(F.startswith(bare, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    payload = F.ltrim(F.regexp_extract(low, "([0-9]*)$", 1), F.lit("0"))
    return F.when(finite, F.concat(sign, body)).when(
        bare.rlike(SPECIAL_DECIMAL),
        F.when(F.contains(low, F.lit("inf")), F.concat(sign, F.lit("Infinity")))
        .when(F.contains(low, F.lit("snan")), F.concat(sign, F.lit("sNaN"), payload))
        .otherwise(F.concat(sign, F.lit("NaN"), payload)),
    )


def decimal_text(bare: Column) -> Column:
    """Canonical text of a trimmed decimal number, null when the text is not a number.

    Follows the General Decimal Arithmetic to-scientific-string rule: digits and
    trailing zeros stay as written, leading zeros and a plus sign go, very small or
    exponent forms become scientific.
    """
    digits, exponent = _exponent_parts(bare)
    rest = let(digits, lambda d: let(exponent, lambda e: _scientific(bare, d, e, bare.rlike(FINITE_DECIMAL))))
    return F.when(bare.rlike(WRITTEN_OUT), let(_unsigned(bare), _written_out)).otherwise(rest)


def _tidy(text: Column) -> Column:
    return F.replace(strip(text), F.lit("_"), F.lit(""))


def _with_given(text: Column, decimal_separator: str | None, thousands_separator: str) -> Column:
    if thousands_separator:
        text = F.replace(text, F.lit(thousands_separator), F.lit(""))
    if decimal_separator and decimal_separator != ".":
        text = F.replace(text, F.lit(decimal_separator), F.lit("."))
    return text


def decimal_stages(
    c: Column, name: str, decimal_separator: str | None = None, thousands_separator: str | None = None
) -> list[dict[str, Column]]:
    """``normalize_decimal`` of a text column in steps, each a projection over the one before,
    so that every value is computed once. The last step is ``name``; what is plain or no number
    stays in generated code there, and the few other numbers take the long way."""
    text, bare = (F.col("`" + f"__{k}_{name}".replace("`", "``") + "`") for k in ("text", "bare"))
    given = decimal_separator is not None and thousands_separator is not None
    parted = _with_given(text, decimal_separator, thousands_separator) if given else _unify_separators(text)
    return [
        {f"__text_{name}": strip(c)},
        {f"__bare_{name}": F.replace(F.btrim(parted, F.lit(WS_CHARS)), F.lit("_"), F.lit(""))},
        {name: F.when(bare.rlike(PLAIN_DECIMAL), bare).when(bare.rlike(ANY_DECIMAL), decimal_text(bare))},
    ]


def normalize_decimal(
    c: Column,
    decimal_separator: str | None = None,
    thousands_separator: str | None = None,
    dtype: str = "string",
) -> Column:
    """Decimal text with a dot; null when it is no number.

    Separators count as given only when both are given, else both are detected. For whole
    columns ``operators.normalize.normalise_decimals`` does the same in generated code.
    """
    if dtype != "string":
        return c.cast("string")

    if decimal_separator is None or thousands_separator is None:
        # what is plain already stays inside generated code
        rest = let(strip(c), lambda t: let(_tidy(_unify_separators(t)), decimal_text))
        return F.when(c.rlike(PLAIN_DECIMAL), c).otherwise(rest)
    return let(_tidy(_with_given(strip(c), decimal_separator, thousands_separator)), decimal_text)


def is_integer_text(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(INTEGER), F.lit(False))


def is_decimal_text(c: Column) -> Column:
    return F.coalesce(F.translate(strip(c), "_", "").rlike(ANY_DECIMAL), F.lit(False))


def to_double(c: Column) -> Column:
    """Double from text in Python's float grammar, null otherwise.

    The guard is needed: Spark alone reads ``1d`` as 1.0.
    """
    return F.when(c.rlike(SIMPLE_NUMBER), c.try_cast("double")).when(
        strip(c).rlike(FLOAT), F.translate(strip(c), "_", "").try_cast("double")
    )


def decimal_to_double(c: Column) -> Column:
    """Nearest double of a decimal text, null when it is no number."""
    bare = F.translate(strip(c), "_", "")
    return F.when(c.rlike(SIMPLE_NUMBER), c.try_cast("double")).when(
        bare.rlike(ANY_DECIMAL), F.regexp_replace(bare, "(?i)s?nan[0-9]*", "NaN").try_cast("double")
    )


def decimal_exact(c: Column) -> Column:
    """Exact decimal(38,18) of a decimal text; null when it has no such value."""
    return F.translate(strip(c), "_", "").try_cast("decimal(38,18)")
