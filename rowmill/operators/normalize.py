"""Row normalisation: trim every text, empty becomes null, other types pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.dates import date_stages
from rowmill.functions.numbers import decimal_stages
from rowmill.functions.text import strip_or_null
from rowmill.records import META, column


def normalise_rows(df: DataFrame) -> DataFrame:
    """Flat record: every text column that is not row metadata."""
    changed = {
        f.name: strip_or_null(column(f.name))
        for f in df.schema.fields
        if f.dataType.simpleString() == "string" and f.name not in META
    }
    return df.select(
        *[changed[n].alias(n) if n in changed else column(n) for n in df.columns]
    )


def normalise_map(df: DataFrame, source: str = "raw", target: str = "normalized") -> DataFrame:
    """Ragged record: every value of a ``map<string,string>``; keys stay."""
    return df.withColumn(target, F.transform_values(F.col(source), lambda _, v: strip_or_null(v)))


def _in_stages(df: DataFrame, stages: list[list[dict]]) -> DataFrame:
    """Projections one after the other, the k-th steps of all columns in one."""
    out = df
    for k in range(max(map(len, stages), default=0)):
        out = out.withColumns({n: c for steps in stages if k < len(steps) for n, c in steps[k].items()})
    return out.select(*[column(c) for c in df.columns])


def normalise_decimals(
    df: DataFrame, names: list[str], decimal_separator: str | None = None, thousands_separator: str | None = None
) -> DataFrame:
    """Text columns as decimal texts, see ``normalize_decimal``; numbers as their texts."""
    types = dict(df.dtypes)
    numbers = {n: column(n).cast("string") for n in names if types[n] != "string"}
    texts = [decimal_stages(column(n), n, decimal_separator, thousands_separator) for n in names if n not in numbers]
    return _in_stages(df.withColumns(numbers) if numbers else df, texts)


def normalise_dates(df: DataFrame, names: list[str], source_format: str | None = None) -> DataFrame:
    """Text columns as ISO dates, see ``normalize_date``."""
    return _in_stages(df, [date_stages(column(n), n, source_format) for n in names])
