"""Duplicate detection by key, and the fuzzy text predicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.text import strip
from rowmill.operators.joins import SALT
from rowmill.records import ERROR_TYPE, NO_ERRORS, Fields

KEY = "dedup_key"
PLACE = "__place"


def dedup_key(fields: Fields, names: list[str], fallback: Fields | None = None) -> Column:
    """MD5 of the lower-case trimmed key values joined by a bar.

    A null value is left out, an absent field counts as an empty text. A row without
    any canonical field takes its values from ``fallback``.
    """

    def parts(source: Fields) -> Column:
        texts = []
        for name in names:
            has = source.has(name)
            text = strip(F.lower(source.text(name)))
            if has is False:
                text = F.lit("")
            elif has is not True:
                text = F.when(has, text).otherwise(F.lit(""))
            texts.append(text)
        return F.md5(F.concat_ws("|", *texts))

    key = parts(fields)
    if fallback is None:
        return key
    empty = F.size(fields.present_names()) == 0
    return F.when(empty, parts(fallback)).otherwise(key)


def with_dedup_key(df: DataFrame, names: list[str], fields: Fields | None = None) -> DataFrame:
    return df.withColumn(KEY, dedup_key(fields or Fields.flat(df), names))


def _dealt(df: DataFrame, key: Column, position: Column, salts: int) -> DataFrame:
    return df.withColumn(KEY, key).withColumn(
        SALT, F.pmod(F.xxhash64(position), F.lit(salts)).cast("int")
    )


def duplicate_groups(
    df: DataFrame, names: list[str], position: str = "line_number", fields: Fields | None = None
) -> DataFrame:
    """Keys held by two or more rows: ``dedup_key, first_position, n_rows``.

    Only min and count are taken per key, so partial aggregation keeps hot keys cheap.
    """
    key = dedup_key(fields or Fields.flat(df), names)
    return (
        df.select(key.alias(KEY), F.col(position).alias("__position"))
        .groupBy(KEY)
        .agg(F.min("__position").alias("first_position"), F.count("*").alias("n_rows"))
        .where("n_rows > 1")
    )


def _with_first(
    df: DataFrame, names: list[str], position: str, fields: Fields | None, salts: int, how: str
) -> DataFrame:
    """Join each row to the first position of its duplicate group.

    Groups are counted per (key, salt) and then per key; the result goes back only to
    the salts a key really has. A hot key is thereby split over all salts, while the
    joined side never has more rows than there are duplicates.
    """
    key = dedup_key(fields or Fields.flat(df), names)
    dealt = _dealt(df, key, F.col(position), salts)
    groups = (
        dealt.groupBy(KEY, SALT)
        .agg(F.min(position).alias("first_position"), F.count("*").alias("n"))
        .groupBy(KEY)
        .agg(
            F.min("first_position").alias("first_position"),
            F.sum("n").alias("n_rows"),
            F.collect_set(SALT).alias("salts"),  # at most `salts` small numbers
        )
        .where("n_rows > 1")
        .select(KEY, "first_position", "n_rows", F.explode("salts").alias(SALT))
    )
    return dealt.join(groups, [KEY, SALT], how).drop(SALT)


def duplicate_members(
    df: DataFrame,
    names: list[str],
    position: str = "line_number",
    fields: Fields | None = None,
    salts: int = 64,
) -> DataFrame:
    """All rows of all duplicate groups, one row per member, with its group's numbers.

    The long form of key -> positions: no group is ever held in one array.
    """
    return _with_first(df, names, position, fields, salts, "inner")


def mark_duplicates(
    df: DataFrame,
    names: list[str],
    position: str | None = None,
    keep_first: bool = True,
    fields: Fields | None = None,
    salts: int = 64,
) -> DataFrame:
    """Append a ``duplicate`` error to all rows of a group but the first (or to all).

    The row status stays as it is. Rows are ordered by file, line and row id, and the first
    row's id is named; ``position`` names one column, unique over the rows, to do both
    instead.
    """
    source = df
    if "validation_errors" not in df.columns:
        source = df.withColumn("validation_errors", F.array().cast(NO_ERRORS))
    place = F.struct("file_id", "line_number", "row_id") if position is None else F.col(position)
    joined = _with_first(source.withColumn(PLACE, place), names, PLACE, fields or Fields.flat(df), salts, "left")
    marked = F.col("first_position").isNotNull()
    if keep_first:
        marked = marked & (F.col(PLACE) != F.col("first_position"))
    first = F.col("first_position.row_id") if position is None else F.col("first_position")
    error = F.struct(
        F.lit("_deduplicate").alias("field"),
        F.lit(None).cast("string").alias("fields"),
        F.lit("duplicate").alias("rule"),
        F.concat(F.lit("Duplicate of row "), first.cast("string")).alias("message"),
    ).cast(ERROR_TYPE)
    errors = F.when(marked, F.array_append("validation_errors", error)).otherwise(
        F.col("validation_errors")
    )
    return joined.withColumn("validation_errors", errors).select(*source.columns)


def fuzzy_match(a: Column, b: Column, threshold: float = 0.85) -> Column:
    """Whether two texts are similar enough; asymmetric.

    Equal ignoring case and outer space; or lengths within 30 % and the share of the
    first text's characters that occur in the second reaching the threshold.
    """
    x, y = strip(F.lower(a)), strip(F.lower(b))
    longer = F.greatest(F.length(x), F.length(y))
    common = F.length(x) - F.length(F.call_function("translate", x, y, F.lit("")))
    close = F.abs(F.length(x) - F.length(y)) <= longer * F.lit(0.3)
    similar = F.when(longer > 0, common / longer >= F.lit(float(threshold))).otherwise(F.lit(False))
    filled = (a != "") & (b != "")
    return F.coalesce(filled & ((x == y) | (close & similar)), F.lit(False))
