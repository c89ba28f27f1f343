"""Reports over validated rows: totals, error distributions, listings, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.operators.mapping import canonical_map
from rowmill.operators.paging import Pages

ERRORS = "validation_errors"


def is_status(status: str) -> Column:
    return F.col("status") == F.lit(status)


def with_status(df: DataFrame, status: str | None = None) -> DataFrame:
    """Rows of one status; ``None`` keeps all."""
    return df if status is None else df.where(is_status(status))


def valid_percentage(valid: Column, total: Column) -> Column:
    """Two decimals, 0 when there are no rows."""
    return F.coalesce(F.round(F.lit(100.0) * valid / F.nullif(total, F.lit(0)), 2), F.lit(0.0))


def _counts() -> list[Column]:
    return [
        F.count("*").alias("total_rows"),
        F.count_if(is_status("valid")).alias("valid_rows"),
        F.count_if(is_status("flagged")).alias("flagged_rows"),
    ]


def totals(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Total, valid and flagged rows with the valid percentage, whole or per group."""
    counted = df.groupBy(*(by or [])).agg(*_counts())
    return counted.withColumn(
        "valid_percentage", valid_percentage(F.col("valid_rows"), F.col("total_rows"))
    )


def export_stats(df: DataFrame, by: str = "export_id", started: str | None = None,
                 finished: str | None = None) -> DataFrame:
    """Rows, valid, flagged, number of exports and seconds per export id."""
    out = [*_counts(), F.count_distinct("source_name").alias("export_count")]
    if started and finished:
        span = F.max(finished).cast("double") - F.min(started).cast("double")
        out.append(span.alias("duration_seconds"))
    return df.groupBy(by).agg(*out)


def errors_exploded(df: DataFrame) -> DataFrame:
    """One row per error of the flagged rows."""
    return df.where(is_status("flagged")).select(F.explode(ERRORS).alias("error")).select("error.*")


def top_rules(counts: DataFrame, top: int | None = 5) -> DataFrame:
    """Errors per rule of (rule, field, errors) counts, most frequent first, ties by name."""
    ordered = counts.groupBy("rule").agg(F.sum("errors").alias("errors")).orderBy(F.desc("errors"), "rule")
    return ordered if top is None else ordered.limit(top)


def per_field(counts: DataFrame) -> DataFrame:
    """Errors per field of (rule, field, errors) counts; several fields count as ``unknown``."""
    field = F.coalesce(F.col("field"), F.lit("unknown")).alias("field")
    return counts.groupBy(field).agg(F.sum("errors").alias("errors"))


def stored_counts(df: DataFrame) -> DataFrame:
    """(rule, field, errors) of validated rows. For rows about to be validated,
    ``validate.error_counts`` gives the same without building errors."""
    return errors_exploded(df).groupBy("rule", "field").agg(F.count("*").alias("errors"))


def errors_by_rule(df: DataFrame, top: int | None = 5) -> DataFrame:
    """Errors per rule of validated rows, most frequent first, ties by name."""
    return top_rules(stored_counts(df), top)


def errors_by_field(df: DataFrame) -> DataFrame:
    """Errors per field of validated rows; an error over several fields counts as ``unknown``."""
    return per_field(stored_counts(df))


def summary_record(df: DataFrame, batch_id: str, file_name: str | None = None) -> DataFrame:
    """The whole summary as one row: totals, top rules and fields as arrays.

    One pass: rows shrink to counts per status, rule and field, as many as the rule set
    has, and all the rest is made of those.
    """
    errors = F.when(is_status("flagged"), F.col(ERRORS))
    small = (
        df.select("status", F.posexplode_outer(errors).alias("at", "error"))
        .select(
            "status",
            (F.coalesce("at", F.lit(0)) == 0).alias("first"),
            F.col("error.rule").alias("rule"),
            F.when(F.col("error").isNotNull(), F.coalesce("error.field", F.lit("unknown"))).alias("field"),
        )
        .groupBy("status", "first", "rule", "field")
        .agg(F.count("*").alias("n"))
    )
    names = ["status", "first", "rule", "field"]
    sets = small.groupingSets([["status", "first"], ["rule"], ["field"]], *names).agg(F.grouping_id().alias("g"), F.sum("n").alias("n"))
    by_status, by_rule, by_field = (F.col("g") == g for g in (0b0011, 0b1101, 0b1110))
    rows = lambda *status: F.coalesce(F.sum(F.when(by_status & F.col("first") & F.col("status").isin(*status), F.col("n"))), F.lit(0))
    one = sets.agg(
        F.coalesce(F.sum(F.when(by_status & F.col("first"), F.col("n"))), F.lit(0)).alias("total_rows"),
        rows("valid").alias("valid_rows"),
        rows("flagged").alias("flagged_rows"),
        F.sort_array(F.collect_list(F.when(by_rule & F.col("rule").isNotNull(), F.struct((-F.col("n")).alias("k"), "rule")))).alias("rules"),
        F.sort_array(F.collect_list(F.when(by_field & F.col("field").isNotNull(), F.struct("field", "n")))).alias("fields"),
    )
    percentage = valid_percentage(F.col("valid_rows"), F.col("total_rows")).alias("valid_percentage")
    return one.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(file_name).cast("string").alias("file_name"),
        F.current_timestamp().alias("generated_at"),
        F.struct("total_rows", "valid_rows", "flagged_rows", percentage).alias("summary"),
        F.transform(F.slice("rules", 1, 5), lambda r: F.struct(r["rule"].alias("rule"), (-r["k"]).alias("errors"))).alias("error_distribution"),
        F.transform("fields", lambda r: F.struct(r["field"].alias("field"), r["n"].alias("errors"))).alias("errors_by_field"),
    )


def flagged_details(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Id, line, errors and canonical data of the flagged rows."""
    return df.where(is_status("flagged")).select(
        "row_id", "line_number", F.col(ERRORS).alias("errors"), _canonical(df, names)
    )


def _canonical(df: DataFrame, names: list[str] | None) -> Column:
    if "canonical" in df.columns:
        return F.col("canonical").alias("canonical_data")
    return canonical_map(df, names).alias("canonical_data")


#: One row of so many, by the hash of its place, tells how far the first flagged rows can reach.
SPREAD = 256


def _up_to(place: list[str], last: list) -> Column:
    """Rows not after a place, in ascending order with nulls first."""
    name, value = F.col(place[0]), last[0]
    if value is None:
        here, before = name.isNull(), F.lit(False)
    else:
        here, before = name == F.lit(value), name.isNull() | (name < F.lit(value))
    return before | (here & _up_to(place[1:], last[1:])) if len(place) > 1 else before | here


def _not_after_first(df: DataFrame, n: int, spread: int) -> DataFrame:
    """Rows among which the first ``n`` flagged ones are, mostly far fewer than all.

    The n-th flagged row of any part of the rows is not before the n-th of all, so those of
    one part, told by data columns alone, bound where to look. The bound is a filter on data
    columns too: both pass through ``validate`` to the scan, and few rows are validated for
    it. Where the part has fewer than ``n``, all rows are kept.
    """
    order = ["file_id", "line_number"]
    part = df.where(F.pmod(F.xxhash64(*order), F.lit(spread)) == 0).where(is_status("flagged"))
    firsts = part.select(*order).orderBy(*order).limit(n).collect()  # n places
    return df if n < 1 or len(firsts) < n else df.where(_up_to(order, list(firsts[-1])))


def flagged_sample(df: DataFrame, n: int = 10, names: list[str] | None = None, spread: int = SPREAD) -> DataFrame:
    """The first flagged rows by file and line, with shortened ids.

    A part of the rows is looked at before, so that not all are validated: see ``_not_after_first``.
    What is shown passes through a generator of one row: so projections above it are not moved
    between the sort and its limit, and every task keeps ``n`` rows instead of sorting all.
    """
    near = _not_after_first(df, n, spread)
    first = near.where(is_status("flagged")).orderBy("file_id", "line_number", "row_id").limit(n)
    shown = F.struct(
        F.left("row_id", F.lit(8)).alias("row_id"),
        F.col("line_number"),
        F.col(ERRORS).alias("errors"),
        _canonical(df, names),
    )
    return first.select(F.explode(F.array(shown)).alias("row")).select("row.*")


def error_rows(df: DataFrame, with_canonical: bool = False, names: list[str] | None = None) -> DataFrame:
    """One row per error: id, line, field, rule, message."""
    extra = [F.to_json(_canonical(df, names), {"ignoreNullFields": "false"}).alias("canonical_data")]
    # the text is made below the generator, once a row and not once an error
    made = df.where(is_status("flagged")).select("row_id", "line_number", ERRORS, *(extra if with_canonical else []))
    slim = made.withColumn("error", F.explode(ERRORS))
    return slim.select(
        "row_id",
        "line_number",
        F.coalesce("error.field", F.lit("")).alias("field"),
        F.col("error.rule").alias("rule"),
        F.col("error.message").alias("message"),
        *(["canonical_data"] if with_canonical else []),
    )


def error_string() -> Column:
    """Errors as ``field:rule`` joined by a bar; an error over several fields has field None."""
    return F.array_join(
        F.transform(ERRORS, lambda e: F.concat_ws(":", F.coalesce(e["field"], F.lit("None")), e["rule"])),
        "|",
    )


_PAGE_ORDER = ["file_id", "line_number", "row_id"]


def _page_columns() -> list[Column]:
    first = F.transform(F.slice(ERRORS, 1, 2), lambda e: F.coalesce(e["field"], F.lit("?")))
    return [F.array_join(first, ", ").alias("errors"), F.size(ERRORS).cast("bigint").alias("error_count"), F.col("status")]


def _shown(page: DataFrame) -> DataFrame:
    return page.select(F.left("row_id", F.lit(8)).alias("row_id"), "line_number", "errors", "error_count", "status")


def flagged_page(df: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of the flagged listing in file and line order, near its start: every task
    keeps ``offset + limit`` rows. For deep pages, or many, see ``flagged_pages``."""
    flagged = df.where(is_status("flagged")).select(*_PAGE_ORDER, *_page_columns())
    return _shown(flagged.orderBy(*_PAGE_ORDER).offset(offset).limit(limit))


def flagged_pages(df: DataFrame, ranges: int | None = None) -> Pages:
    """The flagged listing stored in ranges of its order, for pages of any depth by ``shown_page``."""
    return Pages(df.where(is_status("flagged")).select(*_PAGE_ORDER, *_page_columns()), _PAGE_ORDER, ranges)


def shown_page(pages: Pages, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of the stored flagged listing, as ``flagged_page`` gives it."""
    return _shown(pages.page(limit, offset))


def batch_summary(df: DataFrame) -> DataFrame:
    """Totals per file and for the whole (file_id null), percentages rounded down."""
    counted = df.rollup("file_id").agg(*_counts())
    least = F.greatest(F.lit(1), F.col("total_rows"))

    def percent(part: str) -> Column:
        return F.floor(F.lit(100) * F.col(part) / least).cast("bigint")

    return counted.withColumns(
        {"valid_percent": percent("valid_rows"), "flagged_percent": percent("flagged_rows")}
    )


def flat_rows(df: DataFrame, names: list[str]) -> DataFrame:
    """Data fields followed by the four metadata columns."""
    return df.select(
        *[F.col(f"`{n}`") for n in names],
        F.col("row_id").alias("_row_id"),
        F.col("file_id").alias("_file_id"),
        F.col("line_number").alias("_line_number"),
        F.col("status").alias("_status"),
    )


def field_names(df: DataFrame, map_column: str | None = None) -> list[str] | DataFrame:
    """Sorted union of field names: from the schema, or of all keys of a ragged column."""
    if map_column is None:
        from rowmill.records import Fields

        return sorted(Fields.flat(df).types)
    return df.select(F.explode(F.map_keys(map_column)).alias("field")).distinct().orderBy("field")


def rows_by_status(df: DataFrame, status: str, limit: int | None = None) -> DataFrame:
    """Rows of a status, newest first."""
    ordered = df.where(is_status(status)).orderBy(F.desc("created_at"), "row_id")
    return ordered if limit is None else ordered.limit(limit)
