"""Queries over reports and listings of validated rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.operators import report
from rowmill.operators.mapping import canonical_map
from rowmill.plans import sql as S
from rowmill.plans.catalog import query
from rowmill.operators.validate import SAMPLE_RULES, error_counts
from rowmill.plans.feed import mapped_feed, table, validated_feed
from rowmill.records import Fields
from rowmill.sinks.frames import csv_frame

FIELD = "coalesce(e.field, 'None') || ':' || e.rule"
PERCENT = "round(100.0 * count(*) FILTER (status = 'valid') / count(*), 2)::DOUBLE"
COUNTS = (
    "count(*) AS total_rows, count(*) FILTER (status = 'valid') AS valid_rows, "
    "count(*) FILTER (status = 'flagged') AS flagged_rows"
)


@query("report_totals", f"WITH {S.CHECKED_SQL} SELECT {COUNTS}, {PERCENT} AS valid_percentage FROM validated")
def _report_totals(spark, sf_dir):
    return report.totals(validated_feed(spark, sf_dir))


@query(
    "errors_by_rule_top5",
    f"WITH {S.CHECKED_SQL} SELECT rule, count(*) AS errors FROM exploded GROUP BY rule ORDER BY errors DESC, rule LIMIT 5",
)
def _errors_by_rule(spark, sf_dir):
    return report.top_rules(error_counts(mapped_feed(spark, sf_dir), SAMPLE_RULES))


@query(
    "errors_by_field",
    f"WITH {S.CHECKED_SQL} SELECT coalesce(field, 'unknown') AS field, count(*) AS errors FROM exploded GROUP BY 1",
)
def _errors_by_field(spark, sf_dir):
    return report.per_field(error_counts(mapped_feed(spark, sf_dir), SAMPLE_RULES))


@query(
    "batch_summary",
    f"""WITH {S.CHECKED_SQL} SELECT coalesce(file_id, 'all files') AS file_id, {COUNTS},
          CAST(floor(100 * count(*) FILTER (status = 'valid') // greatest(1, count(*))) AS BIGINT) AS valid_percent,
          CAST(floor(100 * count(*) FILTER (status = 'flagged') // greatest(1, count(*))) AS BIGINT) AS flagged_percent
        FROM validated GROUP BY ROLLUP (file_id)""",
)
def _batch_summary(spark, sf_dir):
    whole = F.coalesce("file_id", F.lit("all files"))
    return report.batch_summary(validated_feed(spark, sf_dir)).withColumn("file_id", whole)


@query(
    "batch_totals",
    f"""WITH {S.CHECKED_SQL} SELECT 'batch-' || (line_number % 7) AS batch_id, count(DISTINCT file_id) AS files, {COUNTS}
        FROM validated GROUP BY 1""",
)
def _batch_totals(spark, sf_dir):
    rows = validated_feed(spark, sf_dir).withColumn(
        "batch_id", F.concat(F.lit("batch-"), (F.col("line_number") % 7).cast("string"))
    )
    per_file = report.totals(rows, ["batch_id", "file_id"])
    return per_file.groupBy("batch_id").agg(
        F.count("*").alias("files"),
        *[F.sum(c).alias(c) for c in ("total_rows", "valid_rows", "flagged_rows")],
    )


@query(
    "flagged_page",
    f"""WITH {S.CHECKED_SQL} SELECT left(row_id, 8) AS row_id, line_number, status, len(errors) AS error_count,
          array_to_string(list_transform(errors[1:2], lambda e: coalesce(e.field, '?')), ', ') AS errors
        FROM validated WHERE status = 'flagged'
        ORDER BY file_id, line_number, validated.row_id LIMIT 100 OFFSET 50""",
)
def _flagged_page(spark, sf_dir):
    return report.flagged_page(validated_feed(spark, sf_dir), limit=100, offset=50)


@query(
    "flagged_page_middle",
    f"""WITH {S.CHECKED_SQL}, placed AS (
          SELECT *, row_number() OVER (ORDER BY file_id, line_number, validated.row_id) - 1 AS place, count(*) OVER () AS n
          FROM validated WHERE status = 'flagged')
        SELECT left(row_id, 8) AS row_id, line_number, status, len(errors) AS error_count,
          array_to_string(list_transform(errors[1:2], lambda e: coalesce(e.field, '?')), ', ') AS errors
        FROM placed WHERE place >= n // 2 AND place < n // 2 + 1000""",
)
def _flagged_page_middle(spark, sf_dir):
    """A thousand rows from the middle of the listing: only the ranges they lie in are sorted."""
    pages = report.flagged_pages(validated_feed(spark, sf_dir))
    return report.shown_page(pages, limit=1000, offset=pages.total // 2)


@query(
    "flagged_sample",
    f"""WITH {S.CHECKED_SQL} SELECT left(row_id, 8) AS row_id, line_number, order_id, quantity, len(errors) AS n_errors
        FROM validated WHERE status = 'flagged' ORDER BY file_id, line_number, validated.row_id LIMIT 10""",
)
def _flagged_sample(spark, sf_dir):
    data = F.col("canonical_data")
    return report.flagged_sample(validated_feed(spark, sf_dir)).select(
        "row_id",
        "line_number",
        F.try_element_at(data, F.lit("order_id")).alias("order_id"),
        F.try_element_at(data, F.lit("quantity")).alias("quantity"),
        F.size("errors").cast("bigint").alias("n_errors"),
    )


@query(
    "error_rows",
    f"""WITH {S.CHECKED_SQL} SELECT row_id, line_number, coalesce(field, '') AS field, rule, message FROM exploded""",
)
def _error_rows(spark, sf_dir):
    return report.error_rows(validated_feed(spark, sf_dir))


@query(
    "flagged_details",
    f"""WITH {S.CHECKED_SQL} SELECT row_id, line_number, len(errors) AS n_errors, order_id, order_date, total_amount
        FROM validated WHERE status = 'flagged'""",
)
def _flagged_details(spark, sf_dir):
    data = F.col("canonical_data")
    return report.flagged_details(validated_feed(spark, sf_dir)).select(
        "row_id",
        "line_number",
        F.size("errors").cast("bigint").alias("n_errors"),
        *[F.try_element_at(data, F.lit(n)).alias(n) for n in ("order_id", "order_date", "total_amount")],
    )


@query(
    "review_rows",
    f"""WITH {S.CHECKED_SQL}, page AS (SELECT * FROM validated WHERE status = 'flagged'),
        e AS (SELECT row_id, line_number, order_id, unnest(errors, recursive := true) FROM page)
        SELECT row_id, line_number, coalesce(field, '') AS field, rule, message, order_id FROM e""",
)
def _review_rows(spark, sf_dir):
    from rowmill.sinks.review import review_frame

    frame = review_frame(validated_feed(spark, sf_dir))
    return frame.select(
        "row_id",
        "line_number",
        F.col("error_field").alias("field"),
        F.col("error_rule").alias("rule"),
        F.col("error_message").alias("message"),
        F.get_json_object("canonical_data", "$.order_id").alias("order_id"),
    )


@query(
    "summary_record",
    f"""WITH {S.CHECKED_SQL},
        r AS (SELECT rule, count(*) AS n FROM exploded GROUP BY rule ORDER BY n DESC, rule LIMIT 5),
        f AS (SELECT coalesce(field, 'unknown') AS field, count(*) AS n FROM exploded GROUP BY 1),
        t AS (SELECT {COUNTS}, {PERCENT} AS valid_percentage FROM validated)
        SELECT t.*, (SELECT string_agg(rule || '=' || n, ';' ORDER BY n DESC, rule) FROM r) AS rules,
          (SELECT string_agg(field || '=' || n, ';' ORDER BY field) FROM f) AS fields FROM t""",
)
def _summary_record(spark, sf_dir):
    def joined(column, name):
        return F.array_join(
            F.transform(column, lambda r: F.concat_ws("=", r[name], r["errors"].cast("string"))), ";"
        )

    return report.summary_record(validated_feed(spark, sf_dir), "batch").select(
        "summary.*",
        joined("error_distribution", "rule").alias("rules"),
        joined("errors_by_field", "field").alias("fields"),
    )


@query(
    "export_stats",
    f"""WITH {S.CHECKED_SQL} SELECT 'export-' || (line_number % 5) AS export_id, {COUNTS},
          count(DISTINCT file_id) AS export_count,
          (max(line_number) - min(line_number))::DOUBLE AS duration_seconds
        FROM validated GROUP BY 1""",
)
def _export_stats(spark, sf_dir):
    line = F.col("line_number")
    rows = validated_feed(spark, sf_dir).select(
        "status",
        F.col("file_id").alias("source_name"),
        F.concat(F.lit("export-"), (line % 5).cast("string")).alias("export_id"),
        F.timestamp_seconds(line).alias("at"),
    )
    return report.export_stats(rows, started="at", finished="at")


@query(
    "field_names",
    """SELECT DISTINCT field FROM (SELECT unnest(json_keys(props)) AS field FROM events
         UNION ALL SELECT event_type FROM events)""",
)
def _field_names(spark, sf_dir):
    props = F.from_json("props", "map<string,string>")
    typed = F.create_map(F.col("event_type"), F.lit(""))
    rows = table(spark, sf_dir, "events").select(F.map_concat(props, typed).alias("raw"))
    return report.field_names(rows, "raw")


@query(
    "rows_by_status",
    """SELECT event_id, user_id FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id LIMIT 500""",
)
def _rows_by_status(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        "user_id",
        F.col("event_type").alias("status"),
        F.col("ts").alias("created_at"),
    )
    return report.rows_by_status(rows, "error", 500).select(F.col("row_id").alias("event_id"), "user_id")


@query(
    "rows_valid_only",
    f"WITH {S.CHECKED_SQL} SELECT row_id, order_id FROM validated WHERE status = 'valid'",
)
def _rows_valid_only(spark, sf_dir):
    return report.with_status(validated_feed(spark, sf_dir), "valid").select("row_id", "order_id")


@query(
    "flat_rows",
    f"""WITH {S.CHECKED_SQL} SELECT order_id, total_amount, row_id AS _row_id, file_id AS _file_id,
          line_number AS _line_number, status AS _status FROM validated""",
)
def _flat_rows(spark, sf_dir):
    return report.flat_rows(validated_feed(spark, sf_dir), ["order_id", "total_amount"])


@query(
    "export_rows_with_errors",
    f"""WITH {S.CHECKED_SQL} SELECT currency, order_id, row_id AS _row_id, line_number AS _line_number, status AS _status,
          array_to_string(list_transform(errors, lambda e: {FIELD}), '|') AS _errors
        FROM validated WHERE status = 'flagged'""",
)
def _export_rows_with_errors(spark, sf_dir):
    return csv_frame(
        validated_feed(spark, sf_dir),
        status="flagged",
        fields=["currency", "order_id"],
        include_metadata=True,
        include_errors=True,
    )


@query(
    "row_lookup",
    "SELECT doc_id, lang, source, length(text) AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def _row_lookup(spark, sf_dir):
    """Point lookups for a whole list of ids."""
    wanted = table(spark, sf_dir, "labels").select("doc_id")
    found = table(spark, sf_dir, "documents").join(wanted, "doc_id", "left_semi")
    return found.select("doc_id", "lang", "source", F.length("text").cast("bigint").alias("n"))


@query(
    "canonical_json",
    "SELECT p_partkey, p_name AS name, CAST(p_size AS VARCHAR) AS size FROM part",
)
def _canonical_json(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    data = canonical_map(parts, list(Fields.flat(parts).types))
    text = F.to_json(data, {"ignoreNullFields": "false"})
    return parts.select(
        "p_partkey",
        F.get_json_object(text, "$.p_name").alias("name"),
        F.get_json_object(text, "$.p_size").alias("size"),
    )
