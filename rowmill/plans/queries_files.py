"""Queries that write whole tables as files and read them back through scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.operators.ledger import Ledger
from rowmill.operators.mapping import MappingRule
from rowmill.plans import sql as S
from rowmill.plans.batch import refine_stored, run_batch
from rowmill.plans.catalog import query
from rowmill.plans.feed import table, validated_feed
from rowmill.schema import CanonicalSchema, normalise_by_schema
from rowmill.session import cut_lineage, scratch_path
from rowmill.sinks import review, writers
from rowmill.sources import scan
from rowmill.sources.intake import read_rows
from rowmill.sources.listing import list_files

ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
ORDER_SQL = "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ORDER) + " FROM orders"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*[F.col(c).cast("string").alias(c) for c in ORDER])


def _fields(rows, names, source="raw"):
    return rows.select(*[F.try_element_at(source, F.lit(n)).alias(n) for n in names])


@query("scan_csv", ORDER_SQL)
def _scan_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    _orders(spark, sf_dir).write.option("header", True).csv(path)
    return _fields(scan.scan_delimited(spark, [path], ",".join(ORDER)), ORDER)


@query("scan_tsv", ORDER_SQL)
def _scan_tsv(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    _orders(spark, sf_dir).write.option("header", True).option("sep", "\t").csv(path)
    return _fields(scan.scan_delimited(spark, [path], "\t".join(ORDER), "\t"), ORDER)


@query(
    "scan_csv_multi_line",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM documents",
)
def _scan_csv_multi_line(spark, sf_dir):
    """Documents with line breaks inside quoted cells, each file in ranges of a megabyte."""
    path = scratch_path(spark, "csv")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    docs.write.option("header", True).option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    rows = _fields(read_rows(spark, list_files(spark, path, range_bytes=1 << 20)), ["doc_id", "text"])
    return rows.withColumn("text", F.regexp_replace("text", "\r\n?", "\n"))


@query("scan_jsonl", ORDER_SQL)
def _scan_jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    _orders(spark, sf_dir).write.json(path)
    return _fields(scan.scan_json_lines(spark, [path]), ORDER)


@query("scan_json_array", ORDER_SQL)
def _scan_json_array(spark, sf_dir):
    path = scratch_path(spark, "array")
    writers.write_json_array(_orders(spark, sf_dir), path)
    return _fields(read_rows(spark, list_files(spark, path, format="json", range_bytes=1 << 20)), ORDER)


@query("scan_xml", ORDER_SQL)
def _scan_xml(spark, sf_dir):
    path = scratch_path(spark, "xml")
    writers.write_xml(_orders(spark, sf_dir), path)
    return _fields(read_rows(spark, list_files(spark, path, range_bytes=1 << 20)), ORDER)


@query(
    "row_identity",
    """SELECT count(*) AS n_rows, count(*) AS distinct_ids, count(*) AS line_sum_matches FROM orders""",
)
def _row_identity(spark, sf_dir):
    """Row ids are unique and lines dense from 1 within each of several files."""
    path = scratch_path(spark, "files")
    orders = _orders(spark, sf_dir).repartition(4, "o_orderstatus")
    orders.write.option("header", True).partitionBy("o_orderstatus").csv(path)
    rows = read_rows(spark, list_files(spark, path))
    per_file = rows.groupBy("file_id").agg(
        F.count("*").alias("n"),
        F.count_distinct("row_id").alias("ids"),
        F.min("line_number").alias("low"),
        F.max("line_number").alias("high"),
    )
    dense = F.when((F.col("low") == 1) & (F.col("high") == F.col("n")), F.col("n")).otherwise(0)
    return per_file.agg(
        F.sum("n").alias("n_rows"), F.sum("ids").alias("distinct_ids"), F.sum(dense).alias("line_sum_matches")
    )


@query(
    "list_files",
    """SELECT format, encoding, json_lines, ways * count(DISTINCT o_orderstatus) AS files
       FROM orders, (VALUES ('csv', 'UTF-8', NULL, 1), ('csv', 'ISO-8859-1', NULL, 1), ('json', 'UTF-8', true, 2),
         ('tsv', 'UTF-8', NULL, 1), ('xml', 'UTF-8', NULL, 1)) v(format, encoding, json_lines, ways)
       GROUP BY format, encoding, json_lines, ways""",
)
def _list_files(spark, sf_dir):
    """One file for each order status in each of six ways; three have a suffix that says
    nothing, so their first bytes do."""
    path = scratch_path(spark, "files")
    one_each = _orders(spark, sf_dir).repartition("o_orderstatus")
    accented = one_each.withColumn("o_orderpriority", F.concat("o_orderpriority", F.lit(" \u00e9")))
    plain = {"sep": "\u0001", "quote": "\u0000", "escape": "\u0000", "extension": "dat"}
    text = F.to_json(F.struct(*ORDER)).alias("text")
    one_each.write.option("header", True).partitionBy("o_orderstatus").csv(f"{path}/a")
    accented.write.option("header", True).option("encoding", "ISO-8859-1").partitionBy("o_orderstatus").csv(f"{path}/b")
    one_each.write.partitionBy("o_orderstatus").json(f"{path}/c")
    one_each.select(text, "o_orderstatus").write.options(**plain).partitionBy("o_orderstatus").csv(f"{path}/d")
    one_each.write.options(**(plain | {"sep": "\t"})).partitionBy("o_orderstatus").csv(f"{path}/e")
    tagged = one_each.select(F.concat(F.lit("<?xml version='1.0'?><o>"), "o_orderkey", F.lit("</o>")).alias("text"), "o_orderstatus")
    tagged.write.options(**plain).partitionBy("o_orderstatus").csv(f"{path}/f")
    return list_files(spark, path).groupBy("format", "encoding", "json_lines").agg(F.count("*").alias("files"))


@query("scan_csv_latin1", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority || ' \u00e9\u00fc' AS o_orderpriority FROM orders")
def _scan_csv_latin1(spark, sf_dir):
    """Files that are no UTF-8, found so in every range, read as Latin-1."""
    path = scratch_path(spark, "latin")
    rows = _orders(spark, sf_dir).select("o_orderkey", F.concat("o_orderpriority", F.lit(" \u00e9\u00fc")).alias("o_orderpriority"))
    rows.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return _fields(read_rows(spark, list_files(spark, path, range_bytes=1 << 20)), ["o_orderkey", "o_orderpriority"])


@query(
    "json_dialects",
    "SELECT o_orderstatus <> 'F' AS json_lines, CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders",
)
def _json_dialects(spark, sf_dir):
    """JSON lines and whole-file arrays in one folder, told apart by their first lines."""
    path = scratch_path(spark, "dialects")
    orders = _orders(spark, sf_dir)
    orders.where("o_orderstatus <> 'F'").write.json(f"{path}/lines")
    writers.write_json_array(orders.where("o_orderstatus = 'F'"), f"{path}/arrays")
    files = cut_lineage(list_files(spark, path, format="json"))
    rows = read_rows(spark, files).join(files.select("file_id", "json_lines").distinct(), "file_id")
    return rows.select("json_lines", F.try_element_at("raw", F.lit("o_orderkey")).alias("o_orderkey"))


@query(
    "xml_row_elements",
    "SELECT 'status_' || lower(o_orderstatus) AS row_tag, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1",
)
def _xml_row_elements(spark, sf_dir):
    """Documents of three row elements, each found by its own most frequent child."""
    path = scratch_path(spark, "tags")
    for status in "FOP":
        writers.write_xml(_orders(spark, sf_dir).where(F.col("o_orderstatus") == status), f"{path}/{status}", row_element=f"status_{status.lower()}")
    files = cut_lineage(list_files(spark, path, range_bytes=1 << 20))
    rows = read_rows(spark, files).join(files.select("file_id", "row_tag").distinct(), "file_id")
    key = F.try_element_at("raw", F.lit("o_orderkey")).cast("bigint")
    return rows.groupBy("row_tag").agg(F.count("*").alias("n_rows"), F.sum(key).alias("key_sum"))


@query(
    "scan_xml_nested",
    """SELECT l_orderkey::VARCHAR AS id, CASE WHEN count(*) = 1 THEN min(l_linenumber)::VARCHAR
         ELSE '["' || string_agg(l_linenumber::VARCHAR, '","' ORDER BY l_linenumber) || '"]' END AS line,
         '{"key":"' || l_orderkey || '","lines":"' || count(*) || '"}' AS order_info
       FROM lineitem GROUP BY l_orderkey""",
)
def _scan_xml_nested(spark, sf_dir):
    """Orders as elements with an attribute, a child for each line and a nested child."""
    path = scratch_path(spark, "nested")
    key = F.col("l_orderkey").cast("string")
    orders = table(spark, sf_dir, "lineitem").groupBy(key.alias("_id")).agg(
        F.transform(F.array_sort(F.collect_list("l_linenumber")), lambda n: n.cast("string")).alias("line"),
        F.struct(F.first(key).alias("key"), F.count("*").cast("string").alias("lines")).alias("order_info"),
    )
    orders.write.option("rootTag", "orders").option("rowTag", "order").xml(path)
    return _fields(read_rows(spark, list_files(spark, path, range_bytes=1 << 20)), ["id", "line", "order_info"])


@query("sink_csv_roundtrip", ORDER_SQL)
def _sink_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    writers.export_rows(_orders(spark, sf_dir), "csv", path)
    return _fields(scan.scan_delimited(spark, [path], ",".join(sorted(ORDER))), ORDER)


@query("sink_jsonl_roundtrip", ORDER_SQL)
def _sink_jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    writers.export_rows(_orders(spark, sf_dir), "jsonl", path)
    return _fields(scan.scan_json_lines(spark, [path]), ORDER)


@query(
    "status_split",
    "SELECT CASE o_orderstatus WHEN 'F' THEN 'valid' ELSE 'flagged' END AS status, count(*) AS n, "
    "CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1",
)
def _status_split(spark, sf_dir):
    base = scratch_path(spark, "split")
    rows = _orders(spark, sf_dir).withColumn(
        "status", F.when(F.col("o_orderstatus") == "F", "valid").otherwise("flagged")
    )
    result = writers.export_split(rows, "jsonl", base)
    parts = [
        scan.scan_json_lines(spark, [result[f"{s}_export"]]).select(
            F.lit(s).alias("status"), F.try_element_at("raw", F.lit("o_orderkey")).cast("bigint").alias("k")
        )
        for s in ("valid", "flagged")
    ]
    both = parts[0].union(parts[1])
    return both.groupBy("status").agg(F.count("*").alias("n"), F.sum("k").alias("key_sum"))


@query(
    "export_by_source",
    "SELECT o_orderpriority AS source_name, count(*) AS total_rows, count(*) FILTER (o_orderstatus = 'F') AS valid_rows FROM orders GROUP BY 1",
)
def _export_by_source(spark, sf_dir):
    path = scratch_path(spark, "export")
    rows = _orders(spark, sf_dir).select(
        "o_orderkey",
        F.col("o_orderpriority").alias("source_name"),
        F.when(F.col("o_orderstatus") == "F", "valid").otherwise("flagged").alias("status"),
    )
    writers.export_all(rows, path, "csv")
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("source_name").agg(
        F.count("*").alias("total_rows"), F.count_if(F.col("status") == "valid").alias("valid_rows")
    )


@query(
    "whole_batch_run",
    """SELECT 'first' AS run, count(*) AS total_rows, count(*) FILTER (o_orderstatus = 'F') AS valid_rows FROM orders
       UNION ALL SELECT 'second', 0, 0""",
)
def _whole_batch_run(spark, sf_dir):
    """Files of orders through the whole job, twice: the second run finds nothing new."""
    path = scratch_path(spark, "batch")
    _orders(spark, sf_dir).repartition(4).write.json(f"{path}/in")
    state = Ledger(spark, f"{path}/ledger")
    mapping = [MappingRule("o_orderkey", "order_id"), MappingRule("o_orderstatus", "code")]
    rules = {
        "field_validation_rules": [
            {"field": "order_id", "rule_type": "required"},
            {"field": "code", "rule_type": "enum", "values": ["f"]},
        ]
    }
    run_batch(spark, f"{path}/in", state, f"{path}/out", mapping, rules)
    first = state.rows().agg(
        F.lit("first").alias("run"),
        F.count("*").alias("total_rows"),
        F.count_if(F.col("status") == "valid").alias("valid_rows"),
    )
    again = run_batch(spark, f"{path}/in", state, f"{path}/out", mapping, rules)
    second = state.read("batches").where(F.col("batch_id") == again["batch_id"]).agg(
        F.lit("second").alias("run"),
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("valid_rows"), F.lit(0)).alias("valid_rows"),
    )
    return first.union(second)


@query(
    "error_list_file",
    f"WITH {S.CHECKED_SQL} SELECT row_id, line_number, coalesce(field, '') AS field, rule, message FROM exploded",
)
def _error_list_file(spark, sf_dir):
    path = scratch_path(spark, "errors")
    review.write_error_list(validated_feed(spark, sf_dir), path)
    names = "row_id string, line_number bigint, field string, rule string, message string"
    return spark.read.option("header", True).schema(names).csv(path).fillna("", ["field"])


@query(
    "review_file",
    f"""WITH {S.CHECKED_SQL} SELECT row_id, line_number, rule AS error_rule, order_id
        FROM (SELECT row_id, line_number, order_id, unnest(errors, recursive := true) FROM validated WHERE status = 'flagged')""",
)
def _review_file(spark, sf_dir):
    path = scratch_path(spark, "review")
    review.write_review_csv(validated_feed(spark, sf_dir), path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return back.select(
        "row_id",
        F.col("line_number").cast("bigint").alias("line_number"),
        "error_rule",
        F.get_json_object("canonical_data", "$.order_id").alias("order_id"),
    )


_TOTALS_SQL = f"""WITH {S.CHECKED_SQL} SELECT count(*) AS total_rows, count(*) FILTER (status = 'valid') AS valid_rows,
    count(*) FILTER (status = 'flagged') AS flagged_rows FROM validated"""
_TOTALS = "struct<total_rows: bigint, valid_rows: bigint, flagged_rows: bigint>"


@query("validation_json_file", _TOTALS_SQL)
def _validation_json_file(spark, sf_dir):
    """Totals as the summary file has them, flagged rows as the details file has them."""
    path = scratch_path(spark, "validation")
    review.write_validation_json(validated_feed(spark, sf_dir), path, "batch")
    summary = spark.read.schema(f"summary {_TOTALS}").json(f"{path}/summary").select("summary.total_rows", "summary.valid_rows")
    details = spark.read.schema("row_id string").json(f"{path}/flagged_details").agg(F.count("row_id").alias("flagged_rows"))
    return summary.join(details)


@query("batch_report_files", _TOTALS_SQL)
def _batch_report_files(spark, sf_dir):
    """Totals as the manifest of a batch report has them."""
    paths = review.write_batch_report(validated_feed(spark, sf_dir), scratch_path(spark, "report"), "batch")
    return spark.read.schema(f"statistics {_TOTALS}").json(paths["manifest"]).select("statistics.*")


@query(
    "typed_batch",
    "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders",
)
def _typed_batch(spark, sf_dir):
    """Rows of a batch whose canonical values are brought to the form of their declared types."""
    path = scratch_path(spark, "typed")
    table(spark, sf_dir, "orders").select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("nr"), F.date_format("o_orderdate", "dd.MM.yyyy").alias("day")
    ).write.json(f"{path}/in")
    state = Ledger(spark, f"{path}/ledger")
    mapping = [MappingRule("nr", "order_id"), MappingRule("day", "order_date")]
    schema = CanonicalSchema({"order_id": {"type": "string"}, "order_date": {"type": "date"}})
    run_batch(spark, f"{path}/in", state, f"{path}/out", mapping, {}, typing=lambda df: normalise_by_schema(df, schema))
    return _fields(state.rows(), ["order_id", "order_date"], "canonical")


@query(
    "remap_stored_file",
    "SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS priority, CASE WHEN o_orderstatus = 'F' THEN 'valid' ELSE 'flagged' END AS status FROM orders",
)
def _remap_stored_file(spark, sf_dir):
    """All stored files of a batch under another mapping and other rules than they came in with."""
    path = scratch_path(spark, "remap")
    _orders(spark, sf_dir).write.json(f"{path}/in")
    state = Ledger(spark, f"{path}/ledger")
    run_batch(spark, f"{path}/in", state, f"{path}/out", [MappingRule("o_orderkey", "order_id")], {})
    mapping = [MappingRule("o_orderkey", "key"), MappingRule("o_orderpriority", "priority"), MappingRule("o_orderstatus", "code")]
    rules = {"field_validation_rules": [{"field": "code", "rule_type": "enum", "values": ["F"]}]}
    return refine_stored(state, state.files(), mapping, rules).select("key", "priority", "status")
