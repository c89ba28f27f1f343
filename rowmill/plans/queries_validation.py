"""Queries over the validation rules, one per rule type and whole rule sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.operators.mapping import MappingRule, map_fields
from rowmill.operators.report import error_string, totals
from rowmill.operators.validate import SAMPLE_RULES, register_check, validate, with_stock
from rowmill.plans import sql as S
from rowmill.plans.catalog import query
from rowmill.plans.feed import mapped_feed, table, validated_feed, vendor_feed
from rowmill.plans.queries_functions import (
    AMOUNT_SQL,
    DATE_TEXT_SQL,
    LINE_KEY,
    LINE_KEY_SQL,
    amount_texts,
    date_texts,
)
from rowmill.operators.normalize import normalise_map, normalise_rows
from rowmill.records import Fields
from rowmill.schema import CanonicalSchema
from rowmill.session import scratch_path
from rowmill.sources.intake import read_rows
from rowmill.sources.listing import list_files


def field_rules(*rules):
    return {"field_validation_rules": list(rules)}


def cross_rules(*rules):
    return {"cross_field_rules": list(rules)}


def semantic_rules(*rules):
    return {"semantic_rules": list(rules)}


def _status(df, rules, *keep, fields=None):
    return validate(df, rules, fields).select(*keep, "status")


def _flag(condition):
    return f"CASE WHEN {condition} THEN 'flagged' ELSE 'valid' END AS status"


@query(
    "validate_orders_summary",
    f"""WITH base AS (
          SELECT {S.strip_or_null("CASE WHEN l_orderkey % 97 = 0 THEN '  ' ELSE CAST(l_orderkey AS VARCHAR) END")} AS order_id,
                 CAST(l_quantity AS BIGINT) - CASE WHEN l_orderkey % 53 = 0 THEN 100 ELSE 0 END AS quantity,
                 l_extendedprice AS total_amount, o_orderdate
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        v AS (SELECT order_id IS NOT NULL AND quantity >= 1 AND total_amount <= 90000 AS ok FROM base)
        SELECT count(*) AS total_rows, count(*) FILTER (ok) AS valid_rows, count(*) FILTER (NOT ok) AS flagged_rows,
          round(100.0 * count(*) FILTER (ok) / count(*), 2)::DOUBLE AS valid_percentage FROM v""",
)
def validate_orders_summary(spark, sf_dir):
    """Trim, map, required and range rules, status, totals: the smallest whole run."""
    k = F.col("l_orderkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    feed = lines.join(orders, k == F.col("o_orderkey")).select(
        F.when(k % 97 == 0, "  ").otherwise(k.cast("string")).alias("Order_ID"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order_Date"),
        (F.col("l_quantity").cast("bigint") - F.when(k % 53 == 0, 100).otherwise(0))
        .cast("string")
        .alias("Qty"),
        F.col("l_extendedprice").cast("string").alias("Total"),
    )
    rules = [
        MappingRule("Order_ID", "order_id"),
        MappingRule("Order_Date", "order_date"),
        MappingRule("Qty", "quantity"),
        MappingRule("Total", "total_amount"),
    ]
    checks = field_rules(
        {"field": "order_id", "rule_type": "required"},
        {"field": "order_date", "rule_type": "required"},
        {"field": "quantity", "rule_type": "range", "min_value": 1},
        {"field": "total_amount", "rule_type": "range", "min_value": 0, "max_value": 90000},
    )
    return totals(validate(map_fields(normalise_rows(feed), rules), checks))


@query(
    "rule_required",
    f"SELECT doc_id, {_flag(f'text IS NULL OR {S.strip(chr(116) + chr(101) + chr(120) + chr(116))} = {chr(39) * 2} OR source IS NULL')} FROM documents",
)
def _rule_required(spark, sf_dir):
    rules = field_rules(
        {"field": "text", "rule_type": "required"},
        {"field": "source", "rule_type": "required"},
        {"field": "not_there", "rule_type": "required"},
    )
    return _status(table(spark, sf_dir, "documents"), rules, "doc_id")


TYPED_TEXT_SQL = """
typed AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN event_id || '.0'
    WHEN 2 THEN ' ' || event_id || ' ' WHEN 3 THEN '1_' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0')
    WHEN 4 THEN '_' || event_id WHEN 5 THEN '+' || event_id WHEN 6 THEN event_id || 'd'
    WHEN 7 THEN NULL ELSE event_type END AS text FROM events)"""


def _typed_texts(spark, sf_dir):
    k = F.col("event_id").cast("string")
    form = F.col("event_id") % 9
    text = (
        F.when(form == 0, k)
        .when(form == 1, F.concat(k, F.lit(".0")))
        .when(form == 2, F.concat(F.lit(" "), k, F.lit(" ")))
        .when(form == 3, F.concat(F.lit("1_"), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0")))
        .when(form == 4, F.concat(F.lit("_"), k))
        .when(form == 5, F.concat(F.lit("+"), k))
        .when(form == 6, F.concat(k, F.lit("d")))
        .when(form == 8, F.col("event_type"))
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("text"))


@query(
    "rule_type_integer",
    f"WITH {TYPED_TEXT_SQL} SELECT event_id, "
    + _flag("NOT coalesce(regexp_full_match(trim(text), '[+-]?[0-9]+(_[0-9]+)*'), false)")
    + " FROM typed",
)
def _rule_type_integer(spark, sf_dir):
    rule = {"field": "text", "rule_type": "type", "expected_type": "integer"}
    return _status(_typed_texts(spark, sf_dir), field_rules(rule), "event_id")


@query(
    "rule_type_decimal",
    f"WITH {TYPED_TEXT_SQL} SELECT event_id, "
    + _flag("NOT coalesce(regexp_full_match(replace(trim(text), '_', ''), '[+-]?[0-9]+(\\.[0-9]*)?'), false)")
    + " FROM typed",
)
def _rule_type_decimal(spark, sf_dir):
    rule = {"field": "text", "rule_type": "type", "expected_type": "decimal"}
    return _status(_typed_texts(spark, sf_dir), field_rules(rule), "event_id")


@query(
    "rule_type_date",
    f"WITH {DATE_TEXT_SQL} SELECT o_orderkey, "
    + _flag(
        "NOT (coalesce(regexp_full_match(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(text AS DATE) IS NOT NULL, false) "
        "OR coalesce(regexp_full_match(text, '[0-9]{8}') AND try_strptime(text, '%Y%m%d') IS NOT NULL, false))"
    )
    + " FROM dates",
)
def _rule_type_date(spark, sf_dir):
    rule = {"field": "text", "rule_type": "type", "expected_type": "date"}
    return _status(date_texts(spark, sf_dir), field_rules(rule), "o_orderkey")


@query(
    "rule_type_email",
    "SELECT c_custkey, "
    + _flag(
        "NOT regexp_full_match(CASE c_custkey % 3 WHEN 0 THEN c_name || '@x.y' WHEN 1 THEN c_name || '@x' "
        "ELSE coalesce(nullif(c_mktsegment, 'BUILDING'), 'None') || '@@x.y' END, '[^@]+@[^@]+\\.[^@]+')"
    )
    + " FROM customer",
)
def _rule_type_email(spark, sf_dir):
    k = F.col("c_custkey")
    text = (
        F.when(k % 3 == 0, F.concat("c_name", F.lit("@x.y")))
        .when(k % 3 == 1, F.concat("c_name", F.lit("@x")))
        .otherwise(F.concat(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("@@x.y")))
    )
    rule = {"field": "mail", "rule_type": "type", "expected_type": "email"}
    rows = table(spark, sf_dir, "customer").select("c_custkey", text.alias("mail"))
    return _status(rows, field_rules(rule), "c_custkey")


@query(
    "rule_range",
    f"""WITH {AMOUNT_SQL}, numbers AS (SELECT *, {S.double(S.decimal_text('text'))} AS x FROM amounts)
        SELECT {LINE_KEY_SQL}, {_flag('coalesce(x, 0) < 0 OR coalesce(x, 0) > 50000')} FROM numbers""",
)
def _rule_range(spark, sf_dir):
    from rowmill.functions import normalize_decimal

    rule = {"field": "amount", "rule_type": "range", "min_value": 0, "max_value": 50000}
    rows = amount_texts(spark, sf_dir).withColumn("amount", normalize_decimal(F.col("text")))
    return _status(rows, field_rules(rule), *LINE_KEY)


@query(
    "rule_range_numbers",
    "SELECT c_custkey, " + _flag("c_acctbal < 100.5 OR c_acctbal > 5000") + " FROM customer",
)
def _rule_range_numbers(spark, sf_dir):
    rule = {"field": "c_acctbal", "rule_type": "range", "min_value": 100.5, "max_value": 5000}
    return _status(table(spark, sf_dir, "customer"), field_rules(rule), "c_custkey")


@query(
    "rule_enum",
    "SELECT c_custkey, "
    + _flag("upper(coalesce(nullif(c_mktsegment, 'FURNITURE'), 'None')) NOT IN ('HOUSEHOLD', 'MACHINERY')")
    + " FROM customer",
)
def _rule_enum(spark, sf_dir):
    rule = {"field": "segment", "rule_type": "enum", "values": ["household", "Machinery"]}
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("segment")
    )
    return _status(rows, field_rules(rule), "c_custkey")


@query(
    "rule_regex",
    "SELECT page_id, " + _flag("NOT regexp_matches(url, '^https?://[a-z.]+\\.example\\.(com|org)')") + " FROM pages",
)
def _rule_regex(spark, sf_dir):
    rule = {"field": "url", "rule_type": "regex", "pattern": r"https?://[a-z.]+\.example\.(com|org)"}
    return _status(table(spark, sf_dir, "pages"), field_rules(rule), "page_id")


@query(
    "rule_length",
    "SELECT doc_id, " + _flag("length(text) < 200 OR length(text) > 2000") + " FROM documents",
)
def _rule_length(spark, sf_dir):
    rule = {"field": "text", "rule_type": "length", "min_length": 200, "max_length": 2000}
    return _status(table(spark, sf_dir, "documents"), field_rules(rule), "doc_id")


@query(
    "rule_date_format",
    f"""WITH {S.FEED_SQL} SELECT row_id, {_flag(f"NOT {S.iso_ok(chr(34) + 'Created_At' + chr(34))}")} FROM feed""",
)
def _rule_date_format(spark, sf_dir):
    rule = {"field": "Created_At", "rule_type": "date_format"}
    return _status(vendor_feed(spark, sf_dir), field_rules(rule), "row_id")


@query(
    "rule_formula",
    "SELECT "
    + LINE_KEY_SQL
    + ", "
    + _flag("coalesce(l_quantity * l_discount + l_tax <> 1.5, false) AND coalesce(l_quantity > 10, true)")
    + " FROM lineitem",
)
def _rule_formula(spark, sf_dir):
    rule = {
        "fields": ["l_quantity", "l_discount", "l_tax"],
        "rule_type": "formula",
        "formula": "l_quantity * l_discount + l_tax == 1.5 or l_quantity <= 10",
    }
    return _status(table(spark, sf_dir, "lineitem"), cross_rules(rule), *LINE_KEY)


@query(
    "rule_formula_text",
    f"""WITH {S.MAPPED_SQL} SELECT row_id, {_flag(f"coalesce({S.double('quantity')} * {S.double('unit_price')} <> {S.double('total_amount')}, false)")} FROM mapped""",
)
def _rule_formula_text(spark, sf_dir):
    return _status(
        mapped_feed(spark, sf_dir), cross_rules(SAMPLE_RULES["cross_field_rules"][0]), "row_id"
    )


@query(
    "rule_formula_division",
    "SELECT "
    + LINE_KEY_SQL
    + ", "
    + _flag("l_linenumber <> 3 AND NOT (l_extendedprice / (l_linenumber - 3) > 2000 AND floor(l_quantity / 7) <> 2)")
    + " FROM lineitem",
)
def _rule_formula_division(spark, sf_dir):
    rule = {
        "fields": ["l_quantity", "l_extendedprice", "l_linenumber"],
        "rule_type": "formula",
        "formula": "l_extendedprice / (l_linenumber - 3) > 2000 and l_quantity // 7 != 2",
    }
    return _status(table(spark, sf_dir, "lineitem"), cross_rules(rule), *LINE_KEY)


@query(
    "rule_formula_texts",
    "SELECT "
    + LINE_KEY_SQL
    + ", "
    + _flag("NOT (l_returnflag <> 'R' AND l_returnflag || l_linestatus IN ('NO', 'AF') OR l_returnflag < l_linestatus AND l_tax > 0.02)")
    + " FROM lineitem",
)
def _rule_formula_texts(spark, sf_dir):
    rule = {
        "fields": ["l_returnflag", "l_linestatus", "l_tax"],
        "rule_type": "formula",
        "formula": "l_returnflag != 'R' and l_returnflag + l_linestatus in ('NO', 'AF') or l_returnflag < l_linestatus and l_tax > 0.02",
    }
    return _status(table(spark, sf_dir, "lineitem"), cross_rules(rule), *LINE_KEY)


_AMOUNT = S.double("total_amount")


@query(
    "rule_formula_compound",
    f"""WITH {S.MAPPED_SQL} SELECT row_id, {_flag(f"coalesce({S.double('quantity')} IS NOT NULL AND {S.double('unit_price')} IS NOT NULL AND total_amount IS NOT NULL AND ({_AMOUNT} IS NULL OR {S.double('quantity')} * {S.double('unit_price')} <> {_AMOUNT} OR {S.double('quantity')} <= 2), false)")} FROM mapped""",
)
def _rule_formula_compound(spark, sf_dir):
    rule = {
        "fields": ["quantity", "unit_price", "total_amount"],
        "rule_type": "formula",
        "formula": "quantity * unit_price == total_amount and quantity > 2",
    }
    return _status(mapped_feed(spark, sf_dir), cross_rules(rule), "row_id")


@query(
    "rule_dependency",
    "SELECT l.o_orderkey, " + _flag("o_orderstatus = 'P' AND o_totalprice < 100000") + " FROM orders l",
)
def _rule_dependency(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_totalprice") < 100000, "").otherwise("big").alias("size"),
    )
    rule = {
        "fields": ["o_orderstatus", "size"],
        "rule_type": "dependency",
        "condition_field": "o_orderstatus",
        "condition_value": "P",
        "required_field": "size",
    }
    return _status(rows, cross_rules(rule), "o_orderkey")


@query(
    "rule_mutual_exclusion",
    "SELECT " + LINE_KEY_SQL + ", " + _flag("l_discount <> 0 AND l_tax <> 0") + " FROM lineitem",
)
def _rule_mutual_exclusion(spark, sf_dir):
    rule = {"fields": ["l_discount", "l_tax"], "rule_type": "mutual_exclusion"}
    return _status(table(spark, sf_dir, "lineitem"), cross_rules(rule), *LINE_KEY)


@query(
    "rule_status_transition",
    "SELECT o_orderkey, " + _flag("o_orderstatus NOT IN ('O', 'P')") + " FROM orders",
)
def _rule_status_transition(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("order_status")
    )
    rule = {"rule_type": "status_transition", "allowed_from": ["O", "P"]}
    return _status(rows, semantic_rules(rule), "o_orderkey")


@query(
    "rule_business_hours",
    "SELECT event_id, "
    + _flag("extract(hour FROM ts) < 9 OR extract(hour FROM ts) >= 17")
    + " FROM events",
)
def _rule_business_hours(spark, sf_dir):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:30"))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("created_at"))
    return _status(rows, semantic_rules({"rule_type": "business_hours"}), "event_id")


@query(
    "rule_inventory",
    "SELECT " + LINE_KEY_SQL + ", " + _flag("l_quantity > CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE p_size END")
    + " FROM lineitem JOIN part ON l_partkey = p_partkey",
)
def _rule_inventory(spark, sf_dir):
    """Lines that order more than there is of their part; every fifth part has no stock."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_partkey", F.col("l_quantity").alias("quantity"))
    parts = table(spark, sf_dir, "part").where("p_partkey % 5 <> 0")
    stock = parts.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("on_hand"))
    rule = {"rule_type": "inventory", "stock_field": "on_hand"}
    return _status(with_stock(lines, stock, ["l_partkey"]), semantic_rules(rule), *LINE_KEY)


def _json_feed(spark, sf_dir, cells):
    """Events as JSON objects whose values are of every kind, read as files and mapped."""
    path = scratch_path(spark, "kinds")
    parts = [F.lit('{"id":'), F.col("event_id").cast("string")]
    for name, values in cells.items():
        chosen = F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % len(values) + 1).cast("int"))
        parts += [F.lit(f',"{name}":'), chosen]
    table(spark, sf_dir, "events").select(F.concat(*parts, F.lit("}")).alias("line")).write.text(path)
    rows = read_rows(spark, list_files(spark, path, format="json", range_bytes=1 << 20))
    mapping = [MappingRule(n, n.upper()) for n in ("id", *cells)]
    return map_fields(normalise_map(rows), mapping, Fields.ragged("normalized", "raw_kinds"))


@query(
    "rule_dependency_json",
    "SELECT event_id, " + _flag("event_id % 5 IN (0, 2) AND event_id % 7 IN (0, 1, 3, 4, 5)") + " FROM events",
)
def _rule_dependency_json(spark, sf_dir):
    """A condition on true, which 1 equals and "true" does not; 0 is not set and "0" is."""
    cells = {
        "gift": ["true", '"true"', "1", "false", '"1"'],
        "note": ["false", "0", '"0"', '""', "null", "[]", '{"a":1}'],
    }
    rule = {"fields": [], "rule_type": "dependency", "condition_field": "GIFT", "condition_value": True, "required_field": "NOTE"}
    rows = _json_feed(spark, sf_dir, cells).withColumn("event_id", F.col("ID").cast("bigint"))
    return _status(rows, cross_rules(rule), "event_id")


@query(
    "rule_mutual_exclusion_json",
    "SELECT event_id, " + _flag("event_id % 4 IN (1, 2) AND event_id % 3 IN (0, 2)") + " FROM events",
)
def _rule_mutual_exclusion_json(spark, sf_dir):
    """Of two fields at most one may be set, whatever the kinds of their values."""
    cells = {"a": ["0.0", '"0"', "true", "{}"], "b": ["[0]", "0", '"false"']}
    rows = _json_feed(spark, sf_dir, cells).withColumn("event_id", F.col("ID").cast("bigint"))
    return _status(rows, cross_rules({"fields": ["A", "B"], "rule_type": "mutual_exclusion"}), "event_id")


@query(
    "rule_custom_check",
    "SELECT p_partkey, " + _flag("p_size % 2 = 1") + " FROM part",
)
def _rule_custom_check(spark, sf_dir):
    register_check("even", lambda fields, name, rule: fields.number(name) % 2 != 0)
    return _status(
        table(spark, sf_dir, "part"), field_rules({"field": "p_size", "rule_type": "even"}), "p_partkey"
    )


@query(
    "schema_constraints",
    f"""WITH {S.MAPPED_SQL} SELECT row_id, {_flag(
        "order_id IS NULL OR length(order_id) > 100 OR order_date IS NULL "
        f"OR product_code IS NULL OR quantity IS NULL OR {S.double('quantity')} IS NULL OR {S.double('quantity')} < 1 "
        "OR unit_price IS NULL OR total_amount IS NULL OR currency IS NULL "
        "OR upper(currency) NOT IN ('USD', 'EUR', 'GBP', 'JPY') "
        "OR upper(coalesce(order_status, 'None')) NOT IN ('PENDING', 'CONFIRMED', 'SHIPPED', 'DELIVERED', 'CANCELLED')"
    )} FROM mapped""",
)
def _schema_constraints(spark, sf_dir):
    return _status(
        mapped_feed(spark, sf_dir), field_rules(*CanonicalSchema().constraint_rules()), "row_id"
    )


@query(
    "validate_ragged",
    """SELECT event_id, CASE WHEN event_type = 'click' AND value < 20 THEN 'flagged' ELSE 'valid' END AS status
       FROM events""",
)
def _validate_ragged(spark, sf_dir):
    """The rule is skipped on rows without the key."""
    raw = F.create_map(F.col("event_type"), F.col("value").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    rule = {"field": "click", "rule_type": "range", "min_value": 20}
    return _status(rows, field_rules(rule), "event_id", fields=Fields.ragged("raw"))


@query(
    "validate_full",
    f"""WITH {S.CHECKED_SQL} SELECT row_id, status, len(errors) AS n_errors,
          coalesce(array_to_string(list_transform(errors, lambda e: coalesce(e.field, 'None') || ':' || e.rule), '|'), '') AS errors
        FROM validated""",
)
def _validate_full(spark, sf_dir):
    return validated_feed(spark, sf_dir).select(
        "row_id",
        "status",
        F.size("validation_errors").cast("bigint").alias("n_errors"),
        error_string().alias("errors"),
    )


@query(
    "validate_file_totals",
    f"""WITH {S.CHECKED_SQL} SELECT file_id, count(*) AS total_rows, count(*) FILTER (status = 'valid') AS valid_rows,
          count(*) FILTER (status = 'flagged') AS flagged_rows,
          round(100.0 * count(*) FILTER (status = 'valid') / count(*), 2)::DOUBLE AS valid_percentage
        FROM validated GROUP BY file_id""",
)
def _validate_file_totals(spark, sf_dir):
    return totals(validated_feed(spark, sf_dir), ["file_id"])
