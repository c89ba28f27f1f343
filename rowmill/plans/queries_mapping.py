"""Queries over field mapping, typing and unmapped fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.operators.mapping import (
    MappingRule,
    canonical_map,
    map_fields,
    rules_from_dict,
    unmapped_fields,
)
from rowmill.operators.normalize import normalise_rows
from rowmill.plans import sql as S
from rowmill.plans.catalog import query
from rowmill.plans.feed import FEED_MAPPING, FEED_SQL, SAMPLE_MAPPING, table, vendor_feed
from rowmill.records import PRESENT, Fields
from rowmill.schema import CanonicalSchema, cast_to_schema, normalise_by_schema


def _feed(spark, sf_dir):
    return normalise_rows(vendor_feed(spark, sf_dir))


@query(
    "map_exact",
    f"WITH {FEED_SQL} SELECT row_id, "
    + ", ".join(f"{S.strip_or_null(chr(34) + v + chr(34))} AS {c}" for v, c in SAMPLE_MAPPING.items())
    + " FROM feed",
)
def _map_exact(spark, sf_dir):
    return map_fields(_feed(spark, sf_dir), rules_from_dict(SAMPLE_MAPPING)).select(
        "row_id", *SAMPLE_MAPPING.values()
    )


@query(
    "map_regex",
    "SELECT page_id, CASE WHEN regexp_matches(url, '^https://.*\\.org/') THEN url END AS secure_url, "
    "regexp_matches(url, '^https://.*\\.org/') AS present FROM pages",
)
def _map_regex(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    rules = [MappingRule("url", "secure_url", "regex", r"^https://.*\.org/")]
    return map_fields(pages, rules, keep=["page_id"]).select(
        "page_id", "secure_url", F.array_contains(PRESENT, "secure_url").alias("present")
    )


@query(
    "map_substring",
    "SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN p_name END AS ring_name, "
    "contains(p_name, 'ring') AS present FROM part",
)
def _map_substring(spark, sf_dir):
    rules = [MappingRule("p_name", "ring_name", "substring", "ring")]
    return map_fields(table(spark, sf_dir, "part"), rules, keep=["p_partkey"]).select(
        "p_partkey", "ring_name", F.array_contains(PRESENT, "ring_name").alias("present")
    )


@query(
    "map_function",
    "SELECT o_orderkey, upper(replace(o_orderpriority, '-', '_')) AS priority FROM orders",
)
def _map_function(spark, sf_dir):
    def shout(c):
        return F.upper(F.replace(c, F.lit("-"), F.lit("_")))

    rules = [MappingRule("o_orderpriority", "priority", "function", function=shout)]
    return map_fields(table(spark, sf_dir, "orders"), rules, keep=["o_orderkey"]).select(
        "o_orderkey", "priority"
    )


CONFLICT = [
    MappingRule("p_brand", "label", priority=5, confidence=0.5),
    MappingRule("p_name", "label", "substring", "blue", priority=20, confidence=0.9),
    MappingRule("p_type", "label", "regex", "^(SMALL|LARGE)$", priority=10, confidence=0.7),
]


@query(
    "map_priority_conflict",
    """SELECT p_partkey,
         CASE WHEN contains(p_name, 'blue') THEN p_name WHEN p_type IN ('SMALL', 'LARGE') THEN p_type
              ELSE p_brand END AS label,
         p_brand AS first_label FROM part""",
)
def _map_priority_conflict(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    first = map_fields(parts, CONFLICT, keep=["p_partkey"], win="first").select(
        "p_partkey", F.col("label").alias("first_label")
    )
    return map_fields(parts, CONFLICT, keep=["p_partkey"]).select("p_partkey", "label").join(
        first, "p_partkey"
    )


@query(
    "mapping_confidence",
    """SELECT p_partkey,
         CASE WHEN contains(p_name, 'blue') THEN 0.9::DOUBLE WHEN p_type IN ('SMALL', 'LARGE') THEN 0.7::DOUBLE
              ELSE 0.5::DOUBLE END AS label_confidence,
         CASE WHEN contains(p_name, 'widget') THEN 0.8::DOUBLE END AS widget_confidence,
         CASE WHEN contains(p_name, 'widget') THEN 2 ELSE 1 END AS n_mapped FROM part""",
)
def _mapping_confidence(spark, sf_dir):
    rules = [*CONFLICT, MappingRule("p_name", "widget", "substring", "widget", confidence=0.8)]
    c = F.col("mapping_confidence")
    return map_fields(table(spark, sf_dir, "part"), rules, keep=["p_partkey"]).select(
        "p_partkey",
        F.try_element_at(c, F.lit("label")).alias("label_confidence"),
        F.try_element_at(c, F.lit("widget")).alias("widget_confidence"),
        F.size(c).alias("n_mapped"),
    )


@query(
    "unmapped_fields",
    """SELECT unnest(['p_partkey', 'p_brand', 'p_size', 'p_retailprice']) AS field
       UNION ALL SELECT 'p_type' AS field WHERE EXISTS (SELECT 1 FROM part WHERE p_type NOT LIKE 'S%')""",
)
def _unmapped_fields(spark, sf_dir):
    rules = [MappingRule("p_name", "name"), MappingRule("p_type", "kind", "regex", "^S")]
    return unmapped_fields(table(spark, sf_dir, "part"), rules)


@query(
    "unmapped_fields_ragged",
    """SELECT DISTINCT key AS field FROM (SELECT unnest(json_keys(props)) AS key FROM events
         UNION ALL SELECT event_type FROM events) WHERE key <> 'k' OR key IS NULL""",
)
def _unmapped_fields_ragged(spark, sf_dir):
    props = F.from_json("props", "map<string,string>")
    typed = F.create_map(F.col("event_type"), F.col("value").cast("string"))
    raw = F.map_concat(props, typed)
    rows = table(spark, sf_dir, "events").select(raw.alias("raw"))
    return unmapped_fields(rows, [MappingRule("k", "key")], Fields.ragged("raw"))


@query(
    "map_ragged",
    """SELECT event_id, json_extract_string(props, '$.k') AS key,
         CASE WHEN event_type = 'click' THEN CAST(event_id AS VARCHAR) END AS click,
         event_type = 'click' AS has_click FROM events""",
)
def _map_ragged(spark, sf_dir):
    props = F.from_json("props", "map<string,string>")
    typed = F.create_map(F.col("event_type"), F.col("event_id").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", F.map_concat(props, typed).alias("raw"))
    rules = [MappingRule("k", "key"), MappingRule("click", "click")]
    return map_fields(rows, rules, Fields.ragged("raw"), keep=["event_id"]).select(
        "event_id", "key", "click", F.array_contains(PRESENT, "click").alias("has_click")
    )


@query(
    "canonical_types",
    f"""WITH {FEED_SQL}, texts AS (
          SELECT row_id, {S.strip_or_null('"Order_ID"')} AS order_id, {S.date_text('"Order_Date"')} AS d,
                 {S.strip_or_null('"Qty"')} AS q, {S.decimal_text('"Unit_Price"')} AS p,
                 {S.decimal_text('"Total"')} AS t, {S.strip_or_null('"Currency"')} AS currency FROM feed)
        SELECT row_id, order_id, strftime(TRY_CAST(d AS DATE), '%Y-%m-%d') AS order_date,
          CASE WHEN regexp_matches(q, '^[+-]?[0-9]+$') THEN CAST(CAST(q AS BIGINT) AS VARCHAR) END AS quantity,
          CAST(CAST(TRY_CAST(p AS DECIMAL(38, 9)) * 100 AS BIGINT) AS VARCHAR) AS unit_price_cents,
          CAST(CAST(TRY_CAST(t AS DECIMAL(38, 9)) * 100 AS BIGINT) AS VARCHAR) AS total_cents, currency
        FROM texts""",
)
def _canonical_types(spark, sf_dir):
    schema = CanonicalSchema()
    mapped = map_fields(_feed(spark, sf_dir), rules_from_dict(FEED_MAPPING))
    typed = cast_to_schema(normalise_by_schema(mapped, schema), schema)
    return typed.select(
        "row_id",
        "order_id",
        F.col("order_date").cast("string").alias("order_date"),
        F.col("quantity").cast("string").alias("quantity"),
        (F.col("unit_price") * 100).cast("bigint").cast("string").alias("unit_price_cents"),
        (F.col("total_amount") * 100).cast("bigint").cast("string").alias("total_cents"),
        "currency",
    )


@query(
    "map_rows_per_file",
    f"""WITH {FEED_SQL} SELECT file_id, count(*) AS n_rows,
          count({S.strip_or_null('"Order_ID"')}) AS with_order_id,
          count({S.strip_or_null('"Discount_Code"')}) AS with_code FROM feed GROUP BY file_id""",
)
def _map_rows_per_file(spark, sf_dir):
    mapped = map_fields(_feed(spark, sf_dir), rules_from_dict(FEED_MAPPING))
    return mapped.groupBy("file_id").agg(
        F.count("*").alias("n_rows"),
        F.count("order_id").alias("with_order_id"),
        F.count("discount_code").alias("with_code"),
    )


@query(
    "select_fields",
    "SELECT p_partkey, p_name, CASE WHEN contains(p_name, 'ring') THEN 2 ELSE 1 END AS n_fields FROM part",
)
def _select_fields(spark, sf_dir):
    rules = [MappingRule("p_name", "name"), MappingRule("p_name", "ring", "substring", "ring")]
    mapped = map_fields(table(spark, sf_dir, "part"), rules, keep=["p_partkey"])
    data = canonical_map(mapped, ["name", "ring", "not_there"])
    return mapped.select(
        "p_partkey",
        F.try_element_at(data, F.lit("name")).alias("p_name"),
        F.size(data).alias("n_fields"),
    )
