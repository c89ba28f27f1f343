"""Queries over duplicates, fuzzy matches and header suggestions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.operators import dedup, matching
from rowmill.plans import sql as S
from rowmill.plans.catalog import query
from rowmill.plans.feed import FEED_SQL, table, vendor_feed
from rowmill.records import Fields
from rowmill.schema import ORDER_FIELDS

TEXT_KEY = f"md5({S.strip('lower(text)')})"


@query(
    "dedup_key",
    f"""SELECT doc_id, md5(concat_ws('|', {S.strip('lower(lang)')}, CASE WHEN source <> 'src1' THEN {S.strip('lower(source)')} END, '')) AS dedup_key
        FROM documents""",
)
def _dedup_key(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.nullif("source", F.lit("src1")).alias("source")
    )
    key = dedup.dedup_key(Fields.flat(docs), ["lang", "source", "not_there"])
    return docs.select("doc_id", key.alias("dedup_key"))


@query(
    "duplicate_groups",
    f"""SELECT {TEXT_KEY} AS dedup_key, min(doc_id) AS first_position, count(*) AS n_rows
        FROM documents GROUP BY 1 HAVING count(*) > 1""",
)
def _duplicate_groups(spark, sf_dir):
    return dedup.duplicate_groups(table(spark, sf_dir, "documents"), ["text"], "doc_id")


@query(
    "duplicate_lines",
    """SELECT md5(l_orderkey || '|' || l_linenumber) AS dedup_key, min(l_partkey) AS first_position, count(*) AS n_rows
       FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
)
def _duplicate_lines(spark, sf_dir):
    return dedup.duplicate_groups(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_partkey"
    )


@query(
    "duplicate_members",
    f"""WITH k AS (SELECT doc_id, {TEXT_KEY} AS dedup_key FROM documents),
        g AS (SELECT *, min(doc_id) OVER w AS first_position, count(*) OVER w AS n_rows FROM k
              WINDOW w AS (PARTITION BY dedup_key))
        SELECT doc_id, dedup_key, first_position, n_rows FROM g WHERE n_rows > 1""",
)
def _duplicate_members(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup.duplicate_members(docs, ["text"], "doc_id").select(
        "doc_id", "dedup_key", "first_position", "n_rows"
    )


def _marks(rows):
    error = F.try_element_at("validation_errors", F.lit(1))
    return rows.select("doc_id", error["rule"].alias("rule"), error["message"].alias("message"))


MARKED = f"""WITH k AS (SELECT doc_id, {TEXT_KEY} AS dedup_key FROM documents),
  g AS (SELECT *, min(doc_id) OVER w AS f, count(*) OVER w AS n FROM k WINDOW w AS (PARTITION BY dedup_key))
  SELECT doc_id, CASE WHEN n > 1 {{extra}} THEN 'duplicate' END AS rule,
    CASE WHEN n > 1 {{extra}} THEN 'Duplicate of row ' || f END AS message FROM g"""


@query("mark_duplicates", MARKED.format(extra="AND doc_id <> f"))
def _mark_duplicates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _marks(dedup.mark_duplicates(docs, ["text"], "doc_id"))


@query("mark_duplicates_all", MARKED.format(extra=""))
def _mark_duplicates_all(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _marks(dedup.mark_duplicates(docs, ["text"], "doc_id", keep_first=False))


@query(
    "mark_duplicates_across_files",
    f"""WITH {FEED_SQL},
        placed AS (SELECT *, md5(lower(trim("Order_ID", chr(9) || ' ')) || '|' || lower(trim("Qty", ' '))) AS key FROM feed),
        firsts AS (SELECT key, arg_min(row_id, (file_id, line_number, row_id)) AS first_row, count(*) AS n FROM placed GROUP BY key)
        SELECT row_id, CASE WHEN n > 1 AND row_id <> first_row THEN 'Duplicate of row ' || first_row END AS message
        FROM placed JOIN firsts USING (key)""",
)
def _mark_duplicates_across_files(spark, sf_dir):
    rows = vendor_feed(spark, sf_dir).select("file_id", "line_number", "row_id", "Order_ID", "Qty")
    return dedup.mark_duplicates(rows, ["Order_ID", "Qty"]).select(
        "row_id", F.get("validation_errors", F.lit(0))["message"].alias("message")
    )


def fuzzy_sql(a: str, b: str, threshold: float) -> str:
    x, y = S.strip(f"lower({a})"), S.strip(f"lower({b})")
    longer = f"greatest(length({x}), length({y}))"
    return (
        f"coalesce({a} <> '' AND {b} <> '' AND ({x} = {y} OR (abs(length({x}) - length({y})) <= {longer} * 0.3 "
        f"AND {longer} > 0 AND (length({x}) - length(translate({x}, {y}, ''))) / {longer} >= {threshold})), false)"
    )


@query(
    "fuzzy_match",
    f"""SELECT a.conv_id, a.turn, {fuzzy_sql('a.text', 'b.text', 0.85)} AS similar
        FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
)
def _fuzzy_match(spark, sf_dir):
    """Each turn against the next one of its conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("other"))
    return turns.join(following, ["conv_id", "turn"]).select(
        "conv_id", "turn", dedup.fuzzy_match(F.col("text"), F.col("other")).alias("similar")
    )


@query(
    "fuzzy_match_words",
    f"""SELECT p_partkey, {fuzzy_sql('p_name', "split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)", 0.5)} AS swapped,
          {fuzzy_sql('p_name', "'red ring'", 0.8)} AS near FROM part""",
)
def _fuzzy_match_words(spark, sf_dir):
    name = F.col("p_name")
    swapped = F.concat(F.split_part(name, F.lit(" "), F.lit(2)), F.lit(" "), F.split_part(name, F.lit(" "), F.lit(1)))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        dedup.fuzzy_match(name, swapped, 0.5).alias("swapped"),
        dedup.fuzzy_match(name, F.lit("red ring"), 0.8).alias("near"),
    )


@query(
    "header_similarity",
    """SELECT p_partkey,
         len(list_intersect(list_distinct(string_split(lower(p_name), '')), list_distinct(string_split(lower(p_type), ''))))
           / greatest(length(p_name), length(p_type))::DOUBLE AS similarity FROM part""",
)
def _header_similarity(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        matching.character_similarity(F.lower("p_name"), F.lower("p_type")).alias("similarity"),
    )


# vendor headers: every distinct word of the documents, and the canonical names spelt oddly
CANONICAL = list(ORDER_FIELDS)
HEADERS_SQL = f"""
words AS MATERIALIZED (SELECT DISTINCT unnest(regexp_split_to_array(text, '[^\\p{{L}}\\p{{N}}]+')) AS header FROM documents),
canon AS (SELECT unnest({CANONICAL!r}) AS canonical_field, unnest(range({len(CANONICAL)})) AS nr),
headers AS MATERIALIZED (
  SELECT header FROM words WHERE header <> ''
  UNION SELECT CASE l.doc_id % 3 WHEN 0 THEN upper(canonical_field) WHEN 1 THEN replace(canonical_field, '_', '-')
     ELSE canonical_field || '!' END AS header
  FROM labels l JOIN canon ON canon.nr = l.doc_id % {len(CANONICAL)})"""


def vendor_headers(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(
        F.explode(F.split("text", r"[^\p{L}\p{N}]+")).alias("header")
    )
    name = F.get(F.array(*[F.lit(c) for c in CANONICAL]), (F.col("doc_id") % len(CANONICAL)).cast("int"))
    form = F.col("doc_id") % 3
    odd = table(spark, sf_dir, "labels").select(
        F.when(form == 0, F.upper(name))
        .when(form == 1, F.replace(name, F.lit("_"), F.lit("-")))
        .otherwise(F.concat(name, F.lit("!")))
        .alias("header")
    )
    return words.where("header <> ''").union(odd).distinct()


SCORED_SQL = HEADERS_SQL + """,
scored AS (
  SELECT header, canonical_field, nr,
    CASE WHEN lower(header) = lower(canonical_field) THEN 0.99::DOUBLE
         WHEN contains(lower(header), lower(canonical_field)) OR contains(lower(canonical_field), lower(header)) THEN 0.7::DOUBLE
         ELSE len(list_intersect(list_distinct(string_split(lower(header), '')), list_distinct(string_split(canonical_field, ''))))
              / greatest(length(lower(header)), length(canonical_field))::DOUBLE END AS score
  FROM headers CROSS JOIN canon),
ranked AS (SELECT header, canonical_field, score, row_number() OVER (PARTITION BY header ORDER BY score DESC, nr) AS rank
           FROM scored WHERE score > 0.5)"""


@query("suggest_mapping", f"WITH {SCORED_SQL} SELECT header, canonical_field, score, rank FROM ranked")
def _suggest_mapping(spark, sf_dir):
    return matching.suggest_mapping(vendor_headers(spark, sf_dir), CANONICAL)


@query(
    "best_suggestion",
    f"WITH {SCORED_SQL} SELECT header, canonical_field, score FROM ranked WHERE rank = 1",
)
def _best_suggestion(spark, sf_dir):
    return matching.best_suggestion(vendor_headers(spark, sf_dir), CANONICAL)


PLAIN = "lower(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'))"
MATCH_SQL = HEADERS_SQL + f""",
matches AS MATERIALIZED (
  SELECT header, canonical_field, 1.0::DOUBLE AS confidence, 'Exact match' AS rationale
  FROM headers JOIN canon ON lower(header) = lower(canonical_field)
  UNION ALL
  SELECT header, canonical_field, 0.95::DOUBLE, 'Normalized match'
  FROM headers JOIN canon ON {PLAIN.format(x='header')} = {PLAIN.format(x='canonical_field')})"""


@query(
    "match_headers",
    f"WITH {MATCH_SQL} SELECT header, canonical_field, confidence, rationale FROM matches",
)
def _match_headers(spark, sf_dir):
    return matching.match_headers(vendor_headers(spark, sf_dir), CANONICAL)


@query(
    "unmatched_headers",
    f"WITH {MATCH_SQL} SELECT header FROM headers ANTI JOIN matches USING (header)",
)
def _unmatched_headers(spark, sf_dir):
    return matching.unmatched_headers(vendor_headers(spark, sf_dir), CANONICAL)


@query(
    "propose_mapping",
    f"""WITH {MATCH_SQL}, {SCORED_SQL[len(HEADERS_SQL) + 2:]},
        best AS (SELECT header, arg_max(canonical_field, confidence) AS canonical_field, max(confidence) AS confidence,
                   arg_max(rationale, confidence) AS rationale FROM matches GROUP BY header)
        SELECT * FROM best UNION ALL
        SELECT header, canonical_field, score, 'Suggested' FROM ranked ANTI JOIN matches USING (header) WHERE rank = 1""",
)
def _propose_mapping(spark, sf_dir):
    return matching.propose_mapping(vendor_headers(spark, sf_dir), CANONICAL)
