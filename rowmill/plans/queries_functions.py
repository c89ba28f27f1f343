"""Queries over single functions, each on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions import (
    collapse_text,
    content_hash,
    detect_separators,
    normalize_boolean,
    normalize_date,
    normalize_email,
    normalize_header,
    normalize_phone,
    redact,
    truncate,
)
from rowmill.operators.normalize import normalise_dates, normalise_decimals, normalise_map, normalise_rows
from rowmill.plans import sql as S
from rowmill.plans.catalog import query
from rowmill.plans.feed import FEED_SQL, table, vendor_feed

# order dates in eleven spellings, by key
DATE_TEXT_SQL = """
dates AS (
  SELECT o_orderkey,
    CASE o_orderkey % 11
      WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(o_orderdate, ' %Y/%m/%d ')
      WHEN 2 THEN strftime(o_orderdate, '%d-%m-%Y')
      WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y')
      WHEN 4 THEN strftime(o_orderdate, '%m/%d/%Y')
      WHEN 5 THEN strftime(o_orderdate, '%Y%m%d')
      WHEN 6 THEN strftime(o_orderdate, '%d.%m.%Y')
      WHEN 7 THEN strftime(o_orderdate, '%d/%m/%Y 08:05:59')
      WHEN 8 THEN '2024-99-' || (10 + o_orderkey % 90)
      WHEN 9 THEN (1 + o_orderkey % 9) || '/' || (1 + o_orderkey % 13) || '/2023'
      ELSE 'day ' || o_orderkey END AS text
  FROM orders
)"""


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    form = k % 11
    return table(spark, sf_dir, "orders").select(
        k,
        F.when(form == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(form == 1, F.date_format(d, " yyyy/MM/dd "))
        .when(form == 2, F.date_format(d, "dd-MM-yyyy"))
        .when(form == 3, F.date_format(d, "dd/MM/yyyy"))
        .when(form == 4, F.date_format(d, "MM/dd/yyyy"))
        .when(form == 5, F.date_format(d, "yyyyMMdd"))
        .when(form == 6, F.date_format(d, "dd.MM.yyyy"))
        .when(form == 7, F.concat(F.date_format(d, "dd/MM/yyyy"), F.lit(" 08:05:59")))
        .when(form == 8, F.concat(F.lit("2024-99-"), (10 + k % 90).cast("string")))
        .when(
            form == 9,
            F.concat((1 + k % 9).cast("string"), F.lit("/"), (1 + k % 13).cast("string"), F.lit("/2023")),
        )
        .otherwise(F.concat(F.lit("day "), k.cast("string")))
        .alias("text"),
    )


@query(
    "normalize_date",
    f"WITH {DATE_TEXT_SQL} SELECT o_orderkey, {S.date_text('text')} AS iso FROM dates",
)
def _normalize_date(spark, sf_dir):
    return normalise_dates(date_texts(spark, sf_dir).select("o_orderkey", F.col("text").alias("iso")), ["iso"])


@query(
    "normalize_date_source_format",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders",
)
def _normalize_date_source_format(spark, sf_dir):
    text = F.date_format("o_orderdate", "MM/dd/yyyy")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", normalize_date(text, "%m/%d/%Y").alias("iso")
    )


# part prices in nine spellings, by key
AMOUNT_SQL = """
amounts AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE (l_orderkey + l_linenumber) % 9
      WHEN 0 THEN whole || '.' || part
      WHEN 1 THEN (whole // 1000) || ',' || lpad(CAST(whole % 1000 AS VARCHAR), 3, '0') || '.' || part
      WHEN 2 THEN (whole // 1000) || '.' || lpad(CAST(whole % 1000 AS VARCHAR), 3, '0') || ',' || part
      WHEN 3 THEN whole || ',' || part
      WHEN 4 THEN '1,' || lpad(CAST(whole % 1000 AS VARCHAR), 3, '0') || ',000'
      WHEN 5 THEN '1.' || lpad(CAST(whole % 1000 AS VARCHAR), 3, '0') || '.000'
      WHEN 6 THEN '$' || whole
      WHEN 7 THEN ' +00' || whole || '.' || part || '0 '
      ELSE '-.' || part END AS text
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) // 100 AS whole,
               lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS part
        FROM lineitem)
)"""


def amount_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    whole = F.floor(cents / 100).cast("bigint")
    w, part = whole.cast("string"), F.lpad((cents % 100).cast("string"), 2, "0")
    high = F.floor(whole / 1000).cast("bigint").cast("string")
    low = F.lpad((whole % 1000).cast("string"), 3, "0")
    form = (F.col("l_orderkey") + F.col("l_linenumber")) % 9
    text = (
        F.when(form == 0, F.concat(w, F.lit("."), part))
        .when(form == 1, F.concat(high, F.lit(","), low, F.lit("."), part))
        .when(form == 2, F.concat(high, F.lit("."), low, F.lit(","), part))
        .when(form == 3, F.concat(w, F.lit(","), part))
        .when(form == 4, F.concat(F.lit("1,"), low, F.lit(",000")))
        .when(form == 5, F.concat(F.lit("1."), low, F.lit(".000")))
        .when(form == 6, F.concat(F.lit("$"), w))
        .when(form == 7, F.concat(F.lit(" +00"), w, F.lit("."), part, F.lit("0 ")))
        .otherwise(F.concat(F.lit("-."), part))
    )
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_extendedprice")
    return lines.select(*LINE_KEY, text.alias("text"))


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_KEY_SQL = ", ".join(LINE_KEY)


@query(
    "normalize_decimal",
    f"WITH {AMOUNT_SQL} SELECT {LINE_KEY_SQL}, {S.decimal_text('text')} AS amount FROM amounts",
)
def _normalize_decimal(spark, sf_dir):
    return normalise_decimals(amount_texts(spark, sf_dir).withColumnRenamed("text", "amount"), ["amount"])


@query(
    "normalize_decimal_given_separators",
    f"""WITH {AMOUNT_SQL}, swapped AS (
          SELECT {LINE_KEY_SQL}, replace(replace({S.strip('text')}, '.', ''), ',', '.') AS t FROM amounts)
        SELECT {LINE_KEY_SQL}, CASE WHEN regexp_matches(t, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN
          CASE WHEN left(t, 1) = '-' THEN '-' ELSE '' END
          || coalesce(nullif(ltrim(regexp_extract(t, '^([+-]?)([0-9]*)', 2), '0'), ''), '0')
          || CASE WHEN contains(t, '.') THEN '.' || split_part(t, '.', 2) ELSE '' END END AS amount
        FROM swapped""",
)
def _normalize_decimal_given(spark, sf_dir):
    return normalise_decimals(amount_texts(spark, sf_dir).withColumnRenamed("text", "amount"), ["amount"], ",", ".")


@query(
    "detect_separators",
    f"""WITH {AMOUNT_SQL}, counted AS (
          SELECT *, length(text) - length(replace(text, '.', '')) AS dots,
                 length(text) - length(replace(text, ',', '')) AS commas FROM amounts)
        SELECT {LINE_KEY_SQL},
          CASE WHEN dots > 0 AND commas > 0 THEN
                 CASE WHEN instr(reverse(text), '.') < instr(reverse(text), ',') THEN '.' ELSE ',' END
               WHEN commas > 1 THEN '.' WHEN dots > 1 THEN ',' ELSE '.' END AS decimal_mark,
          CASE WHEN dots > 0 AND commas > 0 THEN
                 CASE WHEN instr(reverse(text), '.') < instr(reverse(text), ',') THEN ',' ELSE '.' END
               WHEN commas > 1 THEN ',' WHEN dots > 1 THEN '.' END AS thousands_mark
        FROM counted""",
)
def _detect_separators(spark, sf_dir):
    found = detect_separators(F.col("text"))
    return amount_texts(spark, sf_dir).select(
        *LINE_KEY,
        found["decimal"].alias("decimal_mark"),
        found["thousands"].alias("thousands_mark"),
    )


@query(
    "normalize_email",
    f"""WITH mails AS (
          SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN ' ' || c_name || '@Mail.Example.com '
            WHEN 1 THEN replace(c_name, '#', '.') || '@EXAMPLE.org' || chr(10) WHEN 2 THEN replace(c_name, '#', '+') || '@example'
            WHEN 3 THEN replace(c_name, '#', '@') || '@example.com' ELSE replace(c_name, '#', '_') || '@a-b.co' END AS text
          FROM customer)
        SELECT c_custkey, CASE WHEN regexp_full_match(lower({S.strip('text')}), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}')
          THEN lower({S.strip('text')}) END AS email FROM mails""",
)
def _normalize_email(spark, sf_dir):
    k, name = F.col("c_custkey"), F.col("c_name")

    def mail(mark, tail):
        return F.concat(F.replace(name, F.lit("#"), F.lit(mark)), F.lit(tail))

    text = (
        F.when(k % 5 == 0, F.concat(F.lit(" "), name, F.lit("@Mail.Example.com ")))
        .when(k % 5 == 1, mail(".", "@EXAMPLE.org\n"))
        .when(k % 5 == 2, mail("+", "@example"))
        .when(k % 5 == 3, mail("@", "@example.com"))
        .otherwise(mail("_", "@a-b.co"))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", normalize_email(text).alias("email"))


@query(
    "normalize_phone",
    "SELECT c_custkey, nullif(regexp_replace(CASE WHEN c_custkey % 7 = 0 THEN 'n/a' "
    "ELSE '+1 (555) ' || c_custkey || '-' || c_nationkey END, '[^0-9+]', '', 'g'), '') AS phone FROM customer",
)
def _normalize_phone(spark, sf_dir):
    k = F.col("c_custkey")
    text = F.when(k % 7 == 0, "n/a").otherwise(
        F.concat(F.lit("+1 (555) "), k.cast("string"), F.lit("-"), F.col("c_nationkey").cast("string"))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", normalize_phone(text).alias("phone"))


BOOLEAN_WORDS = ["TRUE", " yes", "1", "Y", "on", "false", "No ", "0", "n", "OFF", "maybe", ""]


@query(
    "normalize_boolean",
    "WITH words AS (SELECT event_id, (["
    + ", ".join(f"'{w}'" for w in BOOLEAN_WORDS)
    + f"""])[1 + event_id % {len(BOOLEAN_WORDS)}] AS w, value FROM events)
        SELECT event_id, CASE WHEN lower(trim(w)) IN ('true', 'yes', '1', 'y', 'on') THEN 'true'
          WHEN lower(trim(w)) IN ('false', 'no', '0', 'n', 'off') THEN 'false' END AS flag,
          value <> 0 AS number_flag FROM words""",
)
def _normalize_boolean(spark, sf_dir):
    words = F.array(*[F.lit(w) for w in BOOLEAN_WORDS])
    word = F.get(words, (F.col("event_id") % len(BOOLEAN_WORDS)).cast("int"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        normalize_boolean(word).cast("string").alias("flag"),
        normalize_boolean(F.col("value"), "double").alias("number_flag"),
    )


@query(
    "normalize_text",
    f"""SELECT doc_id, nullif(regexp_replace({S.strip('text')}, '{S.WS_CLASS}+', ' ', 'g'), '') AS clean,
          nullif(left(regexp_replace({S.strip('text')}, '{S.WS_CLASS}+', ' ', 'g'), 80), '') AS cut
        FROM documents""",
)
def _normalize_text(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", collapse_text(text).alias("clean"), collapse_text(text, 80).alias("cut")
    )


@query(
    "truncate_text",
    "SELECT doc_id, CASE WHEN length(text) <= 100 THEN text ELSE left(text, 97) || '...' END AS short FROM documents",
)
def _truncate_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", truncate(F.col("text"), 100).alias("short"))


@query(
    "content_hash",
    "SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5, sha1(text) AS sha1 FROM documents",
)
def _content_hash(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", *[content_hash(text, a).alias(a) for a in ("sha256", "md5", "sha1")]
    )


@query(
    "redact_text",
    """SELECT doc_id, CASE WHEN contains(lower(text), 'password') THEN '[REDACTED: password]'
         WHEN contains(lower(text), 'token') THEN '[REDACTED: token]'
         WHEN contains(lower(text), 'secret') THEN '[REDACTED: secret]'
         WHEN contains(lower(text), 'api_key') THEN '[REDACTED: api_key]'
         WHEN contains(lower(text), 'ssn') THEN '[REDACTED: ssn]'
         WHEN contains(lower(text), 'credit_card') THEN '[REDACTED: credit_card]'
         ELSE text END AS safe FROM documents""",
)
def _redact_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", redact(F.col("text")).alias("safe"))


@query(
    "normalize_header",
    """SELECT page_id, lower(regexp_replace(url, '[^\\p{L}\\p{N}_\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]', '', 'g')) AS header
       FROM pages""",
)
def _normalize_header(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", normalize_header(F.col("url")).alias("header"))


FEED_COLUMNS = [
    "Order_ID", "Order_Date", "Qty", "Unit_Price", "Total", "Customer_Email", "Product_Code",
    "Currency", "Order_Status", "Created_At", "Phone", "Expedited", "Shipping_Cost", "Discount",
    "Discount_Code",
]


@query(
    "normalize_rows",
    f"WITH {FEED_SQL} SELECT row_id, "
    + ", ".join(f"{S.strip_or_null(chr(34) + c + chr(34))} AS \"{c}\"" for c in FEED_COLUMNS)
    + " FROM feed",
)
def _normalize_rows(spark, sf_dir):
    return normalise_rows(vendor_feed(spark, sf_dir)).select("row_id", *FEED_COLUMNS)


@query(
    "normalize_ragged_rows",
    f"""SELECT doc_id, nullif(trim(lang, {S.WS_SQL}), '') AS lang, {S.strip_or_null('text')} AS text,
          CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS n_keys
        FROM documents""",
)
def _normalize_ragged_rows(spark, sf_dir):
    raw = F.when(
        F.col("lang") == "en", F.create_map(F.lit("lang"), F.col("lang"), F.lit("text"), F.col("text"))
    ).otherwise(F.create_map(F.lit("text"), F.col("text")))
    rows = normalise_map(table(spark, sf_dir, "documents").withColumn("raw", raw))
    return rows.select(
        "doc_id",
        F.coalesce(F.try_element_at("normalized", F.lit("lang")), F.col("lang")).alias("lang"),
        F.try_element_at("normalized", F.lit("text")).alias("text"),
        F.size("normalized").alias("n_keys"),
    )
