"""A stand-in vendor feed over the star-schema test tables.

Line items joined to their order and part, written as text with dirt that depends
only on keys, so that any engine produces the same feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.text import normalize_boolean, normalize_phone
from rowmill.operators.mapping import SAMPLE_MAPPING, map_fields, rules_from_dict
from rowmill.operators.normalize import normalise_dates, normalise_decimals, normalise_rows
from rowmill.operators.validate import SAMPLE_RULES, validate
from rowmill.session import tune

FEED_MAPPING = {
    **SAMPLE_MAPPING,
    "Product_Code": "product_code",
    "Currency": "currency",
    "Order_Status": "order_status",
    "Created_At": "created_at",
    "Phone": "phone_number",
    "Expedited": "expedited",
    "Shipping_Cost": "shipping_cost",
    "Discount": "discount",
    "Discount_Code": "discount_code",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def money(cents: Column, style: Column) -> Column:
    """Cents as text: plain, grouped US style, grouped EU style, bare decimal comma."""
    whole = F.floor(cents / 100).cast("bigint")
    part = F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0")
    thousands = F.floor(whole / 1000).cast("bigint")
    rest = F.lpad(F.pmod(whole, F.lit(1000)).cast("string"), 3, "0")

    def grouped(mark: str) -> Column:
        return F.when(whole >= 1000, F.concat(thousands.cast("string"), F.lit(mark), rest)).otherwise(
            whole.cast("string")
        )

    return (
        F.when(style == 0, F.concat(whole.cast("string"), F.lit("."), part))
        .when(style == 1, F.concat(grouped(","), F.lit("."), part))
        .when(style == 2, F.concat(grouped("."), F.lit(","), part))
        .otherwise(F.concat(whole.cast("string"), F.lit(","), part))
    )


def vendor_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as dirty vendor rows with a row identity."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    k = F.col("l_orderkey")
    key, cust = k.cast("string"), F.col("o_custkey").cast("string")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    clock = F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":15:00"))
    qty = F.col("l_quantity").cast("bigint")
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    total = F.when(k % 13 == 0, F.round(F.col("l_extendedprice") * 100).cast("bigint")).otherwise(
        qty * cents
    )
    file_id = F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string"))
    line = k * 10 + F.col("l_linenumber")
    return joined.select(
        file_id.alias("file_id"),
        line.alias("line_number"),
        F.concat_ws("_", file_id, line.cast("string"), F.col("l_partkey").cast("string")).alias("row_id"),
        F.when(k % 97 == 0, "  ")
        .when(k % 7 == 0, F.concat(F.lit(" "), key, F.lit("\t")))
        .otherwise(key)
        .alias("Order_ID"),
        F.when(k % 6 == 0, iso)
        .when(k % 6 == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(k % 6 == 2, F.date_format("o_orderdate", "yyyyMMdd"))
        .when(k % 6 == 3, F.date_format("o_orderdate", "dd.MM.yyyy"))
        .when(k % 6 == 4, F.concat(iso, F.lit(" 10:30:00")))
        .otherwise("soon")
        .alias("Order_Date"),
        F.when(k % 41 == 0, "abc").when(k % 53 == 0, "-1").otherwise(qty.cast("string")).alias("Qty"),
        money(cents, k % 4).alias("Unit_Price"),
        money(total, k % 4).alias("Total"),
        F.concat(
            F.lit("User"), cust, F.when(k % 11 == 0, "").otherwise("@"), F.lit("Example.COM")
        ).alias("Customer_Email"),
        F.concat(
            F.when(k % 19 == 0, "ab").otherwise("ABC"),
            F.lit("-"),
            F.lpad((F.col("l_partkey") % 1000000).cast("string"), 6, "0"),
        ).alias("Product_Code"),
        F.when(k % 5 == 0, "USD")
        .when(k % 5 == 1, "eur")
        .when(k % 5 == 2, "GBP")
        .when(k % 5 == 3, "JPY")
        .otherwise("XXX")
        .alias("Currency"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("Pending")
        .alias("Order_Status"),
        F.when(k % 4 == 0, F.concat(iso, F.lit("T"), clock))
        .when(k % 4 == 1, F.concat(iso, F.lit(" "), clock, F.lit("+05:00")))
        .when(k % 4 == 2, iso)
        .otherwise(F.concat(iso, F.lit("T"), clock, F.lit("Z")))
        .alias("Created_At"),
        F.when(k % 9 == 0, "12-34")
        .otherwise(F.concat(F.lit("+1 (555) "), F.lpad((F.col("o_custkey") % 10000000).cast("string"), 7, "0")))
        .alias("Phone"),
        F.when(k % 3 == 0, "Yes").otherwise("no").alias("Expedited"),
        F.when(k % 6 == 0, "").otherwise("5.00").alias("Shipping_Cost"),
        F.when(k % 4 == 0, "10").otherwise("").alias("Discount"),
        F.when(k % 8 == 0, "SAVE").otherwise(" ").alias("Discount_Code"),
    )


FEED_SQL = """
feed_base AS (
  SELECT *, l_orderkey AS k, CAST(l_quantity AS BIGINT) AS qty,
         CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
         strftime(o_orderdate, '%Y-%m-%d') AS iso,
         lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':15:00' AS clock
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
feed_total AS (
  SELECT *, CASE WHEN k % 13 = 0 THEN CAST(round(l_extendedprice * 100) AS BIGINT)
                 ELSE qty * cents END AS total_cents
  FROM feed_base
),
feed AS (
  SELECT 'supplier-' || l_suppkey AS file_id,
         k * 10 + l_linenumber AS line_number,
         'supplier-' || l_suppkey || '_' || (k * 10 + l_linenumber) || '_' || l_partkey AS row_id,
         CASE WHEN k % 97 = 0 THEN '  ' WHEN k % 7 = 0 THEN ' ' || k || chr(9) ELSE CAST(k AS VARCHAR) END AS "Order_ID",
         CASE k % 6 WHEN 0 THEN iso WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
                    WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') WHEN 3 THEN strftime(o_orderdate, '%d.%m.%Y')
                    WHEN 4 THEN iso || ' 10:30:00' ELSE 'soon' END AS "Order_Date",
         CASE WHEN k % 41 = 0 THEN 'abc' WHEN k % 53 = 0 THEN '-1' ELSE CAST(qty AS VARCHAR) END AS "Qty",
         {unit_price} AS "Unit_Price",
         {total} AS "Total",
         'User' || o_custkey || CASE WHEN k % 11 = 0 THEN '' ELSE '@' END || 'Example.COM' AS "Customer_Email",
         CASE WHEN k % 19 = 0 THEN 'ab' ELSE 'ABC' END || '-' || lpad(CAST(l_partkey % 1000000 AS VARCHAR), 6, '0') AS "Product_Code",
         CASE k % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'eur' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' ELSE 'XXX' END AS "Currency",
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'pending' ELSE 'Pending' END AS "Order_Status",
         CASE k % 4 WHEN 0 THEN iso || 'T' || clock WHEN 1 THEN iso || ' ' || clock || '+05:00'
                    WHEN 2 THEN iso ELSE iso || 'T' || clock || 'Z' END AS "Created_At",
         CASE WHEN k % 9 = 0 THEN '12-34'
              ELSE '+1 (555) ' || lpad(CAST(o_custkey % 10000000 AS VARCHAR), 7, '0') END AS "Phone",
         CASE WHEN k % 3 = 0 THEN 'Yes' ELSE 'no' END AS "Expedited",
         CASE WHEN k % 6 = 0 THEN '' ELSE '5.00' END AS "Shipping_Cost",
         CASE WHEN k % 4 = 0 THEN '10' ELSE '' END AS "Discount",
         CASE WHEN k % 8 = 0 THEN 'SAVE' ELSE ' ' END AS "Discount_Code"
  FROM feed_total
)"""


def _money_sql(cents: str) -> str:
    part = f"lpad(CAST({cents} % 100 AS VARCHAR), 2, '0')"
    whole = f"({cents} // 100)"

    def grouped(mark: str) -> str:
        return (
            f"CASE WHEN {whole} >= 1000 THEN ({whole} // 1000) || '{mark}' || "
            f"lpad(CAST({whole} % 1000 AS VARCHAR), 3, '0') ELSE CAST({whole} AS VARCHAR) END"
        )

    return (
        f"CASE k % 4 WHEN 0 THEN {whole} || '.' || {part} "
        f"WHEN 1 THEN ({grouped(',')}) || '.' || {part} "
        f"WHEN 2 THEN ({grouped('.')}) || ',' || {part} "
        f"ELSE {whole} || ',' || {part} END"
    )


FEED_SQL = FEED_SQL.format(unit_price=_money_sql("cents"), total=_money_sql("total_cents"))


def mapped_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimmed and mapped to canonical fields; dates, amounts and flags in normal form."""
    mapped = map_fields(normalise_rows(vendor_feed(spark, sf_dir)), rules_from_dict(FEED_MAPPING))
    dated = normalise_decimals(normalise_dates(mapped, ["order_date"]), ["unit_price", "total_amount"])
    return dated.withColumns(
        {
            "phone_number": normalize_phone(F.col("phone_number")),
            "expedited": normalize_boolean(F.col("expedited")),
        }
    )


def validated_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed through all three rule layers of the sample vendor."""
    return validate(mapped_feed(spark, sf_dir), SAMPLE_RULES)
