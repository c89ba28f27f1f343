"""SQL texts shared by the result statements of several queries."""

from __future__ import annotations

from rowmill.plans.feed import FEED_SQL

# Fixed value: white space, as an SQL expression for the set of characters.
WS_SQL = "(" + " || ".join(
    f"chr({n})"
    for n in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    )
) + ")"
WS_CLASS = r"[\t-\r\x1c-\x20\x85\p{Z}]"

TIME_RE = (
    r"(([01][0-9]|2[0-3])(:[0-5][0-9](:[0-5][0-9]([.,][0-9]+)?)?)?"
    r"|([01][0-9]|2[0-3])[0-5][0-9]([0-5][0-9]([.,][0-9]+)?)?)"
)
ISO_RE = rf"[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}((?s:.){TIME_RE}(Z|[+-]{TIME_RE})?)?"


def strip(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def strip_or_null(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def iso_ok(x: str) -> str:
    return f"coalesce(regexp_full_match({x}, '{ISO_RE}') AND TRY_CAST(left({x}, 10) AS DATE) IS NOT NULL, false)"


def date_text(x: str) -> str:
    s = strip(x)
    formats = (
        "'%Y-%m-%d', '%Y/%m/%d', '%d-%m-%Y', '%d/%m/%Y', '%m-%d-%Y', '%m/%d/%Y', '%Y%m%d', "
        "'%d.%m.%Y', '%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M:%S'"
    )
    return (
        f"CASE WHEN regexp_matches({s}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN left({s}, 10) "
        f"ELSE strftime(try_strptime({s}, [{formats}]), '%Y-%m-%d') END"
    )


def decimal_text(x: str) -> str:
    """For plain numbers: optional sign, digits, separators; no exponents."""
    s = strip(x)
    dots, commas = (f"(length({s}) - length(replace({s}, '{c}', '')))" for c in ".,")
    last_dot, last_comma = (f"instr(reverse({s}), '{c}')" for c in ".,")
    u = (
        f"CASE WHEN {dots} > 0 AND {commas} > 0 AND {last_dot} < {last_comma} THEN replace({s}, ',', '') "
        f"WHEN {dots} > 0 AND {commas} > 0 THEN replace(replace({s}, '.', ''), ',', '.') "
        f"WHEN {commas} > 1 THEN replace({s}, ',', '') "
        f"WHEN {dots} > 1 THEN replace({s}, '.', '') ELSE {s} END"
    )
    number = r"^([+-]?)([0-9]*)\.?([0-9]*)$"
    digits = f"regexp_extract({u}, '{number}', 2)"
    fraction = f"regexp_extract({u}, '{number}', 3)"
    return (
        f"CASE WHEN regexp_matches({u}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN "
        f"CASE WHEN left({u}, 1) = '-' THEN '-' ELSE '' END || "
        f"coalesce(nullif(ltrim({digits}, '0'), ''), '0') || "
        f"CASE WHEN {fraction} <> '' THEN '.' || {fraction} ELSE '' END END"
    )


def double(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({strip(x)}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') "
        f"THEN TRY_CAST({strip(x)} AS DOUBLE) END"
    )


# the feed trimmed, mapped and in normal form
MAPPED_SQL = FEED_SQL + f""",
trimmed AS (
  SELECT file_id, line_number, row_id,
         {strip_or_null('"Order_ID"')} AS order_id,
         {strip_or_null('"Customer_Email"')} AS customer_email,
         {strip_or_null('"Order_Date"')} AS order_date_text,
         {strip_or_null('"Qty"')} AS quantity,
         {strip_or_null('"Unit_Price"')} AS unit_price_text,
         {strip_or_null('"Total"')} AS total_amount_text,
         {strip_or_null('"Product_Code"')} AS product_code,
         {strip_or_null('"Currency"')} AS currency,
         {strip_or_null('"Order_Status"')} AS order_status,
         {strip_or_null('"Created_At"')} AS created_at,
         nullif(regexp_replace({strip_or_null('"Phone"')}, '[^0-9+]', '', 'g'), '') AS phone_number,
         lower({strip('"Expedited"')}) IN ('true', 'yes', '1', 'y', 'on') AS expedited,
         {strip_or_null('"Shipping_Cost"')} AS shipping_cost,
         {strip_or_null('"Discount"')} AS discount,
         {strip_or_null('"Discount_Code"')} AS discount_code
  FROM feed
),
mapped AS (
  SELECT *, {date_text('order_date_text')} AS order_date,
         {decimal_text('unit_price_text')} AS unit_price,
         {decimal_text('total_amount_text')} AS total_amount
  FROM trimmed
)"""


def _error(field: str | None, names: str | None, rule: str, message: str) -> str:
    f = "CAST(NULL AS VARCHAR)" if field is None else f"'{field}'"
    n = "CAST(NULL AS VARCHAR)" if names is None else f"'{names}'"
    return f"{{'field': {f}, 'fields': {n}, 'rule': '{rule}', 'message': '{message}'}}"


QTY_NUM = double("quantity")
CHECKS_SQL = [
    ("order_id IS NULL", _error("order_id", None, "required", "Order ID is required")),
    (
        f"order_date IS NOT NULL AND NOT {iso_ok('order_date')}",
        _error("order_date", None, "date_format", "Order date must be ISO8601 format (YYYY-MM-DD)"),
    ),
    (
        "NOT regexp_matches(coalesce(customer_email, 'None'), '^[^@]+@[^@]+\\.[^@]+$')",
        _error("customer_email", None, "type", "Customer email must be valid email format"),
    ),
    (
        "NOT coalesce(regexp_matches(quantity, '^[+-]?[0-9]+$'), false)",
        _error("quantity", None, "type", "Quantity must be an integer"),
    ),
    (
        f"quantity IS NULL OR {QTY_NUM} IS NULL OR {QTY_NUM} < 1 OR {QTY_NUM} > 999999",
        _error("quantity", None, "range", "Quantity must be between 1 and 999,999"),
    ),
    (
        f"unit_price IS NOT NULL AND ({double('unit_price')} < 0 OR {double('unit_price')} > 999999.99)",
        _error("unit_price", None, "range", "Unit price must be between 0 and 999,999.99"),
    ),
    (
        "upper(coalesce(currency, 'None')) NOT IN ('USD', 'EUR', 'GBP', 'JPY', 'CNY')",
        _error("currency", None, "enum", "Currency must be one of: USD, EUR, GBP, JPY, CNY"),
    ),
    (
        "upper(coalesce(order_status, 'None')) NOT IN ('PENDING', 'CONFIRMED', 'SHIPPED', 'DELIVERED', 'CANCELLED')",
        _error(
            "order_status",
            None,
            "enum",
            "Order status must be: pending, confirmed, shipped, delivered, cancelled",
        ),
    ),
    (
        "NOT regexp_matches(coalesce(product_code, 'None'), '^[A-Z]{3}-[0-9]{6}$')",
        _error("product_code", None, "regex", "Product code must match format: ABC-123456"),
    ),
    (
        "length(coalesce(phone_number, '')) < 10 OR length(coalesce(phone_number, '')) > 15",
        _error("phone_number", None, "length", "Phone number must be 10-15 digits"),
    ),
    (
        f"coalesce({QTY_NUM} * {double('unit_price')} <> {double('total_amount')}, false)",
        _error(
            None,
            "quantity,unit_price,total_amount",
            "formula",
            "Total amount must equal quantity × unit price",
        ),
    ),
    (
        "expedited AND shipping_cost IS NULL",
        _error(
            None,
            "expedited,shipping_cost",
            "dependency",
            "Shipping cost is required when expedited is true",
        ),
    ),
    (
        "discount IS NOT NULL AND discount_code IS NOT NULL",
        _error(
            None,
            "discount,discount_code",
            "mutual_exclusion",
            "Cannot apply both discount and discount code",
        ),
    ),
    (
        "coalesce(order_status NOT IN ('pending', 'confirmed'), true)",
        _error(
            "order_status",
            None,
            "status_transition",
            "Order can only transition from pending or confirmed status",
        ),
    ),
    (
        f"CASE WHEN {iso_ok('created_at')} THEN "
        "CASE WHEN length(created_at) = 10 THEN true ELSE "
        "CAST(substr(created_at, 12, 2) AS INTEGER) < 9 OR CAST(substr(created_at, 12, 2) AS INTEGER) >= 17 END "
        "ELSE false END",
        _error(
            "created_at",
            None,
            "business_hours",
            "Orders can only be placed during business hours (9 AM - 5 PM)",
        ),
    ),
]

# the feed with its list of errors and its status
CHECKED_SQL = (
    MAPPED_SQL
    + ",\nchecked AS (SELECT *, list_filter(["
    + ",\n".join(f"CASE WHEN {condition} THEN {error} END" for condition, error in CHECKS_SQL)
    + "], lambda e: e IS NOT NULL) AS errors FROM mapped),\n"
    + "validated AS (SELECT *, CASE WHEN len(errors) = 0 THEN 'valid' ELSE 'flagged' END AS status FROM checked),\n"
    + "exploded AS (SELECT row_id, line_number, file_id, unnest(errors, recursive := true) FROM validated)"
)
