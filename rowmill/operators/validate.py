"""Validation: rules given as plain dicts, compiled to one error array per row.

Every rule becomes ``when(fails, error)``; nothing is evaluated outside the one
expression, so validation is a single projection without a shuffle.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.dates import is_iso_moment, iso_hour
from rowmill.functions.numbers import decimal_exact, is_decimal_text, is_integer_text
from rowmill.functions.text import strip
from rowmill.operators.formula import Value, compile_formula
from rowmill.operators.joins import lookup
from rowmill.records import NO_ERRORS, Fields, as_column, both, column

# The sample vendor's rules.
SAMPLE_RULES: dict[str, list[dict[str, Any]]] = {
    "field_validation_rules": [
        {"field": "order_id", "rule_type": "required", "message": "Order ID is required"},
        {
            "field": "order_date",
            "rule_type": "date_format",
            "message": "Order date must be ISO8601 format (YYYY-MM-DD)",
        },
        {
            "field": "customer_email",
            "rule_type": "type",
            "expected_type": "email",
            "message": "Customer email must be valid email format",
        },
        {
            "field": "quantity",
            "rule_type": "type",
            "expected_type": "integer",
            "message": "Quantity must be an integer",
        },
        {
            "field": "quantity",
            "rule_type": "range",
            "min_value": 1,
            "max_value": 999999,
            "message": "Quantity must be between 1 and 999,999",
        },
        {
            "field": "unit_price",
            "rule_type": "range",
            "min_value": 0,
            "max_value": 999999.99,
            "message": "Unit price must be between 0 and 999,999.99",
        },
        {
            "field": "currency",
            "rule_type": "enum",
            "values": ["USD", "EUR", "GBP", "JPY", "CNY"],
            "message": "Currency must be one of: USD, EUR, GBP, JPY, CNY",
        },
        {
            "field": "order_status",
            "rule_type": "enum",
            "values": ["pending", "confirmed", "shipped", "delivered", "cancelled"],
            "message": "Order status must be: pending, confirmed, shipped, delivered, cancelled",
        },
        {
            "field": "product_code",
            "rule_type": "regex",
            "pattern": r"^[A-Z]{3}-\d{6}$",
            "message": "Product code must match format: ABC-123456",
        },
        {
            "field": "phone_number",
            "rule_type": "length",
            "min_length": 10,
            "max_length": 15,
            "message": "Phone number must be 10-15 digits",
        },
    ],
    "cross_field_rules": [
        {
            "fields": ["quantity", "unit_price", "total_amount"],
            "rule_type": "formula",
            "formula": "quantity * unit_price == total_amount",
            "message": "Total amount must equal quantity × unit price",
        },
        {
            "fields": ["expedited", "shipping_cost"],
            "rule_type": "dependency",
            "condition_field": "expedited",
            "condition_value": True,
            "required_field": "shipping_cost",
            "message": "Shipping cost is required when expedited is true",
        },
        {
            "fields": ["discount", "discount_code"],
            "rule_type": "mutual_exclusion",
            "message": "Cannot apply both discount and discount code",
        },
    ],
    "semantic_rules": [
        {
            "rule_type": "status_transition",
            "allowed_from": ["pending", "confirmed"],
            "message": "Order can only transition from pending or confirmed status",
        },
        {
            "rule_type": "business_hours",
            "message": "Orders can only be placed during business hours (9 AM - 5 PM)",
        },
        {"rule_type": "inventory", "message": "Insufficient inventory for this product"},
    ],
}

Condition = Column | bool
FieldCheck = Callable[[Fields, str, dict[str, Any]], Condition]

# Fixed value: the loose address test of the ``type`` rule.
LOOSE_EMAIL = r"^[^@]+@[^@]+\.[^@]+$"


def _printed(fields: Fields, name: str) -> Column:
    """The text that text tests see; a null value is the word None."""
    return F.coalesce(fields.text(name), F.lit("None"))


def _not_true(c: Column) -> Column:
    return ~F.coalesce(c, F.lit(False))


def fails_required(fields: Fields, name: str, rule: dict[str, Any]) -> Condition:
    value = fields.value(name)
    if fields.dtype(name) != "string":
        return value.isNull()
    return value.isNull() | (strip(value) == "")


def fails_type(fields: Fields, name: str, rule: dict[str, Any]) -> Condition:
    expected, dtype, value = rule.get("expected_type"), fields.dtype(name), fields.value(name)
    numeric = dtype.startswith(("tinyint", "smallint", "int", "bigint", "decimal", "boolean"))
    floating = dtype in ("double", "float")
    if expected == "integer":
        if numeric:
            return value.isNull()
        if floating:
            return _not_true(~F.isnan(value) & (F.abs(value) != float("inf")))
        return ~is_integer_text(value)
    if expected == "decimal":
        return value.isNull() if numeric or floating else ~is_decimal_text(value)
    if expected == "date":
        if dtype in ("date", "timestamp", "timestamp_ntz"):
            return value.isNull()
        return ~is_iso_moment(fields.text(name))
    if expected == "email":
        return ~_printed(fields, name).rlike(LOOSE_EMAIL)
    return False


def fails_range(fields: Fields, name: str, rule: dict[str, Any]) -> Condition:
    """Out of the inclusive bounds, or no number. Null counts as zero.

    Compared as doubles; only a tie with the bound needs the exact decimal.
    """
    low, high = rule.get("min_value"), rule.get("max_value")
    value, dtype, double = fields.value(name), fields.dtype(name), fields.amount(name)
    if dtype == "string":
        exact = decimal_exact(value)
    else:
        exact = double if dtype in ("double", "float") else value.cast("decimal(38,18)")
    fails = double.isNull()
    if low is not None or high is not None:
        fails = fails | F.isnan(double)
    if low is not None:
        fails = fails | (double < float(low)) | _tied(double, exact, low, "<")
    if high is not None:
        fails = fails | (double > float(high)) | _tied(double, exact, high, ">")
    zero_fails = (low is not None and float(low) > 0) or (high is not None and float(high) < 0)
    return F.when(value.isNull(), F.lit(zero_fails)).otherwise(fails)


def _tied(double: Column, exact: Column, bound: Any, op: str) -> Column:
    limit = F.lit(str(bound)).try_cast("decimal(38,18)")
    beyond = exact < limit if op == "<" else exact > limit
    return (double == float(bound)) & F.coalesce(beyond, F.lit(False))


def fails_enum(fields: Fields, name: str, rule: dict[str, Any]) -> Condition:
    allowed = sorted({str(v).upper() for v in rule.get("values", [])})
    if not allowed:
        return True
    # usual spellings first: upper-casing takes longer than all the rest
    usual = sorted({f(w) for w in allowed for f in (str, str.lower, str.title) if w.isascii()} | set(allowed))
    return ~(_printed(fields, name).isin(*usual) | F.upper(_printed(fields, name)).isin(*allowed))


def fails_regex(fields: Fields, name: str, rule: dict[str, Any]) -> Condition:
    """The pattern must match at the start; it need not reach the end."""
    pattern = rule.get("pattern")
    if not pattern:
        return False
    return ~_printed(fields, name).rlike(rf"\A(?:{pattern})")


def fails_length(fields: Fields, name: str, rule: dict[str, Any]) -> Condition:
    size = F.length(F.coalesce(fields.text(name), F.lit("")))
    fails = size < rule.get("min_length", 0)
    if rule.get("max_length") is not None:
        fails = fails | (size > rule["max_length"])
    return fails


def fails_date_format(fields: Fields, name: str, rule: dict[str, Any]) -> Condition:
    value = fields.value(name)
    if fields.dtype(name) in ("date", "timestamp", "timestamp_ntz"):
        return False
    return value.isNotNull() & ~is_iso_moment(fields.text(name))


FIELD_CHECKS: dict[str, FieldCheck] = {
    "required": fails_required,
    "type": fails_type,
    "range": fails_range,
    "enum": fails_enum,
    "regex": fails_regex,
    "length": fails_length,
    "date_format": fails_date_format,
}


def register_check(rule_type: str, check: FieldCheck) -> None:
    """Add a field rule type: a function of (fields, name, rule) to "fails"."""
    FIELD_CHECKS[rule_type] = check


def fails_formula(fields: Fields, rule: dict[str, Any]) -> Condition:
    """A formula over the rule's fields must not be false, zero or an empty text.

    A missing value, or an expression that cannot be evaluated, passes.
    """

    def value(name: str) -> Value:
        number, dtype = fields.number(name), fields.dtype(name)
        if dtype == "string":
            text = fields.value(name)
            return Value(number=number, text=F.when(number.isNull(), text))
        if dtype in ("date", "timestamp", "timestamp_ntz") or dtype.startswith(("array", "map", "struct")):
            return Value(text=fields.text(name))
        return Value(number=number)

    formula = rule.get("formula", "")
    try:
        result = compile_formula(formula, {n: value(n) for n in rule["fields"] if fields.knows(n)})
    except (SyntaxError, ValueError) as problem:
        warnings.warn(f"formula {formula!r} cannot be evaluated and passes: {problem}", stacklevel=2)
        return False
    return ~F.coalesce(result.truth(), F.lit(True))


def fails_dependency(fields: Fields, rule: dict[str, Any]) -> Condition:
    """The condition field has the value, typed, and the required field is not set."""
    name, wanted = rule.get("condition_field"), rule.get("condition_value")
    if not fields.knows(name):
        met: Condition = wanted is None
    else:
        dtype, value, kind = fields.dtype(name), fields.value(name), fields.kind(name)
        if wanted is None:
            met = value.isNull()
        elif isinstance(wanted, str):
            met = value.eqNullSafe(F.lit(wanted)) if dtype == "string" else False
            met = met if kind is None else met & kind.isNull()
        elif kind is not None:
            met = F.coalesce(kind.isin("number", "boolean") & (fields.number(name) == float(wanted)), F.lit(False))
        elif dtype == "string":
            met = False
        else:
            met = value.cast("double").eqNullSafe(F.lit(float(wanted)))
    set_ = fields.truthy(rule.get("required_field"))
    return both(met, (not set_) if isinstance(set_, bool) else ~set_)


def fails_mutual_exclusion(fields: Fields, rule: dict[str, Any]) -> Condition:
    flags = [as_column(fields.truthy(n)).cast("int") for n in rule["fields"]]
    return sum(flags[1:], flags[0]) > 1 if len(flags) > 1 else False


CROSS_CHECKS = {
    "formula": fails_formula,
    "dependency": fails_dependency,
    "mutual_exclusion": fails_mutual_exclusion,
}


def fails_status_transition(fields: Fields, rule: dict[str, Any]) -> Condition:
    allowed = rule.get("allowed_from", [])
    if not fields.knows("order_status"):
        return None not in allowed
    value, words = fields.text("order_status"), [a for a in allowed if isinstance(a, str)]
    found = F.coalesce(value.isin(*words), F.lit(False)) if words else F.lit(False)
    return ~((found | value.isNull()) if None in allowed else found)


def fails_business_hours(fields: Fields, rule: dict[str, Any]) -> Condition:
    """The hour as written is before 9 or from 17 on; no or unreadable moment passes."""
    if not fields.knows("created_at"):
        return False
    if fields.dtype("created_at") in ("timestamp", "timestamp_ntz", "date"):
        hour = F.hour(fields.value("created_at"))
    else:
        hour = iso_hour(fields.text("created_at"))
    return F.coalesce(~hour.isin(*range(9, 17)), F.lit(False))


def fails_inventory(fields: Fields, rule: dict[str, Any]) -> Condition:
    """More is ordered than is in stock, as the field named by ``stock_field`` says; see
    ``with_stock``. A rule that names none knows of no stock and passes, as does a quantity
    that is no number. Nothing in stock is none."""
    stock = rule.get("stock_field")
    if stock is None or not fields.knows("quantity"):
        return False
    on_hand = F.coalesce(fields.number(stock), F.lit(0.0)) if fields.knows(stock) else F.lit(0.0)
    return F.coalesce(fields.number("quantity") > on_hand, F.lit(False))


def with_stock(rows: DataFrame, stock: DataFrame, on: list[str], quantity: str = "on_hand") -> DataFrame:
    """Rows with the stock of what they order, null where there is none. Stock has one row a
    key; the tasks of a key that many rows order are split."""
    return lookup(rows, stock.select(*on, quantity), on, "left")


SEMANTIC_CHECKS: dict[str, tuple[str | None, Callable[..., Condition]]] = {
    "status_transition": ("order_status", fails_status_transition),
    "business_hours": ("created_at", fails_business_hours),
    "inventory": ("quantity", fails_inventory),
}


class Compiled(NamedTuple):
    """A rule of the compiled set: when it fails, the error it then adds, its type and field."""

    condition: Condition
    error: Column
    rule: tuple[str, str | None]


def _compiled(condition: Condition, field: str | None, names: list[str] | None, rule: str, message: str) -> Compiled:
    error = F.struct(
        F.lit(field).cast("string").alias("field"),
        F.lit(",".join(names) if names else None).cast("string").alias("fields"),
        F.lit(rule).alias("rule"),
        F.lit(message).alias("message"),
    )
    return Compiled(condition, error, (rule, field))


def field_errors(fields: Fields, rules: list[dict[str, Any]]) -> list[Compiled]:
    out = []
    for rule in rules:
        name, kind = rule["field"], rule["rule_type"]
        test = FIELD_CHECKS.get(kind)
        if test is None:
            warnings.warn(f"unknown rule type {kind!r} passes", stacklevel=2)
            continue
        if not fields.knows(name):
            continue
        condition = both(fields.has(name), test(fields, name, rule))
        if condition is False:
            continue
        message = rule.get("message", f"{name} failed {kind}")
        out.append(_compiled(condition, name, None, kind, message))
    return out


def cross_errors(fields: Fields, rules: list[dict[str, Any]]) -> list[Compiled]:
    out = []
    for rule in rules:
        test = CROSS_CHECKS.get(rule["rule_type"])
        condition = test(fields, rule) if test else False
        if condition is False:
            continue
        names = list(rule["fields"])
        if rule["rule_type"] == "dependency":
            names = [rule["condition_field"], rule["required_field"]]
        message = rule.get("message", "Cross-field rule failed")
        out.append(_compiled(condition, None, names, rule["rule_type"], message))
    return out


def semantic_errors(fields: Fields, rules: list[dict[str, Any]]) -> list[Compiled]:
    out = []
    for rule in rules:
        name, test = SEMANTIC_CHECKS.get(rule["rule_type"], (None, None))
        condition = test(fields, rule) if test else False
        if condition is False:
            continue
        message = rule.get("message", "Semantic validation failed")
        out.append(_compiled(condition, name, None, rule["rule_type"], message))
    return out


@dataclass(frozen=True)
class Checked:
    """Rows with their rule outcomes as bit masks, and what each bit stands for."""

    work: DataFrame
    columns: list[str]
    errors: list[Compiled]
    masks: dict[str, Column]
    found: Column
    rules: list[tuple[str, str | None]]  # rule type and field of each error

    def with_masks(self) -> DataFrame:
        """The data columns and the masks.

        The masks pass through a generator of one row: the optimizer does not copy their
        conditions into filters on status or errors above, and still takes filters on data
        columns down to the scan. They are made by a projection below it, since a generator's
        own expressions are interpreted where a stage is too large for generated code.
        """
        masks = F.struct(*[m.alias(n) for n, m in self.masks.items()]) if self.masks else F.struct(F.lit(0).alias("none"))
        made = self.work.select(*[column(c) for c in self.columns], masks.alias(MASKS))
        out = made.select(*[column(c) for c in self.columns], F.explode(F.array(MASKS)).alias(FAILED))
        return out.select(*[column(c) for c in self.columns], *[F.col(f"{FAILED}.{n}").alias(n) for n in self.masks])


def check(df: DataFrame, rules: dict[str, list[dict[str, Any]]], fields: Fields | None = None) -> Checked:
    """Compile a rule set over a frame; nothing is evaluated yet."""
    fields = fields or Fields.flat(df)
    columns = [c for c in df.columns if c not in ("validation_errors", "status")]
    checks = rules.get("field_validation_rules", [])
    cross = rules.get("cross_field_rules", [])
    semantic = rules.get("semantic_rules", [])
    work, ready = fields.staged(
        df,
        values=_named(checks, cross, semantic),
        numbers={n for r in cross if r["rule_type"] == "formula" for n in r["fields"]},
        amounts={r["field"] for r in checks if r["rule_type"] == "range"},
    )
    errors = [*field_errors(ready, checks), *cross_errors(ready, cross), *semantic_errors(ready, semantic)]
    masks, found = _failed(errors)
    return Checked(work, columns, errors, masks, found, [e.rule for e in errors])


def validate(
    df: DataFrame,
    rules: dict[str, list[dict[str, Any]]],
    fields: Fields | None = None,
) -> DataFrame:
    """Add ``validation_errors`` and ``status`` (valid iff there is no error).

    Errors come in rule order: field rules, then cross-field, then semantic ones.
    Earlier errors of the row are replaced.
    """
    checked = check(df, rules, fields)
    clean = F.lit(True)
    for name in checked.masks:
        clean = clean & (F.col(name) == 0)
    return checked.with_masks().select(
        *[column(c) for c in checked.columns],
        F.when(clean, F.array().cast(NO_ERRORS)).otherwise(checked.found).alias("validation_errors"),
        F.when(clean, "valid").otherwise("flagged").alias("status"),
    )


def error_counts(
    df: DataFrame, rules: dict[str, list[dict[str, Any]]], fields: Fields | None = None
) -> DataFrame:
    """Rows that fail each rule: (rule, field, errors), counted from the masks in one
    aggregate without building an error. A rule over several fields has the field null."""
    checked = check(df, rules, fields)
    failed = [
        F.count_if(F.getbit(F.col(name), F.lit(bit)) == 1).alias(f"n{start + bit}")
        for start, name in zip(range(0, len(checked.errors), MASK_BITS), checked.masks)
        for bit in range(min(MASK_BITS, len(checked.errors) - start))
    ]
    empty = "array<struct<rule: string, field: string, errors: bigint>>"
    named = [
        F.struct(F.lit(rule).alias("rule"), F.lit(field).cast("string").alias("field"), F.col(f"n{i}").alias("errors"))
        for i, (rule, field) in enumerate(checked.rules)
    ]
    counted = checked.with_masks().agg(F.lit(1).alias("one"), *failed)
    return counted.select(F.explode(F.array(*named).cast(empty)).alias("r")).select("r.*").where("errors > 0")


FAILED = "__failed"
MASKS = "__masks"

# rules whose outcomes share one long
MASK_BITS = 62


def _failed(errors: list[Compiled]) -> tuple[dict[str, Column], Column]:
    """Which rules fail, as bit masks, and the error array those masks stand for.

    Only the masks need the record, so all conditions stay in generated code; a report
    that needs no messages never builds them; a clean row costs one comparison.
    """
    masks, arrays = {}, []
    for start in range(0, len(errors), MASK_BITS):
        part, name = errors[start : start + MASK_BITS], f"__failed_{start}"
        mask = F.lit(0).cast("bigint")
        for bit, (condition, *_) in enumerate(part):
            mask = mask.bitwiseOR(F.when(as_column(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint"))
        masks[name] = mask
        known = F.array(*[e.error for e in part]).cast(NO_ERRORS)
        arrays.append(F.filter(known, _bit_test(name)))
    if not arrays:
        return masks, F.array().cast(NO_ERRORS)
    return masks, arrays[0] if len(arrays) == 1 else F.concat(*arrays)


def _bit_test(name: str) -> Callable[[Column, Column], Column]:
    return lambda _, at: F.getbit(F.col(name), at) == 1


def _named(*rule_lists: list[dict[str, Any]]) -> set[str]:
    """All fields that rules look at."""
    names: set[str] = {"order_status", "created_at"} if rule_lists[-1] else set()
    for rule in (r for rules in rule_lists for r in rules):
        names |= {rule[k] for k in ("field", "condition_field", "required_field") if rule.get(k)}
        names |= set(rule.get("fields", []))
    return names
