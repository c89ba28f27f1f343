"""Vendor field to canonical field mapping."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.records import KINDS, META, PRESENT, Fields, as_column, both, column

# The sample vendor's field names and their canonical targets.
SAMPLE_MAPPING = {
    "Order_ID": "order_id",
    "Customer_Email": "customer_email",
    "Order_Date": "order_date",
    "Qty": "quantity",
    "Unit_Price": "unit_price",
    "Total": "total_amount",
}


@dataclass(frozen=True)
class MappingRule:
    """One vendor field to one canonical field.

    ``exact`` carries the value as it is; ``regex`` and ``substring`` map only texts
    that match; ``function`` applies a ``Column -> Column`` callable.
    """

    vendor_field: str
    canonical_field: str
    rule_type: str = "exact"
    pattern: str | None = None
    priority: int = 10
    confidence: float = 1.0
    function: Callable[[Column], Column] | None = None


def rules_from_dict(mappings: dict[str, str]) -> list[MappingRule]:
    """Exact rules from a ``{vendor field: canonical field}`` dict."""
    return [MappingRule(vendor, canonical) for vendor, canonical in mappings.items()]


def _condition(rule: MappingRule, fields: Fields) -> Column | bool:
    """When the rule maps."""
    has = fields.has(rule.vendor_field)
    if has is False or rule.rule_type == "exact":
        return has
    if rule.rule_type == "function":
        return has if rule.function is not None else False
    if fields.dtype(rule.vendor_field) != "string":
        return False
    value = fields.value(rule.vendor_field)
    if rule.rule_type == "regex":
        return both(has, F.coalesce(value.rlike(rule.pattern), F.lit(False)))
    if rule.rule_type == "substring":
        return both(has, F.coalesce(F.contains(value, F.lit(rule.pattern)), F.lit(False)))
    return False


def _ordered(rules: list[MappingRule], win: str) -> list[MappingRule]:
    """Rules from the strongest to the weakest.

    Rules run in ascending priority (a stable sort) and a later rule overwrites, so
    by default the last one wins; ``win='first'`` makes the lowest number win.
    """
    if win not in ("last", "first"):
        raise ValueError(f"win must be 'last' or 'first', not {win!r}")
    ascending = sorted(rules, key=lambda r: r.priority)
    return ascending if win == "first" else ascending[::-1]


def _carried(rule: MappingRule, fields: Fields) -> Column:
    value = fields.value(rule.vendor_field)
    return rule.function(value) if rule.rule_type == "function" else value


def _kind(rule: MappingRule, fields: Fields) -> Column:
    """A function's result is a text."""
    kind = None if rule.rule_type == "function" else fields.kind(rule.vendor_field)
    return F.lit(None).cast("string") if kind is None else kind


def map_fields(
    df: DataFrame,
    rules: list[MappingRule],
    fields: Fields | None = None,
    keep: list[str] | None = None,
    win: str = "last",
) -> DataFrame:
    """Project a record onto the canonical fields its rules name.

    Adds ``mapping_confidence``, ``_present`` when presence differs per row, and ``kinds``
    when the record has kinds of values. One
    ``select``; no shuffle. A target that no row can get is left out.
    """
    fields = fields or Fields.flat(df)
    targets: dict[str, list[tuple[Column | bool, MappingRule]]] = {}
    for rule in _ordered(rules, win):
        condition = _condition(rule, fields)
        if condition is False:
            continue
        options = targets.setdefault(rule.canonical_field, [])
        if not any(c is True for c, _ in options):
            options.append((condition, rule))

    values, scores, presence, kinds = [], [], {}, []
    for name in dict.fromkeys(r.canonical_field for r in sorted(rules, key=lambda r: r.priority)):
        if name not in targets:
            continue
        value = score = kind = None
        for condition, rule in targets[name]:
            carried, weight, sort = _carried(rule, fields), F.lit(float(rule.confidence)), _kind(rule, fields)
            if condition is True and value is None:
                value, score, kind = carried, weight, sort
                break
            test = as_column(condition)
            value = F.when(test, carried) if value is None else value.when(test, carried)
            score = F.when(test, weight) if score is None else score.when(test, weight)
            kind = F.when(test, sort) if kind is None else kind.when(test, sort)
        kinds.append(kind)
        conditions = [c for c, _ in targets[name]]
        presence[name] = True if any(c is True for c in conditions) else F.greatest(
            *map(as_column, conditions), F.lit(False)
        )
        values.append(value.alias(name))
        scores.append((name, score))

    if keep is None:
        keep = [c for c in df.columns if c in META and c not in (PRESENT, KINDS, "mapping_confidence")]
    names = F.array(*[F.lit(n) for n, _ in scores]).cast("array<string>")
    confidence = F.map_from_arrays(names, F.array(*[s for _, s in scores]).cast("array<double>"))
    extra = []
    if any(p is not True for p in presence.values()):
        marks = [F.lit(n) if p is True else F.when(p, F.lit(n)) for n, p in presence.items()]
        extra.append(F.array_compact(F.array(*marks)).alias(PRESENT))
        confidence = F.map_filter(confidence, lambda _, v: v.isNotNull())
    if fields.kinds_column is not None:
        every = F.map_from_arrays(names, F.array(*kinds).cast("array<string>"))
        extra.append(F.map_filter(every, lambda _, k: k.isNotNull()).alias(KINDS))
    return df.select(
        *[column(k) for k in keep], *values, confidence.alias("mapping_confidence"), *extra
    )


def unmapped_fields(
    df: DataFrame, rules: list[MappingRule], fields: Fields | None = None
) -> DataFrame:
    """Source fields that at least one row had and no rule used, one per row."""
    fields = fields or Fields.flat(df)
    used = F.array_compact(
        F.array(
            *[
                F.when(as_column(_condition(r, fields)), F.lit(r.vendor_field))
                for r in rules
                if r.rule_type != "function" or r.function is not None
            ],
            F.lit(None).cast("string"),
        )
    )
    left = F.array_except(fields.present_names(), used)
    return df.select(F.explode(left).alias("field")).distinct()


def canonical_map(df: DataFrame, names: list[str] | None = None) -> Column:
    """The canonical fields of a flat record as ``map<string,string>``, absent ones left out."""
    fields = Fields.flat(df, names)
    parts: list[Any] = []
    for name in fields.types:
        parts += [F.lit(name), fields.text(name)]
    whole = F.create_map(*parts).cast("map<string,string>")
    if fields.present_column is None:
        return whole
    return F.map_filter(whole, lambda k, _: F.array_contains(F.col(PRESENT), k))
