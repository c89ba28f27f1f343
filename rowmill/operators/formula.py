"""Formulas over a record's fields, compiled to Columns.

A formula is an expression in Python's syntax. A field is a number if its text reads as one
and a text otherwise; a missing field is unknown. The result follows Python's rules: unequal
kinds are never equal, ``and`` / ``or`` stop early, comparisons chain, ``//`` and ``%`` round
down. Whatever would raise an error there (an unknown name that is reached, a zero divisor, a
number ordered against a text) makes the whole formula unknown.
"""

from __future__ import annotations

import ast
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowmill.functions.text import strip


@dataclass(frozen=True)
class Value:
    """A number, a text or a truth value; at most one of them is not null in any row, and
    none is where it is unknown. A part that no row can have is None."""

    number: Column | None = None
    text: Column | None = None
    flag: Column | None = None

    def numeric(self) -> Column | None:
        """As a number; a truth value counts 1 or 0."""
        asked = [c for c in (self.number, None if self.flag is None else self.flag.cast("double")) if c is not None]
        return F.coalesce(*asked) if asked else None

    def known(self) -> Column:
        parts = [c.isNotNull() for c in (self.number, self.text, self.flag) if c is not None]
        return reduce(Column.__or__, parts) if parts else F.lit(False)

    def truth(self) -> Column:
        """Whether it counts as true; null where unknown."""
        parts = [self.flag, None if self.number is None else self.number != 0, None if self.text is None else self.text != ""]
        asked = [c for c in parts if c is not None]
        return F.coalesce(*asked) if asked else F.lit(None).cast("boolean")

    def where(self, condition: Column, other: Value) -> Value:
        """This value where the condition holds, the other where it does not, else unknown."""

        def choose(a: Column | None, b: Column | None) -> Column | None:
            if a is None and b is None:
                return None
            out = F.when(condition, F.lit(None) if a is None else a)
            return out.when(~condition, F.lit(None) if b is None else b)

        return Value(choose(self.number, other.number), choose(self.text, other.text), choose(self.flag, other.flag))


UNKNOWN = Value()


def compile_formula(formula: str, fields: dict[str, Value]) -> Value:
    """The value of a formula over named fields.

    Raises ``SyntaxError`` for what is no expression and ``ValueError`` for syntax outside
    numbers, texts, truth values, arithmetic, comparisons, lists, conditions and the text
    methods lower, upper, strip, startswith and endswith.
    """
    return _value(ast.parse(formula.strip(), mode="eval").body, fields)


def _value(node: ast.AST, fields: dict[str, Value]) -> Value:
    match node:
        case ast.Constant(value=bool() as b):
            return Value(flag=F.lit(b))
        case ast.Constant(value=int() | float() as n):
            return Value(number=F.lit(float(n)))
        case ast.Constant(value=str() as s):
            return Value(text=F.lit(s))
        case ast.Name(id=name):
            return fields.get(name, UNKNOWN)
        case ast.BoolOp(op=op, values=values):
            parts = [_value(v, fields) for v in values]
            stop = isinstance(op, ast.Or)
            out = parts[-1]
            for part in reversed(parts[:-1]):
                truth = part.truth()
                out = part.where(truth if stop else ~truth, out)
            return out
        case ast.UnaryOp(op=ast.Not(), operand=inner):
            return Value(flag=~_value(inner, fields).truth())
        case ast.UnaryOp(op=ast.USub() | ast.UAdd() as op, operand=inner):
            n = _value(inner, fields).numeric()
            return UNKNOWN if n is None else Value(number=-n if isinstance(op, ast.USub) else n)
        case ast.BinOp(left=left, op=op, right=right):
            return _arithmetic(op, _value(left, fields), _value(right, fields))
        case ast.Compare(left=left, ops=ops, comparators=rest):
            terms = [_terms(n, fields) if isinstance(n, ast.List | ast.Tuple | ast.Set) else _value(n, fields) for n in (left, *rest)]
            results = [Value(flag=_compare(op, a, b)) for op, a, b in zip(ops, terms, terms[1:])]
            out = results[-1]
            for part in reversed(results[:-1]):
                out = part.where(~part.flag, out)
            return out
        case ast.IfExp(test=test, body=body, orelse=other):
            return _value(body, fields).where(_value(test, fields).truth(), _value(other, fields))
        case ast.Call(func=ast.Attribute(value=inner, attr=method), args=args, keywords=[]):
            return _method(method, _value(inner, fields), [_value(a, fields) for a in args])
    raise ValueError(f"a formula cannot have {ast.unparse(node)!r}")


def _terms(node: ast.List | ast.Tuple | ast.Set, fields: dict[str, Value]) -> list[Value]:
    return [_value(e, fields) for e in node.elts]


def _method(name: str, text: Value, args: list[Value]) -> Value:
    one_text = {"lower": F.lower, "upper": F.upper, "strip": strip}
    asked = {"startswith": F.startswith, "endswith": F.endswith}
    if not (name in one_text and not args or name in asked and len(args) == 1):
        raise ValueError(f"a formula cannot call {name} with {len(args)} values")
    if text.text is None or any(a.text is None for a in args):
        return UNKNOWN
    if not args:
        return Value(text=one_text[name](text.text))
    return Value(flag=asked[name](text.text, args[0].text))


def _arithmetic(op: ast.operator, a: Value, b: Value) -> Value:
    x, y = a.numeric(), b.numeric()
    text = F.concat(a.text, b.text) if isinstance(op, ast.Add) and a.text is not None and b.text is not None else None
    if x is None or y is None:
        return Value(text=text)
    divisor = F.nullif(y, F.lit(0.0))
    match op:
        case ast.Add():
            n = x + y
        case ast.Sub():
            n = x - y
        case ast.Mult():
            n = x * y
        case ast.Div():
            n = F.try_divide(x, divisor)
        case ast.Mod():
            n = _remainder(x, divisor)
        case ast.FloorDiv():
            whole = F.try_divide(x - _remainder(x, divisor), divisor)
            n = F.rint(whole)
        case ast.Pow():
            n = _power(x, y)
        case _:
            raise ValueError(f"a formula cannot have the operator {type(op).__name__}")
    return Value(number=n, text=text)


def _remainder(x: Column, divisor: Column) -> Column:
    """With the sign of the divisor."""
    rest = F.try_mod(x, divisor)
    return F.when((rest != 0) & ((rest < 0) != (divisor < 0)), rest + divisor).otherwise(rest)


def _power(x: Column, y: Column) -> Column:
    """Unknown where Python raises an error or leaves the real numbers."""
    out = F.pow(x, y)
    finite = lambda c: F.abs(c) < float("inf")
    fails = ((x == 0) & (y < 0)) | ((x < 0) & finite(x) & finite(y) & (F.rint(y) != y)) | (finite(x) & finite(y) & ~finite(out))
    return F.when(F.isnan(x) | F.isnan(y) | ~fails, F.when((x == 1) | (y == 0), F.lit(1.0)).otherwise(out))


def _equal(a: Value, b: Value) -> Column:
    """False for unequal kinds, null where one side is unknown; NaN equals nothing."""
    same = F.lit(False)
    x, y = a.numeric(), b.numeric()
    if x is not None and y is not None:
        same = F.coalesce((x == y) & ~F.isnan(x), F.lit(False))
    if a.text is not None and b.text is not None:
        same = same | F.coalesce(a.text == b.text, F.lit(False))
    return F.when(a.known() & b.known(), same)


def _less(a: Value, b: Value, or_equal: bool) -> Column:
    out = []
    x, y = a.numeric(), b.numeric()
    if x is not None and y is not None:
        ordered = ((x <= y) if or_equal else (x < y)) & ~F.isnan(x) & ~F.isnan(y)
        out.append(F.when(x.isNotNull() & y.isNotNull(), ordered))
    if a.text is not None and b.text is not None:
        out.append((a.text <= b.text) if or_equal else (a.text < b.text))
    return F.coalesce(*out) if out else F.lit(None).cast("boolean")


def _compare(op: ast.cmpop, a: Value | list[Value], b: Value | list[Value]) -> Column:
    if isinstance(op, ast.In | ast.NotIn) and isinstance(a, Value):
        if isinstance(b, Value):  # a part of a text
            found = F.contains(b.text, a.text) if a.text is not None and b.text is not None else F.lit(None).cast("boolean")
        else:  # a field is always among itself, even if it is NaN
            all_known = reduce(Column.__and__, [v.known() for v in b], a.known())
            found = F.when(all_known, reduce(Column.__or__, [F.lit(True) if v is a else _equal(a, v) for v in b], F.lit(False)))
        return found if isinstance(op, ast.In) else ~found
    if isinstance(a, list) or isinstance(b, list):
        raise ValueError("a formula can use a list only on the right of in")
    match op:
        case ast.Eq():
            return _equal(a, b)
        case ast.NotEq():
            return ~_equal(a, b)
        case ast.Lt():
            return _less(a, b, False)
        case ast.LtE():
            return _less(a, b, True)
        case ast.Gt():
            return _less(b, a, False)
        case ast.GtE():
            return _less(b, a, True)
    raise ValueError(f"a formula cannot compare with {type(op).__name__}")
