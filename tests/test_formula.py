"""Formulas as Columns beside Python's own evaluation."""

import random

import pytest
from pyspark.sql import functions as F

from rowmill.operators.formula import compile_formula
from rowmill.records import Fields

NAMES = ["a", "b", "t"]
VALUES = [None, "0", "1", "2.5", "-3", "7", "x", "xy", "", "nan", "inf", "1e300"]


def formula(rnd, depth, kind):
    number = lambda: formula(rnd, depth - 1, "number")
    if kind == "number":
        if depth <= 0 or rnd.random() < 0.3:
            return rnd.choice([*NAMES, *NAMES, "1.0", "0.0", "2.5", "3", "missing"])
        op = rnd.choice(["+", "-", "*", "/", "//", "%", "+", "**", "-neg", "if"])
        if op == "-neg":
            return f"(-{number()})"
        if op == "if":
            return f"({number()} if {formula(rnd, depth - 1, 'truth')} else {number()})"
        if op == "**":
            return f"({number()} ** {rnd.choice(['2', '3', '-1.0', '0.0'])})"
        return f"({number()} {op} {number()})"
    if depth <= 0 or rnd.random() < 0.4:
        some = lambda: rnd.choice(["'x'", "'xy'", "''", number(), number(), number()])
        form = rnd.choice(["pair", "pair", "pair", "chain", "in", "notin", "part"])
        if form == "chain":
            return f"({number()} {rnd.choice(['<', '<=', '==', '>'])} {number()} {rnd.choice(['<', '>=', '!='])} {number()})"
        if form in ("in", "notin"):
            return f"({some()} {'in' if form == 'in' else 'not in'} [{some()}, {some()}, 'x'])"
        if form == "part":
            return f"({rnd.choice(NAMES)} in 'wxyz')"
        return f"({some()} {rnd.choice(['==', '!=', '<', '<=', '>', '>='])} {some()})"
    op = rnd.choice(["and", "or", "not", "bare"])
    if op == "not":
        return f"(not {formula(rnd, depth - 1, 'truth')})"
    if op == "bare":
        return number()
    return f"({formula(rnd, depth - 1, 'truth')} {op} {formula(rnd, depth - 1, 'truth')})"


def python(text, row):
    known = {}
    for name, value in row.items():
        if value is not None:
            try:
                known[name] = float(value)
            except ValueError:
                known[name] = value
    try:
        return bool(eval(text, {"__builtins__": {}}, known))
    except Exception:  # noqa: BLE001
        return True


@pytest.mark.parametrize("seed", range(10))
def test_generated_formulas(spark, seed):
    rnd = random.Random(seed)
    formulas = [formula(rnd, 2, "truth") for _ in range(50)]
    rows = [{n: rnd.choice(VALUES) for n in NAMES} for _ in range(40)]
    df = spark.createDataFrame([(i, *r.values()) for i, r in enumerate(rows)], "i int, a string, b string, t string")
    fields = Fields.flat(df)
    work, ready = fields.staged(df, set(), set(NAMES), set())

    from rowmill.operators.formula import Value

    values = {n: Value(number=ready.number(n), text=F.when(ready.number(n).isNull(), ready.value(n))) for n in NAMES}
    passed = [F.coalesce(compile_formula(f, values).truth(), F.lit(True)).alias(f"c{k}") for k, f in enumerate(formulas)]
    for got in work.select("i", *passed).collect():
        for k, text in enumerate(formulas):
            whole_times_text = "3" in text and "*" in text and any(isinstance(v, str) and v[:1] in ("x", "") for v in rows[got.i].values())
            if not whole_times_text:
                assert got[f"c{k}"] == python(text, rows[got.i]), (text, rows[got.i])


def test_text_methods_and_limits(spark):
    df = spark.createDataFrame([("Ab ",), (None,)], "a string")
    from rowmill.operators.formula import Value

    values = {"a": Value(text=F.col("a"))}
    asked = ["a.strip().lower() == 'ab'", "a.upper().startswith('AB')", "not a.endswith('b')", "a in ('Ab ', 'c')"]
    rows = df.select(*[compile_formula(f, values).truth().alias(str(k)) for k, f in enumerate(asked)]).collect()
    assert list(rows[0]) == [True] * 4 and list(rows[1]) == [None] * 4
    for bad in ("f(a)", "a[0]", "a.split('x', 1)", "[a] == [a]", "lambda: 1", "a is None"):
        with pytest.raises(ValueError):
            compile_formula(bad, values)
    with pytest.raises(SyntaxError):
        compile_formula("a ==", values)
