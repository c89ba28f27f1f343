"""What JSON had a value as, through intake, mapping and cross-field rules."""

import json

import pytest
from pyspark.sql import functions as F

from rowmill.operators.ledger import Ledger
from rowmill.operators.mapping import MappingRule
from rowmill.operators.validate import validate, with_stock
from rowmill.plans.batch import refine, refine_stored, run_batch
from rowmill.sources.intake import read_rows
from rowmill.sources.listing import list_files

VALUES = [None, "", "0", "false", "x", 0, 0.0, -0.0, 1, 1.0, 2, True, False, [], {}, [0], {"a": 0}, "true", "1", 1e300, " "]


def trimmed(value):
    return (value.strip() or None) if isinstance(value, str) else value


def as_python(rule, record):
    if rule["rule_type"] == "dependency":
        fails = record.get(rule["condition_field"]) == rule["condition_value"] and not record.get(rule["required_field"])
    else:
        fails = sum(bool(record.get(f)) for f in rule["fields"]) > 1
    return "flagged" if fails else "valid"


RULES = [
    *({"fields": [], "rule_type": "dependency", "condition_field": "A", "condition_value": v, "required_field": "B"} for v in (True, 0, 1, "1", "true", None, 2.0)),
    {"fields": ["A", "B"], "rule_type": "mutual_exclusion"},
]


@pytest.fixture()
def kinds(spark, tmp_path):
    records = [{"n": i, "a": a, "b": b} for i, (a, b) in enumerate((a, b) for a in VALUES for b in VALUES)] + [{"n": 5000}, {"n": 5001, "a": True}]
    (tmp_path / "lines.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records[::2]))
    (tmp_path / "array.json").write_text(json.dumps(records[1::2]))
    return records, read_rows(spark, list_files(spark, str(tmp_path), range_bytes=3000))


def test_rules_on_json_values_are_pythons(kinds):
    records, rows = kinds
    mapping = [MappingRule("n", "N"), MappingRule("a", "A"), MappingRule("b", "B")]
    for rule in RULES:
        got = {int(r.N): r.status for r in refine(rows, mapping, {"cross_field_rules": [rule]}).select("N", "status").collect()}
        want = {r["n"]: as_python(rule, {k.upper(): trimmed(v) for k, v in r.items()}) for r in records}
        assert {n: (s, want[n], records[n] if n < 5000 else n) for n, s in got.items() if s != want[n]} == {}, rule
        assert len(got) == len(want)


def test_kinds_follow_the_rule_that_maps(spark, kinds):
    _, rows = kinds
    one = rows.where("raw['n'] = '5001'")
    upper = MappingRule("a", "T", "function", function=F.upper)
    mapping = [MappingRule("n", "A", priority=1), MappingRule("a", "A", priority=2), upper, MappingRule("n", "M")]
    row = refine(one, mapping, {}).first()
    assert (row.A, row.T, row.M, row.kinds) == ("true", "TRUE", "5001", {"A": "boolean", "M": "number"})


def test_kinds_are_stored(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"a": false, "b": "x"}\n{"a": "false", "b": "x"}\n')
    (folder / "b.csv").write_text("a,b\nfalse,x\n")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    mapping = [MappingRule("a", "A"), MappingRule("b", "B")]
    rule = {"cross_field_rules": [{"fields": ["A", "B"], "rule_type": "mutual_exclusion"}]}
    run_batch(spark, str(folder), ledger, str(tmp_path / "out"), mapping, rule)
    assert sorted(r.status for r in ledger.rows().collect()) == ["flagged", "flagged", "valid"]
    again = refine_stored(ledger, ledger.files(), mapping, rule)
    assert sorted(r.status for r in again.collect()) == ["flagged", "flagged", "valid"]


def test_formulas_that_cannot_run_pass(spark):
    df = spark.createDataFrame([("2", "1")], "q string, t string")
    for formula in ("abs(q) == t", "q[0] == t", "q.replace('1', '2') == t", "q ==", "[a for a in q]"):
        with pytest.warns(UserWarning, match="passes"):
            checked = validate(df, {"cross_field_rules": [{"fields": ["q", "t"], "rule_type": "formula", "formula": formula}]})
        assert checked.first().status == "valid"
    df = spark.createDataFrame([("\tx\n", "x")], "q string, t string")
    rule = {"fields": ["q", "t"], "rule_type": "formula", "formula": "q.strip() == t"}
    assert validate(df, {"cross_field_rules": [rule]}).first().status == "valid"


def test_inventory(spark):
    rows = spark.createDataFrame([(1, "5"), (1, "6"), (2, "1"), (3, "0"), (None, "1"), (1, "x"), (1, None)], "part int, quantity string")
    stock = spark.createDataFrame([(1, 5), (4, 9)], "part int, on_hand int")
    rule = {"rule_type": "inventory", "stock_field": "on_hand"}
    got = validate(with_stock(rows, stock, ["part"]), {"semantic_rules": [rule]})
    assert sorted((str(r.part), str(r.quantity), r.status) for r in got.collect()) == [
        ("1", "5", "valid"), ("1", "6", "flagged"), ("1", "None", "valid"), ("1", "x", "valid"),
        ("2", "1", "flagged"), ("3", "0", "valid"), ("None", "1", "flagged"),
    ]
    assert {r.status for r in validate(rows, {"semantic_rules": [{"rule_type": "inventory"}]}).collect()} == {"valid"}


def test_stock_is_joined_without_copies_of_it(spark):
    """A side repeated for each salt is sixteen times what Spark takes it for when it broadcasts."""
    rows = spark.range(100).selectExpr("id", "id % 7 AS part", "1 AS quantity")
    stock = spark.range(5).selectExpr("id AS part", "id AS on_hand")
    joined = with_stock(rows, stock, ["part"])
    assert "Generate" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 100 and joined.where("on_hand IS NULL").count() == sum(i % 7 > 4 for i in range(100))
