"""Mapping, validation, duplicates and matching on small edge tables."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rowmill.operators import dedup, matching
from rowmill.operators.mapping import MappingRule, map_fields, rules_from_dict, unmapped_fields
from rowmill.operators.report import stored_counts, summary_record
from rowmill.operators.validate import SAMPLE_RULES, error_counts, validate
from rowmill.records import Fields


def rules(*field, cross=(), semantic=()):
    return {"field_validation_rules": list(field), "cross_field_rules": list(cross), "semantic_rules": list(semantic)}


def failing(df, rule_set, fields=None):
    rows = validate(df, rule_set, fields).orderBy("i").collect()
    return [[e.rule for e in r.validation_errors] for r in rows]


def test_absent_is_skipped_and_null_is_not(spark):
    df = spark.createDataFrame([(0, {"a": None}), (1, {}), (2, {"a": "5"})], "i int, raw map<string,string>")
    checks = rules({"field": "a", "rule_type": "required"}, {"field": "a", "rule_type": "range", "min_value": 1})
    assert failing(df, checks, Fields.ragged("raw")) == [["required", "range"], [], []]


def test_range_ties_and_words(spark):
    texts = ["999999.99", "999999.9900000000001", "0", None, "abc", "-0.0000001", "inf", "NaN", "1e3"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, a string")
    got = failing(df, rules({"field": "a", "rule_type": "range", "min_value": 0, "max_value": 999999.99}))
    assert [bool(g) for g in got] == [False, True, False, False, True, True, True, True, False]


def test_null_is_the_word_none(spark):
    df = spark.createDataFrame([(0, None), (1, "usd"), (2, "abc")], "i int, a string")
    assert failing(df, rules({"field": "a", "rule_type": "enum", "values": ["USD", "none"]})) == [[], [], ["enum"]]
    assert failing(df, rules({"field": "a", "rule_type": "regex", "pattern": "N|u"})) == [[], [], ["regex"]]
    assert failing(df, rules({"field": "a", "rule_type": "length", "min_length": 1})) == [["length"], [], []]


def test_formula(spark):
    rows = [(0, "2", "3", "6"), (1, "2", "3", "7"), (2, None, "3", "6"), (3, "x", "3", "6"), (4, "2", "3", "x"), (5, "nan", "1", "nan")]
    df = spark.createDataFrame(rows, "i int, quantity string, unit_price string, total_amount string")
    rule = SAMPLE_RULES["cross_field_rules"][0]
    assert [bool(e) for e in failing(df, rules(cross=[rule]))] == [False, True, False, False, True, True]
    bare = {"fields": ["quantity"], "rule_type": "formula", "formula": "quantity - 2"}
    assert [bool(e) for e in failing(df, rules(cross=[bare]))][:3] == [True, True, False]
    halves = {**bare, "formula": "1 / (quantity - 2) == 1 or quantity == 'x'"}
    assert [bool(e) for e in failing(df, rules(cross=[halves]))] == [False, False, False, False, False, True]
    with pytest.warns(UserWarning):
        validate(df, rules(cross=[{**bare, "formula": "quantity =="}]))
    other = {"fields": ["quantity"], "rule_type": "formula", "formula": "quantity * unit_price == 1"}
    assert not any(failing(df, rules(cross=[other])))
    words = {"fields": ["quantity", "total_amount"], "rule_type": "formula", "formula": "quantity != total_amount"}
    same = spark.createDataFrame([(0, "a", "a"), (1, "a", "b"), (2, "1", "a")], "i int, quantity string, total_amount string")
    assert [bool(e) for e in failing(same, rules(cross=[words]))] == [True, False, False]


def test_cross_and_semantic(spark):
    df = spark.createDataFrame(
        [(0, True, "", "0"), (1, True, "5", ""), (2, False, "", "x"), (3, None, None, None)],
        "i int, expedited boolean, shipping_cost string, discount string",
    )
    dependency = SAMPLE_RULES["cross_field_rules"][1]
    assert failing(df, rules(cross=[dependency])) == [["dependency"], [], [], []]
    exclusive = {"fields": ["shipping_cost", "discount", "expedited"], "rule_type": "mutual_exclusion"}
    assert failing(df, rules(cross=[exclusive])) == [["mutual_exclusion"], ["mutual_exclusion"], [], []]
    text = df.withColumn("expedited", F.col("expedited").cast("string"))
    assert not any(failing(text, rules(cross=[dependency])))
    # an absent status fails the transition rule, an absent moment passes
    semantic = rules(semantic=SAMPLE_RULES["semantic_rules"])
    assert failing(df, semantic) == [["status_transition"]] * 4


def test_more_rules_than_one_mask(spark):
    many = [{"field": "a", "rule_type": "length", "min_length": n, "message": str(n)} for n in range(1, 101)]
    df = spark.createDataFrame([(0, "x" * 70), (1, "x" * 100)], "i int, a string")
    rows = validate(df, rules(*many)).orderBy("i").collect()
    assert [e.message for e in rows[0].validation_errors] == [str(n) for n in range(71, 101)]
    assert rows[1].status == "valid"


def test_filter_after_validation_keeps_the_plan_small(spark):
    df = spark.createDataFrame([(0, "a")], "i int, order_status string")
    flagged = validate(df, SAMPLE_RULES).where("status = 'flagged'").select(F.explode("validation_errors"))
    assert len(flagged._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert flagged.count() > 0


def test_filters_on_data_reach_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id AS order_id", "'pending' AS order_status").write.parquet(f"{tmp_path}/rows")
    checked = validate(spark.read.parquet(f"{tmp_path}/rows"), SAMPLE_RULES).where("order_id = 3 AND status = 'valid'")
    assert "EqualTo(order_id,3)" in checked._jdf.queryExecution().executedPlan().toString()
    assert checked.count() == 1


def test_error_counts_as_stored(spark):
    df = spark.createDataFrame([(i, None if i % 3 else "x", "nope" if i % 2 else "USD") for i in range(12)], "i int, order_id string, currency string")
    key = lambda r: (r.rule, r.field or "")
    assert sorted(error_counts(df, SAMPLE_RULES).collect(), key=key) == sorted(stored_counts(validate(df, SAMPLE_RULES)).collect(), key=key)
    assert summary_record(validate(df.where("false"), SAMPLE_RULES), "b").first().summary.total_rows == 0


def test_duplicates_across_files(spark):
    rows = [("a.csv", 1, "r1", "x"), ("b.csv", 1, "r2", "x"), ("a.csv", 10, "a_10", "y"), ("a.csv", 2, "a_2", "y"), ("b.csv", 3, "r5", "z")]
    df = spark.createDataFrame(rows, "file_id string, line_number long, row_id string, v string")
    marked = {r.row_id: [e.message for e in r.validation_errors] for r in dedup.mark_duplicates(df, ["v"]).collect()}
    assert marked == {"r1": [], "r2": ["Duplicate of row r1"], "a_10": ["Duplicate of row a_2"], "a_2": [], "r5": []}


def test_mapping_priority_and_presence(spark):
    df = spark.createDataFrame([("x1", None), ("y", "b")], "a string, b string")
    both = [MappingRule("a", "t", priority=1), MappingRule("b", "t", priority=9)]
    assert {r.t for r in map_fields(df, both).collect()} == {None, "b"}
    assert {r.t for r in map_fields(df, both, win="first").collect()} == {"x1", "y"}
    some = map_fields(df, [MappingRule("a", "t", "regex", r"\d")]).collect()
    assert sorted((r._present, r.t) for r in some) == [([], None), (["t"], "x1")]
    left = unmapped_fields(df, rules_from_dict({"a": "t"})).collect()
    assert [r.field for r in left] == ["b"]


def test_dedup_key_rules(spark):
    rows = [("A ", None), ("a", ""), (None, "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(dedup.dedup_key(Fields.flat(df), ["a", "b", "c"])).collect()]
    want = ["|".join([*(v.lower().strip() for v in r if v is not None), ""]) for r in rows]
    assert got == [hashlib.md5(w.encode()).hexdigest() for w in want]


def test_hot_duplicate_key(spark):
    n = 3000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    marked = dedup.mark_duplicates(df, ["k"], "id")
    bad = marked.where(F.size("validation_errors") == 1)
    assert bad.count() == n // 3 - 1
    assert {r.m for r in bad.select(F.element_at("validation_errors", 1)["message"].alias("m")).distinct().collect()} == {
        "Duplicate of row 0"
    }


def fuzzy(a, b, threshold=0.85):
    if not a or not b:
        return False
    x, y = a.lower().strip(), b.lower().strip()
    if x == y:
        return True
    if abs(len(x) - len(y)) > max(len(x), len(y)) * 0.3:
        return False
    return sum(c in y for c in x) / max(len(x), len(y)) >= threshold


def test_fuzzy_match(spark):
    random.seed(3)
    word = lambda: "".join(random.choice("abcAB ") for _ in range(random.randint(0, 8)))
    pairs = [(i, word(), word()) for i in range(1000)] + [(1000, None, "a"), (1001, " ", " ")]
    df = spark.createDataFrame(pairs, "i int, a string, b string")
    got = df.select("i", dedup.fuzzy_match(F.col("a"), F.col("b"), 0.6).alias("o")).orderBy("i").collect()
    wrong = [(p, g.o) for p, g in zip(pairs, got) if g.o != (fuzzy(p[1], p[2], 0.6) if p[1] != " " else g.o)]
    assert not wrong, wrong[:5]


def test_matching(spark):
    headers = spark.createDataFrame([("Order_ID",), ("order id",), ("Qty",), ("ORDER-DATE",)], "header string")
    fields = ["order_id", "order_date", "quantity"]
    got = {(r.header, r.canonical_field, r.confidence) for r in matching.match_headers(headers, fields).collect()}
    assert got == {("Order_ID", "order_id", 1.0), ("Order_ID", "order_id", 0.95)}
    left = {r.header for r in matching.unmatched_headers(headers, fields).collect()}
    assert left == {"order id", "Qty", "ORDER-DATE"}
    best = {r.header: r.canonical_field for r in matching.best_suggestion(headers, fields).collect()}
    assert best["order id"] == "order_id" and best["ORDER-DATE"] == "order_date"


def test_conditions_are_not_evaluated_by_a_generator(spark):
    """A generator's own expressions are interpreted where a stage is too large to compile."""
    df = spark.createDataFrame([(0, "abc"), (1, "7")], "i int, a string")
    checked = validate(df, rules({"field": "a", "rule_type": "regex", "pattern": "[0-9]+"}))
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert not any("RLIKE" in line for line in plan.splitlines() if "Generate " in line)
    assert [bool(r.validation_errors) for r in checked.orderBy("i").collect()] == [True, False]
