"""Scans, sinks, the whole job and the review ledger on small files."""

import json

import pytest
from pyspark.sql import functions as F

from rowmill.operators.ledger import Ledger
from rowmill.operators.mapping import MappingRule
from rowmill.plans.batch import refine_stored, run_batch
from rowmill.sinks import writers
from rowmill.sources.intake import read_rows
from rowmill.sources.listing import list_files


def put(folder, name, content, encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(content if isinstance(content, bytes) else content.encode(encoding))


def rows_of(spark, folder):
    got = read_rows(spark, list_files(spark, str(folder))).orderBy("source_name", "line_number").collect()
    out = {}
    for r in got:
        out.setdefault(r.source_name, []).append((r.line_number, r.raw))
        assert r.row_id == f"{r.file_id}_{r.line_number}"
    return out


def test_intake_edges(spark, tmp_path):
    put(tmp_path, "a.csv", 'x,y,x\n1,NA,2\n1,2,3,4\n5\n\n"q\nr",7,8\n')
    put(tmp_path, "b.tsv", "x\ty\n1\tnull\n")
    put(tmp_path, "c.csv", "x,name\n1,Zoë\n", "latin-1")
    put(tmp_path, "d.jsonl", '{"a":1}\n\nbroken\n[1]\n{"a":null,"b":{"c":2}}\n{"a":1} tail\n')
    put(tmp_path, "e.json", '[\n {"a":"1"},\n 5,\n {"b":null}\n]\n')
    put(tmp_path, "f.xml", '<r v="1"><o/><row id="05"><q>1</q><t>a</t><t>b</t></row><row><q>2</q></row></r>')
    put(tmp_path, "g.pdf", b"%PDF-1.4")
    put(tmp_path / "deep", "h.data", "k\tv\n1\t2\n")
    got = rows_of(spark, tmp_path)
    assert got["a.csv"] == [
        (1, {"x": "1", "y": None, "x.1": "2"}),
        (2, {"x": "5", "y": None, "x.1": None}),
        (3, {"x": "q\nr", "y": "7", "x.1": "8"}),
    ]
    assert got["b.tsv"] == [(1, {"x": "1", "y": None})]
    assert got["c.csv"] == [(1, {"x": "1", "name": "Zoë"})]
    assert got["d.jsonl"] == [(1, {"a": "1"}), (2, {"a": None, "b": '{"c":2}'})]
    assert got["e.json"] == [(1, {"a": "1"}), (2, {"b": None})]
    assert got["f.xml"] == [(1, {"id": "05", "q": "1", "t": '["a","b"]'}), (2, {"q": "2"})]
    assert "g.pdf" not in got


def test_line_numbers_over_splits(spark, tmp_path):
    body = "\n".join(f"{i},{'x' * 50}" for i in range(1, 4001))
    put(tmp_path, "big.csv", "n,t\n" + body + "\n")
    put(tmp_path, "big2.csv", "n,t\n" + body + "\n9,9\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_rows(spark, list_files(spark, str(tmp_path)))
        wrong = rows.where(F.col("raw")["n"].cast("long") != F.col("line_number"))
        assert rows.count() == 8001
        assert wrong.count() == 1  # the appended row of the second file
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.fixture()
def validated(spark):
    data = [("r1", "f", 1, "valid", [], 'a "b", c', None), ("r2", "f", 2, "flagged", [(None, "a,b", "formula", "m")], "z", "ü")]
    schema = (
        "row_id string, file_id string, line_number bigint, status string, "
        "validation_errors array<struct<field:string,fields:string,rule:string,message:string>>, b string, a string"
    )
    return spark.createDataFrame(data, schema)


def test_sinks(spark, tmp_path, validated):
    out = str(tmp_path / "o")
    writers.export_rows(validated, "csv", out + "csv", include_metadata=True, include_errors=True)
    back = spark.read.option("header", True).option("escape", '"').csv(out + "csv").orderBy("_row_id").collect()
    assert back[0].asDict() == {
        "a": None, "b": 'a "b", c', "_row_id": "r1", "_line_number": "1", "_status": "valid", "_errors": None,
    }
    assert back[1]["_errors"] == "None:formula"
    writers.export_rows(validated, "json", out + "json", fields=["a", "zz"])
    arrays = [json.loads(p.read_text()) for p in (tmp_path / "ojson").glob("part*") if p.stat().st_size]
    assert sorted(str(r) for a in arrays for r in a) == ["{'a': 'ü'}", "{'a': None}"]
    writers.export_rows(validated, "xml", out + "xml", status="flagged")
    text = "".join(p.read_text() for p in (tmp_path / "oxml").glob("part*"))
    assert 'data count="1" status="flagged"' in text and "<a>ü</a>" in text
    result = writers.export_split(validated, "jsonl", out + "split")
    assert (result["valid_rows"], result["flagged_rows"]) == (1, 1)
    assert writers.export_split(validated.limit(0), "csv", out)["status"] == "NO_DATA"
    with pytest.raises(ValueError):
        writers.export_rows(validated, "parchment", out)


def test_batch_review_and_rerun(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "Order_ID,Qty\n1,5\n,x\n")
    put(tmp_path / "in", "b.pdf", b"%PDF")
    mapping = [MappingRule("Order_ID", "order_id"), MappingRule("Qty", "quantity")]
    rules = {
        "field_validation_rules": [
            {"field": "order_id", "rule_type": "required"},
            {"field": "quantity", "rule_type": "type", "expected_type": "integer"},
        ]
    }
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    args = (spark, str(tmp_path / "in"), ledger, str(tmp_path / "out"), mapping, rules)
    first = run_batch(*args)
    assert (first["total_rows"], first["valid_rows"], first["status"]) == (2, 1, "partial_success")
    assert {r.filename: r.status for r in ledger.files().collect()} == {"a.csv": "success", "b.pdf": "failed"}
    flagged = ledger.rows().where("status = 'flagged'").select("row_id")
    ledger.reject_rows(flagged, "ann")
    ledger.approve_rows([flagged.first().row_id], "bob", "fine")
    assert {r.effective_status for r in ledger.reviewed_rows().collect()} == {"valid", "approved"}
    again = run_batch(*args)
    assert again["total_rows"] == 0
    forced = run_batch(*args, force=True)
    assert forced["total_rows"] == 2 and ledger.rows().count() == 2


def test_bad_files_are_recorded_and_the_rest_goes_on(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "good.csv", "Order_ID\n1\n2\n")
    put(folder, "orders[1]{a}*.csv", "Order_ID\n3\n")
    put(folder, "bad.json", '[{"Order_ID": 1}, {')
    put(folder, "good.json", '[{"Order_ID": 4}]')
    put(folder, "cut.xml", "<r><row><Order_ID>5</Order_ID></row><row>")
    put(folder, "good.xml", '<?xml version="1.0"?><!-- <x> --><r a="1>0"><row><Order_ID>6</Order_ID></row><row/></r>')
    put(folder, "words.jsonl", '{"no\nobjects\n')
    put(folder, "same.csv", "Order_ID\n1\n2\n")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    rules = {"field_validation_rules": [{"field": "order_id", "rule_type": "required"}]}
    args = (spark, str(folder), ledger, str(tmp_path / "out"), [MappingRule("Order_ID", "order_id")], rules)
    done = run_batch(*args, batch_id="b1")
    files = {r.filename: (r.status, r.row_count, r.error_message) for r in ledger.files().collect()}
    assert files == {
        "good.csv": ("success", 2, None),
        "orders[1]{a}*.csv": ("success", 1, None),
        "bad.json": ("failed", 0, "Cannot be parsed as a JSON array"),
        "good.json": ("success", 1, None),
        "cut.xml": ("failed", 0, "Cannot be parsed as XML"),
        "good.xml": ("success", files["good.xml"][1], None),
        "words.jsonl": ("failed", 0, "No line could be read"),
    }
    assert done["status"] == "partial_success" and len(done["errors"]) == 3
    assert [r.status for r in ledger.read("batches").orderBy("recorded_at").collect()] == ["running", "partial_success"]
    assert ledger.batch("b1").first().total_rows == done["total_rows"] == sum(n for _, n, _ in files.values())

    good = ledger.files().where("filename = 'good.csv'").first().file_id
    again = refine_stored(ledger, good, [MappingRule("Order_ID", "code")], {}).collect()
    assert [(r.line_number, r.code) for r in again] == [(1, "1"), (2, "2")]


def test_a_broken_run_is_recorded(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "x\n1\n")
    ledger = Ledger(spark, str(tmp_path / "ledger"))

    def fails(rows):
        raise RuntimeError("no normaliser today")

    with pytest.raises(RuntimeError):
        run_batch(spark, str(tmp_path / "in"), ledger, str(tmp_path / "out"), [], {}, batch_id="b", normalise=fails)
    last = ledger.batch("b").first()
    assert last.status == "failed" and last.errors == ["no normaliser today"]
    assert ledger.files().count() == 0


def test_refine_stored_files(spark, tmp_path):
    """Rows of all files of a DataFrame of ids, and of no other file."""
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"f{i}.json").write_text("".join(f'{{"nr": "{i}{j}"}}\n' for j in range(4)))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    run_batch(spark, str(tmp_path / "in"), ledger, str(tmp_path / "out"), [MappingRule("nr", "old")], {})
    files = ledger.files().select("file_id")
    assert files.count() == 3
    got = refine_stored(ledger, files, [MappingRule("nr", "key")], {}).collect()
    assert sorted(r.key for r in got) == sorted(f"{i}{j}" for i in range(3) for j in range(4))
    assert len(refine_stored(ledger, files.limit(2), [MappingRule("nr", "key")], {}).collect()) == 8


def test_review_files_are_packed(spark, tmp_path):
    """A listing of all errors repeats itself: it is stored packed, and reads back alike."""
    from rowmill.operators.validate import SAMPLE_RULES, validate
    from rowmill.sinks import review

    rows = spark.createDataFrame([("a_1", 1, "x"), ("a_2", 2, "y")], "row_id string, line_number long, quantity string")
    checked = validate(rows, SAMPLE_RULES)
    review.write_review_csv(checked, f"{tmp_path}/r")
    assert {p.suffix for p in (tmp_path / "r").iterdir() if p.name.startswith("part")} == {".gz"}
    back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/r")
    assert back.count() == review.review_frame(checked).count() > 2
