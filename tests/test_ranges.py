"""Files read in byte ranges: the same rows whatever the ranges, each range by itself."""

import csv
import hashlib
import io
import json
import random
import re
import xml.etree.ElementTree as ET

import pytest

from rowmill.sources import marks, ranges, records
from rowmill.sources.intake import read_files, read_rows
from rowmill.sources.listing import list_files
from rowmill.sources.records import _of_range
from rowmill.sources.store import Bytes


def file_in_ranges(path, step, fmt=None):
    """Listing and reading without Spark: (file row, records of each range)."""
    reader = ranges.RangeReader({"path": str(path), "rangebytes": str(step), "fileformat": fmt or ""})
    fold = None
    for part in reader.partitions():
        for values in reader.read(part):
            row = dict(zip((c.split()[0] for c in ranges.SUMMARY.split(", ")), values))
            fold = fold or ranges.Fold(row)
            fold.add(row)
    row = fold.file()
    out = []
    if row["problem"] is None and row["kind"]:
        for r in row["ranges"]:
            with Bytes(row["path"]) as source:
                out.append(list(_of_range(source, {**row, **r, "width": len(row["columns"] or [])})))
    return row, out


def rows_in_ranges(path, step):
    return [r for part in file_in_ranges(path, step)[1] for r in part]


def test_quoted_cells_in_every_split(tmp_path):
    rnd = random.Random(4)
    pieces = ["a", "é", '""', "\n", "\r\n", ",", " ", "x" * 7, "\r", "\t"]
    path = tmp_path / "a.csv"
    for case in range(25):
        lines = ["k,v,w"]
        for _ in range(rnd.randint(0, 12)):
            cells = []
            for _ in range(rnd.randint(1, 4)):
                if rnd.random() < 0.5:
                    cells.append('"' + "".join(rnd.choices(pieces, k=rnd.randint(0, 6))) + '"')
                else:
                    cells.append(rnd.choice(["", "12", '5" pipe', "NA", "ü z", ' "q"']))
            lines.append(",".join(cells))
        text = rnd.choice(["\n", "\r\n", "\r"]).join(lines) + rnd.choice(["", "\n", "\n\n \n"])
        path.write_bytes((b"\xef\xbb\xbf" if case % 3 == 0 else b"") + text.encode())
        whole = rows_in_ranges(path, 1 << 20)
        want = [r for r in csv.reader(io.StringIO(text, newline="")) if r and (len(r) > 1 or r[0].strip())][1:]
        assert [r[1] for r in whole] == [
            [None if c in ("", "NA") else c for c in r] + [None] * (3 - len(r)) for r in want if len(r) <= 3
        ]
        for step in (4, 5, 7, 16, 50) if case % 3 == 0 else (1, 2, 3, 7, 16, 50):
            assert rows_in_ranges(path, step) == whole, (step, text)


def test_array_elements_in_every_split(tmp_path):
    rnd = random.Random(5)
    path = tmp_path / "a.json"

    def value(depth):
        if depth and rnd.random() < 0.5:
            return rnd.choice([[value(depth - 1) for _ in range(rnd.randint(0, 3))], {rnd.choice("ab\\\"],"): value(depth - 1)}])
        return rnd.choice(["x,]}", 'q"\\', "\\\\", "é ", "", 1.5, None, True])

    for _ in range(25):
        items = [value(3) for _ in range(rnd.randint(0, 8))]
        path.write_text(" \n" + json.dumps(items, indent=rnd.choice([None, 1]), ensure_ascii=rnd.random() < 0.5) + "\n")
        for step in (1, 2, 3, 7, 16, 50, 1 << 20):
            row, parts = file_in_ranges(path, step)
            assert row["problem"] is None
            assert [json.loads(r[2]) for p in parts for r in p] == items


@pytest.mark.parametrize(
    "text", ["", "[1,2", '["a]', "[1] 2", "[1][2]", "[]]", '{"a":1}\n]', "x", "[[1]", "5", '"[]"', "[1]]["]
)
def test_broken_arrays_in_every_split(tmp_path, text):
    path = tmp_path / "a.json"
    path.write_text(" " + "\n" + text)
    for step in (1, 2, 3, 100):
        assert file_in_ranges(path, step)[0]["problem"] == "Cannot be parsed as a JSON array", step


def test_xml_rows_in_every_split(tmp_path):
    rnd = random.Random(6)
    path = tmp_path / "a.xml"

    def element(name, depth):
        inner = "".join(
            rnd.choice([element(rnd.choice(["b", "c"]), depth - 1) if depth else "t", "&lt;x&gt; é", "<!-- <row> -->", "<![CDATA[</row>]]>", "<?p >?>"])
            for _ in range(rnd.randint(0, 3))
        )
        attribute = rnd.choice(["", ' k="1 > 0"', " k='</row>'".replace("<", "&lt;")])
        return f"<{name}{attribute}/>" if not inner else f"<{name}{attribute}>{inner}</{name} >"

    for _ in range(20):
        items = [element("row", 2) for _ in range(rnd.randint(2, 6))] + ["<other><row>in</row></other>"]
        text = '<?xml version="1.0"?><!-- <row/> --><data n="2">\n' + "\n".join(items) + "</data>\n<!-- end -->"
        path.write_text(text)
        whole, parts = file_in_ranges(path, 1 << 20)
        want = ET.fromstring(text).iter("row")
        assert len(parts[0]) == sum(1 for _ in want) and whole["row_tag"] == "row" and whole["problem"] is None
        for step in (1, 2, 3, 8, 40):
            row, some = file_in_ranges(path, step)
            assert (row["problem"], row["row_tag"]) == (None, "row")
            assert [r for p in some for r in p] == parts[0], step


@pytest.mark.parametrize(
    "text", ["", "<a>", "<a></b>", "<a/><b/>", "<a><b></a></b>", "</a>", "<a><!-- </a>", "<a>< b/></a>", "<a><b></a>", "words", '<a b="></a>']
)
def test_broken_xml_in_every_split(tmp_path, text):
    path = tmp_path / "a.xml"
    path.write_text(text)
    for step in (1, 2, 3, 100):
        assert file_in_ranges(path, step)[0]["problem"] == "Cannot be parsed as XML", step


def test_xml_values(tmp_path):
    path = tmp_path / "a.xml"
    path.write_text(
        '<r><row id="05" e=""> a <q>1</q><t>x</t><t k="2">y</t><n><m>1</m><m/></n><o/><id>7</id></row><x:row xmlns:x="u"/></r>'
    )
    row, parts = file_in_ranges(path, 9)
    found = [dict(zip(r[0], r[1])) for p in parts for r in p]
    assert row["row_tag"] == "row"
    assert found == [
        {"id": '["05","7"]', "e": "", "q": "1", "t": '["x",{"k":"2","_text":"y"}]', "n": '{"m":["1",null]}', "_text": "a"}
    ]


def test_identity_encoding_and_format(spark, tmp_path):
    put = lambda name, data: (tmp_path / name).write_bytes(data)
    (tmp_path / ".deep" / "_more").mkdir(parents=True)
    utf8 = ("n,name\n" + "1,Zoë €\n" * 50).encode()
    put("_a.csv", utf8)
    put(".b.csv", utf8 + b"2,x\n")
    put(".deep/_more/c.data", b"k\tv\n1\t2\n")
    put("latin.csv", "n,name\n1,Zoë\n".encode("latin-1") * 20)
    put("a.bin", b"%PDF-1.4")
    put("b.bin", b"PK\x03\x04zip")
    put("c.bin", b'{"a": 1}\n')
    put("d.bin", b"<?xml version='1.0'?><a><b/></a>")
    put("e.bin", b"a,b\n1,2\n")
    put("f.bin", b"words\n")
    put("empty.csv", b"")
    put("none", b"a,b\n")
    put(".x.csv.crc", b"crc")
    for step in (5, 1 << 20):
        got = {r.filename: r for r in list_files(spark, str(tmp_path), range_bytes=step).collect()}
        assert set(got) == {
            "_a.csv", ".b.csv", "c.data", "latin.csv", "a.bin", "b.bin", "c.bin", "d.bin", "e.bin", "f.bin", "empty.csv"
        }
        assert {k: r.format for k, r in got.items() if k.endswith("bin")} == {
            "a.bin": "pdf", "b.bin": "xlsx", "c.bin": "json", "d.bin": "xml", "e.bin": "csv", "f.bin": "txt"
        }
        assert got["c.data"].format == "tsv" and got["c.data"].file_type == "data"
        assert {k for k, r in got.items() if r.encoding != "UTF-8"} == {"latin.csv"}
        assert got["_a.csv"].size_bytes == len(utf8) and got["_a.csv"].columns == ["n", "name"]
        digests = [hashlib.sha256(utf8[i : i + step]).digest() for i in range(0, len(utf8), step)]
        want = digests[0] if len(digests) == 1 else hashlib.sha256(b"".join(digests)).digest()
        assert got["_a.csv"].file_id == want.hex()
        rows = read_files(spark, list_files(spark, str(tmp_path), range_bytes=step)).rows
        count = {r.source_name: r["count"] for r in rows.groupBy("source_name").count().collect()}
        assert count == {"_a.csv": 50, ".b.csv": 51, "c.data": 1, "latin.csv": 39, "c.bin": 1, "d.bin": 1, "e.bin": 1}


def test_a_record_that_fails_fails_its_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}, {bad}, {"a": 3}]')
    (tmp_path / "b.json").write_text('[{"a": 1}, 5, null, {"a": 1, "a": 2}]')
    (tmp_path / "c.xml").write_text("<r><row><a>1</a></row><row><a>&nothing;</a></row></r>")
    (tmp_path / "d.json").write_text('[{"a": 1},]')
    (tmp_path / "e.csv").write_text("a\n1\n")
    for step in (4, 1 << 20):
        taken = read_files(spark, list_files(spark, str(tmp_path), range_bytes=step))
        assert sorted((r.source_name, r.line_number, r.raw["a"]) for r in taken.rows.collect()) == [
            ("b.json", 1, "1"), ("b.json", 2, "2"), ("e.csv", 1, "1")
        ]
        assert sorted(r.error_message for r in taken.problems.collect()) == [
            "Cannot be parsed as XML", "Cannot be parsed as a JSON array", "Cannot be parsed as a JSON array"
        ]


def test_many_headers_in_as_many_jobs_as_one(spark, tmp_path):
    def jobs(files):
        tracker = spark.sparkContext.statusTracker()
        group = f"headers-{files}"
        spark.sparkContext.setJobGroup(group, group)
        folder = tmp_path / str(files)
        folder.mkdir()
        for i in range(files):
            (folder / f"{i}.csv").write_text(f"c{i},d\n{i},x\n")
        rows = read_files(spark, list_files(spark, str(folder))).rows.collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert sorted(int(r.raw[f"c{r.source_name[:-4]}"]) for r in rows) == list(range(files))
        return len(tracker.getJobIdsForGroup(group))

    assert jobs(500) == jobs(1)


def test_ranges_of_one_file_are_in_many_tasks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("n,t\n" + "".join(f'{i},"a\n{i}"\n' for i in range(3000)))
    files = list_files(spark, str(tmp_path), range_bytes=2000)
    assert files.first().quoted_newlines
    rows = read_files(spark, files).rows
    from pyspark.sql import functions as F

    places = rows.select(F.spark_partition_id().alias("p"), "line_number", F.col("raw")["n"].cast("long").alias("n"))
    found = places.agg(F.count_distinct("p").alias("p"), F.count("*").alias("n"), F.count_if(F.col("n") + 1 != F.col("line_number")).alias("wrong")).first()
    assert found.p > 1 and (found.n, found.wrong) == (3000, 0)


def test_a_large_sparse_file_is_never_held(spark, tmp_path, monkeypatch):
    path = tmp_path / "big.csv"
    with open(path, "wb") as f:
        f.truncate(5 << 30)
    reader = ranges.RangeReader({"path": str(tmp_path)})
    parts = reader.partitions()
    assert sum(len(p.ranges) for p in parts) == (5 << 30) // ranges.RANGE_BYTES
    held = []
    read = Bytes.read
    monkeypatch.setattr(Bytes, "read", lambda self, a, b: held.append(min(b, self.size) - a) or read(self, a, b))
    first, last = next(reader.read(parts[0])), list(reader.read(parts[-1]))[-1]
    assert first[4] == ranges.RANGE_BYTES and last[4] == 5 << 30
    assert max(held) <= ranges.RANGE_BYTES + 9 and first[10] == -1
    listed = list_files(spark, str(tmp_path)).first()
    assert (listed.size_bytes, listed.problem, len(listed.ranges)) == (5 << 30, "No header line was found", 320)


def test_borders_move_past_what_they_would_split():
    class Text(Bytes):
        def __init__(self, data):
            self.data, self.size = data, len(data)

        def read(self, start, end):
            return self.data[start:end]

    text = Text(b'ab"""c\r\nd')
    assert [text.settle(i, marks.HOLD["delimited"]) for i in range(9)] == [0, 1, 2, 6, 6, 6, 6, 8, 8]


def test_xml_is_read_by_ranges_not_by_elements(tmp_path, monkeypatch):
    """Reads do not grow with the elements, and tags of plain elements are counted at once."""
    path = tmp_path / "a.xml"
    items = "".join(f"<row><a>{i}</a><b k='1'>x</b><c/><row>{i}</row></row>\n" for i in range(500))
    path.write_text(f"<?xml version='1.0'?><data><!-- <row> -->{items}</data>")
    whole, parts = file_in_ranges(path, 1 << 20)
    reads, matches = [], []
    read, token = Bytes.read, marks._TOKEN
    monkeypatch.setattr(Bytes, "read", lambda self, a, b: reads.append(a) or read(self, a, b))

    class Counted:
        def match(self, data, at):
            matches.append(at)
            return token.match(data, at)

    monkeypatch.setattr(marks, "_TOKEN", Counted())
    with Bytes(str(path)) as source:
        found = list(marks.xml_elements(source, 0, source.size, "text", [], "row"))
        assert len(found) == 500 and found[7] == b"<row><a>7</a><b k='1'>x</b><c/><row>7</row></row>" and len(reads) < 5
        matches.clear()
        state = marks.xml_state(source, 0, source.size, "text")
    assert len(matches) < 10 and state["opens"] == state["closes"] == [] and not state["bad"]
    assert sorted(map(tuple, state["counts"])) == [(0, "data", 1), (1, "row", 500), (2, "a", 500), (2, "b", 500), (2, "c", 500), (2, "row", 500)]
    assert whole["problem"] is None and len(parts[0]) == 500


@pytest.mark.parametrize(
    "xml", ["<r><a> x </a>\n<b></b></r>", "<r></r>", "<r><a>1</a><a>2</a></r>", "<r><a>&lt;</a></r>", "<r>t<a>1</a></r>", "<r><a>1\r\n2</a></r>",
            "<r><a>]]&gt;</a></r>", "<r><a k='1'>é</a></r>", "<r> <a>é </a> </r>"]
)
def test_flat_elements_as_the_parser_has_them(monkeypatch, xml):
    quick = records.element_items(xml)
    monkeypatch.setattr(records, "_FLAT", re.compile("(?!)"))
    assert list(quick.items()) == list(records.element_items(xml).items())


@pytest.mark.parametrize("xml", ["<r><a>]]></a></r>", "<r><a>\x01</a></r>", "<r><1>x</1></r>", "<r><a>x</b></r>", "<r><a>&no;</a></r>"])
def test_flat_elements_that_are_not_well_formed(xml):
    with pytest.raises(records.expat.ExpatError):
        records.element_items(xml)


def test_records_are_parsed_once(spark, tmp_path):
    """Numbering reads the stored records: no parser is left in the plan of the rows."""
    (tmp_path / "a.xml").write_text("<r>" + "<row><a>1</a></row>" * 20 + "</r>")
    (tmp_path / "b.json").write_text('{"a":"1"}\n{"a":"2"}\n')
    rows = read_rows(spark, list_files(spark, str(tmp_path)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "from_json" not in plan
    got = sorted((r.source_name, r.line_number, r.raw["a"]) for r in rows.collect())
    assert got == [("a.xml", i, "1") for i in range(1, 21)] + [("b.json", 1, "1"), ("b.json", 2, "2")]


def no_tree(_):
    raise records.ElementTree.ParseError


@pytest.mark.parametrize(
    "xml",
    ["<r k='1'> a <q>1</q>b<t>x</t><t k='2'>y</t><n><m>1</m><m/></n><o/></r>", "<r>x</r>", "<r k='a:b'/>", "<r><a>1:2 &lt;</a><!-- c --><a>é<![CDATA[<b>]]></a></r>",
     "<r><a> <b/> t <b> </b></a></r>", "<r><x:a>1</x:a></r>", "<r xmlns='u'><a/><a>1</a></r>", "<r x:k = '1'/>"],
)
def test_trees_as_the_parser_has_them(monkeypatch, xml):
    quick = records.element_items(xml)
    monkeypatch.setattr(records, "_FLAT", re.compile("(?!)"))
    monkeypatch.setattr(records, "_tree_value", no_tree)
    assert list(quick.items()) == list(records.element_items(xml).items())


def test_elements_with_children_are_parsed_as_trees(monkeypatch):
    monkeypatch.setattr(records.expat, "ParserCreate", None)
    assert records.element_items('<r id="1"><n>1</n><n>2</n><i><k>3</k></i></r>') == {"id": "1", "n": '["1","2"]', "i": '{"k":"3"}'}
