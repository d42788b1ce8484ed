import json
import zipfile

import pytest
from pyspark.errors import PythonException

from cairn.sources import engine, readers, sinks


def test_staged_csv_pads_and_keeps_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,v,w\n1,"say ""hi""",x\n02,,\n3,"a\nb"\n', encoding="utf-8")
    df = readers.read_staged_csv(spark, str(tmp_path / "a.csv"))
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("02", None, None), ("1", 'say "hi"', "x"), ("3", "a\nb", None)]
    assert readers.read_staged_csv(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0


def test_zipped_member_and_schema_guard(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("data_1.tsv", "A \tB\n01\tx\n")
        z.writestr("readme.txt", "no")
    assert [tuple(r) for r in readers.read_zipped(spark, str(tmp_path / "d.zip"), r"data.*\.tsv", "\t", ["A", "B"]).collect()] == [("01", "x")]
    with pytest.raises(PythonException, match="no column"):
        readers.read_zipped(spark, str(tmp_path / "d.zip"), r"data.*\.tsv", "\t", ["C"]).collect()


def test_workbook(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Plants" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="t" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Name</t></si><si><t>MW</t></si><si><t>Sun</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>note</t></is></c></row><row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c></row><row r="3"><c r="A3" t="s"><v>2</v></c><c r="C3"><v>4.5</v></c></row></sheetData></worksheet>')
    assert [tuple(r) for r in readers.read_workbook(spark, str(tmp_path / "w.xlsx"), "Plants", ["MW", "Name"], "Name").collect()] == [("4.5", "Sun")]


def test_tokens_json_and_tables(spark, tmp_path):
    (tmp_path / "t.txt").write_text(" 01 001  x 5\n\n02 003 y 6\n")
    assert [tuple(r) for r in readers.read_tokens(spark, str(tmp_path / "t.txt"), {"st": 0, "v": 3}).collect()] == [("01", "5"), ("02", "6")]
    (tmp_path / "p.json").write_text(json.dumps({"results": [{"id": 1, "name": "a"}]}))
    assert readers.read_json_pages(spark, str(tmp_path / "p.json"), "results", "id int, name string").first().name == "a"
    df = spark.createDataFrame([('["a","b"]',), ("bad",), (None,)], "s string")
    assert [r.s for r in readers.json_list(df, "s").collect()] == [["a", "b"], [], []]
    page = spark.createDataFrame([(1, "<h2>Open</h2><table><tr><th>A<td> b  c</tr></table>")], "k int, h string")
    assert [tuple(r) for r in readers.html_tables(page, "k", "h").collect()] == [(1, "Open", 0, ["A", "b c"])]


def test_topology(spark, tmp_path):
    topology = {"type": "Topology", "transform": {"scale": [2.0, 2.0], "translate": [10.0, 0.0]}, "arcs": [[[0, 0], [1, 0], [0, 1]], [[1, 1], [-1, 0], [0, -1]]], "objects": {"counties": {"type": "GeometryCollection", "geometries": [{"id": "01", "type": "Polygon", "arcs": [[0, 1]]}, {"id": "02", "type": "Polygon", "arcs": [[-1]]}]}}}
    (tmp_path / "t.json").write_text(json.dumps(topology))
    rings = readers.topology_rings(spark, str(tmp_path / "t.json"), "counties")
    assert [(r.x, r.y) for r in rings.where("id = '01'").orderBy("n").collect()] == [(10.0, 0.0), (12.0, 0.0), (12.0, 2.0), (10.0, 2.0), (10.0, 0.0)]
    assert [(r.x, r.y) for r in rings.where("id = '02'").orderBy("n").collect()] == [(12.0, 2.0), (12.0, 0.0), (10.0, 0.0)]


def test_publish_gate_and_console(spark, tmp_path):
    folder = str(tmp_path / "pub")
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, v string")
    manifest = sinks.publish({"items": df}, folder, gates=[df.where("id > 5")])
    assert manifest.first().rows == 2
    with pytest.raises(sinks.GateFailed):
        sinks.publish({"items": df.where("id = 1")}, folder, gates=[df])
    console = engine.Engine(spark, folder)
    assert console.relations == ["items"]
    assert console.shown("SELECT squash(v) AS v FROM items ORDER BY id").collect()[0].v == "a"
    sinks.publish({"items": df.where("id = 1")}, folder)
    assert spark.read.parquet(f"{folder}/items.parquet").count() == 1


def test_a_failed_move_leaves_the_old_edition(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "pub")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    sinks.publish({"items": df}, folder)
    real = sinks._fs

    class Stuck:
        """A file system that can't move a new edition in."""

        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            return False if ".staging-" in a.getName() and not a.getName().endswith(".old") else self.fs.rename(a, b)

    monkeypatch.setattr(sinks, "_fs", lambda spark, path: (real(spark, path)[0], Stuck(real(spark, path)[1])))
    with pytest.raises(OSError, match="could not be replaced"):
        sinks.publish({"items": df.where("id = 1")}, folder)
    assert spark.read.parquet(f"{folder}/items.parquet").count() == 2


def test_other_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", "x"), (1, None, "y")], "id int, v string, st string")
    assert sinks.row_hash(df) == sinks.row_hash(df.orderBy("id").repartition(3))
    assert sinks.columns_and_rows(df.orderBy("id"))["rows"][0] == [1, None, "y"]
    sinks.write_partitions(df, str(tmp_path / "st"), "st")
    sinks.write_partitions(df.where("st = 'x'"), str(tmp_path / "st"), "st")
    assert spark.read.json(str(tmp_path / "st")).count() == 2
    sinks.append_rows(df, str(tmp_path / "ap"))
    sinks.append_rows(df.withColumnRenamed("v", "w"), str(tmp_path / "ap"))
    assert set(sinks.read_appended(spark, str(tmp_path / "ap")).columns) == {"id", "v", "w", "st"}
    assert sinks.ordered_columns(df, ["st"]).columns == ["st", "id", "v"]
    types = {r.field: r.type for r in sinks.inferred_types(spark.createDataFrame([("1", "2024-01-01", "x"), ("", "2024-02-01", "2.5")], "a string, b string, c string")).collect()}
    assert types == {"a": "integer", "b": "date", "c": "string"}
    assert sinks.record_index({"a": (df, "id", "st"), "b": (df, "v", "st")}).count() == 4


def test_requests_and_feed(spark):
    registry = spark.createDataFrame([("a", "http://x/{st}?p={p}", [{"st": "va", "p": "1"}, {"st": "md", "p": "2"}]), ("b", "http://y", None)], "source_id string, url string, params array<map<string,string>>")
    assert sorted(r.url for r in readers.expand_requests(registry).collect()) == ["http://x/md?p=2", "http://x/va?p=1", "http://y"]
    feed = spark.createDataFrame([(1, "h1"), (1, "h2"), (2, "h1")], "id int, hash string")
    assert [(r.id, r.hash) for r in readers.unseen(feed, feed.where("hash = 'h1'"), ["id", "hash"]).collect()] == [(1, "h2")]


def test_the_package_is_shipped_once(spark):
    import subprocess
    import sys

    engine.ship(spark)
    engine.ship(spark)
    shipped = [f for f in spark.sparkContext._python_includes if f == "cairn.zip"]
    assert len(shipped) == 1
    path = next(f for f in spark.sparkContext.listFiles if f.endswith("cairn.zip"))
    assert path
    code = "import sys; sys.path.insert(0, sys.argv[1]); import cairn.operators.similar, cairn; print(cairn.__file__)"
    from pyspark import SparkFiles

    out = subprocess.run([sys.executable, "-c", code, SparkFiles.get("cairn.zip")], capture_output=True, text=True, cwd="/", env={})
    assert "cairn.zip" in out.stdout, out.stderr
