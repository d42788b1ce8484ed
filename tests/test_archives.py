import gzip
import zipfile

import pytest
from pyspark.errors import PySparkException

from cairn.sources import archives
from cairn.sources.archives import read_archives


def pack(path, **members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name.replace("_csv", ".csv"), text)


def test_each_member_is_a_partition(spark, tmp_path):
    pack(tmp_path / "a.zip", d1_csv="﻿A,B\n1,x\n2\n\n,\n", d2_csv="B,C,A\ny,z,3\n", readme="no")
    pack(tmp_path / "b.zip", d3_csv='A,B\n4,"say ""hi"", twice"\n')
    df = read_archives(spark, str(tmp_path), member=r"d\d\.csv")
    assert df.columns == ["A", "B", "source_file", "source_member"] and df.rdd.getNumPartitions() == 3
    assert sorted((r.A, r.B, r.source_member) for r in df.collect()) == [("1", "x", "d1.csv"), ("2", None, "d1.csv"), ("3", "y", "d2.csv"), ("4", 'say "hi", twice', "d3.csv")]
    assert read_archives(spark, str(tmp_path / "b*.zip"), member=r"d\d\.csv", columns=["B"]).count() == 1
    assert read_archives(spark, f"file://{tmp_path}/b.zip", member=r"d3\.csv").first().A == "4"


@pytest.mark.parametrize(
    ("options", "said"),
    [
        ({"member": r"d\d\.csv", "columns": ["A", "Z"]}, r"d1\.csv: no column \['Z'\]"),
        ({"member": r"d\d\.csv", "columns": ["A"], "exact": True}, "header is"),
        ({"member": r"d\d\.csv", "one": True}, "2 members match"),
        ({"member": "none"}, "0 members match"),
        ({"member": r"d1\.csv", "header": "Q"}, "no header row with Q"),
    ],
)
def test_the_guard_comes_before_any_read(spark, tmp_path, options, said):
    pack(tmp_path / "a.zip", d1_csv="A,B\n1,x\n", d2_csv="A,B\n2,y\n")
    with pytest.raises(PySparkException, match=said):
        read_archives(spark, str(tmp_path), **options)  # load() alone asks for the schema


def test_not_an_archive_and_unknown_values(spark, tmp_path):
    (tmp_path / "a.zip").write_text("<html>")
    with pytest.raises(PySparkException, match="not an archive"):
        read_archives(spark, str(tmp_path), member=".*")
    pack(tmp_path / "a.zip", d_csv="K,V\na,1\nb,2\n,3\n")
    assert read_archives(spark, str(tmp_path), member=r"d\.csv", vocabulary={"K": ["a", "b"]}).count() == 3
    with pytest.raises(PySparkException, match=r"unknown K \['b'\]"):
        read_archives(spark, str(tmp_path), member=r"d\.csv", vocabulary={"K": ["a"]}).collect()


def test_sheets_by_name_with_header_search_and_disclaimer(spark, tmp_path):
    rows = spark.createDataFrame([("w.xlsx", "Planned", "1", "a & <b>"), ("w.xlsx", "Planned", "2", None), ("w.xlsx", "Retired", "3", "c"), ("w.xlsx", "Notes", "9", "x")], "file string, sheet string, id string, name string")
    archives.write_workbooks(rows, str(tmp_path), "file", "sheet", ["id", "name"], title="The data are provided as is")
    for how in ({"header": "name"}, {"disclaimer": "The data"}):
        df = read_archives(spark, str(tmp_path), sheet="Planned|Retired", columns=["name", "id"], **how)
        assert df.rdd.getNumPartitions() == 2
        assert sorted((r.source_member, r.id, r.name) for r in df.collect()) == [("Planned", "1", "a & <b>"), ("Planned", "2", ""), ("Retired", "3", "c")]


def test_shared_strings_and_gaps(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="x"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="x" Type="t" Target="/xl/worksheets/one.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Name</t></si><si><r><t>M</t></r><r><t>W</t></r></si></sst>")
        z.writestr("xl/worksheets/one.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="AB1" t="s"><v>1</v></c></row><row r="5"><c r="AB5"><v>4.5</v></c></row></sheetData></worksheet>')
    assert [tuple(r)[:2] for r in read_archives(spark, str(tmp_path), sheet="S", columns=["Name", "MW"]).collect()] == [("", "4.5")]


def test_gzip_or_plain(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A|B\n1|x\n")
    (tmp_path / "b.csv").write_bytes(gzip.compress(b"A|B\n2|y\n"))
    (tmp_path / "_SUCCESS").write_text("")
    assert sorted(tuple(r)[:2] for r in read_archives(spark, str(tmp_path), sep="|").collect()) == [("1", "x"), ("2", "y")]
    (tmp_path / "none").mkdir()
    assert read_archives(spark, str(tmp_path / "none"), columns=["A"]).count() == 0
    with pytest.raises(PySparkException, match="no columns known"):
        read_archives(spark, str(tmp_path / "none"))
