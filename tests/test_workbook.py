"""Workbooks written and read again; files of other programs; what a failed job leaves."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from fundlake.sources import workbook

ROWS = "id long, name string, amount double, ok boolean"


@pytest.fixture(scope="module", autouse=True)
def known(spark):
    workbook.register(spark)


def read(spark, path, schema=ROWS, **options):
    return spark.read.format("workbook").options(**options).schema(schema).load(str(path))


def test_round_trip(spark, tmp_path):
    rows = [(i, None if i % 7 == 0 else f"näam <{i}> & \"x\" \U0001f600\n", None if i % 5 == 0 else i / 3, None if i % 3 == 0 else i % 2 == 0) for i in range(500)] + [(1 << 62, "  a  ", 1e300, True), (None, "\x01b", -0.5, False)]
    path = f"file://{tmp_path}/book"
    spark.createDataFrame(rows, ROWS).repartition(4).write.format("workbook").option("sheet", "Fondsen & <meer>").mode("append").save(path)
    expected = sorted(rows[:-1] + [(None, "b", -0.5, False)], key=str)
    got = read(spark, path)
    assert got.rdd.getNumPartitions() == 4  # one a file and sheet
    assert sorted(map(tuple, got.collect()), key=str) == expected
    assert read(spark, path, sheet="Fondsen & <meer>").count() == 502 and read(spark, path, sheet="andere").count() == 0
    assert spark.read.format("workbook").load(path).columns == ["id", "name", "amount", "ok"]


def test_append_and_overwrite(spark, tmp_path):
    path, rows = str(tmp_path / "b"), lambda *ids: spark.createDataFrame([(i, "x", 1.0, True) for i in ids], ROWS)
    for mode, ids in (("append", (1, 2)), ("append", (3,))):
        rows(*ids).write.format("workbook").mode(mode).save(path)
    assert sorted(r.id for r in read(spark, path).collect()) == [1, 2, 3]
    rows(4).write.format("workbook").mode("overwrite").save(path)
    assert [r.id for r in read(spark, path).collect()] == [4]
    rows().write.format("workbook").mode("overwrite").save(path)
    assert read(spark, path).collect() == []


def test_long_tables_take_several_sheets(spark, tmp_path):
    path = str(tmp_path / "b")
    spark.range(25).coalesce(1).write.format("workbook").option("rows", 11).option("sheet", "s").mode("append").save(path)
    (file,) = workbook.files(path, ".xlsx")
    assert [n for n, _ in workbook._sheets(file)] == ["s 1", "s 2", "s 3"]
    assert sorted(r.id for r in read(spark, path, "id long").collect()) == list(range(25))
    assert read(spark, path, "id long").rdd.getNumPartitions() == 3


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "b")
    bad = spark.range(100).repartition(2).select(F.when(F.col("id") == 50, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")).alias("x"))
    with pytest.raises(Exception, match="no"):
        bad.write.format("workbook").mode("append").save(path)
    assert not os.path.isdir(path) or [f for _, _, names in os.walk(path) for f in names] == []


def test_files_of_other_programs(spark, tmp_path):
    """Shared strings, missing cells, cells by place, two header rows."""
    main = workbook._MAIN[1:-1]
    with zipfile.ZipFile(tmp_path / "o.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{workbook._LINK[1:-1]}"><sheets><sheet name="A" sheetId="1" r:id="x9"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="u"><Relationship Id="x9" Target="/xl/worksheets/one.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>kop</t></si><si><r><t>twee </t></r><r><t>delen</t></r></si></sst>')
        z.writestr("xl/worksheets/one.xml", f'<worksheet xmlns="{main}"><sheetData><row><c r="A1" t="s"><v>0</v></c></row><row><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>0</v></c></row><row><c r="B3" t="s"><v>1</v></c><c r="AA3"><v>7</v></c></row><row/><row><c r="A5"><v>1.0</v></c><c r="B5"><v>3</v></c><c r="C5" t="str"><v>geen getal</v></c></row></sheetData></worksheet>')
    got = read(spark, tmp_path / "o.xlsx", "a long, b string, c double", header=2).collect()
    assert [tuple(r) for r in got] == [(None, "twee delen", None), (None, None, None), (1, "3", None)]


def test_paragraphs(spark, tmp_path):
    w = workbook._WORD[1:-1]
    p = lambda *texts: "<w:p>" + "".join(f"<w:r><w:t>{t}</w:t></w:r>" for t in texts) + "</w:p>"
    body = p("Fondsen ", "in 2024") + f"<w:tbl><w:tr><w:tc>{p('Naam')}</w:tc><w:tc>{p('A', 'B')}</w:tc></w:tr><w:tr><w:tc>{p('x')}</w:tc><w:tc/></w:tr></w:tbl>" + p() + p("slot")
    for name in ("a.docx", "b.docx", "~tijdelijk.docx"):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>')
    got = spark.read.format("paragraphs").load(str(tmp_path))
    assert got.rdd.getNumPartitions() == 2
    assert [r.text for r in got.where("file = 'a.docx'").orderBy("n").collect()] == ["Fondsen in 2024", "Naam\tAB", "x\t", "", "slot"]
