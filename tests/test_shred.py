import datetime

import pytest
from pyspark.sql import functions as F

from shredline.operators.shred import quarantined, shred, with_virtual_columns
from shredline.sources.records import RECORD, RowRecords


def at():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def rows(spark, xml, **options):
    made = shred(RowRecords([("r", xml, "EGP")]).read(spark), at(), **options)
    return [(r.field_index, r.multi_value_index, r.field_value) for r in made.collect()]


@pytest.mark.parametrize(
    "xml, wanted",
    [
        (None, []),
        ("", []),
        ("   ", []),
        ("<row/>", []),
        ("<row></row>", []),
        ("<other><c1>x</c1></other>", []),
        ("<row><c1>x", []),
        ("<row><c100></c100></row>", [("c100", None, None)]),
        ("<row><c100/></row>", [("c100", None, None)]),
        ('<row><c20 m="">a</c20><c20 m="x">b</c20><c20 m="-1">c</c20><c20 m="2">d</c20></row>', [("c20", None, "a"), ("c20", None, "b"), ("c20", -1, "c"), ("c20", 2, "d")]),
        ('<row><c20 m="2">a</c20><c20 m="2">b</c20></row>', [("c20", 2, "a"), ("c20", 2, "b")]),
        ("<row><c1>0010</c1></row>", [("c1", None, "0010")]),
        ("<row><c1>  x </c1></row>", [("c1", None, "  x ")]),
        ("<row><c1>a&amp;b&lt;&#233;</c1></row>", [("c1", None, "a&b<é")]),
        ("<row><c1><![CDATA[<a>&]]></c1></row>", [("c1", None, "<a>&")]),
        ("<row><zz>1</zz><c1>2</c1></row>", [("zz", None, "1"), ("c1", None, "2")]),
        ("<row><c1>a<b>n</b>z</c1></row>", [("c1", None, "a")]),
        ('<row><c1 other="4">v</c1></row>', [("c1", None, "v")]),
        ("<row><!-- <c9>no</c9> --><c1>v</c1></row>", [("c1", None, "v")]),
        ("<?xml version='1.0'?>\n<row><c1>v</c1></row>", [("c1", None, "v")]),
        ("<row id='1'><c1>حساب</c1></row>", [("c1", None, "حساب")]),
    ],
)
def test_records(spark, xml, wanted):
    assert sorted(map(str, rows(spark, xml))) == sorted(map(str, wanted))


MALFORMED = [
    "<row>a</row><x></row>", '<row id="1" id="2"><c1>a</c1></row>', "<row><c1>a</c1></row><row></row>", "<row><c1>a</c2></row>", "<row><c1>a & b</c1></row>",
    "<row><c1>a]]></c1></row>", "<row><c1>\x01</c1></row>", '<row><c1 m="1" m="2">a</c1></row>', "<row><c1>a</c1></row>tail", "<row><1c>a</1c></row>", '<row a="&x;"><c1>a</c1></row>',
]


def test_very_many_children(spark):
    xml = "<row>" + "".join(f'<c20 m="{k}">v{k}</c20>' for k in range(1, 30_001)) + "</row>"
    made = shred(RowRecords([("r", xml, None)]).read(spark), at())
    assert made.count() == 30_000 and made.where("multi_value_index = 30000").first().field_value == "v30000"


def test_text_around_children_and_namespaces(spark):
    assert rows(spark, "<row>x<c1>a</c1>y<c2>b</c2>z</row>\n") == [("c1", None, "a"), ("c2", None, "b")]
    assert rows(spark, '<row xmlns="u"><c1>a</c1></row>') == []


def test_quarantine(spark):
    records = RowRecords([("a", "<row><c1>", None), ("b", "", None), ("c", None, None), ("d", "<row/>", None), *((str(k), x, None) for k, x in enumerate(MALFORMED))]).read(spark)
    assert sorted(r.recid for r in quarantined(records).collect()) == sorted(["a", "b", *map(str, range(len(MALFORMED)))])
    assert shred(records, at()).count() == 0


def test_overlong_values(spark):
    xml = f"<row><c1>{'x' * 4001}</c1></row>"
    assert len(rows(spark, xml, overlong="truncate")[0][2]) == 4000
    assert len(rows(spark, xml, overlong="keep")[0][2]) == 4001
    with pytest.raises(Exception, match="longer than 4000"):
        rows(spark, xml)


@pytest.mark.parametrize(
    "text, wanted",
    [("20260131", datetime.date(2026, 1, 31)), ("20260230", None), ("2026", None), ("202601311", None), ("", None), ("x", None)],
)
def test_record_date(spark, text, wanted):
    made = shred(RowRecords([("r", f"<row><c167>{text}</c167><c167 m='2'>20200101</c167></row>", None)]).read(spark), at(), with_date=True)
    assert {r.source_updated_date for r in made.collect()} == {wanted}


def test_virtual_columns(spark):
    records = spark.createDataFrame([("r", "<row><c2>65</c2><c2 m='2'>66</c2><c1>x</c1></row>", None)], RECORD)
    made = with_virtual_columns(records).first()
    assert (made.category, made.customer, made.co_code) == (65, None, None)
