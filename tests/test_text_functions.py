from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sheetloom.functions import text as T
from sheetloom.plans.search import bm25, expanded, parse_filter


def apply(spark, f, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[1] for r in df.select("i", f(F.col("v"))).orderBy("i").collect()]


def test_identifiers(spark):
    assert apply(spark, T.key_part, [" A 4/ b__=x ", "--", "", None, "é!"]) == ["A-4-b__=x", "none", "none", "none", "none"]
    assert apply(spark, T.padded_circuit, ["5", " 07 ", "1234", "A1", None, ""]) == ["005", "007", "1234", "A1", None, ""]
    assert apply(spark, T.slug, ["Main  Panel #2", "***", None]) == ["main-panel-2", "general", "general"]
    assert apply(spark, T.drawing_slug, ["E5.00_Panel Schedule Rev 3.pdf", "Rev2.pdf"]) == ["e5-00-panel-schedule", "drawing"]
    assert apply(spark, T.drawing_version, ["E5.00_Rev.B.pdf", "E5.00.pdf", "revision-12"]) == ["vb", "v1", "v12"]
    df = spark.createDataFrame([("a", None, " ", "b c"), (None, "", None, None)], "a string, b string, c string, d string")
    assert [r[0] for r in df.select(T.document_id(*[F.col(c) for c in "abcd"])).collect()] == ["a-b-c", "doc"]


def test_disciplines(spark):
    names = ["x/FA1.0.pdf", "E5.00_PANEL.pdf", "LV1_Horn Strobe.pdf", "LV1.pdf", "Z9.pdf", "", None, "_x", "M2.pdf"]
    assert apply(spark, T.discipline, names) == ["FireAlarm", "Electrical", "FireAlarm", "LowVoltage", "Type_Z9", "General", "General", "General", "Mechanical"]
    assert apply(spark, T.subtype, names) == [None, "PANEL_SCHEDULE", "LOW_VOLTAGE", None, None, None, None, None, None]


def test_numbers(spark):
    assert apply(spark, T.first_integer, ["ckt -12b 3", "none", None, "9" * 30]) == [-12, None, None, None]
    assert apply(spark, T.plain_number, ['1,200 in', '9.5"', "x", None]) == [1200.0, 9.5, None, None]


def test_json_repair(spark):
    texts = ['```json\n{"a": 1}\n```', '{"a": [1, 2,], b: 3}', '{"a": {"b": [1', "plain", None, '{"a": "x"\n "b": 2}', '{"a": [{"b": 1', '[{"a":1', '[{"a": 1}{"a": 2}', '{"see": "x: {y, z: 2}", b: [1,', '{"a": "cut', "", '{"a": 1, "a": 2}']
    got = apply(spark, lambda c: F.to_json(T.safe_json(c)), texts)
    assert got == ['{"a":1}', '{"a":[1,2],"b":3}', '{"a":{"b":[1]}}', None, None, '{"a":"x","b":2}', '{"a":[{"b":1}]}', '[{"a":1}]', '[{"a":1},{"a":2}]', '{"b":[1],"see":"x: {y, z: 2}"}', None, None, '{"a":2}']


def test_schedule_types(spark):
    df = spark.createDataFrame([("panel_schedule", None, None), ("Unit", "Mechanical Schedule", ""), ("door", "", ""), ("x", "DOOR schedule", "")], "t string, n string, s string")
    assert [r[0] for r in df.select(T.schedule_type(F.col("t"), F.col("n"), F.col("s"))).collect()] == ["panel", "unit_plan", "", "door"]


def test_filter_language(spark):
    df = spark.createDataFrame([(1, "O'Hara", 2.5, ("S2",)), (2, None, 1.0, ("S3",)), (3, "x", None, (None,))], "id int, name string, v double, key struct<panel:string>")
    ask = lambda text: [r["id"] for r in df.where(parse_filter(text)).orderBy("id").collect()]
    assert ask("name eq 'O''Hara'") == [1]
    assert ask("v ge 1 and not (key/panel eq 'S2')") == [2]
    assert ask("name eq null or v gt 2.0") == [1, 2]
    assert ask("id eq 1 or id eq 2 and v lt 0.5") == [1]
    for bad in ("", "id", "id eq", "id eq 1 and", "(id eq 1", "id eq 1)", "drop table", "v gt null", "name le null"):
        with pytest.raises(ValueError):
            parse_filter(bad)


def test_bm25_and_synonyms(spark):
    assert expanded("Water heater A4", [(["water heater"], "boiler"), (["vav"], "box")]) == ["water", "heater", "a4", "boiler"]
    df = spark.createDataFrame([(1, "water heater"), (2, "water"), (3, None), (4, "the boiler and much more text about it")], "id int, t string")
    got = [r["id"] for r in bm25(df, "id", "t", ["heater", "water"]).orderBy(F.col("score").desc()).collect()]
    assert got == [1, 2]
    assert bm25(df.limit(0), "id", "t", ["x"]).count() == 0
