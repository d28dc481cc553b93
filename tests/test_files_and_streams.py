from __future__ import annotations

import json

from sheetloom.sources.files import read_json_documents, scan_files, write_json_lines
from sheetloom.streaming.upsert import compact, merge_stream, read_merged


def test_scan_and_json(spark, tmp_path):
    for name in ("a/x.PDF", "a/y.txt", "out/z.pdf", "b/c/w.pdf"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"data")
    got = sorted(r["path"].rsplit("/", 1)[1] for r in scan_files(spark, str(tmp_path), exclude=(str(tmp_path / "out"),)).collect())
    assert got == ["w.pdf", "x.PDF"]
    (tmp_path / "d").mkdir()
    (tmp_path / "d/one_structured.json").write_text('{"b": 1, "a": [2]}')
    (tmp_path / "d/two_structured.json").write_text("{broken")
    docs = {r["text"]: r["doc"] for r in read_json_documents(spark, str(tmp_path / "d")).selectExpr("text", "doc IS NULL AS doc").collect()}
    assert docs == {'{"b": 1, "a": [2]}': False, "{broken": True}
    df = spark.createDataFrame([(1, None, "Ø")], "id int, gone string, raw_json string")
    write_json_lines(df, str(tmp_path / "lines"))
    assert [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "lines")).collect()] == [{"id": 1}]


def test_stream_merges_by_key(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = spark.createDataFrame([], "id string, written_at timestamp, v int").schema
    where = (str(source), schema, str(tmp_path / "table"), str(tmp_path / "ck"))
    (source / "1.json").write_text('{"id": "a", "written_at": "2024-01-01T00:00:00Z", "v": 1}\n{"id": "b", "written_at": "2024-01-01T00:00:00Z", "v": 5}\n')
    merge_stream(spark, *where).awaitTermination()
    (source / "2.json").write_text('{"id": "a", "written_at": "2024-01-01T01:00:00Z", "v": 2}\n{"id": "a", "written_at": "2024-01-01T01:00:00Z", "v": 2}\n')
    merge_stream(spark, *where).awaitTermination()
    now = lambda: sorted((r["id"], r["v"]) for r in read_merged(spark, where[2], schema).collect())
    assert now() == [("a", 2), ("b", 5)]
    # a first delivery that comes days late counts, one that is older than what is there doesn't
    (source / "3.json").write_text('{"id": "c", "written_at": "2023-06-01T00:00:00Z", "v": 7}\n{"id": "b", "written_at": "2023-06-01T00:00:00Z", "v": 1}\n')
    merge_stream(spark, *where).awaitTermination()
    assert now() == [("a", 2), ("b", 5), ("c", 7)]
    compact(spark, where[2], schema)
    assert now() == [("a", 2), ("b", 5), ("c", 7)]
    (source / "4.json").write_text('{"id": "a", "written_at": "2024-02-01T00:00:00Z", "v": 9}\n')
    merge_stream(spark, *where).awaitTermination()
    assert now() == [("a", 9), ("b", 5), ("c", 7)]
    assert read_merged(spark, str(tmp_path / "none"), schema).count() == 0
