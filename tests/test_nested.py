from __future__ import annotations

import json

from sheetloom.operators import nested


def brute(value, path="", item=""):
    """Array items that are objects, by plain recursion."""
    out = []
    children = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    for k, v in children:
        at = f"{path}/{str(k).replace('~', '~0').replace('/', '~1')}"
        inside = item
        if isinstance(value, list) and isinstance(v, dict):
            out.append((at, item))
            inside = at
        out += brute(v, at, inside)
    return out


TEXTS = [
    {"a": [{"b": [{"c": 1}, {"d": [[{"e": 2}], 3]}]}, 5, None], "x/y~z": [{"q": {}}], "": [{"n": None}]},
    [{"rows": [["a", "b"], ["c"]], "box": {"x": 1}}, {"rows": [{"cells": [{"t": "é"}]}]}],
    {}, [], {"tree": {"tree": {"tree": [{"leaf": 1}]}}}, {"deep": [[[[{"v": 1}]]]]},
]


def flat(df, **how):
    return nested.flat_rows(df, "id", "t", nested.schema_graph(df, "t"), **how)


def test_items_and_parents(spark):
    rows = [(i, json.dumps(t), "x") for i, t in enumerate(TEXTS)] + [(90, None, "x"), (91, "", "x"), (92, "{broken", "x"), (93, "[" * 5000, "x"), (94, "17", "x"), (0, json.dumps(TEXTS[0]), "again")]
    df = spark.createDataFrame(rows, "id bigint, t string, obj_path string")
    want = sorted((i, *x) for i, t in [*enumerate(TEXTS), (0, TEXTS[0])] for x in brute(t))
    for held in (100, 1):
        got = [tuple(r) for r in flat(df, held=held).where("is_item").select("rec_id", "obj_path", "item_path").collect()]
        assert sorted(got) == want


def test_many_items_in_one_record_and_deep_ones(spark):
    deep = "0"
    for i in range(400):
        deep = f'{{"k{i}": {{"v": 1, "w": {deep}}}}}'
    df = spark.createDataFrame([(1, json.dumps({"r": [{"i": i} for i in range(9000)]})), (2, deep)], "id bigint, t string")
    assert flat(df).where("is_item").count() == 9000
    assert flat(df).where("rec_id = 2").agg({"cells": "count"}).first()[0] >= 400


def test_shared_inlining(spark):
    texts = [{"meta": {"title": "T", "rev": {"no": 1}}, "panels": [{"name": "P", "loads": {"A": 1}, "circuits": [{"no": 1, "side": {"no": 2}, "tags": ["x", {"y": 1}]}]}], "spare": {"loads": {"A": 3}}}]
    df = spark.createDataFrame([(7, json.dumps(t)) for t in texts], "id bigint, t string")
    graph = {r["tag"]: r for r in nested.schema_graph(df, "t").collect()}
    assert graph["panels"]["is_table"] and graph["circuits"]["is_table"] and not graph["meta"]["is_table"]
    assert graph["loads"]["is_table"] and graph["loads"]["n_parents"] == 2  # shared by panels and spare
    for held in (100, 2):
        rows = {(r["table_name"], r["obj_path"]): r for r in flat(df, held=held).collect()}
        assert rows["record", ""]["cells"] == {"meta.title": "T", "meta.rev.no": "1"}
        assert rows["circuits", "/panels/0/circuits/0"]["cells"] == {"no": "1", "side.no": "2", "tags": '["x",{"y":1}]'}
        assert rows["circuits", "/panels/0/circuits/0"]["parent_path"] == "/panels/0"
        assert rows["loads", "/spare/loads"]["parent_table"] == "record" and rows["loads", "/spare/loads"]["item_path"] == ""
    one = nested.flat_table(flat(df), "circuits", ["no", "missing"]).first()
    assert (one["c_no"], one["c_missing"], one["parent_path"]) == ("1", None, "/panels/0")


def test_recursive_elements_are_tables(spark):
    df = spark.createDataFrame([(1, json.dumps({"part": {"id": 1, "part": {"id": 2}}}))], "id bigint, t string")
    rows = {r["obj_path"]: r for r in flat(df).where("table_name = 'part'").collect()}
    assert rows["/part/part"]["parent_path"] == "/part" and rows["/part"]["parent_path"] == ""


def test_empty(spark):
    assert flat(spark.createDataFrame([], "id bigint, t string")).count() == 0
