from __future__ import annotations

import json
from collections import Counter

from sheetloom.operators import drift


def feed(spark, files, feed_id=1, first_file=1):
    rows = []
    for no, records in enumerate(files, 1):
        for key, payload in records:
            rows.append((feed_id, first_file + no - 1, no, key, payload if payload is None or isinstance(payload, str) else json.dumps(payload), "extra"))
    return spark.createDataFrame(rows, "feed_id bigint, file_id bigint, file_no int, record_key string, payload string, kind string")


def changes(df):
    return Counter((r["file_id"], r["change_kind"], r["old_name"], r["new_name"]) for r in drift.schema_changes(df).collect())


BASE = [(f"k{i}", {"panel": f"P{i}", "ckt": i, "note": "n"}) for i in range(9)]


def test_rename_add_remove_and_type(spark):
    second = [(k, {"board": p["panel"], "ckt": str(p["ckt"]), "extra": [1]}) for k, p in BASE]
    third = [(k, {"board": p["panel"], "circuit": p["ckt"], "extra": {"a": 1}}) for k, p in BASE]
    got = changes(feed(spark, [BASE, second, third]))
    assert got == Counter([
        (2, "renamed", "panel", "board"), (2, "removed", "note", ""), (2, "added", "", "extra"), (2, "type_changed", "ckt", "ckt"),
        (3, "renamed", "ckt", "circuit"), (3, "type_changed", "ckt", "circuit"), (3, "type_changed", "extra", "extra"),
    ])


def test_names_are_case_sensitive_and_fields_come_back(spark):
    second = [(k, {"Panel": p["panel"], "ckt": p["ckt"]}) for k, p in BASE]
    third = [(k, {**p, "panel": p["panel"]}) for k, p in BASE]
    got = changes(feed(spark, [BASE, second, third]))
    assert got == Counter([(2, "renamed", "panel", "Panel"), (2, "removed", "note", ""), (3, "renamed", "Panel", "panel"), (3, "added", "", "note")])


def test_repeated_records_nulls_and_bad_payloads(spark):
    noisy = [*BASE, *BASE, ("k1", None), ("k2", "{bad"), ("k3", "[1]"), ("k4", json.dumps({"panel": None, "ckt": None})), (None, json.dumps({"panel": "P1", "ckt": 1, "note": "n"}))]
    got = changes(feed(spark, [BASE, noisy, [(k, {"panel": None, "ckt": 1, "note": "n"}) for k, _ in BASE]]))
    assert got == Counter()


def test_majority_kind_with_ties(spark):
    one = [("a", {"v": 1}), ("b", {"v": "x"})]  # a tie: number comes first
    two = [("a", {"v": "y"}), ("b", {"v": "x"})]
    assert changes(feed(spark, [one, two])) == Counter([(2, "type_changed", "v", "v")])


def test_feeds_are_apart_and_first_files_have_no_changes(spark):
    a, b = feed(spark, [BASE, BASE]), feed(spark, [[("k0", {"other": 1})]], 2, 10)
    assert changes(a.unionByName(b)) == Counter()


def test_empty(spark):
    df = spark.createDataFrame([], "feed_id bigint, file_id bigint, file_no int, record_key string, payload string")
    assert drift.schema_changes(df).count() == 0


def test_unified_table(spark):
    second = [(k, {"board": p["panel"], "ckt": p["ckt"]}) for k, p in BASE]
    df = feed(spark, [BASE, second])
    x = drift.unified(df, drift.schema_changes(df), ["record_key", "file_id"])
    assert x.where("f_board IS NOT NULL").count() == 18 and "f_panel" not in x.columns
    assert x.where("n_ckt = 3.0").count() == 2


def test_numbers_of_any_length_compare_as_numbers(spark):
    from pyspark.sql import functions as F

    from sheetloom.operators.drift import plain_decimal

    told = ["007", "+7.0", "-0.00", "1" * 60 + ".5000", "0.1234567890123456789", "1e3", "-2.50E0", "x", "", None, "1.", "1,5"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(told)], "i int, t string").select("i", plain_decimal(F.col("t")).alias("n")).orderBy("i").select("n").collect()]
    assert got == ["7", "7", "0", "1" * 60 + ".5", "0.1234567890123456789", "1000", "-2.5", None, None, None, None, None]


def test_chance_renames_do_not_merge_meanings(spark):
    """One feed swaps a name by chance; records of others fill both names, so they stay apart. Clashing aliases of a record are kept."""
    both = [(f"k{i}", {"panel": f"P{i}", "tag": f"T{i}", "note": "n"}) for i in range(9)]
    moved = [(k, {"board": p["panel"], "tag": p["tag"], "note": "n"}) for k, p in both]
    chance = [(k, {"panel": p["panel"], "note": "n"}) for k, p in both], [(k, {"tag": p["panel"], "note": "n"}) for k, p in both]
    clash = [("z", {"board": "B", "panel": "P", "note": "n"})]
    df = feed(spark, [both, moved]).unionByName(feed(spark, [both, moved], 2, 10)).unionByName(feed(spark, [*chance], 3, 20))
    x = drift.unified(df, drift.schema_changes(df), ["record_key"])
    assert {c for c in x.columns if c.startswith("f_")} == {"f_panel", "f_tag", "f_note"} and x.where("size(left_over) > 0").count() == 0
    y = drift.unified(feed(spark, [clash]), drift.schema_changes(feed(spark, [both, moved])), ["record_key"])
    assert "f_board" in y.columns and "f_panel" in y.columns  # a record that fills both speaks against the rename
