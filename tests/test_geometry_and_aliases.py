from __future__ import annotations

import random

from pyspark.sql import functions as F

from sheetloom.functions.aliases import CIRCUIT_ALIASES, LOAD_ALIASES, circuit_record, normalised, pipe_size
from sheetloom.operators import geometry as G


def test_words_to_lines(spark):
    words = [(1, 3, 0, 0, 30.0, 10.0, 40.0, 20.0, "20"), (1, 1, 0, 0, 10.0, 11.0, 20.0, 19.0, "Panel"), (1, 2, 0, 1, 5.0, 30.0, 9.0, 40.0, " "), (2, 1, 0, 0, 1.0, 1.0, 2.0, 2.0, "x")]
    df = spark.createDataFrame(words, "page_id int, seq int, block int, line int, x0 double, y0 double, x1 double, y1 double, text string")
    got = {(r["page_id"], r["text"]): (r["x0"], r["y0"], r["x1"], r["y1"], r["cx"]) for r in G.words_to_lines(df).collect()}
    assert got == {(1, "Panel 20"): (10.0, 10.0, 40.0, 20.0, 25.0), (2, "x"): (1.0, 1.0, 2.0, 2.0, 1.5)}


def test_panel_of_each_line_is_the_nearest_header_above(spark):
    rng = random.Random(4)
    headers = [(p, i, f"P{i}", rng.uniform(0, 600), rng.uniform(0, 400)) for p in range(3) for i in range(5)] + [(0, 9, "twin", 50.0, 50.0), (0, 10, "twin2", 50.0, 50.0)]
    lines = [(p, f"{p}-{i} Pump 20 A 540 VA", rng.uniform(0, 600), rng.uniform(-50, 800)) for p in range(4) for i in range(40)] + [(0, "t 20A SPARE", 50.0, 52.0), (0, "no load 20 A", 50.0, 60.0)]
    want = set()
    for page, text, cx, cy in lines:
        above = [(max(0, cy - h[4]) ** 2 + ((cx - h[3]) / 2) ** 2, h[1], h[2]) for h in headers if h[0] == page and cy >= h[4] - 5]
        if above and "no load" not in text:
            want.add((text, min(above)[2]))
    h = spark.createDataFrame(headers, "page_id int, ordinal int, panel_id string, cx double, cy double")
    x = spark.createDataFrame(lines, "page_id int, text string, cx double, cy double")
    got = {(r["text"], r["panel_id"]) for r in G.assign_panels(x, h).collect()}
    assert got == want and ("t 20A SPARE", "twin") in got


def test_rows_are_measured_from_their_first_anchor(spark):
    df = spark.createDataFrame([(1, "a", 5, 0), (1, "b", 1, 200), (1, "c", 9, 400), (1, "d", 2, 500), (2, "e", 0, 900)], "page_id int, name string, x0 int, y0 int")
    rows = {r["name"]: r["row_no"] for r in G.group_rows(df).collect()}
    assert rows == {"a": 0, "b": 0, "c": 1, "d": 1, "e": 0}
    bounds = {r["name"]: (r["left"], r["right"]) for r in G.column_bounds(G.group_rows(df), 100.0).collect()}
    assert bounds["b"] == (0.0, 3.0) and bounds["a"] == (3.0, 100.0) and bounds["e"] == (0.0, 100.0)


def test_nearest_column_and_circuit_number(spark):
    df = spark.createDataFrame([(8.0, 12.0, "7 Pump 20 A 540 VA"), (40.0, 60.0, "20A"), (200.0, 210.0, None)], "x0 double, x1 double, text string")
    assert [r["column_name"] for r in G.nearest_column(df, {"ckt": 10.0, "load": 60.0, "also": 40.0}).collect()] == ["ckt", "load", None]
    assert [r[0] for r in df.select(G.circuit_number(F.col("text"))).collect()] == [7, None, None]
    box = G.normalised_box({k: F.lit(v) for k, v in (("x0", 1.0), ("y0", 1.0), ("x1", 2.0), ("y1", 3.0))}, F.lit(3.0), F.lit(4.0))
    assert tuple(spark.range(1).select(box.alias("b")).first()["b"]) == (0.333333, 0.25, 0.666667, 0.75)


def test_aliases(spark):
    entries = [{"CKT": "5", "Description": " Pump ", "amps": "", "breaker": "20A", "circuit_no": "4"}, {"phase a": "540", "Va_Phase_A": None}, {}, None]
    df = spark.createDataFrame([(i, e) for i, e in enumerate(entries)], "i int, e map<string,string>")
    table = CIRCUIT_ALIASES | {"va_phase_a": LOAD_ALIASES["va_phase_a"]}
    got = [tuple(r["n"]) for r in df.select("i", normalised(F.col("e"), table).alias("n")).orderBy("i").collect()]
    assert got == [("4", "Pump", "20A", None, None), (None, None, None, None, "540"), (None,) * 5, (None,) * 5]
    last = df.where("i = 0").select(normalised(F.col("e"), table, last_wins=True).alias("n")).first()["n"]
    assert last["circuit"] == "5"
    full = df.select(circuit_record(F.create_map(F.lit("#"), F.lit("3"), F.lit("p"), F.lit("3 P"), F.lit("phase_1_load"), F.lit("1,540.5 VA"), F.lit("Demand"), F.lit("9 kVA"))).alias("c")).first()["c"]
    assert tuple(full) == ("3", None, None, 3, 1540.5, None, None, 9.0)
    sizes = [(t,) for t in ('1-1/2"', "3 inch", "none", None)]
    assert [r[0] for r in spark.createDataFrame(sizes, "t string").select(pipe_size(F.col("t"))).collect()] == [0.5, 3.0, None, None]
