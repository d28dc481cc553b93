from __future__ import annotations

import math

from sheetloom.operators import units

CEILINGS = [
    ("9'-6\"", None, 28956, "told"), ("9'-6 1/2\"", None, 29083, "told"), ("12' 9\" AFF", None, 38862, "told"), ("11′-1″", None, 33782, "told"),
    ("8 ft 11 in", None, 27178, "told"), ("8.75 FT.", None, 26670, "told"), ("132", "Heights in inches.", 33528, "stated"), ("2695 mm", None, 26950, "told"),
    ("3,360mm", None, 33600, "told"), ("4,47 m", None, 44700, "told"), ("330.5 cm", None, 33050, "told"), ("91 1/2\"", None, 23241, "told"),
    ("3.32", "Dimensions in meters unless noted.", 33200, "stated"), ("2500", "All dimensions are in millimetres.", 25000, "stated"),
    ("112", "Hold the grille 51 inches clear of the fan coil.", 28448, "inferred"), ("VARIES", None, None, None), ("", None, None, None), (None, "Heights in mm.", None, None), ("0", "Heights in mm.", None, None),
]
AREAS = [
    ("4893", None, 4893, "default"), ("1,488 SF", None, 1488, "told"), ("260,6 m²", None, 2805, "told"), ("62 sq yd", None, 558, "told"), ("100", "Room area was measured in square meters.", 1076, "stated"),
    ("151.6", "Area recorded in m2.", 1632, "stated"), ("SEE PLAN", None, None, None),
]
LOADS = [
    ("19.13", "S1 ckt 2", 19130), ("36,890", "x; load listed in VA", 36890), ("50", "x (connected load, VA)", 50), ("0.01664 MVA", None, 16640), ("32,82 kVA", None, 32820), ("19800va", None, 19800), ("5.39 kilovolt-amperes", None, 5390),
    ("8,480 VA", None, 8480), ("29730", "x; VA load per schedule head", 29730), ("12.5", "VAV-02: grille", 12500), ("N/A", None, None),
]
CURRENTS = [
    ("20A/2P", None, 20000), ("400", None, 400000), ("15 amp. trip", None, 15000), ("225 AMPS", None, 225000), ("20AT", None, 20000), ("0.225 kA", None, 225000), ("1,200,000 mA", None, 1200000), ("360", "x (current column: mA)", 360),
    ("450", "x; standby current listed in milliamps", 450), ("60.5 A", None, 60500), ("-", None, None),
]


def solve(spark, rows, q, columns):
    df = spark.createDataFrame([(i, *r[:2], "dup") for i, r in enumerate(rows)], f"id int, {columns} , unit string")
    return {r["id"]: r for r in units.resolve_units(df, [q]).collect()}


def test_ceilings(spark):
    got = solve(spark, CEILINGS, units.CEILING_HEIGHT, "ceiling_height string, note string")
    for i, (value, note, want, basis) in enumerate(CEILINGS):
        val = got[i]["ceiling_val"]
        assert (val is None if want is None else abs(val - want) < 0.6), (value, note, val)
        assert got[i]["ceiling_basis"] == basis, (value, note)


def test_areas(spark):
    got = solve(spark, AREAS, units.ROOM_AREA, "square_footage string, note string")
    for i, (value, _, want, basis) in enumerate(AREAS):
        assert (got[i]["area_val"] is None if want is None else round(got[i]["area_val"]) == want), value
        assert got[i]["area_basis"] == basis


def test_loads_and_currents(spark):
    for rows, q, column, name in ((LOADS, units.LOAD, "kva", "kva"), (CURRENTS, units.CURRENT, "amps", "amps")):
        got = solve(spark, rows, q, f"{column} string, content string")
        for i, (value, _, want) in enumerate(rows):
            val = got[i][f"{name}_val"]
            assert (val is None if want is None else round(val) == want), (value, val)


def test_identity_settles_an_open_unit(spark):
    """Areas without a unit are square feet or square metres; length times width tells which."""
    rows = [(10.0 + i, 12.0, f"{(10 + i) * 12.0} sq ft") for i in range(30)]
    rows += [(20.0, 30.0, "600"), (20.0, 30.0, f"{600 * 0.09290304:.2f}"), (None, 30.0, "55.7")]
    df = spark.createDataFrame([(i, *r, "") for i, r in enumerate(rows)], "id int, l double, w double, a string, note string")
    area = units.Quantity("area", "a", "note", units.AREA)
    got = {r["id"]: r for r in units.resolve_units(df, [area], [units.Identity({"area": 1, "l": -1, "w": -1})], ["l", "w"]).collect()}
    assert got[30]["area_unit"] == "sqft" and got[30]["area_unique"]
    assert got[31]["area_unit"] == "sqm" and math.isclose(got[31]["area_val"], 600, rel_tol=1e-3)


def test_empty_table(spark):
    df = spark.createDataFrame([], "kva string, amps string, content string")
    assert units.resolve_units(df, [units.LOAD, units.CURRENT]).count() == 0


def test_identity_of_load_and_current_settles_units(spark):
    """Loads at 120 or 208 V: the current tells whether a comma groups thousands, and in which unit a bare load is."""
    from sheetloom.operators.units import CURRENT, KVA, Identity, Quantity, resolve_units

    rows = [(i, f"{0.12 * a * (1 + i % 5 / 100):.3f} kVA", f"{a} A", 1.0) for i, a in enumerate([5, 10, 20, 40, 80, 160] * 20)]
    asked = [(900, "1,200", "10 A", 1.0), (901, "1,200", "10000 A", 1.0), (902, "2,400 kVA", "20 A", 1.0), (903, None, "20 A", 1.0), (904, "1,200", None, None)]
    df = spark.createDataFrame(rows + asked, "row_id int, kva string, amps string, phases double")
    open_load = Quantity("kva", "kva", None, KVA)
    got = {r["row_id"]: (r["kva_val"], r["kva_unit"]) for r in resolve_units(df, [open_load, CURRENT.__class__("amps", "amps", None, CURRENT.units, "", "a")], [Identity({"kva": 1, "amps": -1, "phases": -1})], ["phases"]).where("row_id >= 900").collect()}
    assert got[900] in {(1200.0, "kva"), (1200.0, "va")} and got[901][0] == 1.2e6 and got[902] == (2400.0, "kva") and got[903] == (None, None)


def test_identity_that_rows_do_not_bear_out_is_left_out(spark):
    """Loads and currents that have nothing to do with each other: readings rest on usual magnitudes."""
    import random

    from sheetloom.operators.units import CURRENT, LOAD, Identity, resolve_units

    rng = random.Random(4)
    rows = [(i, f"{rng.uniform(1, 40):.2f} kVA", f"{rng.choice([15, 20, 30, 400, 800])} A", "x", 1.0) for i in range(300)] + [(900, "9,310", "20 A", "loads in VA", 1.0)]
    df = spark.createDataFrame(rows, "row_id int, kva string, amps string, content string, phases double")
    plain = resolve_units(df, [LOAD, CURRENT]).where("row_id = 900").select("kva_val").first()[0]
    assert resolve_units(df, [LOAD, CURRENT], [Identity({"kva": 1, "amps": -1, "phases": -1})], ["phases"]).where("row_id = 900").select("kva_val").first()[0] == plain == 9310.0
