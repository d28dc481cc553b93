from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sheetloom.plans import facts

DOCS = [
    {"Electrical": {"PANEL_SCHEDULES": {"S2": {"panel": "inner", "voltage": 120, "circuit_details": [{"circuit_number": "1", "load_name": "Kitchen", "trip": 20, "right_side": {"circuit": 2, "poles": 1}}]}, "A/1 x": {"circuit_details": [], "circuits": [{"CKT": 3}]}, "none": None}}},
    {"ELECTRICAL": {"panel_schedules": [{"name": "L1", "enclosure_info": {"volts": "208"}, "circuits": [{"circuit": "5"}]}, {"panel_id": "L2", "voltage": "", "enclosure_info": {"voltage": 480}, "circuit_details": [{"circuit": "7"}]}]}},
    {"electrical": {"panels": [{"name": "P1", "voltage": "240", "circuits": [{"circuit": "1"}]}], "PANEL_SCHEDULES": {"P2": {"circuits": [{"circuit": "2"}]}}}},
    {"ELECTRICAL": {"panel schedules": {"P3": {"circuits": [{"circuit": "4"}, 5, {"load": "no number"}]}}}},
    {"blocks": [{"type": "x"}], "ELECTRICAL": {"PANEL_SCHEDULES": {"P4": {"circuits": [{"circuit": "1"}]}}}},
    {"ELECTRICAL": {"PANEL_SCHEDULES": "none"}},
    {"ELECTRICAL": {"panels": [{"name": "P5", "circuits": [{"left": {"circuit_number": 9}, "ckt_b": "10", "load_b": "Fan", "phase_loads": {"A": "540 VA", "B": "Surge (spare)"}}]}]}},
    {"Mechanical": {"equipment": {"fans": [{"tag": "EF-1", "voltage": "208", "phase": 3, "hp": 5, "kw": "3.7", "mca": 10, "mop": 15}]}, "EXHAUST_SCHEDULE": {"Fans": [{"DESIG.": "EF-2"}], "other": [{"tag": "no"}]}, "unit_schedule": [{"name": "AHU-1"}]}},
    {"PLUMBING": {"Fixtures": [{"fixture_id": "WC-1"}, {"tag": "", "mark": "L1"}], "waterHeaters": [{"heater_id": "WH-1"}], "PUMP_SCHEDULE": [{"pump_id": "P-1"}], "SHOCK_ARRESTORS": [{"MARK": "SA-1"}], "THERMOSTATIC_MIXING_VALVE_SCHEDULE": [{"MODEL_NUMBER": "x" * 80}]}},
    {"ARCH": {"WALL_TYPES": [{"type": "W1", "fr": "1 HR", "stc": "50"}, {"other": 1}], "doors": [{"mark": "101A", "hw_set": "H1", "rating": "20 MIN"}], "RCP_SCHEDULE": [{"Ceiling_Type": "ACT-1", "height": "108 in"}], "FINISHES": [{"room": "Lobby", "floor_finish": "CPT"}]}},
    {"blocks": [
        {"type": "unit_schedule", "name": "Unit A", "rows": [{"unit": "A", "tag": "DW", "panel": "S2", "volts": "120", "ph": "1", "amps": "20"}, {"unit": "A"}]},
        {"type": "panel_schedule", "rows": [{"board": "S2", "cct": "7", "desc": "Emergency GFCI spare space, weatherproof", "amp": "1,020", "raceway": "3/4", "bbox_norm": [0, 1]}]},
        {"name": "Lighting Schedule", "rows": [{"mark": "L1", "lm": 900}]}, {"name": "Single line schedule", "rows": [{"tag": "SWBD", "kva": 75}]}, {"name": "Notes", "rows": [{"tag": "none"}]},
    ]},
]


@pytest.fixture(scope="module")
def got(spark):
    rows = [(i, json.dumps(d)) for i, d in enumerate(DOCS)] + [(90, None), (91, "{broken"), (92, "[1]"), (93, "{}")]
    docs = spark.createDataFrame(rows, "state_id bigint, j string").select("state_id", F.try_parse_json("j").alias("doc"))
    out: dict[int, list[dict]] = {}
    for r in facts.emit_facts(docs).collect():
        out.setdefault(r["state_id"], []).append(r.asDict())
    return out


def fields(rows, *names):
    return {tuple(r[n] for n in names) for r in rows}


def test_all_shapes_of_panels(got):
    want = {
        0: {("A/1 x", "3", None, None, None, None), ("S2", "1", 120.0, "Kitchen", "20", None), ("S2", "2", 120.0, None, None, "1")},
        1: {("L1", "5", 208.0, None, None, None), ("L2", "7", 480.0, None, None, None)}, 2: {("P1", "1", 240.0, None, None, None), ("P2", "2", None, None, None, None)},
        3: {("P3", "4", None, None, None, None)}, 6: {("P5", "9", None, "Surge (spare)", None, None), ("P5", "10", None, "Fan", None, None)},
    }
    assert {i: fields(got[i], "panel_name", "circuit_number", "a_voltage", "description", "amps", "poles") for i in want} == want
    assert not {4, 5, 90, 91, 92, 93} & set(got)
    assert fields(got[6], "labels") == {("Spare",), ("",)}


def test_other_sections(got):
    assert fields(got[7], "row_key", "content") == {("mech_equipment_tag-EF-1", "EF-1 — 208V/3φ, 5.0HP (3.7kW), MCA 10.0/MOP 15.0"), ("mech_equipment_tag-EF-2", "EF-2"), ("mech_equipment_tag-AHU-1", "AHU-1")}
    assert fields(got[8], "row_key") == {(f"plumb_equipment_tag-{t}",) for t in ("WC-1", "L1", "WH-1", "P-1", "SA-1", "x" * 50)}
    assert fields(got[9], "row_key", "content") == {
        ("wall_partition_wall_type-W1", "W1 — 1 HR, STC 50"), ("door_door_number-101A", "Door 101A, H1, rating 20 MIN"), ("ceiling_ceiling_type-ACT-1", "ACT-1 — 108.0 in"), ("finish_tag-Lobby", "Lobby — floor CPT"),
    }


def test_blocks(got):
    assert fields(got[10], "row_key", "content", "labels", "panel_name", "amps") == {
        ("unit_plan_tag-DW_unit-A", "Unit A — DW — 120V/1φ, 20A", "", "S2", "20"),
        ("panel_circuit-007_panel-S2", "Panel S2 — Ckt 7 — Emergency GFCI spare space, weatherproof — 1020A, 3/4", "EM,GFCI,Space,Spare,WP", "S2", "1,020"),
        ("lighting_fixture_tag-L1", "L1 — , 900 lm", "", None, None), ("elec_equipment_tag-SWBD", "row", "", None, None),
    }
