from __future__ import annotations

import json

from pyspark.sql import functions as F

from sheetloom.plans import sheets

TEMPLATE = {
    "room_id": "R1", "template_status": "signed_off", "circuits": {"lighting": ["L1", "L2", "L3", "L4"], "power": [], "emergency": []}, "outlets": {"regular_outlets": 4, "gfci_outlets": 1, "usb_outlets": 0}, "appliances": ["DW"],
    "fire_alarm": {"smoke_detectors": {"count": 2}, "horn_strobes": {"count": 1}}, "data_telecom": {"data_outlets": 2, "wireless_ap": False}, "discrepancies": [], "nurse_call": {"stations": {"count": 0}},
}
ROOM = {"room_name": "Lobby", "dimensions": "10 x 12", "ceiling_height": "9'", "finishes": {"floor": {"material": "CPT"}}, "doors": {"count": 2, "fire_rated": True}, "special_rooms": {"lab": {"fume_hood": 1}}, "accessibility": {"ada_required": True}}


def write(spark, path, docs):
    rows = [(i, "p-1", json.dumps(d) if d is not None else None) for i, d in enumerate(docs)]
    spark.createDataFrame(rows, "state_id bigint, project_id string, parsed_json_data string").write.parquet(f"{path}/processing_state.parquet")
    return str(path)


def test_template_tags_and_summaries(spark):
    df = spark.createDataFrame([(0, "electrical", json.dumps(TEMPLATE)), (1, "architectural", json.dumps(ROOM)), (2, "other", "{}"), (3, "electrical", "{}"), (4, "electrical", None)], "i int, kind string, j string").withColumn("v", F.try_parse_json("j"))
    got = {r["i"]: (r["tags"], r["line"]) for r in df.select("i", sheets.template_tags(F.col("v")).alias("tags"), sheets.template_summary(F.col("v"), F.col("kind")).alias("line")).collect()}
    assert got[0] == (["appliances", "data", "fire_alarm", "gfci", "lighting", "outlets", "signed_off"], "R1 Electrical — Lighting: L1, L2, L3..., 5 outlets, 3 FA devices, 2 data (signed_off)")
    assert got[1] == (["ada", "dimensions", "doors", "finishes", "fire_rated", "lab"], "Lobby Architectural — Dims: 10 x 12, Ceiling: 9', Floor: CPT, 2 doors, lab, ADA (in_progress)")
    assert got[2] == ([], "Space Template (other) - Status: in_progress") and got[3][1] == "Space Electrical (empty) (in_progress)" and got[4][0] == []


def test_metadata_chains(spark, tmp_path):
    docs = [
        {"sheet_number": "E1", "discipline": " Electrical ", "levels": ["1"], "page_number": "x", "page": 3, "job_no": 17, "revision_date": "2024-03-05T10:00:00-05:00", "source_document": {"uri": "https://acct.store.example/box/a/b.pdf"}},
        {"DRAWING_METADATA": {"drawing_number": "M2", "date": "3/4/24", "page": 7}, "MECHANICAL": {}, "project": "P"}, {"ELECTRICAL": {}, "PLUMBING": {}, "revision_date": 86400000, "source_document": {"storage_name": "c/d/e.pdf"}}, None, {"drawing_number": "", "page": 0, "revision_date": "soon"},
    ]
    got = {r["state_id"]: r for r in sheets.sheet_metadata(spark, write(spark, tmp_path, docs)).collect()}
    names = ("sheet_number", "discipline", "page", "job_number", "revision_date", "source_account", "source_container", "source_blob")
    assert tuple(got[0][n] for n in names) == ("E1", "electrical", 3, "17", "2024-03-05T15:00:00Z", "acct", "box", "a/b.pdf")
    assert tuple(got[1][n] for n in names) == ("M2", "mechanical", 7, None, "2024-03-04T00:00:00Z", None, None, None) and got[1]["project"] == "P"
    assert tuple(got[2][n] for n in names) == ("sheet", "architectural", 1, None, "1972-09-27T00:00:00Z", None, "c", "d/e.pdf")
    assert 3 not in got and got[4]["sheet_number"] == "sheet" and got[4]["revision_date"] == sheets.NO_DATE and got[4]["revision"] == "IFC" and got[4]["page"] == 1


def test_chunks(spark, tmp_path):
    docs = [
        {"sheet_number": "E2.03", "notes": ["one", "", " two "], "content": "about", "blocks": [{"type": "panel_schedule", "rows": []}, {"type": "panel_schedule", "rows": [{"panel": "S2", "circuit": "7", "amps": 20}, 5]}, {"type": "panel schedule", "rows": [{"panel": "no"}]}]},
        {"DRAWING_METADATA": {"drawing_number": "M1"}, "MECHANICAL": {"equipment": [{"tag": f"F{i}", "hp": 1} for i in range(40)]}, "PLUMBING": {"fixtures": [{"fixture_id": "WC", "voltage": 120}]}, "notes": {"a": "x", "b": ""}},
        {"general_notes": "y" * 3000, "blocks": [{"type": "panel_schedule", "rows": [{"panel": "S9", "circuit": "1"}]}], "ELECTRICAL": {"panels": [{"name": "P", "circuits": [{"circuit": 1}, {"circuit": 2}]}]}}, {"notes": []}, None,
    ]
    got = {(r["state_id"], r["chunk_no"]): r for r in sheets.sheet_chunks(spark, write(spark, tmp_path, docs)).collect()}
    assert {k: (r["chunk_type"], r["json_ptr"]) for k, r in got.items()} == {
        (0, 1): ("panel_schedule", "/blocks/1"), (0, 2): ("notes", "/notes"), (0, 3): ("general", "/content"), (1, 1): ("mech_schedule", "/MECHANICAL"), (1, 2): ("plumb_schedule", "/PLUMBING"), (1, 3): ("notes", "/notes"),
        (2, 1): ("panel_schedule", "/ELECTRICAL/panels"), (2, 2): ("notes", "/notes"),
    }
    assert got[0, 1]["content"] == "E2.03 Panel Schedule (1 rows)\n- Panel S2 — Ckt 7 —  — 20A" and got[0, 1]["chunk_id"] == "tenant-p-1-E2-03-chunk-0001" and got[0, 2]["content"] == "E2.03 notes\none\ntwo"
    lines = got[1, 1]["content"].split("\n")
    assert lines[0] == "M1 Mech Schedule (40 rows)" and lines[1:] == [f"- F{i} — , 1.0HP" for i in range(30)]
    assert got[1, 2]["content"] == "M1 Plumb Schedule (1 rows)\n- tag=WC, voltage=120" and got[1, 3]["content"] == "M1 notes\na: x"
    assert got[2, 1]["n_rows"] == 2 and len(got[2, 2]["content"]) == 1500 and got[2, 2]["content"].endswith("yyy...")


def test_rooms(spark, tmp_path):
    docs = [{"ARCHITECTURAL": {"ROOMS": [{"room_number": "Room_101", "room_name": "Lobby"}, {"number": "101", "name": "again"}, {"name": "15' - 0\""}, {"name": " Open   Office ", "area": 9}, 5, {"mark": "20' x 30'", "usage": "Store"}, {"number": "É"}]}, "rooms": [{"id": "no"}]}, {"rooms": [{"id": "7"}]}, {"room_information": {"rooms": [{"room": "8", "description": "8"}]}}, {}, None]
    got = {(r["state_id"], r["room_id"], r["room_number"], r["room_name"]) for r in sheets.room_scaffolds(spark, write(spark, tmp_path, docs)).collect()}
    assert got == {(0, "Room_101", "101", "Lobby_101"), (0, "Room_OPEN_OFFICE", "Open Office", "Open Office"), (0, "Room_STORE", "Store", "Store"), (0, "Room_UNIDENTIFIED", "É", "Room_É"), (1, "Room_7", "7", "Room_7"), (2, "Room_8", "8", "8")}


def test_coverage(spark, tmp_path):
    docs = [{"ELECTRICAL": {"panels": [{"name": "P", "circuits": [{"circuit": 1}, {"load": "x"}]}]}, "MECHANICAL": {"FAN_SCHEDULE": {"fans": [{"tag": "a"}]}, "equipment": {"x": [{"tag": "b"}]}}}, {"PLUMBING": {"fixtures": [{"tag": "a"}], "PUMP_SCHEDULE": [{"mark": "p"}]}, "ARCHITECTURAL": {"DOOR_SCHEDULE": [{"mark": "1"}, {}]}}]
    got = {tuple(r) for r in sheets.coverage_check(spark, write(spark, tmp_path, docs)).collect()}
    assert got == {(0, "electrical", 2, 1, False), (0, "mechanical", 2, 2, True), (1, "plumbing", 2, 2, True), (1, "architectural", 2, 1, False)}
