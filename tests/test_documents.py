from __future__ import annotations

from sheetloom.plans.documents import repaired_metadata

SHAPE = "i int, path string, titleblock string, sheet_number string, drawing_number string, revision string, project_name string, project_address string, job_number string"


def test_repaired_metadata(spark):
    rows = [
        (0, "x/E5.00_panel.pdf", "PROJECT NAME: Alder Hall\nRev: B", None, "", "E5.00", None, None, "17"), (1, "notes.pdf", "3 IFC", "", None, None, None, "120 N ELM ST", "9"), (2, None, None, None, None, "C", "Kept", "1 A ST", None),
        (3, "A1.pdf", "PROJECT: \nPROJECT: -:Birch-", "S1", None, "S1", "", None, None), (4, "A2.pdf", "", None, None, None, None, None, "44"), (5, None, None, None, None, None, None, None, None),
    ]
    got = {r["i"]: tuple(r[c] for c in ("sheet_number", "drawing_number", "revision", "project_name", "project_source")) for r in repaired_metadata(spark.createDataFrame(rows, SHAPE)).collect()}
    assert got == {
        0: ("E5.00", "E5.00", "B", "Alder Hall", None), 1: (None, None, "3", "N Elm 9", "derived_from_address"), 2: (None, None, "C", "Kept", None), 3: ("S1", "S1", None, "Birch", None),
        4: ("A2", "A2", None, "Project 44", "derived_from_job_no"), 5: (None, None, None, None, None),
    }
