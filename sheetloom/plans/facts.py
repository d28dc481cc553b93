"""Schedule rows of structured drawings as fact documents: from typed blocks or, without these, from each discipline's sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.functions import text as T
from sheetloom.tables import table

VARIANTS, NAMED = "array<variant>", "map<string,variant>"

# Attributes of a schedule row, each with the names that rows use for it, the first filled one counting; numbers first.
NUMBERS = {
    "voltage": ("voltage", "volts", "v"), "rating_a": ("amps", "amp", "a", "breaker", "breaker_a"), "hp": ("hp",), "kw": ("kw",), "kva": ("kva",), "mca": ("mca",), "mop": ("mop",), "fla": ("fla",),
    "busbar_a": ("busbar_a",), "btu": ("btu",), "gpm": ("gpm",), "head": ("head",), "lumens": ("lumens", "lm"), "stc": ("stc",), "ceiling_height_in": ("ceiling_height_in", "height", "ht"),
}
TEXTS = {
    "description": ("description", "desc", "notes", "load"), "phase": ("phase", "ph"), "wire": ("wire", "conductor"), "conduit": ("conduit", "raceway"), "disconnect": ("disconnect", "disc"), "panel": ("panel", "panel_name"),
    "circuit": ("circuit", "ckt", "cct"), "fixture_type": ("fixture_type", "type", "mark"), "lamp_type": ("lamp_type", "lamp"), "cct": ("cct",), "cri": ("cri",), "mounting": ("mounting", "mount"), "dimming": ("dimming",),
    "fire_rating": ("fire_rating", "fr", "rating"), "stud_gauge": ("stud_gauge", "stud"), "layers": ("layers",), "acoustic": ("acoustic", "nrc"), "grid": ("grid",), "finish_floor": ("finish_floor", "floor_finish"),
    "finish_wall": ("finish_wall", "wall_finish"), "finish_ceiling": ("finish_ceiling", "ceiling_finish"), "hardware_set": ("hardware_set", "hw_set"), "size": ("size",), "material_frame": ("material_frame", "material", "frame"),
}
# The parts of a row's key by schedule type, with the names that rows use for each.
TAGS = ("tag", "equipment_tag", "name", "fixture_type", "type", "mark")
KEYS = {
    "panel": {"circuit": ("circuit", "ckt", "cct", "circuit_number"), "panel": ("panel", "panel_name", "board")},
    "unit_plan": {"tag": ("tag", "device", "appliance", "equipment"), "unit": ("unit", "unit_id", "room", "space")},
    "elec_equipment": {"tag": TAGS}, "mech_equipment": {"tag": TAGS}, "plumb_equipment": {"tag": TAGS}, "lighting_fixture": {"tag": TAGS},
    "wall_partition": {"wall_type": ("wall_type", "partition_type", "type")}, "door": {"door_number": ("door_number", "mark", "door", "id")},
    "ceiling": {"ceiling_type": ("ceiling_type", "type")}, "finish": {"tag": ("space", "room", "area", "name")},
}
# Top-level fields of a fact, with the names that count before its key and attributes.
DERIVED = {"panel_name": ("panel", "panel_name"), "circuit_number": ("circuit_number", "circuit"), "poles": ("poles", "pole", "phase"), "amps": ("amps", "amp", "trip"), "kva": ("kva",), "description": ("description", "load_name")}
# Labels by the words of a description.
LABELS = {"EM": ("em",), "GFCI": ("gfci",), "Space": ("space",), "Spare": ("spare",), "WP": ("wp", "weatherproof")}
# Names of panels, of lists and of fields in panel schedules.
PANEL_NAMES = ("panel_name", "panel_id", "name", "panel", "id")
PANEL_SCHEDULES = ("panel_schedules", "panel schedules", "panelschedules")
LEFT = {"circuit": ("circuit", "circuit_number", "ckt", "cct"), "description": ("load_name", "description", "load", "device"), "amps": ("trip", "amps", "breaker", "size"), "poles": ("phase", "poles", "pole", "phase_count")}
RIGHT = {"circuit": ("circuit_number", "circuit", "ckt", "cct"), "description": ("load_name", "description", "load"), "amps": ("trip", "amps", "breaker"), "poles": ("poles", "pole", "phase")}
SECOND = {"circuit": ("ckt_b", "circuit_b", "circuit_number_b"), "description": ("load_name_b", "description_b", "load_b"), "amps": ("trip_b", "amps_b", "breaker_b"), "poles": ("poles_b", "pole_b", "phase_b")}
# Lists of plumbing sections (the first filled one of each family counts), with the names of their tags.
PLUMBING = [
    (("fixtures", "plumbing_fixture_schedule", "fixture_schedule"), ("fixture_id", "mark", "id")),
    (("water_heaters", "waterheaters", "electric_water_heater_schedule", "water_heater_schedule"), ("heater_id", "water_heater_id", "mark", "id")),
    (("pump_schedule",), ("mark", "pump_id", "id")), (("shock_arrestors",), ("mark", "id")),
    (("thermostatic_mixing_valve_schedule",), ("mark", "model_number", "valve_assembly_designation_description", "id")),
]
# Lists inside mechanical schedules, and the names of their items' tags.
MECH_LISTS, MECH_TAGS = ("fans", "devices", "units", "equipment", "items", "rows", "louvers"), ("desig.", "desig", "tag", "name", "mark")
# Lists of architectural sections by schedule type, with the names of what identifies a row.
ARCHITECTURAL = {
    "wall_partition": (("wall_types", "partition_types", "wall_partitions", "wall_schedule", "partition_schedule"), ("wall_type", "partition_type", "type")),
    "door": (("door_schedule", "doors", "door_schedules"), ("door_number", "mark", "door", "id")), "ceiling": (("ceiling_schedule", "rcp_schedule", "ceilings"), ("ceiling_type", "type")),
    "finish": (("finish_schedule", "finishes"), ("space", "room", "area", "name")),
}
#: What row sources may set beside a row's own members.
GIVEN = ("panel", "circuit", "description", "amps", "voltage", "phase", "poles", "tag", "wall_type", "ceiling_type")
READ = sorted({"trip", "tag", "voltage"} | {n for table_ in (NUMBERS, TEXTS, DERIVED, *KEYS.values()) for names in table_.values() for n in names})


def lowered(v: Column) -> Column:
    """The members of a VARIANT object by lower-case name; of names equal but for case the alphabetically first counts."""
    m = F.try_variant_get(v, "$", NAMED)
    low = F.transform(F.map_keys(m), F.lower)
    names = F.array_distinct(low)
    return F.map_from_arrays(names, F.transform(names, lambda k: F.element_at(F.map_values(m), F.array_position(low, k).cast("int"))))


def _string(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _at(m: Column, *names: str) -> Column:
    """First filled of the members of a lowered object, trimmed."""
    return T.first_filled(*[_string(F.try_element_at(m, F.lit(n))) for n in names])


def _list(m: Column, name: str) -> Column:
    return F.try_variant_get(F.try_element_at(m, F.lit(name)), "$", VARIANTS)


def _filled_list(m: Column, *names: str) -> Column:
    return F.coalesce(*[F.when(F.size(_list(m, n)) > 0, _list(m, n)) for n in names])


def _object(v: Column) -> Column:
    return F.try_variant_get(v, "$", NAMED).isNotNull()


def _given(**values: Column) -> Column:
    return F.struct(*[values.get(n, F.lit(None)).cast("string").alias(n) for n in GIVEN]).alias("given")


def _phases(m: Column) -> Column:
    """First phase load that is a text and not a measurement."""
    loads = F.try_element_at(m, F.lit("phase_loads"))
    phases = [T.blank_to_null(F.try_variant_get(loads, f"$.{p}", "string")) for p in "ABC"]
    return F.coalesce(*[F.when(~p.rlike(NUMERIC_LOAD), p) for p in phases])


# Fixed value: the form of a load that is a measurement.
NUMERIC_LOAD = r"(?i)^(--|\d+(\.\d+)?\s*(VA|A|W)?)$"


def panel_rows(sections: DataFrame) -> DataFrame:
    """Circuits of panel lists and panel schedules (objects by name, or lists), each with its right side as a row of its own; voltage
    is inherited from the panel or its enclosure."""
    m = F.col("electrical")
    named = F.coalesce(*[F.try_element_at(m, F.lit(n)) for n in PANEL_SCHEDULES])
    by_name = F.try_variant_get(named, "$", NAMED)
    none = F.lit(None).cast("string")
    listed = lambda vs, details: F.transform(vs, lambda v: F.struct(none.alias("name"), v.alias("p"), F.lit(details).alias("details")))
    every = [listed(_list(m, "panels"), False), listed(F.try_variant_get(named, "$", VARIANTS), True), F.transform(F.map_entries(by_name), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("p"), F.lit(True).alias("details")))]
    empty = F.array().cast("array<struct<name:string,p:variant,details:boolean>>")
    panels = sections.where("electrical IS NOT NULL").select("state_id", F.explode(F.concat(*[F.coalesce(e, empty) for e in every])).alias("x"))
    panels = panels.select("state_id", "x.name", "x.details", F.inline(F.array(F.struct(lowered(F.col("x.p")).alias("p")))))
    p = F.col("p")
    box = lowered(F.try_element_at(p, F.lit("enclosure_info")))
    voltage = F.coalesce(F.nullif(_string(F.try_element_at(p, F.lit("voltage"))), F.lit("")), F.when(F.col("name").isNull(), F.coalesce(F.nullif(_string(F.try_element_at(box, F.lit("volts"))), F.lit("")), F.nullif(_string(F.try_element_at(box, F.lit("voltage"))), F.lit("")))))
    circuits = F.when(F.col("details"), _filled_list(p, "circuit_details", "circuits")).otherwise(_filled_list(p, "circuits", "circuit_details"))
    rows = panels.select("state_id", F.coalesce("name", _at(p, *PANEL_NAMES)).alias("panel"), voltage.alias("voltage"), F.explode(circuits).alias("c"))
    rows = rows.select("state_id", "panel", "voltage", F.inline(F.array(F.struct(lowered(F.col("c")).alias("c"), lowered(F.try_element_at(lowered(F.col("c")), F.lit("right_side"))).alias("r"), lowered(F.try_element_at(lowered(F.col("c")), F.lit("left"))).alias("l")))))
    c, r = F.col("c"), F.col("r")
    left = {k: _at(c, *names) for k, names in LEFT.items()}
    left["circuit"] = F.coalesce(left["circuit"], _at(F.col("l"), "circuit_number"))
    left["description"] = F.coalesce(left["description"], _phases(c))
    own = {k: _at(r, *names) for k, names in RIGHT.items()}
    own["description"] = F.coalesce(own["description"], _phases(r))
    right = {k: F.coalesce(own[k], F.when(own["circuit"].isNull(), _at(c, *SECOND[k]))) for k in RIGHT}
    right["description"] = F.coalesce(right["description"], _phases(c))
    each = F.explode(F.array(*[F.struct(*[s[k].alias(k) for k in LEFT]) for s in (left, right)])).alias("s")
    x = rows.select("state_id", "panel", "voltage", each).where("s.circuit IS NOT NULL")
    s = lambda k: F.col(f"s.{k}")
    return x.select("state_id", F.lit("panel").alias("schedule_type"), F.lit("ELECTRICAL").alias("source"), F.lit(None).cast("variant").alias("r"), _given(panel=F.col("panel"), circuit=s("circuit"), description=s("description"), amps=s("amps"), voltage=F.col("voltage"), phase=s("poles"), poles=s("poles")))


def mechanical_rows(sections: DataFrame) -> DataFrame:
    """Equipment (a list, or lists by kind) and the items of every schedule (a list, or an object with lists of known names)."""
    x = sections.where("mechanical IS NOT NULL")
    m = F.col("mechanical")
    kinds = F.map_values(F.try_variant_get(F.try_element_at(m, F.lit("equipment")), "$", NAMED))
    none = F.array().cast(VARIANTS)
    lists = F.flatten(F.transform(F.coalesce(kinds, none), lambda v: F.coalesce(F.try_variant_get(v, "$", VARIANTS), none)))
    schedules = F.map_values(F.map_filter(m, lambda k, v: k.endswith("_schedule")))
    direct = F.flatten(F.transform(F.coalesce(schedules, none), lambda v: F.coalesce(F.try_variant_get(v, "$", VARIANTS), none)))
    plain = x.select("state_id", F.explode(F.concat(F.coalesce(_list(m, "equipment"), none), lists, direct)).alias("r"), F.lit(False).alias("inner"))
    held = x.select("state_id", F.explode(schedules).alias("v")).select("state_id", F.inline(F.array(F.struct(lowered(F.col("v")).alias("v")))))
    inner = held.select("state_id", F.explode(F.concat(*[F.coalesce(_list(F.col("v"), n), none) for n in MECH_LISTS])).alias("r"), F.lit(True).alias("inner"))
    rows = plain.unionByName(inner).where(_object(F.col("r")))
    tag = F.when(F.col("inner"), _at(lowered(F.col("r")), *MECH_TAGS))
    return rows.select("state_id", F.lit("mech_equipment").alias("schedule_type"), F.lit("MECHANICAL").alias("source"), "r", _given(tag=tag))


def plumbing_rows(sections: DataFrame) -> DataFrame:
    """Items of the five families of plumbing schedules; a mixing valve's tag is at most 50 characters."""
    m, out = F.col("plumbing"), None
    for lists, tags in PLUMBING:
        part = sections.where("plumbing IS NOT NULL").select("state_id", F.explode(_filled_list(m, *lists)).alias("r")).where(_object(F.col("r")))
        tag = _at(lowered(F.col("r")), *tags)
        part = part.select("state_id", F.lit("plumb_equipment").alias("schedule_type"), F.lit("PLUMBING").alias("source"), "r", _given(tag=F.left(tag, F.lit(50)) if lists[0].startswith("thermo") else tag))
        out = part if out is None else out.unionByName(part)
    return out


def architectural_rows(sections: DataFrame) -> DataFrame:
    """Rows of wall, door, ceiling and finish schedules that tell what they describe, in whatever list."""
    m, none = F.col("architectural"), F.array().cast(VARIANTS)
    typed = lambda kind: lambda v: F.struct(F.lit(kind).alias("schedule_type"), v.alias("r"))
    each = F.concat(*[F.transform(F.concat(*[F.coalesce(_list(m, n), none) for n in lists]), typed(kind)) for kind, (lists, _) in ARCHITECTURAL.items()])
    rows = sections.where("architectural IS NOT NULL").select("state_id", F.explode(each).alias("x")).select("state_id", "x.*").where(_object(F.col("r")))
    rows = rows.select("state_id", "schedule_type", "r", F.inline(F.array(F.struct(lowered(F.col("r")).alias("l")))))
    told = None
    for kind, (_, names) in ARCHITECTURAL.items():
        one, is_kind = _at(F.col("l"), *names), F.col("schedule_type") == kind
        told = F.when(is_kind, one) if told is None else told.when(is_kind, one)
    kind = F.col("schedule_type")
    x = rows.withColumn("told", told).where("told IS NOT NULL")
    return x.select("state_id", "schedule_type", F.lit("ARCHITECTURAL").alias("source"), "r", _given(wall_type=F.when(kind == "wall_partition", F.col("told")), ceiling_type=F.when(kind == "ceiling", F.col("told"))))


def block_rows(docs: DataFrame) -> DataFrame:
    blocks = docs.select("state_id", F.explode(F.try_variant_get("doc", "$.blocks", VARIANTS)).alias("b"))
    kind = T.schedule_type(*[F.try_variant_get("b", f"$.{n}", "string") for n in ("type", "name", "subtype")])
    rows = blocks.select("state_id", kind.alias("schedule_type"), F.lit("blocks").alias("source"), F.explode(F.try_variant_get("b", "$.rows", VARIANTS)).alias("r"))
    return rows.where("schedule_type <> ''").select("*", _given())


def described(rows: DataFrame) -> DataFrame:
    """Members (_<name>), attributes (a_<name>), parts of the key (k_<name>) and summary (content) of rows (schedule_type, r, given, and any
    further columns)."""
    own = [c for c in rows.columns if c not in ("r", "given")]

    def member(name: str) -> Column:
        value = F.try_variant_get("r", f"$.{name}", "string")
        if name in GIVEN:  # what a source sets counts where the row has no such member
            value = F.when(F.coalesce(F.array_contains(F.map_keys(F.try_variant_get("r", "$", NAMED)), name), F.lit(False)), value).otherwise(F.col(f"given.{name}"))
        return F.nullif(value, F.lit(""))

    x = rows.select(*own, F.inline(F.array(F.struct(*[member(n).alias(f"_{n}") for n in READ]))))
    get = lambda names: F.coalesce(*[F.col(f"_{n}") for n in names])
    texts = {k: T.blank_to_null(get(names)) for k, names in TEXTS.items()}
    attributes = {f"a_{k}": texts[k] for k in TEXTS} | {f"a_{k}": T.plain_number(get(names)) for k, names in NUMBERS.items()}
    kind = F.col("schedule_type")
    parts = {}
    for part in ("circuit", "panel", "tag", "unit", "wall_type", "door_number", "ceiling_type"):
        cases = [(k, F.trim(get(names[part]))) for k, names in KEYS.items() if part in names]
        out = F.when(kind == cases[0][0], cases[0][1])
        for k, value in cases[1:]:
            out = out.when(kind == k, value)
        parts[part] = out
    x = x.select(*own, *[F.col(f"_{n}") for n in READ], F.inline(F.array(F.struct(*[c.alias(k) for k, c in attributes.items()], *[c.alias(f"k_{k}") for k, c in parts.items()]))))
    return x.withColumn("content", summary())


def fact_documents(rows: DataFrame) -> DataFrame:
    """Keys, attributes, labels and summary of rows (schedule_type, r, given, and any further columns); rows without a full key are left out."""
    x, kind = described(rows), F.col("schedule_type")
    parts = [c[2:] for c in x.columns if c.startswith("k_")]
    full = F.lit(False)
    for k, names in KEYS.items():
        has = F.lit(True)
        for part in names:
            has &= F.col(f"k_{part}").isNotNull()
        full |= (kind == k) & has
    x = x.where(full)
    key = F.concat_ws("_", kind, *[F.concat(F.lit(f"{p}-"), T.padded_circuit(F.col("k_circuit")) if p == "circuit" else F.col(f"k_{p}")) for p in sorted(parts)])
    said = F.lower(F.coalesce("a_description", F.lit("")))
    labels = F.array_join(F.array_compact(F.array(*[F.when(F.greatest(*[said.contains(w).cast("int") for w in words], F.lit(0)) > 0, label) for label, words in LABELS.items()])), ",")
    fallback = {"panel_name": ["a_panel", "k_panel"], "circuit_number": ["k_circuit", "a_circuit"], "poles": ["a_phase"], "amps": ["a_rating_a"], "kva": ["a_kva"], "description": ["a_description"]}
    derived = {k: T.blank_to_null(F.coalesce(*[F.col(f"_{n}") for n in names], *[F.col(c).cast("string") for c in fallback[k]])) for k, names in DERIVED.items()}
    x = x.withColumns({"row_key": key, "labels": labels} | derived)
    return x.drop(*[f"_{n}" for n in READ], *[f"k_{p}" for p in parts])


def summary() -> Column:
    """A readable line for a fact, by its type."""
    a, k = (lambda n: F.col(f"a_{n}")), (lambda n: F.coalesce(F.col(f"k_{n}"), F.lit("None")))
    whole = lambda n, before="", after="": F.coalesce(F.concat(F.lit(before), a(n).cast("bigint").cast("string"), F.lit(after)), F.lit(""))
    plain = lambda n, before="", after="": F.coalesce(F.concat(F.lit(before), a(n).cast("string"), F.lit(after)), F.lit(""))
    dash = F.lit(" — ")
    lines = {
        "panel": [F.lit("Panel "), k("panel"), F.lit(" — Ckt "), k("circuit"), dash, plain("description"), dash, whole("rating_a", "", "A"), plain("conduit", ", ")],
        "unit_plan": [F.lit("Unit "), k("unit"), dash, k("tag"), dash, whole("voltage", "", "V"), plain("phase", "/", "φ"), whole("rating_a", ", ", "A")],
        "mech_equipment": [k("tag"), dash, whole("voltage", "", "V"), plain("phase", "/", "φ"), plain("hp", ", ", "HP"), plain("kw", " (", "kW)"), plain("mca", ", MCA "), plain("mop", "/MOP ")],
        "lighting_fixture": [k("tag"), dash, whole("voltage", "", "V"), whole("lumens", ", ", " lm")],
        "wall_partition": [k("wall_type"), dash, plain("fire_rating"), whole("stc", ", STC ")],
        "door": [F.lit("Door "), k("door_number"), plain("hardware_set", ", "), plain("fire_rating", ", rating ")],
        "ceiling": [k("ceiling_type"), dash, plain("ceiling_height_in", "", " in")],
        "finish": [k("tag"), F.lit(" — floor "), plain("finish_floor")],
    }
    out = None
    for kind, parts in lines.items():
        line = F.btrim(F.concat(*parts), F.lit(" —,"))
        out = F.when(F.col("schedule_type") == kind, line) if out is None else out.when(F.col("schedule_type") == kind, line)
    return out.otherwise("row")


def no_given() -> Column:
    return _given()


def section_rows(docs: DataFrame) -> DataFrame:
    """Rows of the electrical, mechanical, plumbing and architectural sections of docs (state_id, doc), whose names may be in any case."""
    top = docs.where(F.col("doc").isNotNull()).select("state_id", F.inline(F.array(F.struct(lowered(F.col("doc")).alias("m")))))
    section = lambda *names: F.coalesce(*[lowered(F.try_element_at("m", F.lit(n))) for n in names])
    sections = top.select("state_id", F.inline(F.array(F.struct(section("electrical").alias("electrical"), section("mechanical").alias("mechanical"), section("plumbing").alias("plumbing"), section("architectural", "arch").alias("architectural")))))
    out = None
    for source in (panel_rows, mechanical_rows, plumbing_rows, architectural_rows):
        out = source(sections) if out is None else out.unionByName(source(sections))
    return out


def emit_facts(docs: DataFrame) -> DataFrame:
    """Fact documents of docs (state_id, doc VARIANT): those of typed blocks or, in files without blocks, of the electrical, mechanical,
    plumbing and architectural sections, whose names may be in any letter case. Null and faulty documents give none; repeated rows
    each give theirs. Every branch reads the documents narrowly; nothing is shuffled."""
    blocked = F.coalesce(F.size(F.try_variant_get("doc", "$.blocks", VARIANTS)) > 0, F.lit(False))
    rows = block_rows(docs.where(blocked)).unionByName(section_rows(docs.where(~blocked)))
    return fact_documents(rows)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All facts of the structured drawings."""
    return emit_facts(table(spark, sf_dir, "processing_state").select("state_id", F.try_parse_json("parsed_json_data").alias("doc")))


def _low_sql(x: str) -> str:
    return f"map_from_entries(list_transform(json_keys({x}), lambda k: {{'k': lower(k), 'v': json_extract({x}, '$.\"' || k || '\"')}}))"


def _at_sql(m: str, names: tuple[str, ...]) -> str:
    return "coalesce(" + ", ".join(f"nullif(trim({m}['{n}']->>'$'), '')" for n in names) + ")"


def _items_sql(m: str, names: tuple[str, ...]) -> str:
    return "from_json(CASE " + " ".join(f"WHEN json_array_length({m}['{n}']) > 0 THEN {m}['{n}']" for n in names) + " END, '[\"JSON\"]')"


def _phases_sql(m: str) -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN NOT regexp_matches(trim({m}['phase_loads']->>'$.{p}'), '{NUMERIC_LOAD}') THEN nullif(trim({m}['phase_loads']->>'$.{p}'), '') END" for p in "ABC") + ")"


def _rows_sql() -> str:
    """Rows as (state_id, source, schedule_type, r, g): g holds what the source sets."""
    words = "lower(coalesce(b->>'$.type', '') || ' ' || coalesce(b->>'$.name', '') || ' ' || coalesce(b->>'$.subtype', ''))"
    types = "CASE WHEN NOT contains(w, 'schedule') THEN '' " + " ".join(f"WHEN regexp_matches(w, '{p}') THEN '{t}'" for p, t in T.SCHEDULE_RULES) + " ELSE '' END"
    obj = lambda **v: "json_object(" + ", ".join(f"'{k}', {e}" for k, e in v.items()) + ")"
    left = {k: _at_sql("c", n) for k, n in LEFT.items()}
    left |= {"circuit": f"coalesce({left['circuit']}, nullif(trim({_low_sql("c['left']")}['circuit_number']->>'$'), ''))", "description": f"coalesce({left['description']}, {_phases_sql('c')})"}
    own = {k: _at_sql("r", n) for k, n in RIGHT.items()}
    own["description"] = f"coalesce({own['description']}, {_phases_sql('r')})"
    right = {k: f"coalesce({own[k]}, CASE WHEN {own['circuit']} IS NULL THEN {_at_sql('c', SECOND[k])} END)" for k in RIGHT}
    right["description"] = f"coalesce({right['description']}, {_phases_sql('c')})"
    side = lambda s: f"SELECT state_id, {obj(panel='panel', voltage='voltage', circuit=s['circuit'], description=s['description'], amps=s['amps'], phase=s['poles'], poles=s['poles'])} AS g FROM circuits"
    volts = "coalesce(nullif(p['voltage']->>'$', ''), CASE WHEN name IS NULL THEN coalesce(nullif(e['volts']->>'$', ''), nullif(e['voltage']->>'$', '')) END)"
    schedules = "coalesce(" + ", ".join(f"electrical['{n}']" for n in PANEL_SCHEDULES) + ")"
    plumbing = " UNION ALL ".join(
        f"SELECT state_id, r, {'left(t, 50)' if lists[0].startswith('thermo') else 't'} AS tag FROM (SELECT state_id, r, {_at_sql(_low_sql('r'), tags)} AS t FROM (SELECT state_id, unnest({_items_sql('plumbing', lists)}) AS r FROM s) WHERE json_type(r) = 'OBJECT')" for lists, tags in PLUMBING
    )
    arch = " UNION ALL ".join(f"SELECT state_id, '{kind}' AS t, r, {_at_sql(_low_sql('r'), names)} AS told FROM (SELECT state_id, unnest({_items_sql('architectural', (n,))}) AS r FROM s) WHERE json_type(r) = 'OBJECT'" for kind, (lists, names) in ARCHITECTURAL.items() for n in lists)
    inner = " UNION ALL ".join(f"SELECT state_id, unnest({_items_sql('v', (n,))}) AS r, true AS inn FROM held" for n in MECH_LISTS)
    return f"""
    d AS (SELECT state_id, CAST(parsed_json_data AS JSON) AS j, coalesce(json_array_length(json_extract(parsed_json_data, '$.blocks')), 0) > 0 AS blocked FROM processing_state WHERE json_valid(parsed_json_data)),
    b AS (SELECT state_id, {words} AS w, from_json(json_extract(b, '$.rows'), '["JSON"]') AS rows FROM (SELECT state_id, unnest(from_json(json_extract(j, '$.blocks'), '["JSON"]')) AS b FROM d WHERE blocked)),
    m AS (SELECT state_id, {_low_sql('j')} AS m FROM d WHERE NOT blocked AND json_type(j) = 'OBJECT'),
    s AS (SELECT state_id, {_low_sql("m['electrical']")} AS electrical, {_low_sql("m['mechanical']")} AS mechanical, {_low_sql("m['plumbing']")} AS plumbing, {_low_sql("coalesce(m['architectural'], m['arch'])")} AS architectural FROM m),
    ps AS (SELECT state_id, {schedules} AS v FROM s),
    panels AS (SELECT state_id, NULL AS name, unnest({_items_sql('electrical', ('panels',))}) AS p, false AS det FROM s UNION ALL SELECT state_id, NULL, unnest(from_json(v, '["JSON"]')), true FROM ps WHERE json_type(v) = 'ARRAY'
               UNION ALL SELECT state_id, k, json_extract(v, '$."' || k || '"'), true FROM (SELECT state_id, v, unnest(json_keys(v)) AS k FROM ps WHERE json_type(v) = 'OBJECT')),
    p2 AS (SELECT state_id, name, det, p, {_low_sql("p['enclosure_info']")} AS e FROM (SELECT state_id, name, det, {_low_sql('p')} AS p FROM panels WHERE json_type(p) = 'OBJECT')),
    c1 AS (SELECT state_id, coalesce(name, {_at_sql('p', PANEL_NAMES)}) AS panel, {volts} AS voltage, unnest(CASE WHEN det THEN {_items_sql('p', ('circuit_details', 'circuits'))} ELSE {_items_sql('p', ('circuits', 'circuit_details'))} END) AS c FROM p2),
    circuits AS (SELECT state_id, panel, voltage, c, {_low_sql("c['right_side']")} AS r FROM (SELECT state_id, panel, voltage, {_low_sql('c')} AS c FROM c1 WHERE json_type(c) = 'OBJECT')),
    eq AS (SELECT state_id, mechanical['equipment'] AS v FROM s), sch AS (SELECT state_id, unnest(map_values(map_from_entries(list_filter(map_entries(mechanical), lambda e: suffix(e.key, '_schedule'))))) AS v FROM s),
    held AS (SELECT state_id, {_low_sql('v')} AS v FROM sch WHERE json_type(v) = 'OBJECT'),
    mech AS (SELECT state_id, unnest(from_json(v, '["JSON"]')) AS r, false AS inn FROM eq WHERE json_type(v) = 'ARRAY' UNION ALL SELECT state_id, unnest(from_json(e.value, '["JSON"]')), false FROM eq, json_each(eq.v) e WHERE json_type(eq.v) = 'OBJECT' AND e.type = 'ARRAY'
             UNION ALL SELECT state_id, unnest(from_json(v, '["JSON"]')), false FROM sch WHERE json_type(v) = 'ARRAY' UNION ALL {inner}),
    a AS ({arch}),
    rows AS (SELECT state_id, 'blocks' AS source, t AS schedule_type, r, json_object() AS g FROM (SELECT state_id, {types} AS t, unnest(rows) AS r FROM b) WHERE t <> ''
             UNION ALL SELECT state_id, 'ELECTRICAL', 'panel', NULL, g FROM ({side(left)} UNION ALL {side(right)}) WHERE g->>'$.circuit' IS NOT NULL
             UNION ALL SELECT state_id, 'MECHANICAL', 'mech_equipment', r, CASE WHEN inn THEN {obj(tag=_at_sql(_low_sql('r'), MECH_TAGS))} ELSE json_object() END FROM mech WHERE json_type(r) = 'OBJECT'
             UNION ALL SELECT state_id, 'PLUMBING', 'plumb_equipment', r, {obj(tag='tag')} FROM ({plumbing})
             UNION ALL SELECT state_id, 'ARCHITECTURAL', t, r, {obj(wall_type="CASE WHEN t = 'wall_partition' THEN told END", ceiling_type="CASE WHEN t = 'ceiling' THEN told END")} FROM a WHERE told IS NOT NULL)"""


def _facts_sql(only: str = "") -> str:
    member = lambda n: f"nullif(CASE WHEN json_exists(r, '$.{n}') THEN r->>'$.{n}' ELSE g->>'$.{n}' END, '')" if n in GIVEN else f"nullif(r->>'$.{n}', '')"
    get = lambda names, cast="{}": "coalesce(" + ", ".join(f"_{n}" for n in names) + ", NULL)"
    texts = ", ".join(f"nullif(trim({get(n)}), '') AS a_{k}" for k, n in TEXTS.items())
    numbers = ", ".join(f"TRY_CAST(trim(regexp_replace(lower({get(n)}), ',|in|\"', '', 'g')) AS DOUBLE) AS a_{k}" for k, n in NUMBERS.items())
    parts = sorted({p for names in KEYS.values() for p in names})
    keys = ", ".join("CASE schedule_type " + " ".join(f"WHEN '{t}' THEN trim({get(n[p])})" for t, n in KEYS.items() if p in n) + f" END AS k_{p}" for p in parts)
    full = " OR ".join(f"(schedule_type = '{t}' AND " + " AND ".join(f"k_{p} IS NOT NULL" for p in n) + ")" for t, n in KEYS.items())
    pad = "CASE WHEN regexp_matches(trim(k_circuit), '^[0-9]+$') THEN printf('%03d', CAST(trim(k_circuit) AS BIGINT)) ELSE k_circuit END"
    key = "concat_ws('_', schedule_type, " + ", ".join(f"'{p}-' || {pad if p == 'circuit' else f'k_{p}'}" for p in parts) + ")"
    said = "lower(coalesce(a_description, ''))"
    labels = "concat_ws(',', " + ", ".join(f"CASE WHEN {' OR '.join(f"contains({said}, '{w}')" for w in words)} THEN '{label}' END" for label, words in LABELS.items()) + ")"
    whole = lambda n, before="", after="": f"coalesce('{before}' || CAST(CAST(trunc(a_{n}) AS BIGINT) AS VARCHAR) || '{after}', '')"
    plain = lambda n, before="", after="": f"coalesce('{before}' || CAST(a_{n} AS VARCHAR) || '{after}', '')"
    lines = {
        "panel": f"'Panel ' || k_panel || ' — Ckt ' || k_circuit || ' — ' || {plain('description')} || ' — ' || {whole('rating_a', '', 'A')} || {plain('conduit', ', ')}",
        "unit_plan": f"'Unit ' || k_unit || ' — ' || k_tag || ' — ' || {whole('voltage', '', 'V')} || {plain('phase', '/', 'φ')} || {whole('rating_a', ', ', 'A')}",
        "mech_equipment": f"k_tag || ' — ' || {whole('voltage', '', 'V')} || {plain('phase', '/', 'φ')} || {plain('hp', ', ', 'HP')} || {plain('kw', ' (', 'kW)')} || {plain('mca', ', MCA ')} || {plain('mop', '/MOP ')}",
        "lighting_fixture": f"k_tag || ' — ' || {whole('voltage', '', 'V')} || {whole('lumens', ', ', ' lm')}", "wall_partition": f"k_wall_type || ' — ' || {plain('fire_rating')} || {whole('stc', ', STC ')}",
        "door": f"'Door ' || k_door_number || {plain('hardware_set', ', ')} || {plain('fire_rating', ', rating ')}", "ceiling": f"k_ceiling_type || ' — ' || {plain('ceiling_height_in', '', ' in')}", "finish": f"k_tag || ' — floor ' || {plain('finish_floor')}",
    }
    content = "CASE schedule_type " + " ".join(f"WHEN '{t}' THEN trim({line}, ' —,')" for t, line in lines.items()) + " ELSE 'row' END"
    fallback = {"panel_name": "a_panel, k_panel", "circuit_number": "k_circuit, a_circuit", "poles": "a_phase", "amps": "CAST(a_rating_a AS VARCHAR)", "kva": "CAST(a_kva AS VARCHAR)", "description": "a_description"}
    derived = ", ".join(f"nullif(trim(coalesce({', '.join(f'_{n}' for n in names)}, {fallback[k]})), '') AS {k}" for k, names in DERIVED.items())
    columns = ", ".join(f"a_{k}" for k in [*TEXTS, *NUMBERS])
    where = f" AND schedule_type = '{only}'" if only else ""
    return f"""
    WITH {_rows_sql()},
    f AS (SELECT state_id, source, schedule_type, {', '.join(f'{member(n)} AS _{n}' for n in READ)} FROM rows),
    t AS (SELECT *, {texts}, {numbers}, {keys} FROM f)
    SELECT state_id, source, schedule_type, {columns}, {key} AS row_key, {labels} AS labels, {content} AS content, {derived} FROM t WHERE ({full}){where}"""


def _of_type(kind: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return facts(spark, sf_dir).where(F.col("schedule_type") == kind)

    query.__name__ = f"facts_{kind}"
    query.__doc__ = f"Facts of the type {kind}."
    return query


QUERIES = {"facts": facts} | {f"facts_{kind}": _of_type(kind) for kind in KEYS}
SQL = {"facts": _facts_sql()} | {f"facts_{kind}": _facts_sql(kind) for kind in KEYS}
