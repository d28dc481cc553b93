"""Sheets of structured drawings: metadata with fallbacks, chunks, reconciliation of counts, rooms and template tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.functions import text as T
from sheetloom.plans import facts as facts_plan
from sheetloom.tables import table

VARIANTS = "array<variant>"
# Defaults of sheet data that nothing tells.
NO_DATE, NO_REVISION, NO_DISCIPLINE, NO_SHEET, NO_FILE, NO_PROJECT = "2000-01-01T00:00:00Z", "IFC", "architectural", "sheet", "<blob/path>.pdf", "Unnamed Project"
SECTIONS = ("ELECTRICAL", "MECHANICAL", "PLUMBING", "ARCHITECTURAL")
# Keys that may hold a page number, and the keys of each field of a sheet in order (d. is the drawing's metadata).
PAGE_KEYS = ("page_number", "page", "sheet_index")
FIELDS = {
    "sheet_number": ("sheet_number", "d.sheet_number", "d.drawing_number", "drawing_number"), "sheet_title": ("sheet_title", "d.title", "title"), "revision": ("revision", "d.revision"),
    "told_discipline": ("discipline", "d.discipline"), "told_date": ("revision_date", "d.revision_date", "d.date"), "source_file": ("source_file", "d.source_file"),
    "job_number": ("job_number", "job_no", "d.job_number", "d.job_no"), "project": ("project_name", "project"),
}
# Chunk types in order, with the schedule type, section and pointer of their rows; lines and characters of a chunk.
CHUNKS = (("panel_schedule", "panel", "/ELECTRICAL/panels"), ("mech_schedule", "mech_equipment", "/MECHANICAL"), ("plumb_schedule", "plumb_equipment", "/PLUMBING"))
MAX_LINES, MAX_CHARS = 30, 1500
# What a row tells where its type has no summary.
TOLD = ("panel", "panel_name", "circuit", "circuit_number", "tag", "description", "amps", "trip", "voltage", "kva")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "processing_state").select("state_id", "project_id", F.try_parse_json("parsed_json_data").alias("doc"))


def _path(key: str) -> str:
    return f"$.DRAWING_METADATA.{key[2:]}" if key.startswith("d.") else f"$.{key}"


def iso_date(told: Column) -> Column:
    """A date in ISO, American or epoch notation as an ISO instant in UTC; NO_DATE if it is none."""
    text = F.trim(told)
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}:\d{2})?$"), F.when(text.rlike(r"(Z|[+-]\d{2}:\d{2})$"), text).otherwise(F.concat(text, F.when(text.contains(":"), "Z").otherwise("T00:00:00Z"))).try_cast("timestamp"))
    american = F.coalesce(*[F.when(text.rlike(p), F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(f"{f} XXX"))) for p, f in ((r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"))])
    epoch = F.when(text.rlike(r"^\d{5,11}(\.\d+)?$"), F.timestamp_seconds(text.try_cast("double")))
    at = F.to_utc_timestamp(F.coalesce(iso, american, epoch), F.current_timezone())
    return F.coalesce(F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.date_format(at, "SSSSSS") != "000000", F.concat(F.lit("."), F.date_format(at, "SSSSSS"))).otherwise(""), F.lit("Z")), F.lit(NO_DATE))


def _metadata(docs: DataFrame, *keep: str) -> DataFrame:
    """Sheet data of docs (project_id, doc VARIANT) by the first filled key of each field."""
    get = lambda *keys: F.coalesce(*[F.nullif(F.try_variant_get("doc", _path(k), "string"), F.lit("")) for k in keys])
    x = docs.select(*keep, "project_id", F.inline(F.array(F.struct(*[get(*keys).alias(name) for name, keys in FIELDS.items()], *[F.try_variant_get("doc", f"$.{s}", "map<string,variant>").isNotNull().alias(f"has_{s}") for s in SECTIONS],
        F.coalesce(*[F.when(n > 0, n) for k in (*PAGE_KEYS, *[f"d.{k}" for k in PAGE_KEYS]) for n in [F.trim(F.try_variant_get("doc", _path(k), "string")).try_cast("int")]], F.lit(1)).alias("page"),
        *[F.coalesce(*[F.nullif(F.try_variant_get("doc", f"$.{d}.{k}", "string"), F.lit("")) for d in ("source_document", "source_document_info") for k in ks]).alias(n) for n, ks in (("uri", ("uri",)), ("storage_name", ("storage_metadata.storage_name", "storage_name")))],
    ))))
    one = sum((F.col(f"has_{s}").cast("int") for s in SECTIONS), F.lit(0)) == 1
    inferred = F.when(one, F.coalesce(*[F.when(F.col(f"has_{s}"), s.lower()) for s in SECTIONS]))
    path = F.nullif(F.ltrim(F.regexp_extract("uri", r"^[a-z]+://[^/]*(/[^?#]*)", 1), F.lit("/")), F.lit(""))
    inside = F.coalesce(path, F.trim("storage_name"))
    return x.select(
        *keep, F.coalesce("sheet_number", F.lit(NO_SHEET)).alias("sheet_number"), F.coalesce("sheet_title", F.lit("")).alias("sheet_title"), F.coalesce(F.nullif(F.lower(F.trim("told_discipline")), F.lit("")), inferred, F.lit(NO_DISCIPLINE)).alias("discipline"),
        F.coalesce("revision", F.lit(NO_REVISION)).alias("revision"), iso_date(F.col("told_date")).alias("revision_date"), F.coalesce("source_file", F.lit(NO_FILE)).alias("source_file"), F.trim("job_number").alias("job_number"),
        F.coalesce("project", F.nullif("project_id", F.lit("")), F.lit(NO_PROJECT)).alias("project"), "project_id", "page", F.nullif(F.split_part(F.regexp_extract("uri", r"^[a-z]+://([^/]*)", 1), F.lit("."), F.lit(1)), F.lit("")).alias("source_account"),
        F.when(inside.contains("/"), F.substring_index(inside, "/", 1)).alias("source_container"), F.when(inside.contains("/"), F.regexp_replace(inside, "^[^/]*/", "")).otherwise(inside).alias("source_blob"),
    )


def sheet_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet data of each structured drawing, with aliases, fallbacks, page and the place of its source."""
    return _metadata(_docs(spark, sf_dir).where("doc IS NOT NULL"), "state_id")


def _j(keys: tuple[str, ...]) -> str:
    return "coalesce(" + ", ".join(f"nullif(j->>'{_path(k)}', '')" for k in keys) + ", NULL)"


_HAS = {s: f"CAST(json_type(j, '$.{s}') = 'OBJECT' AS INT)" for s in SECTIONS}
_META = f"""
    d AS (SELECT state_id, project_id, CAST(parsed_json_data AS JSON) AS j FROM processing_state WHERE json_valid(parsed_json_data)),
    f AS (SELECT state_id, project_id, j, {', '.join(f'{_j(keys)} AS {name}' for name, keys in FIELDS.items())}, {' + '.join(f'coalesce({h}, 0)' for h in _HAS.values())} AS n_sections,
          coalesce({', '.join(f"CASE WHEN TRY_CAST(trim(j->>'{_path(k)}') AS INT) > 0 THEN TRY_CAST(trim(j->>'{_path(k)}') AS INT) END" for k in (*PAGE_KEYS, *[f'd.{k}' for k in PAGE_KEYS]))}, 1) AS page, j->>'$.source_document.uri' AS uri FROM d)"""
SHEET_METADATA_SQL = f"""
    WITH {_META}
    SELECT state_id, coalesce(sheet_number, 'sheet') AS sheet_number, coalesce(sheet_title, '') AS sheet_title,
        coalesce(nullif(lower(trim(told_discipline)), ''), CASE WHEN n_sections = 1 THEN CASE {' '.join(f"WHEN {h} = 1 THEN '{s.lower()}'" for s, h in _HAS.items())} END END, 'architectural') AS discipline, coalesce(revision, 'IFC') AS revision,
        coalesce(strftime(coalesce(TRY_CAST(told_date AS TIMESTAMP), try_strptime(told_date, ['%m/%d/%Y', '%m/%d/%y'])), '%Y-%m-%dT%H:%M:%SZ'), '2000-01-01T00:00:00Z') AS revision_date, coalesce(source_file, '<blob/path>.pdf') AS source_file, trim(job_number) AS job_number,
        coalesce(project, nullif(project_id, ''), 'Unnamed Project') AS project, project_id, CAST(page AS INT) AS page, nullif(split_part(regexp_extract(uri, '^[a-z]+://([^/]*)', 1), '.', 1), '') AS source_account,
        nullif(regexp_extract(uri, '^[a-z]+://[^/]*/+([^/?#]+)/', 1), '') AS source_container, nullif(regexp_extract(uri, '^[a-z]+://[^/]*/+[^/?#]+/([^?#]+)', 1), '') AS source_blob FROM f"""


def _truncated(c: Column) -> Column:
    return F.when(F.length(c) > MAX_CHARS, F.concat(F.rtrim(F.substring(c, 1, MAX_CHARS - 3)), F.lit("..."))).otherwise(c)


def _chunk_rows(docs: DataFrame) -> DataFrame:
    """Rows of schedule chunks: state_id, schedule_type, json_ptr, at (their order), r, given; those of a discipline's section or, where it
    has none, of the first block of the type that has rows."""
    rows = facts_plan.section_rows(docs.select("state_id", "doc"))
    ptr = F.coalesce(*[F.when(F.col("schedule_type") == kind, ptr) for _, kind, ptr in CHUNKS])
    own = rows.where(F.col("schedule_type").isin(*[kind for _, kind, _ in CHUNKS])).select("state_id", "schedule_type", ptr.alias("json_ptr"), F.lit(0).alias("rank"), F.monotonically_increasing_id().alias("at"), "r", "given")
    blocks = docs.select("state_id", F.posexplode(F.try_variant_get("doc", "$.blocks", VARIANTS)).alias("block_no", "b"))
    kind = T.schedule_type(*[F.try_variant_get("b", f"$.{n}", "string") for n in ("type", "name", "subtype")])
    listed = blocks.select("state_id", "block_no", kind.alias("schedule_type"), F.posexplode(F.try_variant_get("b", "$.rows", VARIANTS)).alias("pos", "r"))
    listed = listed.where(F.col("schedule_type").isin(*[kind for _, kind, _ in CHUNKS])).where(F.try_variant_get("r", "$", "map<string,variant>").isNotNull())
    listed = listed.select("state_id", "schedule_type", F.concat(F.lit("/blocks/"), "block_no").alias("json_ptr"), (F.col("block_no") + 1).alias("rank"), F.col("pos").cast("bigint").alias("at"), "r", facts_plan.no_given())
    return own.unionByName(listed)


def _notes(docs: DataFrame) -> DataFrame:
    """state_id and body of each sheet's notes."""
    notes = docs.select("state_id", F.inline(F.array(F.struct(F.coalesce(*[F.when(~F.coalesce(F.try_variant_get("doc", f"$.{k}", "string"), F.lit("x")).isin("", "[]", "{}"), F.try_variant_get("doc", f"$.{k}", "variant")) for k in ("notes", "NOTES", "general_notes")]).alias("v")))))
    filled = lambda c: F.filter(c, lambda s: s.isNotNull() & (s != "") & (s != "[]"))
    listed = F.array_join(F.transform(filled(F.transform(F.try_variant_get("v", "$", VARIANTS), lambda x: F.try_variant_get(x, "$", "string"))), lambda s: F.trim(s)), "\n")
    keyed = F.array_join(F.transform(F.filter(F.map_entries(F.try_variant_get("v", "$", "map<string,string>")), lambda e: e["value"].isNotNull() & (e["value"] != "")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    said = F.coalesce(listed, keyed, F.trim(F.try_variant_get("v", "$", "string")))
    return notes.select("state_id", said.alias("body")).where("body <> ''")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """state_id, kind_no, chunk_type, json_ptr, n_rows, content of each sheet's chunks."""
    docs = _docs(spark, sf_dir).where("doc IS NOT NULL")
    rows = facts_plan.described(_chunk_rows(docs))
    told = F.array_join(F.array_compact(F.array(*[F.concat(F.lit(f"{n}="), F.coalesce(F.col(f"_{n}"), F.col(f"a_{n}").cast("string") if n in (*facts_plan.TEXTS, *facts_plan.NUMBERS) else F.lit(None).cast("string"))) for n in TOLD])), ", ")
    line = F.nullif(F.when(F.lower("content") != "row", F.nullif(F.col("content"), F.lit(""))).otherwise(None), F.lit(""))
    line = F.coalesce(line, F.nullif(told, F.lit("")))
    # a type's first source with rows counts: its section, else the first such block
    grouped = rows.groupBy("state_id", "schedule_type", "rank", "json_ptr").agg(F.array_sort(F.collect_list(F.struct("at", line.alias("line")))).alias("lines"))
    first = grouped.groupBy("state_id", "schedule_type").agg(F.min(F.struct("rank", "json_ptr", "lines")).alias("c")).select("state_id", "schedule_type", "c.json_ptr", "c.lines")
    name = F.coalesce(*[F.when(F.col("schedule_type") == kind, chunk) for chunk, kind, _ in CHUNKS])
    number = F.coalesce(*[F.when(F.col("schedule_type") == kind, i) for i, (_, kind, _) in enumerate(CHUNKS)])
    sheets = _metadata(docs, "state_id", "doc").select("state_id", "sheet_number", "project_id", "job_number", "page", F.try_variant_get("doc", "$.tenant_id", "string").alias("tenant"))
    body = F.array_join(F.transform(F.filter(F.transform(F.slice("lines", 1, MAX_LINES), lambda x: x["line"]), lambda s: s.isNotNull()), lambda s: F.concat(F.lit("- "), s)), "\n")
    schedules = first.select("state_id", number.alias("kind_no"), name.alias("chunk_type"), "json_ptr", F.size("lines").alias("n_rows"), body.alias("body"))
    notes = _notes(docs).select("state_id", F.lit(3).alias("kind_no"), F.lit("notes").alias("chunk_type"), F.lit("/notes").alias("json_ptr"), F.lit(None).cast("int").alias("n_rows"), "body")
    general = docs.select("state_id", F.lit(4).alias("kind_no"), F.lit("general").alias("chunk_type"), F.lit("/content").alias("json_ptr"), F.lit(None).cast("int").alias("n_rows"), F.trim(F.coalesce(*[F.nullif(F.when(F.schema_of_variant(F.try_variant_get("doc", f"$.{k}", "variant")) == "STRING", F.try_variant_get("doc", f"$.{k}", "string")), F.lit("")) for k in ("content", "CONTENT")])).alias("body")).where("body <> ''")
    x = schedules.unionByName(notes).unionByName(general).join(sheets, "state_id")
    head = F.when(F.col("chunk_type") == "notes", F.concat("sheet_number", F.lit(" notes"))).when(F.col("chunk_type") == "general", F.concat("sheet_number", F.lit(" general context"))).otherwise(F.concat("sheet_number", F.lit(" "), F.initcap(F.replace(F.col("chunk_type"), F.lit("_"), F.lit(" "))), F.lit(" ("), "n_rows", F.lit(" rows)")))
    content = _truncated(F.when(F.col("body") == "", head).otherwise(F.concat(head, F.lit("\n"), "body")))
    # a sheet's few kinds of chunks are numbered within its own row
    each = x.groupBy("state_id").agg(F.array_sort(F.collect_list(F.struct("kind_no", "chunk_type", "json_ptr", "n_rows", content.alias("content"), "sheet_number", "project_id", "job_number", "page", "tenant"))).alias("cs"))
    x = each.select("state_id", F.posexplode("cs").alias("i", "c")).select("state_id", (F.col("i") + 1).alias("chunk_no"), "c.*")
    part = lambda c, fallback: T.key_part(c, fallback)
    key = F.concat_ws("-", part(F.col("tenant"), "tenant"), part(F.coalesce(F.nullif("job_number", F.lit("")), F.col("project_id")), "project"), part(F.col("sheet_number"), "sheet"), F.lit("chunk"), F.lpad(F.col("chunk_no").cast("string"), 4, "0"))
    return x.select("state_id", key.alias("chunk_id"), "chunk_no", "chunk_type", "json_ptr", "n_rows", "page", "content")


def sheet_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of each sheet: panel, mechanical and plumbing schedules, notes and general text, numbered in this order, each of at most
    30 lines and 1500 characters under a header."""
    return _chunks(spark, sf_dir)


def sheet_note_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the notes among the chunks."""
    docs = _docs(spark, sf_dir).where("doc IS NOT NULL")
    x = _notes(docs).join(_metadata(docs, "state_id").select("state_id", "sheet_number"), "state_id")
    return x.select("state_id", _truncated(F.concat("sheet_number", F.lit(" notes\n"), "body")).alias("content"))


def sheet_chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many chunks of each type there are, and of how many rows."""
    return _chunks(spark, sf_dir).groupBy("chunk_type").agg(F.count("*").alias("n_chunks"), F.sum("n_rows").alias("n_rows"))


_NOTES = "CASE " + " ".join(f"WHEN json_array_length(json_extract(j, '$.{k}')) > 0 THEN json_extract(j, '$.{k}')" for k in ("notes", "NOTES", "general_notes")) + " END"
_NOTE_BODY = f"array_to_string(list_transform(list_filter(from_json({_NOTES}, '[\"VARCHAR\"]'), lambda s: s <> ''), lambda s: trim(s)), chr(10))"
SHEET_NOTE_CHUNKS_SQL = f"""
    WITH {_META}, c AS (SELECT state_id, coalesce(sheet_number, 'sheet') || ' notes' || chr(10) || {_NOTE_BODY} AS body FROM f WHERE {_NOTE_BODY} <> '')
    SELECT state_id, CASE WHEN length(body) > 1500 THEN rtrim(body[1:1497]) || '...' ELSE body END AS content FROM c"""


def coverage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured items of each drawing against the facts made of them, by discipline: n_items, n_facts, is_covered."""
    docs = _docs(spark, sf_dir).where("doc IS NOT NULL")
    size = lambda path: F.greatest(F.coalesce(F.size(F.try_variant_get("doc", path, VARIANTS)), F.lit(0)), F.lit(0))
    first = lambda *paths: F.coalesce(*[F.when(size(p) > 0, size(p)) for p in paths], F.lit(0))
    panels = F.try_variant_get("doc", "$.ELECTRICAL.panels", VARIANTS)
    circuits = F.aggregate(F.transform(F.coalesce(panels, F.array().cast(VARIANTS)), lambda p: F.coalesce(*[F.when(F.size(F.try_variant_get(p, f"$.{k}", VARIANTS)) > 0, F.size(F.try_variant_get(p, f"$.{k}", VARIANTS))) for k in ("circuits", "circuit_details")], F.lit(0))), F.lit(0), lambda a, b: a + b)
    lists = lambda m: F.aggregate(F.transform(F.coalesce(F.map_values(m), F.array().cast(VARIANTS)), lambda v: F.greatest(F.coalesce(F.size(F.try_variant_get(v, "$", VARIANTS)), F.lit(0)), F.lit(0))), F.lit(0), lambda a, b: a + b)
    schedules = F.map_filter(F.try_variant_get("doc", "$.MECHANICAL", "map<string,variant>"), lambda k, v: F.upper(k).endswith("_SCHEDULE"))
    inner = F.map_filter(schedules, lambda k, v: F.try_variant_get(v, "$", VARIANTS).isNull())
    nested = F.aggregate(F.transform(F.coalesce(F.map_values(inner), F.array().cast(VARIANTS)), lambda v: sum((F.greatest(F.coalesce(F.size(F.try_variant_get(v, f"$.{k}", VARIANTS)), F.lit(0)), F.lit(0)) for k in facts_plan.MECH_LISTS), F.lit(0))), F.lit(0), lambda a, b: a + b)
    equipment = F.when(size("$.MECHANICAL.equipment") > 0, size("$.MECHANICAL.equipment")).otherwise(lists(F.try_variant_get("doc", "$.MECHANICAL.equipment", "map<string,variant>")))
    p = "$.PLUMBING."
    plumbing = first(p + "fixtures", p + "PLUMBING_FIXTURE_SCHEDULE") + first(p + "water_heaters", p + "waterHeaters", p + "ELECTRIC_WATER_HEATER_SCHEDULE") + size(p + "PUMP_SCHEDULE") + size(p + "SHOCK_ARRESTORS") + size(p + "THERMOSTATIC_MIXING_VALVE_SCHEDULE")
    arch = sum((size(f"$.ARCHITECTURAL.{k}") for k in ("WALL_TYPES", "PARTITION_TYPES", "DOOR_SCHEDULE", "CEILING_SCHEDULE", "FINISH_SCHEDULE")), F.lit(0))
    counts = F.array(*[F.struct(F.lit(d).alias("discipline"), n.cast("bigint").alias("n_items")) for d, n in (("electrical", circuits), ("mechanical", lists(schedules) + nested + equipment), ("plumbing", plumbing), ("architectural", arch))])
    items = docs.select("state_id", F.explode(counts).alias("c")).select("state_id", "c.*").where("n_items > 0")
    kind = F.col("schedule_type")
    discipline = F.when(kind == "panel", "electrical").when(kind == "mech_equipment", "mechanical").when(kind == "plumb_equipment", "plumbing").when(kind.isin("wall_partition", "door", "ceiling", "finish"), "architectural")
    made = facts_plan.emit_facts(docs.select("state_id", "doc")).groupBy("state_id", discipline.alias("discipline")).agg(F.count("*").alias("n_facts"))
    x = items.join(made, ["state_id", "discipline"], "left").fillna(0, ["n_facts"])
    return x.select("state_id", "discipline", "n_items", "n_facts", (F.col("n_facts") >= F.col("n_items")).alias("is_covered"))


def _len(path: str) -> str:
    return f"coalesce(json_array_length(json_extract(j, '{path}')), 0)"


def _first_len(*paths: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({_len(p)}, 0)" for p in paths) + ", 0)"


COVERAGE_CHECK_SQL = f"""
    WITH fa AS ({facts_plan.SQL['facts']}), {_META},
    e AS (SELECT state_id, 'electrical' AS discipline, coalesce(list_sum(list_transform(from_json(json_extract(j, '$.ELECTRICAL.panels'), '["JSON"]'), lambda p: coalesce(nullif(coalesce(json_array_length(json_extract(p, '$.circuits')), 0), 0), json_array_length(json_extract(p, '$.circuit_details')), 0))), 0) AS n FROM f),
    m AS (SELECT state_id, 'mechanical' AS discipline, coalesce(list_sum(list_transform(list_filter(json_keys(json_extract(j, '$.MECHANICAL')), lambda k: suffix(upper(k), '_SCHEDULE')), lambda k: CASE WHEN json_type(json_extract(j, '$.MECHANICAL."' || k || '"')) = 'ARRAY'
              THEN json_array_length(json_extract(j, '$.MECHANICAL."' || k || '"')) ELSE {' + '.join(f"""coalesce(json_array_length(json_extract(j, '$.MECHANICAL."' || k || '".{n}')), 0)""" for n in facts_plan.MECH_LISTS)} END)), 0)
              + CASE WHEN json_type(j, '$.MECHANICAL.equipment') = 'OBJECT' THEN coalesce(list_sum(list_transform(json_keys(json_extract(j, '$.MECHANICAL.equipment')), lambda k: coalesce(json_array_length(json_extract(j, '$.MECHANICAL.equipment."' || k || '"')), 0))), 0) ELSE {_len('$.MECHANICAL.equipment')} END AS n FROM f),
    p AS (SELECT state_id, 'plumbing' AS discipline, {_first_len('$.PLUMBING.fixtures', '$.PLUMBING.PLUMBING_FIXTURE_SCHEDULE')} + {_first_len('$.PLUMBING.water_heaters', '$.PLUMBING.waterHeaters', '$.PLUMBING.ELECTRIC_WATER_HEATER_SCHEDULE')} + {_len('$.PLUMBING.PUMP_SCHEDULE')} + {_len('$.PLUMBING.SHOCK_ARRESTORS')} + {_len('$.PLUMBING.THERMOSTATIC_MIXING_VALVE_SCHEDULE')} AS n FROM f),
    a AS (SELECT state_id, 'architectural' AS discipline, {' + '.join(_len(f'$.ARCHITECTURAL.{k}') for k in ('WALL_TYPES', 'PARTITION_TYPES', 'DOOR_SCHEDULE', 'CEILING_SCHEDULE', 'FINISH_SCHEDULE'))} AS n FROM f),
    i AS (SELECT * FROM e UNION ALL SELECT * FROM m UNION ALL SELECT * FROM p UNION ALL SELECT * FROM a),
    n AS (SELECT state_id, CASE schedule_type WHEN 'panel' THEN 'electrical' WHEN 'mech_equipment' THEN 'mechanical' WHEN 'plumb_equipment' THEN 'plumbing' WHEN 'unit_plan' THEN NULL ELSE 'architectural' END AS discipline, count(*) AS n_facts FROM fa GROUP BY ALL)
    SELECT i.state_id, i.discipline, CAST(n AS BIGINT) AS n_items, coalesce(n_facts, 0) AS n_facts, coalesce(n_facts, 0) >= n AS is_covered FROM i LEFT JOIN n ON i.state_id = n.state_id AND i.discipline = n.discipline WHERE n > 0"""

# Keys of a room's number and name in order, and the places that may list rooms, the first that is a list counting.
ROOM_NUMBER, ROOM_NAME = ("room_number", "number", "id", "room_id", "mark", "room"), ("room_name", "name", "function", "usage", "description")
ROOM_LISTS = ("$.ARCHITECTURAL.ROOMS", "$.rooms", "$.room_information.rooms")
# Forms of dimensions that pass for rooms.
DIMENSIONS = (r"DIMENSION", r"[0-9]\s*(?:'|FT)\b", r"[0-9]\s*(?:\"|IN)\b", r"[0-9]+\s*'\s*[xX×]\s*[0-9]+\s*'", r"(?s)(?:'|FT).*(?:\"|IN)|(?:\"|IN).*(?:'|FT)")


def identifier(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"\s+", " ")


def upper_slug(c: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.upper(c), "[^A-Z0-9]+", "_"), "^_|_$", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("UNIDENTIFIED"))


def is_dimension(c: Column) -> Column:
    """Whether a label is a dimension and no room."""
    return F.coalesce(F.upper(F.trim(c)).rlike("|".join(f"(?:{p})" for p in DIMENSIONS)), F.lit(False))


def room_scaffolds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rooms of each drawing, the first of each identifier: room_id, room_number, room_name and the parsed members."""
    docs = _docs(spark, sf_dir).where("doc IS NOT NULL")
    rooms = docs.select("state_id", F.posexplode(F.coalesce(*[F.try_variant_get("doc", p, VARIANTS) for p in ROOM_LISTS])).alias("pos", "r"))
    told = lambda keys: identifier(F.coalesce(*[F.nullif(F.try_variant_get("r", f"$.{k}", "string"), F.lit("")) for k in keys]))
    x = rooms.where(F.try_variant_get("r", "$", "map<string,variant>").isNotNull()).select("state_id", "pos", "r", F.inline(F.array(F.struct(told(ROOM_NUMBER).alias("n"), told(ROOM_NAME).alias("name")))))
    number = F.when(F.col("n").startswith("Room_"), F.replace(F.col("n"), F.lit("Room_"), F.lit(""))).otherwise(F.col("n"))
    x = x.withColumns({"n": F.when(~is_dimension(number), F.nullif(number, F.lit(""))), "name": F.when(~is_dimension(F.col("name")), F.nullif("name", F.lit("")))})
    x = x.withColumn("n", F.coalesce("n", "name")).where("n IS NOT NULL")
    label = F.when(F.col("name").isNotNull() & (F.lower("name") != F.lower("n")), F.concat_ws("_", "name", "n")).otherwise(F.coalesce("name", F.concat(F.lit("Room_"), "n")))
    x = x.select("state_id", upper_slug(F.col("n")).alias("slug"), F.struct("pos", F.col("n").alias("room_number"), label.alias("room_name"), F.to_json("r").alias("members")).alias("m"))
    x = x.groupBy("state_id", "slug").agg(F.min("m").alias("m"))
    return x.select("state_id", F.concat(F.lit("Room_"), "slug").alias("room_id"), "m.room_number", "m.room_name", F.size(F.json_object_keys("m.members")).alias("n_members"))


def _told_sql(keys: tuple[str, ...]) -> str:
    return "regexp_replace(trim(coalesce(" + ", ".join(f"nullif(r->>'$.{k}', '')" for k in keys) + ")), '\\s+', ' ', 'g')"


_DIM = "|".join(f"(?:{p})" for p in DIMENSIONS).replace("'", "''")
ROOM_SCAFFOLDS_SQL = f"""
    WITH d AS (SELECT state_id, coalesce({', '.join(f"CASE WHEN json_type(parsed_json_data, '{p}') = 'ARRAY' THEN json_extract(parsed_json_data, '{p}') END" for p in ROOM_LISTS)}) AS l FROM processing_state WHERE json_valid(parsed_json_data)),
    r AS (SELECT state_id, generate_subscripts(v, 1) AS pos, unnest(v) AS r FROM (SELECT state_id, from_json(l, '["JSON"]') AS v FROM d)),
    t AS (SELECT state_id, pos, r, {_told_sql(ROOM_NUMBER)} AS a, {_told_sql(ROOM_NAME)} AS b FROM r WHERE json_type(r) = 'OBJECT'),
    u AS (SELECT *, CASE WHEN starts_with(a, 'Room_') THEN replace(a, 'Room_', '') ELSE a END AS a2 FROM t),
    n AS (SELECT state_id, pos, r, CASE WHEN NOT regexp_matches(upper(trim(b)), '{_DIM}') THEN nullif(b, '') END AS name, CASE WHEN NOT regexp_matches(upper(trim(a2)), '{_DIM}') THEN nullif(a2, '') END AS num FROM u),
    m AS (SELECT *, coalesce(num, name) AS room_number FROM n WHERE coalesce(num, name) IS NOT NULL),
    s AS (SELECT *, coalesce(nullif(regexp_replace(regexp_replace(upper(room_number), '[^A-Z0-9]+', '_', 'g'), '^_|_$', '', 'g'), ''), 'UNIDENTIFIED') AS slug FROM m),
    k AS (SELECT *, row_number() OVER (PARTITION BY state_id, slug ORDER BY pos) AS i FROM s)
    SELECT state_id, 'Room_' || slug AS room_id, room_number, CASE WHEN name IS NOT NULL AND lower(name) <> lower(room_number) THEN name || '_' || room_number ELSE coalesce(name, 'Room_' || room_number) END AS room_name, CAST(len(json_keys(r)) AS INT) AS n_members FROM k WHERE i = 1"""

# Tags of a room template, each with the members of which one must be filled (or, for a path ending in .count, be more than none).
TEMPLATE_TAGS = {
    "lighting": ("circuits.lighting",), "power": ("circuits.power",), "emergency": ("circuits.emergency",), "critical": ("circuits.critical",), "ups": ("circuits.ups",), "outlets": ("outlets.regular_outlets", "outlets.controlled_outlets"),
    "gfci": ("outlets.gfci_outlets",), "hospital_grade": ("outlets.hospital_grade",), "emergency_power": ("outlets.red_outlets",), "mechanical": ("mechanical_equipment",), "appliances": ("appliances",),
    "fire_alarm": ("fire_alarm.smoke_detectors.count", "fire_alarm.heat_detectors.count", "fire_alarm.pull_stations.count", "fire_alarm.horn_strobes.count"), "data": ("data_telecom.data_outlets",), "wireless": ("data_telecom.wireless_ap",),
    "security": ("security.cameras.count",), "access_control": ("security.card_readers.count",), "audiovisual": ("audiovisual.displays.count", "audiovisual.projectors.count"), "nurse_call": ("nurse_call.stations.count",),
    "medical_gas": ("medical_gas.oxygen.count",), "medical_vacuum": ("medical_gas.vacuum.count",), "code_blue": ("nurse_call.code_blue",), "dimensions": ("dimensions",), "finishes": ("finishes",), "doors": ("doors.count",),
    "fire_rated": ("doors.fire_rated", "fire_life_safety.fire_rating_required"), "ada": ("accessibility.ada_required",), "clean_room": ("special_rooms.clean_room.classification",), "lab": ("special_rooms.lab.fume_hood",),
    "operating_room": ("special_rooms.operating_room.or_number",), "data_center": ("special_rooms.data_center.raised_floor",), "has_discrepancies": ("discrepancies",),
}


def is_filled(v: Column, path: str) -> Column:
    """Whether a member is there and neither empty, false nor zero."""
    return ~F.coalesce(F.try_variant_get(v, f"$.{path}", "string"), F.lit("")).isin("", "[]", "{}", "false", "0", "0.0")


def template_tags(v: Column) -> Column:
    """Sorted tags of a room template (VARIANT)."""
    tags = [F.when(F.greatest(*[is_filled(v, p) for p in paths], F.lit(False)), tag) for tag, paths in TEMPLATE_TAGS.items()]
    return F.array_sort(F.array_compact(F.array(*tags, F.when(F.try_variant_get(v, "$.template_status", "string") == "signed_off", "signed_off"))))


def template_summary(v: Column, kind: Column) -> Column:
    """A line that tells what an electrical or architectural room template holds."""
    get = lambda p: F.nullif(F.try_variant_get(v, f"$.{p}", "string"), F.lit(""))
    number = lambda p: F.coalesce(F.try_variant_get(v, f"$.{p}", "bigint"), F.lit(0))
    lights = F.transform(F.try_variant_get(v, "$.circuits.lighting", VARIANTS), lambda x: F.try_variant_get(x, "$", "string"))
    outlets = sum((number(f"outlets.{k}") for k in ("regular_outlets", "controlled_outlets", "gfci_outlets", "usb_outlets")), F.lit(0))
    alarms = sum((number(f"fire_alarm.{k}.count") for k in ("smoke_detectors", "heat_detectors", "pull_stations", "horn_strobes")), F.lit(0))
    counted = lambda n, what: F.when(n > 0, F.concat(n, F.lit(f" {what}")))
    said = lambda p, what: F.when(is_filled(v, p), what)
    told = lambda p, what: F.concat(F.lit(f"{what}: "), get(p))
    electrical = [
        F.when(F.size(lights) > 0, F.concat(F.lit("Lighting: "), F.array_join(F.slice(lights, 1, 3), ", "), F.when(F.size(lights) > 3, "...").otherwise(""))), counted(outlets, "outlets"), counted(alarms, "FA devices"), counted(number("data_telecom.data_outlets"), "data"),
        said("nurse_call.stations.count", "nurse call"), said("medical_gas.oxygen.count", "medical gas"), said("security.cameras.count", "security"),
    ]
    architectural = [
        told("dimensions", "Dims"), told("ceiling_height", "Ceiling"), told("finishes.floor.material", "Floor"), counted(number("doors.count"), "doors"), said("special_rooms.clean_room.classification", "clean room"), said("special_rooms.lab.fume_hood", "lab"),
        said("special_rooms.operating_room.or_number", "OR"), said("accessibility.ada_required", "ADA"),
    ]
    room, status = F.coalesce(get("room_id"), get("room_name"), F.lit("Space")), F.coalesce(F.try_variant_get(v, "$.template_status", "string"), F.lit("in_progress"))
    line = lambda name, parts: F.concat(room, F.lit(f" {name}"), F.coalesce(F.concat(F.lit(" — "), F.nullif(F.array_join(F.array_compact(F.array(*parts)), ", "), F.lit(""))), F.lit(" (empty)")), F.lit(" ("), status, F.lit(")"))
    return F.when(kind == "electrical", line("Electrical", electrical)).when(kind == "architectural", line("Architectural", architectural)).otherwise(F.concat(room, F.lit(" Template ("), kind, F.lit(") - Status: "), status))


QUERIES = {f.__name__: f for f in (sheet_metadata, sheet_chunks, sheet_note_chunks, sheet_chunk_counts, coverage_check, room_scaffolds)}
SQL = {"sheet_metadata": SHEET_METADATA_SQL, "sheet_note_chunks": SHEET_NOTE_CHUNKS_SQL, "coverage_check": COVERAGE_CHECK_SQL, "room_scaffolds": ROOM_SCAFFOLDS_SQL}
