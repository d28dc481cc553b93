"""Queries of the core's training-data operators (problems 1, 5, 6 and 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.operators import drift, nested, timestamps, units
from sheetloom.tables import materialise, table


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "schedule_row").select(F.lit("schedule_row").alias("rec_src"), F.col("row_id").alias("rec_id"), "project_id", F.col("revision_date").alias("value"), F.col("ingested_at").alias("seen_at"))
    drawings = table(spark, sf_dir, "drawing_metadata").select(F.lit("drawing_metadata").alias("rec_src"), F.col("meta_id").alias("rec_id"), "project_id", F.col("drawing_date").alias("value"), F.col("captured_at").alias("seen_at"))
    return rows.unionByName(drawings)


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestamps.normalise_timestamps(_values(spark, sf_dir), table(spark, sf_dir, "project_site"), source="project_id", keep=materialise)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTC instant of each usable value. Estimated zones serve sites that nobody declared; those are no cases here."""
    return _dated(spark, sf_dir).where(F.col("utc_us").isNotNull() & F.col("zone_source").isin("told", "declared")).select("rec_src", "rec_id", "utc_us")


def p1_zone_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values of each project took their zone from the value, the site table or the estimate."""
    return _dated(spark, sf_dir).groupBy("project_id", "zone_source").agg(F.count("*").alias("n_values"), F.countDistinct("zone_used").alias("n_zones"))


def p1_zone_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimate put to the test: the zone of each declared site as its values alone tell it, the declaration being hidden."""
    sites = table(spark, sf_dir, "project_site").where("site_tz IS NOT NULL")
    zones = sorted(r[0] for r in sites.select("site_tz").distinct().collect())  # bounded by the time-zone database
    hidden = sites.withColumn("site_tz", F.lit(None).cast("string"))
    dated = timestamps.normalise_timestamps(_values(spark, sf_dir), hidden, source="project_id", keep=materialise, candidates=zones)
    use = dated.where("zone_source IN ('estimated', 'open')").groupBy("project_id").agg(F.max("zone_used").alias("estimated_tz"), F.count("*").alias("n_values"))
    return sites.select("project_id", "site_tz").join(use, "project_id").select("project_id", "site_tz", "estimated_tz", "n_values")


def _rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rooms = table(spark, sf_dir, "a_rooms_template").select("room_key", F.col("metrics.ceiling_height").alias("ceiling_height"), F.col("metrics.square_footage").alias("square_footage"), F.col("metrics.dimensions").alias("dimensions"), F.col("notes.field").alias("note"))
    side = r"^(\d+)'(?:-(\d+)\")? x (\d+)'(?:-(\d+)\")?$"
    feet = lambda i: F.nullif(F.regexp_extract("dimensions", side, i), F.lit("")).cast("double") + F.coalesce(F.nullif(F.regexp_extract("dimensions", side, i + 1), F.lit("")).cast("double"), F.lit(0.0)) / 12
    rooms = rooms.withColumns({"length_ft": feet(1), "width_ft": feet(3)})
    return units.resolve_units(rooms, [units.CEILING_HEIGHT, units.ROOM_AREA], [units.Identity({"area": 1, "length_ft": -1, "width_ft": -1})], ["length_ft", "width_ft"])


def _loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "schedule_row").select("row_id", "kva", "amps", "content", F.when(F.trim("poles") == "3", 3.0**0.5).when(F.trim("poles").isin("1", "2"), 1.0).alias("phases"))
    # load = voltage x current x phases: the identity's level is the log of the usual voltage, its spread tells how far it is trusted
    return units.resolve_units(rows, [units.LOAD, units.CURRENT], [units.Identity({"kva": 1, "amps": -1, "phases": -1})], ["phases"])


def _long(df: DataFrame, key: str, names: dict[str, str]) -> DataFrame:
    """One row per value from one pass over df."""
    each = F.array(*[F.struct(F.lit(src).alias("rec_src"), F.col(f"{n}_val").alias("val"), F.col(f"{n}_basis").alias("basis"), F.col(f"{n}_unit").alias("unit"), F.col(f"{n}_unique").alias("is_unique")) for n, src in names.items()])
    return df.select(F.col(key).alias("rec_id"), F.explode(each).alias("v")).select("v.rec_src", "rec_id", "v.val", "v.basis", "v.unit", "v.is_unique").where("val IS NOT NULL")


def _quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rooms = _long(_rooms(spark, sf_dir), "room_key", {"ceiling": "room_ceiling", "area": "room_area"})
    rows = _long(_loads(spark, sf_dir), "row_id", {"kva": "row_kva", "amps": "row_amps"})
    return rooms.unionByName(rows)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each value with a known unit in its common unit; a unit that only residuals suggest is not known."""
    return _quantities(spark, sf_dir).where("basis <> 'inferred'").select("rec_src", "rec_id", F.round("val").cast("bigint").alias("norm_val"))


def p5_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the unit of each value became known, and how many choices were not unique."""
    return _quantities(spark, sf_dir).groupBy("rec_src", "basis", "unit").agg(F.count("*").alias("n_values"), F.count_if(~F.col("is_unique")).alias("n_not_unique"))


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat tables of both sources' records, in one long form."""
    out = None
    for src, key, text in (("processing_state", "state_id", "parsed_json_data"), ("extraction_result", "extraction_id", "tables_json")):
        records = table(spark, sf_dir, src)
        rows = nested.flat_rows(records, key, text, nested.schema_graph(records, text)).withColumn("rec_src", F.lit(src))
        out = rows if out is None else out.unionByName(rows)
    return out


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each object that is an array's element, a row of its table, with the nearest such object around it."""
    return _flat(spark, sf_dir).where("is_item").select("rec_src", "rec_id", "obj_path", F.col("item_path").alias("parent_path"))


def p6_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the flat tables with their parents and how many cells they hold; p6_cells has these."""
    return _flat(spark, sf_dir).select("rec_src", "rec_id", "table_name", "obj_path", "parent_table", "parent_path", "ordinal", F.size("cells").alias("n_cells"))


def p6_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells of the flat tables: row, column and text."""
    return _flat(spark, sf_dir).select("rec_src", "rec_id", "table_name", "obj_path", F.explode("cells").alias("name", "cell"))


def p6_circuits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of the flat tables: circuits of panels, each with its panel's row."""
    return nested.flat_table(_flat(spark, sf_dir).where("rec_src = 'processing_state'"), "circuits", ["circuit_number", "load_name", "trip", "poles"])


def p6_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat tables of both sources: rows, those with a parent, and columns of each."""
    rows = materialise(_flat(spark, sf_dir).select("rec_src", "table_name", "parent_path", F.map_keys("cells").alias("names")))
    columns = rows.select("rec_src", "table_name", F.explode("names").alias("c")).groupBy("rec_src", "table_name").agg(F.countDistinct("c").alias("n_columns"))
    return rows.groupBy("rec_src", "table_name").agg(F.count("*").alias("n_rows"), F.count("parent_path").alias("n_with_parent")).join(columns, ["rec_src", "table_name"], "left").fillna(0, ["n_columns"])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of each file against the one before in its feed."""
    return drift.schema_changes(table(spark, sf_dir, "drift_record"), keep=materialise).select("file_id", "change_kind", "old_name", "new_name")


def p7_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records in one table with one column per meaning."""
    records = table(spark, sf_dir, "drift_record")
    return drift.unified(records, drift.schema_changes(records, keep=materialise), ["record_no", "feed_id", "file_id", "record_key"])


def p7_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values each record keeps in the unified table, those left over included: as many as it told."""
    x = p7_unified(spark, sf_dir)
    filled = sum((F.col(c).isNotNull().cast("int") for c in x.columns if c.startswith("f_")), F.lit(0))
    return x.select("record_no", (filled + F.greatest(F.coalesce(F.size("left_over"), F.lit(0)), F.lit(0))).alias("n_values"))


QUERIES = {f.__name__: f for f in (p1_found, p1_zone_use, p1_zone_estimates, p5_found, p5_basis, p6_found, p6_rows, p6_cells, p6_circuits, p6_tables, p7_found, p7_unified, p7_filled)}

P6_SQL = """
    WITH RECURSIVE n(rec_src, rec_id, v, kind, ptr, around, is_item) AS (
        SELECT 'processing_state', state_id, CAST(parsed_json_data AS JSON), json_type(parsed_json_data), '', '', false FROM processing_state WHERE json_valid(parsed_json_data)
        UNION ALL SELECT 'extraction_result', extraction_id, CAST(tables_json AS JSON), json_type(tables_json), '', '', false FROM extraction_result WHERE json_valid(tables_json)
        UNION ALL SELECT n.rec_src, n.rec_id, e.value, e.type, n.ptr || '/' || replace(replace(CAST(e.key AS VARCHAR), '~', '~0'), '/', '~1'), CASE WHEN n.is_item THEN n.ptr ELSE n.around END, n.kind = 'ARRAY' AND e.type = 'OBJECT'
        FROM n, json_each(n.v) e WHERE n.kind IN ('OBJECT', 'ARRAY'))
    SELECT rec_src, rec_id, ptr AS obj_path, around AS parent_path FROM n WHERE is_item"""

_P6_ROWS = """
    n(rec_src, rec_id, v, kind, ptr, tag, is_item, ord, up) AS (
        SELECT 'processing_state', state_id, CAST(parsed_json_data AS JSON), json_type(parsed_json_data), '', 'record', false, 0, CAST([] AS STRUCT(p VARCHAR, t VARCHAR)[]) FROM processing_state WHERE json_valid(parsed_json_data)
        UNION ALL SELECT 'extraction_result', extraction_id, CAST(tables_json AS JSON), json_type(tables_json), '', 'record', false, 0, CAST([] AS STRUCT(p VARCHAR, t VARCHAR)[]) FROM extraction_result WHERE json_valid(tables_json)
        UNION ALL SELECT n.rec_src, n.rec_id, e.value, e.type, n.ptr || '/' || replace(replace(CAST(e.key AS VARCHAR), '~', '~0'), '/', '~1'), CASE WHEN n.kind = 'OBJECT' THEN CAST(e.key AS VARCHAR) ELSE n.tag END,
            n.kind = 'ARRAY', CASE WHEN n.kind = 'ARRAY' THEN TRY_CAST(e.key AS INT) ELSE 0 END, CASE WHEN n.kind = 'OBJECT' THEN list_append(n.up, {'p': n.ptr, 't': n.tag}) ELSE n.up END
        FROM n, json_each(n.v) e WHERE n.kind IN ('OBJECT', 'ARRAY')),
    o AS (SELECT * FROM n WHERE kind = 'OBJECT'),
    g AS (SELECT rec_src, tag FROM o GROUP BY rec_src, tag HAVING bool_or(is_item) OR bool_or(list_contains(list_transform(up, lambda u: u.t), tag)) OR count(DISTINCT up[-1].t) > 1 OR tag = 'record'),
    l AS (SELECT rec_src, list(tag) AS names FROM g GROUP BY rec_src),
    w AS (SELECT o.*, list_contains(l.names, o.tag) AS is_row, list_filter(o.up, lambda u: list_contains(l.names, u.t))[-1] AS above FROM o JOIN l USING (rec_src)),
    c AS (SELECT w.rec_src, w.rec_id, CASE WHEN is_row THEN ptr ELSE above.p END AS owner, replace(CASE WHEN is_row THEN '' ELSE substr(ptr, length(above.p) + 2) || '.' END, '/', '.') || replace(replace(CAST(e.key AS VARCHAR), '~', '~0'), '/', '~1') AS name,
          CASE WHEN e.type = 'NULL' THEN NULL WHEN e.type = 'VARCHAR' THEN e.value->>'$' ELSE CAST(e.value AS VARCHAR) END AS cell
          FROM w, json_each(w.v) e WHERE e.type NOT IN ('OBJECT', 'ARRAY') OR e.type = 'ARRAY' AND (json_array_length(e.value) = 0 OR NOT list_bool_and(list_transform(from_json(e.value, '["JSON"]'), lambda x: json_type(x) = 'OBJECT'))))"""
P6_ROWS_SQL = f"""
    WITH RECURSIVE {_P6_ROWS},
    k AS (SELECT rec_src, rec_id, owner, CAST(count(*) AS INT) AS n_cells FROM c GROUP BY ALL)
    SELECT w.rec_src, w.rec_id, tag AS table_name, ptr AS obj_path, above.t AS parent_table, above.p AS parent_path, CAST(ord AS INT) AS ordinal, coalesce(n_cells, 0) AS n_cells FROM w LEFT JOIN k ON w.rec_src = k.rec_src AND w.rec_id = k.rec_id AND w.ptr = k.owner WHERE is_row"""
P6_TABLES_SQL = f"""
    WITH RECURSIVE {_P6_ROWS},
    k AS (SELECT w.rec_src, w.tag, count(DISTINCT name) AS n_columns FROM c JOIN w ON w.rec_src = c.rec_src AND w.rec_id = c.rec_id AND w.ptr = c.owner GROUP BY ALL)
    SELECT r.rec_src, r.tag AS table_name, n_rows, n_with_parent, coalesce(n_columns, 0) AS n_columns FROM (SELECT rec_src, tag, count(*) AS n_rows, count(above.p) AS n_with_parent FROM w WHERE is_row GROUP BY ALL) r LEFT JOIN k USING (rec_src, tag)"""
P6_CELLS_SQL = f"""
    WITH RECURSIVE {_P6_ROWS}
    SELECT c.rec_src, c.rec_id, w.tag AS table_name, owner AS obj_path, name, cell FROM c JOIN w ON w.rec_src = c.rec_src AND w.rec_id = c.rec_id AND w.ptr = c.owner"""
P6_CIRCUITS_SQL = f"""
    WITH RECURSIVE {_P6_ROWS}
    SELECT w.rec_id, ptr AS obj_path, above.t AS parent_table, above.p AS parent_path, CAST(ord AS INT) AS ordinal, v->>'$.circuit_number' AS c_circuit_number, v->>'$.load_name' AS c_load_name, v->>'$.trip' AS c_trip, v->>'$.poles' AS c_poles
    FROM w WHERE is_row AND rec_src = 'processing_state' AND tag = 'circuits'"""

P7_SQL = """
    WITH f AS (SELECT feed_id, file_id, file_no, record_key, e.key AS field, CASE e.type WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN NULL ELSE 'number' END AS kind, e.value->>'$' AS raw
               FROM drift_record d, json_each(d.payload) e),
    g AS (SELECT *, CASE WHEN regexp_matches(raw, '^\\s*[+-]?[0-9]{1,20}(\\.[0-9]{1,15})?\\s*$') THEN CAST(CAST(trim(raw) AS DECIMAL(38, 15)) AS VARCHAR) ELSE raw END AS val FROM f),
    k AS (SELECT feed_id, file_id, field, kind FROM (SELECT *, row_number() OVER (PARTITION BY feed_id, file_id, field ORDER BY kind IS NULL, n DESC, kind) AS r FROM (SELECT feed_id, file_id, field, kind, count(*) AS n FROM f GROUP BY ALL)) WHERE r = 1),
    files AS (SELECT feed_id, file_id, row_number() OVER w AS rank, lead(file_id) OVER w AS next_file FROM (SELECT DISTINCT feed_id, file_id, file_no FROM drift_record) WINDOW w AS (PARTITION BY feed_id ORDER BY file_no, file_id)),
    x AS (SELECT *, lag(rank) OVER w AS before, lead(rank) OVER w AS after, lag(kind) OVER w AS kind_before FROM k JOIN files USING (feed_id, file_id) WINDOW w AS (PARTITION BY feed_id, field ORDER BY rank)),
    starts AS (SELECT file_id, field, kind FROM x WHERE rank > 1 AND (before IS NULL OR before < rank - 1)),
    ends AS (SELECT next_file AS file_id, file_id AS prev_file, field, kind FROM x WHERE next_file IS NOT NULL AND (after IS NULL OR after > rank + 1)),
    o AS (SELECT DISTINCT e.file_id, g.record_key, g.field, g.val FROM g JOIN ends e ON g.file_id = e.prev_file AND g.field = e.field WHERE g.kind IS NOT NULL),
    n AS (SELECT DISTINCT s.file_id, g.record_key, g.field, g.val FROM g JOIN starts s ON g.file_id = s.file_id AND g.field = s.field WHERE g.kind IS NOT NULL),
    p AS (SELECT o.file_id, o.field AS old_name, n.field AS new_name, count(DISTINCT o.record_key) AS keys, count(DISTINCT o.record_key) FILTER (o.val = n.val) AS same FROM o JOIN n ON o.file_id = n.file_id AND o.record_key = n.record_key GROUP BY ALL),
    r AS (SELECT file_id, old_name, new_name FROM (SELECT *, row_number() OVER (PARTITION BY file_id, old_name ORDER BY same / keys DESC, same DESC, new_name) AS a, row_number() OVER (PARTITION BY file_id, new_name ORDER BY same / keys DESC, same DESC, old_name) AS b FROM p WHERE same > 0 AND same >= 0.5 * keys) WHERE a = 1 AND b = 1)
    SELECT file_id, 'renamed' AS change_kind, old_name, new_name FROM r
    UNION ALL SELECT file_id, 'removed', field, '' FROM ends e WHERE NOT EXISTS (FROM r WHERE r.file_id = e.file_id AND r.old_name = e.field)
    UNION ALL SELECT file_id, 'added', '', field FROM starts s WHERE NOT EXISTS (FROM r WHERE r.file_id = s.file_id AND r.new_name = s.field)
    UNION ALL SELECT file_id, 'type_changed', field, field FROM x WHERE before = rank - 1 AND kind <> kind_before
    UNION ALL SELECT r.file_id, 'type_changed', old_name, new_name FROM r JOIN ends e ON r.file_id = e.file_id AND r.old_name = e.field JOIN starts s ON r.file_id = s.file_id AND r.new_name = s.field WHERE e.kind <> s.kind"""

P7_FILLED_SQL = """SELECT record_no, CAST(CASE WHEN json_type(payload) = 'OBJECT' THEN len(list_filter(json_keys(payload), lambda k: json_type(payload, '$."' || k || '"') <> 'NULL')) ELSE 0 END AS INT) AS n_values FROM drift_record"""

_DIGITS = "CASE WHEN regexp_matches({0}, '^[0-9]{{1,3}}(,[0-9]{{3}})+(\\.[0-9]+)?$') THEN TRY_CAST(replace({0}, ',', '') AS DOUBLE) ELSE TRY_CAST(replace({0}, ',', '.') AS DOUBLE) END"


def _clean_sql(c: str) -> str:
    return f"""translate(lower(trim({c})), '′’″”²', '''''""2')"""


def _told_sql(v: str, notations: dict[str, tuple[str, float]]) -> str:
    """Value of a number with its unit, in the common unit."""
    number = _DIGITS.format(f"regexp_extract({v}, '^[0-9.,]+')")
    cases = " ".join("WHEN regexp_matches({}, '^[0-9][0-9.,]* ?(?:{})$') THEN {} * CAST({!r} AS DOUBLE)".format(v, p.replace("'", "''"), number, f) for p, f in notations.values())
    return f"CASE {cases} END"


def _stated_sql(v: str, text: str, patterns: dict[str, float], otherwise: str) -> str:
    """Value of a bare number: patterns of the record's text with their factors, else a factor or NULL."""
    cases = " ".join(f"WHEN regexp_matches(replace(lower(coalesce({text}, '')), '²', '2'), '{p}') THEN {f!r}" for p, f in patterns.items())
    return f"CASE WHEN regexp_matches({v}, '^[0-9][0-9.,]*$') THEN {_DIGITS.format(v)} * CAST(CASE {cases} ELSE {otherwise} END AS DOUBLE) END"


def _group_sql(pattern: str, i: int) -> str:
    return f"TRY_CAST(regexp_extract(h, '{pattern}', {i}) AS DOUBLE)"


def _p5_sql() -> str:
    feet = "^([0-9]+) ?(?:''|ft\\.?|feet)[ -]*([0-9]+)?(?: ?([0-9]+)/([0-9]+))? ?(?:\"|in\\.?|inches)$"
    part = "^(?:([0-9]+) )?([0-9]+)/([0-9]+) ?(?:\"|in\\.?)$"
    height_words = {"inch|inches": 254.0, "feet|ft": 3048.0, "mm|millimet(?:re|er)s?": 10.0, "cm|centimet(?:re|er)s?": 100.0, "m|met(?:re|er)s?": 10000.0}
    said = {f"\\b(?:heights?|dimensions?)\\b[^.]*\\bin (?:{w})\\b": f for w, f in height_words.items()}
    g = _group_sql
    ceiling = (
        f"CASE WHEN regexp_matches(h, '{feet}') THEN 254 * (12 * {g(feet, 1)} + coalesce({g(feet, 2)}, 0) + coalesce({g(feet, 3)} / {g(feet, 4)}, 0)) "
        f"WHEN regexp_matches(h, '{part}') THEN 254 * (coalesce({g(part, 1)}, 0) + {g(part, 2)} / {g(part, 3)}) ELSE coalesce({_told_sql('h', units.CEILING)}, {_stated_sql('h', 'note', said, 'NULL')}) END"
    )
    areas = {"\\bareas?\\b[^.]*\\bin (?:m2|sq m|square met(?:re|er)s?)": units.AREA["sqm"][1], "\\bareas?\\b[^.]*\\bin (?:sq yd|square yards?)": 9.0}
    area = f"coalesce({_told_sql('a', units.AREA)}, {_stated_sql('a', 'note', areas, '1.0')})"
    kva = f"coalesce({_told_sql('k', units.KVA)}, {_stated_sql('k', 'content', {'\\bloads?\\b[^;()]*[ ,](?:va|volt-amperes)(?:[^a-z-]|$)|(?:^|[^a-z])va loads?\\b': 1.0}, '1000.0')})"
    amps = f"coalesce({_told_sql('a', units.AMPS)}, {_stated_sql('a', 'content', {'\\bcurrents?\\b[^;()]*\\b(?:ma|milliamps?)(?:[^a-z]|$)': 1.0}, '1000.0')})"
    return f"""
    WITH r AS (SELECT room_key, trim(regexp_replace({_clean_sql('metrics.ceiling_height')}, ' ?a\\.?f\\.?f\\.?$', '')) AS h, {_clean_sql('metrics.square_footage')} AS a, notes.field AS note FROM a_rooms_template),
    s AS (SELECT row_id, {_clean_sql('kva')} AS k, {_clean_sql('amps')} AS a, content FROM schedule_row),
    v AS (SELECT 'room_ceiling' AS rec_src, room_key AS rec_id, {ceiling} AS val FROM r UNION ALL SELECT 'room_area', room_key, {area} FROM r
          UNION ALL SELECT 'row_kva', row_id, {kva} FROM s UNION ALL SELECT 'row_amps', row_id, {amps} FROM s)
    SELECT rec_src, rec_id, CAST(round(val) AS BIGINT) AS norm_val FROM v WHERE val > 0"""


def _p1_sql() -> str:
    time = r"([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?"
    zone = r"(Z|[+-][0-9]{2}:?[0-9]{2}|[A-Za-z]{2,5}|\[[A-Za-z_/+0-9-]+\]|[A-Za-z_]+(?:/[A-Za-z_-]+)+)?"
    tail = rf"(?:,? +{time}(?: *([AaPp])[Mm])?(?: +{zone})?)?$"
    notations = [
        (rf"^([0-9]{{4}})-([0-9]{{1,2}})-([0-9]{{1,2}})(?:[T ] *{time} *{zone})?$", r"\1|\2|\3|\4|\5|\6|\7||\8|c"), (rf"^([0-9]{{1,2}})[/.-]([0-9]{{1,2}})[/.-]([0-9]{{4}}|[0-9]{{2}}){tail}", r"\3|\1|\2|\4|\5|\6|\7|\8|\9|n"),
        (r"^([0-9]{4})([0-9]{2})([0-9]{2})$", r"\1|\2|\3|||||||c"), (r"^([0-9]{10}(?:[0-9]{3})?)$", r"\1|||||||||e"), (rf"^(?:\pL+,? +)?([0-9]{{1,2}})(?:\. *|[ -]+)(\pL+)\.?[ -]+([0-9]{{4}}|[0-9]{{2}}){tail}", r"\3|\2|\1|\4|\5|\6|\7|\8|\9|c"),
        (rf"^(\pL+)\.? +([0-9]{{1,2}}), *([0-9]{{4}}){tail}", r"\3|\1|\2|\4|\5|\6|\7|\8|\9|c"), (r"^D:([0-9]{4})([0-9]{2})([0-9]{2})([0-9]{2})([0-9]{2})([0-9]{2})(Z|[+-][0-9]{2})?'?([0-9]{2})?'?$", r"\1|\2|\3|\4|\5|\6|||\7\8|c"),
    ]
    quoted = [(p.replace("'", "''"), r) for p, r in notations]
    parts = "CASE " + " ".join(f"WHEN regexp_matches(v, '{p}') THEN regexp_replace(v, '{p}', '{r}')" for p, r in quoted) + " END"
    prefix = "translate(lower(m), 'äéèêûàá', 'aeeeuaa')"
    months = " ".join(f"WHEN starts_with({prefix}, '{k}') THEN {n}" for k, n in sorted(timestamps.MONTH_PREFIXES.items(), key=lambda x: -len(x[0])))
    zones = ["America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles", "America/Phoenix", "Europe/London", "Europe/Berlin", "Australia/Sydney", "Asia/Tokyo", "Asia/Kolkata"]
    known = " ".join(f"WHEN '{k}' THEN {n}" for k, n in timestamps.abbreviation_offsets(zones).items())
    return f"""
    WITH v AS (SELECT 'schedule_row' AS rec_src, row_id AS rec_id, project_id, trim(revision_date) AS v FROM schedule_row UNION ALL SELECT 'drawing_metadata', meta_id, project_id, trim(drawing_date) FROM drawing_metadata),
    p AS (SELECT rec_src, rec_id, site_tz AS tz, date_order AS o, string_split({parts}, '|') AS a FROM v LEFT JOIN project_site USING (project_id)),
    q AS (SELECT *, CASE WHEN a[10] = 'n' AND o = 'DMY' THEN a[3] WHEN a[10] = 'c' OR o = 'MDY' THEN a[2] END AS m, CASE WHEN a[10] = 'n' AND o = 'DMY' THEN a[2] WHEN a[10] = 'c' OR o = 'MDY' THEN a[3] END AS d, translate(a[9], '[]', '') AS z FROM p WHERE a IS NOT NULL),
    t AS (SELECT *, TRY_CAST(printf('%04d-%02d-%02d %02d:%02d:%02d', CAST(a[1] AS INT) + CASE WHEN length(a[1]) = 2 THEN 2000 ELSE 0 END, CASE WHEN regexp_matches(m, '^[0-9]') THEN TRY_CAST(m AS INT) ELSE CASE {months} END END, TRY_CAST(d AS INT),
                 CASE WHEN a[8] = '' THEN coalesce(TRY_CAST(a[4] AS INT), 0) ELSE TRY_CAST(a[4] AS INT) % 12 + CASE WHEN lower(a[8]) = 'p' THEN 12 ELSE 0 END END, coalesce(TRY_CAST(a[5] AS INT), 0), coalesce(TRY_CAST(a[6] AS INT), 0)) AS TIMESTAMP) AS l,
                 coalesce(TRY_CAST(rpad(a[7][1:6], 6, '0') AS BIGINT), 0) AS f FROM q WHERE a[10] <> 'e'),
    w AS (SELECT *, CASE WHEN upper(z) IN ('Z', 'UTC', 'GMT') THEN 0 WHEN regexp_matches(z, '^[+-]') THEN (CASE WHEN starts_with(z, '-') THEN -1 ELSE 1 END) * (CAST(z[2:3] AS INT) * 3600 + coalesce(TRY_CAST(replace(z, ':', '')[4:5] AS INT), 0) * 60)
                 WHEN z <> '' AND NOT contains(z, '/') THEN CASE tz || '|' || upper(z) {known} END END AS ofs, CASE WHEN contains(z, '/') THEN z WHEN z = '' THEN tz END AS zone FROM t WHERE l IS NOT NULL),
    u AS (SELECT *, timezone(zone, l) AS inst FROM w)
    SELECT rec_src, rec_id, CASE WHEN ofs IS NOT NULL THEN epoch_us(l) - CAST(ofs AS BIGINT) * 1000000 WHEN timezone(zone, inst - INTERVAL 1 HOUR) = l THEN epoch_us(inst) - 3600000000 ELSE epoch_us(inst) END + f AS utc_us FROM u WHERE ofs IS NOT NULL OR zone IS NOT NULL
    UNION ALL SELECT rec_src, rec_id, CAST(a[1] AS BIGINT) * CASE WHEN length(a[1]) = 10 THEN 1000000 ELSE 1000 END FROM p WHERE a[10] = 'e'"""


SQL: dict[str, str] = {"p1_found": _p1_sql(), "p5_found": _p5_sql(), "p6_found": P6_SQL, "p6_rows": P6_ROWS_SQL, "p6_tables": P6_TABLES_SQL, "p6_cells": P6_CELLS_SQL, "p6_circuits": P6_CIRCUITS_SQL, "p7_found": P7_SQL, "p7_filled": P7_FILLED_SQL}
