"""Structured drawings to flat documents: schedule rows, sheet data, coverage, identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetloom.functions import text as T
from sheetloom.plans.sheets import template_tags
from sheetloom.tables import table

VARIANTS = "array<variant>"


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sheet and schedule type how many rows have a full key, a load and a current; rooms as a type of their own."""
    rows = table(spark, sf_dir, "schedule_row").groupBy("sheet_number", "schedule_type").agg(F.count("*").alias("total"), F.count_if(F.col("panel_name").isNotNull() & F.col("circuit_number").isNotNull()).alias("with_panel_circuit"), F.count_if(F.col("kva").isNotNull()).alias("with_kva"), F.count_if(F.col("amps").isNotNull()).alias("with_amps"))
    rooms = table(spark, sf_dir, "a_rooms_template").groupBy("sheet_number").agg(F.count("*").alias("total"), F.count_if(F.col("template_status") == "signed_off").alias("signed_off"))
    none = F.lit(None).cast("bigint")
    return rows.withColumn("signed_off", none).unionByName(rooms.select("sheet_number", F.lit("template").alias("schedule_type"), "total", none.alias("with_panel_circuit"), none.alias("with_kva"), none.alias("with_amps"), "signed_off"))


COVERAGE_SQL = """
    SELECT sheet_number, schedule_type, count(*) AS total, count(*) FILTER (panel_name IS NOT NULL AND circuit_number IS NOT NULL) AS with_panel_circuit, count(kva) AS with_kva, count(amps) AS with_amps, CAST(NULL AS BIGINT) AS signed_off FROM schedule_row GROUP BY ALL
    UNION ALL SELECT sheet_number, 'template', count(*), NULL, NULL, NULL, count(*) FILTER (template_status = 'signed_off') FROM a_rooms_template GROUP BY ALL"""


def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed upsert: of rows with one id the last taken in counts. Partial aggregates keep an id that many rows share from being
    gathered; levels come as text."""
    rows = table(spark, sf_dir, "schedule_row").withColumn("levels", F.array_join("levels", "|"))
    own = [c for c in rows.columns if c not in ("id", "ingested_at", "row_id")]
    last = F.max(F.struct("ingested_at", "row_id", *own)).alias("m")
    return rows.groupBy("id").agg(last, F.count("*").alias("n_versions")).select("id", "m.row_id", *[f"m.{c}" for c in own], "n_versions")


LATEST_ROWS_SQL = """
    SELECT * EXCLUDE (n, ingested_at) REPLACE (array_to_string(levels, '|') AS levels) FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n_versions, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC, row_id DESC) AS n FROM schedule_row) WHERE n = 1"""


def drawing_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discipline, subtype, slug and version of drawing files by name."""
    f = F.col("source_file")
    return table(spark, sf_dir, "drawing_metadata").select("meta_id", T.discipline(f).alias("discipline"), T.subtype(f).alias("subtype"), T.drawing_slug(T.base_name(f)).alias("drawing_slug"), T.drawing_version(T.base_name(f)).alias("version"))


_NAME = "upper(regexp_extract(source_file, '[^/]*$'))"
_STEM = "regexp_replace(regexp_replace(regexp_extract(source_file, '[^/]*$'), '\\.[A-Za-z0-9]+$', ''), '(?i)rev(?:ision)?[\\s._-]*([A-Za-z0-9]+)', '', 'g')"
DRAWING_TYPES_SQL = f"""
    SELECT meta_id, CASE WHEN coalesce({_NAME}, '') = '' THEN 'General' {' '.join(
        f"WHEN starts_with({_NAME}, '{c}') THEN " + (f"CASE WHEN regexp_matches({_NAME}, '{T.ALARM_WORDS}') THEN 'FireAlarm' ELSE '{d}' END" if d == "LowVoltage" else f"'{d}'") for c, d in T.DISCIPLINE_CODES.items())}
        WHEN regexp_matches({_NAME}, '^[A-Z0-9]') THEN 'Type_' || regexp_extract({_NAME}, '^[A-Z0-9]{{1,2}}') ELSE 'General' END AS discipline,
        CASE WHEN starts_with({_NAME}, 'E') AND NOT starts_with({_NAME}, 'ES') AND NOT starts_with({_NAME}, 'EX') AND regexp_matches({_NAME}, 'PANEL|SCHEDULE') THEN 'PANEL_SCHEDULE'
             WHEN (starts_with({_NAME}, 'LV') OR starts_with({_NAME}, 'LD')) AND regexp_matches({_NAME}, '{T.ALARM_WORDS}') THEN 'LOW_VOLTAGE' END AS subtype,
        coalesce(nullif(regexp_replace(regexp_replace(lower(trim({_STEM})), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), ''), 'drawing') AS drawing_slug,
        CASE WHEN regexp_matches(source_file, '(?i)rev(?:ision)?[\\s._-]*[A-Za-z0-9]') THEN 'v' || lower(regexp_extract(regexp_extract(source_file, '[^/]*$'), '(?i)rev(?:ision)?[\\s._-]*([A-Za-z0-9]+)', 1)) ELSE 'v1' END AS version
    FROM drawing_metadata"""


def row_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document ids of schedule rows from their parts, blanks dropped."""
    return table(spark, sf_dir, "schedule_row").select("row_id", T.document_id(F.col("job_number"), F.col("sheet_number"), F.lit("schedule-row"), F.col("panel_name"), T.padded_circuit(F.col("circuit_number"))).alias("doc_id"))


def _part_sql(c: str) -> str:
    return f"CASE WHEN trim(coalesce({c}, '')) <> '' THEN coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(trim({c}), '[^A-Za-z0-9_=-]', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g'), ''), 'none') END"


_PAD = "CASE WHEN regexp_matches(trim(circuit_number), '^[0-9]+$') THEN printf('%03d', CAST(circuit_number AS BIGINT)) ELSE circuit_number END"
ROW_IDENTIFIERS_SQL = f"SELECT row_id, concat_ws('-', {_part_sql('job_number')}, {_part_sql('sheet_number')}, 'schedule-row', {_part_sql('panel_name')}, {_part_sql(f'({_PAD})')}) AS doc_id FROM schedule_row"


def circuit_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd circuits of a panel with the even one that follows. Circuits are first made distinct, so the windows see
    each circuit of a panel once however many rows or versions it has."""
    rows = table(spark, sf_dir, "schedule_row").where("panel_name IS NOT NULL").select("project_id", "sheet_number", "panel_name", T.first_integer(F.col("circuit_number")).alias("circuit")).where("circuit IS NOT NULL").distinct()
    w = Window.partitionBy("project_id", "sheet_number", "panel_name").orderBy("circuit")
    x = rows.withColumn("right_circuit", F.lead("circuit").over(w))
    return x.where("circuit % 2 = 1").withColumn("right_circuit", F.when(F.col("right_circuit") == F.col("circuit") + 1, F.col("right_circuit")))


CIRCUIT_PAIRS_SQL = """
    SELECT project_id, sheet_number, panel_name, circuit, CASE WHEN nxt = circuit + 1 THEN nxt END AS right_circuit FROM (SELECT *, lead(circuit) OVER (PARTITION BY project_id, sheet_number, panel_name ORDER BY circuit) AS nxt
    FROM (SELECT DISTINCT project_id, sheet_number, panel_name, TRY_CAST(nullif(regexp_extract(circuit_number, '-?[0-9]+'), '') AS BIGINT) AS circuit FROM schedule_row WHERE panel_name IS NOT NULL) WHERE circuit IS NOT NULL) WHERE circuit % 2 = 1"""


def room_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First room of each sheet and name, without bogus ones, with tags."""
    # Fixed value: names that aren't rooms.
    bogus = r"(?i)^\s*ps[\s_-]*\d+\s*$|\barea\s+not\s+in\s+scope\b|^\s*ada\s*$"
    rooms = table(spark, sf_dir, "a_rooms_template").where(~F.coalesce(F.col("room_name"), F.lit("")).rlike(bogus) & ~F.coalesce(F.col("room_id"), F.lit("")).rlike(bogus))
    name = F.regexp_replace(F.regexp_replace(F.upper(F.trim(F.coalesce("room_name", F.lit("")))), "[^A-Z0-9]+", "_"), "^_|_$", "")
    some = lambda told, **parts: F.when(told, F.struct(*[c.alias(k) for k, c in parts.items()]))
    ceiling = T.blank_to_null(F.col("envelope.ceiling_type"))
    template = F.struct(T.blank_to_null(F.col("metrics.dimensions")).alias("dimensions"), some(F.size("doors") > 0, count=F.size("doors")).alias("doors"), some(ceiling.isNotNull(), ceiling=ceiling).alias("finishes"), "template_status")
    rooms = rooms.select("*", F.inline(F.array(F.struct(F.parse_json(F.to_json(template)).alias("_template")))))
    tags = template_tags(F.col("_template"))
    x = rooms.select("project_id", "sheet_number", name.alias("room_slug"), F.struct("room_key", "room_id", F.array_join(tags, ",").alias("tags")).alias("r"))
    return x.groupBy("project_id", "sheet_number", "room_slug").agg(F.min("r").alias("r"), F.count("*").alias("n_same")).select("project_id", "sheet_number", "room_slug", "r.room_key", "r.room_id", "r.tags", "n_same")


_BOGUS = "(?i)^\\s*ps[\\s_-]*[0-9]+\\s*$|\\barea\\s+not\\s+in\\s+scope\\b|^\\s*ada\\s*$"
ROOM_RECORDS_SQL = f"""
    SELECT project_id, sheet_number, room_slug, room_key, room_id, tags, n_same FROM (SELECT *, count(*) OVER w AS n_same, row_number() OVER (PARTITION BY project_id, sheet_number, room_slug ORDER BY room_key) AS n FROM (
        SELECT project_id, sheet_number, room_key, room_id, regexp_replace(regexp_replace(upper(trim(coalesce(room_name, ''))), '[^A-Z0-9]+', '_', 'g'), '^_|_$', '', 'g') AS room_slug,
               concat_ws(',', CASE WHEN trim(metrics.dimensions) <> '' THEN 'dimensions' END, CASE WHEN len(doors) > 0 THEN 'doors' END, CASE WHEN trim(envelope.ceiling_type) <> '' THEN 'finishes' END, CASE WHEN template_status = 'signed_off' THEN 'signed_off' END) AS tags
        FROM a_rooms_template WHERE NOT regexp_matches(coalesce(room_name, ''), '{_BOGUS}') AND NOT regexp_matches(coalesce(room_id, ''), '{_BOGUS}')) WINDOW w AS (PARTITION BY project_id, sheet_number, room_slug)) WHERE n = 1"""


def ocr_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each extraction would be read by OCR: few characters a page, else few in all."""
    n, pages = F.length(F.trim(F.coalesce("raw_text", F.lit("")))), F.greatest(F.coalesce(F.col("metadata.page_count"), F.lit(1)), F.lit(1))
    reason = F.when(n / pages < 1500, "char_density_low").when(n < 2000, "low_total_chars").otherwise("sufficient_text")
    return table(spark, sf_dir, "extraction_result").select("extraction_id", n.alias("n_chars"), pages.alias("n_pages"), reason.alias("reason"), (reason != "sufficient_text").alias("performed"))


OCR_DECISIONS_SQL = """
    SELECT *, reason <> 'sufficient_text' AS performed FROM (SELECT extraction_id, CAST(n AS INT) AS n_chars, CAST(pages AS INT) AS n_pages, CASE WHEN n / pages < 1500 THEN 'char_density_low' WHEN n < 2000 THEN 'low_total_chars' ELSE 'sufficient_text' END AS reason
    FROM (SELECT extraction_id, length(trim(coalesce(raw_text, ''))) AS n, greatest(coalesce(metadata.page_count, 1), 1) AS pages FROM extraction_result))"""


# Forms of a rating and of a load, and words of a summary line.
AMPS, LOAD = r"(?i)\d+\s*A\b", r"(?i)\d+(?:\.\d+)?\s*(?:VA|KVA|KW)\b"
SUMMARY = "total|connected|demand factor|%"


def panel_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel blocks of each text: its header opens a block (gaps and islands); kinds of its lines are counted."""
    line = F.col("line")
    x = _panel_blocks(spark, sf_dir).where("block_no > 0")
    low, amps, load = F.lower(line), line.rlike(AMPS), line.rlike(LOAD)
    said = low.rlike(SUMMARY)
    kind = F.when(said & (amps | load), "summary").when(~said & amps & (load | (F.length(F.trim(line)) >= 12)), "circuit").otherwise("other")
    return x.withColumn("kind", kind).groupBy("doc_id", "block_no").agg(F.max("header").alias("panel_id"), F.count_if(F.col("kind") == "circuit").alias("n_circuit"), F.count_if(F.col("kind") == "summary").alias("n_summary"), F.count("*").alias("n_lines"))


PANEL_LINES_SQL = f"""
    WITH l AS (SELECT doc_id, generate_subscripts(s, 1) AS line_no, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE regexp_matches(text, '(?im)^\\s*panel'))),
    h AS (SELECT *, upper(nullif(regexp_extract(trim(line), '(?i)^panel\\s*:?\\s*([A-Z0-9\\-.]+)', 1), '')) AS header FROM l),
    b AS (SELECT *, CAST(sum(CASE WHEN header IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS BIGINT) AS block_no, regexp_matches(line, '{AMPS}') AS a, regexp_matches(line, '{LOAD}') AS d, regexp_matches(lower(line), '{SUMMARY}') AS s FROM h)
    SELECT doc_id, block_no, max(header) AS panel_id, count(*) FILTER (NOT s AND a AND (d OR length(trim(line)) >= 12)) AS n_circuit, count(*) FILTER (s AND (a OR d)) AS n_summary, count(*) AS n_lines FROM b WHERE block_no > 0 GROUP BY doc_id, block_no"""


def parse_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How responses parse: as they are, only after repair, or not at all. (The SQL knows no repair, so there is none.)"""
    text = T.unfenced(F.col("raw_ai_response_str"))
    status = F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "empty").when(F.try_parse_json(text).isNotNull(), "parsed").when(T.safe_json(F.col("raw_ai_response_str")).isNotNull(), "repaired").otherwise("failed")
    return table(spark, sf_dir, "processing_state").groupBy("ingest_source", status.alias("parse_status")).agg(F.count("*").alias("n_states"))


# Words of a title block with the weight of each.
TITLE_WORDS = {
    "PROJECT": 0.25, "SHEET": 0.15, "DRAWING": 0.10, "DATE": 0.10, "DRAWN": 0.10, "CHECKED": 0.10, "APPROVED": 0.10, "SCALE": 0.10, "TITLE": 0.15, "JOB": 0.10, "NO": 0.05, "NUMBER": 0.05,
    "REVISION": 0.10, "REV": 0.05, "CLIENT": 0.10, "ARCHITECT": 0.10, "ENGINEER": 0.10, "CONTRACTOR": 0.10,
}
# Fixed value: forms of sheet numbers in title blocks.
SHEET_CODE = r"[A-Z]{1,3}[-.]?\d{1,3}(?:\.\d{1,3})?[A-Z]?|SHEET\s*:?\s*[A-Z0-9]|DWG\.?\s*NO\.?\s*:?\s*[A-Z0-9]"


def titleblocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much each title-block text looks like one, and the project name, revision and sheet number it tells."""
    t = F.col("titleblock_text")
    upper, n = F.upper(t), F.length(t)
    score = sum((F.when(upper.contains(w), v).otherwise(0.0) for w, v in TITLE_WORDS.items()), F.lit(0.0))
    # What a text's length adds.
    score += F.when(n.between(200, 500), 0.25).when(n.between(501, 1000), 0.20).when(n.between(1001, 2000), 0.15).when(n > 2000, 0.05).otherwise(0.0) + F.when(upper.rlike(SHEET_CODE), 0.15).otherwise(0.0)
    text = lambda p: F.nullif(F.trim(F.regexp_extract(t, p, 1)), F.lit(""))
    x = table(spark, sf_dir, "extraction_result").where("trim(titleblock_text) <> ''")
    return x.select("extraction_id", F.round(F.least(score, F.lit(1.0)), 4).alias("score"), text(r"(?im)PROJECT(?:[ \t]+NAME|[ \t]+TITLE)?[ \t]*[:\-][ \t]*([^\n]+)$").alias("project_name"), text(r"(?i)\bRev(?:ision)?\.?[ \t]*[:\-]?[ \t]*([A-Za-z0-9]+)\b").alias("revision"), text(r"(?im)\bSHEET NUMBER[ \t]*:?[ \t]*([A-Z]{1,3}\d{1,3}(?:\.\d{1,3})?)[ \t]*$").alias("sheet_number"))


_TITLE_SCORE = " + ".join(f"CASE WHEN contains(u, '{w}') THEN {v} ELSE 0 END" for w, v in TITLE_WORDS.items())
TITLEBLOCKS_SQL = f"""
    SELECT extraction_id, round(least(CAST({_TITLE_SCORE} + CASE WHEN n BETWEEN 200 AND 500 THEN 0.25 WHEN n BETWEEN 501 AND 1000 THEN 0.20 WHEN n BETWEEN 1001 AND 2000 THEN 0.15 WHEN n > 2000 THEN 0.05 ELSE 0 END + CASE WHEN regexp_matches(u, '{SHEET_CODE}') THEN 0.15 ELSE 0 END AS DOUBLE), 1.0), 4) AS score,
           nullif(trim(regexp_extract(t, '(?im)PROJECT(?:[ \\t]+NAME|[ \\t]+TITLE)?[ \\t]*[:\\-][ \\t]*([^\\n]+)$', 1)), '') AS project_name, nullif(trim(regexp_extract(t, '(?i)\\bRev(?:ision)?\\.?[ \\t]*[:\\-]?[ \\t]*([A-Za-z0-9]+)\\b', 1)), '') AS revision,
           nullif(trim(regexp_extract(t, '(?im)\\bSHEET NUMBER[ \\t]*:?[ \\t]*([A-Z]{{1,3}}[0-9]{{1,3}}(?:\\.[0-9]{{1,3}})?)[ \\t]*$', 1)), '') AS sheet_number
    FROM (SELECT extraction_id, titleblock_text AS t, upper(titleblock_text) AS u, length(titleblock_text) AS n FROM extraction_result WHERE trim(titleblock_text) <> '')"""


def _panel_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text rlike '(?im)^\\\\s*panel'")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    header = F.upper(F.nullif(F.regexp_extract(F.trim("line"), r"(?i)^panel\s*:?\s*([A-Z0-9\-.]+)", 1), F.lit("")))
    w = Window.partitionBy("doc_id").orderBy("line_no")
    x = lines.withColumn("header", header)
    return x.withColumns({"block_no": F.sum(F.when(F.col("header").isNotNull(), 1).otherwise(0)).over(w), "panel_id": F.last("header", ignorenulls=True).over(w)})


def panel_circuits_per_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a panel's lines hold one or two circuits: the commonest number of ratings in its first ten circuit lines,
    ties to the one seen first."""
    line = F.col("line")
    circuit = ~F.lower(line).rlike(SUMMARY) & line.rlike(AMPS) & (line.rlike(LOAD) | (F.length(F.trim(line)) >= 12))
    x = _panel_blocks(spark, sf_dir).where("block_no > 0").where(circuit)
    w = Window.partitionBy("doc_id", "block_no").orderBy("line_no")
    x = x.withColumns({"place": F.row_number().over(w), "n_amps": F.regexp_count("line", F.lit(AMPS))}).where("place <= 10")
    counts = x.groupBy("doc_id", "block_no", "panel_id", "n_amps").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    best = counts.groupBy("doc_id", "block_no", "panel_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "first", "n_amps")).alias("m"))
    return best.select("doc_id", "block_no", "panel_id", F.when(F.col("m.n_amps") >= 2, 2).otherwise(1).alias("per_line"))


_BLOCKS_SQL = "SELECT *, CAST(sum(CASE WHEN header IS NOT NULL THEN 1 ELSE 0 END) OVER w AS BIGINT) AS block_no, last_value(header IGNORE NULLS) OVER w AS panel_id FROM (SELECT doc_id, line_no, line, upper(nullif(regexp_extract(trim(line), '(?i)^panel\\s*:?\\s*([A-Z0-9\\-.]+)', 1), '')) AS header FROM (SELECT doc_id, generate_subscripts(s, 1) AS line_no, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE regexp_matches(text, '(?im)^\\s*panel')))) WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)"
PANEL_CIRCUITS_SQL = f"""
    WITH c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, block_no ORDER BY line_no) AS place, len(regexp_extract_all(line, '{AMPS}')) AS n_amps FROM ({_BLOCKS_SQL}) WHERE block_no > 0 AND NOT regexp_matches(lower(line), '{SUMMARY}') AND regexp_matches(line, '{AMPS}') AND (regexp_matches(line, '{LOAD}') OR length(trim(line)) >= 12)),
    m AS (SELECT *, row_number() OVER (PARTITION BY doc_id, block_no ORDER BY n DESC, first) AS r FROM (SELECT doc_id, block_no, panel_id, n_amps, count(*) AS n, min(place) AS first FROM c WHERE place <= 10 GROUP BY ALL))
    SELECT doc_id, block_no, panel_id, CASE WHEN n_amps >= 2 THEN 2 ELSE 1 END AS per_line FROM m WHERE r = 1"""


def panel_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a marker line before each panel and after its end."""
    x = _panel_blocks(spark, sf_dir).where("doc_id IS NOT NULL")
    w = Window.partitionBy("doc_id").orderBy("line_no")
    ended = F.lag("panel_id").over(w)
    last = F.lead("line_no").over(w).isNull()
    before = F.when(F.col("header").isNotNull(), F.concat(F.coalesce(F.concat(F.lit("=== END PANEL SCHEDULE: "), ended, F.lit(" ===\n")), F.lit("")), F.lit("=== PANEL SCHEDULE: "), F.col("header"), F.lit(" ===\n"))).otherwise("")
    after = F.when(last & F.col("panel_id").isNotNull(), F.concat(F.lit("\n=== END PANEL SCHEDULE: "), F.col("panel_id"), F.lit(" ==="))).otherwise("")
    x = x.select("doc_id", F.struct("line_no", F.concat(before, "line", after).alias("t")).alias("l")).groupBy("doc_id").agg(F.array_sort(F.collect_list("l")).alias("ls"))
    return x.select("doc_id", F.array_join(F.transform("ls", lambda v: v["t"]), "\n").alias("text"))


PANEL_MARKERS_SQL = f"""
    SELECT doc_id, string_agg(CASE WHEN header IS NOT NULL THEN coalesce('=== END PANEL SCHEDULE: ' || ended || ' ===' || chr(10), '') || '=== PANEL SCHEDULE: ' || header || ' ===' || chr(10) ELSE '' END || line
        || CASE WHEN nxt IS NULL AND panel_id IS NOT NULL THEN chr(10) || '=== END PANEL SCHEDULE: ' || panel_id || ' ===' ELSE '' END, chr(10) ORDER BY line_no) AS text
    FROM (SELECT *, lag(panel_id) OVER (PARTITION BY doc_id ORDER BY line_no) AS ended, lead(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) AS nxt FROM ({_BLOCKS_SQL})) GROUP BY doc_id"""


def table_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much each extracted table looks like a panel's, best first in each extraction; ties by position."""
    tables = table(spark, sf_dir, "extraction_result").select("extraction_id", F.posexplode(F.try_variant_get(F.try_parse_json("tables_json"), "$", VARIANTS)).alias("table_no", "v"))
    t = F.lower(F.to_json("v"))
    # Words of panel tables with their weights.
    score = F.when(t.rlike("circuit|ckt|breaker|trip"), 5.0).otherwise(0.0) + F.when(t.rlike("load|va|amps"), 3.0).otherwise(0.0) + F.when(t.contains("panel"), 2.0).otherwise(0.0)
    w = Window.partitionBy("extraction_id").orderBy(F.col("score").desc(), "table_no")
    return tables.select("extraction_id", "table_no", score.alias("score")).withColumn("place", F.row_number().over(w))


TABLE_SCORES_SQL = """
    SELECT extraction_id, CAST(table_no AS INT) AS table_no, score, CAST(row_number() OVER (PARTITION BY extraction_id ORDER BY score DESC, table_no) AS INT) AS place FROM (SELECT extraction_id, table_no, CAST(CASE WHEN regexp_matches(t, 'circuit|ckt|breaker|trip') THEN 5 ELSE 0 END + CASE WHEN regexp_matches(t, 'load|va|amps') THEN 3 ELSE 0 END + CASE WHEN contains(t, 'panel') THEN 2 ELSE 0 END AS DOUBLE) AS score
    FROM (SELECT extraction_id, generate_subscripts(l, 1) - 1 AS table_no, lower(CAST(unnest(l) AS VARCHAR)) AS t FROM (SELECT extraction_id, from_json(tables_json, '["JSON"]') AS l FROM extraction_result WHERE json_valid(tables_json))))"""


# Words that a header row of circuits has of each kind, and what the first ten lines of a panel tell.
HEADER_WORDS = (("ckt", "circuit", "cir."), ("load", "desc", "description", "name"), ("trip", "breaker", "amps", "a"))
PANEL_FACTS = {"rating_amps": r"(?i)rating\s*:\s*(\d+)\s*A", "voltage": r"(?i)volts?\s*:\s*([0-9/\s]+(?:wye|delta)?)", "panel_type": r"(?i)type\s*:\s*([A-Z]+)", "supply_from": r"(?i)supply\s+from\s*:\s*([A-Z0-9\-]+)", "aic_rating": r"(?i)a\.?i\.?c\.?\s*rating\s*:\s*([0-9K]+)"}


def panel_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the head of each panel tells, the row of its column names (from 0) and how many lines come before its first summary line."""
    w = Window.partitionBy("doc_id", "block_no").orderBy("line_no")
    line = F.col("line")
    summary = F.lower(line).rlike(SUMMARY) & (line.rlike(AMPS) | line.rlike(LOAD)) & F.col("header").isNull()
    x = _panel_blocks(spark, sf_dir).where("block_no > 0 AND doc_id IS NOT NULL").withColumn("place", F.row_number().over(w) - 1).withColumn("ended", F.coalesce(F.max(summary).over(w), F.lit(False)))
    named = F.lit(True)
    for words in HEADER_WORDS:
        named &= F.greatest(*[F.lower(line).contains(v) for v in words])
    head = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("place") < 10, F.struct("place", "line")))), lambda v: v["line"]), "\n")
    x = x.groupBy("doc_id", "block_no").agg(F.max("header").alias("panel_id"), head.alias("head"), F.min(F.when(named, F.col("place"))).alias("header_row"), F.count_if(~F.col("ended")).alias("n_kept"))
    return x.select("doc_id", "block_no", "panel_id", "header_row", "n_kept", *[F.nullif(F.trim(F.regexp_extract("head", p, 1)), F.lit("")).alias(k) for k, p in PANEL_FACTS.items()])


PANEL_HEADERS_SQL = f"""
    WITH l AS (SELECT *, row_number() OVER w - 1 AS place, bool_or(regexp_matches(lower(line), '{SUMMARY}') AND (regexp_matches(line, '{AMPS}') OR regexp_matches(line, '{LOAD}')) AND header IS NULL) OVER (w ROWS UNBOUNDED PRECEDING) AS ended FROM ({_BLOCKS_SQL}) WHERE block_no > 0 WINDOW w AS (PARTITION BY doc_id, block_no ORDER BY line_no)),
    h AS (SELECT doc_id, block_no, max(header) AS panel_id, string_agg(line, chr(10) ORDER BY place) FILTER (place < 10) AS head, min(place) FILTER ({' AND '.join('(' + ' OR '.join(f"contains(lower(line), '{v}')" for v in words) + ')' for words in HEADER_WORDS)}) AS header_row, count(*) FILTER (NOT ended) AS n_kept FROM l GROUP BY doc_id, block_no)
    SELECT doc_id, block_no, panel_id, CAST(header_row AS INT) AS header_row, n_kept, {', '.join(f"nullif(trim(regexp_extract(head, '{p}', 1), ' ' || chr(10) || chr(9)), '') AS {k}" for k, p in PANEL_FACTS.items())} FROM h"""

# What the first letter of a specification's name means, and types of files by their ending.
SPECIFICATIONS = {"E": "ELECTRICAL_SPEC", "M": "MECHANICAL_SPEC", "P": "PLUMBING_SPEC", "A": "ARCHITECTURAL_SPEC"}
CONTENT_TYPES = {"pdf": "application/pdf", "json": "application/json", "csv": "text/csv", "txt": "text/plain", "png": "image/png", "jpg": "image/jpeg", "dwg": "application/acad", "dxf": "application/dxf", "rvt": "application/octet-stream"}


def file_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each state's file name and type tell: type to process as, schedule, specification and panel, sheet number, content type, names
    in the archive."""
    path, kind = F.col("pdf_path"), F.lower(F.coalesce("original_drawing_type", F.lit("")))
    name = F.coalesce(T.base_name(path), F.lit(""))
    low = F.lower(name)
    spec = F.lower(path).contains("spec")
    told = F.when(F.coalesce(F.nullif(F.col("original_drawing_type"), F.lit("General")), F.lit("")) == "", T.discipline(path)).otherwise(F.col("original_drawing_type"))
    special = F.coalesce(*[F.when(F.upper(F.left(name, F.lit(1))) == k, v) for k, v in SPECIFICATIONS.items()], F.lit("GENERAL_SPEC"))
    ending = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    content = F.coalesce(*[F.when(ending == k, v) for k, v in CONTENT_TYPES.items()], F.lit("application/octet-stream"))
    place, stem = T.slug(told), T.drawing_slug(name)
    return table(spark, sf_dir, "processing_state").select(
        "state_id", F.when(spec, special).otherwise(told).alias("process_as"), (kind.contains("panel") | kind.contains("schedule") | low.contains("panel") | low.contains("schedule")).alias("is_schedule"), (kind.contains("spec") | low.contains("spec")).alias("is_spec"),
        (low.contains("panel") | F.lower(F.coalesce("subtype", F.lit(""))).contains("panel")).alias("is_panel"), F.nullif(F.regexp_extract(name, r"^([A-Za-z]{1,3}\d{1,3}(?:\.\d{1,2})?)", 1), F.lit("")).alias("sheet_number"), content.alias("content_type"),
        F.array_join(F.filter(F.array(place, stem, name), lambda v: v != ""), "/").alias("archive_name"), F.concat_ws("/", place, stem, F.lit("structured"), F.concat(stem, F.lit("_structured.json"))).alias("structured_name"),
    )


_PDF = "coalesce(regexp_extract(pdf_path, '[^/]*$'), '')"
_PDF_UP = f"upper({_PDF})"
_PDF_STEM = f"regexp_replace(regexp_replace({_PDF}, '\\.[A-Za-z0-9]+$', ''), '(?i)rev(?:ision)?[\\s._-]*([A-Za-z0-9]+)', '', 'g')"
_SLUG = "coalesce(nullif(regexp_replace(regexp_replace(lower(trim({0})), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), ''), '{1}')"
FILE_FACTS_SQL = f"""
    WITH d AS (SELECT *, CASE WHEN {_PDF_UP} = '' THEN 'General' {' '.join(f"WHEN starts_with({_PDF_UP}, '{c}') THEN " + (f"CASE WHEN regexp_matches({_PDF_UP}, '{T.ALARM_WORDS}') THEN 'FireAlarm' ELSE '{v}' END" if v == "LowVoltage" else f"'{v}'") for c, v in T.DISCIPLINE_CODES.items())}
        WHEN regexp_matches({_PDF_UP}, '^[A-Z0-9]') THEN 'Type_' || regexp_extract({_PDF_UP}, '^[A-Z0-9]{{1,2}}') ELSE 'General' END AS found, lower(coalesce(original_drawing_type, '')) AS k, lower({_PDF}) AS low, {_PDF} AS name FROM processing_state),
    t AS (SELECT *, CASE WHEN coalesce(nullif(original_drawing_type, 'General'), '') = '' THEN found ELSE original_drawing_type END AS told, {_SLUG.format(_PDF_STEM, 'drawing')} AS stem FROM d)
    SELECT state_id, CASE WHEN contains(lower(pdf_path), 'spec') THEN CASE upper(name[1]) {' '.join(f"WHEN '{a}' THEN '{v}'" for a, v in SPECIFICATIONS.items())} ELSE 'GENERAL_SPEC' END ELSE told END AS process_as,
        contains(k, 'panel') OR contains(k, 'schedule') OR contains(low, 'panel') OR contains(low, 'schedule') AS is_schedule, contains(k, 'spec') OR contains(low, 'spec') AS is_spec, contains(low, 'panel') OR contains(lower(coalesce(subtype, '')), 'panel') AS is_panel,
        nullif(regexp_extract(name, '^([A-Za-z]{{1,3}}[0-9]{{1,3}}(?:\\.[0-9]{{1,2}})?)', 1), '') AS sheet_number, CASE lower(regexp_extract(name, '\\.([A-Za-z0-9]+)$', 1)) {' '.join(f"WHEN '{a}' THEN '{v}'" for a, v in CONTENT_TYPES.items())} ELSE 'application/octet-stream' END AS content_type,
        {_SLUG.format('told', 'general')} || '/' || stem || CASE WHEN name <> '' THEN '/' || name ELSE '' END AS archive_name, {_SLUG.format('told', 'general')} || '/' || stem || '/structured/' || stem || '_structured.json' AS structured_name FROM t"""

# Forms of sheet numbers, of revisions and of street names.
SHEET_NUMBER, REVISIONS, STREET = r"(?i)^[A-Z]{1,3}\d{1,3}(?:\.\d{1,2})?$", (r"(?i)\bRev(?:ision)?\.?\s*[:\-]?\s*([A-Za-z0-9]+)\b", r"(?i)\b([A-Za-z0-9]+)\s+IFC\b"), r"(?i)\d+\s+([A-Z\s]+?)\s+(?:BLVD|DR|ST|AVE|RD|WAY|LN|CT|PL)"
PROJECT_LINE = r"(?im)PROJECT(?:[ \t]+NAME|[ \t]+TITLE)?[ \t]*[:\-][ \t]*([^\n]*?[^\n:\- \t][^\n]*)$"


def repaired_metadata(df: DataFrame) -> DataFrame:
    """df (path, titleblock, sheet_number, drawing_number, revision, project_name, project_address, job_number, and any further
    columns) with these filled from one another: the sheet number from the file's name, the drawing number from the sheet's, a
    revision that is a sheet number cleared, revision and project name from the title block, the name else from the street or the
    job. project_source tells of the last two. Nulls and blanks are filled alike."""
    get = lambda c: F.nullif(F.col(c), F.lit(""))
    found = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    x = df.withColumn("sheet_number", F.coalesce(get("sheet_number"), found(T.base_name(F.col("path")), r"^([A-Za-z]{1,3}\d{1,3}(?:\.\d{1,2})?)")))
    wrong = F.trim("revision").rlike(SHEET_NUMBER) | (F.col("revision") == F.col("sheet_number"))
    t = F.col("titleblock")
    x = x.withColumns({"drawing_number": F.coalesce(get("drawing_number"), "sheet_number"), "revision": F.coalesce(F.when(~F.coalesce(wrong, F.lit(False)), get("revision")), *[found(t, p) for p in REVISIONS])})
    name = F.coalesce(get("project_name"), F.nullif(F.btrim(found(t, PROJECT_LINE), F.lit(" \t\r:-")), F.lit("")))
    street = F.initcap(F.trim(found(F.col("project_address"), STREET)))
    by_street, by_job = F.trim(F.concat_ws(" ", street, get("job_number"))), F.concat(F.lit("Project "), get("job_number"))
    source = F.when(name.isNotNull(), F.lit(None).cast("string")).when(street.isNotNull(), "derived_from_address").when(get("job_number").isNotNull(), "derived_from_job_no")
    return x.withColumns({"project_source": source, "project_name": F.coalesce(name, F.when(street.isNotNull(), by_street), by_job)})


def extracted_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of each extraction as its file's name and title block tell them; the project's number serves as job."""
    none = F.lit(None).cast("string")
    x = table(spark, sf_dir, "extraction_result").select("extraction_id", F.col("pdf_path").alias("path"), F.col("titleblock_text").alias("titleblock"), *[none.alias(c) for c in ("sheet_number", "drawing_number", "revision", "project_name", "project_address")], F.col("project_id").alias("job_number"))
    return repaired_metadata(x).drop("path", "titleblock", "project_address")


EXTRACTED_METADATA_SQL = f"""
    WITH x AS (SELECT extraction_id, project_id AS job_number, nullif(regexp_extract(regexp_extract(pdf_path, '[^/]*$'), '^([A-Za-z]{{1,3}}[0-9]{{1,3}}(?:\\.[0-9]{{1,2}})?)', 1), '') AS n, titleblock_text AS t FROM extraction_result),
    y AS (SELECT *, nullif(trim(regexp_extract(t, '{PROJECT_LINE}', 1), ' :-' || chr(9) || chr(13)), '') AS p FROM x)
    SELECT extraction_id, job_number, n AS sheet_number, n AS drawing_number, coalesce({', '.join(f"nullif(regexp_extract(t, '{p}', 1), '')" for p in REVISIONS)}) AS revision, coalesce(p, 'Project ' || nullif(job_number, '')) AS project_name, CASE WHEN p IS NULL AND nullif(job_number, '') IS NOT NULL THEN 'derived_from_job_no' END AS project_source FROM y"""

# Marker lines that go before a text with any of these words, the last one first in the text; and the words by which the
# tables of a discipline are ordered.
MARKERS = {
    "architectural": [("ROOM INFORMATION DETECTED:", ("room", "space"))], "mechanical": [("EQUIPMENT INFORMATION DETECTED:", ("equipment", "hvac", "cfm"))],
    "plumbing": [("PLUMBING CONTENT:", ("",)), ("FIXTURE INFORMATION DETECTED:", ("fixture", "water closet", "lavatory", "sink")), ("WATER HEATER INFORMATION DETECTED:", ("water heater", "hot water", "domestic water")), ("PIPING INFORMATION DETECTED:", ("pipe", "piping", "valve"))],
}
TABLE_ORDER = {"architectural": [("room", "space", "finish")], "mechanical": [("equipment", "hvac", "cfm", "tonnage")], "plumbing": [("fixture", "wc", "lav", "sink", "urinal"), ("water heater", "pump", "water temperature"), ("pipe", "valve", "fitting")]}


def _any_of(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out |= text.contains(w)
    return out


def marked_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted texts with the marker lines of each discipline, and whether they tell of no panels."""
    t = F.col("raw_text")
    low = F.lower(t)
    marked = {}
    for discipline, rules in MARKERS.items():
        text = t
        for line, words in rules:
            text = F.when(_any_of(low, words), F.concat(F.lit(line + "\n"), text)).otherwise(text)
        marked[discipline] = text
    no_panels = ~(low.contains("panel") & (low.contains("schedule") | low.contains(":")) & _any_of(low, ("circuit", "ckt", "breaker", "trip")))
    return table(spark, sf_dir, "extraction_result").where("raw_text IS NOT NULL").select("extraction_id", *[c.alias(f"{d}_text") for d, c in marked.items()], no_panels.alias("spec_only"))


def _any_sql(text: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _marked_sql(rules: list) -> str:
    text = "raw_text"
    for line, words in rules:
        text = f"CASE WHEN {_any_sql('low', words)} THEN '{line}' || chr(10) ELSE '' END || {text}"
    return text


MARKED_TEXTS_SQL = f"""
    SELECT extraction_id, {', '.join(f'{_marked_sql(rules)} AS {d}_text' for d, rules in MARKERS.items())}, NOT (contains(low, 'panel') AND (contains(low, 'schedule') OR contains(low, ':')) AND {_any_sql('low', ('circuit', 'ckt', 'breaker', 'trip'))}) AS spec_only
    FROM (SELECT *, lower(raw_text) AS low FROM extraction_result WHERE raw_text IS NOT NULL)"""


def table_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each extracted table in the order of each discipline: by words of its cells, then as extracted."""
    tables = table(spark, sf_dir, "extraction_result").select("extraction_id", F.posexplode(F.try_variant_get(F.try_parse_json("tables_json"), "$", VARIANTS)).alias("table_no", "v"))
    t = F.lower(F.to_json("v"))
    rank = {}
    for discipline, groups in TABLE_ORDER.items():
        out = F.lit(len(groups))
        for i, words in reversed([*enumerate(groups)]):
            out = F.when(_any_of(t, words), i).otherwise(out)
        rank[discipline] = out
    x = tables.select("extraction_id", "table_no", F.explode(F.array(*[F.struct(F.lit(d).alias("discipline"), r.alias("rank")) for d, r in rank.items()])).alias("r")).select("extraction_id", "table_no", "r.*")
    return x.withColumn("place", F.row_number().over(Window.partitionBy("extraction_id", "discipline").orderBy("rank", "table_no")))


_TABLES_SQL = "(SELECT extraction_id, CAST(table_no AS INT) AS table_no, lower(CAST(v AS VARCHAR)) AS t FROM (SELECT extraction_id, generate_subscripts(l, 1) - 1 AS table_no, unnest(l) AS v FROM (SELECT extraction_id, from_json(tables_json, '[\"JSON\"]') AS l FROM extraction_result WHERE json_valid(tables_json))))"
TABLE_ORDER_SQL = "SELECT *, CAST(row_number() OVER (PARTITION BY extraction_id, discipline ORDER BY rank, table_no) AS INT) AS place FROM (" + " UNION ALL ".join(
    f"SELECT extraction_id, table_no, '{d}' AS discipline, CAST(CASE {' '.join(f'WHEN {_any_sql(chr(116), words)} THEN {i}' for i, words in enumerate(groups))} ELSE {len(groups)} END AS INT) AS rank FROM {_TABLES_SQL}" for d, groups in TABLE_ORDER.items()
) + ")"


QUERIES = {f.__name__: f for f in (coverage, latest_rows, drawing_types, row_identifiers, circuit_pairs, room_records, ocr_decisions, panel_lines, parse_status, panel_headers, file_facts, extracted_metadata, marked_texts, table_order, titleblocks, panel_circuits_per_line, panel_markers, table_scores)}
SQL = {
    "coverage": COVERAGE_SQL, "latest_rows": LATEST_ROWS_SQL,
    "drawing_types": DRAWING_TYPES_SQL, "row_identifiers": ROW_IDENTIFIERS_SQL, "circuit_pairs": CIRCUIT_PAIRS_SQL, "room_records": ROOM_RECORDS_SQL, "ocr_decisions": OCR_DECISIONS_SQL, "panel_lines": PANEL_LINES_SQL,
    "titleblocks": TITLEBLOCKS_SQL,
    "panel_circuits_per_line": PANEL_CIRCUITS_SQL, "panel_headers": PANEL_HEADERS_SQL, "file_facts": FILE_FACTS_SQL, "extracted_metadata": EXTRACTED_METADATA_SQL, "marked_texts": MARKED_TEXTS_SQL, "table_order": TABLE_ORDER_SQL, "panel_markers": PANEL_MARKERS_SQL, "table_scores": TABLE_SCORES_SQL,
}
