"""Page layout, circuit records, and the file and stream connectors, as queries over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.functions import aliases
from sheetloom.operators import geometry
from sheetloom.plans.documents import _panel_blocks
from sheetloom.sources import files
from sheetloom.streaming import upsert
from sheetloom.tables import new_path, table

#: Width of a letter and height of a line on the pages that texts are laid out on.
LETTER, LINE = 6.0, 12.0


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word boxes of the pages of ocr_run_result: each line of text at its height, each word where its letters stand."""
    lines = table(spark, sf_dir, "ocr_run_result").select(F.col("ocr_id").alias("page_id"), F.posexplode(F.split(F.regexp_replace("text", "[\\t\\r\\f]", " "), "\n")).alias("line", "s"))
    words = lines.select("page_id", "line", F.posexplode(F.split("s", " ")).alias("seq", "text"), "s")
    before = F.length(F.array_join(F.slice(F.split("s", " "), 1, F.col("seq")), " ")) + F.when(F.col("seq") > 0, 1).otherwise(0)
    x0, y0 = before * LETTER, F.col("line") * LINE
    return words.where("text <> ''").select("page_id", "seq", F.lit(0).alias("block"), "line", x0.alias("x0"), y0.alias("y0"), (x0 + F.length("text") * LETTER).alias("x1"), (y0 + LINE - 2).alias("y1"), "text")


def layout_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each scanned page put together from its word boxes."""
    return geometry.words_to_lines(_words(spark, sf_dir)).select("page_id", "line", "text", "x0", "y0", "x1", "y1", "cx", "cy")


LAYOUT_LINES_SQL = """
    WITH l AS (SELECT ocr_id AS page_id, generate_subscripts(a, 1) - 1 AS line, unnest(a) AS s FROM (SELECT ocr_id, string_split(regexp_replace(text, '[\t\r\f]', ' ', 'g'), chr(10)) AS a FROM ocr_run_result)),
    t AS (SELECT page_id, line, trim(regexp_replace(s, ' +', ' ', 'g')) AS text, length(s) - length(ltrim(s, ' ')) AS a, length(rtrim(s, ' ')) AS b FROM l)
    SELECT page_id, CAST(line AS INT) AS line, text, a * 6.0::DOUBLE AS x0, line * 12.0::DOUBLE AS y0, b * 6.0::DOUBLE AS x1, line * 12.0::DOUBLE + 10 AS y1, (a + b) * 3.0::DOUBLE AS cx, line * 12.0::DOUBLE + 5 AS cy FROM t WHERE text <> ''"""


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel_blocks(spark, sf_dir).where("doc_id IS NOT NULL").select(F.col("doc_id").alias("page_id"), F.col("line_no").alias("ordinal"), F.col("line").alias("text"), "header", (F.length("line") * LETTER / 2).alias("cx"), (F.col("line_no") * LINE).alias("cy"))


def layout_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circuit lines of laid out panel texts with the nearest panel header above them and their circuit's number."""
    x = _placed(spark, sf_dir)
    headers = x.where("header IS NOT NULL").select("page_id", "ordinal", F.col("header").alias("panel_id"), "cx", "cy")
    found = geometry.assign_panels(x.select("page_id", "ordinal", "text", "cx", "cy"), headers)
    return found.select("page_id", F.col("ordinal").alias("line_no"), "panel_id", geometry.circuit_number(F.col("text")).alias("circuit"))


_PLACED_SQL = """
    l AS (SELECT doc_id, generate_subscripts(s, 1) - 1 AS line_no, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE regexp_matches(text, '(?im)^\\s*panel'))),
    p AS (SELECT doc_id AS page_id, line_no, line, upper(nullif(regexp_extract(trim(line), '(?i)^panel\\s*:?\\s*([A-Z0-9\\-.]+)', 1), '')) AS header, length(line) * 3.0 AS cx, line_no * 12.0 AS cy FROM l)"""
LAYOUT_PANELS_SQL = f"""
    WITH {_PLACED_SQL},
    c AS (SELECT * FROM p WHERE regexp_matches(line, '(?i)\\d+\\s*A(?:MPS?)?\\b') AND regexp_matches(line, '(?i)\\d\\s*K?VA\\b|\\bSPARE\\b')),
    d AS (SELECT c.page_id, c.line_no, c.line, h.header AS panel_id, row_number() OVER (PARTITION BY c.page_id, c.line_no ORDER BY pow(greatest(0, c.cy - h.cy), 2) + pow((c.cx - h.cx) / 2, 2), h.line_no) AS n FROM c JOIN p h ON h.page_id = c.page_id AND h.header IS NOT NULL AND c.cy >= h.cy - 5),
    k AS (SELECT page_id, line_no, panel_id, regexp_replace(line, '(?i)[0-9.]+[ \t]*(?:AMPS?|A|VA|KVA|KW)\\b', ' ', 'g') AS rest FROM d WHERE n = 1)
    SELECT page_id, CAST(line_no AS INT) AS line_no, panel_id, CAST(list_min(list_transform(list_filter(regexp_extract_all(rest, '[0-9.]+'), lambda x: regexp_matches(x, '^[0-9]{{1,3}}$')), lambda x: CAST(x AS INT))) AS INT) AS circuit FROM k"""


def layout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel headers of laid out texts in rows (each measured from its first header) with the bounds of their columns."""
    x = _placed(spark, sf_dir).where("header IS NOT NULL")
    rows = geometry.column_bounds(geometry.group_rows(x.select("page_id", F.concat_ws("@", "header", "ordinal").alias("name"), (F.col("ordinal") % 5 * 100.0).alias("x0"), F.col("cy").alias("y0"))), 612.0)
    return rows.select("page_id", "row_no", "name", "x0", "y0", "left", "right")


LAYOUT_ROWS_SQL = f"""
    WITH RECURSIVE {_PLACED_SQL},
    a AS (SELECT page_id, header || '@' || line_no AS name, line_no % 5 * 100.0::DOUBLE AS x0, line_no * 12.0::DOUBLE AS y0, row_number() OVER (PARTITION BY page_id ORDER BY line_no) AS i FROM p WHERE header IS NOT NULL),
    f AS (SELECT a.*, 0 AS row_no, y0 AS top FROM a WHERE i = 1 UNION ALL SELECT a.*, CASE WHEN abs(a.y0 - f.top) > 300 THEN f.row_no + 1 ELSE f.row_no END, CASE WHEN abs(a.y0 - f.top) > 300 THEN a.y0 ELSE f.top END FROM f JOIN a ON a.page_id = f.page_id AND a.i = f.i + 1)
    SELECT page_id, CAST(row_no AS INT) AS row_no, name, x0, y0, coalesce((lag(x0) OVER w + x0) / 2, 0.0) AS left, coalesce((lead(x0) OVER w + x0) / 2, 612.0::DOUBLE) AS right FROM f WINDOW w AS (PARTITION BY page_id, row_no ORDER BY x0, name)"""


def circuit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circuits of panel lists with each field under one name, from the alias table."""
    docs = table(spark, sf_dir, "processing_state").select("state_id", F.try_parse_json("parsed_json_data").alias("doc"))
    panels = docs.select("state_id", F.posexplode(F.try_variant_get("doc", "$.ELECTRICAL.panels", "array<variant>")).alias("panel_no", "p"))
    circuits = panels.select("state_id", "panel_no", F.posexplode(F.try_variant_get("p", "$.circuits", "array<variant>")).alias("row_no", "c"))
    x = circuits.select("state_id", "panel_no", "row_no", F.inline(F.array(F.struct(F.try_variant_get("c", "$", "map<string,string>").alias("m"))))).where("m IS NOT NULL")
    return x.select("state_id", "panel_no", "row_no", F.inline(F.array(aliases.circuit_record(F.col("m")))))


def _first_sql(target: str) -> str:
    names = (aliases.CIRCUIT_ALIASES | aliases.LOAD_ALIASES)[target]
    return "coalesce(" + ", ".join(f"nullif(trim(m['{n}']->>'$'), '')" for n in names) + ")"


CIRCUIT_RECORDS_SQL = f"""
    WITH p AS (SELECT state_id, generate_subscripts(l, 1) - 1 AS panel_no, unnest(l) AS p FROM (SELECT state_id, from_json(json_extract(parsed_json_data, '$.ELECTRICAL.panels'), '["JSON"]') AS l FROM processing_state WHERE json_valid(parsed_json_data))),
    c AS (SELECT state_id, panel_no, generate_subscripts(l, 1) - 1 AS row_no, unnest(l) AS c FROM (SELECT state_id, panel_no, from_json(json_extract(p, '$.circuits'), '["JSON"]') AS l FROM p)),
    m AS (SELECT state_id, panel_no, row_no, map_from_entries(list_transform(json_keys(c), lambda k: {{'k': lower(k), 'v': json_extract(c, '$."' || k || '"')}})) AS m FROM c WHERE json_type(c) = 'OBJECT')
    SELECT state_id, CAST(panel_no AS INT) AS panel_no, CAST(row_no AS INT) AS row_no, {_first_sql('circuit')} AS circuit, {_first_sql('load_name')} AS load_name, {_first_sql('trip')} AS trip, TRY_CAST(regexp_extract({_first_sql('poles')}, '^ *([+-]?[0-9]+)(?: |$)', 1) AS INT) AS poles,
           {', '.join(f"TRY_CAST(regexp_replace({_first_sql(k)}, '[^0-9.]', '', 'g') AS DOUBLE) AS {k}" for k in aliases.LOAD_ALIASES)} FROM m"""


def json_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawing data written as JSON lines and read again."""
    drawings = table(spark, sf_dir, "drawing_metadata").select("meta_id", "drawing_number", "title", "revision", "drawing_date", "project_id", "source_file")
    path = new_path(spark)
    files.write_json_lines(drawings, path)
    return spark.read.schema(drawings.schema).json(path)


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk limits written as JSON documents, found by a recursive scan and parsed."""
    path = new_path(spark)
    table(spark, sf_dir, "chunk_limit").select(F.to_json(F.struct("chunk_type", "max_chars", "overlap_chars")).alias("value")).repartition("value").write.option("maxRecordsPerFile", 1).text(f"{path}/deep/limits")
    docs = files.read_json_documents(spark, path, "part-*.txt")
    return docs.select(F.try_variant_get("doc", "$.chunk_type", "string").alias("chunk_type"), F.try_variant_get("doc", "$.max_chars", "int").alias("max_chars"), F.try_variant_get("doc", "$.overlap_chars", "int").alias("overlap_chars"))


def merged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule rows as a stream of files, merged by id in micro-batches: the row of each id that was taken in last."""
    rows, path = table(spark, sf_dir, "schedule_row").select("id", "ingested_at", "row_id", "revision", "amps", "kva"), new_path(spark)
    rows.repartition(4).write.parquet(f"{path}/in")
    upsert.merge_stream(spark, f"{path}/in", rows.schema, f"{path}/table", f"{path}/progress", order="ingested_at", form="parquet", pattern="part-*", files=2).awaitTermination()
    upsert.compact(spark, f"{path}/table", rows.schema, order="ingested_at")
    return upsert.read_merged(spark, f"{path}/table", rows.schema, order="ingested_at").select("id", "row_id", "revision", "amps", "kva")


QUERIES = {f.__name__: f for f in (layout_lines, layout_panels, layout_rows, circuit_records, json_lines_roundtrip, json_documents, merged_stream)}
SQL = {
    "layout_lines": LAYOUT_LINES_SQL, "layout_panels": LAYOUT_PANELS_SQL, "layout_rows": LAYOUT_ROWS_SQL, "circuit_records": CIRCUIT_RECORDS_SQL,
    "json_lines_roundtrip": "SELECT meta_id, drawing_number, title, revision, drawing_date, project_id, source_file FROM drawing_metadata", "json_documents": "SELECT chunk_type, max_chars, overlap_chars FROM chunk_limit",
    "merged_stream": "SELECT id, row_id, revision, amps, kva FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC, row_id DESC) AS n FROM schedule_row) WHERE n = 1",
}
