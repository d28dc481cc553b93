"""Word boxes of a page to lines, rows, columns and panel ownership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CIRCUIT = r"(?i)\d+\s*A(?:MPS?)?\b"
LOADED = r"(?i)\d\s*K?VA\b|\bSPARE\b"


def words_to_lines(words: DataFrame) -> DataFrame:
    """Lines of each page from words (page_id, seq, block, line, x0, y0, x1, y1, text): text in order of seq, box and
    centre. Blank lines are left out; a page's words are grouped by line only."""
    x = words.groupBy("page_id", "block", "line").agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
        F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda w: w["text"]), " ")).alias("text"),
    )
    return x.where("text <> ''").withColumns({"cx": (F.col("x0") + F.col("x1")) / 2, "cy": (F.col("y0") + F.col("y1")) / 2})


def normalised_box(box: dict[str, Column], width: Column, height: Column) -> Column:
    return F.struct(*[F.round(box[k] / (width if k[0] == "x" else height), 6).alias(k) for k in ("x0", "y0", "x1", "y1")])


def assign_panels(lines: DataFrame, headers: DataFrame, slack: float = 5.0) -> DataFrame:
    """Circuit lines with the panel_id of the nearest header above them (page_id, ordinal, panel_id, cx, cy): least dy² +
    (dx/2)², ties to the first header. A page's few headers travel as one array; no pairs of lines and headers are emitted."""
    h = headers.groupBy("page_id").agg(F.collect_list(F.struct("ordinal", "panel_id", "cx", "cy")).alias("hs"))
    line = lines.where(F.col("text").rlike(CIRCUIT) & F.col("text").rlike(LOADED)).withColumnsRenamed({"cx": "_cx", "cy": "_cy"})

    def rated(x: Column) -> Column:
        dy, dx = F.greatest(F.lit(0.0), F.col("_cy") - x["cy"]), (F.col("_cx") - x["cx"]) / 2
        return F.struct((dy * dy + dx * dx).alias("d"), x["ordinal"].alias("ordinal"), x["panel_id"].alias("panel_id"))

    near = F.array_min(F.transform(F.filter("hs", lambda x: F.col("_cy") >= x["cy"] - slack), rated))
    out = line.join(h, "page_id").withColumn("panel_id", near["panel_id"]).where("panel_id IS NOT NULL")
    return out.drop("hs").withColumnsRenamed({"_cx": "cx", "_cy": "cy"})


def group_rows(anchors: DataFrame, tolerance: float = 300.0) -> DataFrame:
    """Adds row_no: anchors of a page (page_id, x0, y0) fall in the row whose first anchor is within tolerance. Each
    row is measured from its first anchor, so the fold runs over a page's anchors in order; others stay apart."""
    pages = anchors.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("y0", "x0", "name"))).alias("a"))
    start = F.struct(F.lit(-1).alias("row"), F.lit(float("-inf")).alias("y"), F.array().cast("array<struct<row:int,y0:double,x0:double,name:string>>").alias("out"))

    def step(s: Column, a: Column) -> Column:
        new = F.abs(a["y0"] - s["y"]) > tolerance
        row = F.when(new, s["row"] + 1).otherwise(s["row"])
        item = F.struct(row.alias("row"), a["y0"].cast("double").alias("y0"), a["x0"].cast("double").alias("x0"), a["name"].alias("name"))
        return F.struct(row.alias("row"), F.when(new, a["y0"].cast("double")).otherwise(s["y"]).alias("y"), F.concat(s["out"], F.array(item)).alias("out"))

    folded = pages.select("page_id", F.explode(F.aggregate("a", start, step)["out"]).alias("r"))
    return folded.select("page_id", F.col("r.row").alias("row_no"), "r.name", "r.x0", "r.y0")


def column_bounds(rows: DataFrame, page_width: float) -> DataFrame:
    """Adds left and right: half way to the neighbours in the row (page_id, row_no, x0), else the page's edges."""
    w = Window.partitionBy("page_id", "row_no").orderBy("x0", "name")
    before, after = F.lag("x0").over(w), F.lead("x0").over(w)
    return rows.withColumns({"left": F.coalesce((before + F.col("x0")) / 2, F.lit(0.0)), "right": F.coalesce((after + F.col("x0")) / 2, F.lit(page_width))})


def nearest_column(words: DataFrame, columns: dict[str, float], tolerance: float = 30.0) -> DataFrame:
    """Adds column_name: the header nearest to the word's centre, closer than tolerance; the first of equals."""
    centre = (F.col("x0") + F.col("x1")) / 2
    each = [F.when(F.abs(centre - x) < tolerance, F.struct(F.abs(centre - x).alias("d"), F.lit(i).alias("i"), F.lit(n).alias("n"))) for i, (n, x) in enumerate(columns.items())]
    if not each:
        return words.withColumn("column_name", F.lit(None).cast("string"))
    return words.withColumn("column_name", F.array_min(F.array_compact(F.array(*each)))["n"])


def circuit_number(text: Column) -> Column:
    """The least number in a line that no unit of current or load follows."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)(?<![\d.])(\d{1,3})(?![\d.])(?!\s*(?:A|AMP|AMPS|VA|KVA|KW)\b)"), 1)
    return F.array_min(F.transform(found, lambda n: n.cast("int")))
