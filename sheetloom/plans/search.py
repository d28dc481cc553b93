"""Search over flat documents: filters, lexical ranking, facets, tiers, suggestions, freshness and nearest vectors."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetloom.tables import table

# Usual BM25 parameters.
K1, B = 1.2, 0.75
#: Tier names that callers may use, to those in the data.
DOC_TYPES = {"fact": "schedule_row", "template": "room"}
_TERM = re.compile(r"\s*(?:(and|or|not)\b|(\()|(\))|([A-Za-z_][\w/]*)\s+(eq|ne|gt|ge|lt|le)\s+('(?:[^']|'')*'|-?\d+(?:\.\d+)?|null|true|false))", re.I)


def parse_filter(text: str) -> Column:
    """A filter such as "doc_type eq 'fact' and (page gt 2 or key/panel eq 'S2')" as a Column, so that Catalyst can
    push it down. Paths use / for struct members. ValueError for anything else."""
    tokens, at = [], 0
    while at < len(text.rstrip()):
        m = _TERM.match(text, at)
        if not m:
            raise ValueError(f"filter not understood at {at}: {text[at:at + 30]!r}")
        tokens.append(m.groups())
        at = m.end()
    pos = 0

    def peek(i: int) -> str | None:
        return tokens[pos][i].lower() if pos < len(tokens) and tokens[pos][i] else None

    def comparison() -> Column:
        nonlocal pos
        if peek(0) == "not":
            pos += 1
            return ~comparison()
        if peek(1):
            pos += 1
            inner = either()
            if not peek(2):
                raise ValueError("a bracket isn't closed")
            pos += 1
            return inner
        if pos >= len(tokens) or not tokens[pos][3]:
            raise ValueError("a comparison is missing")
        _, _, _, path, op, value = tokens[pos]
        pos += 1
        c, op = F.col(path.replace("/", ".")), op.lower()
        if value.lower() == "null":
            if op not in ("eq", "ne"):
                raise ValueError(f"null has no order: {op}")
            return c.isNull() if op == "eq" else c.isNotNull()
        v: object = value[1:-1].replace("''", "'") if value[0] == "'" else value.lower() == "true" if value.lower() in ("true", "false") else float(value) if "." in value else int(value)
        if path == "doc_type":
            v = DOC_TYPES.get(v, v)
        return {"eq": c == v, "ne": c != v, "gt": c > v, "ge": c >= v, "lt": c < v, "le": c <= v}[op]

    def both() -> Column:
        nonlocal pos
        out = comparison()
        while peek(0) == "and":
            pos += 1
            out &= comparison()
        return out

    def either() -> Column:
        nonlocal pos
        out = both()
        while peek(0) == "or":
            pos += 1
            out |= both()
        return out

    result = either()
    if pos != len(tokens):
        raise ValueError("text after the filter's end")
    return result


def words_of(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda w: w != "")


def expanded(query: str, synonyms: list[tuple[list[str], str]]) -> list[str]:
    """The query's words with those of its synonyms: (terms, meaning) pairs."""
    found = [w for w in re.split(r"[^a-z0-9]+", query.lower()) if w]
    text, extra = " ".join(found), []
    for terms, meaning in synonyms:
        group = [*terms, meaning]
        if any(re.search(rf"\b{re.escape(t.lower())}\b", text) for t in group):
            extra += [w for t in group for w in re.split(r"[^a-z0-9]+", t.lower())]
    return list(dict.fromkeys(w for w in [*found, *extra] if w))


def bm25(docs: DataFrame, key: str, text: str, query: list[str]) -> DataFrame:
    """<key>, score of the documents with any of the query's words. Only the counts of the query's words leave a row;
    one aggregate row (number of documents, mean length, document frequencies) comes to the driver."""
    w = words_of(F.coalesce(F.col(text), F.lit("")))
    split = docs.select(key, F.explode(F.array(w)).alias("w"))  # explode of one element: the words are split once
    counted = split.select(key, F.size("w").alias("n"), *[F.size(F.filter("w", _same(t))).alias(f"t{i}") for i, t in enumerate(query)])
    stats = counted.agg(F.count("*").alias("d"), F.avg("n").alias("avg"), *[F.count_if(F.col(f"t{i}") > 0).alias(f"f{i}") for i in range(len(query))]).first()
    score = F.lit(0.0)
    for i in range(len(query)):
        idf = F.log(F.lit((stats["d"] - stats[f"f{i}"] + 0.5) / (stats[f"f{i}"] + 0.5) + 1.0))
        tf = F.col(f"t{i}")
        score += idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("n") / F.lit(float(stats["avg"] or 1.0))))
    return counted.select(key, score.alias("score")).where("score > 0")


def _same(term: str):
    return lambda x: x == term


def freshness(at: Column, now: Column, boost: float = 1.2, days: float = 365.0) -> Column:
    """Multiplier that falls quadratically from boost to 1 within days."""
    age = (F.unix_micros(now) - F.unix_micros(at)) / F.lit(86_400_000_000.0)
    return F.when(age < days, 1 + (boost - 1) * F.pow(1 - F.greatest(age, F.lit(0.0)) / days, 2.0)).otherwise(1.0)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "schedule_row").withColumn("doc_type", F.lit("schedule_row"))


def search_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = parse_filter("doc_type eq 'fact' and schedule_type eq 'panel' and (page ge 3 or poles eq '2') and not panel_name eq null")
    return _rows(spark, sf_dir).where(condition).select("row_id", "panel_name", "circuit_number", "page", "poles")


def search_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 best rows for a query with synonyms, ties by id."""
    hits = bm25(_rows(spark, sf_dir), "row_id", "content", expanded("water heater", [(["water heater"], "boiler")]))
    return hits.select("row_id", F.round("score", 6).alias("score")).orderBy(F.col("score").desc(), "row_id").limit(25)


SEARCH_LEXICAL_SQL = """
    WITH d AS (SELECT row_id, list_filter(regexp_split_to_array(lower(coalesce(content, '')), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM schedule_row),
    c AS (SELECT row_id, len(w) AS n, len(list_filter(w, lambda x: x = 'water')) AS t0, len(list_filter(w, lambda x: x = 'heater')) AS t1, len(list_filter(w, lambda x: x = 'boiler')) AS t2 FROM d),
    s AS (SELECT count(*) AS d, avg(n) AS a, count(*) FILTER (t0 > 0) AS f0, count(*) FILTER (t1 > 0) AS f1, count(*) FILTER (t2 > 0) AS f2 FROM c)
    SELECT row_id, score FROM (SELECT row_id, round(ln((d - f0 + 0.5) / (f0 + 0.5) + 1) * t0 * 2.2 / (t0 + 1.2 * (0.25 + 0.75 * n / a)) + ln((d - f1 + 0.5) / (f1 + 0.5) + 1) * t1 * 2.2 / (t1 + 1.2 * (0.25 + 0.75 * n / a))
           + ln((d - f2 + 0.5) / (f2 + 0.5) + 1) * t2 * 2.2 / (t2 + 1.2 * (0.25 + 0.75 * n / a)), 6) AS score FROM c, s WHERE t0 + t1 + t2 > 0) ORDER BY score DESC, row_id LIMIT 25"""


FACETS = ("discipline", "schedule_type", "revision", "sheet_number", "project_id")


def search_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each value of the facet fields, list fields item by item, in one pass."""
    fields = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in FACETS])
    levels = F.transform(F.coalesce("levels", F.array()), lambda v: F.struct(F.lit("levels").alias("facet"), v.alias("value")))
    x = _rows(spark, sf_dir).select(F.explode(F.concat(fields, levels)).alias("f")).select("f.facet", "f.value")
    return x.where("value IS NOT NULL").groupBy("facet", "value").agg(F.count("*").alias("n"))


SEARCH_FACETS_SQL = "SELECT facet, value, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS facet, {f} AS value FROM schedule_row" for f in FACETS) + " UNION ALL SELECT 'levels', unnest(levels) FROM schedule_row) WHERE value IS NOT NULL GROUP BY facet, value"


def search_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, rooms, then sheets: the first tier with hits answers. The tiers are probed with a limit of one row."""
    word = "mezzanine"
    tiers = [
        ("schedule_row", table(spark, sf_dir, "schedule_row").where(F.lower("content").contains(word)).select(F.col("row_id").alias("key"), F.col("sheet_number"))),
        ("room", table(spark, sf_dir, "a_rooms_template").where(F.lower("room_name").contains(word)).select(F.col("room_key").alias("key"), F.col("sheet_number"))),
        ("sheet", table(spark, sf_dir, "sheet_chunk").where(F.lower("content").contains(word)).select(F.col("chunk_id").alias("key"), F.col("sheet_number"))),
    ]
    for name, hits in tiers:
        if hits.limit(1).count() or name == "sheet":
            return hits.select(F.lit(name).alias("doc_type"), "key", "sheet_number")
    raise AssertionError


SEARCH_TIERS_SQL = """
    WITH r AS (SELECT 'schedule_row' AS doc_type, row_id AS key, sheet_number FROM schedule_row WHERE contains(lower(content), 'mezzanine')),
    m AS (SELECT 'room' AS doc_type, room_key AS key, sheet_number FROM a_rooms_template WHERE contains(lower(room_name), 'mezzanine')),
    s AS (SELECT 'sheet' AS doc_type, chunk_id AS key, sheet_number FROM sheet_chunk WHERE contains(lower(content), 'mezzanine'))
    SELECT * FROM r UNION ALL SELECT * FROM m WHERE NOT EXISTS (FROM r) UNION ALL SELECT * FROM s WHERE NOT EXISTS (FROM r) AND NOT EXISTS (FROM m)"""


# Fields of rows and of rooms that suggestions come from.
SUGGESTED, SUGGESTED_ROOMS = ("sheet_number", "sheet_title", "panel_name", "circuit_number", "description"), ("room_id", "room_name")


def search_suggest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values that hold the typed text, of the fields of rows and rooms."""
    typed = "pan"
    values = [df.select(F.explode(F.array(*fields)).alias("suggestion")) for df, fields in ((_rows(spark, sf_dir), SUGGESTED), (table(spark, sf_dir, "a_rooms_template"), SUGGESTED_ROOMS))]
    return values[0].unionByName(values[1]).where(F.lower("suggestion").contains(typed)).groupBy("suggestion").agg(F.count("*").alias("n"))


SEARCH_SUGGEST_SQL = f"""
    SELECT suggestion, count(*) AS n FROM (SELECT unnest([{', '.join(SUGGESTED)}]) AS suggestion FROM schedule_row UNION ALL SELECT unnest([{', '.join(SUGGESTED_ROOMS)}]) FROM a_rooms_template) WHERE contains(lower(suggestion), 'pan') GROUP BY suggestion"""


def search_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean freshness of each discipline's rows, against the newest arrival."""
    rows = _rows(spark, sf_dir)
    now = rows.agg(F.max("ingested_at").alias("now")).first()["now"]
    boost = freshness(F.col("ingested_at"), F.lit(now)) if now else F.lit(1.0)
    return rows.groupBy("discipline").agg(F.round(F.avg(boost), 8).alias("avg_boost"), F.count_if(boost > 1.0).alias("n_fresh"))


SEARCH_FRESH_SQL = """
    SELECT discipline, round(avg(b), 8) AS avg_boost, count(*) FILTER (b > 1.0) AS n_fresh FROM (SELECT discipline, CASE WHEN age < 365 THEN 1 + 0.2 * pow(1 - greatest(age, 0) / 365, 2) ELSE 1.0 END AS b
    FROM (SELECT discipline, (epoch_us((SELECT max(ingested_at) FROM schedule_row)) - epoch_us(ingested_at)) / 86400000000.0 AS age FROM schedule_row)) GROUP BY discipline"""


def _unit_rows(ids: pa.Array, vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of length 1; those that are null, not of dim finite numbers, or zero are left out."""
    whole = [(i, v) for i, v in zip(ids.to_pylist(), vectors.to_pylist()) if i is not None and v is not None and len(v) == dim and None not in v]
    out = np.array([v for _, v in whole], np.float64).reshape(-1, dim)
    norm = np.sqrt((out * out).sum(1))
    good = np.isfinite(norm) & (norm > 0)
    return np.array([i for i, _ in whole], np.int64)[good], out[good] / norm[good, None]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, ties by id: ids and scores. Places without a neighbour have the score -inf."""
    if len(scores) and scores.shape[1] > k:
        # ties at the k-th place are kept until ids decide
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
        width = int((scores >= least).sum(1).max())
        at = np.argpartition(-scores, min(width, scores.shape[1]) - 1, axis=1)[:, :width]
        ids, scores = np.take_along_axis(ids, at, 1), np.take_along_axis(scores, at, 1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 50, block: int = 20_000) -> DataFrame:
    """query_id, vec_id, score: the k vectors nearest to each query by cosine (5 decimals, ties by id), without itself; exact.

    The queries go to all tasks in blocks of at most about `block`; each block sees every vector once, a task keeps the k
    best of each query, and the best of all tasks are merged. Null, zero and odd-sized vectors are no neighbours and, as
    queries, have none; of repeated query ids one row counts. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    queries = queries.dropDuplicates(["vec_id"])
    sizes = queries.where("embedding IS NOT NULL").groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).collect()
    out = spark.createDataFrame([], "query_id bigint, vec_id bigint, score double")
    for dim, n in sorted((r["dim"], r["n"]) for r in sizes):
        blocks = -(-n // block)
        for b in range(blocks):
            own = queries.where((F.size("embedding") == dim) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)).select("vec_id", "embedding").toArrow()
            shared = spark.sparkContext.broadcast(_unit_rows(own.column(0), own.column(1), dim))

            def run(batches: Iterator[pa.RecordBatch], shared=shared, dim=dim) -> Iterator[pa.RecordBatch]:
                query_ids, unit = shared.value
                held = [(np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0))) for q in np.array_split(query_ids, -(-len(query_ids) // 500) or 1)]
                parts = list(zip(np.array_split(query_ids, len(held)), np.array_split(unit, len(held))))
                for batch in batches:
                    ids, rows = _unit_rows(batch.column(0), batch.column(1), dim)
                    for i, (q, u) in enumerate(parts):
                        scores = np.round(u @ rows.T, 5) + 0.0
                        scores[q[:, None] == ids[None, :]] = -np.inf
                        found = np.broadcast_to(ids, scores.shape)
                        held[i] = _best(np.concatenate([held[i][0], found], 1), np.concatenate([held[i][1], scores], 1), k)
                for (q, _), (ids, scores) in zip(parts, held):
                    real = np.isfinite(scores)
                    yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(q[:, None], ids.shape)[real]), pa.array(ids[real]), pa.array(scores[real])], names=["query_id", "vec_id", "score"])

            out = out.unionByName(vectors.select("vec_id", "embedding").mapInArrow(run, "query_id bigint, vec_id bigint, score double"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).drop("place")


def search_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 vectors nearest to each whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


SEARCH_NEAREST_SQL = """
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v)
    SELECT query_id, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM (SELECT q.vec_id AS query_id, u.vec_id, round(list_dot_product(q.e, u.e), 5) AS score FROM u q JOIN u ON q.vec_id <> u.vec_id WHERE q.vec_id % 20 = 0)) WHERE place <= 50"""

QUERIES = {f.__name__: f for f in (search_filter, search_lexical, search_facets, search_tiers, search_suggest, search_fresh, search_nearest)}
SQL = {
    "search_filter": "SELECT row_id, panel_name, circuit_number, page, poles FROM schedule_row WHERE schedule_type = 'panel' AND (page >= 3 OR poles = '2') AND panel_name IS NOT NULL",
    "search_lexical": SEARCH_LEXICAL_SQL, "search_facets": SEARCH_FACETS_SQL, "search_tiers": SEARCH_TIERS_SQL, "search_suggest": SEARCH_SUGGEST_SQL, "search_fresh": SEARCH_FRESH_SQL, "search_nearest": SEARCH_NEAREST_SQL,
}
