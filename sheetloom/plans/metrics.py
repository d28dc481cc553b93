"""Run metrics: rollups, exact percentiles, slowest operations, comparison of runs, slowdown alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetloom.tables import table


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("category"), F.col("user_id"), F.col("value").alias("duration"), F.to_date("ts").alias("day"))


def metrics_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average, extremes and count by category and day, by category, and over all, in one pass."""
    x = _events(spark, sf_dir).rollup("category", "day").agg(F.count("*").alias("n"), F.round(F.avg("duration"), 6).alias("avg_duration"), F.min("duration").alias("min_duration"), F.max("duration").alias("max_duration"))
    return x.withColumn("day", F.col("day").cast("string"))


def exact_percentiles(df: DataFrame, by: str, value: str, shares: tuple[float, ...], steps: int = 200) -> DataFrame:
    """<by>, n, and for each share a column p<percent>: linearly interpolated percentiles, exact.

    Approximate quantiles divide each group's values into about `steps` ranges, whose counts tell the one that holds each wanted
    rank; only the values of these few ranges are sorted, so no task sees a group whole. Null values are left out; a group without
    values has none; an empty table none.
    """
    x = df.where(F.col(value).isNotNull() & F.col(by).isNotNull()).select(F.col(by).alias("_by"), F.col(value).cast("double").alias("_v"))
    cuts = x.groupBy("_by").agg(F.count("*").alias("n"), F.percentile_approx("_v", [i / steps for i in range(1, steps)], 10_000).alias("_cuts"))
    few = cuts.limit(10_001).count() <= 10_000  # groups; what is sent to all tasks grows with their number alone
    sent = F.broadcast if few else (lambda df: df)
    placed = x.join(sent(cuts), "_by").select("_by", "n", "_v", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))).alias("_range"))
    counts = placed.groupBy("_by", "n", "_range").agg(F.count("*").alias("_in"))
    upto = F.sum("_in").over(Window.partitionBy("_by").orderBy("_range"))
    counts = counts.withColumn("_before", upto - F.col("_in"))
    ranks = F.explode(F.array_distinct(F.flatten(F.array(*[F.array(F.floor((F.col("n") - 1) * p), F.ceil((F.col("n") - 1) * p)) for p in shares])))).alias("_rank")
    wanted = counts.select("_by", "_range", "_before", "_in", ranks).where("_rank >= _before AND _rank < _before + _in")
    held = placed.join(sent(wanted.select("_by", "_range", "_before").distinct()), ["_by", "_range"]).withColumn("_rank", F.row_number().over(Window.partitionBy("_by", "_range").orderBy("_v")) - 1 + F.col("_before"))
    found = held.join(sent(wanted.select("_by", "_rank").distinct()), ["_by", "_rank"]).groupBy("_by", "n").agg(F.map_from_entries(F.collect_list(F.struct(F.col("_rank").cast("bigint").alias("k"), "_v"))).alias("_at"))
    out = []
    for p in shares:
        at = (F.col("n") - 1) * p
        low, high = F.try_element_at("_at", F.floor(at)), F.try_element_at("_at", F.ceil(at))
        out.append((low + (high - low) * (at - F.floor(at))).alias(f"p{int(p * 100)}"))
    return found.select(F.col("_by").alias(by), "n", *out)


def metrics_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact linearly interpolated percentiles per category."""
    x = exact_percentiles(_events(spark, sf_dir), "category", "duration", (0.5, 0.95, 0.99))
    return x.select("category", "n", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


def metrics_slowest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five slowest operations of each category, ties by id; group limits are applied before the shuffle."""
    w = Window.partitionBy("category").orderBy(F.col("duration").desc(), "event_id")
    return _events(spark, sf_dir).withColumn("place", F.row_number().over(w)).where("place <= 5").select("category", "place", "event_id", "duration")


def metrics_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day of each category against the day before it that it has."""
    days = _events(spark, sf_dir).groupBy("category", "day").agg(F.avg("duration").alias("avg"), F.count("*").alias("n"))
    w = Window.partitionBy("category").orderBy(F.col("day").desc())
    x = days.withColumns({"place": F.row_number().over(w), "before": F.lead("avg").over(w)}).where("place = 1 AND before IS NOT NULL")
    return x.select("category", F.round("avg", 6).alias("avg_now"), F.round("before", 6).alias("avg_before"), F.round((F.col("avg") - F.col("before")) / F.col("before") * 100, 4).alias("change_percent"))


def metrics_slowdowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which a category is at least a tenth slower than the mean of its five days before."""
    days = _events(spark, sf_dir).groupBy("category", "day").agg(F.avg("duration").alias("avg"))
    w = Window.partitionBy("category").orderBy("day").rowsBetween(-5, -1)
    x = days.withColumns({"usual": F.avg("avg").over(w), "n_points": F.count("avg").over(w)}).where("n_points >= 3 AND avg > usual * 1.1")
    return x.select("category", F.col("day").cast("string").alias("day"), F.round("avg", 6).alias("avg_duration"), F.round("usual", 6).alias("usual_duration"))


def metrics_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Success and failure counts with rates per project."""
    x = table(spark, sf_dir, "processing_state").groupBy("project_id").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "processed").alias("n_ok"))
    return x.withColumn("ok_percent", F.round(F.col("n_ok") / F.col("n") * 100, 4))


def metrics_work_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct files in the order they would be worked on: by discipline, then small ones first."""
    order = F.when(F.col("original_drawing_type") == "Architectural", 0).when(F.col("original_drawing_type") == "Electrical", 1).when(F.col("original_drawing_type") == "Mechanical", 2).when(F.col("original_drawing_type") == "Plumbing", 3).otherwise(4)
    files = table(spark, sf_dir, "processing_state").groupBy("pdf_path").agg(F.min(order).alias("priority"), F.max(F.length(F.coalesce("raw_ai_response_str", F.lit("")))).alias("size"))
    return files.orderBy("priority", "size", "pdf_path")


QUERIES = {f.__name__: f for f in (metrics_rollup, metrics_percentiles, metrics_slowest, metrics_compare, metrics_slowdowns, metrics_run_totals, metrics_work_order)}
_DAYS = "SELECT event_type AS category, CAST(ts AS DATE) AS day, avg(value) AS avg FROM events GROUP BY ALL"
SQL = {
    "metrics_rollup": "SELECT event_type AS category, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, round(avg(value), 6) AS avg_duration, min(value) AS min_duration, max(value) AS max_duration FROM events GROUP BY ROLLUP (event_type, CAST(ts AS DATE))",
    "metrics_percentiles": "SELECT event_type AS category, count(*) AS n, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type",
    "metrics_slowest": "SELECT category, CAST(place AS INT) AS place, event_id, duration FROM (SELECT event_type AS category, event_id, value AS duration, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS place FROM events) WHERE place <= 5",
    "metrics_compare": f"SELECT category, round(avg, 6) AS avg_now, round(before, 6) AS avg_before, round((avg - before) / before * 100, 4) AS change_percent FROM (SELECT *, row_number() OVER w AS place, lead(avg) OVER w AS before FROM ({_DAYS}) WINDOW w AS (PARTITION BY category ORDER BY day DESC)) WHERE place = 1 AND before IS NOT NULL",
    "metrics_slowdowns": f"SELECT category, CAST(day AS VARCHAR) AS day, round(avg, 6) AS avg_duration, round(usual, 6) AS usual_duration FROM (SELECT *, avg(avg) OVER w AS usual, count(avg) OVER w AS n_points FROM ({_DAYS}) WINDOW w AS (PARTITION BY category ORDER BY day ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)) WHERE n_points >= 3 AND avg > usual * 1.1",
    "metrics_run_totals": "SELECT project_id, count(*) AS n, count(*) FILTER (status = 'processed') AS n_ok, round(count(*) FILTER (status = 'processed') / count(*) * 100, 4) AS ok_percent FROM processing_state GROUP BY project_id",
    "metrics_work_order": "SELECT pdf_path, min(CASE original_drawing_type WHEN 'Architectural' THEN 0 WHEN 'Electrical' THEN 1 WHEN 'Mechanical' THEN 2 WHEN 'Plumbing' THEN 3 ELSE 4 END) AS priority, CAST(max(length(coalesce(raw_ai_response_str, ''))) AS INT) AS size FROM processing_state GROUP BY pdf_path",
}
