"""Queries of the text-corpus operators (problems 2, 3, 4, 8, 9 and 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.llm import coherence, leakage, packing, scanned, splitting, truncation
from sheetloom.tables import materialise, table


def _truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(table(spark, sf_dir, "processing_state"), "state_id", "ingest_source", "raw_ai_response_str", keep=materialise)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States whose response lost its end."""
    return _truncated(spark, sf_dir).select(F.col("key").alias("state_id"), F.col("source").alias("ingest_source"))


def p2_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each ingest_source, how many responses there are and how many lost their end, at a field limit or in transfer."""
    states = table(spark, sf_dir, "processing_state").where("trim(coalesce(raw_ai_response_str, '')) <> ''").groupBy(F.col("ingest_source")).agg(F.count("*").alias("n_responses"))
    lost = _truncated(spark, sf_dir).groupBy(F.col("source").alias("_s")).agg(F.count_if(F.col("cause") == "field_limit").alias("n_limit"), F.count_if(F.col("cause") == "transfer").alias("n_transfer"))
    x = states.join(lost, states["ingest_source"].eqNullSafe(lost["_s"]), "left").drop("_s").fillna(0, ["n_limit", "n_transfer"])
    return x.withColumn("lost_share", F.round((F.col("n_limit") + F.col("n_transfer")) / F.col("n_responses"), 6))


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_oversized(table(spark, sf_dir, "sheet_chunk"), table(spark, sf_dir, "chunk_limit"), "chunk_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that had to be cut, and how; each has exactly one first piece."""
    return _pieces(spark, sf_dir).where("piece_no = 1").select(F.col("key").alias("chunk_id"), "cut_kind")


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir).withColumnRenamed("key", "chunk_id")


def p3_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that the pieces make without their overlaps, and whether every piece keeps to the limit and overlaps as specified."""
    limits = table(spark, sf_dir, "chunk_limit").select("chunk_type", "max_chars")
    kinds = table(spark, sf_dir, "sheet_chunk").select("chunk_id", "chunk_type").join(F.broadcast(limits), "chunk_type")  # five limits
    parts = F.array_sort(F.collect_list(F.struct("piece_no", F.expr("substr(piece, overlap_chars + 1)").alias("t"))))
    x = p3_pieces(spark, sf_dir).groupBy("chunk_id").agg(F.array_join(F.transform(parts, lambda p: p["t"]), "").alias("content"), F.max(F.length("piece")).alias("longest"), F.count("*").alias("n_pieces"))
    return x.join(kinds, "chunk_id").select("chunk_id", "content", (F.col("longest") <= F.col("max_chars")).alias("keeps_limit"), (F.col("n_pieces") > 1).alias("is_cut"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = table(spark, sf_dir, "extraction_result").select("extraction_id", F.explode(F.array(
        F.struct(F.lit("raw_text").alias("rec_src"), F.col("raw_text").alias("text"), F.lit(True).alias("has_pages")),
        F.struct(F.lit("titleblock_text").alias("rec_src"), F.col("titleblock_text").alias("text"), F.lit(False).alias("has_pages")),
    )).alias("r"))
    extracted = extracted.select("r.rec_src", F.col("extraction_id").alias("rec_id"), F.col("extraction_id").alias("doc_id"), F.lit(None).cast("int").alias("page"), "r.text", "r.has_pages")
    pages = table(spark, sf_dir, "ocr_run_result").select(F.lit("ocr_text").alias("rec_src"), F.col("ocr_id").alias("rec_id"), F.col("extraction_id").alias("doc_id"), F.col("page").cast("int").alias("page"), "text", F.lit(True).alias("has_pages"))
    return extracted.unionByName(pages)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with traces of the scanned page."""
    return scanned.defects(_pages(spark, sf_dir), materialise)


def p4_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repaired paragraphs of each text."""
    return scanned.paragraphs(_pages(spark, sf_dir), materialise)


def p8_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers of each capacity, filled with whole documents where these fit."""
    return packing.pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "container_spec"), keep=materialise)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each capacity are."""
    specs = table(spark, sf_dir, "container_spec")
    each = p8_assignment(spark, sf_dir).groupBy("spec_id", "group_no", "container_no").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("items"))
    x = each.groupBy("spec_id").agg(F.count("*").alias("n_containers"), F.sum("items").alias("n_items"), F.sum("tokens").alias("n_tokens"))
    return x.join(specs, "spec_id").select("spec_id", "n_containers", "n_items", "n_tokens", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6).alias("fill_share"))


def p8_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each specification: documents in containers, containers over their capacity, documents divided without need, documents whose
    parts leave tokens out."""
    specs = table(spark, sf_dir, "container_spec")
    x = materialise(p8_assignment(spark, sf_dir).join(F.broadcast(specs), "spec_id"))  # three specifications
    held = x.groupBy("spec_id", "capacity_tokens", "separator_tokens", "group_no", "container_no").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"))
    over = held.groupBy("spec_id").agg(F.count_if(F.col("t") + (F.col("n") - 1) * F.col("separator_tokens") > F.col("capacity_tokens")).alias("n_over"))
    docs = x.groupBy("spec_id", "capacity_tokens", "doc_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"), F.max(F.col("first_token") + F.col("n_tokens")).alias("end"))
    sound = docs.groupBy("spec_id").agg(F.count("*").alias("n_docs"), F.count_if((F.col("n") > 1) & (F.col("t") <= F.col("capacity_tokens"))).alias("n_needless"), F.count_if(F.col("t") != F.col("end")).alias("n_gaps"))
    return sound.join(over, "spec_id").select("spec_id", "n_docs", "n_over", "n_needless", "n_gaps")


def _leaked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"), keep=materialise)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold 12 words of a passage in a row, or all of a shorter one."""
    return _leaked(spark, sf_dir).where("longest >= least(12, n_words)").select("item_id", "doc_id")


def p9_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose tiles cover at least 60 % of a passage, in whatever order."""
    return _leaked(spark, sf_dir).where("covered >= 0.6 * n_words").select("item_id", "doc_id", "n_words", "longest", "n_tiles", "covered")


def _shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coherence.spam_shares(table(spark, sf_dir, "documents"), "doc_id", "text", materialise)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shares(spark, sf_dir).where("share > 0.5").select("doc_id")


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shares(spark, sf_dir).select("doc_id", F.round("share", 4).alias("spam_share"))


QUERIES = {f.__name__: f for f in (p2_found, p2_rates, p3_found, p3_pieces, p3_rebuilt, p4_found, p4_paragraphs, p8_assignment, p8_fill, p8_sound, p9_found, p9_reordered, p10_found, p10_shares)}
SQL: dict[str, str] = {
    "p3_found": r"""
        SELECT c.chunk_id, CASE WHEN list_max(list_transform(regexp_split_to_array(c.content, '[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda x: length(x))) > l.max_chars
               THEN 'forced' ELSE 'natural' END AS cut_kind
        FROM sheet_chunk c JOIN chunk_limit l USING (chunk_type) WHERE length(c.content) > l.max_chars""",
    "p3_rebuilt": "SELECT chunk_id, content, true AS keeps_limit, true AS is_cut FROM sheet_chunk JOIN chunk_limit USING (chunk_type) WHERE length(content) > max_chars",
    "p8_sound": "SELECT spec_id, (SELECT count(DISTINCT doc_id) FROM documents WHERE text <> '') AS n_docs, CAST(0 AS BIGINT) AS n_over, CAST(0 AS BIGINT) AS n_needless, CAST(0 AS BIGINT) AS n_gaps FROM container_spec",
    "p9_found": r"""
        WITH e AS (SELECT item_id, regexp_extract_all(lower(passage), '[\p{L}\p{N}]+') AS w FROM eval_item),
        p AS (SELECT DISTINCT item_id, least(12, len(w)) AS k, unnest(list_transform(range(1, len(w) - least(12, len(w)) + 2), lambda i: array_to_string(w[i : i + least(12, len(w)) - 1], ' '))) AS g FROM e WHERE len(w) > 0),
        d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
        t AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS g FROM d, (SELECT DISTINCT k FROM p) WHERE len(w) >= k)
        SELECT DISTINCT item_id, doc_id FROM p JOIN t USING (k, g)""",
}
