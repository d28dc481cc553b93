"""Oversized texts cut into overlapping pieces at natural boundaries.

Recursive separator hierarchy: section, paragraph, line, sentence, word, character. A stretch that fits is
never cut at a lower level; neighbouring stretches are packed greedily up to the limit, each piece repeating
the end of the one before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Each pattern's match belongs to the stretch before it, except for the lookahead of the first.
LEVELS = [re.compile(p) for p in (r"\n\s*\n(?=#|[A-Z0-9][A-Z0-9 .,&/()-]{3,}\n)", r"\n\s*\n\s*", r"\n\s*", r"[.!?;:]+[\"')\]]*\s+", r"\s+")]
WHITE = r"[\s\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def stretches(text: str, start: int, end: int, most: int, level: int = 0) -> Iterator[tuple[int, int]]:
    """Consecutive stretches of text[start:end], each of at most `most` characters, cut at the highest level that does."""
    todo = [(start, end, level)]
    while todo:
        a, b, level = todo.pop()
        if b - a <= most:
            yield a, b
        elif level == len(LEVELS):
            for at in range(a, b, most):
                yield at, min(at + most, b)
        else:
            cuts = [a, *(m.end() for m in LEVELS[level].finditer(text, a, b) if a < m.end() < b), b]
            todo.extend((c, d, level + 1) for c, d in reversed(list(zip(cuts, cuts[1:]))))


def back_to_word(text: str, at: int, floor: int) -> int:
    """The start of the word that `at` is in, but not before floor."""
    while at > floor and not text[at - 1].isspace():
        at -= 1
    return at


def split_text(text: str, most: int, overlap: int) -> list[tuple[int, int, int]]:
    """Pieces (start, end, overlap with the piece before) of at most `most` characters that cover the text. Each
    repeats `overlap` characters of the one before, and up to as many again to begin with a whole word."""
    most = max(1, most)
    overlap = max(0, min(overlap, most - 1, most // 2))
    if len(text) <= most:
        return [(0, len(text), 0)]
    pieces: list[tuple[int, int, int]] = []
    start = fresh = end = 0
    for a, b in stretches(text, 0, len(text), most - overlap):
        if b - start > most:
            pieces.append((start, end, fresh - start))
            fresh = end
            room = most - (b - a)
            start = back_to_word(text, end - overlap, max(end - room, end - 2 * overlap, 0)) if overlap else end
            if start > 0 and not text[start - 1].isspace():
                start = end - overlap
        end = b
    pieces.append((start, end, fresh - start))
    return pieces


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kind = batch.schema.field(0).type
        keys, rows = [], []
        for key, text, most, overlap, cut_kind in zip(*(batch.column(i).to_pylist() for i in range(5))):
            for n, (a, b, again) in enumerate(split_text(text, most, overlap), 1):
                keys.append(key)
                rows.append((n, a, again, text[a:b], cut_kind))
                if len(rows) >= 1000:
                    yield _pieces(kind, keys, rows)
                    keys, rows = [], []
        if rows:
            yield _pieces(kind, keys, rows)


def _pieces(kind: pa.DataType, keys: list, rows: list[tuple]) -> pa.RecordBatch:
    no, start, again, text, cut_kind = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(no, pa.int32()), pa.array(start, pa.int32()), pa.array(again, pa.int32()), pa.array(text, pa.string()), pa.array(cut_kind, pa.string())], names=["key", "piece_no", "start_char", "overlap_chars", "piece", "cut_kind"])


def oversized(df: DataFrame, limits: DataFrame, key: str, kind: str, text: str) -> DataFrame:
    """Texts over the limit of their kind: key, text, max_chars, overlap_chars, cut_kind ('forced' where a
    stretch without white space is longer than the limit, else 'natural')."""
    l = limits.groupBy(F.col(kind).alias("_kind")).agg(F.min("max_chars").alias("_max"), F.min("overlap_chars").alias("_over"))
    x = df.select(F.col(key).alias("key"), F.col(kind).alias("kind"), F.col(text).alias("text")).join(l, F.col("kind") == F.col("_kind"))
    run = F.array_max(F.transform(F.split("text", WHITE), F.length))
    return x.where(F.length("text") > F.col("_max")).select("key", "text", F.col("_max").cast("int").alias("max_chars"), F.coalesce(F.col("_over"), F.lit(0)).cast("int").alias("overlap_chars"), F.when(run > F.col("_max"), "forced").otherwise("natural").alias("cut_kind"))


def split_oversized(df: DataFrame, limits: DataFrame, key: str, kind: str = "chunk_type", text: str = "content") -> DataFrame:
    """Pieces of the oversized texts of df: key, piece_no, start_char, overlap_chars (repeated from the piece
    before), piece, cut_kind. limits: <kind>, max_chars, overlap_chars.

    Texts within their limit, null and empty ones and those of a kind without a limit are not cut; of repeated
    limits the smallest counts; repeated rows are each cut. Only oversized texts reach Python, one pass without
    a shuffle but the join with the limits.
    """
    x = oversized(df, limits, key, kind, text)
    key_type = x.schema["key"].dataType.simpleString()
    return x.select("key", "text", "max_chars", "overlap_chars", "cut_kind").mapInArrow(_split, f"key {key_type}, piece_no int, start_char int, overlap_chars int, piece string, cut_kind string")
