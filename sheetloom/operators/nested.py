"""Deeply nested records to related flat tables, by shared inlining.

A first pass takes every record apart and counts its elements' names. This schema graph (which name occurs inside which)
decides what becomes a table: elements that repeat (array items), that are shared (occur inside differently named parents)
or that are recursive. A second pass makes the rows; all other objects are inlined into the nearest row above them. Rows are
named by the JSON Pointer of their object; each child row carries that of its parent. Both passes are narrow.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROOT = "record"
#: Table names that every task may hold; if there are more, each record is joined with those it has.
HELD = 100_000
#: Rows in a batch that leaves a task, whatever a record holds.
MOST = 2000
ROWS = "table_name string, obj_path string, parent_table string, parent_path string, item_path string, is_item boolean, ordinal int, cells map<string,string>"
_ROW = pa.struct(
    [("table_name", pa.string()), ("obj_path", pa.string()), ("parent_table", pa.string()), ("parent_path", pa.string()), ("item_path", pa.string()), ("is_item", pa.bool_()), ("ordinal", pa.int32()),
     ("cells", pa.map_(pa.string(), pa.string()))]
)


def _text(value: object) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def parsed(text: str | None) -> object:
    """The value of a JSON text; null for null, empty and faulty text."""
    try:
        return json.loads(text) if text else None
    except (ValueError, RecursionError):
        return None


def _step(key: str) -> str:
    return key.replace("~", "~0").replace("/", "~1")


def _inner(value: object) -> bool:
    """Whether a member holds objects or lists of its own, so that it isn't a cell (or not only one)."""
    return isinstance(value, dict) or isinstance(value, list) and any(isinstance(x, (dict, list)) for x in value)


def edges_of(root: object) -> Iterator[tuple[str, str | None, bool, bool]]:
    """tag, parent_tag, is_item and is_recursive of each object."""
    stack: list[tuple] = [(root, ROOT, None, False)]  # value, element name, chain of names above, item or not
    while stack:
        value, tag, above, is_item = stack.pop()
        if isinstance(value, list):
            stack += [(x, tag, above, True) for x in value if isinstance(x, (dict, list))]
        elif isinstance(value, dict):
            up = above
            while up is not None and up[0] != tag:
                up = up[1]
            yield tag, above[0] if above else None, is_item, up is not None
            stack += [(child, key, (tag, above), False) for key, child in value.items() if _inner(child)]


def rows_of(root: object, tables) -> list[dict]:
    """The rows of one record, parents before children. tables: names of elements that are tables."""
    out: list[dict] = []
    # value, its pointer, element name, row that owns it, prefix of its columns there, nearest array item above, item or not, ordinal
    stack: list[tuple] = [(root, "", ROOT, None, "", "", False, 0)]
    while stack:
        value, path, tag, owner, prefix, item, is_item, ordinal = stack.pop()
        if isinstance(value, list):
            stack += [(value[i], f"{path}/{i}", tag, owner, prefix, item, True, i) for i in range(len(value) - 1, -1, -1) if isinstance(value[i], (dict, list))]
        elif isinstance(value, dict):
            if is_item or owner is None or tag in tables:
                row = {"table_name": tag, "obj_path": path, "parent_table": owner and owner["table_name"], "parent_path": owner and owner["obj_path"], "item_path": item, "is_item": is_item, "ordinal": ordinal, "cells": {}}
                out.append(row)
                prefix = ""
            else:
                row = owner
            inner = []
            for key, child in value.items():
                nested = _inner(child)
                if nested:
                    inner.append((child, f"{path}/{_step(key)}", key, row, f"{prefix}{_step(key)}.", path if is_item else item, False, 0))
                if not nested or isinstance(child, list) and any(not isinstance(x, dict) for x in child):
                    row["cells"][prefix + _step(key)] = _text(child)
            stack += reversed(inner)
    return out


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = Counter(e for text in batch.column(0).to_pylist() for e in edges_of(parsed(text)))
        if counts:
            tag, parent, item, recursive = zip(*counts)
            yield pa.RecordBatch.from_arrays([pa.array(tag, pa.string()), pa.array(parent, pa.string()), pa.array(item), pa.array(recursive), pa.array(list(counts.values()), pa.int64())], names=["tag", "parent_tag", "is_item", "is_recursive", "n"])


def schema_graph(df: DataFrame, text: str) -> DataFrame:
    """One row per element name of df's JSON texts: tag, n_rows, n_parents (different names of parents), is_item, is_recursive, is_table.
    Counted with partial sums; an empty table has none."""
    edges = df.select(F.col(text).cast("string").alias("_text")).mapInArrow(_edges, "tag string, parent_tag string, is_item boolean, is_recursive boolean, n bigint")
    edges = edges.groupBy("tag", "parent_tag").agg(F.sum("n").alias("n"), F.bool_or("is_item").alias("is_item"), F.bool_or("is_recursive").alias("is_recursive"))
    graph = edges.groupBy("tag").agg(F.sum("n").alias("n_rows"), F.count("parent_tag").alias("n_parents"), F.bool_or("is_item").alias("is_item"), F.bool_or("is_recursive").alias("is_recursive"))
    return graph.withColumn("is_table", F.col("is_item") | F.col("is_recursive") | (F.col("n_parents") > 1) | (F.col("tag") == ROOT))


def flat_rows(df: DataFrame, key: str, text: str, graph: DataFrame, held: int = HELD) -> DataFrame:
    """Rows of all tables: rec_id and ROWS. parent_path names the row above, item_path the nearest array item around; cells hold
    column name to text, those of inlined objects prefixed with their relative path.

    Null, empty and faulty texts have no rows; repeated rows of df each give theirs; of a repeated JSON key the last value counts.
    df may have any further columns.
    """
    kind = df.select(F.col(key).alias("rec_id")).schema["rec_id"].dataType.simpleString()
    tables = graph.where("is_table").select("tag")
    x = df.select(F.col(key).alias("rec_id"), F.col(text).cast("string").alias("_text"))
    few = tables.limit(held + 1).count() <= held
    shared = df.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in tables.collect()) if few else frozenset())

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(k, t) for k, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for t in {e[0] for e in edges_of(parsed(s))}]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], batch.schema.field(0).type), pa.array([p[1] for p in pairs], pa.string())], names=["rec_id", "tag"])

    if not few:
        names = x.mapInArrow(own, f"rec_id {kind}, tag string").distinct().join(tables, "tag").groupBy("rec_id").agg(F.collect_list("tag").alias("_tables"))
        x = x.join(names, "rec_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told, rows, at = batch.column(2).to_pylist() if batch.num_columns > 2 else None, [], []
            for i, (rec, s) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                for row in rows_of(parsed(s.as_py()), shared.value if told is None else frozenset(told[i] or ())):
                    rows.append(row | {"cells": list(row["cells"].items())})
                    at.append(rec)
                    if len(rows) >= MOST:
                        yield _batch(batch.schema.field(0).type, at, rows)
                        rows, at = [], []
            if rows:
                yield _batch(batch.schema.field(0).type, at, rows)

    return x.mapInArrow(run, f"rec_id {kind}, {ROWS}")


def _batch(kind: pa.DataType, at: list, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(at, type=kind), *pa.array(rows, type=_ROW).flatten()], names=["rec_id", *[f.name for f in _ROW]])


def flat_table(rows: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """One of the tables, with the columns asked for: rec_id, obj_path, parent_table, parent_path, ordinal and a STRING column c_<column> each."""
    return rows.where(F.col("table_name") == name).select("rec_id", "obj_path", "parent_table", "parent_path", "ordinal", *[F.try_element_at("cells", F.lit(c)).alias(f"c_{c}") for c in columns])
