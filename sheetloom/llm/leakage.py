"""Held-out passages inside a corpus, found by greedy string tiling.

Documents that share a seed (a run of words) with a passage are tiled against it: the longest common run of
words is marked, then the longest among what is unmarked, and so on, candidates being found by a running
Karp-Rabin hash. The longest tile tells of verbatim leaks, the covered share of reordered ones.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sheetloom.llm.words import Words, in_blocks

WORD = re.compile(r"[^\W_]+")
BASE = np.uint64(1_000_003)
RESULT = "item_id {item}, doc_id {doc}, n_words int, longest int, n_tiles int, covered int"
#: Characters of passages that every task may hold; more of them are joined by their seeds.
HELD = 16_000_000
#: Bits of the filter that seeds of texts pass before they are joined.
FILTER_BITS = 1 << 26
#: Passages that a row holds when a text is tiled against those it shares seeds with.
TOGETHER = 200


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, case ignored."""
    return WORD.findall(text.lower()) if text else []


def running_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hashes, modulo 2**64, of all runs of k numbers."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * BASE + ids[i : i + n]
    return out


class Passages:
    """A block of passages with their seeds. seed: words in a seed; a shorter passage is one seed."""

    def __init__(self, items: list[tuple], seed: int, least_tile: int) -> None:
        self.least_tile = least_tile
        self.vocabulary: dict[str, int] = {}
        self.items: dict = {}
        self.seeds: dict[int, dict[int, list[tuple]]] = defaultdict(lambda: defaultdict(list))
        for number, (key, text) in enumerate(items):
            found = words(text)
            if not found:
                continue
            key = (number, key)
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found], np.uint64)
            k = min(seed, len(ids))
            self.items[key] = (ids, k)
            for at, h in enumerate(running_hashes(ids, k).tolist()):
                self.seeds[k][h].append((key, at))
        self.sorted = {k: np.array(sorted(seeds), np.uint64) for k, seeds in self.seeds.items()}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"seeds": {k: dict(v) for k, v in self.seeds.items()}}

    def found_in(self, text: str) -> Iterator[tuple]:
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words(text)], np.uint64)
        hits: dict = defaultdict(list)
        for k, seeds in self.seeds.items():
            hashes = running_hashes(ids, k)
            if not len(hashes):
                continue
            for at in np.flatnonzero(np.isin(hashes, self.sorted[k])).tolist():
                if 0 not in ids[at : at + k]:
                    for key, there in seeds[int(hashes[at])]:
                        hits[key].append((at, there))
        for key, starts in hits.items():
            tiles = self.tile(ids, *self.items[key], starts)
            if tiles:
                yield key[1], len(self.items[key][0]), max(t[2] for t in tiles), len(tiles), sum(t[2] for t in tiles)

    def tile(self, doc: np.ndarray, passage: np.ndarray, k: int, starts: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """Greedy tiling of the runs that the seeds start: (position in the document, in the passage, length)."""
        a, b = doc.tolist(), passage.tolist()
        runs, done = [], {}
        for i, j in starts:
            if done.get(i - j, -1) >= i + k:  # inside a run of the same diagonal
                continue
            if a[i : i + k] != b[j : j + k]:  # equal hashes of other words
                continue
            n = k
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            done[i - j] = i + n
            runs.append((n, i, j))
        used_a, used_b, tiles = set(), set(), []
        while runs:
            runs.sort(key=lambda r: (-r[0], r[1], r[2]))
            n, i, j = runs[0]
            tiles.append((i, j, n))
            used_a.update(range(i, i + n))
            used_b.update(range(j, j + n))
            runs = [piece for r in runs[1:] for piece in self.unmarked(r, used_a, used_b, min(self.least_tile, len(b)))]
        return tiles

    @staticmethod
    def unmarked(run: tuple[int, int, int], used_a: set, used_b: set, least: int) -> Iterator[tuple[int, int, int]]:
        n, i, j = run
        start = 0
        for at in range(n + 1):
            if at == n or i + at in used_a or j + at in used_b:
                if at - start >= least:
                    yield at - start, i + start, j + start
                start = at + 1


def seed_hashes(texts: list[str], k: int, block: Words | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a text, and the numbers of their texts."""
    block = block or Words(texts)
    hashes = running_hashes(block.ids.astype(np.uint64), k)
    inside = block.of[: len(hashes)] == block.of[k - 1 :][: len(hashes)]
    return hashes[inside], block.of[: len(hashes)][inside]


def _places(hashes: np.ndarray, k: int) -> np.ndarray:
    """Places of hashes of runs of k words in the filter."""
    with np.errstate(over="ignore"):
        return ((hashes + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(38)).astype(np.int64) % FILTER_BITS


def _key_type(df: DataFrame, key: str) -> str:
    return df.select(key).schema[0].dataType.simpleString()


def leaked(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", text: str = "text", item_key: str = "item_id", passage: str = "passage", seed: int = 6, least_tile: int = 5, held: int = HELD, keep=lambda x: x) -> DataFrame:
    """Pairs of passage and document that share a seed: item_id, doc_id, n_words (of the passage), longest,
    n_tiles, covered (words in tiles).

    The passages are the stated query set. Where they have at most `held` characters all tasks hold them and one narrow pass
    reads the documents; where they have more, the documents' seeds that pass a filter of the passages' seeds are joined with
    these, and each document is tiled against the passages it shares seeds with. Either way every document is read once for
    seeds, however many passages there are. Null and empty texts and passages match nothing; repeated documents each match;
    each different passage of a repeated item key matches on its own. Empty tables give no pairs.
    """
    items = items.where(F.col(item_key).isNotNull() & (F.length(passage) > 0)).select(F.col(item_key).alias("_item"), F.col(passage).cast("string").alias("_passage")).distinct()
    docs = docs.select(F.col(doc_key).alias("_doc"), F.col(text).cast("string").alias("_text")).where(F.length("_text") > 0)
    if (items.agg(F.sum(F.length("_passage"))).first()[0] or 0) <= held:
        return _held_pass(docs, items, seed, least_tile)
    return _seed_join(docs, items, seed, least_tile, keep)


def _result(item_type, doc_type, rows: list[tuple], keys: list) -> pa.RecordBatch:
    item, *numbers = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(item, item_type), pa.array(keys, doc_type), *[pa.array(c, pa.int32()) for c in numbers]], names=["item_id", "doc_id", "n_words", "longest", "n_tiles", "covered"])


def _shape(docs: DataFrame, items: DataFrame) -> tuple:
    return to_arrow_type(items.schema["_item"].dataType), RESULT.format(item=_key_type(items, "_item"), doc=_key_type(docs, "_doc"))


def _held_pass(docs: DataFrame, items: DataFrame, seed: int, least_tile: int) -> DataFrame:
    own = [tuple(r) for r in items.orderBy("_item", "_passage").collect()]
    lengths = {}
    for _, p in own:
        if found := len(words(p)):
            lengths.setdefault(min(seed, found), []).append(p)
    seeds = {k: np.unique(np.concatenate([seed_hashes(part, k)[0] for _, part in in_blocks([p.lower() for p in ps])])) for k, ps in lengths.items()}
    shared = docs.sparkSession.sparkContext.broadcast((Passages(own, seed, least_tile), seeds))
    kind, shape = _shape(docs, items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages, wanted = shared.value
        for batch in batches:
            rows, keys, doc_keys, texts = [], [], batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for begin, part in in_blocks(texts):
                block = Words([t.lower() for t in part]) if wanted else None
                hit: set[int] = set()
                for k, hashes in wanted.items():
                    asked, of = seed_hashes(part, k, block)
                    at = np.minimum(np.searchsorted(hashes, asked), len(hashes) - 1)
                    hit.update(np.unique(of[hashes[at] == asked]).tolist())
                for i in sorted(hit):
                    for found in passages.found_in(part[i]):
                        rows.append(found)
                        keys.append(doc_keys[begin + i])
            if rows:
                yield _result(kind, batch.schema.field(0).type, rows, keys)

    return docs.mapInArrow(run, shape)


def _seed_join(docs: DataFrame, items: DataFrame, seed: int, least_tile: int, keep) -> DataFrame:
    spark = docs.sparkSession
    numbered = keep(items.withColumn("_no", F.xxhash64("_item", "_passage")))

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            by: dict[int, list[int]] = defaultdict(list)
            texts = [t.lower() for t in batch.column(1).to_pylist()]
            for i, n in enumerate(np.bincount(Words(texts).of, minlength=len(texts)).tolist()):
                if n:
                    by[min(seed, n)].append(i)
            for k, own in by.items():
                hashes, of = seed_hashes([texts[i] for i in own], k)
                yield pa.RecordBatch.from_arrays([pa.array(numbers[np.array(own)[of]]), pa.array(np.full(len(of), k, np.int32)), pa.array(hashes.astype(np.int64)), pa.array(_places(hashes, k))], names=["_no", "k", "h", "place"])

    seeds = keep(numbered.select("_no", "_passage").mapInArrow(item_seeds, "_no bigint, k int, h bigint, place bigint").distinct())
    bits = seeds.select(F.floor(F.col("place") / 32).cast("int").alias("w"), F.expr("shiftleft(1L, cast(place % 32 as int))").alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    table[bits.column(0).to_numpy()] = bits.column(1).to_numpy().astype(np.uint32)
    ks = sorted(r[0] for r in seeds.select("k").distinct().collect())
    shared = spark.sparkContext.broadcast((table, ks))
    doc_type = _key_type(docs, "_doc")

    def doc_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, lengths = shared.value
        for batch in batches:
            for begin, part in in_blocks(batch.column(2).to_pylist()):
                block = Words([t.lower() for t in part])
                for k in lengths:
                    hashes, of = seed_hashes(part, k, block)
                    places = _places(hashes, k)
                    passed = (filter_[places // 32] >> (places % 32).astype(np.uint32)) & np.uint32(1) > 0
                    once = np.unique(np.stack([of[passed], hashes[passed].astype(np.int64)]), axis=1)
                    at = pa.array(begin + once[0])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.full(once.shape[1], k, np.int32)), pa.array(once[1])], names=["_doc", "_th", "k", "h"])

    marked = docs.withColumn("_th", F.xxhash64("_text")).select("_doc", "_th", "_text")
    pairs = marked.mapInArrow(doc_seeds, f"_doc {doc_type}, _th bigint, k int, h bigint").join(seeds.select("k", "h", "_no"), ["k", "h"]).select("_doc", "_th", "_no").distinct()
    # the passages of a document travel in rows of about TOGETHER, so that no row grows with the query set
    sets = F.greatest(F.lit(1), F.ceil(F.lit(numbered.count() / TOGETHER))).cast("int")
    asked = pairs.join(numbered, "_no").groupBy("_doc", "_th", F.pmod(F.hash("_no"), sets).alias("_set")).agg(F.collect_list(F.struct("_item", "_passage")).alias("_asked"))
    kind, shape = _shape(docs, items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], []
            for key, doc, own in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for found in Passages([(o["_item"], o["_passage"]) for o in own], seed, least_tile).found_in(doc):
                    rows.append(found)
                    keys.append(key)
            if rows:
                yield _result(kind, batch.schema.field(0).type, rows, keys)

    there = asked["_doc"].eqNullSafe(marked["_doc"]) & (asked["_th"] == marked["_th"])
    return marked.join(asked, there).select(marked["_doc"], "_text", "_asked").mapInArrow(run, shape)
