"""Keyword-stuffed and link-list pages, found by the coherence of neighbouring words.

Corpus counts (each distinct text once) give the pointwise mutual information of all neighbouring words and the
usual density of each word. In a sliding window over a text, a low mean information marks word salad: lists of
keywords, tags and anchors. A word far denser than in nearly all texts that have it, where the window isn't
highly coherent, marks excessively repeated collocations. Addresses and link markup count as links. A text is
spam if more than half of its characters are so marked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.llm import words

LINK = re.compile(r"<a\s[^>]*>|</a>|\]\([^)\s]*\)|(?:https?://|www\.)\S+")
#: Without any of these a text holds no link.
LINK_SIGNS = ("<a", "</a>", "](", "://", "www.")

#: Pairs to each side in a window; mean information (bits) below which a window is word salad.
WINDOW, SALAD = 12, -0.9
#: Words to each side for a word's local density; least density, times the usual one, least occurrences there, words
#: around each that belong to it, and the mean information above which a text is too coherent to be stuffed.
REACH, DENSE, TIMES, LEAST, AROUND, COHERENT = 20, 0.12, 2.5, 4, 4, 0.5
#: The share of the texts having a word in which it is at most usually dense; histogram steps per doubling of density.
USUAL, STEPS = 0.97, 8
#: What the usual density of a word is shrunk to, and with the weight of how many texts.
RARE_DENSITY, RARE_WEIGHT = 0.04, 15
#: Statistics (of words and pairs, 12 bytes each) that every task may hold; the rarer ones beyond are joined.
HELD = 4_000_000


class Block:
    """Texts taken apart together: ids, starts (code points from the block's beginning) and text numbers (of) of their words outside
    links (those with digits left out), first (number of each text's first word, and one past the last), links (spans), at (where each
    text begins, and one past the last), sizes."""

    def __init__(self, texts: list[str]) -> None:
        self.links: list[tuple[int, int]] = []
        plain, offset = [], 0
        for text in texts:
            if any(sign in text for sign in LINK_SIGNS):
                self.links += [(offset + m.start(), offset + m.end()) for m in LINK.finditer(text)]
                plain.append(LINK.sub(lambda m: " " * len(m.group()), text))
            else:
                plain.append(text)
            offset += len(text) + 1
        found = words.Words(plain)
        self.sizes, self.at, kept = found.sizes, found.at, ~found.digits
        self.ids, self.starts, self.of = found.ids[kept], found.starts[kept], found.of[kept]
        self.first = np.searchsorted(self.starts, self.at)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pairs of neighbours within a text, and the number of each pair's first word."""
        where = np.flatnonzero(self.of[1:] == self.of[:-1])
        with np.errstate(over="ignore"):
            a, b = self.ids[where].astype(np.uint64), self.ids[where + 1].astype(np.uint64)
            return (words.mixed(a * words.ODD ^ (b * words.MIX + np.uint64(0x165667B19E3779F9))) >> np.uint64(1)).astype(np.int64), where


def blocks(texts: list[str]) -> Iterator[tuple[int, Block]]:
    return ((begin, Block(own)) for begin, own in words.in_blocks(texts))


def _once(ids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different id of each text, and how often the text has it."""
    with np.errstate(over="ignore"):
        key = ids.astype(np.uint64) ^ (of.astype(np.uint64) + np.uint64(1)) * words.ODD
    order = np.argsort(key)
    new = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0])) if len(key) else np.empty(0, np.int64)
    return order[new], np.diff(np.append(new, len(key)))


COUNTS = "k bigint, a bigint, b bigint, step int"


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k, a, b, step: a word (k, step of its density) or a pair (k, its words a and b), once for each text having it."""
    for batch in batches:
        for _, block in blocks(batch.column(0).to_pylist()):
            at, n = _once(block.ids, block.of)
            lengths = np.diff(block.first)[block.of[at]]
            own, steps = block.ids[at], np.floor(np.log2(n / lengths) * STEPS).astype(np.int32)
            pairs, where = block.pairs()
            once, _ = _once(pairs, block.of[where])
            first, second = block.ids[where[once]], block.ids[where[once] + 1]
            none = pa.nulls(len(own), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(own), none, none, pa.array(steps)], names=["k", "a", "b", "step"])
            yield pa.RecordBatch.from_arrays([pa.array(pairs[once]), pa.array(first), pa.array(second), pa.nulls(len(once), pa.int32())], names=["k", "a", "b", "step"])


def looked_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the asked keys (0 for those that keys, ascending, don't have) and which it has."""
    if not len(keys):
        return np.zeros(len(asked), np.float32), np.zeros(len(asked), bool)
    order = np.argsort(asked)  # ascending questions are answered much faster
    at = np.empty(len(asked), np.int64)
    at[order] = np.minimum(np.searchsorted(keys, asked[order]), len(keys) - 1)
    has = keys[at] == asked
    return np.where(has, values[at], np.float32(0)), has


def _added(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the spans from low to (without) high."""
    change = np.bincount(low, minlength=n + 1).astype(np.int64)
    change -= np.bincount(high, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def spam_shares_of(block: Block, bits: np.ndarray, where: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Share of each text's characters in salad, stuffing and links. bits: information of the block's pairs (which begin
    at the words where), usual: usual density of its words."""
    n = len(block.ids)
    low_of, high_of = block.first[:-1][block.of], block.first[1:][block.of]
    chars = int(block.at[-1])
    begin, end = np.empty(0, np.int64), np.empty(0, np.int64)
    if len(bits):
        total = np.concatenate([[0.0], np.cumsum(bits, dtype=np.float64)])
        # the pairs of a text are numbered on from its first word's, one fewer than its words
        number = np.searchsorted(where, np.arange(n + 1))
        at = np.arange(len(bits))
        low, high = np.maximum(at - WINDOW, number[low_of[where]]), np.minimum(at + WINDOW + 1, number[high_of[where]])
        mean = np.full(n, np.inf)
        mean[where] = (total[high] - total[low]) / (high - low)
        last = block.first[1:][np.diff(block.first) > 1] - 1
        mean[last] = mean[last - 1]
        marked = mean < SALAD
        order = np.lexsort((block.ids, block.of))
        new = np.concatenate([[True], (np.diff(block.ids[order]) != 0) | (np.diff(block.of[order]) != 0)])
        place = (np.cumsum(new) * (n + 2 * REACH)) + order
        near = np.empty(n, np.int64)
        near[order] = np.searchsorted(place, place + REACH, side="right") - np.searchsorted(place, place - REACH)
        each = np.arange(n)
        room = np.minimum(each + REACH + 1, high_of) - np.maximum(each - REACH, low_of)
        dense = np.flatnonzero((near >= LEAST) & (near >= DENSE * room) & (near >= TIMES * usual * room) & (high_of - low_of > 1))
        around = _added(n, np.maximum(dense - AROUND, low_of[dense]), np.minimum(dense + AROUND + 1, high_of[dense]))
        marked |= around & (mean < COHERENT)
        found = np.flatnonzero(marked)
        ends = np.append(block.starts[1:], chars)
        ends = np.where(np.arange(n) == high_of - 1, block.at[1:][block.of] - 1, ends)
        begin, end = block.starts[found], ends[found]
    if block.links:
        spans = np.array(block.links, np.int64)
        begin, end = np.concatenate([begin, spans[:, 0]]), np.concatenate([end, spans[:, 1]])
    spam = np.concatenate([[0], np.cumsum(_added(chars, begin, end))])
    return (spam[block.at[1:] - 1] - spam[block.at[:-1]]) / np.maximum(block.sizes, 1)


def corpus_statistics(texts: DataFrame, keep=lambda x: x) -> DataFrame:
    """k, v, n for all texts (column text): of a pair its information in bits, of a word its usual density; n texts have it.

    One pass takes the texts apart; its rows are counted with map-side partial sums, so frequent words cost one row per task.
    The usual density of a word is the USUAL quantile over the texts that have it, shrunk to RARE_DENSITY where these are few.
    """
    n = texts.count()
    counts = keep(texts.select("text").mapInArrow(_counts, COUNTS).groupBy("k", "a", "b", "step").agg(F.count("*").alias("n")))
    own = counts.where("step IS NOT NULL").groupBy("k").agg(F.sum("n").alias("n"), F.percentile("step", F.lit(USUAL), F.col("n")).alias("step"))
    own = keep(own)
    pairs = counts.where("step IS NULL").select("k", "a", "b", F.col("n"))
    first, second = own.select(F.col("k").alias("a"), F.col("n").alias("df_a")), own.select(F.col("k").alias("b"), F.col("n").alias("df_b"))
    raw = F.log2(F.col("n").cast("double") * n / F.col("df_a") / F.col("df_b"))
    # high information of rare pairs is discounted (as by Pantel and Lin, with 5 for 1): it may be chance
    rarer = F.least("df_a", "df_b")
    discounted = F.when(raw > 0, raw * F.col("n") / (F.col("n") + 5) * rarer / (rarer + 5)).otherwise(raw)
    bits = pairs.join(first, "a").join(second, "b").groupBy("k").agg(F.max(discounted).cast("float").alias("v"), F.max("n").alias("n"))
    step = (F.col("step") + 1) / STEPS
    shrunk = (F.col("n") * step + RARE_WEIGHT * float(np.log2(RARE_DENSITY))) / (F.col("n") + RARE_WEIGHT)
    usual = own.select("k", F.pow(F.lit(2.0), F.least(step, shrunk)).cast("float").alias("v"), "n")
    return bits.unionByName(usual)


def _least_held(statistics: DataFrame, held: int) -> int:
    """The least n for which at most `held` statistics are as frequent."""
    total, least = 0, None
    steps = statistics.groupBy(F.floor(F.log2("n") * 4).alias("step")).agg(F.count("*").alias("rows"), F.min("n").alias("n")).orderBy(F.col("step").desc()).collect()  # bounded: quarter octaves of a count
    for row in steps:
        total += row["rows"]
        if total > held:
            break
        least = row["n"]
    return least if least is not None else steps[0]["n"] + 1 if steps else 1


def spam_shares(docs: DataFrame, key: str, text: str, keep, held: int = HELD) -> DataFrame:
    """<key>, share: the spam share of each document; copies share one evaluation.

    keep: writes a frame and reads it again (distinct texts are numbered by it, so they must stay the same).
    Null texts are left out, empty ones have share 0; repeated rows each get theirs; an empty table has none. Shuffled are the
    distinct texts, once, and counts. Each task holds the most frequent statistics, at most `held` of them; rarer ones, if
    there are more, are joined to the texts that have them, so no key of that join is in many texts.
    """
    x = docs.where(F.col(text).isNotNull()).select(F.col(key).alias(key), F.unhex(F.sha2(F.col(text), 256)).alias("_sha"), F.col(text).alias("_text"))
    texts = keep(x.select("_sha", "_text").dropDuplicates(["_sha"]).select(F.monotonically_increasing_id().alias("h"), F.col("_text").alias("text"), "_sha"))
    statistics = keep(corpus_statistics(texts, keep))
    total = statistics.count()
    least = 0 if total <= held else _least_held(statistics, held)
    own = statistics.where(F.col("n") >= least).select("k", "v").toArrow()
    keys, values = own.column(0).to_numpy(), own.column(1).to_numpy()
    order = np.argsort(keys)
    shared = docs.sparkSession.sparkContext.broadcast((keys[order], values[order]))

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, block in blocks(batch.column(1).to_pylist()):
                pairs, where = block.pairs()
                asked, of = np.concatenate([block.ids, pairs]), np.concatenate([block.of, block.of[where]])
                once, _ = _once(asked, of)
                rare = once[~looked_up(*shared.value, asked[once])[1]]
                h = batch.column(0).to_numpy()[begin + of[rare]]
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(asked[rare])], names=["h", "k"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_of, more = batch.column(1).to_pylist(), batch.column(2) if batch.num_columns > 2 else None
            out = []
            for begin, block in blocks(texts_of):
                pairs, where = block.pairs()
                bits, _ = looked_up(*shared.value, pairs)
                usual, _ = looked_up(*shared.value, block.ids)
                if more is not None:
                    rest = [(i, v) for i, v in enumerate(more[begin : begin + len(block.sizes)].to_pylist()) if v]
                    mixed = {(i, e["k"]): e["v"] for i, v in rest for e in v}
                    for ids, of, into in ((pairs, block.of[where], bits), (block.ids, block.of, usual)):
                        for i in np.flatnonzero(~looked_up(*shared.value, ids)[1]):
                            into[i] = mixed[int(of[i]), int(ids[i])]
                out.append(spam_shares_of(block, bits, where, usual))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())], names=["h", "share"])

    asked = texts.select("h", "text")
    if least:
        rare = asked.mapInArrow(missing, "h bigint, k bigint").join(statistics.where(F.col("n") < least).select("k", "v"), "k")
        asked = asked.join(rare.groupBy("h").agg(F.collect_list(F.struct("k", "v")).alias("kv")), "h", "left")
    shares = asked.mapInArrow(scored, "h bigint, share double").join(texts.select("h", "_sha"), "h").select("_sha", "share")
    return x.select(key, "_sha").join(shares, "_sha").select(key, "share")
