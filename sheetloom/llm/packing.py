"""Documents packed into containers of fixed token capacity by first-fit decreasing.

Documents fall into randomised groups of bounded size; each group is packed on its own with a tournament tree
over the room left in its containers, which finds the first container with enough room in logarithmic time.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_LOADED: dict = {}


def tokenizer(path: str):
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _LOADED[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def token_counts(docs: DataFrame, key: str, text: str, path: str = TOKENIZER) -> DataFrame:
    """doc key and n_tokens of each whole text; one narrow pass."""
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode_ordinary
        for batch in batches:
            sizes = [len(encode(x.as_py())) if x.is_valid else None for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32())], names=[key, "n_tokens"])

    return docs.select(key, F.col(text).cast("string").alias("_text")).mapInArrow(run, f"{key} {kind}, n_tokens int")


class Rooms:
    """Tournament tree: the room of up to n containers, each node holding the larger of its two below."""

    def __init__(self, n: int, room: int) -> None:
        self.half = 1 << max(0, (n - 1).bit_length())
        self.best = [room] * (2 * self.half)

    def first_fit(self, size: int) -> int:
        """Takes size from the first container with that much room."""
        best, at = self.best, 1
        while at < self.half:
            at *= 2
            at += best[at] < size
        slot = at - self.half
        best[at] -= size
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
        return slot


def first_fit_decreasing(sizes: list[int], capacity: int, separator: int) -> list[int]:
    """Container number of each item (none larger than capacity). A separator stands between two items."""
    rooms, out = Rooms(max(1, len(sizes)), capacity + separator), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = rooms.first_fit(sizes[i] + separator)
    return out


def pack(docs: DataFrame, specs: DataFrame, key: str = "doc_id", text: str = "text", path: str = TOKENIZER, group_items: int = 20_000, keep=lambda x: x) -> DataFrame:
    """Assignment of documents to containers: spec_id, <key>, part_no, first_token, n_tokens, group_no, container_no.

    specs: spec_id, capacity_tokens, separator_tokens; the few specifications are listed on the driver. Only a document longer than the capacity is divided: into
    full containers and a rest that is packed. Null and empty texts hold no tokens and get no container; repeated
    rows are packed each. Group of a row: hash of its key, size and number among its equals, so a key that many rows share is spread too
    and the assignment doesn't depend on how the input is split.
    """
    sized = keep(token_counts(docs, key, text, path).where("n_tokens > 0"))
    groups = max(1, -(-sized.count() // group_items))
    # a row's number among its equals salts the group: copies of one key don't gather in a group, and file splits don't matter
    equal = sized.groupBy(key, "n_tokens").agg(F.count("*").alias("_n")).select(key, "n_tokens", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"))
    salted = equal.select(key, "n_tokens", F.pmod(F.xxhash64(key, "n_tokens", "_copy"), F.lit(groups)).cast("int").alias("group_no"))
    own = specs.where("capacity_tokens > 0").select("spec_id", "capacity_tokens", F.coalesce("separator_tokens", F.lit(0)).alias("separator_tokens")).distinct().collect()
    kinds = "array<struct<spec_id:{},capacity_tokens:int,separator_tokens:int>>".format(specs.select("spec_id").schema[0].dataType.simpleString())
    each = F.array(*[F.struct(*[F.lit(v) for v in r]) for r in own]).cast(kinds)
    items = salted.select("*", F.explode(each).alias("s")).select(key, "n_tokens", "group_no", "s.*")
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(by: tuple, g: pd.DataFrame) -> pd.DataFrame:
        spec_id, group_no = by
        capacity, separator = int(g["capacity_tokens"].iloc[0]), int(g["separator_tokens"].iloc[0])
        rows, sizes, full = [], [], []
        for k, n in zip(g[key].tolist(), g["n_tokens"].tolist()):
            for part, at in enumerate(range(0, n, capacity), 1):
                size = min(capacity, n - at)
                (full if size == capacity and n > capacity else rows).append((k, part, at, size))
        sizes = [r[3] for r in rows]
        at = first_fit_decreasing(sizes, capacity, separator)
        after = max(at, default=-1) + 1
        out = pd.DataFrame(rows + full, columns=[key, "part_no", "first_token", "n_tokens"])
        return out.assign(spec_id=spec_id, group_no=group_no, container_no=[*at, *range(after, after + len(full))])[["spec_id", key, "part_no", "first_token", "n_tokens", "group_no", "container_no"]]

    spec_kind = specs.select("spec_id").schema[0].dataType.simpleString()
    return items.groupBy("spec_id", "group_no").applyInPandas(run, f"spec_id {spec_kind}, {key} {kind}, part_no int, first_token int, n_tokens int, group_no int, container_no int")
