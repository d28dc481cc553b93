from __future__ import annotations

from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetloom.llm.packing import first_fit_decreasing, pack


def plain_first_fit(sizes, capacity, separator):
    rooms, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        need = sizes[i] + separator
        for b, room in enumerate(rooms):
            if room >= need:
                break
        else:
            rooms.append(capacity + separator)
            b = len(rooms) - 1
        rooms[b] -= need
        out[i] = b
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80), st.integers(0, 3))
def test_tournament_tree_is_first_fit(sizes, separator):
    assert first_fit_decreasing(sizes, 50, separator) == plain_first_fit(sizes, 50, separator)


def test_operator(spark):
    texts = ["word " * n for n in (1, 3, 900, 40, 40, 40, 200, 64, 65)] + [None, "", "x" * 5000]
    docs = spark.createDataFrame([(i if i != 3 else 4, t, 0) for i, t in enumerate(texts)], "doc_id bigint, text string, capacity_tokens int")
    specs = spark.createDataFrame([(1, 64, 0), (2, 128, 2)], "spec_id int, capacity_tokens int, separator_tokens int")
    rows = pack(docs, specs, group_items=4).collect()
    sizes = defaultdict(list)
    for r in rows:
        sizes[r["spec_id"], r["group_no"], r["container_no"]].append(r["n_tokens"])
    for (spec, *_), held in sizes.items():
        capacity, separator = {1: (64, 0), 2: (128, 2)}[spec]
        assert sum(held) + separator * (len(held) - 1) <= capacity
    whole = defaultdict(list)
    for r in rows:
        whole[r["spec_id"], r["doc_id"]].append((r["first_token"], r["n_tokens"]))
    assert {d for _, d in whole} == {0, 1, 2, 4, 5, 6, 7, 8, 11}
    for (spec, doc), parts in whole.items():
        if doc != 4:  # two rows have that id
            at = 0
            for first, n in sorted(parts):
                assert first == at
                at += n
            assert len(parts) == 1 or at > {1: 64, 2: 128}[spec]
    assert pack(docs.limit(0), specs).count() == 0


def test_hot_key_is_spread(spark):
    docs = spark.createDataFrame([(1, "same text here")], "doc_id bigint, text string").crossJoin(spark.range(400)).drop("id")
    specs = spark.createDataFrame([(1, 64, 0)], "spec_id int, capacity_tokens int, separator_tokens int")
    groups = pack(docs, specs, group_items=50).groupBy("group_no").agg(F.count("*").alias("n")).collect()
    assert len(groups) == 8 and max(r["n"] for r in groups) < 120
