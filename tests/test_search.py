from __future__ import annotations

import numpy as np
import pytest

from sheetloom.plans import search

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, queries, k):
    out = set()
    unit = {i: np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) for i, v in rows if v and any(v)}
    for q in queries:
        near = sorted((-round(float(unit[q] @ v), 5) + 0.0, i) for i, v in unit.items() if i != q and len(v) == len(unit[q]))[:k]
        out |= {(q, i, -s + 0.0) for s, i in near}
    return out


@pytest.mark.parametrize("block", [3, 20_000])
def test_nearest_by_brute_force(spark, block):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6)]) for i in range(1, 200)]  # few values: many ties
    rows = [(i, v if any(v) else [1.0] * 6) for i, v in rows] + [(1000, None), (1001, [0.0] * 6), (1002, [1.0] * 3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {tuple(r) for r in search.nearest(df, df.where("vec_id % 20 = 0"), 7, block).collect()}
    assert got == brute(rows, range(20, 200, 20), 7)


def test_every_twentieth_is_a_query_and_the_first_may_be_missing(spark, tmp_path):
    spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 101)], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = search.search_nearest(spark, str(tmp_path)).collect()
    assert {r["query_id"] for r in rows} == {20, 40, 60, 80, 100} and len(rows) == 250 and all(r["score"] is not None for r in rows)


def test_no_vectors(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert search.nearest(df, df).count() == 0
    rows = spark.createDataFrame([(i, [float(i % 20), 0.0]) for i in range(1, 61)], SCHEMA)
    assert search.nearest(rows, rows.where("vec_id % 20 = 0")).count() == 0


def test_exact_percentiles(spark):
    import numpy as np

    from sheetloom.plans.metrics import exact_percentiles

    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(size=3000), "b": np.array([1.0] * 500 + [2.0]), "c": np.array([7.0]), "d": rng.integers(0, 5, 999).astype(float)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("e", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["n"], r["p10"], r["p50"], r["p99"]) for r in exact_percentiles(df, "g", "v", (0.1, 0.5, 0.99), steps=20).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        assert got[k][0] == len(vs) and np.allclose(got[k][1:], np.quantile(vs, (0.1, 0.5, 0.99)))
    assert exact_percentiles(df.limit(0), "g", "v", (0.5,)).count() == 0
