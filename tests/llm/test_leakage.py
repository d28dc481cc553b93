from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from sheetloom.llm.leakage import Passages, leaked, words


def longest_run(a, b):
    best = 0
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            best = max(best, n)
    return best


few = st.lists(st.sampled_from(["a", "b", "c", "d"]), min_size=1, max_size=40)


@settings(max_examples=300, deadline=None)
@given(few, few)
def test_longest_tile_is_the_longest_common_run(doc, passage):
    p = Passages([(1, " ".join(passage))], 6, 5)
    found = {k: (n, longest, covered) for k, n, longest, _, covered in p.found_in(" ".join(doc))}
    want = longest_run(doc, passage)
    need = min(6, len(passage))
    if want >= need:
        assert found[1][1] == want and found[1][2] <= len(passage)
    else:
        assert not found


def test_words():
    assert words("Bend-space (No. 12_b) É!") == ["bend", "space", "no", "12", "b", "é"]
    assert words(None) == [] and words("") == []


P1 = " ".join(f"w{i}" for i in range(30))


def test_operator(spark):
    docs = [
        (1, f"before {P1.upper()} after"), (2, " ".join(f"w{i}" for i in range(11))), (3, "w0, w1; w2\nw3 w4 w5-w6 w7 w8 w9 w10 (w11)"), (4, "tiny passage here"), (5, None), (6, ""), (7, "q " * 50_000 + P1),
        (8, " ".join([f"w{i}" for i in range(20, 30)] + ["x"] + [f"w{i}" for i in range(10)] + ["y"] + [f"w{i}" for i in range(10, 20)])), (1, P1),
    ]
    d = spark.createDataFrame([(*r, 0) for r in docs], "doc_id bigint, text string, item_id int")
    e = spark.createDataFrame([(10, P1), (11, "tiny PASSAGE"), (12, None), (13, ""), (14, "no such thing as this at all in any of the documents there")], "item_id bigint, passage string")
    for held in (10_000, 1):  # held by all tasks, and joined by seeds
        got = sorted((r["item_id"], r["doc_id"]) for r in leaked(d, e, held=held).where("longest >= least(12, n_words)").collect())
        assert got == [(10, 1), (10, 1), (10, 3), (10, 7), (11, 4)]
    reordered = leaked(d, e).where("doc_id = 8").first()
    assert reordered["longest"] == 10 and reordered["n_tiles"] == 3 and reordered["covered"] == 30
    assert leaked(d.limit(0), e).count() == 0 and leaked(d, e.limit(0)).count() == 0


def test_all_passages_of_a_repeated_item_key_count(spark):
    d = spark.createDataFrame([(1, f"x {P1} y"), (2, "one two three four"), (None, P1), (3, "\u0130stanbul one two")], "doc_id bigint, text string")
    e = spark.createDataFrame([(10, "one two three"), (10, P1), (10, P1), (11, "\u0130STANBUL ONE")], "item_id bigint, passage string")
    for held in (10_000, 1):
        got = sorted(((r["item_id"], r["doc_id"], r["n_words"]) for r in leaked(d, e, held=held).where("longest = n_words").collect()), key=repr)
        assert got == sorted([(10, 1, 30), (10, 2, 3), (10, None, 30), (11, 3, 3)], key=repr)
