from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from sheetloom.llm.splitting import split_oversized, split_text

text = st.text(alphabet=st.sampled_from("ab. \n#Øé漢-"), max_size=600) | st.text(max_size=200)


@settings(max_examples=300, deadline=None)
@given(text, st.integers(1, 80), st.integers(0, 100))
def test_round_trip_limit_and_overlap(t, most, overlap):
    pieces = split_text(t, most, overlap)
    assert "".join(t[a + again : b] for a, b, again in pieces) == t
    assert all(b - a <= most for a, b, _ in pieces)
    assert pieces[0][2] == 0
    if len(t) <= most:
        assert len(pieces) == 1
    wanted = min(overlap, most - 1, most // 2)
    for (a, b, _), (c, _, again) in zip(pieces, pieces[1:]):
        assert c + again == b and again >= min(wanted, b - a)


def test_natural_boundaries():
    t = "First sentence here. Second one follows.\n\nNext paragraph starts. It ends."
    pieces = [t[a:b] for a, b, _ in split_text(t, 45, 0)]
    assert pieces == ["First sentence here. Second one follows.\n\n", "Next paragraph starts. It ends."]
    words = [t[a:b] for a, b, _ in split_text("alpha beta gamma delta", 12, 0) for t in ["alpha beta gamma delta"]]
    assert words == ["alpha beta ", "gamma delta"]


def test_long_unbroken_text():
    t = "x" * 200_000
    pieces = split_text(t, 1000, 100)
    assert all(b - a <= 1000 for a, b, _ in pieces) and "".join(t[a + o : b] for a, b, o in pieces) == t


def test_operator(spark):
    rows = [(1, "n", "a b " * 30), (2, "n", "y" * 60), (3, "n", "short"), (4, "n", None), (5, "n", ""), (6, "none", "a b " * 90), (7, None, "a b " * 90), (1, "n", "a b " * 30), (8, "n", "wide Ø" * 20)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id bigint, kind string, content string, piece string")
    limits = spark.createDataFrame([("n", 50, 10), ("n", 70, 10), ("other", 1, 0)], "kind string, max_chars int, overlap_chars int")
    got = split_oversized(df, limits, "id", "kind").collect()
    kinds = {(r["key"], r["cut_kind"]) for r in got}
    assert kinds == {(1, "natural"), (2, "forced"), (8, "natural")}
    assert sum(r["piece_no"] == 1 for r in got if r["key"] == 1) == 2
    assert all(len(r["piece"]) <= 50 for r in got)
    assert split_oversized(df.limit(0), limits, "id", "kind").count() == 0
