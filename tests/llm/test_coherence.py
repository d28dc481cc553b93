from __future__ import annotations

import random

import numpy as np

from sheetloom.llm import words
from sheetloom.llm.coherence import Block, blocks, spam_shares
from sheetloom.tables import materialise

NOUNS = [f"{a}{b}" for a in ("pump", "valve", "duct", "panel", "conduit", "soffit", "grille", "sleeve", "boiler", "dimmer") for b in ("", "set", "box", "head")]
MODS = "cheap best buy online sale free quote top rated near discount quality".split()


def prose(rng):
    a, b = rng.sample(NOUNS, 2)
    return rng.choice([f"The contractor shall install the {a} above the accessible ceiling before the {b} is covered.", f"Refer to the riser diagram for the {a} located near the {b} in the lobby.", f"Each {a} shall carry a permanent tag that lists the source of the {b}."])


def corpus():
    rng = random.Random(7)
    good = [" ".join(prose(rng) for _ in range(rng.randint(3, 12))) for _ in range(400)]
    tags = [" | ".join(f"{rng.choice(MODS)} {rng.choice(NOUNS)}" for _ in range(60)) for _ in range(15)]
    links = [" ".join(f"https://shop{rng.randint(1, 9)}.example/{rng.choice(NOUNS)}" for _ in range(20)) for _ in range(10)]
    stuffed = [" ".join(f"Looking for {n}? Our {n} is the best {n} for every {n} need. Why {n}? Because {n} means more {n}." for _ in range(6)) for n in ("pumpset", "grille", "wainscot")]
    other = " | ".join(f"{rng.choice(MODS)} {rng.choice(NOUNS)}" for _ in range(60))
    few_links = [g + " See https://specs.example/pump for more." for g in good[:20]]
    half = [good[0] + "\n" + other * 2, good[1] * 6 + "\nKeywords: " + ", ".join(NOUNS[:6])]
    return good + few_links + [half[1]], tags + links + stuffed + [half[0]]


def test_spam_is_found(spark):
    clean, spam = corpus()
    rows = [(i, t) for i, t in enumerate(clean)] + [(1000 + i, t) for i, t in enumerate(spam)]
    rows += [(5000, spam[0]), (5001, clean[0]), (6000, None), (6001, ""), (6002, "word"), (5000, spam[0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, h int")
    got = {}
    for r in spam_shares(df, "doc_id", "text", materialise).collect():
        got.setdefault(r["doc_id"], []).append(r["share"])
    assert 6000 not in got and got[6001] == [0.0] and got[6002] == [0.0]
    assert got[5000] == [got[1000][0]] * 2  # copies and repeated rows get the same
    flagged = {k for k, v in got.items() if v[0] > 0.5}
    want = {1000 + i for i in range(len(spam))} | {5000}
    assert flagged == want, (sorted(flagged - want), sorted(want - flagged))


def test_words_skip_links_and_codes():
    block = Block(["", "See [duct work](https://a.example/x1) A56 and www.b.test/pump now", "DUCT \u00c9TAGE duct"])
    assert [*(block.starts - block.at[1])][:5] == [0, 5, 10, 42, 62] and len(block.links) == 2 and [*block.of] == [1] * 5 + [2] * 3
    assert block.ids[1] == block.ids[5] == block.ids[7] and len({*block.ids}) == 6


def test_blocks_are_the_same_whatever_their_size(monkeypatch):
    texts = [*corpus()[0][:50], "", "x", "\U0001f600 pump"]
    whole = Block(texts)
    monkeypatch.setattr(words, "BLOCK", 200)
    parts = [*blocks(texts)]
    assert len(parts) > 10 and [*np.concatenate([b.ids for _, b in parts])] == [*whole.ids] and [*np.concatenate([b.of + n for n, b in parts])] == [*whole.of]


def test_rare_statistics_are_joined_where_too_many_to_hold(spark):
    clean, spam = corpus()
    rows = [*enumerate(clean + spam)] + [(9000, "pump " * 50_000), (9001, "long " + "x" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {tuple(r) for r in spam_shares(df, "doc_id", "text", materialise).collect()}
    for held in (1, 300):
        assert {tuple(r) for r in spam_shares(df, "doc_id", "text", materialise, held=held).collect()} == want


def test_empty(spark):
    assert spam_shares(spark.createDataFrame([], "doc_id bigint, text string"), "doc_id", "text", materialise).count() == 0
