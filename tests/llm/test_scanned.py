from __future__ import annotations

import random

import numpy as np
import pytest

from sheetloom.llm.scanned import LineModel, corrections, defects, features, paragraphs, pattern
from sheetloom.tables import materialise

SCHEMA = "rec_src string, rec_id bigint, doc_id bigint, page int, text string, has_pages boolean, label string"
NOUNS = "transformer receptacle generator luminaire switchboard contractor commissioning enclosure specification installation".split()


def sentences(rng, n):
    out = []
    for _ in range(n):
        a, b = rng.sample(NOUNS, 2)
        out.append(f"The heavy-duty {a} serving the laboratory shall be coordinated with the {b} before final inspection of the building.")
    return " ".join(out)


def wrapped(text, width, rng):
    """Lines of at most width characters, long words divided at some line ends; the numbers of those lines."""
    lines, line, broken = [], "", []
    for word in text.split(" "):
        if len(line) + 1 + len(word) <= width:
            line = f"{line} {word}".strip()
            continue
        room = width - len(line) - 2
        if "-" not in word and len(word) > 8 and 3 <= room <= len(word) - 3 and rng.random() < 0.8:
            lines.append(f"{line} {word[:room]}-")
            broken.append(len(lines))
            line = word[room:]
        else:
            lines.append(line)
            line = word
    return [*lines, line], broken


@pytest.fixture(scope="module")
def made():
    rng = random.Random(5)
    rows, want = [], set()
    for doc in range(60):
        for page in range(1, 4):
            rec = doc * 10 + page
            lines, broken = wrapped(sentences(rng, 6), 50, rng)
            wrong = rng.randrange(len(lines))
            for good, bad in (("laboratory", "1aboratory"), ("before", "bef0re"), ("serving", "servlng")):
                if f" {good} " in f" {lines[wrong]} ":
                    lines[wrong] = lines[wrong].replace(good, bad)
                    want.add(("ocr_text", rec, wrong + 2, "misread"))
                    break
            text = [f"MERIDIAN HALL - PROJECT MANUAL {doc % 4}", *lines, f"- {doc + page} -"]
            want |= {("ocr_text", rec, 1, "furniture"), ("ocr_text", rec, len(text), "furniture")} | {("ocr_text", rec, n + 1, "broken_word") for n in broken}
            rows.append(("ocr_text", rec, doc, page, "\n".join(text), True, "x"))
        rows.append(("raw_text", 5000 + doc, doc, None, f"1.{doc % 9} SHOP DRAWING\n" + sentences(rng, 3) + "\n" + sentences(rng, 2), True, "x"))
    rows += [("raw_text", 1, 900, None, None, True, "x"), ("raw_text", 2, 901, None, "", True, "x"), ("titleblock_text", 3, 902, None, "PROJECT: ALDER\nSHEET: E1.01", False, "x")]
    return rows, want


def test_defects(spark, made):
    rows, want = made
    got = {tuple(r) for r in defects(spark.createDataFrame(rows, SCHEMA), materialise).collect()}
    for kind in ("furniture", "broken_word", "misread"):
        g, w = {x for x in got if x[3] == kind}, {x for x in want if x[3] == kind}
        assert len(g & w) >= 0.97 * len(w), (kind, sorted(w - g)[:5])
        assert len(g & w) >= 0.97 * len(g), (kind, sorted(g - w)[:5])


def test_word_divided_over_a_page_end(spark, made):
    rows, _ = made
    extra = [("ocr_text", 9001, 800, 1, "Refer to the transfor-", True, "x"), ("ocr_text", 9002, 800, 2, "mer serving the laboratory.", True, "x"), ("ocr_text", 9003, 800, 3, "A heavy-\nduty transformer.", True, "x")]
    got = {tuple(r) for r in defects(spark.createDataFrame(rows + extra, SCHEMA), materialise).where("rec_id > 9000").collect()}
    assert got == {("ocr_text", 9001, 1, "broken_word")}
    text = {r["rec_id"]: r["paragraph"] for r in paragraphs(spark.createDataFrame(rows + extra, SCHEMA), materialise).where("rec_id > 9000").collect()}
    assert text[9001] == "Refer to the transformer" and text[9002] == "serving the laboratory."


def test_empty(spark):
    assert defects(spark.createDataFrame([], SCHEMA), materialise).count() == 0


def test_pattern_ignores_numbers_and_confusions():
    assert pattern("Page 12") == pattern("page 3") and pattern("PR0JECT MANUAL") == pattern("PROJECT MANUAL")


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(2)
    model = LineModel().fit([features("HEAD\nsome text goes on\nand on\n\n12", None, 5) for _ in range(3)])
    x = features("HEAD\nsome text\n\nmore text\n7", None, 5)
    got = model.label(x)

    def score(labels):
        total = model.start[labels[0]] + sum(model.move[a, b] for a, b in zip(labels, labels[1:]))
        for row, y in zip(x, labels):
            total += 0 if (row[0] < 0) and y == 3 else -1e9 if (row[0] < 0) != (y == 3) or (row[0] in (1, 2, 4) and y) else sum(e[y, v] for e, v in zip(model.emit, row))
        return total

    best = max((tuple(np.unravel_index(i, (4,) * len(x))) for i in range(4 ** len(x))), key=score)
    assert abs(score(best) - score(tuple(got))) < 1e-9
    assert rng is not None


def test_misread_words_that_look_like_codes(spark):
    texts = [f"DRAWING TITLE: FLOOR PLAN\nas built, prior to the final test of item {i}, one whole field" for i in range(30)]
    texts += ["DRAWING TITLE: FLO0R PLAN", "TIT1E: LARGE", "seal it pri0r to the test", "a whi1e field", "the whole fie1d", "0ne field", "see A5 and sheet E1 at 20A/1P"]
    rows = [("titleblock_text", i, i, None, t, False, "x") for i, t in enumerate([*texts, *[f"and DRAWING TITLE: while prior {i}" for i in range(12)]])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in defects(df, materialise).collect()} == {("titleblock_text", i, 1, "misread") for i in range(30, 36)}
    text = {r["rec_id"]: r["paragraph"] for r in paragraphs(df, materialise).where("rec_id BETWEEN 30 AND 36").collect()}
    assert text == {30: "DRAWING TITLE: FLOOR PLAN", 31: "TITLE: LARGE", 32: "seal it prior to the test", 33: "a while field", 34: "the whole field", 35: "one field", 36: "see A5 and sheet E1 at 20A/1P"}


def test_copies_of_a_page_do_not_hide_its_misread_words(spark):
    rows = [("titleblock_text", i, i, None, f"test item {i} before use", False, "x") for i in range(30)]
    rows += [("titleblock_text", 100 + i, i, None, "test it bef0re use", False, "x") for i in range(15)] + [("titleblock_text", 100, 0, None, "test it bef0re use", False, "x")] * 9
    got = {tuple(r) for r in defects(spark.createDataFrame(rows, SCHEMA), materialise).collect()}
    assert got == {("titleblock_text", 100 + i, 1, "misread") for i in range(15)}


def test_paragraphs_over_running_lines_and_divided_misread_words(spark, made):
    rows, _ = made
    text = "The transformer serving the\n\n- 12 -\n\nlaboratory shall be coordinated.\n\nThe generator has a trans-\nf0rmer before it."
    df = spark.createDataFrame([*rows, ("raw_text", 9100, 9100, None, text, True, "x")], SCHEMA)
    got = [r["paragraph"] for r in paragraphs(df, materialise).where("rec_id = 9100").orderBy("par_no").collect()]
    assert got == ["The transformer serving the laboratory shall be coordinated.", "The generator has a transformer before it."]


def test_long_running_headers_and_headers_of_unwrapped_texts(spark, made):
    """A header of more than 120 characters, and headers in texts whose lines aren't wrapped."""
    rng, rows = random.Random(8), [*made[0]]
    head = "MERIDIAN HALL PROJECT MANUAL " * 5 + "VOLUME"
    for doc in range(12):
        pages = ["\n".join([head, *wrapped(sentences(rng, 4), 50, rng)[0], f"- {page} -"]) for page in range(1, 4)]
        rows += [("ocr_text", 20_000 + doc * 10 + n, 20_000 + doc, n, t, True, "x") for n, t in enumerate(pages)]
        rows.append(("raw_text", 30_000 + doc, 30_000 + doc, None, "\n\n".join(f"ALDER HALL - SECTION 09\n{sentences(rng, 3)}" for _ in range(5)), True, "x"))
    got = {tuple(r) for r in defects(spark.createDataFrame(rows, SCHEMA), materialise).where("defect = 'furniture'").collect()}
    assert {("ocr_text", 20_000 + doc * 10 + n, 1, "furniture") for doc in range(12) for n in range(3)} <= got
    assert {("raw_text", 30_000 + doc, n, "furniture") for doc in range(12) for n in (1, 4, 7, 10, 13)} == {x for x in got if x[0] == "raw_text" and x[1] >= 30_000}


def test_corrections_of_long_and_short_words(spark):
    long = "electro" + "magnetohydrodynamic" * 4
    known = spark.createDataFrame([(long, 9), ("tool", 400), ("word", 10), ("pool", 30)], "word string, n bigint")
    words = spark.createDataFrame([(long.replace("o", "0").replace("l", "1", 1), 1), ("t00l", 1), ("w0rcl", 1), ("p00l", 1), ("x", 1), ("12", 5)], "word string, n bigint")
    got = {r["word"]: (r["meant"], r["first_at"], r["last_at"]) for r in corrections(words, known).collect()}
    wrong = long.replace("o", "0").replace("l", "1", 1)
    differ = [i for i, (a, b) in enumerate(zip(wrong, long)) if a != b]
    assert got == {wrong: (long, differ[0], differ[-1]), "t00l": ("tool", 1, 2)}


def test_rare_forms_are_joined_where_too_many_to_hold(spark, made):
    df = spark.createDataFrame(made[0], SCHEMA)
    for find in (defects, paragraphs):
        want = {tuple(r) for r in find(df, materialise).collect()}
        assert {tuple(r) for r in find(df, materialise, held=20).collect()} == want and want


def test_paragraphs_end_at_headings_and_short_lines(spark, made):
    text = "The transformer serving the laboratory shall be coordinated\nwith the generator.\nThe contractor shall coordinate the enclosure of the panel\nbefore final inspection.\n1.5 SHOP DRAWINGS\nSubmit drawings of the enclosure."
    df = spark.createDataFrame([*made[0], ("raw_text", 9200, 9200, None, text, True, "x")], SCHEMA)
    got = [r["paragraph"] for r in paragraphs(df, materialise).where("rec_id = 9200").orderBy("par_no").collect()]
    assert got == ["The transformer serving the laboratory shall be coordinated with the generator.", "The contractor shall coordinate the enclosure of the panel before final inspection.", "1.5 SHOP DRAWINGS", "Submit drawings of the enclosure."]
