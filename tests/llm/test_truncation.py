from __future__ import annotations

import json
import random

from sheetloom.llm.truncation import length_counts, limits_of, significant_lengths, truncated

WHOLE = [
    '{"a": [1, 2, {"b": "x ] y"}]}', '```json\n{"a": 1}\n```', 'Here is the structured content:\n{"a": {"b": []}}', '{a: 1, "b": "q",}', "{}",
    "The pump was tested.", "The pump was tested.\nEND OF SECTION", "Items:\n- rigid soffit\n- old pump", 'Said "yes".', "All good.\n--\nforwarded by mail intake, batch 7",
]
LOST = [
    '{"a": [1, 2, {"b": "x', '```json\n{"a": 1}\n', 'Here is the structured content:\n{"a": {"b": [', '{"a": 1, "b": {"c": 2}', "The pump was tes", "It was tested. The pump was\n--\nforwarded by mail intake, batch 12",
    'Text with a {"a": "b…', "The pump ... was teste…", "It was tested. [output limit reached]", '{"a": "cut here [continued]',
]


def frame(spark, texts):
    return spark.createDataFrame([(i, s, t, "x") for i, (s, t) in enumerate(texts)], "id bigint, src string, t string, key string")


def test_endings(spark):
    filler = [("s", f"Note {i} was read.\nEND OF SECTION") for i in range(6)] + [("s", f"Kept as is:\n- rigid soffit {'x' * (i + 1)}\n- an old pump\n- the soffit") for i in range(4)]
    texts = [("s", t) for t in WHOLE + LOST] + filler + [("s", None), ("s", ""), ("s", "  \n ")]
    got = {r["key"] for r in truncated(frame(spark, texts), "id", "src", "t").collect()}
    assert got == set(range(len(WHOLE), len(WHOLE) + len(LOST)))


def test_significant_length_settles_open_endings(spark):
    """A list that ends in a whole item is lost where its source cuts at just that length, else whole."""
    rng = random.Random(3)
    rows = [("a", "word " * rng.randint(20, 200) + "end.") for _ in range(300)]
    cut = lambda: ("Some list:\n- rigid soffit\n- " + "old " * 60)[:100]
    rows += [("a", cut()[:96] + "pump") for _ in range(40)] + [("b", cut()[:96] + "pump")] + [("b", "word " * rng.randint(20, 200) + "pump.") for _ in range(100)]
    rows += [("a", "- the pump\n- a pump\n- of pump")]
    got = {(r["key"], r["cause"]) for r in truncated(frame(spark, rows), "id", "src", "t").collect()}
    assert got == {(i, "field_limit") for i in range(300, 340)}


def test_hazard_peak_among_neighbours(spark):
    rng = random.Random(1)
    rows = [("a", n := rng.randint(1, 2000), n) for _ in range(3000)] + [("a", 900, 905)] * 60 + [(None, 50, 50)]
    counts = length_counts(spark.createDataFrame(rows, "source string, n_chars int, n_bytes int"))
    got = {(r["measure"], r["length"]) for r in significant_lengths(counts).collect()}
    assert got == {("chars", 900), ("bytes", 905)}


def test_one_source_holds_most_and_null_source(spark):
    rows = [(None, '{"a": "lost'), (None, "All whole.")] + [("big", json.dumps({"n": i})) for i in range(500)]
    got = truncated(frame(spark, rows), "id", "src", "t").collect()
    assert [(r["key"], r["source"]) for r in got] == [(0, None)]


def test_very_long_and_empty(spark):
    long = '{"a": "' + "x" * 300_000
    assert [r["key"] for r in truncated(frame(spark, [("s", long), ("s", long + '"}')]), "id", "src", "t").collect()] == [0]
    assert truncated(frame(spark, []), "id", "src", "t").count() == 0


def test_copies_of_a_cut_text_do_not_vouch_for_its_end(spark):
    cut = "The pump was tested.\nThe valve was in"
    rows = [("s", cut), ("s", cut + "\n--\nforwarded by mail intake, batch 7")] * 10 + [("s", f"Note {i} was read.\nEND OF SECTION") for i in range(10)]
    assert {r["key"] for r in truncated(frame(spark, rows), "id", "src", "t").collect()} == set(range(20))


SENTENCES = ["The pump was measured again.", "The labourers replaced the accepted valve.", "Every schedule was approved before inspection.", "The remaining conduit was removed.", "Refer to the drawing."]


def closing_rows(rng):
    """Rows of four sources; c closes what it lost: half words, half sentences and sentences broken off between words."""
    rows, lost = [], set()
    for i in range(400):
        source, text = "abcd"[i % 4], " ".join(rng.choice(SENTENCES) for _ in range(rng.randint(5, 40)))
        kind = i // 4 % 5
        if source == "c" and kind == 0:
            text, _ = text.rsplit(" ", 1)[0] + " appro.", lost.add(i)
        elif source == "c" and kind == 1:
            text, _ = json.dumps({"n": i, "notes": [text, "The labourers replaced the accep"]}), lost.add(i)
        elif source == "c" and kind == 2:
            text, _ = json.dumps({"notes": text + " The pump was measured again and the"}, indent=1), lost.add(i)
        elif source == "c" and kind == 3:
            text, _ = text.rsplit(". ", 1)[0] + ". Refer to the.", lost.add(i)
        elif kind > 2:
            text = json.dumps({"status": "open", "notes": [text], "by": "whole crew"})
        rows.append((source, text))
    return rows, lost


def test_losses_that_something_closed(spark):
    """A full stop or brackets after the loss hide it; a source that does so shows far more odd endings than others."""
    rows, lost = closing_rows(random.Random(5))
    rows += [("a", "A rare word is whole: zyzzyva."), ("b", json.dumps({"note": "a sentence of the label kind"})), ("a", "The other source wrote a labou.")]
    got = {r["key"] for r in truncated(frame(spark, rows), "id", "src", "t").collect()}
    assert got == lost


def test_hazards_of_one_measure_given_the_other(spark):
    """A source that cuts at 300 bytes has texts of 290 characters in plenty, but no limit there."""
    rng = random.Random(2)
    rows = [("a", "word " * rng.randint(20, 200) + "end.") for _ in range(300)]
    rows += [("a", "\u00e9" * (10 if i % 2 else i % 7) + "x" * (300 - 2 * (10 if i % 2 else i % 7))) for i in range(80)]
    x = spark.createDataFrame([("a", len(t), len(t.encode()), not t.endswith(".")) for _, t in rows], "source string, n_chars int, n_bytes int, is_open boolean")
    assert {tuple(r) for r in limits_of(x).collect()} == {("a", "bytes", 300)}


def test_long_trailers_markers_and_words(spark):
    """What follows a loss, introduces a text or ends it may be of any length."""
    trailer, intro = "\n--\nforwarded " + "by the mail intake " * 40, "Here is the content " * 30 + "\n"
    rows = [("s", "The pump was" + trailer), ("s", "It ran. The pump was   [output " + "very " * 30 + "truncated]"), ("s", intro + '{"a": {"b": ['), ("s", intro + '{"a": {"b": []}}'), ("s", "It ran" + " " * 500 + "[limit reached]"), ("s", "All good." + trailer)]
    assert {r["key"] for r in truncated(frame(spark, rows), "id", "src", "t").collect()} == {0, 1, 2, 4}
