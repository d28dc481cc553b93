"""Text of scanned pages repaired into continuous paragraphs.

Lines are labelled as body, header, footer or break by a hidden Markov model over layout features (shape, length,
repetition of a line's pattern in its document and in the corpus, place on the page). Words that the line end divided
and misrecognised words are then found by corpus counts of whole words, and paragraphs are put together again.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATES = ("body", "header", "footer", "break")
#: Records that the line model is fitted on.
SAMPLE_RECORDS = 3000

PAGE_NUMBER = re.compile(r"^(?:[-–—~]\s*)?(?:(?:page|sheet|pg\.?|p\.)\s*)?(?:[\dlio]{1,4}|[ivxlc]{1,7})(?:\s*(?:of|/)\s*[\dlio]{1,4})?(?:\s*[-–—~])?$", re.I)
HEADING = re.compile(r"^\d+(?:\.\d+)+\s+\S")
# Words that no line of a running header ends in.
LINKING = frozenset("a an the of to and or in on at by for with from as is was be been that".split())
TITLE = re.compile(r"^(?:[A-Z0-9][\w.&/'-]*(?:\s+|$)|[-|]\s+|(?:of|for|and|the|without)\s+)+$")
#: What a scanner makes of letters (left) and the letters meant.
CONFUSIONS = [
    ("c", "e"), ("à", "a"), ("á", "a"), ("é", "e"), ("l", "i"), ("+", "t"), ("0", "o"), ("5", "s"), ("1", "l"), ("1", "i"), ("ri", "n"), ("cl", "d"),
    ("ii", "u"), ("rn", "m"), ("b", "h"), ("q", "g"), ("6", "b"), ("6", "g"), ("m", "in"), ("m", "rn"), ("m", "n"), ("vv", "w"), ("f", "e"), ("0", "d"), ("7", "t"),
    ("d", "cl"), ("8", "b"), ("|", "l"), ("|", "i"), ("$", "s"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl"),
]
LIGATURES = "[ﬀ-ﬆ]"
#: Forms of words that every task may hold; tokens of rarer forms, if there are more, are joined.
HELD = 300_000
#: Letters of a word up to which every pair of confusions is tried; longer words are compared by what confusions leave alike.
TRIED = 40
_WORD, _DIGITS = re.compile(r"[^\W\d_][\w+'-]*"), re.compile(r"\d+")
# Fixed value: the form of sheet codes, tags and ratings, which a misread word in capitals may share.
CODE = re.compile(r"[A-Z]{1,3}-?\d[\d.]*[A-Z]?|\d+[A-Z]{0,2}")


_MASKED, _CONFUSED = re.compile(r"\b[a-z]{1,3}-?\d[\d.]*[a-z]?\b|\d+(?=[^a-z]|$)"), str.maketrans("0156à+q7", "olsbatgt")


def pattern(line: str) -> str:
    """What lines of one running header share: codes and numbers masked, letters that scanners confuse made alike."""
    return " ".join(_MASKED.sub("#", line.lower()).translate(_CONFUSED).split()).replace("rn", "m")


def pattern_id(line: str) -> int:
    return xxhash.xxh3_64_intdigest(pattern(line)) >> 1


def page_records(df: DataFrame) -> DataFrame:
    """df must have rec_src, rec_id, doc_id, page, text, has_pages (false: no headers are sought)."""
    return df.where(F.col("text").isNotNull()).select("rec_src", "rec_id", "doc_id", "page", "has_pages", "text")


def _signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signs = [[pattern_id(line) if line.strip() else None for line in text.split("\n")] for text in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(signs, pa.list_(pa.int64()))], names=["rec_src", "rec_id", "doc_id", "page", "signs"])


def pattern_counts(records: DataFrame, keep=lambda x: x) -> DataFrame:
    """rec_src, rec_id, counts (array of line_no, in_doc: pages, or lines of an undivided text, of its document with that
    pattern, n_docs: documents with it). A page that was read twice counts once.

    Patterns of a thousandth of all documents or more are few (at most a thousand times the lines of a mean document), so
    their counts are sent to all tasks; all others are joined, none of them having many rows.
    """
    signs = keep(records.where("has_pages").select("rec_src", "rec_id", "doc_id", "page", "text").mapInArrow(_signs, "rec_src string, rec_id bigint, doc_id bigint, page int, signs array<bigint>"))
    lines = signs.select("rec_src", "rec_id", "doc_id", "page", F.posexplode("signs").alias("line_no", "p")).where("p IS NOT NULL")
    per_page = lines.groupBy("p", "rec_src", "doc_id", "page").agg(F.count("*").alias("n"))
    per_doc = keep(per_page.groupBy("p", "rec_src", "doc_id").agg(F.sum(F.when(F.col("page").isNull(), F.col("n")).otherwise(1)).cast("int").alias("in_doc")))
    corpus = keep(per_doc.groupBy("p").agg(F.countDistinct("doc_id").cast("int").alias("n_docs")).where("n_docs > 1"))
    frequent = max(3, signs.select("doc_id").distinct().count() // 1000)
    common = per_doc.join(F.broadcast(corpus.where(F.col("n_docs") >= frequent)), "p")
    rest = per_doc.join(F.broadcast(corpus.where(F.col("n_docs") >= frequent).select("p")), "p", "left_anti").join(corpus.where(F.col("n_docs") < frequent), "p", "left").fillna(1, ["n_docs"])
    both = common.unionByName(rest.select(*common.columns)).where("in_doc > 1 OR n_docs > 2")
    x = lines.join(both, ["p", "rec_src", "doc_id"])
    return x.groupBy("rec_src", "rec_id").agg(F.collect_list(F.struct((F.col("line_no") + 1).alias("line_no"), "in_doc", "n_docs")).alias("counts"))


def features(text: str, counts: list[dict] | None, n_all: int) -> np.ndarray:
    """One row of small numbers per line; -1 in the first marks a break. counts: line_no, in_doc and n_docs of its lines' patterns."""
    lines = text.split("\n")
    known = {c["line_no"]: c for c in counts or ()}
    filled = [i for i, s in enumerate(lines) if s.strip()]
    lengths = sorted(len(lines[i].rstrip()) for i in filled)
    wide = lengths[int(0.8 * (len(lengths) - 1))] if lengths else 1
    out = np.zeros((len(lines), 8), np.int64)
    for k, i in enumerate(filled):
        raw = lines[i]
        s = raw.strip()
        c = known.get(i + 1)
        share = (c["n_docs"] / max(1, n_all)) if c else 0.0
        number = bool(PAGE_NUMBER.match(s))
        before, after = (lines[filled[k - 1]].strip() if k else ""), (lines[filled[k + 1]].strip() if k + 1 < len(filled) else "")
        words = _WORD.findall(s)
        small = sum([w[0].islower() for w in words])
        row = ("|" in s or "—" in s) and len(_DIGITS.findall(s)) > 1
        shape = 0 if number else 1 if HEADING.match(s) else 2 if row else 3 if TITLE.match(s) else 4 if s[0].islower() or s.rsplit(" ", 1)[-1] in LINKING else 5 if len(words) >= 4 and small >= 0.5 * len(words) else 6
        end = 0 if s[-1] in ".;:" else 1 if s[-1] in "-," else 2 if s[-1].isdigit() else 3
        size = min(3, int(4 * len(s) / max(1, wide)))
        inner = min(3, c["in_doc"] if c else 1)
        spread = 0 if share == 0 else min(5, max(1, int(np.log2(share * 4096 + 1) / 2) + 1))
        edge = 0 if k == 0 else 1 if k == len(filled) - 1 else 2 if raw.startswith("\f") or k + 1 < len(filled) and lines[filled[k + 1]].startswith("\f") else 3
        cut = 3 if size == 3 and s[-1].islower() and after[:1].islower() and shape >= 5 else 1 if before and before[-1].islower() and after[:1].islower() else 2 if before[-1:] == "-" else 0
        gap = int(i > 0 and not lines[i - 1].strip()) + 2 * int(i + 1 < len(lines) and not lines[i + 1].strip())
        out[i] = (shape, end, size, inner, spread, edge, cut, gap + 4 * int(wide > 130))
    for i in range(len(lines)):
        if not lines[i].strip():
            out[i, 0] = -1
    return out


LEVELS = (7, 4, 4, 4, 6, 4, 4, 8)


class LineModel:
    """Hidden Markov model whose emissions are independent categorical features."""

    def __init__(self) -> None:
        self.emit = [np.zeros((len(STATES), n)) for n in LEVELS]
        self.move = np.zeros((len(STATES), len(STATES)))
        self.start = np.zeros(len(STATES))

    def fit(self, records: list[np.ndarray], rounds: int = 5) -> LineModel:
        """Viterbi training. It starts from weak labels (lines that repeat or number pages); what is plainly body stays so."""
        labels = [self.weak(x) for x in records]
        sure = [self.plain_body(x) for x in records]
        for _ in range(rounds):
            self.count(records, labels)
            labels = [np.where(body, 0, y) for y, body in zip(self.label_all(records), sure)]
        self.count(records, labels)
        return self

    @staticmethod
    def plain_body(x: np.ndarray) -> np.ndarray:
        """Headings, table rows, lines that begin or end in mid-sentence, prose that nothing repeats, and lines of wide unwrapped
        texts that don't recur in them."""
        return (x[:, 0] >= 0) & (np.isin(x[:, 0], (1, 2, 4)) | (x[:, 0] == 5) & (x[:, 3] <= 1) | (x[:, 7] >= 4) & (x[:, 3] < 3))

    @classmethod
    def weak(cls, x: np.ndarray) -> np.ndarray:
        running = (x[:, 0] == 0) | (x[:, 3] >= 2) & (x[:, 4] >= 1) & (np.isin(x[:, 0], (3, 6)) | (x[:, 4] >= 3))
        running &= ~cls.plain_body(x)
        out = np.where(running, np.where((x[:, 0] == 0) | (x[:, 5] == 1), 2, 1), 0)
        out[x[:, 0] < 0] = 3
        return out

    def count(self, records: list[np.ndarray], labels: list[np.ndarray]) -> None:
        for e in self.emit:
            e[:] = 0.5
        self.move[:] = 0.5
        self.start[:] = 0.5
        for x, y in zip(records, labels):
            if len(y):
                self.start[y[0]] += 1
                np.add.at(self.move, (y[:-1], y[1:]), 1)
                on = x[:, 0] >= 0
                for f, e in enumerate(self.emit):
                    np.add.at(e, (y[on], x[on, f]), 1)
        self.emit = [np.log(e / e.sum(1, keepdims=True)) for e in self.emit]
        self.move = np.log(self.move / self.move.sum(1, keepdims=True))
        self.start = np.log(self.start / self.start.sum())

    def label(self, x: np.ndarray) -> np.ndarray:
        return self.label_all([x])[0]

    def label_all(self, records: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each record's lines (Viterbi); records go step by step together, the longest first."""
        order = sorted(range(len(records)), key=lambda i: -len(records[i]))
        out: list = [np.zeros(0, np.int64)] * len(records)
        for begin in range(0, len(order), 256):
            own = [i for i in order[begin : begin + 256] if len(records[i])]
            if not own:
                continue
            lengths = np.array([len(records[i]) for i in own])
            x, offset = np.concatenate([records[i] for i in own]), np.concatenate([[0], np.cumsum(lengths)[:-1]])
            on = x[:, 0] >= 0
            score = np.zeros((len(x), len(STATES)))
            for f, e in enumerate(self.emit):
                score += e[:, x[:, f]].T
            score[~on] = 0
            score[on, 3] = score[~on, :3] = -1e9
            # headings, table rows, mid-sentence, lines of unwrapped texts that don't recur
            never = on & (np.isin(x[:, 0], (1, 2, 4)) | (x[:, 7] >= 4) & (x[:, 3] < 3))
            score[never, 1:] = -1e9
            best, back = self.start + score[offset], np.zeros((lengths[0], len(own), len(STATES)), np.int8)
            for i in range(1, lengths[0]):
                active = int(np.searchsorted(-lengths, -i))  # those with more than i lines
                reach = best[:active, :, None] + self.move
                back[i, :active] = reach.argmax(1)
                best[:active] = reach.max(1) + score[offset[:active] + i]
            for n, i in enumerate(own):
                labels = np.zeros(lengths[n], np.int64)
                labels[-1] = best[n].argmax()
                for at in range(lengths[n] - 1, 0, -1):
                    labels[at - 1] = back[at, n, labels[at]]
                out[i] = labels
        return out


LEADING, TRAILING, HYPHENS = "([\"'“”", ".,;:)]?!\"'“”", "-‐\u00ad"
_BLANK, _LETTER, _LIGATURE = re.compile(r"[\f\r\t]"), re.compile(r"[^\W\d_]"), re.compile(LIGATURES)
_PIECE = re.compile(r"[^\W\d_]|\d+")


def bare(token: str) -> str:
    """A token without the punctuation around it."""
    return token.lstrip(LEADING).rstrip(TRAILING)


def tokens_of(line: str) -> list[str]:
    """Pieces between blanks, tabs and page feeds."""
    if "\f" in line or "\t" in line or "\r" in line:
        line = _BLANK.sub(" ", line)
    return [t for t in line.split(" ") if t]


def ends_divided(token: str) -> bool:
    """A letter and a hyphen end the token."""
    return len(token) > 1 and token[-1] in HYPHENS and token[0] not in HYPHENS and _LETTER.match(token[-2]) is not None


def _letters(form: str) -> bool:
    return not form.endswith("-") and _LETTER.search(form) is not None


class Body:
    """The body lines with words of one labelled text: line numbers, tokens, and whether each ends in a divided word."""

    def __init__(self, text: str, labels: list[int]) -> None:
        found = [(n, tokens_of(s)) for n, (s, y) in enumerate(zip(text.split("\n"), labels), 1) if y == 0]
        self.lines = [(n, t) for n, t in found if t]
        self.divided = [ends_divided(t[-1]) for _, t in self.lines]


FOUND = (
    "kind string, rec_src string, rec_id bigint, doc_id bigint, page int, text string, labels array<tinyint>, form string, n_inner bigint, n_any bigint, "
    "line_no int, left_part string, next_rec bigint, next_line int, next_first string"
)
_FOUND = pa.schema(
    [("kind", pa.string()), ("rec_src", pa.string()), ("rec_id", pa.int64()), ("doc_id", pa.int64()), ("page", pa.int32()), ("text", pa.string()), ("labels", pa.list_(pa.int8())), ("form", pa.string()),
     ("n_inner", pa.int64()), ("n_any", pa.int64()), ("line_no", pa.int32()), ("left_part", pa.string()), ("next_rec", pa.int64()), ("next_line", pa.int32()), ("next_first", pa.string())]
)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in _FOUND], schema=_FOUND)


def label_texts(records: DataFrame, keep, sample: int = SAMPLE_RECORDS) -> DataFrame:
    """What one pass over all texts tells, by kind: 'text' (rec_src, rec_id, doc_id, page, text, labels of its lines), 'form' (form of a
    word, n_inner times whole inside lines of different texts, n_any times at all; partial counts), 'piece' (a divided word's left_part
    and what reads on: next_rec, next_line, next_first) and 'top' (a page's first body line: line_no, next_first).

    The model is fitted on at most `sample` records (those of smallest hash), which come to the driver; all are labelled.
    """
    once = records.groupBy(F.xxhash64("text").alias("_h")).agg(F.min(F.struct("rec_src", "rec_id")).alias("r")).select("r.*", F.lit(True).alias("once"))
    counted = keep(records.join(pattern_counts(records, keep), ["rec_src", "rec_id"], "left").join(once, ["rec_src", "rec_id"], "left"))
    n_all = max(1, counted.where("has_pages").select("doc_id").distinct().count())
    chosen = counted.where("has_pages").select(F.xxhash64("rec_src", "rec_id").alias("o"), "text", "counts").orderBy("o").limit(sample).collect()
    model = LineModel().fit([features(r["text"], [c.asDict() for c in r["counts"] or ()], n_all) for r in chosen])
    numbers = (model.emit, model.move, model.start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LineModel()
        own.emit, own.move, own.start = numbers
        seen: set[tuple] = set()  # a record that is delivered twice counts once
        for batch in batches:
            source = batch.to_pydict()
            texts = source["text"]
            paged = [i for i, p in enumerate(source["has_pages"]) if p]
            labels: list = [[0 if s.strip() else 3 for s in t.split("\n")] if not p else None for t, p in zip(texts, source["has_pages"])]
            for i, y in zip(paged, own.label_all([features(texts[i], source["counts"][i], n_all) for i in paged])):
                labels[i] = y.tolist()
            inner, every, rows = Counter(), Counter(), []
            for src, rec, doc, page, text, y, first in zip(source["rec_src"], source["rec_id"], source["doc_id"], source["page"], texts, labels, source["once"]):
                body = Body(text, y)
                before = True
                whole: list[str] = []
                for (n, tokens), divided in zip(body.lines, body.divided):
                    every.update(tokens)
                    whole += tokens[int(before) : len(tokens) - int(divided)] if len(tokens) > 1 or not (before or divided) else []
                    before = divided
                if first and (src, rec) not in seen:
                    seen.add((src, rec))
                    inner.update(whole)
                place = {"rec_src": src, "rec_id": rec, "doc_id": doc, "page": page}
                for k, ((n, tokens), divided) in enumerate(zip(body.lines, body.divided)):
                    if divided:
                        after = {"next_rec": rec, "next_line": body.lines[k + 1][0], "next_first": bare(body.lines[k + 1][1][0])} if k + 1 < len(body.lines) else {}
                        rows.append(place | {"kind": "piece", "line_no": n, "left_part": bare(tokens[-1]).rstrip(HYPHENS)} | after)
                if page is not None and body.lines:
                    rows.append(place | {"kind": "top", "line_no": body.lines[0][0], "next_first": bare(body.lines[0][1][0])})
            n_inner, n_any = Counter(), Counter()
            for counts, into in ((inner, n_inner), (every, n_any)):
                for token, n in counts.items():
                    into[bare(token)] += n
            n_any.pop("", None)
            rows += [{"kind": "form", "form": w, "n_inner": n_inner[w], "n_any": n} for w, n in n_any.items()]
            if rows:
                yield _rows(rows)
            fixed = {"kind": pa.array(["text"] * len(texts), pa.string()), "labels": pa.array(labels, pa.list_(pa.int8()))} | {c: batch.column(c) for c in ("rec_src", "rec_id", "doc_id", "page", "text")}
            yield pa.RecordBatch.from_arrays([fixed.get(f.name, pa.nulls(len(texts), f.type)) for f in _FOUND], schema=_FOUND)

    return counted.select("rec_src", "rec_id", "doc_id", "page", "has_pages", "text", "counts", "once").mapInArrow(run, FOUND)


def divided_words(found: DataFrame) -> DataFrame:
    """rec_src, rec_id, line_no, next_rec, next_line, left_part, right_part: divided words, read on over page ends."""
    pieces = found.where("kind = 'piece'").select("rec_src", "rec_id", "doc_id", "page", "line_no", "left_part", "next_rec", "next_line", "next_first")
    tops = found.where("kind = 'top'").groupBy("rec_src", "doc_id", "page").agg(F.min(F.struct("rec_id", "line_no", F.col("next_first").alias("first"))).alias("top"))
    turn = Window.partitionBy("rec_src", "doc_id").orderBy("page")
    tops = tops.select("rec_src", "doc_id", "page", F.lead("top").over(turn).alias("top"))
    last = pieces.where("next_rec IS NULL").drop("next_rec", "next_line", "next_first").join(tops, ["rec_src", "doc_id", "page"])
    last = last.select("rec_src", "rec_id", "line_no", F.col("top.rec_id").alias("next_rec"), F.col("top.line_no").alias("next_line"), "left_part", F.col("top.first").alias("right_part"))
    inside = pieces.where("next_rec IS NOT NULL").select("rec_src", "rec_id", "line_no", "next_rec", "next_line", "left_part", F.col("next_first").alias("right_part"))
    return inside.unionByName(last).where(F.col("right_part").rlike(r"^\p{L}|^[0-9+]"))


def _classes() -> dict[int, str]:
    """Each letter of a single-letter confusion to the first of all letters that confusions link it with."""
    of: dict[str, str] = {}
    for seen, meant in CONFUSIONS:
        if len(seen) == len(meant) == 1:
            a, b = of.setdefault(seen, seen), of.setdefault(meant, meant)
            of = {k: min(a, b) if v in (a, b) else v for k, v in of.items()}
    return {ord(k): v for k, v in of.items()}


_ALIKE = _classes()


def alike(word: str) -> str:
    """What words have in common that confusions turn into each other (for long words, in linear time)."""
    for seen, meant in CONFUSIONS:
        if len(seen) > 1 or len(meant) > 1 and seen not in "md":
            word = word.replace(seen, meant)
    return word.translate(_ALIKE)


def _edits(word: str) -> Iterator[tuple[str, int, int, int]]:
    """What a word may have been: candidate, first and last place of a misread character, number of confusions."""
    ones = [(word[:i] + meant + word[i + len(seen) :], i, len(meant)) for seen, meant in CONFUSIONS for i in range(len(word)) if word.startswith(seen, i)]
    for made, i, _ in ones:
        yield made, i, i, 1
    for made, i, n in ones:
        for seen, meant in CONFUSIONS:
            at = made.find(seen, i + n)
            while at >= 0:
                yield made[:at] + meant + made[at + len(seen) :], i, min(at + len(word) - len(made), len(word) - 1), 2
                at = made.find(seen, at + 1)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {"word": [], "n_seen": [], "meant": [], "first_at": [], "last_at": [], "n_edits": []}
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if len(word) > TRIED:
                for k, v in zip(rows, (word, n, "\0" + alike(word), None, None, 1)):
                    rows[k].append(v)
                continue
            seen = set()
            for made, i, j, edits in _edits(word):
                if made not in seen and not any(c.isdigit() or c in "+|$" for c in made):
                    seen.add(made)
                    for k, v in zip(rows, (word, n, made, i, j, edits)):
                        rows[k].append(v)
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))


def _common_ends(word: Column, meant: Column) -> Column:
    """The places of the first and the last letter in which two long words differ."""
    def same(a: Column, b: Column) -> Column:
        letters = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
        return F.array_position(letters, False) - 1

    return F.struct(same(word, meant).cast("int").alias("first_at"), (F.length(word) - 1 - same(F.reverse(word), F.reverse(meant))).cast("int").alias("last_at"))


def corrections(words: DataFrame, known: DataFrame, times: float = 6.0, least: int = 3) -> DataFrame:
    """word, meant, first_at, last_at for those of words (word, n: its own count) that a confusion of letters turns
    into a word at least `least` and `times` as frequent (for two confusions in less than six letters, the square of
    times). Of several the most frequent counts. Words of more than TRIED letters may have any number of confusions."""
    usable = (F.length("word") >= 2) & F.col("word").rlike(r"\p{L}")
    x = words.where(usable).select("word", "n").mapInArrow(_candidates, "word string, n_seen bigint, meant string, first_at int, last_at int, n_edits int")
    long = known.where(F.length("word") >= TRIED - 2).select("word", "n").mapInArrow(_long_keys, "made string, meant string, n_meant bigint")
    near = x.where(~F.col("meant").startswith("\0")).join(known.select(F.col("word").alias("meant"), F.col("n").alias("n_meant")), "meant")
    far = x.where(F.col("meant").startswith("\0")).select("word", "n_seen", F.col("meant").alias("made"), "n_edits").join(long, "made").where("word <> meant")
    far = far.withColumn("_at", _common_ends(F.col("word"), F.col("meant"))).select("word", "n_seen", "meant", "_at.first_at", "_at.last_at", "n_edits", "n_meant")
    enough = F.when((F.col("n_edits") > 1) & (F.length("word") < 6), times * times).otherwise(times)
    x = near.unionByName(far).where((F.col("n_meant") >= least) & (F.col("n_meant") >= F.col("n_seen") * enough))
    best = F.max(F.struct("n_meant", F.struct("meant", "first_at", "last_at").alias("c")))["c"]
    return x.groupBy("word").agg(best.alias("c")).select("word", "c.*")


def _long_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(["\0" + alike(w) for w in batch.column(0).to_pylist()], pa.string()), batch.column(0), batch.column(1)], names=["made", "meant", "n_meant"])


def find_noise(records: DataFrame, keep, sample: int = SAMPLE_RECORDS) -> dict[str, DataFrame]:
    """The labelled texts and what is wrong with them: 'found' (as label_texts tells), 'pieces' (divided words, is_broken: a line end
    divided them) and 'wrong' (form, meant, n_any: all forms, meant being null for right ones).

    Null texts have no lines; empty lines are breaks; repeated pages are each judged, and a page's last word reads on at the first
    run of the next page. An empty table gives empty results. No document's lines are gathered in one task: texts stay whole,
    counts are pre-aggregated, windows run over one row per page of a document.
    """
    found = keep(label_texts(page_records(records), keep, sample))
    forms = keep(found.where("kind = 'form'").groupBy("form").agg(F.sum("n_inner").alias("n_inner"), F.sum("n_any").alias("n_any")))
    known = forms.where("n_inner > 0").groupBy(F.lower("form").alias("word")).agg(F.sum("n_inner").alias("n"), F.sum(F.when(F.col("form") == F.upper("form"), F.col("n_inner")).otherwise(0)).alias("n_upper"))
    known = keep(known)

    pieces = divided_words(found)
    pieces = pieces.withColumns({"whole": F.lower(F.concat("left_part", "right_part")), "compound": F.lower(F.concat_ws("-", "left_part", "right_part"))})
    pieces = pieces.join(known.select(F.col("word").alias("whole"), F.col("n").alias("n_whole")), "whole", "left").join(known.select(F.col("word").alias("compound"), F.col("n").alias("n_compound")), "compound", "left")
    pieces = keep(pieces)
    unknown = pieces.where("n_whole IS NULL AND n_compound IS NULL").select(F.explode(F.array("whole", "compound")).alias("word")).groupBy("word").agg(F.lit(0).cast("bigint").alias("n"))
    fixed = keep(corrections(unknown, known))
    for part in ("whole", "compound"):
        pieces = pieces.join(fixed.select(F.col("word").alias(part), *[F.col(c).alias(f"{part}_{c}") for c in ("meant", "first_at", "last_at")]), part, "left")
    # a hyphen belongs to the word if the compound is the better known; an unknown word is whole unless its left part begins compounds
    heads = known.where("word like '%-%'").select(F.substring_index("word", "-", 1).alias("head"), "n").groupBy("head").agg(F.sum("n").alias("n_head"))
    pieces = pieces.join(heads.withColumnRenamed("head", "_head"), F.lower(F.col("left_part")) == F.col("_head"), "left")
    n_whole, n_compound = F.coalesce("n_whole", F.lit(0)), F.coalesce("n_compound", F.lit(0))
    is_whole = F.when(n_whole + n_compound > 0, n_whole > n_compound).when(F.col("whole_meant").isNotNull() | F.col("compound_meant").isNotNull(), F.col("whole_meant").isNotNull() & F.col("compound_meant").isNull()).otherwise(F.coalesce(F.col("n_head"), F.lit(0)) < 3)
    pieces = keep(pieces.withColumn("is_broken", is_whole))

    # what has the form of a code is one unless a word that is frequent in capitals may be meant: 'FLO0R', but not 'A5'
    own = forms.where(F.col("form").rlike(r"\p{L}") & ~F.col("form").rlike("-$")).select("form", "n_any", F.lower("form").alias("word"), F.col("form").rlike(f"^(?:{CODE.pattern})$").alias("code"))
    seen = own.select("word", "code").distinct().join(known, "word", "left").where(~F.col("word").rlike("[/=@]"))
    plain = corrections(seen.where("NOT code").select("word", F.coalesce("n", F.lit(1)).alias("n")), known).select("word", F.lit(False).alias("code"), "meant")
    capitals = known.where("n_upper > 0").select("word", F.col("n_upper").alias("n"))
    coded = corrections(seen.where("code").select("word", F.greatest("n_upper", F.lit(1)).alias("n")), capitals).select("word", F.lit(True).alias("code"), "meant")
    wrong = keep(own.join(plain.unionByName(coded), ["word", "code"], "left").select("form", "meant", "n_any"))
    return {"found": found, "pieces": pieces, "wrong": wrong}


def held_corrections(wrong: DataFrame, held: int) -> tuple[dict, bool]:
    """form to meant (null for right forms) that every task may hold, at most `held` of them, and whether these are all wrong forms;
    else they are the most frequent forms, right or wrong."""
    if wrong.count() <= held:
        return {r[0]: r[1] for r in wrong.where("meant IS NOT NULL").select("form", "meant").toLocalIterator()}, True
    top = wrong.orderBy(F.col("n_any").desc(), "form").limit(held)
    return {r[0]: r[1] for r in top.select("form", "meant").collect()}, False


def misread_tokens(found: DataFrame, wrong: DataFrame, held: int = HELD) -> DataFrame:
    """rec_src, rec_id, line_no, form, meant (null for a ligature sign) of misread tokens; at_end: it is the left part of a divided word.
    Tokens whose form tasks don't hold leave the texts and are joined; they are of rare forms, so no key has many rows."""
    known, all_wrong = held_corrections(wrong, held)
    shared = found.sparkSession.sparkContext.broadcast(known)
    shape = pa.schema([("rec_src", pa.string()), ("rec_id", pa.int64()), ("line_no", pa.int32()), ("form", pa.string()), ("meant", pa.string()), ("at_end", pa.bool_()), ("asked", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = shared.value
        for batch in batches:
            rows: list[tuple] = []
            for src, rec, text, labels in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for n, tokens in (body := Body(text, labels)).lines:
                    for token in tokens:
                        form = bare(token)
                        meant = told.get(form, 0)
                        if meant:
                            rows.append((src, rec, n, form, meant, False, False))
                        elif _LIGATURE.search(form):
                            rows.append((src, rec, n, form, None, False, False))
                        elif meant == 0 and not all_wrong and _letters(form):
                            rows.append((src, rec, n, form, None, False, True))
                for (n, tokens), divided in zip(body.lines, body.divided):
                    if divided:
                        form = bare(tokens[-1]).rstrip(HYPHENS)
                        meant = told.get(form, 0)
                        if meant or meant == 0 and not all_wrong:
                            rows.append((src, rec, n, form, meant or None, True, meant == 0))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)

    out = found.where("kind = 'text'").select("rec_src", "rec_id", "text", "labels").mapInArrow(run, "rec_src string, rec_id bigint, line_no int, form string, meant string, at_end boolean, asked boolean")
    if all_wrong:
        return out.drop("asked")
    asked = out.where("asked").drop("meant", "asked").join(wrong.where("meant IS NOT NULL").select("form", "meant"), "form")
    return out.where("NOT asked").drop("asked").unionByName(asked.select("rec_src", "rec_id", "line_no", "form", "meant", "at_end"))


def misread_lines(noise: dict[str, DataFrame], keep, held: int = HELD) -> DataFrame:
    """rec_src, rec_id, line_no of lines with misread words."""
    line = ["rec_src", "rec_id", "line_no"]
    tokens, broken = keep(misread_tokens(noise["found"], noise["wrong"], held)), noise["pieces"].where("is_broken")
    # pieces of divided words are judged as the word they make; compounds that kept their hyphen by their parts
    heads_of = broken.select("rec_src", F.col("next_rec").alias("rec_id"), F.col("next_line").alias("line_no"), F.col("right_part").alias("form"))
    plain = tokens.where("NOT at_end AND meant IS NOT NULL").join(heads_of, [*line, "form"], "left_anti").select(line)
    ends = tokens.where("at_end").join(broken.select(line), line, "left_anti").select(line)
    ligatures = tokens.where("NOT at_end AND meant IS NULL").select(line)
    faulty, left = broken.where("whole_meant IS NOT NULL"), F.length("left_part")
    first = faulty.where(F.col("whole_first_at") < left).select(line)
    second = faulty.where(F.col("whole_last_at") >= left).select("rec_src", F.col("next_rec").alias("rec_id"), F.col("next_line").alias("line_no"))
    return plain.unionByName(ends).unionByName(ligatures).unionByName(first).unionByName(second).distinct()


def defects(records: DataFrame, keep, held: int = HELD) -> DataFrame:
    """rec_src, rec_id, line_no, defect ('furniture', 'broken_word' or 'misread')."""
    noise = find_noise(records, keep)
    furniture = noise["found"].where("kind = 'text'").select("rec_src", "rec_id", F.posexplode("labels").alias("line_no", "label")).where("label IN (1, 2)")
    furniture = furniture.select("rec_src", "rec_id", (F.col("line_no") + 1).alias("line_no"), F.lit("furniture").alias("defect"))
    broken = noise["pieces"].where("is_broken").select("rec_src", "rec_id", "line_no", F.lit("broken_word").alias("defect"))
    return furniture.unionByName(broken).unionByName(misread_lines(noise, keep, held).withColumn("defect", F.lit("misread")))


_SENTENCE_END, _JOINED_ON = re.compile(r"[.!?:;][\"'”)\]]*$"), re.compile(r" ([.,;:)\]?!]+)(?= |$)")


def cased(token: str, core: str, meant: str) -> str:
    """The token with its core replaced by the word meant, in the core's case."""
    if core == core.upper():
        meant = meant.upper()
    elif core[:1].isupper():
        meant = meant[:1].upper() + meant[1:]
    return token.replace(core, meant)


def paragraphs_of(text: str, labels: list[int], joins: dict, taken: set, correct) -> Iterator[tuple[int, str]]:
    """Number and text of each paragraph. joins: line number to (moved in, whole word, word meant); taken: lines whose first word moved to
    the line before; correct: form to the word meant or None.

    A paragraph ends at a blank line, but not where a header or footer stands inside a sentence; before and after a numbered
    heading; and after a line that ends a sentence well before the usual width, if a capital follows.
    """
    lines = text.split("\n")
    widths = sorted(len(s.rstrip()) for s, y in zip(lines, labels) if y == 0)
    wide = widths[int(0.8 * (len(widths) - 1))] if widths else 0
    out: list[list[str]] = [[]]
    broke = ran = False
    before = None
    for n, (line, y) in enumerate(zip(lines, labels), 1):
        if y:
            broke, ran = broke or y == 3, ran or y in (1, 2)
            continue
        s = line.strip(" ")
        if before is not None:
            goes_on = ran and not _SENTENCE_END.search(before) and s.lstrip("\f")[:1].islower()
            ended = _SENTENCE_END.search(before) and len(before) < 0.6 * wide and s.lstrip("\f")[:1].isupper()
            if broke and not goes_on or HEADING.match(s) or HEADING.match(before.strip()) and not s[:1].islower() or ended:
                out.append([])
        broke = ran = False
        before = line.rstrip()
        tokens = tokens_of(line)
        if n in taken and tokens:
            tail = tokens[0][len(tokens[0].rstrip(".,;:)]?!")) :]
            tokens = ([tail] if tail else []) + tokens[1:]
        if n in joins:
            moved, whole, meant = joins[n]
            head = tokens[-1].rstrip(HYPHENS) if tokens else ""
            word = head + moved
            core = bare(word)
            tokens = tokens[:-1] + [cased(word, core, meant) if meant and core.lower() == whole else word]
        for token in tokens:
            core = bare(token)
            meant = correct(core) if core else None
            out[-1].append(cased(token, core, meant) if meant else token)
    for number, words in enumerate(out):
        if words:
            yield number, _JOINED_ON.sub(r"\1", " ".join(words))


def paragraphs(records: DataFrame, keep, held: int = HELD) -> DataFrame:
    """rec_src, rec_id, par_no, paragraph: continuous text without running lines, divided words joined, misread words
    corrected. A remainder of a divided word on the next page moves to the page where the word began. Where paragraphs end,
    paragraphs_of tells. Pages aren't joined. Repeated rows each give theirs."""
    noise = find_noise(records, keep)
    known, all_wrong = held_corrections(noise["wrong"], held)
    shared = records.sparkSession.sparkContext.broadcast(known)
    broken = noise["pieces"].where("is_broken")
    joins = broken.select("rec_src", "rec_id", F.struct("line_no", F.col("right_part").alias("moved"), "whole", F.col("whole_meant").alias("meant")).alias("j"), F.lit(None).cast("int").alias("t"))
    taken = broken.select("rec_src", F.col("next_rec").alias("rec_id"), F.lit(None).cast(joins.schema["j"].dataType).alias("j"), F.col("next_line").alias("t"))
    moves = joins.unionByName(taken).groupBy("rec_src", "rec_id").agg(F.collect_list("j").alias("joins"), F.collect_set("t").alias("taken"))
    x = noise["found"].where("kind = 'text'").select("rec_src", "rec_id", "text", "labels").join(moves, ["rec_src", "rec_id"], "left")
    if not all_wrong:
        own = misread_tokens(noise["found"], noise["wrong"], held).where("NOT at_end AND meant IS NOT NULL").groupBy("rec_src", "rec_id").agg(F.collect_set(F.struct("form", "meant")).alias("own"))
        x = x.join(own, ["rec_src", "rec_id"], "left")
    shape = pa.schema([("rec_src", pa.string()), ("rec_id", pa.int64()), ("par_no", pa.int32()), ("paragraph", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            source = batch.to_pydict()
            for i, (src, rec, text, labels) in enumerate(zip(source["rec_src"], source["rec_id"], source["text"], source["labels"])):
                here = {j["line_no"]: (j["moved"], j["whole"], j["meant"]) for j in source["joins"][i] or ()}
                table = shared.value if all_wrong else shared.value | {o["form"]: o["meant"] for o in source["own"][i] or ()} if source["own"][i] else shared.value
                rows += [(src, rec, n, p) for n, p in paragraphs_of(text, labels, here, set(source["taken"][i] or ()), table.get)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)

    return x.mapInArrow(run, "rec_src string, rec_id bigint, par_no int, paragraph string")
