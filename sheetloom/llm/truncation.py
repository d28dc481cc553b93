"""Texts that lost their end: cut at a field's size limit or in mid-transfer.

Per source and measure (code points, UTF-8 bytes) the discrete hazard of each length, that is the share of
texts ending unfinished there among those that reach it, is tested against the hazards of neighbouring lengths, with
the false discovery rate controlled within each source. Endings are judged by bracket and quote balance for
structured text and by punctuation, recurring closing lines and list items for prose. Plainly incomplete
endings are flagged; endings that may be either are flagged where the length is a significant one. Endings that look
whole only because something was closed after the loss (a full stop after half a word, quotes and brackets after half a
sentence) are flagged in sources that have significantly more of them than the other sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAILER = r"(?s)\n-- ?\n[^\n]*+\s*+$"
BLANKS = " \t\n\r\f"
CLOSERS = BLANKS + ".!?;)]}|>\"”`"
MARKER = r"(?<!\s)\s*+\[[A-Za-z][A-Za-z ]++\]\s*+$"
#: Words of a marker that tells of a loss.
ANNOUNCED = r"(?i)\[[a-z ]*\b(?:continued|limit|truncated|cut|clipped|abridged|incomplete|omitted|more|exceeded)\b[a-z ]*\]\s*$"
ELLIPSIS = r"(?:\u2026|\.\.\.)$"
ITEM = r"^\s*(?:[-*•]|\d+[.)])\s.*[\p{L}\p{N}]$"
STRINGS = r"(?s)\"[^\"\\]*+(?:\\.[^\"\\]*+)*+\""
LAST_STRING = STRINGS + "$"
INTRODUCTION = r"(?s)^\s*+(?:[^\n{\[]*+\n)?\s*+(?:```\w*+\s*+)?"
STRUCTURED = INTRODUCTION + r"[{\[]"
WORD = r"(?<![\p{L}\p{N}'-])([\p{L}\p{N}'-]++)"
LAST_WORD = r"(?<![\p{L}\p{N}'-])[\p{L}\p{N}'-]++$"
#: What is taken for the share of whole texts with a suspicious ending before any are seen, and its weight in texts.
PRIOR_SHARE, PRIOR_TEXTS = 0.02, 50


def body_of(text: Column) -> Column:
    """The text without what a forwarding system put after it, and without white space at its end."""
    return F.rtrim(F.regexp_replace(F.regexp_replace(text, TRAILER, ""), MARKER, ""), F.lit(BLANKS))


def length_counts(df: DataFrame) -> DataFrame:
    """source, measure, length, n, n_open for texts of df (source, n_chars, n_bytes, is_open; without it all are open);
    pre-aggregated per task."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(c).alias("length")) for m, c in (("chars", "n_chars"), ("bytes", "n_bytes"))]))
    df = df if "is_open" in df.columns else df.withColumn("is_open", F.lit(True))
    return df.select("source", "is_open", each.alias("m")).groupBy("source", "m.measure", "m.length").agg(F.count("*").alias("n"), F.count_if("is_open").alias("n_open"))


def significant_lengths(counts: DataFrame, reach: int = 100, gap: int = 12, alpha: float = 0.001) -> DataFrame:
    """Lengths whose hazard exceeds that of their neighbours (between gap and reach away): source, measure,
    length, n, at_risk, expected, log_p. counts: source, measure, length, n (texts that end there), n_open (of these, the
    unfinished ones, whose hazard is tested; a column n_open that is missing counts as n).

    The tail of the count given the neighbours' hazard is bounded by Chernoff's k ln(k/m) - k + m, a safe
    side bound on the Poisson tail; Benjamini-Hochberg within each source and measure. The windows run over
    counts per length, so a source holding most texts still has no more rows than it has lengths.
    """
    n_open = F.col("n_open") if "n_open" in counts.columns else F.col("n")
    by = Window.partitionBy("source", "measure").orderBy("length")
    x = counts.withColumn("at_risk", F.sum("n").over(by.rowsBetween(0, Window.unboundedFollowing))).withColumn("n", n_open)
    low, high = by.rangeBetween(-reach, -gap), by.rangeBetween(gap, reach)
    near = F.coalesce(F.sum("n").over(low), F.lit(0)) + F.coalesce(F.sum("n").over(high), F.lit(0))
    # each end of a text among the neighbours counts, as does half an end, so that empty neighbourhoods keep a hazard
    hazard = (near + 0.5) / (F.lit(2.0 * (reach - gap + 1)) * F.greatest(F.col("at_risk"), F.lit(1)))
    x = x.withColumn("expected", hazard * F.col("at_risk")).where("n > 0")
    k, m = F.col("n").cast("double"), F.col("expected")
    x = x.withColumn("log_p", F.when(k > m, -(k * F.ln(k / m) - k + m)).otherwise(0.0))
    return discovered(x, ["source", "measure"], ["length"], alpha).select("source", "measure", "length", "n", "at_risk", "expected", "log_p")


def discovered(tests: DataFrame, family: list[str], ties: list[str], alpha: float) -> DataFrame:
    """The rows of tests (log_p) that Benjamini and Hochberg's procedure accepts within each family."""
    ranked, whole = Window.partitionBy(*family).orderBy("log_p", *ties), Window.partitionBy(*family)
    x = tests.withColumns({"_rank": F.row_number().over(ranked), "_tests": F.count("*").over(whole)})
    passed = F.max(F.when(F.col("log_p") <= F.ln(F.lit(alpha) * F.col("_rank") / F.col("_tests")), F.col("_rank"))).over(whole)
    return x.withColumn("_passed", passed).where("_rank <= _passed").drop("_rank", "_tests", "_passed")


def limits_of(x: DataFrame, keep=lambda x: x) -> DataFrame:
    """source, measure, length of significant lengths of x (source, n_chars, n_bytes, is_open). A source's measure with the
    smallest tail is taken first; of the other only texts that the first doesn't explain are tested."""
    first = keep(significant_lengths(length_counts(x)))
    leading = first.groupBy("source").agg(F.min(F.struct("log_p", "measure"))["measure"].alias("_lead"))
    first = first.join(leading.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")) & (F.col("measure") == F.col("_lead"))).select("source", "measure", "length")
    first = keep(first)
    rest = left_over(x, first)
    other = significant_lengths(length_counts(rest))
    done = first.select(F.col("source").alias("_s"), F.col("measure").alias("_m")).distinct()
    other = other.join(done, other["source"].eqNullSafe(done["_s"]) & (other["measure"] == done["_m"]), "left_anti").select("source", "measure", "length")
    return keep(first.unionByName(other))


def at_limits(x: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds at_limit: whether a text has a significant length of its source."""
    for measure, col in (("chars", "n_chars"), ("bytes", "n_bytes")):
        own = limits.where(F.col("measure") == measure).select(F.col("source").alias("_s"), F.col("length").alias("_l"), F.lit(True).alias(f"_at_{measure}"))
        x = x.join(own, x["source"].eqNullSafe(own["_s"]) & (x[col] == own["_l"]), "left").drop("_s", "_l")
    at = F.coalesce(F.col("_at_chars") | F.col("_at_bytes"), F.col("_at_chars"), F.col("_at_bytes"), F.lit(False))
    return x.withColumn("at_limit", at).drop("_at_chars", "_at_bytes")


def left_over(x: DataFrame, limits: DataFrame) -> DataFrame:
    return at_limits(x, limits).withColumn("is_open", F.col("is_open") & ~F.col("at_limit")).drop("at_limit")


def judge_endings(df: DataFrame) -> DataFrame:
    """Adds structured, ending ('whole', 'lost', 'open' or 'announced'), last_line, last_word, is_bullet, and for endings
    that something may have closed: closed_word (the word before all closing marks) and bare_string (the last string of a
    structured text is a sentence without an end mark) to df (text, body)."""
    body = F.col("body")
    # inline() of one element keeps the optimizer from copying what was found into every later use
    inside = F.regexp_replace(F.regexp_replace(body, INTRODUCTION, ""), STRINGS, "")
    last_line = F.substring_index(body, "\n", -1)  # a pattern that ends in $ would be tried from every place of a long text
    structured = body.rlike(STRUCTURED)
    string = F.regexp_extract(F.rtrim(body, F.lit(BLANKS + "]}`")), LAST_STRING, 0)
    first = F.struct(structured.alias("structured"), F.when(structured, inside).alias("_inside"), F.when(structured, string).alias("_string"), last_line.alias("last_line"), F.right(body, F.lit(3)).alias("_end"))
    x = df.select("*", F.inline(F.array(first)))
    end, inside, structured = F.col("_end"), F.col("_inside"), F.col("structured")
    depth = F.length(F.translate(inside, "}]", "")) - F.length(F.translate(inside, "{[", ""))
    fenced = (F.regexp_count(body, F.lit("```")) % 2) == 1
    bullet = F.col("last_line").rlike(r"^\s*(?:[-*•]|\d+[.)])\s")
    marked = end.rlike(r"[.!?;)\]}|>\"”`]$")
    prose = F.when(F.regexp_replace("text", TRAILER, "").rlike(ANNOUNCED), "announced").when(marked & ~end.rlike(ELLIPSIS), "whole").when(bullet & end.rlike(r"[\p{L}\p{N}]$"), "open").otherwise("lost")
    ending = F.when(structured, F.when((depth > 0) | inside.contains('"') | fenced, "lost").otherwise("whole")).otherwise(prose)
    closed = F.when(structured, F.col("_string").rlike(r"[\p{L}\p{N}]\"$")).otherwise(marked)
    last = F.when(structured, F.rtrim("_string", F.lit('"'))).otherwise(F.rtrim("last_line", F.lit(CLOSERS)))
    second = F.struct(ending.alias("ending"), closed.alias("_closed"), bullet.alias("is_bullet"), F.lower(F.regexp_extract("last_line", LAST_WORD, 0)).alias("last_word"), F.lower(F.regexp_extract(last, LAST_WORD, 0)).alias("_word"))
    x = x.select("*", F.inline(F.array(second)))
    maybe = (F.col("ending") == "whole") & F.col("_closed")
    return x.withColumns({
        "closed_word": F.when(maybe & F.col("_word").rlike(r"^\p{L}{2,}$"), F.col("_word")),
        "bare_string": F.coalesce(maybe & F.col("structured") & F.col("_string").rlike(r"\S\s+\S+\s+\S+\s+\S"), F.lit(False)),
    }).drop("_inside", "_string", "_end", "_closed", "_word")


def _shape(line: Column) -> Column:
    return F.regexp_replace(F.trim(line), r"\d+", "9")


def word_places(x: DataFrame, keep=lambda x: x) -> DataFrame:
    """word, n (texts that have it before their last word), n_end (texts where it ends a sentence), place: 2 where it ends
    list items, 1 where it stands only in these, 0 elsewhere; of texts x (body, structured, is_bullet). Counted with
    map-side partial sums of each text's different words, so a word that all texts have costs one row per task."""
    every = F.regexp_extract_all(F.lower("body"), F.lit(WORD + r"(?:[.!?;](?=[\s\"”)]))?"), 0)
    every = F.transform(F.slice(every, 1, F.greatest(F.size(every) - 1, F.lit(0))), lambda w: F.concat(F.lit("0"), w))
    lines = F.split("body", "\n")
    inner = F.when(F.col("is_bullet"), F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0)))).otherwise(lines)
    items = F.transform(F.filter(inner, lambda s: s.rlike(ITEM)), lambda s: F.split(F.lower(s), r"[^\p{L}\p{N}'-]+"))
    ends = F.transform(items, lambda w: F.concat(F.lit("2"), F.element_at(w, -1)))
    within = F.transform(F.flatten(F.transform(items, lambda w: F.slice(w, 1, F.size(w) - 1))), lambda w: F.concat(F.lit("1"), w))
    listed = F.when(~F.col("structured") & F.col("body").rlike(r"(?m)^\s*(?:[-*•]|\d+[.)])\s"), F.concat(ends, within)).otherwise(F.array().cast("array<string>"))
    seen = keep(x.select(F.explode(F.array_distinct(F.concat(every, listed))).alias("w")).groupBy("w").agg(F.count("*").alias("n")))
    place, word = F.substring("w", 1, 1).cast("int"), F.rtrim(F.expr("substr(w, 2)"), F.lit(".!?;"))
    each = seen.select(word.alias("word"), place.alias("p"), F.col("w").rlike("[.!?;]$").alias("ends"), "n").where("word <> ''")
    return each.groupBy("word").agg(F.sum(F.when(F.col("p") == 0, F.col("n")).otherwise(0)).alias("n"), F.sum(F.when((F.col("p") == 0) & F.col("ends"), F.col("n")).otherwise(0)).alias("n_end"), F.max("p").alias("place"))


def closed_losses(judged: DataFrame, words: DataFrame, often: int = 30, alpha: float = 0.001) -> DataFrame:
    """Adds is_closed to judged: something closed the text after a loss.

    Suspicious is a last word that no text has elsewhere but that begins words which texts have ('appro', 'labora'), one
    that at least `often` texts have but none at a sentence's end ('the'), and a last string that is a sentence without an
    end mark. A source closes losses if its share of them exceeds the share in all other sources (Chernoff's bound on the
    Poisson tail, Benjamini-Hochberg over sources and kinds); only then are its suspicious endings losses.
    """
    kinds = ("bare_string", "cut_string", "cut_word", "midway")
    asked = judged.where("closed_word IS NOT NULL").select(F.col("closed_word").alias("word")).distinct()
    known = asked.join(words.select("word", "n", "n_end"), "word", "left").fillna(0, ["n", "n_end"])
    longer = words.where((F.col("n") > 0) & F.col("word").rlike(r"^\p{L}{2,}$"))
    begun = longer.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", F.lit(1), i))).alias("word"))
    begun = begun.groupBy("word").agg(F.count("*").alias("n_longer"))
    odd = known.join(begun, "word", "left").select(F.col("word").alias("_word"), ((F.col("n") == 0) & F.col("n_longer").isNotNull()).alias("cut"), ((F.col("n") >= often) & (F.col("n_end") == 0)).alias("midway"))
    x = judged.join(odd, judged["closed_word"] == odd["_word"], "left").drop("_word")
    cut, midway, bare = F.coalesce("cut", F.lit(False)), F.coalesce("midway", F.lit(False)), F.col("bare_string")
    kind = F.when(F.col("structured"), F.when(bare, "bare_string").when(cut, "cut_string")).otherwise(F.when(cut, "cut_word").when(midway, "midway"))
    x = x.withColumn("kind", F.when(F.col("ending") == "whole", kind)).drop("cut", "midway")
    by = x.where("ending = 'whole'").groupBy("source", "structured").agg(F.count("*").alias("n"), *[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("k")) for k in kinds]))
    by = by.select("source", "structured", "n", each.alias("t")).select("source", "structured", "n", "t.*")
    everywhere = Window.partitionBy("structured", "kind")
    rate = (F.sum("k").over(everywhere) - F.col("k") + PRIOR_SHARE * PRIOR_TEXTS) / (F.sum("n").over(everywhere) - F.col("n") + PRIOR_TEXTS)
    k, m = F.col("k").cast("double"), F.col("n") * F.col("rate")
    tests = by.withColumn("rate", rate).where("k > 0").withColumn("log_p", F.when(k > m, -(k * F.ln(k / m) - k + m)).otherwise(0.0)).withColumn("family", F.lit(0))
    closing = discovered(tests, ["family"], ["kind", "source"], alpha).select(F.col("source").alias("_s"), F.col("kind").alias("_k"))
    x = x.join(closing, x["source"].eqNullSafe(closing["_s"]) & (x["kind"] == closing["_k"]), "left")
    return x.withColumn("is_closed", F.col("_k").isNotNull()).drop("_s", "_k", "kind")


def truncated(df: DataFrame, key: str, source: str, text: str, least_share: float = 0.002, least_lines: int = 3, keep=lambda x: x) -> DataFrame:
    """Texts that lost their end: key, source, cause ('field_limit' or 'transfer'), n_chars, n_bytes.

    A closing line without end punctuation that recurs (digits aside) in at least least_share of all different texts and
    least_lines of them is a way to end (copies of one text count once), as is a list item whose last word ends other
    items or stands in prose. Null, empty and blank texts are no cases. A null source is a source of its own. Repeated
    rows are judged alike. An empty table gives none. keep: called with the judged texts (without their bodies), the words'
    counts and the limits, to write each once.
    """
    base = df.where(F.col(text).rlike(r"\S")).select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("text"))
    x = base.withColumn("body", body_of(F.col("text")))
    core = F.regexp_replace("body", ELLIPSIS, "")
    x = judge_endings(x).withColumns({"n_chars": F.length(core), "n_bytes": F.octet_length(core)})
    judged = keep(x.select("key", "source", "ending", "structured", "closed_word", "bare_string", "n_chars", "n_bytes", "last_word", _shape(F.col("last_line")).alias("shape"), F.xxhash64("body").alias("body_id")))
    words = keep(word_places(x, keep))

    x = closed_losses(judged, words).withColumn("is_open", (F.col("ending") != "whole") | F.col("is_closed"))
    x = keep(x.select("key", "source", "ending", "structured", "is_closed", "is_open", "n_chars", "n_bytes", "last_word", "shape"))
    x = at_limits(x, limits_of(x, keep))

    # copies of a cut text can't vouch for its last line
    shapes = judged.where("NOT structured AND ending = 'lost'").select(F.col("shape").alias("_shape"), "body_id").distinct().groupBy("_shape").agg(F.count("*").alias("n_shape"))
    closers = shapes.where(F.col("n_shape") >= max(least_lines, least_share * judged.select("body_id").distinct().count())).select("_shape", F.lit(True).alias("closes"))
    seen = words.where("place IS NOT NULL").select(F.col("word").alias("_word"), "place")
    x = x.join(closers, (x["shape"] == closers["_shape"]) & (x["ending"] == "lost") & ~x["structured"], "left")
    x = x.join(seen, (x["last_word"] == seen["_word"]) & (x["ending"] == "open"), "left")
    # a word that list items have, but never at their end, or that no text has, isn't where an item ends
    unlikely = F.coalesce(F.col("place"), F.lit(1)) == 1
    lost = (
        F.when(F.col("is_closed"), True)
        .when(F.col("structured"), F.col("ending") == "lost")
        .when(F.col("ending") == "lost", F.col("closes").isNull())
        .when(F.col("ending") == "open", unlikely | F.col("at_limit"))
        .otherwise(F.col("ending") == "announced")
    )
    return x.where(lost).select("key", "source", F.when(F.col("at_limit"), "field_limit").otherwise("transfer").alias("cause"), "n_chars", "n_bytes")
