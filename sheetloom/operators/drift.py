"""Schemas that drift between files: a catalogue of field lifespans, all changes, and one consistent table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def plain_decimal(text: Column) -> Column:
    """One spelling of a number's text, whatever its length: without plus, leading and trailing zeros; with an exponent only where it
    was told with one. Null for other texts."""
    t = F.trim(text)
    body = F.regexp_replace(t, "^[+-]", "")
    whole = F.regexp_replace(F.regexp_extract(body, r"^(\d*)", 1), "^0+", "")
    part = F.regexp_replace(F.regexp_extract(body, r"^\d*\.(\d+)$", 1), "0+$", "")
    digits = F.concat(F.coalesce(F.nullif(whole, F.lit("")), F.lit("0")), F.when(part != "", F.concat(F.lit("."), part)).otherwise(""))
    plain = F.when(digits == "0", digits).otherwise(F.concat(F.when(t.startswith("-"), "-").otherwise(""), digits))
    # a number with an exponent is that which a double reads
    told = F.when(t.rlike(r"^[+-]?\d+(\.\d+)?[eE][+-]?\d+$"), t.try_cast("double").try_cast("decimal(38,15)").cast("string"))
    return F.when(t.rlike(r"^[+-]?\d+(\.\d+)?$"), plain).otherwise(F.regexp_replace(F.regexp_replace(told, "0+$", ""), r"\.$", ""))


def exploded_fields(df: DataFrame, feed: str, file: str, file_no: str, record_key: str, payload: str) -> DataFrame:
    """One row per record and top-level field: feed, file_id, file_no, record_key, field, kind (JSON type, null
    for a JSON null) and val (comparable text). Payloads that are no JSON object have no fields."""
    entries = F.from_json(F.col(payload), "map<string,variant>")
    x = df.select(F.col(feed).alias("feed"), F.col(file).alias("file_id"), F.col(file_no).alias("file_no"), F.col(record_key).alias("record_key"), F.explode(entries).alias("field", "v"))
    told = F.schema_of_variant("v")
    kind = (
        F.when(told.startswith("ARRAY"), "array").when(told.startswith("OBJECT"), "object").when(told == "BOOLEAN", "boolean").when(told == "STRING", "string").when(told != "VOID", "number")
    )
    # inline() of one element keeps the optimizer from copying what was read into every later use
    x = x.select("feed", "file_id", "file_no", "record_key", "field", F.inline(F.array(F.struct(kind.alias("kind"), F.col("v").cast("string").alias("_text")))))
    text = F.col("_text")
    usual = text.rlike(r"^[1-9][0-9]*$") | ~text.rlike(r"^\s*[+-]?[0-9]")
    return x.select("feed", "file_id", "file_no", "record_key", "field", "kind", F.when(usual, text).otherwise(F.coalesce(plain_decimal(text), text)).alias("val"))


def lifespans(fields: DataFrame) -> DataFrame:
    """The catalogue: one row per feed, field and file with its kind there, ranked by file (file_rank) and with
    the rank before and after in which the feed has the field, and its kind before. Counts are pre-aggregated
    per file and field, so the windows see one row for each of these however many records a feed has."""
    counts = fields.groupBy("feed", "file_id", "file_no", "field", "kind").agg(F.count("*").alias("n"))
    best = F.min(F.when(F.col("kind").isNotNull(), F.struct((-F.col("n")).alias("n"), "kind")))["kind"]
    per_file = counts.groupBy("feed", "file_id", "file_no", "field").agg(best.alias("kind"))
    return per_file


def file_ranks(df: DataFrame, feed: str, file: str, file_no: str) -> DataFrame:
    """feed, file_id, file_rank (1 is the feed's first file), next_file."""
    files = df.select(F.col(feed).alias("feed"), F.col(file).alias("file_id"), F.col(file_no).alias("file_no")).distinct()
    w = Window.partitionBy("feed").orderBy("file_no", "file_id")
    return files.select("feed", "file_id", F.row_number().over(w).alias("file_rank"), F.lead("file_id").over(w).alias("next_file"))


def starts_and_ends(catalogue: DataFrame, files: DataFrame, keep=lambda x: x) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Islands of consecutive files per feed and field: (starts, ends, kept). A start is a field's first file
    after one without it, an end is logged at the file that lacks it, kept are pairs of consecutive files."""
    x = catalogue.join(files, ["feed", "file_id"])
    w = Window.partitionBy("feed", "field").orderBy("file_rank")
    x = x.withColumns({"before": F.lag("file_rank").over(w), "after": F.lead("file_rank").over(w), "kind_before": F.lag("kind").over(w)})
    x = keep(x)
    starts = x.where((F.col("file_rank") > 1) & (F.col("before").isNull() | (F.col("before") < F.col("file_rank") - 1))).select("feed", "file_id", "file_rank", "field", "kind")
    ends = x.where(F.col("next_file").isNotNull() & (F.col("after").isNull() | (F.col("after") > F.col("file_rank") + 1))).select("feed", F.col("next_file").alias("file_id"), (F.col("file_rank") + 1).alias("file_rank"), "field", "kind", F.col("file_id").alias("prev_file"))
    kept = x.where(F.col("before") == F.col("file_rank") - 1).select("feed", "file_id", "field", "kind", "kind_before")
    return starts, ends, kept


def renames(fields: DataFrame, starts: DataFrame, ends: DataFrame, least_share: float = 0.5) -> DataFrame:
    """Pairs (old_name, new_name) of a file where the new field carries the gone one's values for the same record
    keys: equal in at least least_share of the keys for which both have a value. A field is in one pair at most:
    the best by number of equal values, each from both sides; ties by name.

    Only values of fields that end or start are joined, on feed, file, record key and value.
    """
    old = fields.where("kind IS NOT NULL").join(ends.select("feed", F.col("prev_file").alias("file_id"), F.col("file_id").alias("at_file"), "field"), ["feed", "file_id", "field"])
    old = old.select("at_file", "record_key", F.col("field").alias("old_name"), "val").distinct()
    new = fields.where("kind IS NOT NULL").join(starts.select("feed", "file_id", "field"), ["feed", "file_id", "field"])
    new = new.select(F.col("file_id").alias("at_file"), "record_key", F.col("field").alias("new_name"), F.col("val").alias("new_val")).distinct()
    pairs = old.join(new, ["at_file", "record_key"]).groupBy("at_file", "old_name", "new_name").agg(F.countDistinct("record_key").alias("n_keys"), F.countDistinct(F.when(F.col("val") == F.col("new_val"), F.col("record_key"))).alias("n_equal"))
    fit = pairs.where((F.col("n_equal") > 0) & (F.col("n_equal") >= least_share * F.col("n_keys")))
    score = F.col("n_equal") / F.col("n_keys")
    by_old = Window.partitionBy("at_file", "old_name").orderBy(score.desc(), F.col("n_equal").desc(), "new_name")
    by_new = Window.partitionBy("at_file", "new_name").orderBy(score.desc(), F.col("n_equal").desc(), "old_name")
    return fit.withColumns({"_o": F.row_number().over(by_old), "_n": F.row_number().over(by_new)}).where("_o = 1 AND _n = 1").select(F.col("at_file").alias("file_id"), "old_name", "new_name", "n_keys", "n_equal")


def schema_changes(df: DataFrame, feed: str = "feed_id", file: str = "file_id", file_no: str = "file_no", record_key: str = "record_key", payload: str = "payload", keep=lambda x: x) -> DataFrame:
    """All changes of each file against the one before in its feed: file_id, change_kind ('renamed', 'removed',
    'added' or 'type_changed'), old_name, new_name, old_kind, new_kind.

    A field is in a file if any record has its key. Fields whose values are all null have no kind and no change
    of it. Repeated records count once for renames. A feed's first file has no changes; rows with a null feed or
    file are left out; an empty table has none. keep: called with the exploded fields, the
    catalogue and the renames, to write each once.
    """
    usable = df.where(F.col(feed).isNotNull() & F.col(file).isNotNull())
    fields = keep(exploded_fields(usable, feed, file, file_no, record_key, payload))
    starts, ends, kept = starts_and_ends(lifespans(fields), file_ranks(usable, feed, file, file_no), keep)
    pairs = keep(renames(fields, starts, ends))
    none = F.lit(None).cast("string")
    renamed = pairs.join(ends.select("file_id", F.col("field").alias("old_name"), F.col("kind").alias("old_kind")), ["file_id", "old_name"]).join(starts.select("file_id", F.col("field").alias("new_name"), F.col("kind").alias("new_kind")), ["file_id", "new_name"])
    shape = ["file_id", "change_kind", "old_name", "new_name", "old_kind", "new_kind"]
    renamed = renamed.withColumn("change_kind", F.lit("renamed")).select(shape)
    removed = ends.join(pairs.select("file_id", F.col("old_name").alias("field")), ["file_id", "field"], "left_anti").select("file_id", F.lit("removed").alias("change_kind"), F.col("field").alias("old_name"), F.lit("").alias("new_name"), F.col("kind").alias("old_kind"), none.alias("new_kind"))
    added = starts.join(pairs.select("file_id", F.col("new_name").alias("field")), ["file_id", "field"], "left_anti").select("file_id", F.lit("added").alias("change_kind"), F.lit("").alias("old_name"), F.col("field").alias("new_name"), none.alias("old_kind"), F.col("kind").alias("new_kind"))
    same = kept.select("file_id", F.lit("kept").alias("change_kind"), F.col("field").alias("old_name"), F.col("field").alias("new_name"), F.col("kind_before").alias("old_kind"), F.col("kind").alias("new_kind"))
    typed = same.unionByName(renamed).where("old_kind <> new_kind").withColumn("change_kind", F.lit("type_changed"))
    return renamed.unionByName(removed).unionByName(added).unionByName(typed)


def meanings(changes: DataFrame, together: list[frozenset[str]] = ()) -> tuple[dict[str, str], list[tuple[str, str, int]]]:
    """Alias table: each field name that was ever renamed, to the commonest name of its meaning (ties by name); and the renames that
    contradict it (old_name, new_name, number of files), which it leaves out.

    Renames unite names, the most frequent first, unless records (sets of names, together) fill both meanings at once: one chance
    rename can't merge two meanings that live side by side. The distinct renames are listed on the driver: they are bounded by
    the vocabulary of field names, not by records or files.
    """
    pairs = sorted(((r[0], r[1], r[2]) for r in changes.where("change_kind = 'renamed'").groupBy("old_name", "new_name").agg(F.count("*").alias("n")).collect()), key=lambda p: (-p[2], p[0], p[1]))
    above: dict[str, str] = {}

    def root(name: str) -> str:
        while above.setdefault(name, name) != name:
            name = above[name]
        return name

    uses: dict[str, int] = {}
    refused = []
    for old, new, n in pairs:
        for name in (old, new):
            uses[name] = uses.get(name, 0) + n
        a, b = root(old), root(new)
        if a != b and any(a in roots and b in roots for roots in ({root(x) for x in names} for names in together)):
            refused.append((old, new, n))
        else:
            above[a] = b
    best: dict[str, str] = {}
    for name in sorted(uses, key=lambda x: (-uses[x], x)):
        best.setdefault(root(name), name)
    return {name: best[root(name)] for name in uses}, refused


def unified(df: DataFrame, changes: DataFrame, keep: list[str], payload: str = "payload") -> DataFrame:
    """One table: the columns keep, one STRING column f_<name> per meaning, a cast to DOUBLE, n_<name>, where most of its values are
    numbers, and left_over: values (by their names) of a record that fills several aliases of one meaning, but for the
    alphabetically first. Records without a usable payload have nulls."""
    entries = F.from_json(F.col(payload), "map<string,variant>")
    x = df.select(*keep, F.map_filter(F.transform_values(entries, lambda k, v: v.cast("string")), lambda k, v: v.isNotNull()).alias("_m"))
    renamed = changes.where("change_kind = 'renamed'").select(F.explode(F.array("old_name", "new_name")).alias("n")).distinct()
    known = [r[0] for r in renamed.collect()]
    sets = x.select(F.array_sort(F.array_intersect(F.map_keys("_m"), F.array(*[F.lit(n) for n in known]).cast("array<string>"))).alias("s")).where("size(s) > 1").distinct().collect()
    alias, _ = meanings(changes, [frozenset(r[0]) for r in sets])
    names = [r[0] for r in x.select(F.explode(F.map_keys("_m")).alias("n")).distinct().orderBy("n").collect()]
    groups: dict[str, list[str]] = {}
    for name in names:
        groups.setdefault(alias.get(name, name), []).append(name)
    columns, taken, left = {}, set(), []
    for meaning in sorted(groups):
        label = meaning.lower() if meaning.lower() not in taken else f"{meaning.lower()}_{len(taken)}"
        taken.add(label)
        columns[label] = F.coalesce(*[F.try_element_at("_m", F.lit(n)) for n in groups[meaning]])
        left += [F.when(F.coalesce(*[F.try_element_at("_m", F.lit(o)) for o in groups[meaning][:i]]).isNotNull() & F.try_element_at("_m", F.lit(n)).isNotNull(), F.lit(n)) for i, n in enumerate(groups[meaning]) if i]
    over = F.array_compact(F.array(*left)) if left else F.array().cast("array<string>")
    x = x.select(*keep, *[c.alias(f"f_{label}") for label, c in columns.items()], F.map_filter("_m", lambda k, v: F.array_contains(over, k)).alias("left_over"))
    number = r"^\s*[+-]?\d+(\.\d+)?\s*$"
    if not columns:
        return x
    shares = x.agg(*[F.avg(F.when(F.col(f"f_{c}").isNotNull(), F.col(f"f_{c}").rlike(number).cast("int"))).alias(c) for c in columns]).first().asDict()
    return x.withColumns({f"n_{c}": F.expr(f"try_cast(trim(f_{c}) AS DOUBLE)") for c in columns if (shares[c] or 0) > 0.5})
