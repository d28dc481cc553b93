"""Mixed timestamp notations and time zones to UTC instants.

Every notation is taken apart with JVM expressions into calendar fields and a zone token. Values without
a zone get the zone of their source: among candidate zones (offset histories) the one is chosen that
violates the evidence least. A declared zone wins unless the evidence clearly speaks against it.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo, available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names by their first letters, in English, German, French and Spanish.
MONTH_PREFIXES = {
    "jan": 1, "ene": 1, "feb": 2, "fev": 2, "mar": 3, "apr": 4, "avr": 4, "abr": 4, "may": 5, "mai": 5, "jun": 6,
    "juin": 6, "jul": 7, "juil": 7, "aug": 8, "aou": 8, "ago": 8, "sep": 9, "oct": 10, "okt": 10, "nov": 11,
    "dec": 12, "dez": 12, "dic": 12,
}

_ZONE = r"(Z|[+-]\d{2}:?\d{2}|[A-Za-z]{2,5}|\[[A-Za-z_/+\-0-9]+\]|[A-Za-z_]+(?:/[A-Za-z_\-]+)+)?"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
#: Notations, each with the places of its parts in year|month|day|hour|minute|second|fraction|half|zone|kind. In kind n
#: month and day are in the order of the source.
NOTATIONS = [
    (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})(?:[T ] *{_TIME} *{_ZONE})?$", "$1|$2|$3|$4|$5|$6|$7||$8|c"),
    (rf"^(\d{{1,2}})([/.\-])(\d{{1,2}})\2(\d{{4}}|\d{{2}})(?: +{_TIME}(?: *([AaPp])[Mm])?(?: +{_ZONE})?)?$", "$4|$1|$3|$5|$6|$7|$8|$9|$10|n"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1|$2|$3|||||||c"),
    (r"^(\d{10}(?:\d{3})?)$", "$1|||||||||e"),
    (rf"^(?:\p{{L}}+,? +)?(\d{{1,2}})(?:\. *|[ \-]+)(\p{{L}}+)\.?[ \-]+(\d{{4}}|\d{{2}})(?:,? +{_TIME}(?: *([AaPp])[Mm])?(?: +{_ZONE})?)?$", "$3|$2|$1|$4|$5|$6|$7|$8|$9|c"),
    (rf"^(\p{{L}}+)\.? +(\d{{1,2}}), *(\d{{4}})(?:,? +{_TIME}(?: *([AaPp])[Mm])?(?: +{_ZONE})?)?$", "$3|$1|$2|$4|$5|$6|$7|$8|$9|c"),
    (r"^D:(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})(?:(Z)|([+-]\d{2})'?(\d{2})?'?)?$", "$1|$2|$3|$4|$5|$6|||$7$8$9|c"),
]


def _month(name: Column) -> Column:
    plain = F.translate(F.lower(name), "äéèêûàá", "aeeeuaa")
    table = F.create_map(*[F.lit(x) for kv in MONTH_PREFIXES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.substring(plain, 1, 4)), F.try_element_at(table, F.substring(plain, 1, 3)))


def parse_parts(value: Column) -> Column:
    """The parts of one notation as an array of ten strings; null where no notation matches."""
    v = F.trim(F.translate(value, "\t\n\r\u00a0", "    "))
    parts = None
    for pattern, places in NOTATIONS:
        found = F.regexp_replace(v, pattern, places)
        parts = F.when(v.rlike(pattern), found) if parts is None else parts.when(v.rlike(pattern), found)
    return F.split(parts, r"\|")


def fields_of(parts: Column, date_order: Column) -> dict[str, Column]:
    """Calendar fields of the parts. Where month and day are in the source's order, date_order ('MDY' or 'DMY') tells it;
    null leaves them unread."""
    at = lambda i: F.nullif(F.try_element_at(parts, F.lit(i)), F.lit(""))
    kind, day_first = at(10), date_order == "DMY"
    month = F.when(kind == "c", at(2)).when(day_first, at(3)).when(~day_first, at(2))
    day = F.when(kind == "c", at(3)).when(day_first, at(2)).when(~day_first, at(3))
    month = F.coalesce(month.try_cast("int"), _month(month))
    return {"kind": kind, "y": at(1), "mo": month, "d": day.cast("int"), "h": at(4), "mi": at(5), "s": at(6), "frac": at(7), "half": at(8), "zone": at(9)}


def local_micros(f: dict[str, Column]) -> Column:
    """Microseconds of the fields read as if they were UTC; null for a day or time that doesn't exist."""
    hour = F.coalesce(f["h"].cast("int"), F.lit(0))
    hour = F.when(f["half"].isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(F.lower(f["half"]) == "p", 12).otherwise(0))
    year = f["y"].cast("int") + F.when(F.length(f["y"]) == 2, 2000).otherwise(0)
    second = F.coalesce(f["s"].cast("int"), F.lit(0))
    whole = F.try_make_timestamp(year, f["mo"], f["d"], hour, F.coalesce(f["mi"].cast("int"), F.lit(0)), second, F.lit("UTC"))
    micros = F.coalesce(F.rpad(F.substring(f["frac"], 1, 6), 6, "0").cast("bigint"), F.lit(0))
    # Spark reads second 60 as the next minute; no clock of these sources shows it
    return F.when((f["kind"] != "e") & year.between(1, 9999) & (second < 60), F.unix_micros(whole) + micros)


def zoned_micros(local: Column, zone: Column) -> Column:
    """UTC microseconds of a local time in a named zone: a repeated time is the earlier instant, a skipped
    one is read with the offset before the change."""
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), zone))


def abbreviation_offsets(zones: list[str]) -> dict[str, int]:
    """'zone|ABBR' to offset seconds, as used in each zone since 1990."""
    out: dict[str, int] = {}
    for name in zones:
        zone, at = ZoneInfo(name), datetime(1990, 1, 1, tzinfo=timezone.utc)
        while at.year < 2038:
            local = at.astimezone(zone)
            if local.tzname().isalpha():
                out[f"{name}|{local.tzname()}"] = int(local.utcoffset().total_seconds())
            at += timedelta(days=91)
    return out


def estimate_zones(rows: DataFrame, source: str, zones: list[str], near_us: int = 3_600_000_000) -> DataFrame:
    """For each source: evidence (rows), declared_wrong (violations of the declared zone) and, for sources without one,
    best_zone, the candidate whose offset history violates the evidence least, and zone_unique.

    rows has local_us, offset_s (offset told in the value, or null), seen_us (when the row was taken in) and _tz (the
    declared zone). A told offset is violated by a zone with another offset at that time, a bare value where it would
    lie after seen_us. Of candidates with equally few violations the one counts that explains most: told offsets that it
    has, and values taken in less than near_us after it (a zone further east makes every value look older, so the zone
    that is no further east than needed has the most of these). Candidates that differ in instants but not in these
    counts, or of which none explains anything, leave the zone open: zone_unique is false. One pass with map-side
    partial sums: a hot source costs one small row per task.
    """

    def judged(zone: Column) -> tuple[Column, Column, Column]:
        at = zoned_micros(F.col("local_us"), zone)
        told, lag = at == F.col("local_us") - F.col("offset_s").cast("bigint") * 1_000_000, F.col("seen_us") - at
        known = F.col("offset_s").isNotNull()
        return F.when(known, ~told).otherwise(lag < 0), F.when(known, told).otherwise((lag >= 0) & (lag < near_us)), F.floor(at / 900_000_000)

    open_ = F.col("_tz").isNull()
    tests = []
    for i, zone in enumerate(zones):
        for name, value in zip("vgc", judged(F.lit(zone))):
            tests.append(F.sum(F.when(open_, value.cast("bigint"))).alias(f"{name}{i}"))
    declared = F.sum(F.when(~open_, judged(F.col("_tz"))[0].cast("bigint"))).alias("declared_wrong")
    x = rows.where("local_us IS NOT NULL").groupBy(source).agg(F.count("*").alias("evidence"), declared, *tests)
    none = F.lit(0).cast("bigint")
    ranked = F.array_sort(F.array(*[F.struct(F.coalesce(F.col(f"v{i}"), none).alias("wrong"), (-F.coalesce(F.col(f"g{i}"), none)).alias("right"), F.lit(z).alias("zone"), F.coalesce(F.col(f"c{i}"), none).alias("instants")) for i, z in enumerate(zones)]))
    x = x.select(source, "evidence", F.coalesce("declared_wrong", F.lit(0)).alias("declared_wrong"), F.inline(F.array(F.struct(ranked.alias("_ranked")))))
    best = F.element_at("_ranked", 1)
    rivals = F.exists("_ranked", lambda z: (z["wrong"] == best["wrong"]) & (z["right"] == best["right"]) & (z["instants"] != best["instants"]))
    return x.select(source, "evidence", "declared_wrong", best["zone"].alias("best_zone"), ((best["right"] < 0) & ~rivals).alias("zone_unique"))


def normalise_timestamps(df: DataFrame, sites: DataFrame, value: str = "value", source: str = "source", seen: str = "seen_at", keep=lambda x: x, candidates: list[str] | None = None) -> DataFrame:
    """Adds utc_us BIGINT, zone_used STRING, zone_source ('told', 'declared', 'estimated', 'open' or null) and, for a
    declared zone, contradicted BOOLEAN (it violates more than half of its source's evidence) to df.

    candidates: the zones that a source without a declared one may have; by default those of the sites. 'open' is a value
    whose source's zone the evidence doesn't single out; its utc_us is null.

    sites: columns <source>, site_tz, date_order, one row per source (of repeated ones the smallest is taken).
    df may have any further columns except those names and names that begin with an underscore.
    Nulls, blanks, placeholders and impossible days give utc_us null; a null source has no declared zone and no
    estimate; an empty sites table leaves estimates out. The zones of sites are listed on the driver: their number
    is bounded by the time-zone database. keep: called with the parsed rows, to write them once.
    """
    sites = sites.where(F.col(source).isNotNull()).groupBy(F.col(source).alias("_src")).agg(F.min("site_tz").alias("_tz"), F.min("date_order").alias("_order"))
    known = available_timezones()
    zones = sorted({r[0] for r in sites.select("_tz").distinct().collect() if r[0] in known} | {z for z in candidates or () if z in known})
    offsets = abbreviation_offsets(zones)
    abbr = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]) if offsets else F.lit(None).cast("map<string,int>")

    own = df.columns
    with_site = df.join(sites, df[source] == sites["_src"], "left")
    with_site = with_site.withColumn("_tz", F.when(F.col("_tz").isin(*zones), F.col("_tz")) if zones else F.lit(None).cast("string"))
    # inline() and explode() of one element keep the optimizer from copying what was parsed into every later use
    x = with_site.select("*", F.explode(F.array(parse_parts(F.col(value)))).alias("_parts"))
    f = fields_of(F.col("_parts"), F.col("_order"))
    told = F.try_element_at("_parts", F.lit(1))
    epoch = F.when(f["kind"] == "e", told.cast("bigint") * F.when(F.length(told) == 10, 1_000_000).otherwise(1000))
    zone = F.translate(f["zone"], "[]", "")
    read = F.struct(local_micros(f).alias("local_us"), zone.alias("_zone"), epoch.alias("_epoch"), F.unix_micros(F.col(seen).cast("timestamp")).alias("seen_us"))
    x = x.select(*own, "_tz", F.inline(F.array(read)))
    zone = F.col("_zone")
    digits = F.translate(zone, "+-:", "")
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    numeric = sign * (F.substring(digits, 1, 2).cast("int") * 3600 + F.coalesce(F.nullif(F.substring(digits, 3, 2), F.lit("")).cast("int"), F.lit(0)) * 60)
    universal = F.upper(zone).isin("Z", "UTC", "GMT")
    offset = F.when(universal, 0).when(zone.startswith("+") | zone.startswith("-"), numeric).when(~zone.contains("/"), F.try_element_at(abbr, F.concat_ws("|", F.col("_tz"), F.upper(zone))))
    region = F.when(zone.contains("/") & zone.isin(*sorted(z for z in known if "/" in z)), zone)
    x = x.select(*own, "_tz", "local_us", "_zone", "_epoch", "seen_us", F.inline(F.array(F.struct(offset.alias("offset_s"), region.alias("_region"), universal.alias("_universal")))))
    x = keep(x)
    if zones:
        # a value in UTC tells nothing about its source's zone
        evidence = x.where(F.col(source).isNotNull() & (F.col("_zone").isNull() | ~F.col("_universal") & F.col("offset_s").isNotNull()))
        est = estimate_zones(evidence.select(F.col(source).alias("_esrc"), "local_us", "offset_s", "seen_us", "_tz"), "_esrc", sorted(set(candidates) & set(zones)) if candidates else zones)
        x = x.join(est, x[source] == est["_esrc"], "left")
    else:
        x = x.select("*", F.lit(None).cast("string").alias("best_zone"), F.lit(False).alias("zone_unique"), F.lit(0).alias("evidence"), F.lit(0).alias("declared_wrong"))
    bare, chosen = F.col("_zone").isNull() & F.col("_epoch").isNull(), F.coalesce("_tz", F.when(F.col("zone_unique"), F.col("best_zone")))
    at = (
        F.when(F.col("_epoch").isNotNull(), F.col("_epoch"))
        .when(F.col("offset_s").isNotNull(), F.col("local_us") - F.col("offset_s").cast("bigint") * 1_000_000)
        .when(F.col("_region").isNotNull() | bare, zoned_micros(F.col("local_us"), F.coalesce("_region", chosen)))
    )
    used = F.when(F.col("_epoch").isNotNull(), F.lit("UTC")).when(bare, chosen).otherwise(F.col("_zone"))
    how = F.when(~bare, "told").when(F.col("_tz").isNotNull(), "declared").when(chosen.isNotNull(), "estimated").when(F.col("local_us").isNotNull() & F.col("best_zone").isNotNull(), "open")
    x = x.select(*own, F.inline(F.array(F.struct(at.alias("utc_us"), used.alias("_used"), how.alias("_how"), (F.col("declared_wrong") * 2 > F.col("evidence")).alias("_against")))))
    there = F.col("utc_us").isNotNull()
    return x.select(*own, "utc_us", F.when(there, F.col("_used")).alias("zone_used"), F.when(there | (F.col("_how") == "open"), F.col("_how")).alias("zone_source"), F.when(there & (F.col("_how") == "declared"), F.coalesce("_against", F.lit(False))).alias("contradicted"))
