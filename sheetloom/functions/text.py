"""Column expressions for names, numbers, codes and identifiers of drawings."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Discipline codes that a drawing file's name begins with; two letters go before one.
DISCIPLINE_CODES = {
    "FA": "FireAlarm", "FP": "FireProtection", "LV": "LowVoltage", "LD": "LowVoltage", "FS": "FoodService", "AV": "AudioVisual", "TL": "Telecom",
    "SC": "Security", "ID": "InteriorDesign", "FD": "FireDetection", "ES": "EnvironmentalSystems", "LT": "Lighting", "TP": "TelephoneSystem",
    "EX": "Exhibit", "FE": "FireEgress", "SM": "SiteMechanical", "SE": "SiteElectrical", "A": "Architectural", "E": "Electrical", "M": "Mechanical",
    "P": "Plumbing", "C": "Civil", "S": "Structural", "T": "Technology", "H": "HVAC", "I": "Interiors", "L": "Landscape", "Q": "Equipment",
}
# Words that make a low-voltage drawing a fire-alarm one.
ALARM_WORDS = "FIRE|ALARM|SMOKE|DETECTOR|PULL|STROBE|HORN"


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def first_filled(*cs: Column) -> Column:
    """First value that isn't null or blank, trimmed."""
    return F.coalesce(*[blank_to_null(c) for c in cs])


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def discipline(path: Column) -> Column:
    """Discipline by the code that the file's name begins with; 'Type_XX' for unknown codes, 'General' without any."""
    name = F.upper(base_name(path))
    out = F.when(F.coalesce(name, F.lit("")) == "", "General")
    for code, meaning in DISCIPLINE_CODES.items():
        found = F.when(name.rlike(ALARM_WORDS), "FireAlarm").otherwise(meaning) if meaning == "LowVoltage" else F.lit(meaning)
        out = out.when(name.startswith(code), found)
    code = F.regexp_extract(name, r"^([A-Z0-9]{1,2})", 1)
    return out.when(code != "", F.concat(F.lit("Type_"), code)).otherwise("General")


def subtype(path: Column) -> Column:
    name = F.upper(base_name(path))
    low = name.startswith("LV") | name.startswith("LD")
    return F.when((discipline(path) == "Electrical") & name.rlike("PANEL|SCHEDULE"), "PANEL_SCHEDULE").when(low & name.rlike(ALARM_WORDS), "LOW_VOLTAGE")


def key_part(c: Column, fallback: str = "none") -> Column:
    """A component of a document id: other characters become single hyphens, none at the ends."""
    text = F.coalesce(blank_to_null(c), F.lit(fallback))
    safe = F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9_\-=]", "-"), "-+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(safe, "^-|-$", ""), F.lit("")), F.lit(fallback))


def document_id(*parts: Column) -> Column:
    """Filled parts joined by hyphens; 'doc' if none is filled."""
    filled = F.filter(F.array(*[F.when(blank_to_null(p).isNotNull(), key_part(p)) for p in parts]), lambda p: p.isNotNull())
    return F.when(F.size(filled) > 0, F.array_join(filled, "-")).otherwise("doc")


def padded_circuit(c: Column) -> Column:
    """Whole numbers get three digits, all else stays."""
    text = F.trim(c)
    number = F.regexp_replace(text, r"^0+(?=\d)", "")
    return F.when(text.rlike(r"^\d+$"), F.when(F.length(number) >= 3, number).otherwise(F.lpad(number, 3, "0"))).otherwise(c)


def slug(c: Column, fallback: str = "general") -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "-"), "^-|-$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(fallback))


# Fixed value: how file names tell a revision.
REVISION = r"(?i)rev(?:ision)?[\s._-]*([A-Za-z0-9]+)"


def drawing_version(name: Column) -> Column:
    token = F.lower(F.regexp_extract(name, REVISION, 1))
    return F.when(token != "", F.concat(F.lit("v"), token)).otherwise("v1")


def drawing_slug(name: Column) -> Column:
    stem = F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "")
    return slug(F.regexp_replace(stem, REVISION, ""), "drawing")


def first_integer(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"-?\d+", 0), F.lit("")).try_cast("bigint")


def plain_number(c: Column) -> Column:
    """A number once commas, inch marks and 'in' are gone; null otherwise."""
    return F.trim(F.regexp_replace(F.lower(c), r",|in|\"", "")).try_cast("double")


def unfenced(c: Column) -> Column:
    """Text inside a code fence, or the text itself, trimmed."""
    inner = F.regexp_extract(c, r"(?is)^\s*```(?:json)?\s*(.*?)\s*```\s*$", 1)
    return F.when(c.rlike(r"(?is)^\s*```(?:json)?\s*.*?\s*```\s*$"), inner).otherwise(F.trim(c))


_BARE_KEY = re.compile(r"[A-Za-z_]\w*(?=\s*:)")


def repair_text(text: str) -> str:
    """A JSON text with missing commas, trailing commas, bare keys and missing closing brackets put right outside its strings;
    brackets close in the order in which they are open. Of a repeated key the last value counts. The text itself if nothing parses."""
    try:
        return json.dumps(json.loads(text), ensure_ascii=False)
    except (ValueError, RecursionError):
        pass
    out: list[str] = []
    opened: list[str] = []
    last, at, n = "", 0, len(text)  # last: the last mark that is no white space
    while at < n:
        c = text[at]
        if c == '"':
            end = at + 1
            while end < n and text[end] != '"':
                end += 2 if text[end] == "\\" else 1
            piece = text[at : min(end + 1, n)]
            if last in ('"', "}", "]"):
                out.append(",")
            out.append(piece)
            at, last = at + len(piece), '"'
            continue
        key = _BARE_KEY.match(text, at) if last in ("{", ",", "}", "]") else None
        if key:
            out.append(("," if last in ("}", "]") else "") + f'"{key.group()}"')
            at, last = key.end(), '"'
            continue
        if c in "{[":
            if last in ("}", "]"):
                out.append(",")
            opened.append("}" if c == "{" else "]")
        elif c in "}]":
            while last == "," and out and out[-1].strip() in ("", ","):
                if out.pop().strip():
                    break
            if opened:
                opened.pop()
        out.append(c)
        if not c.isspace():
            last = c
        at += 1
    if last == ",":
        while out and out[-1].strip() in ("", ","):
            if out.pop().strip():
                break
    made = "".join([*out, *reversed(opened)])
    try:
        return json.dumps(json.loads(made), ensure_ascii=False)
    except (ValueError, RecursionError):
        return text


def _repaired(texts: pd.Series) -> pd.Series:
    return texts.map(repair_text, na_action="ignore")


def repaired_json(c: Column) -> Column:
    """repair_text of a column, on Arrow batches."""
    return F.pandas_udf(_repaired, "string")(c)


def safe_json(c: Column) -> Column:
    """The parsed text as VARIANT, after a repair if it needs one; null if neither parses. Only texts that don't parse are repaired."""
    text = unfenced(c)
    plain = F.try_parse_json(text)
    return F.coalesce(plain, F.try_parse_json(repaired_json(F.when(plain.isNull(), text))))


# Ordered rules for the type of a schedule block, each word pattern with its type; all need the word schedule.
SCHEDULE_RULES = [
    ("panel", "panel"), ("unit", "unit_plan"), ("lighting", "lighting_fixture"), ("electrical equipment|single line", "elec_equipment"), ("mechanical|rtu|ahu|vfd", "mech_equipment"),
    ("plumbing|ejector|water heater|wh", "plumb_equipment"), ("wall|partition", "wall_partition"), ("door", "door"), ("ceiling", "ceiling"), ("finish", "finish"),
]


def schedule_type(kind: Column, name: Column, sub: Column) -> Column:
    """Type of a schedule block by the words of its type, name and subtype; the first rule that fits counts."""
    words = F.lower(F.concat_ws(" ", F.coalesce(kind, F.lit("")), F.coalesce(name, F.lit("")), F.coalesce(sub, F.lit(""))))
    out = F.when(~words.contains("schedule"), "")
    for pattern, meaning in SCHEDULE_RULES:
        out = out.when(words.rlike(pattern), meaning)
    return out.otherwise("")
