"""Records whose fields have many names brought to one set of names, from alias tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that schedules use for a circuit's fields, the commonest first.
CIRCUIT_ALIASES = {
    "circuit": ["circuit", "circuit_no", "ckt", "circuit_number", "#", "no", "ckt_no", "circuit_num", "cct", "cct_no", "circuit_id", "number", "branch", "branch_no"],
    "load_name": ["load_name", "description", "equipment", "load description", "serves", "item", "connected_to", "load", "device", "designation", "usage", "purpose", "notes", "function", "servicing", "area_served", "room", "location", "powered_device"],
    "trip": ["trip", "breaker", "amps", "size", "rating", "amp", "ocp", "breaker_size", "amperage", "ampacity", "amp_rating", "trip_size", "breaker_rating", "ocpd", "overcurrent", "amp_trip", "current", "current_rating", "a", "protection"],
    "poles": ["poles", "pole", "p", "#p", "no_poles", "num_poles", "pole_count", "phases", "phase", "num_phases", "number_of_poles", "number_poles", "ph", "p#", "num_p"],
}


# Names of a phase's load and of a circuit's total load.
LOAD_ALIASES = {
    "va_phase_a": ["va_phase_a", "va a", "phase a", "ph a", "a va", "va_a", "phase_a", "a_phase", "a_load", "va_phase_1", "phase_1", "ph_a", "va_a_phase", "load_a", "ph1", "phase1", "ph_1", "phase_1_load"],
    "va_phase_b": ["va_phase_b", "va b", "phase b", "ph b", "b va", "va_b", "phase_b", "b_phase", "b_load", "va_phase_2", "phase_2", "ph_b", "va_b_phase", "load_b", "ph2", "phase2", "ph_2", "phase_2_load"],
    "va_phase_c": ["va_phase_c", "va c", "phase c", "ph c", "c va", "va_c", "phase_c", "c_phase", "c_load", "va_phase_3", "phase_3", "ph_c", "va_c_phase", "load_c", "ph3", "phase3", "ph_3", "phase_3_load"],
    "total_va": ["total_va", "va total", "connected va", "kva", "total_kva", "connected_load", "load", "total", "sum", "total_load", "connected", "va_total", "total_connected", "kva_total", "va_sum", "load_total", "demand", "total_demand", "volt_amps"],
}


def digits_number(c: Column) -> Column:
    """The number that a text's digits and dots make; null if none."""
    return F.regexp_replace(c, r"[^\d.]", "").try_cast("double")


# Pipe sizes as fractions, in the order in which they are looked for.
PIPE_SIZES = {"1/8": 0.125, "1/4": 0.25, "3/8": 0.375, "1/2": 0.5, "5/8": 0.625, "3/4": 0.75, "7/8": 0.875, "1-1/4": 1.25, "1-1/2": 1.5, "2-1/2": 2.5, "3-1/2": 3.5}


def pipe_size(c: Column) -> Column:
    """The first listed fraction that the text holds, else the number its digits make."""
    out = None
    for told, size in PIPE_SIZES.items():
        out = F.when(c.contains(told), size) if out is None else out.when(c.contains(told), size)
    return out.otherwise(digits_number(c))


def circuit_record(entries: Column) -> Column:
    """A circuit (map of names to text) with its fields under one name each: poles whole, loads as numbers."""

    def record(told: Column) -> Column:
        poles = F.regexp_extract(told["poles"], r"^\s*([+-]?\d+)(?:\s|$)", 1).try_cast("int")
        return F.struct(*[told[k].alias(k) for k in ("circuit", "load_name", "trip")], poles.alias("poles"), *[digits_number(told[k]).alias(k) for k in LOAD_ALIASES])

    # a lambda's variable is evaluated once, whatever uses it
    return F.element_at(F.transform(F.array(normalised(entries, CIRCUIT_ALIASES | LOAD_ALIASES)), record), 1)


def normalised(entries: Column, aliases: dict[str, list[str]], last_wins: bool = False) -> Column:
    """Struct of the alias table's fields, each from the first (or last) alias in table order that entries (a map of
    names to text) has with a filled value; names are compared without case."""
    names_of = F.array_distinct(F.transform(F.map_keys(entries), F.lower))
    # of names equal but for case the alphabetically first counts
    lowered = F.map_from_arrays(names_of, F.transform(names_of, lambda k: F.element_at(entries, F.array_min(F.filter(F.map_keys(entries), lambda n: F.lower(n) == k)))))

    def fields(m: Column) -> Column:
        order = {target: [n.lower() for n in (reversed(names) if last_wins else names)] for target, names in aliases.items()}
        return F.struct(*[F.coalesce(*[F.nullif(F.trim(F.try_element_at(m, F.lit(n))), F.lit("")) for n in names]).alias(target) for target, names in order.items()])

    return F.element_at(F.transform(F.array(lowered), fields), 1)
