"""Quantities recorded in different units, scales and notations to one common unit per quantity.

Each value gets its possible readings (number times unit). A unit told in the value, stated in the record's
text or fixed by convention narrows them; what is left open is settled over all quantities of a record at
once by the smallest sum of log residuals against physical identities among columns (such as area = length
times width) and against the usual magnitude of each quantity. Choices that another one nearly matches are
flagged as not unique.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER = r"(\d[\d.,]*)"


@dataclass(frozen=True)
class Quantity:
    """units: unit name to (regex of its notations, factor to the common unit). statements: regex over the
    record's text whose last non-empty group is a unit notation. default: unit of a bare number without a
    statement, or None where it then stays open. feet_inches: also reads 9'-6 1/2" and the like."""

    name: str
    value: str
    text: str | None
    units: dict[str, tuple[str, float]]
    statements: str = ""
    default: str | None = None
    feet_inches: bool = False
    drop: str = ""


@dataclass(frozen=True)
class Identity:
    """Product of the quantities to the given powers is constant up to noise, e.g. area / (length * width)."""

    powers: dict[str, float] = field(default_factory=dict)


def _clean(c: Column, drop: str) -> Column:
    c = F.translate(F.lower(F.trim(c)), "′’″”² ", "''\"\"2 ")
    return F.trim(F.regexp_replace(c, drop, "")) if drop else c


def _readings(text: Column) -> Column:
    """The numbers a digit string may mean. A comma groups thousands or marks decimals; where both are
    possible both are returned, thousands first."""
    thousands = text.rlike(r"^\d{1,3}(,\d{3})+(\.\d+)?$")
    decimals = text.rlike(r"^\d+,\d+$")
    plain = text.rlike(r"^\d+(\.\d+)?$")
    as_thousands, as_decimal = F.replace(text, F.lit(","), F.lit("")), F.replace(text, F.lit(","), F.lit("."))
    both = F.array(F.when(thousands, as_thousands), F.when(decimals, as_decimal), F.when(plain, text))
    return F.transform(F.filter(both, lambda x: x.isNotNull()), lambda x: x.cast("double"))


def candidates(q: Quantity) -> Column:
    """Array of struct<rank, val, unit, basis>: the readings of a value in the common unit, empty where the
    value gives no single quantity."""
    v = _clean(F.col(q.value), q.drop)
    pattern = {u: rf"(?:{p})" for u, (p, _) in q.units.items()}
    kind = "struct<rank:int,val:double,unit:string,basis:string>"

    def of(numbers: Column, unit: str, basis: str) -> Column:
        factor = q.units[unit][1]
        return F.transform(numbers, lambda x, i: F.struct(i.cast("int").alias("rank"), (x * F.lit(float(factor))).alias("val"), F.lit(unit).alias("unit"), F.lit(basis).alias("basis")).cast(kind))

    cases: list[tuple[Column, Column]] = []
    if q.feet_inches:
        split = r"^(\d+) ?(?:'|ft\.?|feet)(?:[ -]*(\d+)?(?: ?(\d+)/(\d+))? ?(?:\"|in\.?|inches))$"
        inch = r"^(?:(\d+) )?(\d+)/(\d+) ?(?:\"|in\.?|inches)$"

        def g(p: str, i: int) -> Column:
            return F.coalesce(F.nullif(F.regexp_extract(v, p, i), F.lit("")).cast("double"), F.lit(0.0))

        def part(p: str, i: int) -> Column:
            return F.when(g(p, i + 1) > 0, g(p, i) / g(p, i + 1)).otherwise(0.0)

        cases.append((v.rlike(split), of(F.array(g(split, 1) * 12 + g(split, 2) + part(split, 3)), "in", "told")))
        cases.append((v.rlike(inch), of(F.array(g(inch, 1) + part(inch, 2)), "in", "told")))
    for u in q.units:
        p = rf"^{NUMBER} ?{pattern[u]}$"
        cases.append((v.rlike(p), of(_readings(F.regexp_extract(v, p, 1)), u, "told")))
    bare = _readings(v)
    if q.statements and q.text:
        text = F.translate(F.lower(F.col(q.text)), "²", "2")
        for u in q.units:
            cases.append(((F.size(bare) > 0) & text.rlike(q.statements.replace("UNIT", pattern[u])), of(bare, u, "stated")))
    cases.append((F.size(bare) > 0, of(bare, q.default, "default") if q.default else F.flatten(F.array(*[of(bare, u, "inferred") for u in q.units]))))
    out = F.when(*cases[0])
    for condition, value in cases[1:]:
        out = out.when(condition, value)
    return F.coalesce(F.filter(out, lambda x: x["val"] > 0), F.array().cast(f"array<{kind}>"))


def _combos(quantities: list[Quantity]) -> Column:
    """All choices of one candidate per quantity; a quantity without candidates contributes a null."""
    def own(q: Quantity) -> Column:
        return F.when(F.size(f"_c_{q.name}") > 0, F.col(f"_c_{q.name}")).otherwise(F.array(F.lit(None)))

    def joined(combos: Column, done: list[str], q: Quantity) -> Column:
        return F.flatten(F.transform(combos, lambda a: F.transform(own(q), lambda c: F.struct(*[a[n].alias(n) for n in done], c.alias(q.name)))))

    first = quantities[0]
    combos = F.transform(own(first), lambda c: F.struct(c.alias(first.name)))
    for i, q in enumerate(quantities[1:], 1):
        combos = joined(combos, [p.name for p in quantities[:i]], q)
    return combos


def resolve_units(df: DataFrame, quantities: list[Quantity], identities: list[Identity] = (), given: list[str] = (), margin: float = math.log(3)) -> DataFrame:
    """Adds, for each quantity, <name>_val DOUBLE in its common unit, <name>_unit, <name>_basis ('told',
    'stated', 'default' or 'inferred') and <name>_unique BOOLEAN.

    given: columns of df that identities may use as they are. The usual magnitude of each quantity and the
    level and spread of each identity are medians over all rows whose values have a single reading; one
    aggregate row comes to the driver. An identity counts only where the rows bear it out: its residuals must spread less
    than half as much as those of unrelated columns with the same spreads would. A null, blank, zero or wordy value has no reading and yields nulls, an
    empty table yields no rows, repeated rows are each resolved alike.
    """
    x = df.withColumns({f"_c_{q.name}": candidates(q) for q in quantities})

    def sole(name: str) -> Column:
        if name in given:
            return F.when(F.col(name) > 0, F.col(name))
        return F.when(F.size(f"_c_{name}") == 1, F.try_element_at(f"_c_{name}", F.lit(1))["val"])

    aggs = []
    for q in quantities:
        aggs.append(F.percentile_approx(F.ln(sole(q.name)), [0.16, 0.5, 0.84], 1000).alias(q.name))
    for i, one in enumerate(identities):
        total = sum((F.ln(sole(n)) * F.lit(float(e)) for n, e in one.powers.items()), F.lit(0.0))
        aggs.append(F.percentile_approx(total, [0.16, 0.5, 0.84], 1000).alias(f"i{i}"))
    for n in given:
        aggs.append(F.percentile_approx(F.ln(sole(n)), [0.16, 0.5, 0.84], 1000).alias(f"g_{n}"))
    levels = x.agg(*aggs).first().asDict()

    def spread(name: str) -> tuple[float, float]:
        low, mid, high = levels[name] or (0.0, 0.0, 2.0)
        return mid, max((high - low) / 2, 0.05)

    def borne_out(i: int, one: Identity) -> bool:
        apart = math.sqrt(sum((e * spread(f"g_{n}" if n in given else n)[1]) ** 2 for n, e in one.powers.items()))
        return levels[f"i{i}"] is not None and spread(f"i{i}")[1] < apart / 2

    trusted = [(i, one) for i, one in enumerate(identities) if borne_out(i, one)]

    def cost(combo: Column) -> Column:
        total = F.lit(0.0)
        for q in quantities:
            mid, wide = spread(q.name)
            total += F.coalesce(F.abs(F.ln(combo[q.name]["val"]) - mid) / wide, F.lit(0.0))
        for i, one in trusted:
            mid, wide = spread(f"i{i}")
            parts = [F.ln(F.when(F.col(n) > 0, F.col(n)) if n in given else combo[n]["val"]) * F.lit(float(e)) for n, e in one.powers.items()]
            total += F.coalesce(F.abs(sum(parts[1:], parts[0]) - mid) / wide, F.lit(0.0))
        return total

    ranks = lambda c: sum((F.coalesce(c[q.name]["rank"], F.lit(0)) for q in quantities), F.lit(0))
    scored = F.array_sort(F.transform(F.col("_combos"), lambda c: F.struct(cost(c).alias("cost"), ranks(c).alias("rank"), c.alias("c"))))
    x = x.withColumn("_combos", _combos(quantities)).withColumn("_scored", scored)
    best = F.try_element_at("_scored", F.lit(1))

    def rival(q: Quantity, mine: Column) -> Column:
        _, wide = spread(q.name)
        return F.exists("_scored", lambda s: (s["cost"] < best["cost"] + margin / wide) & (F.abs(F.ln(s["c"][q.name]["val"]) - F.ln(mine["val"])) > 1e-9))

    out = {}
    for q in quantities:
        mine = best["c"][q.name]
        near = rival(q, mine)
        out |= {f"{q.name}_val": mine["val"], f"{q.name}_unit": mine["unit"], f"{q.name}_basis": mine["basis"], f"{q.name}_unique": F.when(mine["val"].isNotNull(), ~F.coalesce(near, F.lit(False)))}
    return x.withColumns(out).drop("_combos", "_scored", *[f"_c_{q.name}" for q in quantities])


# Notations and factors of the drawing trade. Common units: tenths of a millimetre, square
# feet, volt-amperes and milliamperes.
CEILING = {
    "in": (r"\"|in\.?|inch|inches", 254.0), "ft": (r"'|ft\.?|foot|feet", 3048.0), "mm": (r"mm|millimet(?:re|er)s?", 10.0),
    "cm": (r"cm|centimet(?:re|er)s?", 100.0), "m": (r"m|met(?:re|er)s?", 10000.0),
}
AREA = {
    "sqft": (r"sf|sq\.? ?ft\.?|square feet|ft2|sqft", 1.0), "sqm": (r"m2|sq\.? ?m|sqm|square met(?:re|er)s?", 1 / 0.09290304),
    "sqyd": (r"sq\.? ?yd|yd2|square yards?|sy", 9.0),
}
KVA = {
    "kva": (r"kva|kilovolt-amperes?", 1000.0), "va": (r"va|volt-amperes?", 1.0), "mva": (r"mva|megavolt-amperes?", 1e6),
}
AMPS = {
    "a": (r"a|at|amps?|amperes?|amp\.? trip|a/\dp", 1000.0), "ma": (r"ma|milliamps?|milliamperes?", 1.0), "ka": (r"ka|kiloamps?|kiloamperes?", 1e6),
}

CEILING_HEIGHT = Quantity("ceiling", "ceiling_height", "note", CEILING, r"\b(?:heights?|dimensions?)\b[^.]*\bin UNIT\b", None, True, r" ?a\.?f\.?f\.?$")
ROOM_AREA = Quantity("area", "square_footage", "note", AREA, r"\bareas?\b[^.]*\bin UNIT(?![a-z0-9])", "sqft")
LOAD = Quantity("kva", "kva", "content", KVA, r"\bloads?\b[^;()]*[ ,]UNIT(?![a-z-])|(?<![a-z])UNIT loads?\b", "kva")
CURRENT = Quantity("amps", "amps", "content", AMPS, r"\bcurrents?\b[^;()]*\bUNIT(?![a-z])", "a")
