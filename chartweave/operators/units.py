"""Amounts and rates in different units, brought to mg, mL, mg/hr and mL/hr.

Method: a multi-pattern automaton (Aho-Corasick over all unit aliases) finds the aliases that stand after a
number or in the unit field; the longest match wins, and the field (an amount or a rate) decides what a
sequence of aliases means.  The units found are joined to a broadcast table of conversion factors, and the
arithmetic is exact decimal arithmetic in the JVM.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Aliases of the units, in lower case (micro signs are folded to u first).
ALIASES = {
    ("mass", "mg"): "mg mgs milligram milligrams milligramme milligrammes",
    ("mass", "mcg"): "mcg mcgs ug ugs microgram micrograms microgramme microgrammes",
    ("mass", "g"): "g gs gm gms gram grams gramme grammes",
    ("mass", "ng"): "ng nanogram nanograms",
    ("volume", "mL"): "ml mls cc ccs milliliter milliliters millilitre millilitres",
    ("volume", "L"): "l liter liters litre litres",
    ("volume", "dL"): "dl deciliter deciliters decilitre decilitres",
    ("volume", "cL"): "cl centiliter centiliters centilitre centilitres",
    ("volume", "uL"): "ul microliter microliters microlitre microlitres",
    ("drop", "drop"): "gtt gtts drop drops microdrop microdrops ugtt ugtts",
    ("time", "hr"): "h hr hrs hour hours",
    ("time", "min"): "min mins minute minutes",
    ("time", "day"): "d day days",
    ("time", "s"): "s sec secs second seconds",
    ("per", "per"): "/ per @",
    ("other", "other"): "kg kilogram kilograms m2 m^2 m² unit units iu meq mmol each tablet tablets tab tabs capsule capsules cap caps patch patches puff puffs vial vials kit kits syringe syringes",
}
#: (unit, common unit, numerator, denominator): value in the common unit = value x numerator / denominator.
AMOUNT_FACTORS = [
    ("mg", "mg", 1, 1), ("mcg", "mg", 1, 1000), ("g", "mg", 1000, 1), ("ng", "mg", 1, 1000000),
    ("mL", "mL", 1, 1), ("L", "mL", 1000, 1), ("dL", "mL", 100, 1), ("cL", "mL", 10, 1), ("uL", "mL", 1, 1000),
    ("drop", "mL", 1, 1),
]
#: (unit of time, units of it in an hour, hours in it)
TIME_FACTORS = [("hr", 1, 1), ("min", 60, 1), ("day", 1, 24), ("s", 3600, 1)]
COMMON = ["mg", "mL", "mg/hr", "mL/hr"]

_NUMBER = re.compile(r"[+]?(?:\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+,\d+|\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d{1,3})?(?![\d,.])|[+]?\d+\.(?!\d)")
# Words that may stand before the one number of a value.
_BEFORE = re.compile(r"(?i)(?:(?:about|approx|approximately|ca|circa|dose|total|amount|volume|rate|give|given|at|of)\b[\s.:=]*|[~≈=:]\s*)+")
_GLUE = re.compile(r"[\s.,()\[\]]*")


@functools.lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for (kind, unit), words in ALIASES.items():
        for w in words.split():
            a.add_word(w, (kind, unit, len(w)))
    a.make_automaton()
    return a


def _fold(text: str) -> str:
    return text.replace("µ", "u").replace("μ", "u").lower()


@functools.lru_cache(maxsize=200_000)
def unit_of(text: str, rate: bool) -> tuple[str, str | None, str, str] | None:
    """``(unit, unit of time or None, count of that time, drops per mL)`` of a unit text, or None if it is none of ours."""
    text = _fold(text)
    tokens, at = [], 0
    matches = {}
    for end, (kind, unit, n) in _automaton().iter(text):
        lo = end - n + 1
        before, after = text[lo - 1 : lo], text[end + 1 : end + 2]
        if kind != "per" or unit == "per" and text[lo] == "p":
            if before.isalpha() and text[lo].isalpha() or after.isalpha() or after.isdigit() and kind != "per" and not text[end].isdigit():
                continue
        if lo not in matches or matches[lo][1] < n:
            matches[lo] = ((kind, unit), n)
    while at < len(text):
        if at in matches:
            tokens.append(matches[at][0])
            at += matches[at][1]
        elif m := _NUMBER.match(text, at):
            tokens.append(("number", m[0]))
            at = m.end()
        elif (m := _GLUE.match(text, at)) and m.end() > at:
            at = m.end()
        else:
            return None
    kinds = [k for k, _ in tokens]
    if not rate:
        return (tokens[0][1], None, "1", "1") if kinds in (["mass"], ["volume"]) else None
    if kinds in (["mass", "per", "time"], ["volume", "per", "time"]):
        return tokens[0][1], tokens[2][1], "1", "1"
    if kinds in (["mass", "per", "number", "time"], ["volume", "per", "number", "time"]):
        count = number_of(tokens[2][1])
        return (tokens[0][1], tokens[3][1], count, "1") if count and float(count) > 0 else None
    for k in (["drop", "per", "time", "number", "drop", "per", "volume"], ["drop", "per", "time", "per", "number", "drop", "per", "volume"]):
        if kinds == k and tokens[-1][1] == "mL":
            count = number_of(tokens[-4][1])
            return ("drop", tokens[2][1], "1", count) if count and float(count) > 0 else None
    return None


def number_of(text: str) -> str | None:
    """A number as a plain decimal text; None if it isn't one.  A comma before exactly three digits groups
    thousands, any other is a decimal comma; an exponent may follow."""
    m = re.fullmatch(r"\+?(\d{1,3}(?:,\d{3})+|\d*)(?:([.,])(\d*))?(?:[eE]([+-]?\d{1,3}))?", text)
    if not m or not (m[1] or m[3]):
        return None
    whole, fraction, power = (m[1] or "").replace(",", ""), m[3] or "", int(m[4] or 0)
    if m[2] == "," and not fraction:
        return None
    digits, point = whole + fraction, len(whole) + power
    if abs(power) > 30:
        return None
    if point <= 0:
        digits, point = "0" * (1 - point) + digits, 1
    digits = digits.ljust(point, "0")
    return (digits[:point].lstrip("0") or "0") + ("." + digits[point:] if digits[point:].rstrip("0") else "")


def read_quantity(value: str | None, unit: str | None, rate: bool) -> tuple[str, str, str | None, str, str] | None:
    """``(number, unit, unit of time, its count, drops per mL)`` of a value and its unit field, or None.

    A unit in the value counts before the unit field, which then may be absent, blank or say anything.
    """
    if value is None or not (v := value.strip()):
        return None
    if before := _BEFORE.match(v):
        v = v[before.end() :]
    m = _NUMBER.match(v)
    if not m or (number := number_of(m[0])) is None:
        return None
    rest = v[m.end() :].strip()
    u = unit_of(rest, rate) if rest else unit_of((unit or "").strip(), rate)
    return (number, *u) if u else None


def exact_thousandths(number: str, unit: str, time_unit: str | None, count: str, drops: str) -> int | None:
    """The value in thousandths of the common unit by whole-number arithmetic of any length, rounded half up; None beyond 64 bits."""
    num, den = next((n, d) for u, _, n, d in AMOUNT_FACTORS if u == unit)
    per_hour, hours = next(((a, b) for u, a, b in TIME_FACTORS if u == time_unit), (1, 1))
    top, bottom = Fraction(number) * num * per_hour * 1000, Fraction(count) * Fraction(drops) * den * hours
    got = (2 * top + bottom) // (2 * bottom)
    return got if got < 1 << 63 else None


def _fits(number: str, *small: str) -> bool:
    """Whether decimals of the widths used in the JVM hold these texts exactly."""
    whole, _, part = number.partition(".")
    return len(whole) <= 15 and len(part) <= 9 and all(len(x.partition(".")[0]) <= 6 and len(x.partition(".")[2]) <= 3 for x in small)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        d = b.to_pydict()
        keep, beyond, cols = [], [], ([], [], [], [], [])
        for i, (v, u, r) in enumerate(zip(d["value"], d["unit"], d["is_rate"])):
            q = read_quantity(v, u, r)
            if q:
                keep.append(i)
                for c, x in zip(cols, q):
                    c.append(x)
                beyond.append(None if _fits(q[0], q[3], q[4]) else -1 if (x := exact_thousandths(*q)) is None else x)
        rows = b.select(["source_table", "row_id", "field_name", "plain"]).take(pa.array(keep, pa.int32()))
        extra = [*(pa.array(c, pa.string()) for c in cols), pa.array(beyond, pa.int64())]
        yield pa.RecordBatch.from_arrays([*rows.columns, *extra], names=[*rows.schema.names, "number", "amount_unit", "time_unit", "time_count", "drops", "beyond"])


def common_units(spark: SparkSession, parts: list[tuple[DataFrame, str, str, str, str, bool]]) -> DataFrame:
    """``(source_table, row_id, field_name, common_unit, value_thousandths)`` of values not yet in their common unit.

    ``parts``: (table, its name, field name, value column, unit column, is it a rate).  A drop rate with its drop
    factor is a volume rate.  Per-weight, per-area and count units, values without any unit, ranges and words
    give no row, nor do nulls and blanks.  A value that isn't a whole number of thousandths is rounded half up; one that
    64 bits can't hold in thousandths is no value.  Numbers too long for the JVM's decimals are reckoned when they are read.
    """
    every = None
    for df, name, field, value, unit, rate in parts:
        plain = F.col(value).rlike(r"\A[0-9]+(\.[0-9]+)?\z") & F.col(unit).isin(*COMMON)
        one = df.select(
            F.lit(name).alias("source_table"), "row_id", F.lit(field).alias("field_name"), F.col(value).alias("value"), F.col(unit).alias("unit"),
            F.lit(rate).alias("is_rate"), F.when(plain, F.col(unit)).alias("plain"),
        ).where(F.col("value").rlike("[0-9]"))
        every = one if every is None else every.unionByName(one)
    found = every.mapInArrow(_read, "source_table string, row_id long, field_name string, plain string, number string, amount_unit string, time_unit string, time_count string, drops string, beyond long")
    amounts = spark.createDataFrame(AMOUNT_FACTORS, "amount_unit string, common string, num long, den long")
    times = spark.createDataFrame(TIME_FACTORS, "time_unit string, per_hour long, hours long")
    j = found.join(F.broadcast(amounts), "amount_unit").join(F.broadcast(times), "time_unit", "left")
    dec = lambda c: F.col(c).try_cast("decimal(24,9)")
    top = (dec("number") * (F.col("num") * F.coalesce("per_hour", F.lit(1)) * 1000).cast("decimal(12,0)")).cast("decimal(38,9)")
    bottom = (F.col("den") * F.coalesce("hours", F.lit(1))).cast("decimal(10,0)") * F.col("time_count").try_cast("decimal(9,3)") * F.col("drops").try_cast("decimal(9,3)")
    out = j.withColumn("common_unit", F.when(F.col("time_unit").isNull(), F.col("common")).otherwise(F.concat("common", F.lit("/hr"))))
    plain = F.when(F.col("beyond").isNull(), F.round(F.try_divide(top, bottom), 0).try_cast("long"))
    out = out.withColumn("value_thousandths", F.coalesce(plain, F.when(F.col("beyond") >= 0, F.col("beyond"))))
    return out.where(F.col("value_thousandths").isNotNull() & ~F.col("plain").eqNullSafe(F.col("common_unit"))).select(
        "source_table", "row_id", "field_name", "common_unit", "value_thousandths"
    )
