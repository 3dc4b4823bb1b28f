"""Timestamps of mixed formats, precisions and zones in one normal form.

Method: texts are parsed to local wall-clock seconds with JVM expressions; an as-of join to the exploded
zone-offset intervals (``zones.local_segments``: zone x year, so an equi-join with a short residual) gives the
offset: one matching interval gives it directly, two mean an ambiguous time (the first is taken), none a
nonexistent one (the offset before the change is taken).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartweave.functions.dates import utc_text
from chartweave.operators import zones

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
FULL_MONTHS = "january february march april may june july august september october november december".split()
_MONTH = "(?i:" + "|".join(f"{a}(?:{b[3:]})?" if b[3:] else a for a, b in zip(MONTHS, FULL_MONTHS)) + "|sept)"
#: One pattern for all layouts; its groups come out in one pass of regexp_replace, joined by _SEP.
_HEADS = [
    r"(\d{4})-(\d{1,2})-(\d{1,2})",
    r"(\d{4})(\d{2})(\d{2})",
    r"(\d{1,2})/(\d{1,2})/(\d{4})",
    r"(\d{1,2})\.(\d{1,2})\.(\d{4})",
    rf"(?:(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? )?(\d{{1,2}})[ -]({_MONTH})\.?[ -](\d{{4}})",
    rf"({_MONTH})\.? (\d{{1,2}}),? (\d{{4}})",
]
_TAIL = (
    r"(?:(?:[Tt]|,? +|(?<=^\d{8}))(\d{1,2})(?::(\d{2})(?::(\d{2})(?:[.,]\d+)?)?|(\d{2})(\d{2})?)"
    r" *([AaPp]\.?[Mm]\.?)? *(Z|z|[+-]\d{2}(?::?\d{2})?|\[[A-Za-z0-9_+/-]+\]|[A-Za-z]{2,5})?)?"
)
_SEP = "\u0001"
_N = 3 * len(_HEADS)
PATTERN = "^(?:" + "|".join(_HEADS) + ")" + _TAIL + "$"


def parse(df: DataFrame, value: str, date_order: str) -> DataFrame:
    """Adds ``__day`` (text), ``__local`` (wall-clock seconds, null without a time), ``__epoch`` (UTC seconds of a
    plain epoch number) and ``__zone`` (what the text says of a zone, null if nothing); all null where the text
    can't be read."""
    t = F.regexp_replace(F.col(value), r"^[\s\u00A0\u3000]+|[\s\u00A0\u3000]+$", "")
    groups = _SEP.join(f"${i}" for i in range(1, _N + 8))
    df = df.withColumn("__t", t).withColumn(
        "__p",
        F.when(
            (F.length("__t") >= 8) & ~F.col("__t").rlike(r"^(?:\d{10}|\d{13})$"),
            F.split(F.regexp_replace("__t", PATTERN, groups), _SEP),
        ),
    )
    hit = F.size("__p") == _N + 7
    g = lambda i: F.nullif(F.element_at("__p", i), F.lit(""))
    num = lambda c: c.try_cast("int")
    month = lambda c: (F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(c, 1, 3)))).cast("int")
    order = F.col(date_order)
    mdy, known = order == "MDY", order.isin("MDY", "DMY")
    y = F.coalesce(g(1), g(4), g(9), g(12), g(15), g(18))
    m = F.coalesce(num(g(2)), num(g(5)), F.when(known, num(F.when(mdy, g(7)).otherwise(g(8)))), num(g(11)), F.when(g(14).isNotNull(), month(g(14))), F.when(g(16).isNotNull(), month(g(16))))
    d = F.coalesce(g(3), g(6), F.when(known, F.when(mdy, g(8)).otherwise(g(7))), g(10), g(13), g(17))
    h, half = g(_N + 1), F.lower(F.substring(g(_N + 6), 1, 1))
    df = df.select(
        *[c for c in df.columns if c not in ("__p",)],
        F.when(hit, F.struct(
            num(y).alias("y"), m.alias("m"), num(d).alias("d"), num(h).alias("h"),
            num(F.coalesce(g(_N + 2), g(_N + 4))).alias("mi"), F.coalesce(num(g(_N + 3)), num(g(_N + 5)), F.lit(0)).alias("s"),
            half.alias("half"), g(_N + 7).alias("zone"),
        )).alias("__f"),
    )
    f = lambda k: F.col(f"__f.{k}")
    hour = (
        F.when(f("half").isNull(), F.when(f("h") <= 23, f("h")))
        .when(f("h").between(1, 12), f("h") % 12 + F.when(f("half") == "p", 12).otherwise(0))
    )
    time_ok = F.col("__hour").isNotNull() & (f("mi") <= 59) & (f("s") <= 59)
    # strict: a day that doesn't exist gives null
    day = F.try_to_date(F.concat_ws("-", f("y").cast("string"), f("m").cast("string"), f("d").cast("string")), "y-M-d")
    df = df.withColumn("__hour", hour).withColumn("__date", F.when(f("h").isNull() | time_ok, day))
    epoch = F.when(F.col("__t").rlike(r"^\d{10}$"), F.col("__t").try_cast("long")).when(
        F.col("__t").rlike(r"^\d{13}$"), F.floor(F.col("__t").try_cast("long") / 1000)
    )
    at = F.col("__date")
    return df.select(
        *[c for c in df.columns if c not in ("__t", "__f", "__hour", "__date")],
        at.cast("string").alias("__day"),
        F.when(f("h").isNotNull(), F.unix_date(at).cast("long") * 86400 + F.col("__hour") * 3600 + f("mi") * 60 + f("s")).alias("__local"),
        epoch.alias("__epoch"),
        F.when(at.isNotNull(), f("zone")).alias("__zone"),
        F.when(at.isNotNull(), f("y")).alias("__year"),
    )


def _later(year: Column, what: Callable[[int], int]) -> Column:
    """A number of the year of the table that a later year is like, by its kind."""
    kinds = range(zones.LAST_YEAR - zones.CYCLE + 1, zones.LAST_YEAR + 1)
    leap = F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) == 366
    weekday = F.weekday(F.make_date(year, F.lit(1), F.lit(1)))
    first = {(datetime(y, 12, 31).timetuple().tm_yday == 366, datetime(y, 1, 1).weekday()): y for y in kinds}
    table = F.array(*[F.lit(what(first[k, w])) for k in (False, True) for w in range(7)])
    return F.get(table, weekday + F.when(leap, 7).otherwise(0))


def normal_form(spark: SparkSession, df: DataFrame, value: str, zone: str, date_order: str, day_only: str, row_zones: list[str] | None = None) -> DataFrame:
    """Adds ``normal_form``: UTC ``YYYY-MM-DDTHH:MM:SSZ`` where the text has a time of day (or is an epoch number of
    10 or 13 digits), else ``YYYY-MM-DD``; null where it can't be read.

    ``zone`` names the column with the row's own IANA zone, ``date_order`` the one with MDY or DMY, ``day_only`` a
    boolean column: true gives the day as written, whatever time follows.  A zone name, an abbreviation used in
    the row's zone or an offset in the text counts before the row's zone.  Can't be read: null, blank, impossible
    dates or times, two-digit years, numeric dates with ``/`` or local times where the row's order or zone is
    missing, abbreviations that the row's zone doesn't use.  Adds ``zone_matches``, too: how many zone-offset intervals
    a local time without an offset of its own matches (2: ambiguous, 0: nonexistent), null for all other values.

    The names of zones are few (the IANA list bounds them), so the distinct ones in use are gathered on the driver
    to build the interval table, and that table is broadcast.  ``row_zones`` spares a scan for those of ``zone``.
    """
    p = parse(df, value, date_order)
    wanted = F.coalesce(F.regexp_extract("__zone", r"^\[(.+)\]$", 1), F.lit(""))
    known = spark.createDataFrame([(z,) for z in sorted(zones.known_zones())], "z string")
    bracketed = df.where(F.col(value).contains("[")).select(F.regexp_extract(value, r"\[([A-Za-z0-9_+/-]+)\]", 1).alias("z"))
    named = bracketed if row_zones is not None else bracketed.unionByName(df.select(F.col(zone).alias("z")))
    found = {r.z for r in named.distinct().join(F.broadcast(known), "z", "left_semi").collect()}
    names = sorted(found | set(row_zones or ()) & zones.known_zones())
    segments = spark.createDataFrame(zones.local_segments(names).astype(object).where(lambda t: t.notna(), None), "zone string, local_year int, local_lo long, local_hi long, matches int, first_s int, before_s int")
    abbrs = spark.createDataFrame(zones.abbreviations(names), "zone string, abbr string, offset_s int")
    z = F.col("__zone")
    sign = F.when(z.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(z, r"[^0-9]", "")
    hh, mm = F.substring(digits, 1, 2).try_cast("int"), F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    written = F.when(F.upper(z).isin("Z", "UTC", "GMT"), 0).when(
        z.rlike(r"^[+-]\d") & (hh <= 18) & (mm <= 59), sign * (hh * 3600 + mm * 60)
    )
    p = p.withColumn("__written", written).withColumn(
        "__az", F.when(z.rlike(r"^[A-Za-z]{2,5}$") & F.col("__written").isNull(), F.col(zone))
    ).withColumn("__abbr", F.upper(z)).withColumn(
        "__lz", F.when(z.isNull(), F.col(zone)).when(z.startswith("["), wanted)
    )
    # years beyond the table are read as the one of it that is like them
    year, local = F.col("__year"), F.when(~F.col(day_only), F.col("__local"))
    like = _later(year, lambda y: y)
    back = F.unix_date(F.make_date(year, F.lit(1), F.lit(1))).cast("long") - _later(year, lambda y: (datetime(y, 1, 1) - datetime(1970, 1, 1)).days)
    late = year > zones.LAST_YEAR
    p = p.withColumn("__at_year", F.when(late, like).otherwise(F.greatest(year, F.lit(zones.FIRST_YEAR - 1)))).withColumn("__at", F.when(late, local - back * 86400).otherwise(local))
    a, s = abbrs.alias("a"), segments.alias("s")
    j = p.alias("p").join(
        F.broadcast(a), (F.col("p.__az") == F.col("a.zone")) & (F.col("p.__abbr") == F.col("a.abbr")), "left"
    ).join(
        F.broadcast(s),
        (F.when(F.col("p.__at").isNotNull(), F.col("p.__lz")) == F.col("s.zone"))
        & (F.col("p.__at_year") == F.col("s.local_year"))
        & (F.col("p.__at") >= F.col("s.local_lo"))
        & (F.col("p.__at") < F.col("s.local_hi")),
        "left",
    )
    matched = F.col("s.matches")
    local_offset = F.when(matched == 0, F.col("s.before_s")).when(matched >= 1, F.col("s.first_s"))
    offset = F.coalesce(F.col("p.__written"), F.col("a.offset_s"), local_offset)
    utc = F.when(~F.col(f"p.{day_only}"), F.coalesce("p.__epoch", F.col("p.__local") - offset))
    out = j.select(*[F.col(f"p.`{c}`") for c in df.columns], utc.alias("__utc"), F.when(F.col(f"p.{day_only}") | F.col("p.__local").isNull(), F.col("p.__day")).alias("__as_day"), matched.alias("zone_matches"))
    return out.select(*df.columns, F.coalesce(utc_text(F.col("__utc")), F.col("__as_day")).alias("normal_form"), "zone_matches")


def chart_timestamps(spark: SparkSession, tables: dict[str, tuple[DataFrame, str, bool]], sites: DataFrame) -> DataFrame:
    """``(source_table, row_id, normal_form)`` of every readable value that isn't in its normal form already.

    ``tables``: name -> (table, field, whether only its day counts).
    """
    every = None
    for name, (df, field, day_only) in tables.items():
        one = df.select(F.lit(name).alias("source_table"), "row_id", "site_code", F.col(field).alias("__value"), F.lit(day_only).alias("__day_only")).where(F.col("__value").isNotNull())
        every = one if every is None else every.unionByName(one)
    site = sites.select("site_code", "tz_name", "date_order").dropDuplicates(["site_code"])
    rows = every.join(site, "site_code", "left")
    names = [r.tz_name for r in site.select("tz_name").distinct().collect()]
    out = normal_form(spark, rows, "__value", "tz_name", "date_order", "__day_only", names)
    return out.where(F.col("normal_form").isNotNull() & (F.col("normal_form") != F.col("__value"))).select("source_table", "row_id", "normal_form")
