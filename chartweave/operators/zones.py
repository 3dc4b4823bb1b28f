"""Zone-offset intervals: which UTC offset a zone's wall clock had when."""

from __future__ import annotations

import functools
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo, available_timezones

import pandas as pd

#: No zone changed its offset before 1800, and from 2101 on all follow a rule by weekdays, so that the 28 years up to 2128 hold
#: each kind of year (leap or not, by the weekday it begins with) that may come later.
FIRST_YEAR, LAST_YEAR, CYCLE = 1800, 2128, 28
FAR = 1 << 60
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def known_zones() -> set[str]:
    return available_timezones()


def _offset(zone: ZoneInfo, second: int) -> tuple[int, str]:
    t = (EPOCH + timedelta(seconds=second)).astimezone(zone)
    return int(t.utcoffset().total_seconds()), t.tzname()


@functools.lru_cache(maxsize=None)
def utc_intervals(name: str) -> tuple[tuple[int, int, int, str], ...]:
    """``(from_utc, to_utc, offset, abbreviation)`` in seconds, without holes, over FIRST_YEAR..LAST_YEAR."""
    zone, step = ZoneInfo(name), 14 * 86400
    a = int((datetime(FIRST_YEAR, 1, 1, tzinfo=timezone.utc) - EPOCH).total_seconds())
    z = int((datetime(LAST_YEAR + 1, 1, 1, tzinfo=timezone.utc) - EPOCH).total_seconds())
    out, begun, now = [], a, _offset(zone, a)
    t = a
    while t < z:
        n = min(t + step, z)
        then = _offset(zone, n)
        if then != now:
            lo, hi = t, n
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if _offset(zone, mid) == now else (lo, mid)
            out.append((begun, hi, *now))
            begun, now, n = hi, _offset(zone, hi), hi
        t = n
    return (*out, (begun, z, *now))


def _day(y: int) -> int:
    return int((datetime(y, 1, 1, tzinfo=timezone.utc) - EPOCH).total_seconds())


def local_segments(names: list[str]) -> pd.DataFrame:
    """Elementary stretches of wall-clock time, exploded by calendar year.

    Every zone-offset interval covers ``[from + offset, to + offset)`` of local time.  The boundaries of all
    intervals of a zone cut its local time into stretches; of each stretch ``matches`` counts the intervals
    that cover it: 1 gives its offset, 2 is an ambiguous stretch, 0 a nonexistent one.  ``first_s`` is the offset
    of the first interval that covers it (null if none does), ``before_s`` that of the last one before it.  As the
    stretches don't overlap, an as-of join finds exactly one for each local time.  All years before FIRST_YEAR
    are in the stretch of the year before it.
    """
    rows = []
    for name in names:
        its = [(a + o, b + o, o) for a, b, o, _ in utc_intervals(name)]
        its[0], its[-1] = (_day(FIRST_YEAR - 1), *its[0][1:]), (its[-1][0], _day(LAST_YEAR + 1), its[-1][2])
        cuts = sorted({x for a, b, _ in its for x in (a, b)})
        for lo, hi in zip(cuts, cuts[1:]):
            cover = [o for a, b, o in its if a <= lo and hi <= b]
            before = [o for a, b, o in its if b <= lo]
            y0 = (EPOCH + timedelta(seconds=lo)).year
            y1 = (EPOCH + timedelta(seconds=hi - 1)).year
            for y in range(y0, y1 + 1):
                rows.append((name, y, -FAR if y < FIRST_YEAR else max(lo, _day(y)), min(hi, _day(y + 1)), len(cover), cover[0] if cover else None, before[-1] if before else None))
    out = pd.DataFrame(rows, columns=["zone", "local_year", "local_lo", "local_hi", "matches", "first_s", "before_s"])
    return out.astype({"first_s": "Int64", "before_s": "Int64"})


def abbreviations(names: list[str]) -> pd.DataFrame:
    """``(zone, abbr, offset_s)``: the latest offset that each alphabetic abbreviation stood for in a zone."""
    rows = {(n, ab): o for n in names for _, _, o, ab in utc_intervals(n) if ab.isalpha()}
    return pd.DataFrame([(n, ab, o) for (n, ab), o in rows.items()], columns=["zone", "abbr", "offset_s"])
