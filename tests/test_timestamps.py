"""Timestamps against an independent reading with zoneinfo."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from chartweave.operators.timestamps import chart_timestamps, normal_form
from chartweave.operators.zones import abbreviations, local_segments

SITES = [("NY", "America/New_York", "MDY"), ("BE", "Europe/Berlin", "DMY"), ("PH", "America/Phoenix", "MDY"), ("KO", "Asia/Kolkata", "DMY"), ("AD", "Australia/Adelaide", "DMY"), ("NO", None, None)]
ZONES = {s: z for s, z, _ in SITES}


def read(spark, rows, day_only=False):
    df = spark.createDataFrame([(i, v, ZONES[s], dict((a, o) for a, _, o in SITES)[s], day_only, "clash") for i, (v, s) in enumerate(rows)], "i int, v string, tz string, ord string, d boolean, zone string")
    return [r.normal_form for r in normal_form(spark, df, "v", "tz", "ord", "d").orderBy("i").collect()]


def brute(local: datetime, zone: str) -> str:
    """First of an ambiguous time, the offset before the change for a skipped one."""
    z = ZoneInfo(zone)
    a = local.replace(tzinfo=z, fold=0)
    return (local - a.utcoffset()).replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


@pytest.mark.parametrize("site", ["NY", "BE", "PH", "KO", "AD"])
def test_every_half_hour_around_the_changes(spark, site):
    times = []
    for start in (datetime(2023, 3, 11, 22), datetime(2023, 3, 25, 22), datetime(2023, 10, 28, 22), datetime(2023, 11, 4, 22), datetime(2023, 4, 1, 22), datetime(2023, 9, 30, 22), datetime(1975, 4, 6)):
        times += [start + timedelta(minutes=30 * k) for k in range(16)]
    got = read(spark, [(t.strftime("%Y-%m-%d %H:%M"), site) for t in times])
    assert got == [brute(t, ZONES[site]) for t in times]


def test_layouts(spark):
    cases = [
        ("2023-07-24T03:41:40", "NY", "2023-07-24T07:41:40Z"), (" 2022-12-28 ", "NY", "2022-12-28"), ("1610619732", "NO", "2021-01-14T10:22:12Z"),
        ("1673945423811", "BE", "2023-01-17T08:50:23Z"), ("20220626220100", "BE", "2022-06-26T20:01:00Z"), ("20240622T164900Z", "NO", "2024-06-22T16:49:00Z"),
        ("20240622", "NO", "2024-06-22"), ("02/03/2023", "NY", "2023-02-03"), ("02/03/2023", "BE", "2023-03-02"), ("02/03/2023", "NO", None), ("31/31/2023 09:00", "BE", None),
        ("2/3/2023 12:10 AM", "PH", "2023-02-03T07:10:00Z"), ("2/3/2023 12:10 PM", "PH", "2023-02-03T19:10:00Z"), ("2/3/2023 13:10 PM", "PH", None),
        ("07.10.2021 05:20", "NY", "2021-10-07T09:20:00Z"), ("February 13, 2021 6:29 PM", "NY", "2021-02-13T23:29:00Z"), ("12-JUN-2026 15:11:15", "BE", "2026-06-12T13:11:15Z"),
        ("5 Nov 2023", "NO", "2023-11-05"), ("Wed, 05 Oct 2022 00:51:00 -0330", "NO", "2022-10-05T04:21:00Z"), ("2023-06-08 23:44:00+00", "NO", "2023-06-08T23:44:00Z"),
        ("2024-11-27T22:54:15[America/Chicago]", "NO", "2024-11-28T04:54:15Z"), ("2024-11-27T22:54:15[Mars/Base]", "NY", None), ("27-Jan-2024 10:19:00 CET", "BE", "2024-01-27T09:19:00Z"),
        ("27-Jan-2024 10:19:00 CET", "NY", None), ("2024-12-03 20:22:00 GMT", "KO", "2024-12-03T20:22:00Z"), ("2024-08-17T01:40:00.845310+01:00", "NO", "2024-08-17T00:40:00Z"),
        ("2021-10-02T13:57-03:30", "NO", "2021-10-02T17:27:00Z"), ("2023-02-29", "NY", None), ("2024-05-01 25:61", "NY", None), ("2024-05-01 10:00", "NO", None), ("4/11/26", "NY", None), ("27-Sep-25", "NY", None),
        ("last Tuesday", "NY", None), ("", "NY", None), (None, "NY", None), ("x" * 5000, "NY", None), ("2021-05-02T00:34:21Z", "NO", "2021-05-02T00:34:21Z"),
    ]
    assert read(spark, [(v, s) for v, s, _ in cases]) == [w for *_, w in cases]


def test_day_only_gives_the_day_as_written(spark):
    assert read(spark, [("1949-06-04T00:00:00+01:00", "NY"), ("1966-01-18 23:59:00", "AD"), ("7/9/63", "NY"), ("19600821", "NO")], True) == ["1949-06-04", "1966-01-18", None, "1960-08-21"]


def test_years_beyond_the_table(spark):
    times = [datetime(y, m, d, h, 30) for y in (1500, 1799, 1800, 1850, 1899, 1950, 2100, 2101, 2128, 2129, 2150, 2300, 2400, 2999, 9000) for m, d, h in ((1, 1, 0), (3, 10, 2), (3, 28, 2), (5, 1, 10), (10, 27, 2), (11, 3, 1), (12, 31, 23))]
    for site in ("NY", "BE", "AD"):
        got = read(spark, [(t.strftime("%4Y-%m-%d %H:%M"), site) for t in times])
        assert got == [brute(t, ZONES[site]) for t in times]


def test_how_many_intervals_match(spark):
    df = spark.createDataFrame([(1, "2023-03-12 02:30"), (2, "2023-11-05 01:30"), (3, "2023-06-01 01:30"), (4, "2023-06-01"), (5, "2023-06-01 01:30 UTC"), (6, None)], "i int, v string").selectExpr("*", "'America/New_York' as tz", "'MDY' as ord", "false as d")
    assert [(r.zone_matches, r.normal_form) for r in normal_form(spark, df, "v", "tz", "ord", "d").orderBy("i").collect()] == [(0, "2023-03-12T07:30:00Z"), (2, "2023-11-05T05:30:00Z"), (1, "2023-06-01T05:30:00Z"), (None, "2023-06-01"), (None, "2023-06-01T01:30:00Z"), (None, None)]


def test_long_texts(spark):
    assert read(spark, [("Wednesday, 05 October 2022 00:51:00.123456789123456789 PM [America/Argentina/Buenos_Aires]", "NO"), ("2022-10-05" + " " * 3000 + "10:00", "BE")]) == [None, "2022-10-05T08:00:00Z"]
    assert read(spark, [("Wednesday, 05 October 2022 00:51:00.123456789123456789 [America/Argentina/Buenos_Aires]", "NO")]) == ["2022-10-05T03:51:00Z"]


def test_segments_of_a_zone_leave_no_hole_and_dont_overlap():
    s = local_segments(["Europe/Berlin", "America/Phoenix", "Australia/Lord_Howe"])
    for _, g in s.sort_values("local_lo").groupby("zone"):
        assert (g.local_lo.iloc[1:].to_numpy() == g.local_hi.iloc[:-1].to_numpy()).all()
        assert set(g.matches) <= {0, 1, 2}
    assert {"CET", "CEST"} <= set(abbreviations(["Europe/Berlin"]).abbr)


def test_tables_are_combined_and_normal_values_left_out(spark):
    t = spark.createDataFrame([(1, "NY", "2023-07-24T03:41:40", 1), (2, "NY", "2023-07-24", 2), (3, None, "2023-07-24 ", 3), (4, "??", None, 4)], "row_id long, site_code string, date string, zone int")
    sites = spark.createDataFrame([(s, z, o) for s, z, o in SITES if z] * 2, "site_code string, tz_name string, date_order string")
    got = {(r.source_table, r.row_id): r.normal_form for r in chart_timestamps(spark, {"t": (t, "date", False), "empty": (t.limit(0), "date", True)}, sites).collect()}
    assert got == {("t", 1): "2023-07-24T07:41:40Z", ("t", 3): "2023-07-24"}
