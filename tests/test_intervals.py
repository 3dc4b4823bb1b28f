"""Periods and gaps against painting of days."""

from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chartweave.operators.intervals import order_periods

BASE = date(2022, 1, 1)


def brute(rows):
    painted = {}
    for key, a, z in rows:
        if a is not None and z is not None and a <= z:
            painted.setdefault(key, set()).update(range(a, z + 1))
    out = set()
    for key, days in painted.items():
        ordered, start = sorted(days), None
        for i, x in enumerate(ordered):
            start = x if start is None else start
            if i + 1 == len(ordered) or ordered[i + 1] > x + 1:
                out.add((key, "period", start, x))
                if i + 1 < len(ordered):
                    out.add((key, "gap", x + 1, ordered[i + 1] - 1))
                start = None
    return out


day = st.one_of(st.none(), st.integers(0, 40))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), day, day), max_size=40))
def test_like_painted_days(spark, rows):
    text = lambda d: None if d is None else str(BASE + timedelta(days=d))
    df = spark.createDataFrame([("p", k, text(a), text(z), "x", 1) for k, a, z in rows], "patient_id string, medication string, start_date string, end_date string, kind string, __day int")
    got = {(r.medication.lower(), r.kind, (date.fromisoformat(r.first_day) - BASE).days, (date.fromisoformat(r.last_day) - BASE).days) for r in order_periods(df).collect()}
    assert got == brute(rows)


def test_names_are_folded_times_ignored_and_bad_rows_left_out(spark):
    rows = [
        ("1", " Aspirin  81 ", "2022-01-01", "2022-01-02 10:00"), ("1", "ASPIRIN 81", "2022-01-03T08:00:00", "2022-01-03"), ("1", "aspirin 81", "2022-01-03", "2022-01-03"),
        ("1", "aspirin 81", "2022-02-30", "2022-03-01"), ("1", "aspirin 81", "2022-02-05", "2022-02-01"), ("1", None, "2022-01-01", "2022-01-02"), (None, "x", "2022-01-01", "2022-01-02"), ("1", " ", "2022-01-01", "2022-01-02"),
        ("2", "b", "x" * 4000, "2022-01-02"), ("2", "b", "", None),
    ]
    df = spark.createDataFrame(rows, "patient_id string, medication string, start_date string, end_date string")
    assert [tuple(r) for r in order_periods(df).collect()] == [("1", "ASPIRIN 81", "period", "2022-01-01", "2022-01-03")]
    assert order_periods(df.limit(0)).collect() == []


def test_a_hot_entity_is_combined_to_days_before_it_is_sorted(spark):
    df = spark.range(200_000).selectExpr("'p' as patient_id", "'m' as medication", "cast(date_add(date '2022-01-01', cast(id % 300 as int) * 2) as string) as start_date", "cast(date_add(date '2022-01-01', cast(id % 300 as int) * 2) as string) as end_date")
    out = order_periods(df)
    assert out.where("kind = 'period'").count() == 300 and out.where("kind = 'gap'").count() == 299
    assert "partial_sum" in out._jdf.queryExecution().toString()
