"""The partial-date truth table against enumeration of days, and three-valued filters."""

from calendar import monthrange
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from chartweave.functions import dates
from chartweave.plans.filters import Filter, drop_statistics, kept, kept_or_all, stop_gate, with_template_values

VALUES = ["2020-03-15", "2020-03-15T10:00:00", "2020-03-XX", "2020-XX-XX", "2019-12-31", "2020-02-XX", "2020-02-30", "2020-XX-15", "spring", "", None]


def days(v):
    if v is None or not v.strip() or v in ("spring", "winter", "2020-02-30"):
        return None
    y, m, d = int(v[:4]), v[5:7], v[8:10]
    lo = date(y, 1 if m == "XX" else int(m), 1 if d == "XX" else int(d))
    mm = 12 if m == "XX" else int(m)
    hi = date(y, mm, monthrange(y, mm)[1] if d == "XX" else int(d))
    return [lo + timedelta(days=k) for k in range((hi - lo).days + 1)]


@pytest.mark.parametrize("op", ["==", "!=", "<", "<=", ">", ">="])
def test_every_pair_of_dates(spark, op):
    import operator

    f = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}[op]
    rows = [(i, v) for i, v in enumerate(VALUES)]
    df = spark.createDataFrame(rows, "i int, document_date string")
    for target in ("2020-03-15", "2020-03-XX", "2020-XX-XX", "winter"):
        for keep in (False, True):
            want = set()
            for i, v in rows:
                a, b = days(v), days(target)
                if v is None or not v.strip():
                    ok = keep
                elif a and b:
                    ok = (a[0] <= b[-1] and b[0] <= a[-1]) if op == "==" else not (len(a) == len(b) == 1 and a == b) if op == "!=" else any(f(x, y) for x in (a[0], a[-1]) for y in (b[0], b[-1]))
                elif op in ("==", "!="):
                    ok = f(v.strip().lower(), target)
                else:
                    ok = keep
                if ok:
                    want.add(i)
            assert {r.i for r in kept(df, [Filter("document_date", op, target, keep)]).collect()} == want, (target, keep)


def test_text_and_number_filters(spark):
    df = spark.createDataFrame([(1, " 62.0 ", "Progress Notes"), (2, "nan", "PROGRESS"), (3, "x", None), (4, None, " "), (5, "1e400", "letter")], "i int, age string, doc_type string")
    ids = lambda *f: sorted(r.i for r in kept(df, list(f)).collect())
    assert ids(Filter("age", "==", 62)) == [1] and ids(Filter("age", "in", [1, "62"])) == [1] and ids(Filter("age", "<", 100, True)) == [1, 2, 3, 4, 5]
    assert ids(Filter("doc_type", "contains", "progress")) == [1, 2] and ids(Filter("doc_type", "in", ["Letter "])) == [5] and ids(Filter("age", ">", "many")) == []
    assert ids(Filter("doc_type", "not_contains", "progress", True)) == [3, 4, 5] and ids(Filter("doc_type", "!=", "LETTER")) == [1, 2]
    got = [tuple(r) for r in drop_statistics(df, [Filter("age", ">", 60), Filter("doc_type", "==", "x")], "i").orderBy("filter_index").collect()]
    assert got == [(0, 4, 1, 3, 2), (1, 1, 0, 0, 1)]
    assert sorted((r.i, r.fell_back) for r in kept_or_all(df, [Filter("age", ">", 60)], ["doc_type"]).collect()) == [(1, False), (2, True), (3, True), (4, True), (5, True)]
    for bad in (Filter("age", "~", 1), Filter("nope", "==", 1), Filter("title", "<", 1), Filter("age", "in", 3)):
        with pytest.raises(ValueError):
            bad.checked()


def test_template_values_and_stop(spark):
    df = spark.createDataFrame([("p", "a note"), ("q", "a note"), ("r", "other"), (None, "other")], "patient string, title string")
    values = spark.createDataFrame([("p", "note"), ("q", "unknown"), ("r", " ")], "patient string, v string")
    out = with_template_values(df, Filter("title", "contains", None), values, ["patient"], "v")
    assert sorted((r.patient or "", r.filter_skipped) for r in out.collect()) == [("", True), ("p", False), ("q", True), ("r", True)]
    assert stop_gate(df, "title = 'other'").count() == 2 and stop_gate(df, "no_such_column > 1").count() == 4


def test_dates_that_refuse(spark):
    df = spark.createDataFrame([("2020-03-XX", "2020-04-01"), ("2020-03-XX", "2020-03-20"), ("2020-05-01", "2020-XX-XX"), ("2021-01-01", "2020-XX-XX"), ("x", "2020-01-01")], "a string, b string")
    assert [r[0] for r in df.select(dates.strictly_before(F.col("a"), F.col("b"))).collect()] == [True, None, None, False, None]
    assert [r[0] for r in df.select(dates.month_number(F.col("a"))).collect()] == [2020 * 12 + 2, 2020 * 12 + 2, 2020 * 12 + 4, 2021 * 12, None]
    assert [r[0] for r in df.select(dates.sort_key(F.col("a"))).collect()] == [20200300, 20200300, 20200501, 20210101, None]
    assert df.select(dates.sort_key(F.col("a"), True)).first()[0] == 20200399
    c = spark.createDataFrame([("5/3/2021",), ("05/03/2021 14:05",), ("2021-05-03T14:05:06+02:00",), ("2021-05-03T14:05:06Z",), ("2021-13-03",), ("5/3/21",), ("word",), (None,)], "v string")
    assert [r[0] for r in c.select(dates.canonical(F.col("v"))).collect()] == ["2021-05-03", "2021-05-03T14:05:00+00:00", "2021-05-03T14:05:06+02:00", "2021-05-03T14:05:06+00:00", "2021-13-03", "5/3/21", "word", None]


def test_a_stop_expression_never_fails_a_query(spark):
    from chartweave.plans.filters import stop_gate

    df = spark.createDataFrame([(1, "abc"), (2, "5"), (3, None), (4, "1")], "id int, v string")
    assert sorted(r.id for r in stop_gate(df, "cast(v as int) > 3").collect()) == [1, 3, 4] and sorted(r.id for r in stop_gate(df, "1 / (id - 1) > 0.9").collect()) == [1, 3, 4]
    assert stop_gate(df, "no_such_column > 1").count() == 4 and spark.conf.get("spark.sql.ansi.enabled") == "true"
