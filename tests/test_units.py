import pytest

from chartweave.operators.units import common_units, number_of, read_quantity

CASES = [
    ("0,4 litre", None, False, ("mL", 400_000)), ("6E+02", "µg", False, ("mg", 600)), ("700", "μg", False, ("mg", 700)), ("1", "G", False, ("mg", 1_000_000)), ("195mg.", "", False, ("mg", 195_000)),
    ("2280ml/24 hr", "", True, ("mL/hr", 95_000)), ("49", "drops/min @ 20 drops/mL", True, ("mL/hr", 147_000)), ("12 gtt/min (60 gtt/mL)", "", True, ("mL/hr", 12_000)),
    ("33", "microdrops/min, 60 drops per mL", True, ("mL/hr", 33_000)), ("2,328", "mL/24h", True, ("mL/hr", 97_000)), ("0.72", "L/day", True, ("mL/hr", 30_000)), ("3,5", "mg per minute", True, ("mg/hr", 210_000)),
    ("475", "mcg/hr", True, ("mg/hr", 475)), ("5", "grams per hour", True, ("mg/hr", 5_000_000)), ("1.5", "dL", False, ("mL", 150_000)), ("190", "cc", False, ("mL", 190_000)), ("4", "mg", False, None), ("4.5", "mL/hr", True, None),
    (" 4", "mg", False, ("mg", 4000)), ("4", "MG", False, ("mg", 4000)), ("4e1", "mg", False, ("mg", 40_000)), ("4 mg", None, False, ("mg", 4000)), ("57", "mcg/kg/min", True, None), ("17", "mg/m2", False, None), ("27", "mEq/hr", True, None),
    ("5", "tablet", False, None), ("5", None, False, None), ("see order", "mg", False, None), ("5-10", "mg", False, None), ("5 10", "mg", False, None), ("", "mg", False, None), (None, "mg", False, None), ("5", "mg", True, None), ("5", "mg/hr", False, None),
    ("1,234.5", "mg", False, ("mg", 1_234_500)), ("9" * 400, "mg", False, None), ("5", "mg" * 3000, False, None), ("5", "min", False, None), ("5", "mgx", False, None), ("8 gtt/min", None, True, None), ("5.", "mg", False, ("mg", 5000)),
    ("about 5 g", "", False, ("mg", 5_000_000)), ("Dose: 5", "g", False, ("mg", 5_000_000)), ("~ 2 L/day", None, True, ("mL/hr", 83_333)), ("dose 5 to 6 g", None, False, None), ("of 5", "tablet", False, None),
    ("30 gtt/min (15.1234 gtt/mL)", "", True, ("mL/hr", 119_021)), ("9000000000000000", "mgs", False, ("mg", 9_000_000_000_000_000_000)), ("9300000000000000", "mg", False, None), ("12345678901234567890", "ng", False, ("mg", 12_345_678_901_234_568)),
    ("0.00000000049", "g", False, ("mg", 0)), ("1.0000000005", "g", False, ("mg", 1_000_000)), ("1.0000004999999999999", "g", False, ("mg", 1_000_000)), ("1.0000005", "g", False, ("mg", 1_000_001)), ("1e15", "mcg", False, ("mg", 10**15)), ("48 mL/1234567.5 min", None, True, ("mL/hr", 2)),
]


def test_quantities(spark):
    for rate in (False, True):
        cases = [(i, v, u) for i, (v, u, r, _) in enumerate(CASES) if r is rate]
        df = spark.createDataFrame([(i, v, u, "mg", 3) for i, v, u in cases], "row_id long, v string, u string, unit string, number int")
        got = {r.row_id: (r.common_unit, r.value_thousandths) for r in common_units(spark, [(df, "t", "f", "v", "u", rate)]).collect()}
        assert got == {i: CASES[i][3] for i, *_ in cases if CASES[i][3]}


def test_empty_tables_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "1 g", None)] * 3, "row_id long, v string, u string")
    assert [r.value_thousandths for r in common_units(spark, [(df, "t", "f", "v", "u", False), (df.limit(0), "e", "f", "v", "u", True)]).collect()] == [1_000_000] * 3


@pytest.mark.parametrize(("text", "want"), [("1,234", "1234"), ("1,23", "1.23"), ("12,345,678.5", "12345678.5"), ("1.5e-2", "0.015"), ("1e3", "1000"), ("+5", "5"), (".5", "0.5"), ("1,2,3", None), ("", None), ("1e999", None), ("5,", None)])
def test_numbers(text, want):
    assert number_of(text) == want


def test_the_unit_in_the_value_counts_first():
    assert read_quantity("5 g", "mg", False)[1] == "g"
