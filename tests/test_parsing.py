"""Text-number checks agree with Python's int() / float() (the jobs' rule)."""

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.functions import parsing as P

ODD = ["12", " 12 ", "+12", "-1", "1.5", "1e3", "1E-2", ".5", "5.", "nan", "NaN", "inf",
       "-Infinity", "1d", "1f", "0x1p3", "0x10", "abc", "", " ", "1_000", "١٢", "1 2",
       "9223372036854775807", "9223372036854775808", "+", "-", "e5", "1e", "--1"]


def py_int(s):
    try:
        int(s)
        return "_" not in s and s.strip().isascii() and -2**63 <= int(s) < 2**63
    except ValueError:
        return False


def py_float(s):
    # documented difference: digit groups with "_" are not numbers here
    try:
        float(s)
        return "_" not in s
    except ValueError:
        return False


def _eval(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn("s")).collect()]


def test_int_and_float_checks_match_python(spark):
    assert _eval(spark, ODD, P.is_int) == [py_int(s) for s in ODD]
    assert _eval(spark, ODD, P.is_float) == [py_float(s) for s in ODD]


def test_digits_check(spark):
    assert _eval(spark, ODD, P.is_digits) == [s.isdigit() and s.isascii() for s in ODD]


def test_wei_is_exact_and_drops_non_finite(spark):
    vals = ["123456789012345678901234567890", " 12 ", "1e3", "nan", "inf", "1.5", "abc"]
    got = _eval(spark, vals, P.to_wei)
    assert got[0] == Decimal("123456789012345678901234567890")
    assert got[1] == Decimal(12) and got[2] == Decimal(1000)
    assert got[3] is None and got[4] is None and got[6] is None
    assert _eval(spark, vals, P.is_wei) == [True, True, True, False, False, True, False]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.integers(-10**20, 10**20).map(str),
                          st.floats(allow_nan=False, allow_infinity=False).map(repr),
                          st.text(alphabet="0123456789+-.eE _", max_size=6)),
                min_size=1, max_size=30))
def test_random_numbers_match_python(spark, values):
    assert _eval(spark, values, P.is_int) == [py_int(s) for s in values]
    assert _eval(spark, values, P.is_float) == [py_float(s) for s in values]


@pytest.mark.parametrize("flag,expected", [("1", True), ("0", False), ("true", True),
                                           ("FALSE", False), ("x", None), (None, None)])
def test_flags(spark, flag, expected):
    df = spark.createDataFrame([(flag,)], "s string")
    assert df.select(P.to_flag("s")).first()[0] is expected
