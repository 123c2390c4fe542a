"""Edge-cell tables for the parsers."""

import math

import pytest
from pyspark.sql import functions as F

from envtrack.functions.cells import is_missing, parse_bool, parse_epoch, parse_float

FLOAT_CASES = [
    (None, None, "missing_measurement"),
    ("", None, "missing_measurement"),
    ("   ", None, "missing_measurement"),
    ("N/A", None, "missing_measurement"),
    ("na", None, "missing_measurement"),
    ("NULL", None, "missing_measurement"),
    ("+nan", None, "missing_measurement"),
    ("-NaN", None, "missing_measurement"),
    (" 3.5 ", 3.5, None),
    ("\t2\n", 2.0, None),
    ("1e3", 1000.0, None),
    ("-.5", -0.5, None),
    ("5.", 5.0, None),
    ("inf", math.inf, None),
    ("-Infinity", -math.inf, None),
    ("YES", 1.0, None),
    ("false", 0.0, None),
    ("1_000", None, "invalid_numeric"),
    ("1d", None, "invalid_numeric"),
    ("0x1p3", None, "invalid_numeric"),
    ("bad-value", None, "invalid_numeric"),
    ("1.2.3", None, "invalid_numeric"),
]

BOOL_CASES = [
    (None, None, "missing_measurement"),
    ("n/a", None, "missing_measurement"),
    ("true", True, None),
    (" TRUE ", True, None),
    ("1", True, None),
    ("1.0", True, None),
    ("yes", True, None),
    ("0", False, None),
    ("0.0", False, None),
    ("No", False, None),
    ("2", None, "invalid_boolean"),
    ("maybe", None, "invalid_boolean"),
    ("1d", None, "invalid_boolean"),
]


def _run(spark, cases, fn):
    df = spark.createDataFrame([(c[0],) for c in cases], "x string")
    v, i = fn(F.col("x"))
    return df.select(v.alias("v"), i.alias("i")).collect()


@pytest.mark.parametrize("kind", ["float", "bool"])
def test_parser_tables(spark, kind):
    cases, fn = (FLOAT_CASES, parse_float) if kind == "float" else (BOOL_CASES, parse_bool)
    got = _run(spark, cases, fn)
    for (text, value, issue), row in zip(cases, got):
        assert row["i"] == issue, text
        if value is None:
            assert row["v"] is None, text
        else:
            assert row["v"] == value, text


def test_missing_and_epoch(spark):
    df = spark.createDataFrame([("",), ("nan",), ("1594512094.0",), ("1594512094385",), ("x",), ("inf",)], "x string")
    rows = df.select(is_missing(F.col("x")).alias("m"), parse_epoch(F.col("x")).alias("e")).collect()
    assert [r["m"] for r in rows] == [True, True, False, False, False, False]
    assert rows[2]["e"] == 1594512094.0 and rows[3]["e"] == 1594512094385.0
    assert rows[4]["e"] is None and rows[5]["e"] is None  # infinity is never a time
