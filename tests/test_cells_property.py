"""Property test: Spark cell parsers agree with a plain-Python statement of the rules."""

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from envtrack import schema as S
from envtrack.functions.cells import is_missing, parse_bool, parse_epoch, parse_float

NUM = re.compile(S.NUMBER_PATTERN)
INF = re.compile(S.INF_PATTERN)
NAN = re.compile(S.NAN_PATTERN)


def clean(x):
    return x.strip(S.WHITESPACE).lower()


def py_missing(x):
    return x is None or clean(x) in S.MISSING_TOKENS or bool(NAN.match(clean(x)))


def py_number(t):
    if NUM.match(t):
        return float(t)
    if INF.match(t):
        return -math.inf if t.startswith("-") else math.inf
    return None


def py_float(x):
    if py_missing(x):
        return None, S.ISSUE_MISSING
    t = clean(x)
    v = 1.0 if t in S.TRUE_WORDS_FLOAT else 0.0 if t in S.FALSE_WORDS_FLOAT else py_number(t)
    return v, (None if v is not None else S.ISSUE_NUMERIC)


def py_bool(x):
    if py_missing(x):
        return None, S.ISSUE_MISSING
    t = clean(x)
    n = py_number(t)
    v = (True if t in S.TRUE_WORDS_BOOL else False if t in S.FALSE_WORDS_BOOL
         else True if n == 1.0 else False if n == 0.0 else None)
    return v, (None if v is not None else S.ISSUE_BOOLEAN)


digits = st.text("0123456789", min_size=1, max_size=6)
number_text = st.builds(lambda s, a, b, e: f"{s}{a}{b}{e}", st.sampled_from(["", "+", "-"]), digits,
                        st.sampled_from(["", ".", ".5", ".25", ".000"]),
                        st.sampled_from(["", "e3", "E-2", "e+1"]))
words = st.sampled_from(S.MISSING_TOKENS + S.TRUE_WORDS_BOOL + S.FALSE_WORDS_BOOL
                        + ["inf", "-Infinity", "+nan", "NaN", "1d", "0x1p3", "1_000", "maybe", "bad-value", "2", "1.0"])
cased = words.flatmap(lambda w: st.sampled_from([w, w.upper(), w.capitalize()]))
padded = st.builds(lambda l, x, r: l + x + r, st.sampled_from(["", " ", "\t", "  "]), st.one_of(number_text, cased),
                   st.sampled_from(["", " ", "\n"]))
cells = st.lists(st.one_of(st.none(), padded, st.text(max_size=5)), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None)
@given(cells)
def test_parsers_agree_with_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    fv, fi = parse_float(F.col("x"))
    bv, bi = parse_bool(F.col("x"))
    rows = df.select(fv.alias("fv"), fi.alias("fi"), bv.alias("bv"), bi.alias("bi"),
                     is_missing(F.col("x")).alias("m"), parse_epoch(F.col("x")).alias("e")).collect()
    for v, r in zip(values, rows):
        assert (r["fv"], r["fi"]) == py_float(v), repr(v)
        assert (r["bv"], r["bi"]) == py_bool(v), repr(v)
        assert r["m"] == py_missing(v), repr(v)
        want_e = None if py_missing(v) or not NUM.match(clean(v)) else float(clean(v))
        assert r["e"] == want_e, repr(v)
