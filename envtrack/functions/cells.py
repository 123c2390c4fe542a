"""Cell-level parsers for raw text readings (all native column expressions, no UDF).

Every parser takes a string column and returns column expressions; nothing here triggers a job.
Rules:

* missing: null, or trimmed lower-case text in ``MISSING_TOKENS``, or any spelling of NaN;
* numbers: only strict decimal text (``NUMBER_PATTERN``) is cast, so the result does not depend
  on what a given engine's cast happens to accept (``1d``, ``0x1p3``, ``1_000`` are invalid);
* ``inf``/``infinity`` with an optional sign are accepted as numbers;
* float fields also accept ``true/yes`` (1.0) and ``false/no`` (0.0);
* bool fields accept ``true/1/yes``, ``false/0/no`` and numeric text equal to 1 or 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from envtrack import schema as S


def clean_text(c: Column) -> Column:
    """Trim ASCII whitespace and lower-case."""
    return F.lower(F.trim(c, F.lit(S.WHITESPACE)))


def is_missing(c: Column) -> Column:
    """True for null, blank, NA-like tokens and NaN spellings (never null itself)."""
    t = clean_text(c)
    return c.isNull() | t.isin(S.MISSING_TOKENS) | t.rlike(S.NAN_PATTERN)


def strict_number(t: Column) -> Column:
    """Double value of already-cleaned text, or null when it is not strict number text."""
    signed_inf = F.when(t.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (
        F.when(t.rlike(S.NUMBER_PATTERN), t.try_cast("double"))
        .when(t.rlike(S.INF_PATTERN), signed_inf)
    )


def missing_from_clean(c: Column, t: Column) -> Column:
    """``is_missing`` given the raw cell and its cleaned text."""
    return c.isNull() | t.isin(S.MISSING_TOKENS) | t.rlike(S.NAN_PATTERN)


def float_from_parts(t: Column, missing: Column, num: Column) -> Column:
    """Float value from cleaned text, the missing test and ``strict_number`` of the text."""
    return (
        F.when(missing, F.lit(None).cast("double"))
        .when(t.isin(S.TRUE_WORDS_FLOAT), F.lit(1.0))
        .when(t.isin(S.FALSE_WORDS_FLOAT), F.lit(0.0))
        .otherwise(num)
    )


def bool_from_parts(t: Column, missing: Column, num: Column) -> Column:
    """Boolean value from cleaned text, the missing test and ``strict_number`` of the text."""
    return (
        F.when(missing, F.lit(None).cast("boolean"))
        .when(t.isin(S.TRUE_WORDS_BOOL), F.lit(True))
        .when(t.isin(S.FALSE_WORDS_BOOL), F.lit(False))
        .when(num == 1.0, F.lit(True))
        .when(num == 0.0, F.lit(False))
    )


def issue_from_parts(missing: Column, value: Column, invalid_kind: str) -> Column:
    """``missing_measurement`` / ``invalid_*`` / null."""
    return F.when(missing, F.lit(S.ISSUE_MISSING)).when(value.isNull(), F.lit(invalid_kind))


def parse_float(c: Column) -> tuple[Column, Column]:
    """(value double, issue string) for a float measurement cell."""
    t = clean_text(c)
    missing = is_missing(c)
    value = float_from_parts(t, missing, strict_number(t))
    return value, issue_from_parts(missing, value, S.ISSUE_NUMERIC)


def parse_bool(c: Column) -> tuple[Column, Column]:
    """(value boolean, issue string) for a boolean measurement cell."""
    t = clean_text(c)
    missing = is_missing(c)
    value = bool_from_parts(t, missing, strict_number(t))
    return value, issue_from_parts(missing, value, S.ISSUE_BOOLEAN)


def epoch_number(t: Column) -> Column:
    """Epoch number of cleaned ``ts`` text; only strict decimal text (infinity is never a time)."""
    return F.when(t.rlike(S.NUMBER_PATTERN), t.try_cast("double"))


def parse_epoch(c: Column) -> Column:
    """Raw epoch number of a ``ts`` cell (null when missing or not strict number text)."""
    return F.when(~is_missing(c), epoch_number(clean_text(c)))


def epoch_seconds(x: Column) -> Column:
    """Seconds since the epoch: values above 1e12 are milliseconds."""
    return F.when(x > S.MILLIS_CUTOFF, x / 1000.0).otherwise(x)


def epoch_in_range(x: Column) -> Column:
    """Finite and inside the years 1..9999 after scaling (never null).

    Values up to 1e12 are seconds, so the valid ones lie in [MIN, MAX]; larger values are
    milliseconds, valid up to MAX * 1000. Both intervals are tested on the raw number.
    """
    lo, hi = S.MIN_EPOCH_SECONDS, S.MAX_EPOCH_SECONDS
    return F.coalesce(x.between(lo, hi) | x.between(S.MILLIS_CUTOFF, hi * 1000.0) & (x != S.MILLIS_CUTOFF),
                      F.lit(False))


def epoch_to_micros(x: Column) -> Column:
    """Microseconds since the epoch, rounded (only call on values that passed ``epoch_in_range``)."""
    return F.round(epoch_seconds(x) * 1e6).cast("bigint")
