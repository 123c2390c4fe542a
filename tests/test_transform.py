"""The reference's transformation tests, plus the golden counts of the derived fixture."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from envtrack import schema as S
from envtrack.operators.dedupe import dedupe_readings
from envtrack.operators.transform import accepted_readings, classify_rows
from envtrack.sources.fixtures import raw_readings

from conftest import SF_MID, SF_SMALL

INGESTED = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
GOOD = {"ts": "1594512094.0", "device": "aa:bb:cc:dd:ee:ff", "co": "1.0", "humidity": "50.0", "light": "false",
        "lpg": "0.1", "motion": "false", "smoke": "0.2", "temp": "22.0"}


def one(spark, **over):
    row = dict(GOOD, **over)
    df = spark.createDataFrame([tuple(row[c] for c in S.REQUIRED_COLUMNS)], S.RAW_SCHEMA)
    return classify_rows(df, INGESTED).first()


def test_invalid_timestamp_rejected(spark):
    r = one(spark, ts="not-a-timestamp")
    assert r["rejection_reason"] == "invalid_ts" and r["reading_id"] is None
    assert r["row"]["ts"] == "not-a-timestamp"


def test_out_of_range_timestamp_rejected(spark):
    assert one(spark, ts="1e20")["rejection_reason"] == "invalid_ts"
    assert one(spark, ts="inf")["rejection_reason"] == "invalid_ts"
    assert one(spark, ts="")["rejection_reason"] == "missing_ts"
    assert one(spark, device="  ")["rejection_reason"] == "missing_device"


def test_invalid_measurement_creates_quality_flag(spark):
    r = one(spark, co="bad-value", light="maybe")
    assert r["rejection_reason"] is None
    q = r["quality"]
    assert q["is_valid"] is False
    assert q["flags"] == ["invalid_numeric_co", "invalid_boolean_light"]
    assert q["invalid_measurement_count"] == 2
    assert r["measurements"]["co"] is None and r["measurements"]["light"] is None


def test_deterministic_id(spark):
    a, b = one(spark), one(spark)
    assert a["reading_id"] == b["reading_id"] and len(a["reading_id"]) == 64
    assert one(spark, co="0.2")["reading_id"] != a["reading_id"]
    # flags are not part of the identity: missing and invalid values both become null
    assert one(spark, co="")["reading_id"] == one(spark, co="bad")["reading_id"]
    # same instant in ms is a different raw number, hence a different id (kept from the reference)
    ms = one(spark, ts="1594512094000")
    assert ms["reading_id"] != a["reading_id"] and ms["timestamp"] == a["timestamp"]


def test_timestamp_and_date(spark):
    r = one(spark, ts="1594512094.385975")
    assert r["timestamp_unix"] == 1594512094.385975
    assert r["event_date"] == dt.date(2020, 7, 12)
    assert r["source"]["dataset"] == S.SOURCE_DATASET


GOLDEN = {
    SF_SMALL: dict(raw=1015, missing_ts=12, invalid_ts=11, missing_device=22, accepted=970, flagged=56,
                   distinct=956, devices=15, ms=12,
                   flags={"invalid_numeric_co": 11, "invalid_numeric_lpg": 12, "invalid_boolean_light": 11,
                          "missing_measurement_humidity": 11, "missing_measurement_temp": 11}),
    SF_MID: dict(raw=10141, missing_ts=106, invalid_ts=106, missing_device=211, accepted=9718, flagged=543,
                 distinct=9584, devices=150, ms=117,
                 flags={"invalid_numeric_co": 108, "invalid_numeric_lpg": 110, "invalid_boolean_light": 108,
                        "missing_measurement_humidity": 109, "missing_measurement_temp": 108}),
}


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_MID])
def test_golden_counts(spark, sf_dir):
    g = GOLDEN[sf_dir]
    c = classify_rows(raw_readings(spark, sf_dir), INGESTED).cache()
    assert c.count() == g["raw"]
    reasons = {r[0]: r[1] for r in c.groupBy("rejection_reason").count().collect()}
    assert reasons.get("missing_ts") == g["missing_ts"]
    assert reasons.get("invalid_ts") == g["invalid_ts"]
    assert reasons.get("missing_device") == g["missing_device"]
    assert reasons.get(None) == g["accepted"]
    assert "empty_device" not in reasons
    acc = accepted_readings(c)
    assert acc.where(~F.col("quality.is_valid")).count() == g["flagged"]
    assert acc.where(F.col("timestamp_unix") > 1e12).count() == g["ms"]
    d = dedupe_readings(acc)
    assert d.count() == g["distinct"]
    assert d.select("device").distinct().count() == g["devices"]
    flags = {r[0]: r[1] for r in acc.select(F.explode("quality.flags")).groupBy("col").count().collect()}
    assert flags == g["flags"]
    c.unpersist()


def test_no_python_in_plan(spark):
    plan = classify_rows(raw_readings(spark, SF_SMALL), INGESTED)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
