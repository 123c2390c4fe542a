"""Registered queries: plan hygiene for all, and the DuckDB oracle for a representative set."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from envtrack.plans import registry

from conftest import SF_SMALL

FORBIDDEN = ["PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]
SKIP_PLAN = {"resumable_load", "batch_log"}  # run a whole load when called


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - SKIP_PLAN))
def test_plan_hygiene(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, 'events.parquet')}')")
    return con


@pytest.mark.parametrize("name", ["classify_rows", "dedupe_readings", "batch_quality_status", "upsert_counts",
                                  "alert_thresholds", "high_smoke_readings", "avg_temperature_by_device",
                                  "readings_by_day", "validation_report", "basic_statistics", "elevated_periods",
                                  "silent_devices", "downsample", "device_baselines", "upsert_merge", "rolling_bursts",
                                  "extreme_thresholds", "extreme_baselines", "device_relative_alerts", "batch_log",
                                  "csv_round_trip", "quality_report_devices"])
def test_matches_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    drows = rel.fetchall()
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(rel.columns, drows)
