"""Queries and writes that use their rows several times compute them once; batches are numbered on slim rows."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from envtrack.plans import registry
from envtrack.sources import table as tables

from conftest import SF_SMALL


@pytest.mark.parametrize("name", ["high_smoke_readings", "high_co_readings", "high_lpg_readings", "high_smoke_valid_only",
                                  "elevated_periods", "gap_tolerant_periods", "device_relative_alerts", "silent_devices"])
def test_readings_are_not_derived_again(spark, name):
    files = entry.queries()[name](spark, SF_SMALL).inputFiles()
    assert files and not [f for f in files if "events.parquet" in f]


def test_slim_readings_hold_the_same_values(spark):
    want = registry.readings(spark, SF_SMALL)
    got = registry.computed_once(want, "smoke", "co")
    columns = ["device", "timestamp", "timestamp_unix", "measurements.smoke", "measurements.co", "quality.is_valid"]
    assert got.select(columns).exceptAll(want.select(columns)).isEmpty()
    assert want.select(columns).exceptAll(got.select(columns)).isEmpty()


def test_instants_of_any_year_are_kept(spark):
    old = registry.readings(spark, SF_SMALL).limit(3).withColumn("timestamp", F.timestamp_micros(F.lit(-50_000_000_000_000_001)))
    assert registry.computed_once(old).select(F.unix_micros("timestamp")).distinct().collect() == [(-50_000_000_000_000_001,)]


def test_a_batch_and_a_compaction_are_settled_once(spark, scratch, monkeypatch):
    docs = registry.loaded(spark, SF_SMALL)
    for n in range(2):
        tables.merge_into_table(docs.where(F.col("timestamp_unix").isNotNull()), f"{scratch}/t", f"b{n}")
    seen = []
    monkeypatch.setattr(tables, "write_part", lambda rows, *a, **k: seen.append((rows.inputFiles(), rows.count())))
    tables.merge_into_table(docs, f"{scratch}/t", "b2")
    tables.compact(spark, f"{scratch}/t", f"{scratch}/compacted")
    n = registry.readings(spark, SF_SMALL).count()
    for files, rows in seen:
        assert rows == n
        assert not [f for f in files if "events.parquet" in f or f"{scratch}/t/" in f]


def test_batches_are_numbered_on_slim_rows(spark):
    plan = entry.queries()["batch_log"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "Window [row_number" in line]
    assert below and all("rejection_reason" in line and not re.search(r"[ \[]humidity#\d+, ", line) for line in below)
