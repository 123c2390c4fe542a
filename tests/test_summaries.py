"""Kept summaries: equal to the full reports, renewed only where days changed, within the stated errors."""

import datetime as dt

from pyspark.sql import functions as F

from envtrack.operators import validate
from envtrack.operators.transform import accepted_readings, classify_rows
from envtrack.plans import summaries
from envtrack.sources.fixtures import raw_readings
from envtrack.sources.table import merge_into_table, read_readings

from conftest import SF_MID, SF_SMALL


def docs_of(spark, sf=SF_SMALL):
    return accepted_readings(classify_rows(raw_readings(spark, sf)))


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_report_equals_the_full_one_after_any_load(spark, scratch):
    table, root = f"{scratch}/readings", f"{scratch}/summaries"
    docs = docs_of(spark).persist()
    days = [r[0] for r in docs.select("event_date").distinct().orderBy("event_date").collect()]
    first, second = days[:len(days) // 2], days[len(days) // 2:]
    assert summaries.refresh(spark, table, root) == 0
    assert rows_of(summaries.validation_report(spark, root)) == rows_of(validate.validation_report(docs.limit(0)))
    merge_into_table(docs.where(F.col("event_date").isin(first)), table, "b0")
    assert summaries.refresh(spark, table, root) == len(first)
    merge_into_table(docs.where(F.col("event_date").isin([first[-1], *second])), table, "b1")
    assert summaries.refresh(spark, table, root) == len(second) + 1  # the untouched days stay as they are
    assert summaries.refresh(spark, table, root) == 0
    full = validate.validation_report(read_readings(spark, table))
    assert rows_of(summaries.validation_report(spark, root)) == rows_of(full)
    part = read_readings(spark, table).where(F.col("event_date").between(F.lit(days[1]), F.lit(days[3])))
    got = summaries.validation_report(spark, root, days[1], days[3] + dt.timedelta(days=1))
    assert rows_of(got) == rows_of(validate.validation_report(part))


def test_a_failed_refresh_is_done_again(spark, scratch, monkeypatch):
    table, root = f"{scratch}/readings", f"{scratch}/summaries"
    merge_into_table(docs_of(spark), table, "b0")
    real, calls = summaries._write, []

    def broken(df, path):
        calls.append(path)
        if path.endswith("/days"):
            raise OSError("no space")
        real(df, path)

    monkeypatch.setattr(summaries, "_write", broken)
    try:
        summaries.refresh(spark, table, root)
        raise AssertionError("must fail")
    except OSError:
        pass
    monkeypatch.undo()
    assert summaries.refresh(spark, table, root) > 0
    assert rows_of(summaries.validation_report(spark, root)) == rows_of(validate.validation_report(read_readings(spark, table)))


def test_reports_read_the_summaries_alone(spark, scratch):
    table, root = f"{scratch}/readings", f"{scratch}/summaries"
    merge_into_table(docs_of(spark), table, "b0")
    summaries.refresh(spark, table, root)
    for df in (summaries.validation_report(spark, root), summaries.kept_quantiles(spark, root, {"m": 0.5}),
               summaries.kept_distinct_devices(spark, root)):
        assert df.inputFiles() and all("/summaries/" in f for f in df.inputFiles())


def test_quantiles_are_within_the_stated_rank_error(spark, scratch):
    table, root = f"{scratch}/readings", f"{scratch}/summaries"
    merge_into_table(docs_of(spark, SF_MID), table, "b0")
    summaries.refresh(spark, table, root)
    ps = {f"p{i}": i / 10 for i in range(1, 10)}
    found = {r["field"]: r for r in summaries.kept_quantiles(spark, root, ps).collect()}
    readings = read_readings(spark, table)
    for field, row in found.items():
        values = sorted(r[0] for r in readings.select(f"measurements.{field}").where(f"measurements.{field} is not null").collect())
        assert row["n"] == len(values)
        for name, p in ps.items():
            below, upto = sum(v < row[name] for v in values), sum(v <= row[name] for v in values)
            slack = summaries.RANK_ERROR * len(values) + 1
            assert below <= p * len(values) + slack and upto >= p * len(values) - slack
    assert set(found) == set(summaries.THRESHOLD_FIELDS)


def test_fields_without_values_have_no_quantiles(spark, scratch):
    table, root = f"{scratch}/readings", f"{scratch}/summaries"
    raw = raw_readings(spark, SF_SMALL).withColumn("smoke", F.lit(""))
    merge_into_table(accepted_readings(classify_rows(raw)), table, "b0")
    summaries.refresh(spark, table, root)
    by_device = summaries.kept_quantiles(spark, root, {"m": 0.5}, by_device=True)
    assert {r[0] for r in by_device.select("field").distinct().collect()} == {"co", "lpg"}


def test_distinct_devices_of_days(spark, scratch):
    table, root = f"{scratch}/readings", f"{scratch}/summaries"
    merge_into_table(docs_of(spark, SF_MID), table, "b0")
    summaries.refresh(spark, table, root)
    readings = read_readings(spark, table)
    days = [r[0] for r in readings.select("event_date").distinct().orderBy("event_date").collect()]
    for start, end in ((None, None), (days[2], days[5]), (days[-1], None), (days[-1] + dt.timedelta(days=1), None)):
        rows = readings if start is None else readings.where(F.col("event_date") >= F.lit(start))
        rows = rows if end is None else rows.where(F.col("event_date") < F.lit(end))
        exact = rows.select("device").distinct().count()
        assert abs(summaries.kept_distinct_devices(spark, root, start, end).first()[0] - exact) <= 0.05 * exact
