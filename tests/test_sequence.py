"""Chunked sequence operators equal plain per-device windows, whatever the chunk width."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from envtrack.functions.timecols import micros
from envtrack.operators import health as H
from envtrack.operators.sequence import with_previous
from envtrack.plans import registry

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def readings(spark):
    return registry.readings(spark, SF_SMALL).cache()


@pytest.mark.parametrize("chunk", [60, 3600, 86400 * 40])
def test_previous_matches_plain_window(spark, readings, chunk):
    x = readings.select("device", "timestamp", "timestamp_unix", micros(F.col("timestamp")).alias("us"),
                        (F.col("measurements.smoke") >= 0.05).cast("int").alias("hi"))
    order = ["timestamp", "timestamp_unix"]
    got = with_previous(x, "device", "timestamp", order, ["us"], chunk_seconds=chunk)
    w = Window.partitionBy("device").orderBy(*order)
    want = x.select("*", F.lag("us").over(w).alias("prev_us"))
    cols = ["device", "timestamp_unix", "us", "prev_us"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_gaps_and_periods_independent_of_chunk(spark, readings):
    a = sorted(H.reading_gaps(readings, 600, chunk_seconds=60).collect())
    b = sorted(H.reading_gaps(readings, 600, chunk_seconds=86400 * 40).collect())
    assert a == b and len(a) > 0
    p1 = sorted(H.elevated_periods(readings, chunk_seconds=60).collect())
    p2 = sorted(H.elevated_periods(readings, chunk_seconds=86400 * 40).collect())
    assert p1 == p2 and len(p1) > 0
    # each period's count equals the number of elevated readings overall
    thr = readings.agg(F.percentile_approx("measurements.smoke", 0.9, 1000000)).first()[0]
    assert sum(r["readings"] for r in p1) == readings.where(F.col("measurements.smoke") >= round(thr, 6)).count()


@pytest.mark.parametrize("chunk", [60, 3600, 86400 * 40])
def test_islands_match_plain_gaps_and_islands(spark, readings, chunk):
    from envtrack.operators.sequence import with_islands

    x = readings.select("device", "timestamp", "timestamp_unix",
                        (F.col("measurements.smoke") >= 0.05).alias("hi"))
    order = ["timestamp", "timestamp_unix"]
    got = with_islands(x, "device", "timestamp", order, "hi", "island", chunk_seconds=chunk)
    w = Window.partitionBy("device").orderBy(*order)
    starts = x.withColumn("s", (F.coalesce("hi", F.lit(False))
                                & ~F.coalesce(F.lag(F.coalesce("hi", F.lit(False))).over(w), F.lit(False))).cast("long"))
    want = starts.withColumn("island", F.when(F.coalesce("hi", F.lit(False)),
                                              F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    cols = ["device", "timestamp_unix", "island"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_positions_tree_matches_row_number(spark):
    """The prefix-sum tree gives the global row number, also across sparse, far-apart group keys."""
    from envtrack.operators.batches import with_positions

    rows = [(p, s) for p in (0, 1) for s in list(range(0, 300)) + [70_000, 70_001, 5_000_000_000, 2**40 + 7]]
    df = spark.createDataFrame(rows, "part int, seq bigint")
    got = with_positions(df, F.shiftleft(F.col("part").cast("bigint"), 48) + F.shiftright("seq", 4), ["seq"])
    want = sorted(rows)
    assert [(r["part"], r["seq"]) for r in got.orderBy("position").collect()] == want
    assert [r["position"] for r in got.orderBy("position").collect()] == list(range(1, len(want) + 1))
    per_part = with_positions(df, F.shiftright("seq", 4), ["seq"], within=["part"])
    assert sorted(r["position"] for r in per_part.where("part = 1").collect()) == list(range(1, 305))


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_events = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 20_000), st.booleans()),
                   min_size=1, max_size=80)


@settings(max_examples=12, deadline=None)
@given(_events, st.sampled_from([1, 7, 60, 3600]))
def test_islands_and_previous_property(spark, events, chunk):
    """Random per-device sequences (ties on time broken by a unique sequence number)."""
    import datetime as dt

    from envtrack.operators.sequence import with_islands

    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(d, base + dt.timedelta(seconds=s), i, hi) for i, (d, s, hi) in enumerate(events)]
    df = spark.createDataFrame(rows, "device string, ts timestamp, seq long, hi boolean")
    got = with_islands(df, "device", "ts", ["ts", "seq"], "hi", "island", chunk_seconds=chunk)
    got = with_previous(got, "device", "ts", ["ts", "seq"], ["seq"], chunk_seconds=chunk)
    result = {r["seq"]: (r["island"], r["prev_seq"]) for r in got.collect()}
    want = {}
    for d in {r[0] for r in rows}:
        seq_rows = sorted((r for r in rows if r[0] == d), key=lambda r: (r[1], r[2]))
        island, prev_hi, prev_seq = 0, False, None
        for _, _, s, hi in seq_rows:
            if hi and not prev_hi:
                island += 1
            want[s] = (island if hi else None, prev_seq)
            prev_hi, prev_seq = hi, s
    assert result == want


def test_rolling_bursts_match_a_plain_range_window(spark, readings):
    x = readings.select("device", "timestamp", micros(F.col("timestamp")).alias("us"))
    for seconds, least in ((60, 1), (3600, 2), (86400, 3)):
        w = Window.partitionBy("device").orderBy("us").rangeBetween(-seconds * 1_000_000, 0)
        want = x.select("device", F.count("*").over(w).alias("readings")).where(F.col("readings") >= least)
        got = H.rolling_bursts(readings, seconds, least).select("device", "readings")
        assert sorted(got.collect()) == sorted(want.collect())


def test_one_device_with_most_readings(spark):
    """Baselines, silence and alerts of a device that holds nearly all rows."""
    rows = spark.range(4000).selectExpr(
        "if(id % 50 = 0, concat('d', id % 7), 'busy') AS device", "timestamp_seconds(1704067200 + id * 60) AS timestamp",
        "double(1704067200 + id * 60) AS timestamp_unix",
        "named_struct('co', 1.0D, 'humidity', 1.0D, 'light', true, 'lpg', double(id % 5), 'motion', true, 'smoke', "
        "double((id * 7919) % 1000), 'temp', 1.0D) AS measurements",
        "named_struct('is_valid', true, 'flags', array(''), 'invalid_measurement_count', 0) AS quality",
        "string(id) AS reading_id")
    smoke: dict[str, list[float]] = {}
    for r in rows.select("device", "measurements.smoke").collect():
        smoke.setdefault(r["device"], []).append(r["smoke"])
    p90 = {d: sorted(v)[-(-9 * len(v) // 10) - 1] for d, v in smoke.items()}
    assert {r["device"]: r["smoke_p90"] for r in H.device_baselines(rows).collect()} == p90
    found = H.device_relative_alerts(rows).collect()
    assert len(found) == sum(x >= p90[d] for d, v in smoke.items() for x in v)
    assert all(r["device_p90"] == p90[r["device"]] for r in found)
    assert {r["device"] for r in H.silent_devices(rows).collect()} == set(smoke)
