"""Standing queries on streams against the same computations on whole tables."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from envtrack import schema as S
from envtrack.operators import health as H
from envtrack.operators.transform import accepted_readings, classify_rows
from envtrack.sources.table import merge_into_table, read_readings
from envtrack.streaming import live

START = dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc).timestamp()


def docs(spark, rows):
    """rows: (seconds behind START, device, smoke)."""
    raw = [(str(START + t), d, "0.1", "50", "true", "0.2", "false", "" if s is None else str(s), "20") for t, d, s in rows]
    columns = ["ts", "device", "co", "humidity", "light", "lpg", "motion", "smoke", "temp"]
    frame = spark.createDataFrame(raw, ", ".join(f"{c} string" for c in columns)).select(*S.REQUIRED_COLUMNS)
    return accepted_readings(classify_rows(frame))


def keys(df):
    return sorted((r.device, r.timestamp_unix) for r in df.select("device", "timestamp_unix").collect())


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_copies_in_any_order_of_files_give_the_batch_result(spark, scratch, order):
    parts = [[(i * 60, f"d{i % 3}", i / 10) for i in range(a, z)] for a, z in ((0, 30), (20, 50), (10, 45))]
    out = None
    for at, n in enumerate(order):  # each part arrives in a run of its own; the state lives between the runs
        merge_into_table(docs(spark, parts[n]), f"{scratch}/t", f"b{at}")
        out = live.run(live.first_copies(live.arriving(spark, f"{scratch}/t"), "2 hours"), f"{scratch}/out", f"{scratch}/ckpt")
    assert keys(out) == keys(read_readings(spark, f"{scratch}/t"))


def test_copies_beyond_the_watermark_are_left_out_and_state_is_dropped(spark, scratch):
    def step(name, rows):
        merge_into_table(docs(spark, rows), f"{scratch}/t", name)
        return live.run(live.first_copies(live.arriving(spark, f"{scratch}/t"), "10 minutes"), f"{scratch}/out", f"{scratch}/ckpt")

    step("b0", [(0, "d0", 0.1), (1, "d0", 0.2)])
    assert step("b1", [(86_400, "d1", 0.3)]).count() == 3
    out = step("b2", [(0, "d0", 0.1), (2, "d0", 0.4), (86_000, "d2", 0.5), (86_400, "d1", 0.3)])  # a copy, too late, in time, a copy
    assert keys(out) == sorted([("d0", START), ("d0", START + 1), ("d1", START + 86_400), ("d2", START + 86_000)])
    state = spark.read.format("statestore").load(f"{scratch}/ckpt")
    assert state.count() == 2  # the ids of the first day are forgotten


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
def test_window_alerts_of_a_replay_are_those_of_the_table(spark, scratch, order):
    rows = [(i * 97, f"d{i % 4}", (i * 7919) % 100 / 100 if i % 11 else None) for i in range(300)]
    for at, n in enumerate(order):
        merge_into_table(docs(spark, rows[n::3]), f"{scratch}/t", f"b{at}")
        got = live.run(live.window_alerts(live.arriving(spark, f"{scratch}/t"), "smoke", 0.7, "10 minutes", "5 minutes", 1, "9 hours"),
                       f"{scratch}/out", f"{scratch}/ckpt")
    merge_into_table(docs(spark, [(9 * 86_400, "late", 0.9)]), f"{scratch}/t", "b9")  # lets the watermark pass all of them
    got = live.run(live.window_alerts(live.arriving(spark, f"{scratch}/t"), "smoke", 0.7, "10 minutes", "5 minutes", 1, "9 hours"),
                   f"{scratch}/out", f"{scratch}/ckpt")
    want = live.window_alerts(read_readings(spark, f"{scratch}/t").where("device <> 'late'"), "smoke", 0.7, "10 minutes", "5 minutes", 1)
    assert want.count() > 20 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_alarms_are_raised_once_and_cleared_on_return(spark, scratch):
    limits = spark.createDataFrame([("a", 100.0), ("b", 100.0), ("c", 1e6)], "device string, limit_seconds double")

    def step(name, rows):
        merge_into_table(docs(spark, rows), f"{scratch}/t", name)
        out = live.run(live.silence_alarms(live.arriving(spark, f"{scratch}/t"), limits), f"{scratch}/out", f"{scratch}/ckpt")
        base = dt.datetime.fromtimestamp(START, dt.timezone.utc).replace(tzinfo=None)
        return sorted((r.device, r["at"] - base, r.event) for r in out.collect())

    s = lambda n: dt.timedelta(seconds=n)
    assert step("b0", [(0, "a", 1), (10, "a", 1), (60, "b", 1), (50, "unwatched", 1)]) == []
    assert step("b1", [(155, "c", 1)]) == [("a", s(110), "raised")]
    assert step("b2", [(156, "c", 1), (159, "b", 1)]) == [("a", s(110), "raised")]  # raised once
    assert step("b3", [(200, "a", 1)]) == [("a", s(110), "raised"), ("a", s(200), "cleared")]
    assert step("b4", [(500, "c", 1)]) == [("a", s(110), "raised"), ("a", s(200), "cleared"), ("a", s(300), "raised"),
                                           ("b", s(259), "raised")]


def test_standing_alarms_agree_with_silent_devices(spark, scratch):
    rows = [(i * 60, "steady", 1) for i in range(100)] + [(i * 30, "gone", 1) for i in range(40)] + [(i * 900, "slow", 1) for i in range(7)]
    rows.sort()
    table = docs(spark, rows).persist()
    limits = H.silent_devices(table).select("device", (F.col("median_interval_seconds") * 3).alias("limit_seconds"))
    for i in range(3):
        merge_into_table(docs(spark, rows[i * 49:(i + 1) * 49]), f"{scratch}/t", f"b{i}")
        events = live.run(live.silence_alarms(live.arriving(spark, f"{scratch}/t"), limits), f"{scratch}/out", f"{scratch}/ckpt")
    up = {r.device for r in events.where("event = 'raised'").collect()} - {r.device for r in events.where("event = 'cleared'").collect()}
    assert up == {r.device for r in H.silent_devices(table).where("is_silent").collect()} == {"gone"}


@pytest.mark.parametrize("chunk", [60, 600, 86_400])
def test_gap_tolerant_periods_equal_a_plain_computation(spark, chunk):
    rows = [((i * 7919) % 5000 + (i % 5) * 9000, f"d{i % 3}", (i * 31) % 10 / 10) for i in range(400)]
    rows += [(t, "edge", 0.9) for t in (0, 599, 1198, 1798, 1799, 2399)]  # 599 s goes on, 600 s does not
    table = docs(spark, rows)
    got = H.gap_tolerant_periods(table, "smoke", 0.6, quiet_seconds=600, chunk_seconds=chunk)
    base = dt.datetime.fromtimestamp(START, dt.timezone.utc).replace(tzinfo=None)
    found = sorted((r.device, (r.period_start - base).total_seconds(), (r.period_end - base).total_seconds(), r.readings, r.max_value)
                   for r in got.collect())
    want = []
    for device in sorted({d for _, d, _ in rows}):
        for t, v in sorted((t, v) for t, d, v in rows if d == device and v >= 0.6):
            if want and want[-1][0] == device and t - want[-1][2] < 600:
                _, a, _, n, m = want[-1]
                want[-1] = (device, a, t, n + 1, max(m, v))
            else:
                want.append((device, t, t, 1, v))
    assert found == sorted(want)
