"""Resumable load: resume, stop-after-N, failure, replay, reset, changed source, header checks."""

import datetime as dt
import os
import time

import pytest

from envtrack import schema as S
from envtrack.operators.dedupe import dedupe_readings
from envtrack.operators.transform import accepted_readings, classify_rows
from envtrack.sources.csv import MissingColumnsError
from envtrack.sources.fixtures import raw_readings
from envtrack.sources.manifest import SourceChangedError
from envtrack.sources.table import read_readings
from envtrack.sources import storage
from envtrack.sources import table as tables
from envtrack.streaming import load as L

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw_pdf(spark):
    return raw_readings(spark, SF_SMALL, keep_order=True).orderBy("_part", "_seq").toPandas()


def write_parts(pdf, folder, n=5, columns=None):
    os.makedirs(folder, exist_ok=True)
    size = -(-len(pdf) // n)
    for i in range(n):
        part = pdf.iloc[i * size:(i + 1) * size][columns or S.REQUIRED_COLUMNS]
        part.to_csv(os.path.join(folder, f"part-{i:02d}.csv"), index=False)


def table_ids(spark, table):
    return {(r[0], r[1]) for r in read_readings(spark, table).select("device", "timestamp_unix").collect()}


def test_resume_two_two_rest(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src)
    # one ingest time for the three runs: identical repeats then count as neither insert nor update
    at = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    s1 = L.load_readings(spark, src, table, state, max_batches=2, delay_seconds=0, ingested_at=at)
    assert s1.batches_processed_this_run == 2 and s1.stopped_early
    s2 = L.load_readings(spark, src, table, state, max_batches=2, delay_seconds=0, ingested_at=at)
    assert s2.batches_processed_this_run == 2 and s2.stopped_early
    s3 = L.load_readings(spark, src, table, state, delay_seconds=0, ingested_at=at)
    assert s3.batches_processed_this_run == 1 and not s3.stopped_early
    assert (s3.total_rows_seen, s3.rows_loaded, s3.rows_rejected, s3.rows_with_quality_flags) == (1015, 970, 45, 56)
    assert s1.total_inserted_or_updated_this_run + s2.total_inserted_or_updated_this_run \
        + s3.total_inserted_or_updated_this_run == 956

    one_shot = dedupe_readings(accepted_readings(classify_rows(raw_readings(spark, SF_SMALL))))
    expected = {(r[0], r[1]) for r in one_shot.select("device", "timestamp_unix").collect()}
    assert read_readings(spark, table).count() == 956
    assert table_ids(spark, table) == expected
    assert read_readings(spark, table).select("reading_id").distinct().count() == 956

    paths = L.load_state(spark, table, state)
    rejected = spark.read.parquet(paths.rejected)
    assert rejected.count() == 45
    assert sorted(r[0] for r in rejected.select("batch_id").distinct().collect()) == [0, 1, 2, 3, 4]

    s4 = L.load_readings(spark, src, table, state, delay_seconds=0)
    assert s4.batches_processed_this_run == 0 and s4.total_rows_seen == 1015


def test_failed_write_does_not_advance(spark, scratch, raw_pdf, monkeypatch):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src, n=2)
    calls = {"n": 0}

    def broken(*a, **k):
        calls["n"] += 1
        raise OSError("storage unavailable")

    monkeypatch.setattr(L, "merge_into_table", broken)
    with pytest.raises(L.LoadFailed):
        L.load_readings(spark, src, table, state, max_attempts=3, delay_seconds=0)
    assert calls["n"] == 3
    paths = L.load_state(spark, table, state)
    failures = spark.read.parquet(paths.failures).collect()
    assert len(failures) == 1 and failures[0]["batch_id"] == 0 and "storage unavailable" in failures[0]["error"]
    monkeypatch.undo()

    s = L.load_readings(spark, src, table, state, delay_seconds=0)
    assert s.batches_processed_this_run == 2 and s.rows_loaded == 970
    assert read_readings(spark, table).count() == 956


def test_replay_and_reset_keep_data(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src, n=3)
    L.load_readings(spark, src, table, state, delay_seconds=0)
    before = read_readings(spark, table).select("reading_id").collect()
    s = L.load_readings(spark, src, table, state, reset=True, delay_seconds=0)
    assert s.generation == 1 and s.batches_processed_this_run == 3
    assert s.total_rows_seen == 1015  # counters restart with the new generation
    assert s.total_inserted_or_updated_this_run == 956  # newer ingest time replaces every reading
    after = read_readings(spark, table).select("reading_id").collect()
    assert sorted(before) == sorted(after)


def test_changed_source_is_refused(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src, n=2)
    L.load_readings(spark, src, table, state, delay_seconds=0)
    time.sleep(1.1)
    with open(f"{src}/part-00.csv", "a") as fh:
        fh.write("1594512094.0,dev-x,1,1,true,1,true,1,1\n")
    with pytest.raises(SourceChangedError):
        L.load_readings(spark, src, table, state, delay_seconds=0)


def test_header_order_free_and_missing_column(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    os.makedirs(src)
    pdf = raw_pdf.copy()
    pdf["extra"] = "x"
    cols = ["temp", "extra", "device", "ts", "smoke", "motion", "lpg", "light", "humidity", "co"]
    pdf[cols].to_csv(f"{src}/reordered.csv", index=False)
    s = L.load_readings(spark, src, table, state, delay_seconds=0)
    assert s.rows_loaded == 970 and read_readings(spark, table).count() == 956

    bad = f"{scratch}/bad"
    os.makedirs(bad)
    raw_pdf[[c for c in S.REQUIRED_COLUMNS if c != "temp"]].to_csv(f"{bad}/no_temp.csv", index=False)
    with pytest.raises(MissingColumnsError):
        L.load_readings(spark, bad, f"{scratch}/t2", f"{scratch}/s2", delay_seconds=0)


def test_empty_and_header_only_files(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src, n=1)
    open(f"{src}/zz-empty.csv", "w").close()
    with open(f"{src}/zz-header.csv", "w") as fh:
        fh.write(",".join(S.REQUIRED_COLUMNS) + "\n")
    s = L.load_readings(spark, src, table, state, delay_seconds=0)
    assert s.batches_processed_this_run == 3 and s.rows_loaded == 970


def test_bad_arguments(spark, scratch):
    with pytest.raises(ValueError):
        L.load_readings(spark, scratch, f"{scratch}/t", max_batches=0)


@pytest.mark.parametrize("per_batch", [1, 3])
def test_three_files_in_three_column_orders(spark, scratch, raw_pdf, per_batch):
    """Every file is read by its own header; the table is that of a load in one order."""
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    os.makedirs(src)
    third = -(-len(raw_pdf) // 3)
    orders = [S.REQUIRED_COLUMNS, S.REQUIRED_COLUMNS[::-1], ["device", "extra", *[c for c in S.REQUIRED_COLUMNS if c != "device"]]]
    pdf = raw_pdf.assign(extra='x "y", z')
    for i, order in enumerate(orders):
        pdf.iloc[i * third:(i + 1) * third][order].to_csv(f"{src}/p{i}[{{x}}].csv", index=False)
    open(f"{src}/a-empty.csv", "w").close()
    s = L.load_readings(spark, src, table, state, files_per_batch=per_batch, delay_seconds=0)
    assert (s.total_rows_seen, s.rows_loaded, s.rows_rejected) == (1015, 970, 45)
    got = read_readings(spark, table).select("reading_id", "device", "timestamp_unix", "quality.flags")
    want = dedupe_readings(accepted_readings(classify_rows(raw_readings(spark, SF_SMALL)))).select(
        "reading_id", "device", "timestamp_unix", "quality.flags")
    assert sorted(got.collect()) == sorted(want.collect())
    rejected = spark.read.parquet(L.load_state(spark, table, state).rejected)
    assert rejected.select("source_file").distinct().count() <= 3


def test_a_later_file_without_a_column_fails_its_batch(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src, n=1)
    time.sleep(0.05)
    raw_pdf[[c for c in S.REQUIRED_COLUMNS if c != "temp"]].to_csv(f"{src}/z.csv", index=False)
    with pytest.raises(L.LoadFailed, match="temp"):
        L.load_readings(spark, src, table, state, delay_seconds=0)
    assert read_readings(spark, table).count() == 956


@pytest.mark.parametrize("n_files,per_batch", [(1, 1), (3, 2), (7, 1)])
def test_any_split_gives_the_same_table(spark, scratch, raw_pdf, n_files, per_batch):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf.sample(frac=1.0, random_state=n_files), src, n=n_files)  # row order shuffled too
    s = L.load_readings(spark, src, table, state, files_per_batch=per_batch, delay_seconds=0)
    assert (s.total_rows_seen, s.rows_loaded, s.rows_rejected) == (1015, 970, 45)
    got = read_readings(spark, table).select("reading_id", "device", "timestamp_unix", "quality.flags")
    one_shot = dedupe_readings(accepted_readings(classify_rows(raw_readings(spark, SF_SMALL))))
    want = one_shot.select("reading_id", "device", "timestamp_unix", "quality.flags")
    assert sorted(got.collect()) == sorted(want.collect())


def test_crash_after_rejects_replays_without_duplicates(spark, scratch, raw_pdf, monkeypatch):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src, n=2)
    real = L.write_batch_partition
    seen = {"crashed": False}

    def crash_on_log(df, path, batch_id, *a, **k):
        if path.endswith("batch_log") and batch_id == 1 and not seen["crashed"]:
            seen["crashed"] = True
            raise RuntimeError("crash after the rejected rows were written")
        return real(df, path, batch_id, *a, **k)

    monkeypatch.setattr(L, "write_batch_partition", crash_on_log)
    with pytest.raises(L.LoadFailed):
        L.load_readings(spark, src, table, state, delay_seconds=0)
    s = L.load_readings(spark, src, table, state, delay_seconds=0)
    assert s.batches_processed_this_run == 1 and s.total_rows_seen == 1015
    paths = L.load_state(spark, table, state)
    assert spark.read.parquet(paths.rejected).count() == 45
    assert read_readings(spark, table).count() == 956


def test_custom_checkpoint_location(spark, scratch, raw_pdf):
    src, table, state, ckpt = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state", f"{scratch}/my-ckpt"
    write_parts(raw_pdf, src, n=2)
    s = L.load_readings(spark, src, table, state, checkpoint_path=ckpt, max_batches=1, delay_seconds=0)
    assert s.batches_processed_this_run == 1
    assert os.path.isdir(f"{ckpt}/offsets") and os.path.isdir(f"{ckpt}/commits")
    s = L.load_readings(spark, src, table, state, checkpoint_path=ckpt, delay_seconds=0)
    assert s.batches_processed_this_run == 1 and s.total_rows_seen == 1015


def test_staged_batches_keep_file_order(spark, scratch, raw_pdf):
    src, dest = f"{scratch}/one", f"{scratch}/staged"
    os.makedirs(src)
    raw_pdf[S.REQUIRED_COLUMNS].to_csv(f"{src}/all.csv", index=False)
    # small splits: the file is read by many tasks, yet batches must follow file order
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        L.stage_batches(L._csv_batches(spark, src, "*.csv", 100, False), dest)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = spark.read.parquet(dest).orderBy("ordinal", "position").toPandas()
    want = raw_pdf[S.REQUIRED_COLUMNS].fillna("").astype(str).reset_index(drop=True)
    assert got["ordinal"].tolist() == [i // 100 + 1 for i in range(len(want))]
    assert (got["ts"].fillna("").tolist(), got["smoke"].fillna("").tolist()) == (want["ts"].tolist(), want["smoke"].tolist())


def test_empty_source(spark, scratch):
    os.makedirs(f"{scratch}/src")
    s = L.load_readings(spark, f"{scratch}/src", f"{scratch}/t", f"{scratch}/s", delay_seconds=0)
    assert s.batches_processed_this_run == 0 and s.total_rows_seen == 0


def test_row_batches_from_one_csv_like_the_reference(spark, scratch, raw_pdf):
    """One CSV cut into 300-row batches: 2 + 2 + rest, batch counters per 300 rows, changed file refused."""
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    os.makedirs(src)
    raw_pdf[S.REQUIRED_COLUMNS].to_csv(f"{src}/all.csv", index=False)
    at = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    s1 = L.load_in_row_batches(spark, src, table, state, batch_size=300, max_batches=2, delay_seconds=0, ingested_at=at)
    assert s1.batches_processed_this_run == 2 and s1.stopped_early and s1.total_rows_seen == 600
    s2 = L.load_in_row_batches(spark, src, table, state, batch_size=300, max_batches=2, delay_seconds=0, ingested_at=at)
    assert s2.batches_processed_this_run == 2 and s2.total_rows_seen == 1015
    s3 = L.load_in_row_batches(spark, src, table, state, batch_size=300, delay_seconds=0, ingested_at=at)
    assert s3.batches_processed_this_run == 0
    status = L.batch_status_table(spark, L.load_state(spark, table, state))
    assert sorted((r["batch_number"], r["rows_read"]) for r in status.collect()) == [(1, 300), (2, 300), (3, 300), (4, 115)]
    assert read_readings(spark, table).count() == 956
    time.sleep(1.1)
    with open(f"{src}/all.csv", "a") as fh:
        fh.write("1594512094.0,dev-x,1,1,true,1,true,1,1\n")
    with pytest.raises(SourceChangedError):
        L.load_in_row_batches(spark, src, table, state, batch_size=300, delay_seconds=0)
    s4 = L.load_in_row_batches(spark, src, table, state, batch_size=300, reset=True, delay_seconds=0)
    assert s4.total_rows_seen == 1016 and s4.batches_processed_this_run == 4


def test_files_in_nested_folders_are_loaded(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, f"{src}/day1", n=2)
    write_parts(raw_pdf, f"{src}/day2/late", n=1)
    s = L.load_readings(spark, src, table, state, files_per_batch=3, delay_seconds=0)
    assert s.total_rows_seen == 2 * 1015 and read_readings(spark, table).count() == 956


def test_row_batches_from_nested_source(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    os.makedirs(f"{src}/a/b")
    raw_pdf[S.REQUIRED_COLUMNS].to_csv(f"{src}/a/b/all.csv", index=False)
    s = L.load_in_row_batches(spark, src, table, state, batch_size=500, delay_seconds=0)
    assert s.batches_processed_this_run == 3 and s.total_rows_seen == 1015


def test_row_batches_several_per_trigger(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    os.makedirs(src)
    raw_pdf[S.REQUIRED_COLUMNS].to_csv(f"{src}/all.csv", index=False)
    s = L.load_in_row_batches(spark, src, table, state, batch_size=300, batches_per_trigger=3, delay_seconds=0)
    assert s.batches_processed_this_run == 4 and s.total_rows_seen == 1015 and s.rows_loaded == 970
    status = L.batch_status_table(spark, L.load_state(spark, table, state)).collect()
    assert sorted((r["batch_number"], r["rows_read"]) for r in status) == [(1, 300), (2, 300), (3, 300), (4, 115)]
    assert read_readings(spark, table).count() == 956


def test_row_batches_run_in_order_from_file_to_file(spark, scratch, raw_pdf):
    """With many write tasks and several files: batches 1 to 3, then from 4; a log row for each."""
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src, n=2)  # 508 and 507 rows
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        s1 = L.load_in_row_batches(spark, src, table, state, batch_size=200, max_batches=2, delay_seconds=0)
        s2 = L.load_in_row_batches(spark, src, table, state, batch_size=200, batches_per_trigger=3, delay_seconds=0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert (s1.batches_processed_this_run, s1.total_rows_seen, s1.stopped_early) == (2, 400, True)
    assert (s2.batches_processed_this_run, s2.total_rows_seen, s2.stopped_early) == (4, 1015, False)
    paths = L.load_state(spark, table, state)
    log = {(r["source_file"].rsplit("/", 1)[-1], r["batch_number"]): r["rows_read"]
           for r in L.batch_log_table(spark, paths).collect()}
    assert log == {("part-00.csv", 1): 200, ("part-00.csv", 2): 200, ("part-00.csv", 3): 108,
                   ("part-01.csv", 1): 200, ("part-01.csv", 2): 200, ("part-01.csv", 3): 107}
    rejected = spark.read.parquet(paths.rejected)
    assert rejected.count() == 45 and {"batch_number", "source_file"} <= set(rejected.columns)
    assert read_readings(spark, table).count() == 956


def test_an_error_while_listing_fails_the_batch(spark, scratch, raw_pdf, monkeypatch):
    """Stored readings must not be taken for absent: the batch fails, and the next run loses nothing."""
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src, n=3)
    L.load_readings(spark, src, table, state, max_batches=1, delay_seconds=0)
    real = tables.read_if_exists

    def unreadable(spark, path, schema):
        if path == table:
            raise OSError("listing failed")
        return real(spark, path, schema)

    monkeypatch.setattr(tables, "read_if_exists", unreadable)
    with pytest.raises((OSError, L.LoadFailed)):
        L.load_readings(spark, src, table, state, max_attempts=1, delay_seconds=0)
    monkeypatch.undo()
    L.load_readings(spark, src, table, state, delay_seconds=0)
    assert read_readings(spark, table).count() == 956


@pytest.mark.parametrize("written", ["nothing", "half", "all"])
def test_a_half_done_batch_changes_nothing_in_the_end(spark, scratch, raw_pdf, monkeypatch, written):
    """Fail before a batch's readings are written, when half of them are, and right behind that."""
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf.sample(frac=1.0, random_state=1), src, n=2)  # both files touch all days
    at = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    L.load_readings(spark, src, table, state, max_batches=1, delay_seconds=0, ingested_at=at)
    before = {r[0] for r in read_readings(spark, table).select("reading_id").collect()}
    real = L.merge_into_table

    def broken(docs, *rest):
        if written != "nothing":
            real(docs.where("timestamp_unix % 2 < 1") if written == "half" else docs, *rest)
        raise OSError("connection lost")

    monkeypatch.setattr(L, "merge_into_table", broken)
    with pytest.raises(L.LoadFailed):
        L.load_readings(spark, src, table, state, max_attempts=1, delay_seconds=0, ingested_at=at)
    monkeypatch.undo()
    seen = [r[0] for r in read_readings(spark, table).select("reading_id").collect()]
    assert len(seen) == len(set(seen)) and before <= set(seen)
    L.load_readings(spark, src, table, state, delay_seconds=0, ingested_at=at)
    clean = f"{scratch}/clean"
    L.load_readings(spark, src, clean, f"{scratch}/state2", files_per_batch=2, delay_seconds=0, ingested_at=at)
    assert sorted(read_readings(spark, table).collect()) == sorted(read_readings(spark, clean).collect())


def test_an_unfinished_write_is_done_again(spark, scratch):
    spark.range(3).write.parquet(f"{scratch}/whole")
    os.makedirs(f"{scratch}/half")
    assert storage.is_complete(spark, f"{scratch}/whole") and not storage.is_complete(spark, f"{scratch}/half")
    assert not storage.is_complete(spark, f"{scratch}/absent")


def test_two_states_share_a_table(spark, scratch, raw_pdf):
    """Loads with states of their own never overwrite each other's parts; copies are settled."""
    table = f"{scratch}/readings"
    for name, pdf in (("a", raw_pdf.iloc[:700]), ("b", raw_pdf.iloc[300:])):
        write_parts(pdf, f"{scratch}/{name}", n=2)
        L.load_readings(spark, f"{scratch}/{name}", table, f"{scratch}/state-{name}", delay_seconds=0)
    got = read_readings(spark, table)
    assert got.count() == got.select("reading_id").distinct().count() == 956


def test_compaction_keeps_the_readings_and_drops_the_copies(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf.sample(frac=1.0, random_state=2), src, n=3)
    L.load_readings(spark, src, table, state, delay_seconds=0)
    L.load_readings(spark, src, table, state, reset=True, delay_seconds=0)
    tables.compact(spark, table, f"{scratch}/compacted")
    stored = tables.stored_parts(spark, f"{scratch}/compacted")
    assert stored.count() == 956 < tables.stored_parts(spark, table).count()
    assert tables.days_written(stored).where("several").isEmpty()
    assert sorted(read_readings(spark, f"{scratch}/compacted").collect()) == sorted(read_readings(spark, table).collect())


def test_filters_reach_the_scan_through_the_settling(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf.sample(frac=1.0, random_state=3), src, n=2)
    L.load_readings(spark, src, table, state, delay_seconds=0)
    day = read_readings(spark, table).selectExpr("min(event_date)").first()[0]
    plan = read_readings(spark, table).where(f"event_date = date'{day}' and device = 'dev-1'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan" in line and "reading_id" in line]
    assert len(scans) == 2 and all("EqualTo(device,dev-1)" in x and "event_date" in x.split("PartitionFilters")[1]
                                   for x in scans)


def test_layout_skips_row_groups_by_value_and_by_device(spark, scratch):
    """K7: fewer row groups can hold readings with much smoke than in the order of device and time."""
    import glob

    import pyarrow.parquet as pq

    rows = dedupe_readings(accepted_readings(classify_rows(raw_readings(spark, SF_SMALL.replace("0.001", "0.1")))))
    threshold = rows.selectExpr("percentile(measurements.smoke, 0.99)").first()[0]
    spark.conf.set("parquet.block.size", "16384")
    spark.conf.set("parquet.block.size.row.check.min", "100")
    try:
        tables.write_part(rows, f"{scratch}/new", "b", partitions=64)
        order = ["event_date", "device", "timestamp"]
        rows.repartitionByRange(64, *order).sortWithinPartitions(*order).write.partitionBy("event_date").parquet(f"{scratch}/old")
    finally:
        spark.conf.unset("parquet.block.size")
        spark.conf.unset("parquet.block.size.row.check.min")

    def share(path):
        groups, hit = 0, 0
        for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
            meta = pq.ParquetFile(f).metadata
            at = next(i for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == "measurements.smoke")
            for g in range(meta.num_row_groups):
                groups, stats = groups + 1, meta.row_group(g).column(at).statistics
                hit += stats is not None and stats.has_min_max and stats.max >= threshold
        return hit / groups, groups

    (new, n), (old, m) = share(f"{scratch}/new"), share(f"{scratch}/old")
    assert min(n, m) >= 32 and new < 0.6 * old
    assert read_readings(spark, f"{scratch}/new").count() == rows.count()


def test_reset_with_a_custom_checkpoint_goes_on(spark, scratch, raw_pdf):
    src, table, state, ckpt = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state", f"{scratch}/ckpt"
    write_parts(raw_pdf, src, n=3)
    L.load_readings(spark, src, table, state, checkpoint_path=ckpt, delay_seconds=0)
    s = L.load_readings(spark, src, table, state, checkpoint_path=ckpt, reset=True, max_batches=1, delay_seconds=0)
    assert s.batches_processed_this_run == 1
    s = L.load_readings(spark, src, table, state, checkpoint_path=ckpt, delay_seconds=0)
    assert s.batches_processed_this_run == 2 and s.total_rows_seen == 1015


def test_another_source_is_refused(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src, n=1)
    write_parts(raw_pdf, f"{scratch}/other", n=1)
    L.load_readings(spark, src, table, state, delay_seconds=0)
    with pytest.raises(SourceChangedError):
        L.load_readings(spark, f"{scratch}/other", table, state, delay_seconds=0)


def test_long_errors_and_many_changed_files_are_kept_whole(spark, scratch, raw_pdf, monkeypatch):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src, n=30)
    text = "x" * 9000
    monkeypatch.setattr(L, "merge_into_table", lambda *a: (_ for _ in ()).throw(OSError(text)))
    with pytest.raises(L.LoadFailed):
        L.load_readings(spark, src, table, state, files_per_batch=30, max_attempts=2, delay_seconds=0)
    monkeypatch.undo()
    failure = spark.read.parquet(L.load_state(spark, table, state).failures).first()
    assert text in failure["error"] and failure["attempts"] == 2
    L.load_readings(spark, src, table, state, files_per_batch=30, delay_seconds=0)
    time.sleep(1.1)
    for i in range(25):
        with open(f"{src}/part-{i:02d}.csv", "a") as fh:
            fh.write("1594512094.0,dev-x,1,1,true,1,true,1,1\n")
    with pytest.raises(SourceChangedError, match="^25 source files") as found:
        L.load_readings(spark, src, table, state, delay_seconds=0)
    listed = str(found.value).split("listed in ")[1].split(". Restore")[0]
    assert spark.read.parquet(listed).count() == 25


def test_an_error_that_stays_is_not_tried_again():
    calls = []

    def wrong():
        calls.append(1)
        raise ValueError("no")

    with pytest.raises(L.GaveUp) as found:
        L.persistently(wrong, 5, 0)
    assert len(calls) == found.value.attempts == 1


def test_load_report_sums_what_the_batches_kept(spark, scratch, raw_pdf):
    src, table, state = f"{scratch}/src", f"{scratch}/readings", f"{scratch}/state"
    write_parts(raw_pdf, src, n=3)
    labels = L.SourceLabels(dataset="d", url="http://example.org/d")
    L.load_readings(spark, src, table, state, delay_seconds=0, labels=labels)
    report = L.load_report(spark, L.load_state(spark, table, state))
    totals = report["totals"].first()
    assert (totals["total_rows_seen"], totals["batches"]) == (1015, 3) and totals["consequences"]
    assert totals["rejected_reasons"] == {"missing_ts": 12, "invalid_ts": 11, "missing_device": 22}
    assert totals["invalid_measurement_values"]["invalid_numeric_lpg"] == 12
    assert sum(r["documents"] for r in report["device_counts"].collect()) == 970
    assert {tuple(r) for r in read_readings(spark, table).select("source.dataset", "source.url").distinct().collect()} \
        == {("d", "http://example.org/d")}
