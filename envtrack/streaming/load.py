"""Resumable batch load: CSV files -> readings table.

Two granularities share one way of handling a batch (``BatchLoad``):

* ``load_readings``: a file stream with ``maxFilesPerTrigger`` and ``trigger(availableNow=True)``; a
  batch is one or several files, and Spark's offset and commit logs under ``checkpoint`` remember
  which files are done;
* ``load_in_row_batches``: batches of a fixed number of rows, numbered in file order through all files
  (by name). The numbered rows are staged once as Parquet, sorted by batch, so that a range of batches
  is read by row-group statistics; the last finished batch is written down after each step.

What holds for both:

* resume: a second run continues behind the last finished batch; a batch that failed is done again;
* stop after N batches: the run ends successfully with batch N+1 untouched;
* the upsert is tried ``max_attempts`` times, ``delay_seconds`` apart, unless the error is one that
  another attempt cannot cure; tasks are retried by Spark itself;
* failure: one record with the whole error text is appended, the error propagates, nothing is
  marked as done;
* repeating a batch is safe: all that a batch writes, its readings too, overwrites partitions of its own
  (``sources.table``) by Spark's dynamic partition overwrite, and copies are settled on reading;
* reset: a new *generation* of state folders is started; the readings table is kept, nothing is deleted;
* source: state belongs to one source path, and files already loaded must keep size and time.

Loads with states of their own write parts of their own and may share a table; one state serves one load
at a time.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envtrack import schema as S
from envtrack.operators.batches import assign_batches, group_offsets
from envtrack.operators.quality import batch_counters, quality_counts, quality_report, quality_report_full
from envtrack.operators.transform import SourceLabels, accepted_readings, classify_rows, rejected_rows
from envtrack.session import state_path
from envtrack.sources.csv import csv_options, header_of, read_files, require_header, text_schema, with_file_order
from envtrack.sources.manifest import SourceChangedError, guard_unchanged, source_manifest
from envtrack.sources.storage import is_complete, kept, read_if_exists
from envtrack.sources.table import IdVersionError, changes, check_version, layout_bounds, merge_into_table
from envtrack.streaming.sinks import append_failure, write_batch_partition

STOP_MARKER = "envtrack:stop-after-max-batches"


class StopLoad(Exception):
    """Raised inside the batch callback to end a run after ``max_batches`` (not an error)."""

    def __init__(self):
        super().__init__(STOP_MARKER)


class LoadFailed(RuntimeError):
    """A batch failed after its retries; it was not marked as done."""


@dataclass
class LoadSummary:
    batches_processed_this_run: int
    last_batch_id: int | None
    total_rows_seen: int
    rows_loaded: int
    rows_rejected: int
    rows_with_quality_flags: int
    total_inserted_or_updated_this_run: int
    stopped_early: bool
    reset_checkpoint: bool
    generation: int
    start_time: str
    end_time: str
    duration_seconds: float
    step_seconds: dict | None = None
    source: str | None = None
    table: str | None = None
    checkpoint_path: str | None = None

    def as_dict(self) -> dict:
        return asdict(self)


# --- state ------------------------------------------------------------------------------------

@dataclass
class LoadPaths:
    root: str
    generation: int
    checkpoint: str

    @property
    def base(self) -> str:
        return f"{self.root}/g{self.generation}"

    @property
    def rejected(self) -> str:
        return f"{self.base}/rejected"

    @property
    def batch_log(self) -> str:
        """Counters of each batch (A1)."""
        return f"{self.base}/batch_log"

    @property
    def manifest(self) -> str:
        """The files that each batch consumed (S3)."""
        return f"{self.base}/manifest"

    @property
    def quality(self) -> str:
        """Rejections by reason, flags by kind and rows by device of each batch (A2-A4)."""
        return f"{self.base}/quality"

    @property
    def failures(self) -> str:
        return f"{self.base}/failures"

    @property
    def progress(self) -> str:
        """The last finished row batch, one partition for each step."""
        return f"{self.base}/progress"

    def part(self, batch_id: int) -> str:
        """The name of a batch's part in the table: of this state and generation, in the batches' order."""
        return f"{hashlib.md5(self.root.encode()).hexdigest()[:12]}-{self.generation:06d}-{batch_id:015d}"


GEN_SCHEMA = T.StructType([T.StructField("generation", T.IntegerType()),
                           T.StructField("created_at", T.TimestampType())])
SOURCE_SCHEMA = T.StructType([T.StructField("source", T.StringType()), T.StructField("fingerprint", T.StringType()),
                              T.StructField("batch_size", T.LongType())])
BATCH_LOG_SCHEMA = T.StructType([*S.BATCH_STATUS_SCHEMA.fields, T.StructField("source_file", T.StringType()),
                                 T.StructField("batch_id", T.LongType())])
LOG_ROW = ("batch_number bigint, rows_read bigint, documents_built bigint, invalid_rows bigint, "
           "rows_with_quality_flags bigint, source_file string")
MANIFEST_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
                                T.StructField("modificationTime", T.TimestampType()),
                                T.StructField("batch_id", T.LongType())])
QUALITY_SCHEMA = T.StructType([T.StructField("kind", T.StringType()), T.StructField("key", T.StringType()),
                               T.StructField("n", T.LongType()), T.StructField("batch_id", T.LongType())])
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"  # of the binaryFile source
PROGRESS_SCHEMA = T.StructType([T.StructField("done", T.LongType()), T.StructField("step", T.LongType())])


def current_generation(spark: SparkSession, root: str) -> int:
    gens = read_if_exists(spark, f"{root}/generations", GEN_SCHEMA)
    newest = gens.agg(F.max("generation")).first()[0] if gens is not None else None
    return newest or 0


def new_generation(spark: SparkSession, root: str) -> int:
    g = current_generation(spark, root) + 1
    spark.createDataFrame([(g, _dt.datetime.now(_dt.timezone.utc))], GEN_SCHEMA) \
        .coalesce(1).write.mode("append").parquet(f"{root}/generations")
    return g


def resolve_paths(spark: SparkSession, state: str | None, table: str, reset: bool,
                  checkpoint_path: str | None) -> LoadPaths:
    """The state folders of the generation in force (of a new one with ``reset``).

    A checkpoint path of the caller's own belongs to generation 0 as it is and to later generations by
    a folder below it, so that every run finds the folder that the generation began with.
    """
    root = (state or state_path(spark, "load", table.strip("/").replace("/", "_").replace(":", "_"))).rstrip("/")
    gen = new_generation(spark, root) if reset else current_generation(spark, root)
    own = (checkpoint_path or "").rstrip("/")
    if not own:
        return LoadPaths(root, gen, f"{root}/g{gen}/checkpoint")
    return LoadPaths(root, gen, f"{own}/g{gen}" if gen else own)


def load_state(spark: SparkSession, table: str, state: str | None = None,
               checkpoint_path: str | None = None) -> LoadPaths:
    """Paths of the current generation (for reading rejected rows, status, failures)."""
    return resolve_paths(spark, state, table, False, checkpoint_path)


def bind_source(spark: SparkSession, paths: LoadPaths, source: str, fingerprint: str | None = None,
                batch_size: int | None = None) -> None:
    """A generation's state belongs to one source (and cut); another one is refused."""
    at, now = f"{paths.base}/source", (source.rstrip("/"), fingerprint, batch_size)
    if not is_complete(spark, at):
        spark.createDataFrame([now], SOURCE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(at)
        return
    recorded = read_if_exists(spark, at, SOURCE_SCHEMA)
    before = tuple(recorded.first())
    if before != now:
        raise SourceChangedError(f"this state belongs to source {before[0]} (fingerprint {before[1]}, batch size "
                                 f"{before[2]}), not to {now[0]} ({now[1]}, {now[2]}); restore it, use another "
                                 "state, or start over with reset=True")


def counters_by_batch(classified: DataFrame) -> DataFrame:
    """A1 of rows numbered by ``numbered_batches``: the counters of every batch in one aggregate."""
    return classified.groupBy("source_file", "batch_number").agg(*batch_counters())


def batch_log_table(spark: SparkSession, paths: LoadPaths) -> DataFrame:
    """One row for each batch, with the source file of row batches."""
    log = read_if_exists(spark, paths.batch_log, BATCH_LOG_SCHEMA)
    return spark.createDataFrame([], BATCH_LOG_SCHEMA) if log is None else log


def batch_status_table(spark: SparkSession, paths: LoadPaths) -> DataFrame:
    """A1 table of the current generation: one row per batch."""
    return batch_log_table(spark, paths).select(*[f.name for f in S.BATCH_STATUS_SCHEMA.fields])


def manifest_table(spark: SparkSession, paths: LoadPaths) -> DataFrame | None:
    """S3 as recorded: path, size and modification time of every file a batch consumed."""
    return read_if_exists(spark, paths.manifest, MANIFEST_SCHEMA)


def cumulative_report(spark: SparkSession, paths: LoadPaths) -> DataFrame:
    """A5 over the current generation's batches: the totals, one row."""
    return quality_report(batch_status_table(spark, paths))


def load_report(spark: SparkSession, paths: LoadPaths) -> dict[str, DataFrame]:
    """A5 in full, from what the batches kept: nothing is read again from the source."""
    kept = read_if_exists(spark, paths.quality, QUALITY_SCHEMA)
    kept = spark.createDataFrame([], QUALITY_SCHEMA) if kept is None else kept
    return quality_report_full(kept, batch_status_table(spark, paths))


# --- one batch --------------------------------------------------------------------------------

#: Errors that the same attempt would meet again.
LASTING = (AnalysisException, IdVersionError, ValueError, TypeError)


class GaveUp(RuntimeError):
    """The last of ``attempts`` failed with the error that this one is raised from."""

    def __init__(self, attempts: int, cause: Exception):
        super().__init__(f"{type(cause).__name__}: {cause}")
        self.attempts = attempts


def persistently(action: Callable[[], object], most: int, pause: float) -> object:
    """T5: the result of ``action``, tried anew after errors that may pass."""
    made = 0
    while True:
        made += 1
        try:
            return action()
        except Exception as error:  # noqa: BLE001 - storage errors come in many classes
            if made >= most or isinstance(error, LASTING):
                raise GaveUp(made, error) from error
        time.sleep(pause)


@dataclass
class BatchLoad:
    """What one batch of raw rows goes through; the same for files and for row batches."""
    spark: SparkSession
    paths: LoadPaths
    table: str
    ingested_at: _dt.datetime
    labels: SourceLabels
    max_attempts: int
    delay_seconds: float
    batches: int = 0
    first: int | None = None
    last: int | None = None
    steps: dict[str, float] = field(default_factory=dict)

    def timed(self, name: str, action: Callable[[], object]) -> object:
        since = time.perf_counter()
        try:
            return action()
        finally:
            self.steps[name] = round(self.steps.get(name, 0.0) + time.perf_counter() - since, 3)

    def run(self, batch: DataFrame, batch_id: int, number: int | None, keep: list[str],
            listing: DataFrame | None = None) -> None:
        """``number``: the batch's number; None if column ``batch_number`` tells several batches apart.
        ``listing`` has the files that the batch consumed, if files are recorded."""
        classified = classify_rows(batch, self.ingested_at, keep=keep, labels=self.labels).persist()
        totals, attempts = None, 1
        try:
            totals = self.timed("classify_and_count", lambda: classified.agg(*batch_counters(), *layout_bounds()).first())
            self.timed("writes", lambda: self._write(classified, totals.asDict(), batch_id, number, listing))
        except Exception as error:
            attempts = error.attempts if isinstance(error, GaveUp) else 1
            counts = (None, None) if totals is None else (totals["rows_read"], totals["documents_built"])
            append_failure(self.spark, self.paths.failures, batch_id, attempts,
                           str(error) if isinstance(error, GaveUp) else f"{type(error).__name__}: {error}", *counts)
            raise
        finally:
            classified.unpersist()
        self.batches += 1
        self.first = batch_id if self.first is None else self.first
        self.last = batch_id

    def _write(self, classified: DataFrame, totals: dict, batch_id: int, number: int | None,
               listing: DataFrame | None) -> None:
        """All writes read the persisted batch, go to different paths and may be repeated, so they run
        as concurrent jobs; all must finish before the batch counts as done."""
        if number is None:
            log = counters_by_batch(classified)
            rejected = rejected_rows(classified, keep=["batch_number", "source_file"])
        else:
            row = [totals[c] for c in ("rows_read", "documents_built", "invalid_rows", "rows_with_quality_flags")]
            log = self.spark.createDataFrame([(number, *row, None)], LOG_ROW).coalesce(1)
            rejected = rejected_rows(classified, keep=["_file"]).withColumns(
                {"source_file": F.regexp_extract("_file", "[^/]+$", 0), "batch_number": F.lit(number).cast("bigint")}).drop("_file")
        writes = [(log, self.paths.batch_log), (rejected, self.paths.rejected),
                  (quality_counts(classified), self.paths.quality)]
        if listing is not None:
            writes.append((listing, self.paths.manifest))
        docs, part = accepted_readings(classified), self.paths.part(batch_id)
        with ThreadPoolExecutor(max_workers=len(writes) + 1) as pool:
            jobs = [pool.submit(persistently, lambda: merge_into_table(docs, self.table, part, totals),
                                self.max_attempts, self.delay_seconds)]
            jobs += [pool.submit(write_batch_partition, df, path, batch_id) for df, path in writes]
            for job in jobs:
                job.result()  # re-raises the first failure

    def summary(self, source: str, start: _dt.datetime, stopped: bool, reset: bool) -> LoadSummary:
        totals = self.timed("report", lambda: cumulative_report(self.spark, self.paths).first())
        changed = 0 if self.first is None else self.timed("upsert_counts", lambda: changes(
            self.spark, self.table, self.paths.part(self.first), self.paths.part(self.last)))
        end = _dt.datetime.now(_dt.timezone.utc)
        return LoadSummary(
            batches_processed_this_run=self.batches, last_batch_id=self.last,
            total_rows_seen=int(totals["total_rows_seen"]), rows_loaded=int(totals["rows_loaded"]),
            rows_rejected=int(totals["rows_rejected"]),
            rows_with_quality_flags=int(totals["rows_with_quality_flags"]),
            total_inserted_or_updated_this_run=changed, stopped_early=stopped, reset_checkpoint=reset,
            generation=self.paths.generation, start_time=start.isoformat(), end_time=end.isoformat(),
            duration_seconds=round((end - start).total_seconds(), 3), step_seconds=dict(self.steps), source=source,
            table=self.table, checkpoint_path=self.paths.checkpoint)


def _check_arguments(max_batches: int | None, **least_one: int) -> None:
    for name, value in {"max_batches": max_batches, **least_one}.items():
        if value is not None and value < 1:
            raise ValueError(f"{name} must be >= 1")


def _columns_of(spark: SparkSession, listing: DataFrame) -> list[str]:
    """The columns of the first file that is not empty, in its order."""
    first = listing.where("length > 0").select(F.min("path")).first()[0]
    if first is None:
        return list(S.REQUIRED_COLUMNS)
    return require_header(header_of(spark, first), first)


# --- batches of files -------------------------------------------------------------------------

def load_readings(spark: SparkSession, source: str, table: str, state: str | None = None, *,
                  max_batches: int | None = None, reset: bool = False, checkpoint_path: str | None = None,
                  files_per_batch: int = 1, max_attempts: int = 3, delay_seconds: float = 2.0,
                  pattern: str = "*.csv", ingested_at: _dt.datetime | None = None,
                  labels: SourceLabels | None = None, multi_line: bool = False) -> LoadSummary:
    """Load every CSV file under ``source`` into the readings table at ``table``.

    Files are taken in the order of their modification times, each with the column order of its own
    header. ``labels``: where the readings come
    from, stored with each of them. ``multi_line``: quoted cells may hold line breaks; files are then
    read whole by one task each.

    Returns a summary; raises ``LoadFailed`` when a batch failed (re-run to retry it),
    ``SourceChangedError`` when a loaded file changed or the state belongs to another source,
    ``MissingColumnsError`` on a bad header.
    """
    _check_arguments(max_batches, files_per_batch=files_per_batch, max_attempts=max_attempts)
    start = _dt.datetime.now(_dt.timezone.utc)
    paths = resolve_paths(spark, state, table, reset, checkpoint_path)
    load = BatchLoad(spark, paths, table, ingested_at or start, labels or SourceLabels(), max_attempts, delay_seconds)

    def prepared() -> DataFrame:
        check_version(spark, table)
        bind_source(spark, paths, source)
        listing = source_manifest(spark, source, pattern)
        guard_unchanged(listing, manifest_table(spark, paths), f"{paths.base}/changed_files")
        _columns_of(spark, listing)  # refuse a wrong source before anything is written
        stream = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", pattern)
                  .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(source))
        return stream.select("path", "length", "modificationTime")  # no file's content is read here

    def process(files: DataFrame, batch_id: int) -> None:
        if max_batches is not None and load.batches >= max_batches:
            raise StopLoad()
        paths_of = [r["path"] for r in files.select("path").orderBy("path").collect()]  # files_per_batch at most
        rows = read_files(spark, paths_of, multi_line)
        rows = spark.createDataFrame([], text_schema([*S.REQUIRED_COLUMNS, "_file"])) if rows is None else rows
        load.run(rows, batch_id, batch_id + 1, ["_file"], files)

    query = (load.timed("setup", prepared).writeStream.foreachBatch(process)
             .option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start())
    stopped = False
    try:
        query.awaitTermination()
    except StreamingQueryException as exc:
        stopped = STOP_MARKER in str(exc)
        if not stopped:
            raise LoadFailed(f"batch failed, checkpoint not advanced: {exc}") from exc
    finally:
        if query.isActive:
            query.stop()
    return load.summary(source, start, stopped, reset)


# --- batches of rows --------------------------------------------------------------------------

def source_fingerprint(spark: SparkSession, source: str, pattern: str = "*.csv") -> str:
    """Order-independent fingerprint of a source listing (paths, sizes, modification times).

    A sum of per-file 64-bit hashes, computed as one aggregate: nothing is collected per file.
    """
    listing = source_manifest(spark, source, pattern)
    row = listing.agg(F.count("*").alias("n"), F.sum(F.xxhash64("path", "length", "modificationTime")
                                                   .cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}_{str(row['h'] or 0).replace('-', 'm')}"


def numbered_batches(rows: DataFrame, group, fine: list, batch_size: int, file_col: str) -> DataFrame:
    """Rows with ``position`` and ``batch_number`` within their file and ``ordinal``, the batch's
    number through all files in the order of their names.

    Positions come from ``assign_batches`` (no global window). The files' batch counts are put in the order
    of their names by a range sort and summed by the same tree, so that no task sees all files.
    """
    placed = assign_batches(rows, group, fine, batch_size, within=[file_col])
    files = placed.groupBy(F.col(file_col).alias("_name")).agg(F.max("batch_number").alias("_b"))
    files = kept(files.orderBy("_name").withColumn("_at", F.monotonically_increasing_id()), "files")
    before = files.join(group_offsets(files, "_at", "_b", []), F.col("_at") == F.col("_og")).select("_name", "_off")
    return placed.join(before, F.col(file_col) == F.col("_name")).withColumn(
        "ordinal", F.col("_off") + F.col("batch_number")).drop("_name", "_off")


def stage_batches(numbered: DataFrame, dest: str) -> None:
    """Write numbered rows sorted by batch: a range of batches is found by row-group statistics."""
    columns = ["ordinal", "batch_number", "position", "source_file", *S.REQUIRED_COLUMNS]
    ranged = numbered.select(*columns).repartitionByRange("ordinal", "position")
    ranged.sortWithinPartitions("ordinal", "position").write.mode("overwrite").parquet(dest)


def _csv_batches(spark: SparkSession, source: str, pattern: str, batch_size: int, multi_line: bool) -> DataFrame:
    columns = _columns_of(spark, source_manifest(spark, source, pattern))
    scan = (spark.read.options(**csv_options(multi_line)).schema(text_schema(columns))
            .option("pathGlobFilter", pattern).csv(source))
    named = with_file_order(scan).withColumnRenamed("_file", "source_file")
    return numbered_batches(named, "_block", ["_scan_seq"], batch_size, "source_file")


def load_staged_batches(spark: SparkSession, staged: str, load: BatchLoad, max_batches: int | None,
                        batches_per_trigger: int) -> bool:
    """The batches behind the last finished one, in order; True if it stopped with batches left."""
    rows = spark.read.parquet(staged)
    progress = read_if_exists(spark, load.paths.progress, PROGRESS_SCHEMA)
    done = (progress.agg(F.max("done")).first()[0] if progress is not None else None) or 0
    total = rows.agg(F.max("ordinal")).first()[0] or 0
    goal = total if max_batches is None else min(total, done + max_batches)
    while done < goal:
        first, last = done + 1, min(goal, done + batches_per_trigger)
        part = rows.where(F.col("ordinal").between(first, last))
        load.run(part, first, None, ["batch_number", "source_file"])
        load.batches += last - first  # run() counted one
        (spark.createDataFrame([(last, first)], PROGRESS_SCHEMA).coalesce(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("step").parquet(load.paths.progress))
        done = last
    return done < total


def load_in_row_batches(spark: SparkSession, source: str, table: str, state: str | None = None, *,
                        batch_size: int = S.DEFAULT_BATCH_SIZE, max_batches: int | None = None,
                        reset: bool = False, checkpoint_path: str | None = None, pattern: str = "*.csv",
                        batches_per_trigger: int = 1000, max_attempts: int = 3, delay_seconds: float = 2.0,
                        ingested_at: _dt.datetime | None = None, labels: SourceLabels | None = None,
                        multi_line: bool = False) -> LoadSummary:
    """J1 in batches of ``batch_size`` rows, in file order: files by name, rows as they stand.

    The numbered rows are staged under the state folder, keyed by the source's fingerprint, and reused
    by later runs. ``batches_per_trigger`` batches are handled in one step (far fewer Spark jobs); the
    batch log, the rejected rows and ``max_batches`` still go by row batches.
    """
    _check_arguments(max_batches, batch_size=batch_size, batches_per_trigger=batches_per_trigger,
                     max_attempts=max_attempts)
    start = _dt.datetime.now(_dt.timezone.utc)
    paths = resolve_paths(spark, state, table, reset, checkpoint_path)
    load = BatchLoad(spark, paths, table, ingested_at or start, labels or SourceLabels(), max_attempts, delay_seconds)

    def prepared() -> str:
        check_version(spark, table)
        fingerprint = source_fingerprint(spark, source, pattern)
        bind_source(spark, paths, source, fingerprint, batch_size)
        staged = f"{paths.root}/staged/{fingerprint}_{batch_size}"
        if not is_complete(spark, staged):
            stage_batches(_csv_batches(spark, source, pattern, batch_size, multi_line), staged)
        return staged

    staged = load.timed("setup", prepared)
    try:
        stopped = load_staged_batches(spark, staged, load, max_batches, batches_per_trigger)
    except Exception as exc:
        raise LoadFailed(f"batch failed, not marked as done: {exc}") from exc
    return load.summary(source, start, stopped, reset)


__all__ = ["BatchLoad", "LoadFailed", "LoadSummary", "StopLoad", "batch_log_table", "batch_status_table",
           "cumulative_report", "load_in_row_batches", "load_readings", "load_report", "load_staged_batches",
           "load_state", "manifest_table", "numbered_batches", "resolve_paths", "source_fingerprint",
           "stage_batches"]
