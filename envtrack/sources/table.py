"""The readings table: day folders that hold one part for each batch.

``<table>/id_version=V/event_date=D/batch=B/`` has the readings of day D that batch B brought, one row an
id. A batch is written by Spark's dynamic partition overwrite of its own parts and of nothing else, so
that doing it again, whole or after a failure at any point, leaves the same parts; the store needs no
moves and no list of commits. (A reader that opens the table while a batch is being repeated may miss
part of that batch, as with any job that overwrites files.) Copies of a reading in several batches are settled on reading, by the rule
of ``operators.dedupe``, and only on the days that several batches wrote. ``compact`` is an ordinary job
that writes the settled readings as a table of their own.

Files are laid out along a bit-interleaved key of device, time and the values that queries filter on, so
that row groups are narrow in all of them, and carry Bloom filters of the device.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envtrack import schema as S
from envtrack.functions.timecols import micros
from envtrack.operators.dedupe import dedupe_readings, settled
from envtrack.sources.storage import kept, read_if_exists, released

PARTITIONS = ["id_version", "event_date", "batch"]
STORED_SCHEMA = T.StructType([*S.READINGS_SCHEMA.fields, T.StructField("id_version", T.IntegerType()),
                              T.StructField("batch", T.StringType())])
#: Values that the published queries filter on, the most common first.
LAYOUT_FIELDS = ("smoke", "temp", "co")
LAYOUT_BITS = 8
DAY_MICROS = 86_400_000_000
COMPACTED = "compacted"


class IdVersionError(RuntimeError):
    """The table holds ids made by another version of the identity rule."""


def stored_parts(spark: SparkSession, table: str) -> DataFrame | None:
    """All copies of all readings with their batch; None for a table that was never written."""
    return read_if_exists(spark, table.rstrip("/"), STORED_SCHEMA)


def days_written(stored: DataFrame) -> DataFrame:
    """event_date, several, oldest, newest: whether several batches wrote a day, and with which id versions.

    Only the partition columns are read."""
    return stored.groupBy("event_date").agg((F.min("batch") != F.max("batch")).alias("several"),
                                            F.min("id_version").alias("oldest"), F.max("id_version").alias("newest"))


def _checked(table: str, days: DataFrame) -> bool:
    """Whether any day has several batches; refuses ids of another version."""
    several, oldest, newest = days.agg(F.bool_or("several"), F.min("oldest"), F.max("newest")).first()
    if oldest is not None and (oldest, newest) != (S.READING_ID_VERSION, S.READING_ID_VERSION):
        raise IdVersionError(f"{table} holds ids of versions {oldest} to {newest}, this library makes "
                             f"version {S.READING_ID_VERSION}; load into a new table")
    return bool(several)


def check_version(spark: SparkSession, table: str) -> None:
    stored = stored_parts(spark, table)
    if stored is not None:
        _checked(table, days_written(stored))


def read_readings(spark: SparkSession, table: str) -> DataFrame:
    """The readings as they stand (READINGS_SCHEMA); an absent table reads as an empty one.

    Which days several batches wrote is asked when the table is opened; on all other days the stored rows
    are the readings, and nothing is shuffled. Filters on day, device and time reach the scan either way.
    """
    stored = stored_parts(spark, table)
    if stored is None:
        return spark.createDataFrame([], S.READINGS_SCHEMA)
    days = days_written(stored)
    if not _checked(table, days):
        return stored.select(*S.READING_COLUMNS)
    several = days.where("several").select("event_date")
    once = stored.join(several, "event_date", "left_anti").select(*S.READING_COLUMNS)
    return once.unionByName(settled(stored.join(several, "event_date", "left_semi")))


def _part_of(value: Column, low: float | None, high: float | None) -> Column:
    """``value`` between ``low`` and ``high`` as a number of LAYOUT_BITS bits; 0 where there is none."""
    if low is None or not high > low:
        return F.lit(0).cast("bigint")
    most = (1 << LAYOUT_BITS) - 1
    share = (value.cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))
    return F.floor(F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.nanvl(share, F.lit(0.0)))), F.lit(0.0)) * most)


def layout_bounds(fields: tuple[str, ...] = LAYOUT_FIELDS) -> list[Column]:
    """The least and the greatest finite value of each field, as aggregates over readings."""
    finite = {f: F.when(F.abs(F.col(f"measurements.{f}")) < float("inf"), F.col(f"measurements.{f}")) for f in fields}
    return [x for f in fields for x in (F.min(finite[f]).alias(f"{f}_low"), F.max(finite[f]).alias(f"{f}_high"))]


def layout_key(bounds: dict[str, float | None], fields: tuple[str, ...] = LAYOUT_FIELDS) -> Column:
    """A key whose bits are, in turn, those of the device, the time of day and the ``fields``.

    Values are scaled by the ``bounds``; the layout says nothing about the content, so bounds that fit badly
    cost skipping and nothing else.
    """
    parts = [F.pmod(F.xxhash64("device"), F.lit(1 << LAYOUT_BITS)),
             _part_of(F.pmod(micros(F.col("timestamp")), F.lit(DAY_MICROS)), 0, DAY_MICROS)]
    parts += [_part_of(F.col(f"measurements.{f}"), bounds[f"{f}_low"], bounds[f"{f}_high"]) for f in fields]
    key = F.lit(0).cast("bigint")
    for bit in range(LAYOUT_BITS):
        for place, part in enumerate(parts):
            moved = F.shiftleft(F.shiftright(part, bit).bitwiseAND(F.lit(1)), bit * len(parts) + len(parts) - 1 - place)
            key = key.bitwiseOR(moved)
    return key


def write_part(rows: DataFrame, table: str, batch: str, bounds: dict | None = None, partitions: int | None = None) -> None:
    """Write ``rows``, one an id, as the parts of ``batch``, replacing what the same batch wrote before.

    Rows are range-partitioned along (day, layout key): bounds come from a sample, so that tasks are
    balanced even when one day or one device dominates, and each day gets a bounded number of files.
    ``bounds``: of the layout's values, where they are known (otherwise one job finds them).
    """
    bounds = rows.agg(*layout_bounds()).first().asDict() if bounds is None else bounds
    keyed = rows.withColumns({"id_version": F.lit(S.READING_ID_VERSION), "batch": F.lit(batch), "_key": layout_key(bounds)})
    order = ["event_date", "_key", "device", "timestamp"]
    ranged = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    (ranged.sortWithinPartitions(*order).drop("_key").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("parquet.bloom.filter.enabled#device", "true")
     .partitionBy(*PARTITIONS).parquet(table.rstrip("/")))


def merge_into_table(batch: DataFrame, table: str, name: str, bounds: dict | None = None) -> None:
    """K1: upsert ``batch`` (readings schema) into the table as the part ``name``.

    The batch's own copies are settled before it is written (a sort aggregate with map-side combine, safe
    for hot ids); copies in other batches are settled when the table is read (``read_readings``). Nothing
    that is stored is read or written anew, whatever days the batch touches. Without ``bounds`` the settled
    rows are kept until they are written, as the bounds, the ranges and the write each read them.
    """
    if bounds is not None:
        return write_part(dedupe_readings(batch), table, name, bounds)
    rows = kept(dedupe_readings(batch), "batch")
    write_part(rows, table, name)
    released(rows)


def compact(spark: SparkSession, table: str, into: str) -> None:
    """Write the readings of ``table`` as the table ``into``, one part a day and no copies left.

    Batches that come later are written to either; a reader of ``table`` is not disturbed. The copies are
    settled once: bounds, ranges and the write read the rows that are kept meanwhile."""
    rows = kept(read_readings(spark, table), "settled")
    write_part(rows, into, COMPACTED)
    released(rows)


def changes(spark: SparkSession, table: str, first: str, last: str) -> int:
    """K2 for a run: readings inserted or updated by the batches from ``first`` to ``last``, in their order.

    A batch's copy of a reading counts if the reading was new or stood with another ingest time or other
    flags. Only days that the run wrote are read, and of those only ids, ingest times and flags.
    """
    stored = stored_parts(spark, table)
    if stored is None:
        return 0
    own = F.col("batch").between(first, last)
    days = stored.where(own).select("event_date").distinct()
    touched = stored.join(days, "event_date", "left_semi")
    if touched.groupBy("event_date").agg((F.min("batch") != F.max("batch")).alias("several")).where("several").isEmpty():
        return stored.where(own).count()  # nothing but this run's parts, one for each day: all readings are new
    copies = touched.select("event_date", "reading_id", "ingested_at", F.array_join("quality.flags", ",").alias("flags"),
                            "batch", own.alias("own"))
    copy = F.struct("own", "batch", F.struct("ingested_at", "flags").alias("state"))
    stands = F.lit(None).cast("struct<ingested_at: timestamp, flags: string>")

    def after(so_far: Column, one: Column) -> Column:
        before = so_far["stands"]
        counts = one["own"] & (before.isNull() | (before != one["state"]))
        newest = F.when(before.isNull() | (before < one["state"]), one["state"]).otherwise(before)
        return F.struct(newest.alias("stands"), (so_far["n"] + counts.cast("bigint")).alias("n"))

    start = F.struct(stands.alias("stands"), F.lit(0).cast("bigint").alias("n"))
    of_id = copies.groupBy("event_date", "reading_id").agg(
        F.sort_array(F.collect_list(copy)).alias("copies"))
    return of_id.agg(F.sum(F.aggregate("copies", start, after)["n"])).first()[0] or 0
