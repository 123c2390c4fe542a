"""Raw text readings derived from the driver's ``events`` table.

The reference ships no input file, so the bulk input is derived from ``events`` by the rule written
down in FIXTURES.md section 3 (the same rule runs in DuckDB for the oracle). It produces every case
the loader must handle: missing and bad timestamps, blank devices, bad and alternative spellings of
measurements, millisecond timestamps and exact duplicate rows.

Spark form: one scan of ``events`` and one projection. The exact-duplicate rows (the second
``UNION ALL`` branch of the rule) are generated by ``posexplode(array_repeat(row, copies))`` on
the same scan rather than by a second scan and a union. Two provenance columns are kept for ordering only and are never input to
the transform: ``_part`` (0 = original row, 1 = appended copy) and ``_seq`` (the event id).
File order is ``(_part, _seq)``: originals by event id, then the copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envtrack import schema as S
from envtrack.functions.timecols import micros, ntz_micros

ORDER_COLUMNS = ["_part", "_seq"]


def _event_micros(events: DataFrame) -> F.Column:
    if isinstance(events.schema["ts"].dataType, T.TimestampNTZType):
        return ntz_micros(F.col("ts"))
    return micros(F.col("ts"))


def raw_readings_from_events(events: DataFrame, keep_order: bool = False) -> DataFrame:
    """Nine string columns (``REQUIRED_COLUMNS``), plus ``_part``/``_seq`` when ``keep_order``."""
    events = events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    e = events.select(
        F.col("event_id"),
        F.col("user_id"),
        F.col("event_type"),
        _event_micros(events).cast("string").alias("us"),
        F.round(F.col("value") * 100).cast("bigint").alias("c"),
        F.regexp_extract(F.col("props"), "[0-9]+", 0).alias("k"),
    )
    eid, us, c, k, etype = F.col("event_id"), F.col("us"), F.col("c"), F.col("k"), F.col("event_type")
    m97, m89, m83 = eid % 97, eid % 89, eid % 83

    def pad5(x):
        return F.lpad(x.cast("string"), 5, "0")

    ts = (F.when(m97 == 0, F.lit("")).when(m97 == 1, F.lit("not-a-timestamp"))
          .when(m83 == 0, F.substring(us, 1, 13))
          .otherwise(F.concat(F.substring(us, 1, 10), F.lit("."), F.substring(us, 11, 6))))
    device = (F.when(m97 == 2, F.lit("")).when(m97 == 3, F.lit("   "))
              .otherwise(F.concat(F.lit("dev-"), F.lpad(F.col("user_id").cast("string"), 4, "0"))))
    co = F.when(m89 == 0, F.lit("bad-value")).otherwise(F.concat(F.lit("0."), pad5(c % 10000)))
    humidity = F.when(m89 == 3, F.lit("N/A")).otherwise(F.concat(k, F.lit(".0")))
    light = (F.when(m89 == 1, F.lit("maybe")).when(etype == "view", F.lit("true"))
             .otherwise(F.lit("false")))
    lpg = F.when(m89 == 6, F.lit("1d")).otherwise(F.concat(F.lit("0."), pad5((c * 7) % 10000)))
    motion = (F.when(m89 == 4, F.lit("1")).when(etype == "click", F.lit("TRUE"))
              .otherwise(F.lit("FALSE")))
    smoke = F.when(m89 == 5, F.lit("true")).otherwise(F.concat(F.lit("0."), pad5(c)))
    temp = (F.when(m89 == 2, F.lit(""))
            .otherwise(F.concat((k.cast("int") % 40).cast("string"), F.lit("."), (c % 10).cast("string"))))

    cols = [ts.alias("ts"), device.alias("device"), co.alias("co"), humidity.alias("humidity"),
            light.alias("light"), lpg.alias("lpg"), motion.alias("motion"), smoke.alias("smoke"),
            temp.alias("temp"), eid.alias("_seq")]
    # each row once, plus an exact copy when event_id % 71 = 0; the row is built once and repeated,
    # and its cells come out of the generator, so later filters stop here instead of re-deriving text
    copies = F.when(eid % 71 == 0, F.lit(2)).otherwise(F.lit(1))
    rows = e.select(F.posexplode(F.array_repeat(F.struct(*cols), copies)).alias("_part", "_r"))
    out = [F.col(f"_r.{c}").alias(c) for c in S.REQUIRED_COLUMNS]
    if keep_order:
        out += [F.col("_part"), F.col("_r._seq").alias("_seq")]
    return rows.select(*out)


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_readings(spark: SparkSession, sf_dir: str, keep_order: bool = False) -> DataFrame:
    """Raw readings derived from ``{sf_dir}/events.parquet``."""
    return raw_readings_from_events(load_events(spark, sf_dir), keep_order=keep_order)


__all__ = ["ORDER_COLUMNS", "load_events", "raw_readings", "raw_readings_from_events", "S"]
