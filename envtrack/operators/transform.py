"""Row transformation: raw text rows -> accepted readings and rejected rows.

The whole classification is a chain of projections of native expressions (whole-stage codegen,
no Python in the data path). ``classify_rows`` adds a ``rejection_reason`` column (null = accepted) next to
the parsed reading; ``accepted_readings`` and ``rejected_rows`` are two filters over it, so a caller
that needs both persists the classified frame once.

Rejection order (first hit wins): ``missing_ts`` -> ``invalid_ts`` -> ``missing_device`` ->
``empty_device``. ``empty_device`` cannot occur for text input (blank text is already missing);
it stays in the vocabulary.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envtrack import schema as S
from envtrack.functions.cells import (
    bool_from_parts, clean_text, epoch_in_range, epoch_number, epoch_to_micros, float_from_parts,
    issue_from_parts, missing_from_clean, strict_number,
)
from envtrack.functions.identity import reading_id
from envtrack.functions.timecols import MICROS_PER_DAY


@dataclass(frozen=True)
class SourceLabels:
    """Where readings come from, stored with each of them."""
    dataset: str = S.SOURCE_DATASET
    platform: str = S.SOURCE_PLATFORM
    url: str | None = None

    def column(self) -> Column:
        return F.struct(F.lit(self.dataset).alias("dataset"), F.lit(self.platform).alias("platform"),
                        F.lit(self.url).cast("string").alias("url"))


def classify_rows(raw: DataFrame, ingested_at: _dt.datetime | None = None,
                  keep: list[str] | None = None, labels: SourceLabels | None = None) -> DataFrame:
    """Raw rows -> one row per input row with ``rejection_reason`` and the parsed reading.

    ``ingested_at`` is one literal per load run (never ``current_timestamp`` per query), so a
    replayed batch produces identical rows. ``keep`` names extra input columns to carry along
    (provenance such as batch numbers).

    The work is split into stages (clean text -> missing/number tests -> values -> issues, flags,
    reason -> id). Each stage reads the previous stage's columns, so every regex and cast runs once
    per cell: Catalyst does not re-inline an expensive column that is used more than once, and a
    filter on ``rejection_reason`` pushed below the last stage costs a few column reads.
    """
    if ingested_at is None:
        ingested_at = _dt.datetime.now(_dt.timezone.utc)
    out = raw
    for stage in _classify_stages(tuple(keep or ()), labels or SourceLabels()):
        out = out.select(*stage)
    ingest = F.when(F.col("rejection_reason").isNull(), F.lit(ingested_at).cast("timestamp"))
    cols = [c for c in out.columns if c != "event_date"]
    return out.select(*cols, ingest.alias("ingested_at"), "event_date")


_STAGE_CACHE: dict = {}


def _classify_stages(keep: tuple, labels: SourceLabels) -> list[list[Column]]:
    """Column expressions of the five stages, built once per (session, kept columns).

    Building ~2,000 expression nodes through the Python API costs most of a second per call; the
    load calls ``classify_rows`` once per micro-batch, so the finished (DataFrame-independent)
    expressions are reused.
    """
    from pyspark import SparkContext

    key = (id(SparkContext._active_spark_context), keep, labels)
    if key not in _STAGE_CACHE:
        if len(_STAGE_CACHE) > 32:
            _STAGE_CACHE.clear()
        _STAGE_CACHE[key] = _build_stages(list(keep), labels)
    return _STAGE_CACHE[key]


def _build_stages(keep: list[str], labels: SourceLabels) -> list[list[Column]]:
    keep_cols = [F.col(c) for c in keep]
    keep_names = [F.col(c) for c in keep]
    cells = S.REQUIRED_COLUMNS
    parsed = ["ts"] + S.FLOAT_FIELDS + S.BOOL_FIELDS

    # 1. raw snapshot + cleaned text of every cell
    s1 = [*keep_cols, *[F.col(c) for c in cells],
                    *[clean_text(F.col(c)).alias(f"_t_{c}") for c in cells]]
    # 2. missing test and strict number of every parsed cell
    s2 = [*keep_names, *[F.col(c) for c in cells], *[F.col(f"_t_{c}") for c in parsed],
                   *[missing_from_clean(F.col(c), F.col(f"_t_{c}")).alias(f"_m_{c}") for c in cells],
                   epoch_number(F.col("_t_ts")).alias("_n_ts"),
                   *[strict_number(F.col(f"_t_{c}")).alias(f"_n_{c}") for c in parsed[1:]]]
    # 3. typed values, epoch, trimmed device, rejection reason
    values = [float_from_parts(F.col(f"_t_{f}"), F.col(f"_m_{f}"), F.col(f"_n_{f}")).alias(f"_v_{f}")
              for f in S.FLOAT_FIELDS]
    values += [bool_from_parts(F.col(f"_t_{f}"), F.col(f"_m_{f}"), F.col(f"_n_{f}")).alias(f"_v_{f}")
               for f in S.BOOL_FIELDS]
    ts_raw = F.when(~F.col("_m_ts"), F.col("_n_ts"))
    device = F.trim(F.col("device"), F.lit(S.WHITESPACE))
    reason = (
        F.when(F.col("_m_ts"), F.lit(S.REJECT_MISSING_TS))
        .when(~epoch_in_range(F.col("_n_ts")), F.lit(S.REJECT_INVALID_TS))
        .when(F.col("_m_device"), F.lit(S.REJECT_MISSING_DEVICE))
        .when(device == "", F.lit(S.REJECT_EMPTY_DEVICE))
    )
    s3 = [*keep_names, F.struct(*[F.col(c) for c in cells]).alias("row"),
                   reason.alias("rejection_reason"), ts_raw.alias("_ts_raw"), device.alias("_device"),
                   *[F.col(f"_m_{f}") for f in S.FLOAT_FIELDS + S.BOOL_FIELDS], *values]
    # 4. accepted-only columns: measurements, flags
    ok = F.col("rejection_reason").isNull()
    kinds = {f: S.ISSUE_NUMERIC for f in S.FLOAT_FIELDS} | {f: S.ISSUE_BOOLEAN for f in S.BOOL_FIELDS}
    flags = F.array_compact(F.array(*[
        F.when(issue_from_parts(F.col(f"_m_{f}"), F.col(f"_v_{f}"), kinds[f]).isNotNull(),
               F.concat(issue_from_parts(F.col(f"_m_{f}"), F.col(f"_v_{f}"), kinds[f]), F.lit("_" + f)))
        for f in S.FLOAT_FIELDS + S.BOOL_FIELDS]))
    # struct fields in sorted name order (also the key order of the canonical id text)
    measurements = F.struct(*[F.col(f"_v_{n}").alias(n) for n in sorted(S.FLOAT_FIELDS + S.BOOL_FIELDS)])
    # the raw snapshot is kept for rejected rows only (accepted rows carry the parsed reading)
    s4 = [*keep_names, F.when(~ok, F.col("row")).alias("row"), "rejection_reason",
                   F.when(ok, F.col("_ts_raw")).alias("timestamp_unix"),
                   F.when(ok, F.col("_device")).alias("device"),
                   F.when(ok, measurements).alias("measurements"),
                   F.when(ok, flags).alias("_flags"),
                   F.when(ok, epoch_to_micros(F.col("_ts_raw"))).alias("_us")]
    # 5. id, timestamp, quality, constants
    ts = F.timestamp_micros(F.col("_us"))
    ok = F.col("rejection_reason").isNull()
    s5 = [
        *keep_names, "row", "rejection_reason",
        F.when(ok, reading_id(F.col("device"), F.col("measurements"), F.col("timestamp_unix"))).alias("reading_id"),
        ts.alias("timestamp"),
        "timestamp_unix", "device", "measurements",
        F.when(ok, F.struct(
            (F.size("_flags") == 0).alias("is_valid"),
            F.col("_flags").alias("flags"),
            F.size("_flags").cast("int").alias("invalid_measurement_count"),
        )).alias("quality"),
        F.when(ok, labels.column()).alias("source"),
        F.date_from_unix_date(F.floor(F.col("_us") / MICROS_PER_DAY).cast("int")).alias("event_date"),
    ]
    return [s1, s2, s3, s4, s5]


def accepted_readings(classified: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Documents built from accepted rows, in the stored readings schema."""
    return (classified.where(F.col("rejection_reason").isNull())
            .select(*[F.col(c) for c in (keep or [])], *S.READING_COLUMNS))


def rejected_rows(classified: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rejected rows with their reason and a snapshot of the nine raw cells."""
    return (classified.where(F.col("rejection_reason").isNotNull())
            .select(*[F.col(c) for c in (keep or [])], "rejection_reason", "row"))


def transform_readings(raw: DataFrame, ingested_at: _dt.datetime | None = None) -> DataFrame:
    """Raw rows -> accepted readings (duplicates still present; see ``dedupe_readings``)."""
    return accepted_readings(classify_rows(raw, ingested_at))


__all__ = ["SourceLabels", "accepted_readings", "classify_rows", "rejected_rows", "transform_readings"]
