"""Per-device sequence operators (previous row, running sum, islands) that split hot devices.

``Window.partitionBy("device")`` puts every reading of a device into one task; one busy device can
hold a large share of the table. Here the window runs per (device, time chunk) instead, and chunk
boundaries are stitched through a small frame with one row per (device, chunk), read off the
windowed frame itself (each chunk's first / last row is where ``row_number`` is 1 / the chunk size):

* previous row: inside a chunk ``lag``; for a chunk's first row, the last row of the device's
  previous non-empty chunk (``lag`` over the chunk frame);
* islands (runs of flagged rows): run starts counted inside each chunk, corrected where a run
  continues across a chunk boundary, offset by the starts of earlier chunks -- one pass.

A chunk is bounded by time, not by rows: a window partition holds what one device sends in
``chunk_seconds`` (ten minutes by default). Results do not depend on the width.

Chunk boundaries follow the ordering timestamp, so all rows of chunk k precede chunk k+1 and the
result equals the unsplit window. The join back is on (device, chunk), the same keys the chunk
window is partitioned by, so the large side is not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envtrack.functions.timecols import micros

DEFAULT_CHUNK_SECONDS = 600


def _chunked(df: DataFrame, ts: str, chunk_seconds: int) -> DataFrame:
    if "_chunk" in df.columns:  # already chunked by a previous sequence step: keep its partitioning
        return df
    return df.withColumn("_chunk", F.floor(micros(F.col(ts)) / (chunk_seconds * 1_000_000)))


def with_previous(df: DataFrame, key: str, ts: str, order: list[str], cols: list[str],
                  chunk_seconds: int = DEFAULT_CHUNK_SECONDS, prefix: str = "prev_",
                  keep_chunk: bool = False) -> DataFrame:
    """Add ``prev_<c>`` for each ``c`` in ``cols``: its value on the previous row of the same key.

    ``order`` names columns sorted ascending; the first must be ``ts`` (it defines the chunks).
    The chunk summary (each chunk's last row) is read off the windowed frame itself, so it shares
    the scan and the shuffle with the main branch instead of scanning again.
    """
    c = _chunked(df, ts, chunk_seconds)
    part = Window.partitionBy(key, "_chunk")
    w = part.orderBy(*order)
    c = c.select("*", F.row_number().over(w).alias("_rn"), F.count(F.lit(1)).over(part).alias("_cn"),
                 *[F.lag(x).over(w).alias(f"_in_{x}") for x in cols])
    last = c.where(F.col("_rn") == F.col("_cn")).select(key, "_chunk", F.struct(*cols).alias("_last"))
    prev_last = last.select(key, "_chunk", F.lag("_last").over(Window.partitionBy(key).orderBy("_chunk")).alias("_pl"))
    out = c.join(prev_last, [key, "_chunk"], "left")
    for col in cols:
        out = out.withColumn(f"{prefix}{col}", F.when(F.col("_rn") == 1, F.col(f"_pl.{col}"))
                             .otherwise(F.col(f"_in_{col}")))
    drop = ["_rn", "_cn", "_pl", *[f"_in_{x}" for x in cols]] + ([] if keep_chunk else ["_chunk"])
    return out.drop(*drop)


def with_islands(df: DataFrame, key: str, ts: str, order: list[str], flag: str, out: str,
                 chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Number the maximal runs of consecutive rows (per key, in order) where ``flag`` is true.

    ``out`` is 1, 2, ... per key for flagged rows (null elsewhere). One chunk window gives, per
    row, the run starts counted inside its chunk (the chunk's first flagged row counts as a start);
    a frame with one row per chunk then removes that provisional start where the run continues
    from the previous non-empty chunk, and adds the starts of all earlier chunks.
    """
    c = _chunked(df, ts, chunk_seconds)
    part = Window.partitionBy(key, "_chunk")
    w = part.orderBy(*order)
    hi = F.coalesce(F.col(flag), F.lit(False))
    c = c.select("*", F.lag(hi).over(w).alias("_pf"), F.row_number().over(w).alias("_rn"),
                 F.count(F.lit(1)).over(part).alias("_cn"))
    c = c.withColumn("_cs", F.sum((hi & ~F.coalesce(F.col("_pf"), F.lit(False))).cast("long"))
                     .over(w.rowsBetween(Window.unboundedPreceding, 0)))
    edges = (c.where((F.col("_rn") == 1) | (F.col("_rn") == F.col("_cn")))
             .groupBy(key, "_chunk").agg(
                 F.max(F.when(F.col("_rn") == 1, hi)).alias("_first"),
                 F.max(F.when(F.col("_rn") == F.col("_cn"), hi)).alias("_last"),
                 F.max(F.when(F.col("_rn") == F.col("_cn"), F.col("_cs"))).alias("_total")))
    wk = Window.partitionBy(key).orderBy("_chunk")
    edges = edges.withColumn("_corr", (F.col("_first") & F.coalesce(F.lag("_last").over(wk), F.lit(False))).cast("long"))
    edges = edges.select(key, "_chunk", "_corr", F.coalesce(F.sum(F.col("_total") - F.col("_corr")).over(
        wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    res = c.join(edges, [key, "_chunk"], "left")
    return res.withColumn(out, F.when(hi, F.col("_off") + F.col("_cs") - F.col("_corr"))) \
        .drop("_chunk", "_pf", "_rn", "_cn", "_cs", "_corr", "_off")
