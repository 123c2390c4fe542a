"""Row positions and batch numbers without a global window.

``row_number() over (order by ...)`` with no partition key moves every row into one task. Here a
position is built from bounded pieces:

1. rows carry a *group* key ``g``: a non-negative bigint that orders the groups the same way as the
   rows (a range of sequence numbers, a file split's start offset) and keeps each group bounded;
   ``row_number()`` runs inside each group only;
2. each group's offset (rows in all earlier groups) is a prefix sum over the frame of group sizes,
   computed as a tree with fan-out 2^16: at level ``l`` the blocks are ``g >> 16*l``, and the
   exclusive running sum of block sizes is windowed per parent block, so no window partition ever
   holds more than 65,536 rows; the offset of ``g`` is the sum over the four levels (covering any
   bigint key). The offsets (one row per group) are joined back on the group key.

``within`` restarts the numbering per key (e.g. per file): all windows and sums are also partitioned
by it. position = offset of the group + row number inside the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FANOUT_BITS = 16
LEVELS = 4  # 4 x 16 bits: any non-negative bigint group key


def _join_on(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str) -> DataFrame:
    """Join on differently named key columns. The small frames here derive from the same rows they
    are joined back to; renamed keys (fresh attributes) keep Spark from reading the condition as a
    self-comparison."""
    cond = None
    for a, b in pairs:
        c = F.col(a) == F.col(b)
        cond = c if cond is None else cond & c
    return left.join(right, cond, how).drop(*[b for _, b in pairs])


def group_offsets(sizes: DataFrame, group: str, count: str, within: list[str]) -> DataFrame:
    """One row per (within, group) with ``_off`` = rows in all earlier groups of the same ``within``."""
    offsets = sizes.select(*within, group)
    for level in range(LEVELS):
        block = F.shiftright(F.col(group), FANOUT_BITS * level)
        top = FANOUT_BITS * (level + 1) >= 64  # shift counts are taken mod 64: the top parent is one block
        parent = F.lit(0).cast("bigint") if top else F.shiftright(F.col(group), FANOUT_BITS * (level + 1))
        sums = (sizes.groupBy(*[F.col(w).alias(f"_w{i}") for i, w in enumerate(within)],
                              block.alias("_blk"), parent.alias("_par"))
                .agg(F.sum(count).alias("_s")))
        w_keys = [f"_w{i}" for i in range(len(within))]
        w = Window.partitionBy(*w_keys, "_par").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
        excl = sums.select(*w_keys, "_blk", F.coalesce(F.sum("_s").over(w), F.lit(0)).alias(f"_e{level}"))
        offsets = _join_on(offsets.withColumn("_b", F.shiftright(F.col(group), FANOUT_BITS * level)), excl,
                           [*zip(within, w_keys), ("_b", "_blk")], "left").drop("_b")
    total = sum((F.coalesce(F.col(f"_e{lv}"), F.lit(0)) for lv in range(1, LEVELS)),
                F.coalesce(F.col("_e0"), F.lit(0)))
    return offsets.select(*[F.col(w).alias(f"_o{i}") for i, w in enumerate(within)],
                          F.col(group).alias("_og"), total.cast("bigint").alias("_off"))


def with_positions(df: DataFrame, group: Column | str, fine: list[Column | str],
                   within: list[str] | None = None, name: str = "position") -> DataFrame:
    """Add a 1-based ``name`` column numbering rows in (group, fine) order, per ``within`` key."""
    within = list(within or [])
    g_col = F.col(group) if isinstance(group, str) else group
    fine_cols = [F.col(c) if isinstance(c, str) else c for c in fine]
    g = df.select("*", g_col.cast("bigint").alias("_g"))
    inner = g.withColumn("_rn", F.row_number().over(Window.partitionBy(*within, "_g").orderBy(*fine_cols)))
    sizes = g.groupBy(*within, "_g").agg(F.count("*").alias("_n"))
    offsets = group_offsets(sizes, "_g", "_n", within)
    pairs = [*[(w, f"_o{i}") for i, w in enumerate(within)], ("_g", "_og")]
    out = _join_on(inner, offsets, pairs, "inner")
    return out.select(*df.columns, (F.col("_off") + F.col("_rn")).cast("bigint").alias(name))


def batch_of(position: Column, batch_size: int) -> Column:
    """1-based batch number of a 1-based position."""
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    return F.ceil(position / F.lit(batch_size)).cast("bigint")


def assign_batches(df: DataFrame, group: Column | str, fine: list[Column | str], batch_size: int,
                   within: list[str] | None = None) -> DataFrame:
    """Add ``position`` and ``batch_number`` (rows ``1..batch_size`` are batch 1, and so on)."""
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    pos = with_positions(df, group, fine, within)
    return pos.withColumn("batch_number", batch_of(F.col("position"), batch_size))


def sequence_group(part: Column | str, seq: Column | str, bucket_bits: int = 16) -> Column:
    """Group key for rows ordered by (part, seq): ``part`` in the top bits, ``seq >> bucket_bits``
    below, so that a group has at most 2^bucket_bits sequence numbers.

    ``part`` has 3 bits and ``seq`` 60 - bucket_bits more; a row outside raises an error instead of
    being numbered wrongly.
    """
    p = F.col(part) if isinstance(part, str) else part
    s = (F.col(seq) if isinstance(seq, str) else seq).cast("bigint")
    p = p.cast("bigint")
    fits = p.between(0, 7) & s.between(0, (1 << 60) - 1)
    key = F.shiftleft(p, 60 - bucket_bits) + F.shiftright(s, bucket_bits)
    return F.when(fits, key).otherwise(F.raise_error(F.lit("part or sequence number out of range")).cast("bigint"))
