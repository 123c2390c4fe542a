"""Exact quantiles by counts and distributed selection (the discrete percentile: the value at rank ceil(p * n)).

A sketch (``percentile_approx``) is exact only when its accuracy exceeds the number of values, and its
partial buffers all travel to the one task that owns the group. Here equal values are first counted per
group, combined map-side: a value that many rows hold costs one row.

* A group with at most ``ORDERED_VALUES`` different values is put in order by one task, with a running
  count: one shuffle for any number of such groups.
* A group with more is narrowed down first. Values are mapped to integers that order alike
  (``functions.numeric.order_image``) and counted by ``STEP_BITS`` of their bits, so that no task sees more
  than 2^16 buckets of a group; the bucket that holds the wanted rank is looked at again by the next
  bits. Values are joined to a group's chosen bucket on group *and* bucket, so that the values of a
  large group are spread. All 64 bits are known after four steps, whatever the values.

Equal to DuckDB's ``quantile_disc``.
"""

from __future__ import annotations

import math
import struct

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envtrack.functions.numeric import order_image
from envtrack.sources.storage import kept

ORDERED_VALUES = 1 << 20
STEP_BITS = (16, 16, 16, 16)


def _prefix(step: int) -> Column:
    """The image's bits up to and including a step."""
    return F.shiftright(F.col("_i"), 64 - sum(STEP_BITS[:step + 1]))


def value_counts(df: DataFrame, groups: list[str], value: Column | str) -> DataFrame:
    """(groups..., value, n): how often each group holds each non-null value."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    return (df.select(*groups, v.alias("value")).where(F.col("value").isNotNull())
            .groupBy(*groups, "value").agg(F.count("*").alias("n")))


def _ordered(values: DataFrame, keys: list[str], ps: dict[str, float]) -> DataFrame:
    """(keys..., one column for each name of ``ps``, _all): each group's values put in order by one task."""
    group = Window.partitionBy(*keys)
    counted = values.select(*keys, "_v", F.sum("_n").over(group).alias("_all"), F.sum("_n").over(
        group.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"))
    at = {name: F.greatest(F.ceil(F.lit(p) * F.col("_all")), F.lit(1)) for name, p in ps.items()}
    return counted.groupBy(*keys).agg(*[F.min(F.when(F.col("_cum") >= k, F.col("_v"))).alias(name)
                                        for name, k in at.items()])


def _narrowed(values: DataFrame, keys: list[str], ps: dict[str, float]) -> DataFrame:
    """The same for groups of any size, by buckets of bits."""
    values = kept(values.withColumn("_i", order_image(F.col("_v"))), "counts")
    wanted = F.array(*[F.struct(F.lit(name).alias("_name"), F.greatest(
        F.ceil(F.lit(p) * F.col("_all")), F.lit(1)).cast("bigint").alias("_k")) for name, p in ps.items()])
    state = None
    for step in range(len(STEP_BITS)):
        if state is None:
            buckets = values.groupBy(*keys, _prefix(step).alias("_b")).agg(F.sum("_n").alias("_c"),
                                                                          F.min("_v").alias("_v"))
            per = keys
        else:
            chosen = state.select(*[F.col(k).alias(f"_s{k}") for k in keys], "_name", "_k", F.col("_b").alias("_sb"))
            same = F.col("_sb") == _prefix(step - 1)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_s{k}"))
            inside = values.join(chosen, same)
            buckets = inside.groupBy(*keys, "_name", "_k", _prefix(step).alias("_b")).agg(
                F.sum("_n").alias("_c"), F.min("_v").alias("_v"))
            per = [*keys, "_name"]
        running = Window.partitionBy(*per).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        buckets = buckets.withColumn("_cum", F.sum("_c").over(running))
        if state is None:
            buckets = buckets.withColumn("_all", F.sum("_c").over(Window.partitionBy(*per)))
            buckets = buckets.select("*", F.explode(wanted).alias("_w")).select("*", "_w.*").drop("_w", "_all")
        here = (F.col("_cum") - F.col("_c") < F.col("_k")) & (F.col("_cum") >= F.col("_k"))
        state = buckets.where(here).select(*keys, "_name", "_b", "_v",
                                           (F.col("_k") - (F.col("_cum") - F.col("_c"))).alias("_k"))
    return state.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ps])


def _large(frame: DataFrame, keys: list[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > ORDERED_VALUES).select(*keys)


def quantiles_of_counts(counts: DataFrame, groups: list[str], ps: dict[str, float],
                        rows: DataFrame | None = None) -> DataFrame:
    """(groups..., one column for each name of ``ps``) from counts (groups..., value, n).

    Which groups have too many values for one task is asked when this is called: of ``rows`` first (any
    frame that has for each group as many rows as it has values, or more), which is cheaper than
    counting the values.
    """
    if not groups:
        raise ValueError("give at least one group column (use exact_quantile_values for global quantiles)")
    if not all(0.0 <= p <= 1.0 for p in ps.values()):
        raise ValueError("p must be in [0, 1]")
    keys = [f"_q{i}" for i in range(len(groups))]
    values = counts.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col("value").alias("_v"), F.col("n").alias("_n"))
    if (rows is not None and _large(rows, groups).isEmpty()) or (large := _large(values, keys)).isEmpty():
        found = _ordered(values, keys, ps)
    else:
        large = large.select(*[F.col(k).alias(f"_l{k}") for k in keys])
        same = None
        for k in keys:
            same = F.col(k).eqNullSafe(F.col(f"_l{k}")) if same is None else same & F.col(k).eqNullSafe(F.col(f"_l{k}"))
        found = _ordered(values.join(large, same, "left_anti"), keys, ps).unionByName(
            _narrowed(values.join(large, same, "left_semi"), keys, ps))
    return found.select(*[F.col(k).alias(g) for k, g in zip(keys, groups)], *ps)


def exact_quantiles(df: DataFrame, groups: list[str], value: Column | str, p: float, out: str = "value") -> DataFrame:
    """One row per group (with at least one non-null value): ``groups..., out``."""
    return quantiles_of_counts(value_counts(df, groups, value), groups, {out: p})


def _image(v: float) -> int:
    """``functions.numeric.order_image`` of a number."""
    if math.isnan(v):
        return 2**63 - 1
    size = int.from_bytes(struct.pack(">d", abs(v)), "big")
    return -size if v < 0 else size


def _inside(fields: dict[str, Column], open_: dict[str, tuple]) -> Column:
    """(_f, _v) of the values of the open fields that lie in their bounds, as an array."""
    entries = []
    for f, (_, _, lo, hi, whole) in open_.items():
        v = fields[f].cast("double")
        entry = F.struct(F.lit(f).alias("_f"), v.alias("_v"))
        entries.append(F.when(v.isNotNull() if whole else v.between(lo, hi), entry))
    return F.array(*entries)


def exact_quantile_values(df: DataFrame, fields: dict[str, Column], p: float) -> dict[str, float | None]:
    """Global exact quantile of a few columns, returned as numbers (like ``approxQuantile``); None for a
    column without values.

    One job counts the values and finds their bounds. While a column has more than ``ORDERED_VALUES``
    between its bounds (and they are more than 2^16 doubles apart), a job counts it by 2^16 buckets of
    integer images between the bounds and narrows them down; they are literals, so that they reach the scan.
    What is left is put in order in one job for all columns.
    """
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be in [0, 1]")
    found: dict[str, float | None] = dict.fromkeys(fields)
    of = {f: c.cast("double") for f, c in fields.items()}
    first = df.agg(*[x for i, c in enumerate(of.values()) for x in (
        F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"))]).first()
    open_ = {f: (max(1, math.ceil(p * first[f"n{i}"])), first[f"n{i}"], first[f"lo{i}"], first[f"hi{i}"], True)
             for i, f in enumerate(of) if first[f"n{i}"]}
    while open_:
        few = {f: o for f, o in open_.items() if o[1] <= ORDERED_VALUES or _image(o[3]) - _image(o[2]) < 1 << 16}
        many = {f: o for f, o in open_.items() if f not in few}
        for part in (many, few):
            if not part:
                continue
            rows = df
            if len(part) == 1 and not any(o[4] for o in part.values()):
                (f, o), = part.items()
                rows = df.where(fields[f].between(o[2], o[3]))
            values = rows.select(F.explode(F.array_compact(_inside(fields, part))).alias("_r")).select("_r._f", "_r._v")
            rank, bucket = F.lit(None).cast("bigint"), F.col("_v")
            if part is many:
                bucket = F.lit(None).cast("bigint")
                for f, o in part.items():
                    shift = max(0, (_image(o[3]) - _image(o[2])).bit_length() - 16)
                    bucket = F.when(F.col("_f") == f, F.shiftright(order_image(F.col("_v")), shift)).otherwise(bucket)
            for f, o in part.items():
                rank = F.when(F.col("_f") == f, F.lit(o[0]).cast("bigint")).otherwise(rank)
            counts = values.groupBy("_f", bucket.alias("_b")).agg(
                F.count("*").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
            running = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
            counts = counts.select("*", F.sum("_c").over(running).alias("_cum"), rank.alias("_k"))
            chosen = counts.where((F.col("_cum") - F.col("_c") < F.col("_k")) & (F.col("_cum") >= F.col("_k")))
            for r in chosen.collect():  # one row a column
                if r["_lo"] == r["_hi"] or math.isnan(r["_lo"]):
                    found[r["_f"]] = r["_lo"]
                    del open_[r["_f"]]
                else:
                    open_[r["_f"]] = (r["_k"] - (r["_cum"] - r["_c"]), r["_c"], r["_lo"], r["_hi"], False)
    return found
