"""Helpers that several operators of this subpackage share: tables, staging, Arrow text columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envtrack.session import shared_dir

#: Text handled at once inside a task, in bytes (a longer document is handled alone).
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark's own setting: a finished query's shuffle files are removed at once, not when the driver happens to
#: collect its garbage. What is staged is never computed again from its plan.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str, *folders: str) -> DataFrame:
    """Write ``df`` to the shared folder (spark.checkpoint.dir), by ``folders``, and read it back.

    Cuts the lineage the way a checkpoint does, so that a lost executor costs a re-read and not a
    recomputation, and later stages scan only the columns that they need. The write's shuffle files go
    with its end; ``released`` removes the folder itself.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").partitionBy(*folders).parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def released(df: DataFrame) -> None:
    """Remove the folder of a ``staged`` frame that nothing reads any more (of an iteration's earlier state)."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written once with a row number that stays, and the number's column name (a new one)."""
    name = f"row_{uuid.uuid4().hex[:12]}"
    return staged(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and the n+1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(column) == 0:
        return raw[:0], np.zeros(1, np.int64)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row makes a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start+1, ... of all given spans, one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by ``keys``: a group that is open at a batch's end is carried on."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
        differs = np.zeros(batch.num_rows, bool)
        for column in columns:
            differs |= column != column[-1]
        cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if not cut and held:
            last = [held[-1].column(batch.schema.get_field_index(k))[-1].as_py() for k in keys]
            if any(x != column[0] for x, column in zip(last, columns)):
                yield pa.Table.from_batches(held)
                held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def left_join_by_key(rows: DataFrame, per_key: DataFrame, key: str, count: str, share: int = 1024) -> DataFrame:
    """``rows`` left-joined with ``per_key`` (one row for each key), whatever the keys' frequencies.

    Column ``count`` of ``per_key`` has the number of rows with the key. A key with more than 1/share of
    them all is joined by broadcast: there are fewer than ``share`` of those. All others are shuffled,
    none of them hot -- which holds only if ``per_key`` has every key of ``rows``: a frequent key that it
    lacks goes to one task. Both tables are read several times: stage them before.
    """
    total = per_key.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    heavy, light = per_key.where(F.col(count) * share > total), per_key.where(F.col(count) * share <= total)
    rest = rows.join(F.broadcast(heavy), key, "left_anti")
    return rows.join(F.broadcast(heavy), key).unionByName(rest.join(light, key, "left"))


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of ``edges``: the least node of its connected component.

    Alternating large-star and small-star steps on the edge table, each written to the shared folder;
    a node with very many edges is handled by ``left_join_by_key``. Nothing goes through the driver but
    the counts and the check sum that tell when nothing changes any more.
    """
    edges = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    edges = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen, old = state, edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
                       .select("u", F.least("u", "m").alias("m"), "n"), "least")
        large = left_join_by_key(both, least, "u", "n").where("v > u and v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, first = staged(large, "edges"), least
        least = staged(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
        small = left_join_by_key(large, least, "u", "n").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        for frame in (old, first, large, least):
            released(frame)
