"""Operator 4: sharding by extendible hashing.

A document's place is given by 120 hash bits: 60 of its id's MD5, then 60 that are a one-to-one image
of its row number, which separate rows of equal ids. The directory starts with one bucket; a bucket
over the byte limit splits on its next bit, all others stay, until every bucket fits or holds a single
document. Bits are examined several at a time: one aggregation gives the bytes of the cells some bits
further down in the oversized buckets, and the cells' ancestors tell where each split ends. Only rows
of buckets still oversized take part in the next round. All work is on narrow rows (id, bits, bytes);
the directory is a table, joined by key like any other.

Defined results: a document counts its UTF-8 bytes and one more (null counts as empty); a document over
the limit has a shard of its own; repeated rows are placed one by one; null ids count as equal ids; an
empty table gives an empty table; other columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envtrack.llm.common import left_join_by_key, numbered, staged

#: Bits of each of the two hashes, bits of a further round, and bits below the expected depth.
HASH_BITS, ROUND_BITS, MARGIN_BITS = 60, 8, 3
#: Odd, so that multiplying by it modulo 2^60 is one-to-one.
ROW_FACTOR = 0x9E3779B97F4A7C1


def _keys(docs: DataFrame, id_col: str, text_col: str, row_col: str | None) -> DataFrame:
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    number = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(F.col(id_col).alias("id"), number.alias("row"), F.coalesce(F.octet_length(text_col), F.lit(0)).alias("size"),
                       F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint").alias("key"))
    row = F.col("row").cast("decimal(20,0)")
    image = (row * F.lit(ROW_FACTOR).cast("decimal(18,0)")) % F.lit(1 << HASH_BITS).cast("decimal(20,0)")
    return rows.select("id", "row", (F.col("size").cast("bigint") + 1).alias("bytes"), "key",
                       image.cast("bigint").alias("row_key"))


def _cell(depth: int) -> Column:
    """The first ``depth`` bits as text: the whole words, then the part of the last one."""
    if depth <= HASH_BITS:
        return F.shiftright("key", HASH_BITS - depth).cast("string")
    return F.concat_ws(".", "key", F.shiftright("row_key", 2 * HASH_BITS - depth))


def _round(rows: DataFrame, depth: int, to: int, limit: int) -> DataFrame:
    """Splits oversized buckets at ``depth``: each cell at ``to`` with its documents and its shard, if it has one."""
    word = F.col("key") if to <= HASH_BITS else F.col("row_key")
    high = F.lit(0) if to <= HASH_BITS else F.col("key")
    skip = (HASH_BITS if to <= HASH_BITS else 2 * HASH_BITS) - to
    cells = staged(rows.groupBy(high.cast("bigint").alias("high"), F.shiftright(word, skip).alias("cell"),
                                _cell(to).alias("name"))
                   .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs")), "cells")
    paths = cells.select("high", "cell", "name", "bytes", "docs", F.explode(F.sequence(
        F.lit(min(depth + 1, to)), F.lit(to))).alias("depth"))
    paths = paths.withColumn("node", F.expr(f"shiftright(cell, {to} - depth)"))
    node = ["high", "depth", "node"]
    nodes = paths.groupBy(node).agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)
    # the shard of a cell is its shallowest ancestor that fits
    shard = paths.select("name", *node).join(nodes.where(fits), node).groupBy("name").agg(
        F.min(F.struct("depth", "node", "shard_bytes", "shard_docs")).alias("s"), F.first("high").alias("high"))
    place = F.col("s.node").cast("string") if to <= HASH_BITS else F.concat_ws(".", "high", "s.node")
    found = shard.select("name", F.concat_ws(":", "s.depth", place).alias("shard"), F.col("s.depth").alias("depth"),
                         "s.shard_bytes", "s.shard_docs")
    return cells.select("name", "docs").join(found, "name", "left")


def assign_shards(docs: DataFrame, byte_limit: int, id_col: str = "doc_id", text_col: str = "text",
                  row_col: str | None = None) -> DataFrame:
    """For each document: id, bytes, shard (depth and prefix), depth, shard_bytes and shard_docs.

    ``row_col`` names a column of unique row numbers, if there is one; it is returned as well.
    """
    rows = staged(_keys(docs, id_col, text_col, row_col), "shard-keys")
    total, count = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    columns = [F.col("id").alias(id_col), "bytes", "shard", "depth", "shard_bytes", "shard_docs",
               *([F.col("row").alias(row_col)] if row_col else [])]
    if total <= byte_limit or count <= 1:
        out = rows.withColumns({"shard": F.lit("0:0"), "depth": F.lit(0), "shard_bytes": F.lit(total).cast("bigint"),
                                "shard_docs": F.lit(count).cast("bigint")})
        return out.select(*columns)
    depth, to = 0, min(HASH_BITS, MARGIN_BITS + max(1, math.ceil(math.log2(total / byte_limit))))
    out = None
    while True:
        rows = rows.withColumn("name", _cell(to))
        cells = staged(_round(rows, depth, to, byte_limit), "directory")
        placed = left_join_by_key(rows, cells, "name", "docs")  # all rows of an id are one cell until the row's bits
        part = placed.where("shard is not null").select(*columns)
        out = part if out is None else out.unionByName(part)
        if to == 2 * HASH_BITS or cells.where("shard is null").isEmpty():
            return out
        rows = staged(placed.where("shard is null").select("id", "row", "bytes", "key", "row_key"), "shard-keys")
        depth = to
        to = min(to + ROUND_BITS, HASH_BITS if to < HASH_BITS else 2 * HASH_BITS)


def write_shards(docs: DataFrame, byte_limit: int, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, whole, below ``path``, one folder ``shard=`` for each shard; returns what was assigned.

    Documents are followed by a row number, so that repeated and null ids keep each of their rows.
    """
    rows, row = numbered(docs)
    shards = staged(assign_shards(rows, byte_limit, id_col, text_col, row), "shards")
    placed = rows.join(shards.select(row, "shard"), row).drop(row)
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
    return shards.drop(row)


def oracle(byte_limit: int) -> str:
    return f"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS bytes,
                  ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS key FROM documents),
p AS (SELECT d.*, t.depth, key >> (60 - t.depth)::INTEGER AS node FROM d, range(0, 61) t(depth)),
n AS (SELECT depth, node, sum(bytes) AS shard_bytes, count(*) AS shard_docs FROM p GROUP BY ALL),
f AS (SELECT p.doc_id, p.bytes, p.depth, p.node, n.shard_bytes, n.shard_docs,
             row_number() OVER (PARTITION BY p.doc_id ORDER BY p.depth) AS k
      FROM p JOIN n USING (depth, node) WHERE n.shard_bytes <= {byte_limit} OR n.shard_docs = 1)
SELECT doc_id, bytes, depth || ':' || node AS shard, CAST(depth AS INTEGER) AS depth,
       CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_docs
FROM f WHERE k = 1
"""
