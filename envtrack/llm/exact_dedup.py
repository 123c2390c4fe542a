"""Operator 1: exact dedup by counting quotient filters.

1. One pass over the texts keeps a narrow row for each document: id, row number, SHA-256 of the
   normalised text (A-Z lower-cased) and, as its leading bits, the fingerprint.
2. Each partition builds counting quotient filters of its fingerprints: a fingerprint's high bits, the
   quotient, name a run, its low bits, the remainder, lie sorted in that run with a count. Filters of
   one block of quotients merge without loss, remainder by remainder; a block holds about a million
   fingerprints whatever the input, and a repeated fingerprint is one entry of each partition's filter.
3. Only documents whose fingerprint counts above one go to byte verification: their texts, folded
   within each batch first, are grouped by their bytes. The occupied-bits vector of the merged filters
   (at most 2^27 bits, 16 MB) tells the tasks which documents to pass on; a full vector passes on more
   texts, never fewer.
4. Groups are resolved on the narrow rows. A group with more than 1/1024 of all rows -- there are
   fewer than 1024 of them -- is joined by broadcast, all others by their key.

Defined results: null counts as empty; of equal texts the row with the largest id stays (null ids are
smallest), of repeated rows with one id exactly one; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envtrack.llm.common import chunks, numbered, staged, text_buffer

#: Fingerprints in one block of quotients, about.
BLOCK_FINGERPRINTS = 1 << 20
LEAST_BLOCK_BITS, QUOTIENT_BITS_IN_BLOCK = 6, 14
MOST_ROUTE_BITS = 27
HEAVY_SHARE = 1024


def normalised(raw: np.ndarray) -> bytes:
    """The bytes with A-Z (and nothing else) lower-cased."""
    return raw.tobytes().lower()


def fingerprints(digests: list[bytes], bits: int) -> np.ndarray:
    """The leading bits of the digests, as unsigned integers."""
    lead = np.frombuffer(b"".join(d[:8] for d in digests), ">u8").astype(np.uint64)
    return lead >> np.uint64(64 - bits)


class QuotientFilter:
    """A counting quotient filter over one block of quotients.

    ``runs[q]`` is the length of quotient q's run; the remainders lie run after run, sorted within
    each, with their counts beside them.
    """

    def __init__(self, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray, remainder_bits: int):
        self.runs, self.remainders, self.counts, self.remainder_bits = runs, remainders, counts, remainder_bits

    @classmethod
    def build(cls, values: np.ndarray, counts: np.ndarray, quotients: int, remainder_bits: int) -> QuotientFilter:
        """From sorted distinct values (fingerprints without the block's bits) and their counts."""
        shift = np.uint64(remainder_bits)
        runs = np.bincount((values >> shift).astype(np.int64), minlength=quotients)
        return cls(runs, values & ((np.uint64(1) << shift) - np.uint64(1)), counts, remainder_bits)

    def values(self) -> np.ndarray:
        quotient = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        return (quotient << np.uint64(self.remainder_bits)) | self.remainders

    @classmethod
    def merge(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """The filter of all entries; equal remainders of a run become one with the summed count."""
        values = np.concatenate([f.values() for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(values, kind="stable")  # merges the sorted stretches
        values, counts = values[order], counts[order]
        first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        return cls.build(values[first], np.add.reduceat(counts, first), len(filters[0].runs),
                         filters[0].remainder_bits)


def document_digests(docs: DataFrame, bits: int, id_col: str, text_col: str, row_col: str | None) -> DataFrame:
    """id, row, fingerprint (unsigned in a long) and sha (binary) of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for a, z in chunks(offsets):
                text, at = normalised(raw[offsets[a]:offsets[z]]), (offsets[a:z + 1] - offsets[a]).tolist()
                sha = [hashlib.sha256(text[b:e]).digest() for b, e in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, z - a), pa.array(fingerprints(sha, bits).view(np.int64)),
                     pa.array(sha, pa.binary()), batch.column(2).slice(a, z - a)],
                    names=["id", "fingerprint", "sha", "row"])

    kind = docs.schema[id_col].dataType.simpleString()
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), row.alias("row"))
    return rows.mapInArrow(run, f"id {kind}, fingerprint bigint, sha binary, row bigint")


def repeated_fingerprints(digests: DataFrame, rows: int, bits: int) -> DataFrame:
    """fingerprint, n of those that occur more than once, from the partitions' merged filters."""
    blocks = LEAST_BLOCK_BITS + max(0, math.ceil(math.log2(max(1, rows) / BLOCK_FINGERPRINTS)))
    blocks = min(blocks, bits - 1)
    quotients = min(QUOTIENT_BITS_IN_BLOCK, bits - blocks - 1)
    remainder = bits - blocks - quotients
    inner = np.uint64(bits - blocks)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def filters(parts: list[np.ndarray]) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(parts), return_counts=True)
            block = (values >> inner).astype(np.int64)
            cut = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            out = []
            for a, z in zip(cut, np.append(cut[1:], len(values))):
                f = QuotientFilter.build(values[a:z] & ((np.uint64(1) << inner) - np.uint64(1)), counts[a:z],
                                         1 << quotients, remainder)
                used = np.flatnonzero(f.runs)  # the occupied quotients and their run lengths
                out.append((int(block[a]), used.astype("<u4").tobytes(), f.runs[used].astype("<u4").tobytes(),
                            f.remainders.astype("<u8").tobytes(), f.counts.astype("<u8").tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), FILTER_TYPES)], FILTER_NAMES)

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= 1 << 22:  # a full filter leaves the task; merging loses nothing
                yield filters(held)
                held = []
        if sum(map(len, held)):
            yield filters(held)

    def merge(group: pa.Table) -> pa.Table:
        parts = []
        for used, runs, remainders, counts in zip(*(group.column(c).to_pylist() for c in FILTER_NAMES[1:])):
            full = np.zeros(1 << quotients, np.int64)
            full[np.frombuffer(used, "<u4")] = np.frombuffer(runs, "<u4")
            parts.append(QuotientFilter(full, np.frombuffer(remainders, "<u8"), np.frombuffer(counts, "<u8"),
                                        remainder))
        merged = QuotientFilter.merge(parts)
        often = merged.counts > 1
        high = np.uint64(group.column("block")[0].as_py()) << inner
        return pa.table({"fingerprint": (merged.values()[often] | high).view(np.int64),
                         "n": merged.counts[often].astype(np.int64)})

    built = digests.select("fingerprint").mapInArrow(
        build, "block bigint, used binary, runs binary, remainders binary, counts binary")
    return built.groupBy("block").applyInArrow(merge, "fingerprint bigint, n bigint")


FILTER_NAMES = ["block", "used", "runs", "remainders", "counts"]
FILTER_TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def occupied_bits(repeated: DataFrame, bits: int) -> tuple[int, np.ndarray]:
    """The bit vector of the repeated fingerprints' leading bits: (bits of an index, packed bytes)."""
    count = repeated.count()
    route = min(MOST_ROUTE_BITS, bits, max(10, math.ceil(math.log2(8 * max(1, count)))))
    index = F.shiftrightunsigned("fingerprint", bits - route)
    words = repeated.withColumn("i", index).groupBy(F.shiftright("i", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(i % 32 as int))")).alias("bits"))
    vector = np.zeros(1 << max(0, route - 5), np.uint32)
    for word, value in words.toLocalIterator():
        vector[word] = value
    return route, vector


def verified_texts(docs: DataFrame, route: int, vector: np.ndarray, bits: int, text_col: str) -> DataFrame:
    """sha (lower-case hex), n of the texts that occur more than once, compared by their bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(0))
            found: dict[bytes, int] = {}
            for a, z in chunks(offsets):
                text, at = normalised(raw[offsets[a]:offsets[z]]), (offsets[a:z + 1] - offsets[a]).tolist()
                bodies = [text[b:e] for b, e in zip(at, at[1:])]
                index = fingerprints([hashlib.sha256(b).digest() for b in bodies], bits) >> np.uint64(bits - route)
                hit = (shared.value[(index >> np.uint64(5)).astype(np.int64)]
                       >> (index & np.uint64(31)).astype(np.uint32)) & np.uint32(1)
                for i in np.flatnonzero(hit).tolist():
                    found[bodies[i]] = found.get(bodies[i], 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()),
                                              pa.array(list(found.values()), pa.int64())], names=["body", "n"])

    bodies = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "body binary, n bigint")
    same = bodies.groupBy("body").agg(F.sum("n").alias("n")).where("n > 1")
    return same.select(F.unhex(F.sha2("body", 256)).alias("sha"), "n")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     fingerprint_bits: int = 64, row_col: str | None = None) -> DataFrame:
    """For each document: id, keep_id, group_size, kept, text_sha256 (see the module for the rules).

    ``row_col`` names a column of unique row numbers, if there is one; it is returned as well.
    """
    digests = staged(document_digests(docs, fingerprint_bits, id_col, text_col, row_col), "digests")
    rows = digests.count()
    repeated = staged(repeated_fingerprints(digests, rows, fingerprint_bits), "repeated")
    route, vector = occupied_bits(repeated, fingerprint_bits)
    verified = verified_texts(docs, route, vector, fingerprint_bits, text_col)
    keepers = digests.groupBy("sha").agg(F.max(F.struct("id", "row")).alias("keep"), F.count("*").alias("copies"))
    groups = staged(keepers.where("copies > 1").join(verified, "sha", "left_semi"), "copies")
    heavy_from = rows / HEAVY_SHARE
    heavy, light = groups.where(F.col("copies") > heavy_from), groups.where(F.col("copies") <= heavy_from)
    out = digests.join(F.broadcast(heavy), "sha").unionByName(
        digests.join(F.broadcast(heavy), "sha", "left_anti").join(light, "sha", "left"), allowMissingColumns=True)
    alone = F.col("keep").isNull()
    return out.select(F.col("id").alias(id_col),
                      F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
                      F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
                      (alone | (F.col("row") == F.col("keep.row"))).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"),
                      *([F.col("row").alias(row_col)] if row_col else []))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, that stay."""
    rows, row = numbered(docs)
    kept = exact_duplicates(rows, id_col, text_col, row_col=row).where("kept").select(row)
    return rows.join(kept, row, "left_semi").drop(row)


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256
FROM d
"""
