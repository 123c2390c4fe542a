"""Operator 10: packed token-id matrices by best-fit-decreasing.

Each task encodes its documents, cuts those longer than a row losslessly into whole rows and a rest,
and fits the rests of one block of documents, longest first, into the row with the least room that
still holds them. A segment tree over the room left in a row finds that row in log(length) steps. The
work is map-only: no shuffle, memory bounded by ``block_tokens``.

Defined results: null and empty texts are documents of the end id alone; repeated rows are packed once
each; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envtrack.llm.bpe import load
from envtrack.llm.common import chunks, spans, text_buffer
from envtrack.llm.encoding import packed

ROW_BITS = 40
#: Tokens whose rests are fitted together.
BLOCK_TOKENS = 4 << 20


class RoomTree:
    """Rows by the room that they have left; finds the least sufficient room."""

    def __init__(self, most: int):
        self.leaves = 1 << max(1, most).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """A row with the least room of at least ``need``, taken out: (room, row)."""
        at, count = need + self.leaves, self.count
        while not count[at]:
            while at & 1:  # a right child: nothing larger below its parent
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        while at:
            count[at] -= 1
            at >>= 1
        return room, row


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and offset of each piece (sizes 1 to ``capacity``), and the number of rows."""
    row = np.empty(len(sizes), np.int64)
    offset = np.empty(len(sizes), np.int64)
    tree, rows = RoomTree(capacity), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = tree.take(size) if size < capacity else None
        if found is None:
            found, rows = (capacity, rows), rows + 1
        room, row[i] = found
        offset[i] = capacity - room
        if room > size:
            tree.add(room - size, int(row[i]))
    return row, offset, rows


def pack_matrix(docs: DataFrame, vocabulary: str, end_id: int = 50256, pad_id: int = 50256, length: int = 2048,
                id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row of the packed matrix in each row of the result.

    row_id; n_tokens without padding; ids and position_ids, each ``length`` packed little-endian unsigned
    integers of 16 bits (32 for larger vocabularies or rows), padded with ``pad_id`` and 0; cu_seqlens,
    the cumulative segment lengths from 0 to n_tokens, where positions restart at 0 for each segment;
    segments, for each the document's id and the place of its first token in the document.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        wide = max(len(bpe.token_length), end_id + 1, pad_id + 1, length) > 1 << 16
        width = 4 if wide else 2
        next_row = TaskContext.get().partitionId() << ROW_BITS
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        tokens = 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal next_row
            ids = pa.chunked_array([h[0] for h in held]).combine_chunks()
            counts = np.concatenate([h[1] for h in held])
            flat = np.concatenate([h[2] for h in held])
            begin = np.cumsum(counts) - counts
            pieces = (counts + length - 1) // length
            doc = np.repeat(np.arange(len(counts)), pieces)
            start = spans(np.zeros(len(counts), np.int64), pieces) * length
            size = np.minimum(length, counts[doc] - start)
            row, offset, rows = best_fit_decreasing(size, length)
            order = np.lexsort((offset, row))
            doc, start, size, row, offset = (x[order] for x in (doc, start, size, row, offset))
            bounds = np.searchsorted(row, np.arange(rows + 1))
            for a in range(0, rows, 512):
                z = min(a + 512, rows)
                lo, hi = bounds[a], bounds[z]
                cells = spans((row[lo:hi] - a) * length + offset[lo:hi], size[lo:hi])
                matrix = np.full((z - a) * length, pad_id, np.int64)
                matrix[cells] = flat[spans(begin[doc[lo:hi]] + start[lo:hi], size[lo:hi])]
                place = np.zeros((z - a) * length, np.int64)
                place[cells] = spans(np.zeros(hi - lo, np.int64), size[lo:hi])
                used = np.add.reduceat(size[lo:hi], bounds[a:z] - lo)
                ends = bounds[a:z + 1] - lo
                # a 0 before each row's segment ends
                cumulative = np.insert(offset[lo:hi] + size[lo:hi], ends[:-1], 0)
                whole = np.full(z - a, length)
                segments = pa.StructArray.from_arrays([ids.take(pa.array(doc[lo:hi])),
                                                       pa.array(start[lo:hi], pa.int64())], names=["id", "start"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(next_row + np.arange(a, z), pa.int64()), pa.array(used, pa.int64()),
                     packed(matrix, whole, width).cast(pa.binary()), packed(place, whole, width).cast(pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends + np.arange(z - a + 1), pa.int32()),
                                              pa.array(cumulative, pa.int32())),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), segments)],
                    names=["row_id", "n_tokens", "ids", "position_ids", "cu_seqlens", "segments"])
            next_row += rows

        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for a, z in chunks(offsets):
                flat, counts = bpe.encode(raw[offsets[a]:offsets[z]], offsets[a:z + 1] - offsets[a])
                flat = np.insert(flat, np.cumsum(counts), end_id).astype(np.int32)
                held.append((batch.column(0).slice(a, z - a), counts + 1, flat))
                tokens += len(flat)
                if tokens >= block_tokens:
                    yield from block()
                    held, tokens = [], 0
        if held:
            yield from block()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "row_id bigint, n_tokens bigint, ids binary, position_ids binary, "
                                f"cu_seqlens array<int>, segments array<struct<id:{kind},start:bigint>>")


def write_matrix(matrix: DataFrame, path: str) -> None:
    """The packed rows as Parquet files below ``path``, one folder that readers can scan in parallel."""
    matrix.write.mode("errorifexists").parquet(path)
