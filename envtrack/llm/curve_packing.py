"""Operator 2: packing along a space-filling curve.

1. One map-only pass encodes each document (plus its end id) and projects the hashed bag of its ids to
   a few dimensions; the position of that point on a Hilbert curve is the sort key. Ids are written
   once to the shared folder, so that the sampling of the range sort does not encode again.
2. The documents are range-partitioned and sorted by (key, hash of the id, row): copies share a key,
   and the further columns let the range sort split even a group that holds a third of all rows.
3. Each range packs its documents one after another, cutting wherever a sequence is full. Only the end
   of a range is not a full sequence; it is cut into sequences of falling powers of two, so that
   nothing is padded. A task holds one batch and one open sequence.

Defined results: null and empty texts are documents of the end id alone; repeated rows are packed once
each; an empty table gives no pieces; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envtrack.llm.bpe import load
from envtrack.llm.common import chunks, spans, staged, text_buffer
from envtrack.llm.encoding import packed

#: The hashed vector's length, the projection's dimensions, and the bits of each on the curve.
BUCKETS, DIMENSIONS, BITS = 256, 4, 10
SEQUENCE_BITS = 40  # of a sequence number within its range


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (one in a row), ``bits`` for each dimension.

    Skilling's transform between axes and the transposed curve index, on all points at once.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_points(flat: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Grid points of documents given by their ids: hashed vector, length one, projected, squashed."""
    rng = np.random.default_rng(7)
    bucket = rng.integers(0, BUCKETS, size)
    project = rng.standard_normal((BUCKETS, DIMENSIONS))
    doc = np.repeat(np.arange(len(counts)), counts)
    vec = np.bincount(doc * BUCKETS + bucket[flat], minlength=len(counts) * BUCKETS).reshape(-1, BUCKETS)
    vec = np.sqrt(vec)
    norm = np.sqrt((vec * vec).sum(axis=1, keepdims=True))
    point = (vec / np.maximum(norm, 1e-12)) @ project
    unit = 1 / (1 + np.exp(-1.7 * point))  # close to the normal distribution function
    return np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def encoded_on_curve(docs: DataFrame, vocabulary: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        size = max(len(bpe.token_length), end_id + 1)
        width = 2 if size <= 1 << 16 else 4
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for a, z in chunks(offsets):
                flat, counts = bpe.encode(raw[offsets[a]:offsets[z]], offsets[a:z + 1] - offsets[a])
                key = hilbert_key(curve_points(flat, counts, size), BITS)
                flat = np.insert(flat, np.cumsum(counts), end_id)
                counts = counts + 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, z - a), pa.array(key, pa.int64()), pa.array(counts, pa.int64()),
                     pa.array(np.full(z - a, width, np.int32)), packed(flat, counts, width).cast(pa.binary())],
                    names=["id", "curve_key", "n_tokens", "width", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, curve_key bigint, n_tokens bigint, width int, ids binary")
    return out.withColumn("tie", F.xxhash64(F.col("id").cast("string"))).withColumn(
        "row", F.monotonically_increasing_id())


class _Range:
    """The sequences of one sorted range."""

    def __init__(self, length: int, first_id: int):
        self.length, self.sequence = length, first_id
        self.open: list[tuple] = []  # pieces of the open sequence: (doc, start, tokens, ids)
        self.filled = 0

    def batch(self, ids: pa.Array, counts: np.ndarray, flat: np.ndarray) -> pa.RecordBatch | None:
        """Takes a batch of documents, gives the pieces of the sequences that became full."""
        begin = self.filled + np.cumsum(counts) - counts  # positions from the open sequence's start
        end = begin + counts
        first, last = begin // self.length, (end - 1) // self.length
        pieces = last - first + 1
        doc = np.repeat(np.arange(len(counts)), pieces)
        seq = spans(first, pieces)
        lo = np.maximum(begin[doc], seq * self.length)
        hi = np.minimum(end[doc], (seq + 1) * self.length)
        source = np.cumsum(counts)[doc] - counts[doc] + lo - begin[doc]
        total = int(end[-1])
        full = total // self.length
        done = seq < full
        out = self._rows(ids, doc[done], lo[done] - begin[doc[done]], hi[done] - lo[done], counts,
                         seq[done] + self.sequence, lo[done] % self.length,
                         flat[spans(source[done], (hi - lo)[done])]) if full else None
        if full:
            before = self._pending()
            self.open = []
            if before is not None:
                out = pa.Table.from_batches([before, out]).combine_chunks().to_batches()[0] if out.num_rows else before
            self.sequence += full
        for k in np.flatnonzero(~done):
            self.open.append((ids[int(doc[k])], int(lo[k] - begin[doc[k]]), int(counts[doc[k]]),
                              flat[source[k]:source[k] + hi[k] - lo[k]].copy()))
        self.filled = total - full * self.length
        self.kind = ids.type
        return out

    def _rows(self, ids, doc, start, size, counts, seq, offset, flat) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(doc)), pa.array(start, pa.int64()), pa.array(size, pa.int64()),
             pa.array(counts[doc], pa.int64()), pa.array(seq, pa.int64()), pa.array(offset, pa.int64()),
             packed(flat, size).cast(pa.binary())], names=PIECE)

    def _pending(self, cuts: list[int] | None = None) -> pa.RecordBatch | None:
        """The open sequence's pieces, as one sequence or cut into sequences of the given lengths."""
        if not self.open:
            return None
        rows, at, seq, used = [], 0, self.sequence, 0
        room = list(cuts or [self.length])
        for doc, start, tokens, flat in self.open:
            while len(flat):
                take = min(len(flat), room[at] - used)
                rows.append((doc, start, take, tokens, seq, used, flat[:take].astype("<u4").tobytes()))
                start, flat, used = start + take, flat[take:], used + take
                if used == room[at] and cuts:
                    at, seq, used = at + 1, seq + 1, 0
        columns = list(zip(*rows))
        ids = pa.array([d.as_py() for d in columns[0]], self.kind)
        return pa.RecordBatch.from_arrays(
            [ids, *(pa.array(c, pa.int64()) for c in columns[1:6]), pa.array(columns[6], pa.binary())], names=PIECE)

    def finish(self) -> pa.RecordBatch | None:
        return self._pending([1 << b for b in range(self.filled.bit_length() - 1, -1, -1) if self.filled >> b & 1])


PIECE = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


def pack_along_curve(docs: DataFrame, vocabulary: str, end_id: int = 1, length: int = 2048,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents in sequences of at most ``length`` tokens, neighbours together.

    Returns id, start, length, doc_tokens, sequence_id, offset (all long) and ids (packed little-endian
    unsigned 32-bit). The pieces of a sequence are gapless from offset 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Range(length, TaskContext.get().partitionId() << SEQUENCE_BITS)
        for batch in batches:
            column = batch.column(2).cast(pa.large_binary())
            if not len(column):
                continue
            width = int(batch.column(1)[0].as_py())
            ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            raw = np.frombuffer(column.buffers()[2], np.uint8)
            for a, z in chunks(ends - ends[0]):
                flat = raw[ends[a]:ends[z]].view(f"<u{width}")
                out = packer.batch(batch.column(0).slice(a, z - a), np.diff(ends[a:z + 1]) // width, flat)
                if out is not None:
                    yield out
        if (out := packer.finish()) is not None:
            yield out

    rows = staged(encoded_on_curve(docs, vocabulary, end_id, id_col, text_col), "curve")
    order = ["curve_key", "tie", "row"]
    kind = docs.schema[id_col].dataType.simpleString()
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "width", "ids")
    pieces = ranged.mapInArrow(run, f"id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
                                    "offset bigint, ids binary")
    return pieces.withColumnRenamed("id", id_col)


def piece_digests(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return pieces.select(id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")
