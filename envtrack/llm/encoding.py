"""Operator 8: byte-level BPE encoding and decoding by batched numpy merge rounds (see ``bpe``).

Both directions are map-only: no shuffle, no driver data, memory bounded by one chunk of text and the
worker's word memory, and a lost task is simply run again. Ids travel as packed little-endian unsigned
32-bit integers (``binary``), the form in which they are written to disk.

Defined results: null and empty texts have no ids; repeated rows each get their row; other columns of
the input are not read, whatever their names; an empty table gives an empty table with the schema.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envtrack.llm.bpe import load
from envtrack.llm.common import chunks, text_buffer


def packed(flat: np.ndarray, counts: np.ndarray, width: int = 4) -> pa.Array:
    """One binary value for each row out of flat integers."""
    ends = np.append(0, np.cumsum(counts)) * width
    data = flat.astype(f"<u{width}").tobytes()
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts),
                                            [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens long, ids binary) for each row; the ids equal the tokenizers library's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for a, z in chunks(offsets):
                flat, counts = bpe.encode(raw[offsets[a]:offsets[z]], offsets[a:z + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, z - a), pa.array(counts, pa.int64()),
                     packed(flat, counts).cast(pa.binary())], names=["id", "n_tokens", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids binary, text string) for each row of packed ids; special tokens are kept as text.

    Bytes that are no UTF-8 become replacement characters, as in the tokenizers library. Null ids give
    an empty text; an id that the vocabulary lacks gives nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        known = len(bpe.token_length)
        for batch in batches:
            column = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            for a, z in chunks(ends - ends[0]) if len(column) else ():
                flat = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[a]:ends[z]].view("<u4").astype(np.int64)
                bound = (ends[a:z + 1] - ends[a]) // 4
                keep = flat < known
                if not keep.all():
                    bound = np.append(0, np.cumsum(keep))[bound]
                    flat = flat[keep]
                size = np.append(0, np.cumsum(bpe.byte_lengths(flat)))[bound]
                whole = bpe.decode(flat).tobytes()
                texts = [whole[b:e].decode("utf-8", "replace") for b, e in zip(size[:-1], size[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, z - a), batch.column(1).slice(a, z - a), pa.array(texts, pa.string())],
                    names=["id", "ids", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, ids binary, text string").withColumnRenamed("id", id_col)


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, decode, and digest both."""
    both = decode(encode(docs, vocabulary), vocabulary)
    return both.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))
