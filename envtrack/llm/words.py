"""Folding equal words of a byte buffer, which are compared byte by byte, and a rolling 64-bit hash of words."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from envtrack.llm.common import CHUNK_BYTES, spans

_BASE = 0x9E3779B97F4A7C15
MIX = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)


@functools.lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    one, n = np.ones(1, np.uint64), 1 << bits
    base, back = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 2**64))
    return (np.multiply.accumulate(np.concatenate([one, np.full(n, base)])),
            np.multiply.accumulate(np.concatenate([one, np.full(n, back)])))


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    power, inverse = _powers(max(len(raw) + 1, CHUNK_BYTES).bit_length())
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(MIX[raw] * power[:len(raw)], out=total[1:])
    return (total[ends] - total[begins]) * inverse[begins] + (ends - begins).astype(np.uint64)


def letter_powers(exponents: np.ndarray) -> np.ndarray:
    """The factor by which a byte that stands so many places behind the first enters a word's hash."""
    return _powers(max(int(exponents.max(initial=0)) + 1, CHUNK_BYTES).bit_length())[0][exponents]


def fold_words(raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray):
    """(first, which, keys): the word that stands for each distinct one, and each word's distinct one.

    ``keys`` are the distinct hashes, ascending; None if two words had the same hash. The words are told
    apart by their bytes, by Arrow's dictionary, so that only distinct words are hashed here.
    """
    apart = len(begins) == 0 or lengths.sum() < len(raw) or (np.cumsum(lengths) != begins + lengths).any()
    number, words = dictionary_of((raw[spans(begins, lengths)] if apart else raw, lengths))
    if not len(number):
        return number, number, np.zeros(0, np.uint64)
    first = np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1))
    flat, at = binary_buffer(words)
    keys = word_hashes(flat, at[:-1], at[1:])
    order = np.argsort(keys)
    keys = keys[order]
    if (keys[1:] == keys[:-1]).any():
        return first, number, None
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return first[order], place[number], keys


def dictionary_of(*parts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, pa.Array]:
    """Of words that lie one after another, given by parts (their bytes, their lengths): each one's number
    among the distinct words, and these, both in the order in which the words first come.
    """
    coded = pa.chunked_array([_words(*part) for part in parts], pa.large_binary()).dictionary_encode()
    numbers = [chunk.indices.to_numpy() for chunk in coded.chunks]
    return np.concatenate([np.zeros(0, np.int32), *numbers]), (
        coded.chunk(coded.num_chunks - 1).dictionary if numbers else pa.array([], pa.large_binary()))


def _words(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    at = np.append(0, np.cumsum(lengths)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [
        None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(flat))])


def binary_buffer(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large binary array without nulls, and the offsets into them."""
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    flat = words.buffers()[2]
    flat = np.frombuffer(flat, np.uint8) if flat is not None else np.zeros(0, np.uint8)
    return flat[at[0]:at[-1]], at - at[0]
