"""Byte-level BPE in numpy: the encoder and decoder that the token operators share.

Encoding works on whole batches of texts, never on one word at a time:

1. word boundaries of the byte-level pattern are found with array comparisons on character classes;
2. equal words are folded by a 64-bit rolling hash and then compared byte by byte with the word that
   stands for them, so that a hash collision cannot give a wrong id;
3. the distinct words lie one after another in one flat array of symbols. Each merge round takes in
   every word its lowest-ranked pair -- ranks come from a table of slots, and for slots with several
   pairs from a binary search over the sorted pair keys --
   and merges all its occurrences, until no word has a known pair left.

The result equals the tokenizers library with ``add_special_tokens=False``: special tokens that stand
literally in a text are recognised, as that library does by default.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np

from envtrack.llm.common import spans
from envtrack.llm.words import fold_words

NO_RANK = np.int32(2**31 - 1)
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
#: Code points with the White_Space property.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
               0x3000]
#: The endings that the word pattern cuts off after an apostrophe.
ENDINGS = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]
#: Distinct words whose ids a worker remembers; when full, it starts again.
CACHE_WORDS = 400_000
#: Pairs are looked up in so many slots (a power of two).
SLOT_BITS = 18


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Letter, number, space or other for every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE_SPACE] = SPACE
    return out


def byte_classes(raw: np.ndarray) -> np.ndarray:
    """The class of each byte's character; continuation bytes have their character's class."""
    table = character_classes()
    kinds = table[:256][raw]
    high = np.flatnonzero(raw >= 0xC0)
    if len(high):
        wide = raw.astype(np.int32)
        for low, top, extra, mask in ((0xC0, 0xE0, 1, 0x1F), (0xE0, 0xF0, 2, 0x0F), (0xF0, 0x100, 3, 0x07)):
            lead = high[(raw[high] >= low) & (raw[high] < top)]
            point = wide[lead] & mask
            for k in range(1, extra + 1):
                point = (point << 6) | (wide[lead + k] & 0x3F)
            for k in range(extra + 1):
                kinds[lead + k] = table[point]
    return kinds


def word_starts(raw: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the pattern's words begin; ``text_starts`` are the beginnings of the non-empty texts."""
    n = len(raw)
    kinds = byte_classes(raw)
    lead = (raw & 0xC0) != 0x80
    begins = np.zeros(n + 1, bool)
    begins[text_starts] = True
    first = begins[:n].copy()
    begins[n] = True
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=change[1:])
    space = kinds == SPACE
    run = change | first  # first byte of a run of one class within one text
    # the last character of a run of spaces that something else follows in the same text
    ends = np.flatnonzero(run & ~space)
    ends = ends[ends > 0]
    ends = ends[space[ends - 1] & ~first[ends]]
    last = ends - 1
    while len(back := np.flatnonzero(~lead[last])):  # to the first byte of a wide space
        last[back] -= 1
    word = run.copy()
    word[last] = True  # it leaves the run of spaces before it
    blank = raw[last] == 0x20
    word[ends[blank]] = False  # a plain blank belongs to the word after it
    # an apostrophe alone, with no blank before it: a known ending stays with it
    quote = np.flatnonzero((raw == 0x27) & word[:n])
    if len(quote):
        after = np.append(kinds, np.uint8(SPACE))[quote + 1]
        inside = ~np.append(first, True)[quote + 1]
        quote = quote[(after == LETTER) & inside]
        padded = np.concatenate([raw, np.zeros(3, np.uint8)])
        stop = np.append(first, [True, True, True])
        for ending in ENDINGS:
            if not len(quote):
                break
            fits = np.ones(len(quote), bool)
            for k, b in enumerate(ending, 1):
                fits &= (padded[quote + k] == b) & ~stop[quote + k]
            hit = quote[fits]
            word[hit + 1] = False
            rest = hit + 1 + len(ending)
            rest = rest[rest < n]
            word[rest] = True
            quote = quote[~fits]
    return np.flatnonzero(word)


class Bpe:
    """A byte-level BPE vocabulary with its sorted pair keys."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        chars = byte_characters()
        to_byte = {c: b for b, c in chars.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        names = dict(vocab) | self.special
        size = max(names.values()) + 1
        token_bytes = [b""] * size
        for name, i in names.items():
            plain = name in self.special or any(c not in to_byte for c in name)
            token_bytes[i] = name.encode() if plain else bytes(to_byte[c] for c in name)
        self.token_length = np.array([len(t) for t in token_bytes], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_flat = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.byte_id = np.array([vocab.get(chars[b], 0) for b in range(256)], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        into = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_rank, self.pair_into = keys[order], order.astype(np.int32), into[order]
        slots = self._slots(self.pair_keys)
        self.pair_at = np.zeros(1 << SLOT_BITS, np.int32)  # one of the slot's pairs; of an empty one any
        self.pair_at[slots] = np.arange(len(slots))
        self.pair_more = np.bincount(slots, minlength=1 << SLOT_BITS) > 1
        self._forget()

    # --- merge rounds -------------------------------------------------------------------------

    @staticmethod
    def _slots(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.intp)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (left << 32) | right
        slots = self._slots(key)
        at = self.pair_at[slots]
        known = self.pair_keys[at] == key
        other = np.flatnonzero(~known & self.pair_more[slots])  # perhaps another pair of its slot
        if len(other):
            found = np.searchsorted(self.pair_keys, key[other])
            found[found == len(self.pair_keys)] = 0
            at[other], known[other] = found, self.pair_keys[found] == key[other]
        return np.where(known, self.pair_rank[at], NO_RANK), self.pair_into[at]

    def merge_words(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that lie one after another in ``raw``: (flat ids, ids per word)."""
        sym = self.byte_id[raw]
        length = lengths.astype(np.int64)
        index = np.arange(len(length))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(index):
            start = np.cumsum(length) - length
            rank = np.full(len(sym), NO_RANK, np.int32)
            into = np.zeros(len(sym), np.int64)
            inner = np.ones(len(sym), bool)
            inner[start + length - 1] = False
            at = np.flatnonzero(inner)
            rank[at], into[at] = self._ranks(sym[at], sym[at + 1])
            while True:
                lowest = np.minimum.reduceat(rank, start)
                open_ = lowest != NO_RANK
                if open_.mean() < 0.75:  # put the finished words aside
                    break
                pick = np.flatnonzero((rank != NO_RANK) & (rank == np.repeat(lowest, length)))
                # a pair of equal symbols may overlap itself: from the left, every second one
                head = np.ones(len(pick), bool)
                head[1:] = pick[1:] != pick[:-1] + 1
                if not head.all():
                    origin = np.maximum.accumulate(np.where(head, np.arange(len(pick)), 0))
                    pick = pick[(np.arange(len(pick)) - origin) % 2 == 0]
                sym[pick] = into[pick]
                keep = np.ones(len(sym), bool)
                keep[pick + 1] = False
                length -= np.add.reduceat(~keep, start, dtype=np.int64)
                moved = np.cumsum(keep) - 1
                sym, rank, into = sym[keep], rank[keep], into[keep]
                start = np.cumsum(length) - length
                final = np.zeros(len(sym), bool)
                final[start + length - 1] = True
                merged = moved[pick]
                before = merged - 1
                before = before[(before >= 0)]
                before = before[~final[before]]
                rank[merged[final[merged]]] = NO_RANK
                after = merged[~final[merged]]
                again = np.concatenate([before, after])
                rank[again], into[again] = self._ranks(sym[again], sym[again + 1])
            flat = np.repeat(open_, length)
            done.append((index[~open_], length[~open_], sym[~flat]))
            index, length, sym = index[open_], length[open_], sym[flat]
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        index, length, sym = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(index, kind="stable")
        start = np.cumsum(length) - length
        return sym[spans(start[order], length[order])], length[order]

    # --- words --------------------------------------------------------------------------------

    def _forget(self):
        self.known = np.zeros(0, np.uint64)
        self.known_word = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8))
        self.known_ids = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _encode_raw(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts between ``bounds`` in ``raw``: (flat ids, ids per text)."""
        texts = len(bounds) - 1
        if not len(raw):
            return np.zeros(0, np.int64), np.zeros(texts, np.int64)
        begins = word_starts(raw, bounds[:-1][np.diff(bounds) > 0])
        ends = np.append(begins[1:], len(raw))
        length = ends - begins
        first, which, keys = fold_words(raw, begins, length)
        if keys is None:  # two words with one key: nothing to remember them by
            ids, count = self.merge_words(raw[spans(begins[first], length[first])], length[first])
        else:
            ids, count = self._known(raw, keys, begins[first], length[first])
        offset = np.cumsum(count) - count
        per_word = count[which]
        flat = ids[spans(offset[which], per_word)]
        filled = np.append(np.cumsum(per_word) - per_word, len(flat))
        cut = filled[np.searchsorted(begins, bounds)]
        return flat, np.diff(cut)

    def _known(self, raw, keys, starts, lengths):
        """Ids of distinct words (keys ascending), from memory where they have been seen before."""
        if len(self.known) + len(keys) > CACHE_WORDS:
            self._forget()
        at = np.searchsorted(self.known, keys)
        at[at == len(self.known)] = 0
        found = self.known[at] == keys if len(self.known) else np.zeros(len(keys), bool)
        word_at, word_len, word_flat = self.known_word
        taken = found.copy()
        hit = np.flatnonzero(found)
        if len(hit):  # byte by byte again
            found[hit] = word_len[at[hit]] == lengths[hit]
            hit = np.flatnonzero(found)
            mine = raw[spans(starts[hit], lengths[hit])]
            differ = np.flatnonzero(mine != word_flat[spans(word_at[at[hit]], lengths[hit])])
            found[hit[np.searchsorted(np.cumsum(lengths[hit]), differ, side="right")]] = False
        new = np.flatnonzero(~found)
        text = raw[spans(starts[new], lengths[new])]
        ids, count = self.merge_words(text, lengths[new])
        ids_at, ids_len, ids_flat = self.known_ids
        where = np.empty(len(keys), np.int64)
        size = np.empty(len(keys), np.int64)
        where[found], size[found] = ids_at[at[found]], ids_len[at[found]]
        where[new], size[new] = len(ids_flat) + np.cumsum(count) - count, count
        ids_flat = np.concatenate([ids_flat, ids])
        pick = np.flatnonzero(~taken[new])  # a key that already stands for another word is not remembered again
        fresh = new[pick]
        order = np.searchsorted(self.known, keys[fresh])
        new_at = len(word_flat) + np.cumsum(lengths[new]) - lengths[new]
        self.known = np.insert(self.known, order, keys[fresh])
        self.known_word = (np.insert(word_at, order, new_at[pick]), np.insert(word_len, order, lengths[fresh]),
                           np.concatenate([word_flat, text]))
        self.known_ids = (np.insert(ids_at, order, where[fresh]), np.insert(ids_len, order, size[fresh]), ids_flat)
        return ids_flat[spans(where, size)], size

    # --- texts --------------------------------------------------------------------------------

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the UTF-8 texts between ``offsets`` in ``raw``: (flat ids, ids per text)."""
        whole = raw.tobytes()
        cuts: list[tuple[int, int, int]] = []  # a special token: from, to, id
        for name, i in self.special.items():
            token = name.encode()
            at = whole.find(token)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(token) <= offsets[text + 1]:
                    cuts.append((at, at + len(token), i))
                at = whole.find(token, at + len(token))
        if not cuts:
            return self._encode_raw(raw, offsets)
        cuts.sort()
        bounds = np.unique(np.concatenate([offsets, [c[0] for c in cuts], [c[1] for c in cuts]]))
        ids, count = self._encode_raw(raw, bounds)
        parts = np.split(ids, np.cumsum(count)[:-1])
        for start, _, i in cuts:
            parts[int(np.searchsorted(bounds, start))] = np.array([i], np.int64)
        size = np.append(0, np.cumsum([len(p) for p in parts]))
        return np.concatenate(parts), np.diff(size[np.searchsorted(bounds, offsets)])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids' tokens, one after another."""
        return self.token_flat[spans(self.token_start[ids], self.token_length[ids])]

    def byte_lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.token_length[ids]


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One vocabulary per worker process, whatever the number of tasks that it runs."""
    return Bpe(path)
