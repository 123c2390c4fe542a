"""BPE, curve packing and token matrices against the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import awkward_documents
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from envtrack.llm import curve_packing, encoding, token_matrix
from envtrack.llm.bpe import load
from envtrack.llm.common import table, text_buffer
from envtrack.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def public():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(public, text):
    return public.encode(text or "", add_special_tokens=False).ids


def numpy_ids(texts):
    raw, offsets = text_buffer(pa.array(texts, pa.string()))
    flat, counts = load(VOCABULARY).encode(raw, offsets)
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


def test_bpe_equals_the_library(public):
    rng = random.Random(3)
    parts = ["a", " ", "  ", "\n", "'s", "'", "'ll", "é", "日本", "1", "23", "!", "<|endoftext|>", "　", "\xa0", "\r\n",
             "😀", "aaaa", " the", "'t", "'d", "’s", "\x1c", "\x85", "ß", "٣", "½", "don't", "''s", " 's", "ABC"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + ["", "x" * 3000]
    assert numpy_ids(texts) == [ids_of(public, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_bpe_on_any_text(texts):
    public = Tokenizer.from_file(VOCABULARY)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert numpy_ids(texts) == [ids_of(public, t) for t in texts]


def test_encode_and_decode(spark, public):
    docs = awkward_documents(spark)
    rows = encoding.decode(encoding.encode(docs, VOCABULARY), VOCABULARY).collect()
    source = docs.select("doc_id", "text").collect()
    expected = sorted(((r.doc_id or -1), np.array(ids_of(public, r.text), "<u4").tobytes(), r.text or "") for r in source)
    assert sorted((r.doc_id or -1, bytes(r.ids), r.text) for r in rows) == expected
    odd = spark.createDataFrame([(1, bytearray(b"\xff\x00\x00\x00\xff\xff\xff\x00")), (2, None)], "doc_id long, ids binary")
    assert {r.doc_id: r.text for r in encoding.decode(odd, VOCABULARY).collect()}[2] == ""


def test_hilbert_curve_visits_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = curve_packing.hilbert_key(grid, 3)
    assert sorted(key) == list(range(512))
    walk = grid[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check_pieces(rows, source, public, length):
    whole = defaultdict(list)
    for i, text in source:
        whole[i].append(ids_of(public, text) + [1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(whole)
    for i, documents in whole.items():  # every id of every document lies in exactly one piece
        assert sum(r.length for r in pieces[i]) == sum(map(len, documents))
        crc = {(r.start, r.length, r.doc_tokens): r.ids_crc32 for r in pieces[i]}
        for (start, size, tokens), value in crc.items():
            assert any(len(d) == tokens and zlib.crc32(np.array(d[start:start + size], "<u4").tobytes()) == value
                       for d in documents)
        for d in documents:
            covered = sorted((r.start, r.start + r.length) for r in pieces[i] if r.doc_tokens == len(d))
            assert covered[0][0] == 0 and max(c[1] for c in covered) == len(d)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == length or (at < length and at & (at - 1) == 0)


def test_curve_packing(spark, public):
    docs = awkward_documents(spark)
    rows = curve_packing.piece_digests(curve_packing.pack_along_curve(docs, VOCABULARY, length=256)).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], public, 256)


def test_curve_packing_of_a_table(spark, public):
    docs = table(spark, SF_SMALL, "documents")
    rows = curve_packing.piece_digests(curve_packing.pack_along_curve(docs, VOCABULARY)).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], public, 2048)


def best_fit_by_search(sizes, capacity):
    room, rows = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [r for r in range(len(room)) if room[r] >= sizes[i]]
        if fits:
            r = min(fits, key=lambda r: room[r])
        else:
            r = len(room)
            room.append(capacity)
        room[r] -= sizes[i]
        rows.append((i, r))
    return sorted(room)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
def test_best_fit_decreasing(sizes):
    row, offset, rows = token_matrix.best_fit_decreasing(np.array(sizes), 40)
    used = np.bincount(row, weights=sizes, minlength=rows).astype(int)
    assert sorted((40 - used).tolist()) == best_fit_by_search(sizes, 40)
    for r in range(rows):
        mine = sorted((o, s) for o, s, k in zip(offset, sizes, row) if k == r)
        assert all(b[0] == a[0] + a[1] for a, b in zip(mine, mine[1:])) and mine[0][0] == 0


@pytest.mark.parametrize("block", [4 << 20, 500])
def test_token_matrix_is_lossless(spark, public, block):
    docs = awkward_documents(spark)
    rows = token_matrix.pack_matrix(docs, VOCABULARY, length=128, block_tokens=block).collect()
    assert len({r.row_id for r in rows}) == len(rows)
    found = defaultdict(list)
    for r in rows:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        ends = r.cu_seqlens
        assert len(ids) == len(places) == 128 and ends[0] == 0 and ends[-1] == r.n_tokens
        assert len(ends) == len(r.segments) + 1 and (ids[r.n_tokens:] == 50256).all()
        for a, z, s in zip(ends, ends[1:], r.segments):
            assert (places[a:z] == np.arange(z - a)).all()
            found[s.id].append((s.start, ids[a:z].tolist()))
    expected = defaultdict(list)
    for r in docs.collect():
        d = ids_of(public, r.text) + [50256]
        expected[r.doc_id] += [(s, d[s:s + 128]) for s in range(0, len(d), 128)]
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}


def test_matrix_is_well_filled(spark, scratch):
    matrix = token_matrix.pack_matrix(table(spark, SF_SMALL, "documents"), VOCABULARY, length=512)
    token_matrix.write_matrix(matrix, scratch + "/matrix")
    rows = spark.read.parquet(scratch + "/matrix").select("n_tokens").collect()
    assert sum(r.n_tokens for r in rows) > 0.97 * 512 * len(rows)
