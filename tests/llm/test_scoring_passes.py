"""Operator 9's passes over blocks, words and batches: word counts by parts, words told apart, pairs in slots, plans."""

from collections import Counter

import numpy as np
import pytest
from cases import awkward_documents
from conftest import SF_SMALL
from test_models import plain_base, small_model

from envtrack.llm import attention, lm_scoring
from envtrack.llm.bpe import load
from envtrack.llm.common import table
from envtrack.llm.queries import VOCABULARY
from envtrack.llm.words import dictionary_of, fold_words


@pytest.mark.parametrize("part_words", [1, 40, 1 << 19])
def test_words_are_summed_over_blocks_by_parts(spark, monkeypatch, part_words):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 500)
    monkeypatch.setattr(lm_scoring, "PART_WORDS", part_words)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["the cat sat on the mat", "The dog " * 90, "", "zebra", "mat cat é " * 70, "the end", None] * 3)],
        "doc_id int, text string").repartition(2)
    blocks = lm_scoring.staged(lm_scoring._blocks(lm_scoring._marked(docs, "doc_id", "text"), VOCABULARY), "test-blocks")
    held, total = [], Counter()
    for r in blocks.collect():
        at = np.append(0, np.cumsum(np.frombuffer(r.word_lengths, "<i4")))
        words = [bytes(r.words[a:z]) for a, z in zip(at, at[1:])]
        counts = np.frombuffer(r.counts, "<i8").tolist()
        assert r.n_words == len(words) == len(set(words)) == len(counts)
        held.append((r.block, words))
        total.update(dict(zip(words, counts)))
    blocks_of = Counter(w for _, words in held for w in words)
    rows = lm_scoring._summed_words(blocks).collect()
    parts = -(-sum(len(words) for _, words in held) // part_words)
    assert len(held) > 4 and len(rows) <= len(held) * parts  # a row holds many words
    assert sum(r.total for r in rows) == sum(total.values())
    assert sum(r.distinct for r in rows) == sum(n > 0 for n in total.values())
    found = {(r.block, p): c for r in rows for p, c in zip(np.frombuffer(r.pos, "<i4").tolist(), np.frombuffer(r.c, "<i8").tolist())}
    assert found == {(b, p): total[w] for b, words in held for p, w in enumerate(words) if blocks_of[w] > 1 and total[w]}


def test_scores_of_many_blocks_are_those_of_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(lm_scoring, "PART_WORDS", 100)
    docs = awkward_documents(spark).select("doc_id", "text").unionByName(
        table(spark, SF_SMALL, "documents").select("doc_id", "text").limit(40)).repartition(3)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = plain_base(rows)
    found = lm_scoring.score_documents(docs, VOCABULARY).collect()
    want = sorted((i or -1, *expected[(i, t)]) for i, t in rows)
    got = sorted((r.doc_id or -1, *list(r)[1:6]) for r in found)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)


def test_words_are_told_apart_by_their_bytes():
    rng = np.random.default_rng(0)
    for _ in range(40):
        raw = rng.integers(97, 100, rng.integers(1, 300)).astype(np.uint8)
        cut = np.unique(np.append(0, rng.integers(0, len(raw), 50)))
        lengths = np.diff(np.append(cut, len(raw)))
        some = rng.random(len(cut)) < 0.7
        for begins, size in ((cut, lengths), (cut[some], lengths[some])):
            words = [raw[b:b + n].tobytes() for b, n in zip(begins, size)]
            first, which, keys = fold_words(raw, begins, size)
            assert [words[i] for i in first[which]] == words and len(first) == len(set(words))
            assert (keys[1:] > keys[:-1]).all() and all(words.index(words[i]) == i for i in first)
            half = len(words) // 2
            parts = [(np.frombuffer(b"".join(x), np.uint8), np.array([len(w) for w in x], np.int64))
                     for x in (words[:half], [], words[half:])]
            number, distinct = dictionary_of(*parts)
            assert distinct.to_pylist() == list(dict.fromkeys(words))
            assert [distinct[int(i)].as_py() for i in number] == words
    assert len(dictionary_of()[0]) == 0


def test_pairs_in_slots_are_those_of_a_search():
    bpe = load(VOCABULARY)
    rng = np.random.default_rng(1)
    left, right = np.append(bpe.pair_keys >> 32, rng.integers(0, 50000, 50000)), np.append(
        bpe.pair_keys & 0xFFFFFFFF, rng.integers(0, 50000, 50000))
    rank, into = bpe._ranks(left, right)
    at = {int(k): i for i, k in enumerate(bpe.pair_keys)}
    place = np.array([at.get(int(k), -1) for k in (left << 32) | right])
    assert (place[:len(at)] == np.arange(len(at))).all() and (place < 0).sum() > 40000
    known = place >= 0
    assert (rank[known] == bpe.pair_rank[place[known]]).all() and (into[known] == bpe.pair_into[place[known]]).all()
    assert (rank[~known] == 2**31 - 1).all()
    assert bpe.pair_more[bpe._slots(bpe.pair_keys)].sum() > 1000  # slots with several pairs are among them


def test_plans_made_together_are_those_of_each_batch_alone():
    model, _, _, windows = small_model()
    rng = np.random.default_rng(2)
    windows = model.code[np.concatenate([windows] * 12)][:330]
    at = rng.random(windows.shape) < 0.1
    windows[at] = attention.TAIL + rng.integers(0, len(model.tail), at.sum())
    together = list(attention._plans(windows, 32))
    assert len(together) == 11
    for t, plan in enumerate(together):
        part = windows[32 * t:32 * t + 32]
        alone = next(attention._plans(part, 32, 1))
        for name, value in vars(plan).items():
            assert np.array_equal(value, getattr(alone, name)), name
        targets = part[:, attention.CONTEXT + 1:].ravel()
        assert (targets[plan.sorted] == plan.codes).all() and sorted(plan.sorted) == np.flatnonzero(targets != attention.PAD).tolist()
        assert (part[:, :attention.WINDOW].ravel()[plan.at] == plan.own + attention.TAIL).all()
        assert sorted(plan.at) == np.flatnonzero(part[:, :attention.WINDOW].ravel() >= attention.TAIL).tolist()


def test_exponentials_in_place_are_taken_again_where_the_range_is_left():
    rng = np.random.default_rng(3)
    v = np.ones((2, 5, attention.WIDTH + 1), np.float32)
    v[:, :, :-1] = rng.standard_normal((2, 5, attention.WIDTH))
    for offset in (0, 150, -150):
        scores = (rng.standard_normal((2, 3, 5)) + offset).astype(np.float32)
        with np.errstate(over="ignore", invalid="ignore"):
            weights, mixed = attention._weighted(scores.copy(), v, np.zeros((2, 5), bool), scores.copy)
            other, plain = attention._weighted(scores.copy(), v, np.zeros((2, 5), bool))
        assert np.isfinite(mixed).all() and (weights == other).all() and (mixed == plain).all()


@pytest.mark.parametrize("texts", [[], [None, ""] * 20, [" \n", "\t"] * 20])
def test_tables_without_words(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = plain_base(rows)
    found = lm_scoring.score_documents(docs, VOCABULARY).collect()
    assert sorted(list(r)[:5] for r in found) == sorted([i, *expected[(i, t)][:4]] for i, t in rows)
    assert all(r.base_score == pytest.approx(expected[(r.doc_id, dict(rows)[r.doc_id])][4], rel=1e-9) for r in found)
