"""The quality classifier and the language model: held-out accuracy, exact base scores, gradients."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import awkward_documents, awkward_labels
from conftest import SF_MID, SF_SMALL
from tokenizers import Tokenizer

from envtrack.llm import attention, lm_scoring, quality
from envtrack.llm.bpe import load
from envtrack.llm.common import table, text_buffer
from envtrack.llm.queries import VOCABULARY


def test_held_out_quality(spark):
    labels = table(spark, SF_MID, "labels")
    scores = quality.score_documents(table(spark, SF_MID, "documents"), labels)
    rows = scores.join(labels, "doc_id").collect()
    assert scores.count() == table(spark, SF_MID, "documents").count()
    for r in scores.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    out = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in out) >= 0.97 * len(out)
    good = [r.predicted for r in out if r.quality == 1]
    assert sum(good) >= 0.98 * len(good)


def test_keep_good_returns_the_predicted_rows_whole(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    kept = quality.keep_good(docs, labels)
    predicted = quality.score_documents(docs, labels).where("predicted = 1")
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in predicted.collect())


def test_quality_of_awkward_rows(spark):
    docs = awkward_documents(spark)
    rows = quality.score_documents(docs, awkward_labels(spark)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 3}) == 1  # repeated rows


@pytest.mark.parametrize("kind, expected", [(1, {0.7}), (0, {0.0})])
def test_labels_of_one_kind(spark, kind, expected):
    labels = awkward_labels(spark).where(f"quality = {kind}")
    scores = {round(r.score, 9) for r in quality.score_documents(awkward_documents(spark), labels).collect()}
    assert all(abs(s - next(iter(expected))) < 1e-6 for s in scores)


def test_no_labels(spark):
    rows = quality.score_documents(awkward_documents(spark), awkward_labels(spark).limit(0)).collect()
    assert {r.predicted for r in rows} == {1}


def plain_base(rows):
    words = [re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
             for _, t in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i, _ in rows]
    counts, ends = Counter(), 0
    for w, out in zip(words, held):
        if not out:
            counts.update(w)
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    z = math.log10(n + 0.5 * (v + 1))
    out = {}
    for (i, t), w, h in zip(rows, words, held):
        score = sum(math.log10(counts.get(x, 0) + 0.5) - z for x in w) + math.log10(ends + 0.5) - z
        out[(i, t)] = (h, len(w) + 1, sum(counts.get(x, 0) > 0 for x in w) + (ends > 0), n, score)
    return out


def test_base_scores_and_awkward_rows(spark):
    docs = awkward_documents(spark).repartition(3)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = lm_scoring.score_documents(docs, VOCABULARY).collect()
    expected = sorted([(i or -1, *plain_base(rows)[(i, t)]) for i, t in rows])
    assert len(found) == len(rows)
    for r, e in zip(sorted((r.doc_id or -1, *list(r)[1:]) for r in found), expected):
        assert r[:5] == e[:5]
        assert r[5] == pytest.approx(e[5], rel=1e-9) and math.isfinite(r[6]) and r[6] < 0


def test_scores_of_a_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = plain_base(rows)
    found = {r.doc_id: r for r in lm_scoring.score_documents(docs, VOCABULARY).collect()}
    assert len(found) == len(rows)
    for i, t in rows:
        assert found[i].base_score == pytest.approx(expected[(i, t)][4], rel=1e-9)
    # far better than a uniform guess over the vocabulary
    public = Tokenizer.from_file(VOCABULARY)
    ids = sum(len(public.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.score for r in found.values()) > -0.6 * math.log10(50257) * ids


def small_model():
    raw, offsets = text_buffer(__import__("pyarrow").array(["the cat sat on the mat. " * 40, "a dog", "", "ééé 123"] * 8))
    bpe = load(VOCABULARY)
    flat, counts = bpe.encode(raw, offsets)
    size = len(bpe.token_length)
    model = lm_scoring.Model(np.bincount(flat, minlength=size).astype(float), bpe)
    windows, _ = lm_scoring.windows_of(flat, counts, size, size + 1, size + 2)
    pairs, often = lm_scoring.pairs_of(flat, counts, size)
    assert often.sum() == len(flat) + len(counts)
    dense = np.zeros((attention.SYMBOLS + 2) * attention.SYMBOLS)
    np.add.at(dense, model.symbol[pairs // (size + 3)] * attention.SYMBOLS + model.symbol[pairs % (size + 3)], often)
    model.tables = attention.Tables.from_counts(dense.reshape(-1, attention.SYMBOLS))
    return model, flat, counts, windows


def test_every_id_is_a_target_once():
    _, flat, counts, windows = small_model()
    size = len(load(VOCABULARY).token_length)
    targets = windows[:, attention.CONTEXT + 1:].ravel()
    real = targets[targets < size]
    assert (np.sort(real) == np.sort(flat)).all() and (targets == size + 1).sum() == len(counts)


def test_every_id_is_scored_with_16_to_63_ids_before_it():
    ids = np.arange(1000)
    windows, _ = lm_scoring.windows_of(ids, np.array([1000]), 2000, 2001, 2002)
    seen = [place + 1 for w in windows for place in range(attention.CONTEXT, attention.WINDOW)
            if w[place + 1] != 2002 and w[0] != 2002]
    assert min(seen) >= 17 and max(seen) >= 64  # the place before a target is the input that predicts it


def test_every_training_window_is_dealt_once(spark):
    docs = table(spark, SF_SMALL, "documents").unionByName(awkward_documents(spark).select("doc_id", "text"), True)
    marked = lm_scoring._marked(docs, "doc_id", "text")
    bpe = load(VOCABULARY)
    size = len(bpe.token_length)
    raw, offsets = text_buffer(marked.where("not held_out").select("text").toArrow().column(0))
    expected, _ = lm_scoring.windows_of(*bpe.encode(raw, offsets), size, size + 1, size + 2)
    rows = lm_scoring._dealt(lm_scoring._blocks(marked, VOCABULARY), size, 3, 2).collect()
    assert {(r.turn, r.part) for r in rows} == {(t, p) for t in range(3) for p in range(2)}
    found = np.concatenate([lm_scoring.windows_of_runs(
        np.frombuffer(r.codes, "<u2").astype(np.int32), np.frombuffer(r.lengths, "<i4").astype(np.int64), size, size + 2)
        for r in rows])
    assert sorted(w.tobytes() for w in found) == sorted(w.tobytes() for w in expected)


def test_copies_of_a_text_spread_over_rounds_and_copies(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, concat('text number ', id), 'the one text') as text")
    size = len(load(VOCABULARY).token_length)
    rows = lm_scoring._dealt(lm_scoring._blocks(lm_scoring._marked(docs, "doc_id", "text"), VOCABULARY), size, 3, 4).collect()
    equal, held = {}, [0] * 12
    for r in rows:
        windows = lm_scoring.windows_of_runs(np.frombuffer(r.codes, "<u2").astype(np.int32),
                                             np.frombuffer(r.lengths, "<i4").astype(np.int64), size, size + 2)
        held[r.turn * 4 + r.part] += len(windows)
        for w in windows:
            equal.setdefault(w.tobytes(), [0] * 12)[r.turn * 4 + r.part] += 1
    copies = max(equal.values(), key=sum)
    assert sum(copies) > 1500 and max(copies) < 1.5 * sum(copies) / 12 and max(held) < 1.5 * sum(held) / 12


def test_rounds_and_copies_grow_with_the_corpus():
    per_copy = []
    for windows in (1, 10**5, 10**7, 10**9):
        rounds, parts = lm_scoring.rounds_and_copies(windows)
        assert rounds >= 3 and rounds * parts * lm_scoring.SLICE_WINDOWS >= windows
        per_copy.append(windows / parts)
    assert per_copy == sorted(set(per_copy))


def test_probabilities_sum_to_one():
    model, *_ = small_model()
    rng = np.random.default_rng(0)
    p = {k: v + rng.standard_normal(v.shape).astype(np.float32) * 0.05 for k, v in model.parameters.items()}
    window = rng.integers(0, attention.SYMBOLS, (1, attention.WINDOW + 1))
    window[0, attention.CONTEXT + 2:] = attention.PAD
    every = np.repeat(window, attention.SYMBOLS, axis=0)
    every[:, attention.CONTEXT + 1] = np.arange(attention.SYMBOLS)
    assert np.exp(attention.log_chances(p, model.tables, every)).sum() == pytest.approx(1, abs=1e-4)
    assert np.exp(model.within[:model.size][model.symbol[:model.size] == lm_scoring.RARE]).sum() == pytest.approx(1)


def test_whole_vocabulary_is_predicted_from_the_context(spark):
    docs = spark.createDataFrame([(i, t) for i in range(0, 300) for t in ["zebra quantum", "walrus nebula"]], "doc_id int, text string")
    docs = docs.unionByName(table(spark, SF_SMALL, "documents").select("doc_id", "text").limit(300))
    marked = lm_scoring._marked(docs, "doc_id", "text")
    bpe = load(VOCABULARY)
    size = len(bpe.token_length)
    counts = np.zeros(size)
    counts[:1100] = 10**9  # so that the words above are none of the symbols
    blocks = lm_scoring.staged(lm_scoring._blocks(marked, VOCABULARY), "test-blocks")
    model = lm_scoring.train(blocks, counts, bpe)

    def ids(text):
        return bpe.encode(*text_buffer(pa.array([text])))[0]

    for right, wrong in (("zebra quantum", "walrus quantum"), ("walrus nebula", "zebra nebula")):
        (a, b), (c, d) = ((ids(t), np.array([len(ids(t))])) for t in (right, wrong))
        lead_a, lead_c = ids(right.split()[0]), ids(wrong.split()[0])
        assert (model.symbol[a] == lm_scoring.RARE).any()
        right_gain = model.log10(a, b)[0] - model.log10(lead_a, np.array([len(lead_a)]))[0]
        wrong_gain = model.log10(c, d)[0] - model.log10(lead_c, np.array([len(lead_c)]))[0]
        assert right_gain > wrong_gain + 0.5


def test_chances_of_all_ids_sum_to_one_with_tail_and_pairs():
    model, *_ = small_model()
    rng = np.random.default_rng(0)
    p = {k: v + rng.standard_normal(v.shape).astype(np.float32) * 0.05 for k, v in model.parameters.items()}
    model.tables.set_tail(model.within[model.tail])
    codes = attention.TAIL + len(model.tail)
    every = np.array([*model.code[:model.size], lm_scoring.END])
    for before in (5, codes - 7):  # a symbol and an id of the tail
        after = np.array([3, codes - 9, codes - 2])
        key, share = before * codes + after, np.array([0.2, 0.1, 0.3])
        if before < attention.TAIL:
            key, share = key[1:], share[1:]
        rest = np.ones(codes)
        rest[before] -= share.sum()
        model.tables.pairs = attention.Pairs(key, share, rest)
        windows = np.full((len(every), attention.WINDOW + 1), attention.PAD, np.int32)
        windows[:, 3:attention.CONTEXT] = rng.integers(0, codes, attention.CONTEXT - 3)
        windows[:, attention.CONTEXT], windows[:, attention.CONTEXT + 1] = before, every
        assert np.exp(attention.log_chances(p, model.tables, windows)).sum() == pytest.approx(1, abs=2e-4)


def test_gradients_of_the_tail():
    model, _, _, windows = small_model()
    model.tables.set_tail(model.within[model.tail])
    rng = np.random.default_rng(1)
    p = {k: (v + rng.standard_normal(v.shape) * 0.05).astype(np.float64) for k, v in model.parameters.items()}
    w = rng.integers(0, attention.TAIL + len(model.tail), (3, attention.WINDOW + 1))
    w[(w >= attention.SYMBOLS) & (w < attention.TAIL)] = 1
    g = attention.gradients(p, model.tables, w)
    assert set(g) == set(p)
    for name in (n for n in p if n.startswith("tail")):
        at = np.unravel_index(np.abs(g[name]).argmax(), p[name].shape)
        old, values = p[name][at], []
        for step in (1e-3, -1e-3):
            p[name][at] = old + step
            values.append(-attention.forward(p, model.tables, w)[0].mean())
        p[name][at] = old
        assert g[name][at] != 0 and (values[0] - values[1]) / 2e-3 == pytest.approx(g[name][at], rel=0.05)
    chance = attention.log_chances({k: v.astype(np.float32) for k, v in p.items()}, model.tables, w)
    logp, real, _ = attention.forward(p, model.tables, w)
    assert np.allclose(chance, np.bincount(real // attention.SCORED, weights=logp), rtol=1e-4)


def test_training_improves_and_gradients_are_right():
    model, _, _, windows = small_model()
    w = model.symbol[windows]
    before = attention.log_chances(model.parameters, model.tables, w).sum()
    p = model.parameters
    for seed in range(3):
        p = attention.train(p, model.tables, w, seed=seed)
    assert attention.log_chances(p, model.tables, w).sum() > before
    rng = np.random.default_rng(1)
    p = {k: (v + rng.standard_normal(v.shape) * 0.05).astype(np.float64) for k, v in p.items()}
    g = attention.gradients(p, model.tables, w[:4])

    def loss():
        return -attention.forward(p, model.tables, w[:4])[0].mean()

    for name in p:
        at = np.unravel_index(np.abs(g[name]).argmax(), p[name].shape)
        old, values = p[name][at], []
        for step in (1e-3, -1e-3):
            p[name][at] = old + step
            values.append(loss())
        p[name][at] = old
        assert (values[0] - values[1]) / 2e-3 == pytest.approx(g[name][at], rel=0.05, abs=1e-5)


def test_the_future_is_not_seen():
    model, _, _, windows = small_model()
    rng = np.random.default_rng(0)
    p = {k: v + rng.standard_normal(v.shape).astype(np.float32) * 0.1 for k, v in model.parameters.items()}
    w = rng.integers(0, attention.SYMBOLS, (2, attention.WINDOW + 1))
    w[1] = w[0]
    w[1, -10:] = rng.integers(0, attention.SYMBOLS, 10)
    logp, real, _ = attention.forward(p, model.tables, w)
    by_place = np.zeros(2 * attention.SCORED)
    by_place[real] = logp
    first, second = by_place.reshape(2, -1)[:, :attention.SCORED - 10]
    assert np.allclose(first, second, atol=1e-5)


def plain_features(text):
    """The style measures of one text, written down one by one."""
    raw = text.encode()
    n = max(1, len(raw))
    kinds = [range(65, 91), range(97, 123), b"0123456789", b" \t", b"\n\r", b".?", b",;:", b"'\"()-",
             b"!#$%&*+/<=>@[\\]^_`{}~", b"|", range(128, 256)]
    out = [math.log1p(len(raw)), *(sum(b in k for b in raw) / n for k in map(set, kinds))]
    out.append(-sum(c / n * math.log2(c / n) for c in Counter(raw).values()))
    words = raw.split()
    if not words:
        return out + [0.0] * 8
    m, tally = len(words), Counter(words)
    symbols = set(b"!#$%&*+/<=>@[\\]^_`{}~|")
    lines = [x for x in raw.split(b"\n") if x]
    return out + [math.log1p(sum(len(w) for w in words) / m), len(tally) / m,
                  sum(a == b for a, b in zip(words, words[1:])) / m, max(tally.values()) / m,
                  sum(w[-1] in symbols for w in words) / m,
                  sum(len(w) < 4 and not w.isalpha() and all(b < 128 for b in w) for w in words) / m,
                  math.log1p(len(raw) / len(lines)), len(set(lines)) / len(lines)]


def test_features_are_those_of_a_plain_computation(spark):
    docs = awkward_documents(spark).select("doc_id", "text").unionByName(
        table(spark, SF_SMALL, "documents").select("doc_id", "text")).repartition(3)
    rows = quality.document_features(docs.withColumnRenamed("doc_id", "key"), "key")
    found = sorted((str(r[0]), tuple(round(x, 9) for x in r[1])) for r in rows.collect())
    want = sorted((str(r.doc_id), tuple(round(x, 9) for x in plain_features(r.text or ""))) for r in docs.collect())
    assert found == want and len(quality.FEATURES) == len(found[0][1])


def test_fit_ranks_preference_pairs_and_cuts_at_the_quantile_of_fewest_errors():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, len(quality.FEATURES)))
    good = x[:, 3] - 2 * np.abs(x[:, 5]) > -1.2  # not linear in the measures
    model = quality.fit(x, good)
    strength = model.strength(x)
    pairs = strength[good][:, None] > strength[~good][None, :]
    assert pairs.mean() > 0.97
    errors = [((strength >= c) != good).sum() for c in np.append(strength, np.inf)]
    assert ((model.score(x) >= 0.7) != good).sum() == min(errors)
    loss = -np.log(1 / (1 + np.exp(-(strength[good][:, None] - strength[~good][None, :])))).mean()
    assert loss < 0.2 < math.log(2)


def test_labels_and_documents_with_repeated_ids_do_not_multiply(spark):
    docs = spark.createDataFrame([(i % 40, f"Some text, number {i % 40}. It goes on and on.") for i in range(200)], "doc_id int, text string")
    labels = spark.createDataFrame([(i % 40, i % 2) for i in range(400)], "doc_id int, quality int")
    assert quality.marked(labels).groupBy("doc_id").count().where("count > 1").isEmpty()
    assert quality.labelled_texts(docs, labels, rows=10).select("doc_id").distinct().count() == 10


def test_scores_of_large_weights_are_those_of_the_plain_forward_pass():
    model, _, _, windows = small_model()
    w = model.symbol[windows][:8]
    for factor in (1, 200, 5000):
        p = {k: v * np.float32(factor) if k in ("query", "class_head") else v for k, v in model.parameters.items()}
        rng = np.random.default_rng(4)
        p["class_head"] = p["class_head"] + rng.standard_normal(p["class_head"].shape).astype(np.float32) * factor / 20
        logp, real, _ = attention.forward({k: v.astype(np.float64) for k, v in p.items()}, model.tables, w)
        plain = np.bincount(real // attention.SCORED, weights=logp, minlength=len(w))
        got = attention.log_chances(p, model.tables, w)
        assert np.isfinite(got).all() and np.allclose(got, plain, rtol=2e-3, atol=0.05)


def test_the_trained_model_beats_counts_alone_on_held_out_texts(spark):
    """Attention does work: with its trained output taken away, held-out texts are less likely."""
    marked = lm_scoring._marked(table(spark, SF_MID, "documents"), "doc_id", "text")
    bpe = load(VOCABULARY)

    def encoded(rows):
        return bpe.encode(*text_buffer(rows.select("text").toArrow().column(0)))

    counts = np.bincount(encoded(marked.where("not held_out"))[0], minlength=len(bpe.token_length)).astype(float)
    model = lm_scoring.train(lm_scoring.staged(lm_scoring._blocks(marked, VOCABULARY), "test-blocks"), counts, bpe)
    flat, sizes = encoded(marked.where("held_out"))
    trained = model.log10(flat, sizes).sum()
    model.parameters = attention.initial(len(model.tail))  # corrections of zero: the counts alone
    counted = model.log10(flat, sizes).sum()
    assert trained > 0.95 * counted


def test_sums_of_exponentials_that_leave_the_range_are_taken_again_without_their_maxima():
    rng = np.random.default_rng(5)
    for factor, offset in ((1, 0), (1, 200), (1, -200), (300, 0)):
        logits = (rng.standard_normal((40, 8)) * factor + offset).astype(np.float32)
        wanted = rng.integers(0, 8, 40)
        exact = logits.astype(np.float64) - logits.max(axis=1, keepdims=True)
        exact -= np.log(np.exp(exact).sum(axis=1, keepdims=True))
        with np.errstate(over="ignore", invalid="ignore"):
            logp, chance = attention._chances(logits, wanted)
        assert np.allclose(logp, exact[np.arange(40), wanted], rtol=1e-5, atol=1e-4)
        assert np.allclose(chance, np.exp(exact), atol=1e-5)


def test_weighted_values_leave_out_padding_and_the_range_does_no_harm():
    rng = np.random.default_rng(6)
    padded = np.zeros((2, 5), bool)
    padded[0, :2] = True
    v = np.ones((2, 5, attention.WIDTH + 1), np.float32)
    v[:, :, :-1] = rng.standard_normal((2, 5, attention.WIDTH))
    v[padded] = 0
    for offset in (0, 150, -150):
        att = (rng.standard_normal((2, 3, 5)) + offset).astype(np.float32)
        weights = np.exp(att.astype(np.float64) - offset) * ~padded[:, None, :]
        exact = weights @ v[:, :, :-1] / weights.sum(axis=2, keepdims=True)
        with np.errstate(over="ignore", invalid="ignore"):
            mixed = attention._weighted(att, v, padded)[1]
        assert np.allclose(mixed[:, :, :-1] / mixed[:, :, -1:], exact, atol=1e-4)


@pytest.mark.parametrize("most", [3, 50])
def test_rows_are_summed_by_their_numbers(most):
    rng = np.random.default_rng(7)
    at = np.repeat(np.arange(30), rng.integers(1, most, 30))
    rng.shuffle(at)
    values = rng.standard_normal((len(at), 4, 3))
    found, sums = attention._rows(at, values)
    assert found.tolist() == list(range(30))
    assert np.allclose(sums, [values[at == i].sum(axis=0) for i in range(30)])
