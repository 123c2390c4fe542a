"""Operators 11 to 13 against plain computations."""

import collections
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from cases import awkward_documents, awkward_vectors
from conftest import SF_SMALL
from pyspark.sql import functions as F

from envtrack.llm import divergence, graph_search, queries, variants
from envtrack.llm.common import table


# ---------------------------------------------------------------- 11: neighbours

def all_pairs(rows, k, modulus=20):
    """Every query's k best by (score, id, row), and all rows' scores by query."""
    sound = [(n, i, np.array(v, np.float64)) for n, (i, v) in enumerate(rows)
             if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, _, v in sound), default=0)
    x = np.array([np.pad(v, (0, width - len(v))) for _, _, v in sound])
    out = []
    for a, (n, ident, _) in enumerate(sound):
        if ident is None or ident % modulus:
            continue
        score = (x * x[a]).sum(axis=1)
        best = sorted((b for b in range(len(sound)) if b != a),
                      key=lambda b: (-round(score[b], 12), sound[b][1] is None, sound[b][1] or 0, sound[b][0]))[:k]
        out += [(ident, r, sound[b][1], round(float(score[b]), 9)) for r, b in enumerate(best, 1)]
    return sorted(out, key=str)


def found(vectors, **options):
    rows = graph_search.nearest(vectors, F.col("id") % 20 == 0, **options).collect()
    return sorted(((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in rows), key=str)


@pytest.mark.parametrize("k", [1, 20, 300])
def test_nearest_with_ties_repeats_and_unsound_vectors(spark, k):
    vectors = awkward_vectors(spark).repartition(3)
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    assert found(vectors, k=k) == all_pairs(rows, k)


def test_nearest_is_exact_where_vectors_are_equal_to_a_third(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)] if i % 3 else [1.0] * 8) for i in range(600)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    assert found(vectors, k=20) == all_pairs(rows, 20)


def test_recall_by_rounds_and_search_beyond_one_block(spark, monkeypatch):
    """With cells of 64 nodes a block says little: the joins of neighbours of neighbours and the search do."""
    monkeypatch.setattr(graph_search, "CELL_BITS", 6)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2500, 24)) * rng.uniform(0.5, 2, (2500, 1))  # norms differ: inner products, not angles
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(6)
    got = {(q, v) for q, _, v, _ in found(vectors, k=20)}
    expected = {(q, v) for q, _, v, _ in all_pairs(rows, 20)}
    assert len(got) == len(expected) == 125 * 20
    assert len(got & expected) >= 0.95 * len(expected)


def test_rounds_improve_the_graph(spark, monkeypatch):
    monkeypatch.setattr(graph_search, "CELL_BITS", 6)
    x = np.random.default_rng(8).standard_normal((1500, 16))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    _, nodes, number, width, peak = graph_search.distinct_vectors(vectors, "vec_id", "embedding")
    points = graph_search.numbered_nodes(nodes, number, width, peak)
    at = {tuple(r.x): r.node for r in points.collect()}
    node = np.array([at[tuple(v)] for v in x.tolist()])
    norm = np.square(x).sum(axis=1)
    full = np.concatenate([x, np.sqrt(norm.max() - norm)[:, None]], axis=1)
    score = full @ full.T
    np.fill_diagonal(score, -np.inf)
    best = {n: set(node[np.argsort(-s)[:16]]) for n, s in zip(node, score)}

    def recall(share):
        lists = graph_search.neighbour_graph(points, 16, 8, share, number).collect()
        return np.mean([len(best[r.node] & set(r.others)) / 16 for r in lists])

    assert recall(0.03) > 0.9 > recall(1.0) + 0.1


# ---------------------------------------------------------------- 12: divergence

def plain_audit(rows, least=30, most=50):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    seen, docs = collections.Counter(), collections.Counter()
    groups = sorted({(r[1] or "", r[2] or "") for r in rows})
    for text, lang, source in rows:
        terms = [t.translate(lower) for t in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        for t in terms:
            seen[lang or "", source or "", t] += 1
        for t in set(terms):
            docs[lang or "", t] += 1
    kept = collections.defaultdict(list)
    for (lang, t), n in docs.items():
        if n >= least:
            kept[lang].append(t)
    out = []
    for lang in {g[0] for g in groups}:
        sources, terms = [s for g, s in groups if g == lang], kept[lang]
        count = {s: {t: seen[lang, s, t] for t in terms} for s in sources}
        total = {t: sum(count[s][t] for s in sources) for t in terms}

        def shares(c):
            n = sum(c.values()) + 5 * len(terms)
            return {t: 1 + int(Fraction(10**9 * (x + 5), n)) for t, x in c.items()}

        p, q = {s: shares(count[s]) for s in sources}, shares(total)
        for s in sources:
            pair = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in terms), o.encode()) for o in sources if o != s))
            term = sorted((q[t] - p[s][t], t.encode()) for t in terms if count[s][t] and p[s][t] > q[t])[:most]
            for part, ranked in (("pair", pair), ("term", term)):
                out += [(lang, s, part, item.decode(), -v, r) for r, (v, item) in enumerate(ranked, 1)]
    return sorted(out)


def audited(docs, **options):
    out = divergence.audit(docs, **options).select("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r) for r in out.collect())


def term_rows():
    rng = random.Random(12)
    words = ["a", "Bb", "quiet", "Éclair", "日本語の", "straße", "twelveletters", "x" * 16, "y" * 17, "Z" * 40,
             "ö" * 300, "it", "OF", "seven77seven", "under_score"]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(12))), rng.choice(["en", "de", None]),
             rng.choice(["s0", "s1", "s2", "", None, "ß"])) for _ in range(400)]
    return rows + [(None, "en", "only null"), ("", "xx", "a"), ("once", "xx", "b"), ("\x00a\x00B\x7f", "en", "s0")] + [rows[0]] * 3


@pytest.mark.parametrize("least", [1, 30])
def test_audit(spark, least, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 4)  # several buckets of terms and blocks of sources
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 2)
    monkeypatch.setattr(divergence, "COUNT_BYTES", 200)
    monkeypatch.setattr(divergence, "HELD_ENTRIES", 16)
    rows = term_rows()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    assert audited(docs, least=least) == plain_audit(rows, least)


def test_audit_of_awkward_documents(spark):
    docs = awkward_documents(spark)
    assert audited(docs, least=2) == plain_audit([(r.text, r.lang, r.source) for r in docs.collect()], 2)


def test_shares_beyond_32_bits(spark):
    rows = [(c, n) for c in (5, 6, 10**12 + 1, 2**50 - 1) for n in (c, c + 1, 3 * c, 2**52 + 11) if c <= n]
    got = spark.createDataFrame(rows, "c bigint, n bigint").select("c", "n", divergence.share("c", "n").alias("p")).collect()
    assert all(r.p == 1 + 10**9 * r.c // r.n for r in got)


def test_radix_order_is_stable():
    rng = np.random.default_rng(1)
    low, high = (rng.integers(0, 3, 500).astype(np.uint64) << np.uint64(s) for s in (0, 60))
    assert (divergence.radix_order([low, high]) == np.lexsort((low, high))).all()


# ---------------------------------------------------------------- 13: variants

def plain_variants(rows, spoil=97, least=3):
    count = collections.Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.encode().lower().decode()
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % spoil == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if c >= least and len(w) >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    close = {w: [o for o in n if o != w and abs(len(o) - len(w)) <= 1 and near(w, o)] for w in n}
    form = {}
    for w, others in close.items():
        if others:
            best = min(others, key=lambda o: (-n[o], o))
            if n[best] >= 2 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(close[w]), n[form[w]] if w in form else None))
    return sorted(out, key=str)


def word_rows():
    rng = random.Random(13)
    base = ["garden", "Gardens", "straße", "çaéro", "aaaaa", "aaaaaa", "colour", "color", "x" * 3000]
    words = list(base)
    for _ in range(250):
        w = rng.choice(base[:8])
        at = rng.randrange(len(w) + 1)
        words.append(rng.choice([w[:at] + rng.choice("abzéÿ") + w[at:], w[:at] + w[at + 1:],
                                 w[:at] + rng.choice("abz×") + w[at + 1:]]))
    rows = [(i, " ".join(rng.choices(words, k=30))) for i in range(150)]
    return rows + [(None, "garden garden"), (None, None), (7, ""), (8, None), (9, "x" * 2999 + " " + ("x" * 2999 + "1") * 2),
                   (3, rows[3][1]), (3, rows[3][1])]


@pytest.mark.parametrize("bucket", [2, 512])
def test_variants(spark, bucket, monkeypatch):
    monkeypatch.setattr(variants, "BUCKET", bucket)  # with 2 nearly every signature is split
    monkeypatch.setattr(variants, "HELD_WORDS", 50)
    rows = word_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = variants.variants(docs, spoil=7).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_variants(rows, spoil=7)


def test_variants_of_the_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = queries.QUERIES["op13_spelling_variants"](spark, SF_SMALL)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_variants(rows)


def test_signatures_lose_no_near_words():
    rng = random.Random(2)
    for _ in range(300):
        a = "".join(rng.choices("abcé", k=rng.randrange(5, 12)))
        at = rng.randrange(len(a))
        for b, roles in ((a[:at] + "z" + a[at + 1:], (variants.SAME, variants.SAME)),
                         (a[:at] + rng.choice("abcz") + a[at:], (variants.SHORTER, variants.LONGER))):
            keys = [variants.signatures(*[np.frombuffer(w.encode("latin-1"), np.uint8), np.zeros(1, np.int64),
                                          np.array([len(w)])], role) for w, role in zip((a, b), roles)]
            assert (keys[0] == keys[1]).any()


def test_sql_of_the_audit_on_awkward_rows(spark):
    con = duckdb.connect()
    frame = awkward_documents(spark).select("doc_id", "text", "lang", "source").toPandas()
    frame = frame.loc[np.repeat(np.arange(len(frame)), 16)]  # so that some terms are in 30 documents
    con.register("documents", frame)
    docs = spark.createDataFrame([tuple(None if x != x else x for x in r) for r in frame.itertuples(index=False)],
                                 "doc_id double, text string, lang string, source string")
    columns = "lang, source, part, item, value, rank"
    assert audited(docs) == sorted(con.sql(f"SELECT {columns} FROM ({divergence.ORACLE})").fetchall())
