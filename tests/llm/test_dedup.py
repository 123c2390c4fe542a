"""Exact dedup, the n-gram join and sharding against plain computations."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import awkward_documents, prose
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from envtrack.llm import exact_dedup, ngram_join, sharding
from envtrack.llm.common import components, left_join_by_key, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**12 - 1), max_size=60), min_size=1, max_size=5))
def test_quotient_filters_merge_without_loss(parts):
    filters = []
    for part in parts:
        values, counts = np.unique(np.array(part, np.uint64), return_counts=True)
        filters.append(exact_dedup.QuotientFilter.build(values, counts, 16, 8))
    if not any(parts):
        return
    merged = exact_dedup.QuotientFilter.merge(filters)
    assert dict(zip(merged.values().tolist(), merged.counts.tolist())) == Counter(v for p in parts for v in p)


def plain_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r.text or "").translate(LOWER)].append(r.doc_id)
    out = Counter()
    for body, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            out[(i, max(known) if known else None, len(ids), hashlib.sha256(body.encode()).hexdigest())] += 1
    return out, len(groups)


@pytest.mark.parametrize("bits", [64, 5])  # five bits: many different texts share a fingerprint
def test_exact_duplicates(spark, bits):
    docs = awkward_documents(spark).repartition(5)
    rows = exact_dedup.exact_duplicates(docs, fingerprint_bits=bits).collect()
    expected, groups = plain_groups(docs.collect())
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == expected
    kept = [r for r in rows if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_without_copies_keeps_whole_rows(spark):
    docs = awkward_documents(spark)
    out = exact_dedup.without_copies(docs)
    assert out.schema == docs.schema and out.count() == plain_groups(docs.collect())[1]


def grams(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_classes(rows):
    """Links of each row and its class, by comparing all pairs."""
    sets = [grams(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (ident, _) in enumerate(rows):
        k = find(i)
        if ident is not None:
            least[k] = min(least.get(k, ident), ident)
    return Counter((ident, least.get(find(i)), links[i]) for i, (ident, _) in enumerate(rows))


def near_copies(n=90, words=120):
    """Clusters of near copies at all similarities around the threshold, with exact copies among them."""
    rows = []
    for c in range(3):
        base = prose(c, words).split()
        for k in range(n // 3):
            text = list(base)
            for e in range(k % 6):
                text[(k * 7 + e * 17) % words] = f"edit{k // 2}"
            rows.append((c * 1000 + k, " ".join(text)))
    return rows


def test_join_finds_every_link(spark):
    rows = near_copies() + [(r.doc_id, r.text) for r in awkward_documents(spark).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = ngram_join.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in out) == plain_classes(rows)


def test_join_of_a_table_and_one_of_each_class(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = ngram_join.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in out) == plain_classes(rows)
    left = ngram_join.one_of_each_class(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({r.class_id for r in out})


def test_blocks_of_a_cluster_cover_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 8)
    rows = near_copies(60)
    out = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in out) == plain_classes(rows)


def test_overlaps_and_large_buckets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 30).astype(np.uint64)) for _ in range(50)]
    exact = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    own = ngram_join.overlaps(sets, None)
    np.fill_diagonal(own, np.diag(exact))
    assert (own == exact).all()
    assert (ngram_join.overlaps(sets[:20], sets[20:]) == exact[:20, 20:]).all()
    base = rng.integers(0, 256, (4, ngram_join.VALUES)).astype(np.uint8)
    sig = base[rng.integers(0, 4, 400)].copy()
    noise = rng.random(sig.shape) < 0.08
    sig[noise] = rng.integers(0, 256, int(noise.sum()))
    least = ngram_join.least_matches(0.8)
    i, j = np.triu_indices(400, 1)
    good = ngram_join.surviving(sig, i, j, least)
    assert (ngram_join.connect(sig, least) == ngram_join.roots(400, i[good], j[good])).all()


def test_pruning_keeps_what_the_posterior_allows():
    least = ngram_join.least_matches(0.8)
    rng = np.random.default_rng(2)
    hits = np.cumsum(rng.random((20000, 64)) < 0.8, axis=1)[:, 15::16]
    assert (hits >= np.array(least)).all(axis=1).mean() > 0.999
    assert all(b > a for a, b in zip(least, least[1:]))


def test_components_with_a_hub(spark):
    edges = [(f"n{i}", "hub") for i in range(300)] + [(f"c{i}", f"c{i + 1}") for i in range(40)] + [("x", "x")]
    found = components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()
    root = {r.node: r.root for r in found}
    assert len(root) == len(found) == 301 + 41
    assert {root[f"n{i}"] for i in range(300)} == {"hub"} and {root[f"c{i}"] for i in range(41)} == {"c0"}


def test_rows_without_grams_are_not_joined(spark, monkeypatch):
    joined = []

    def watched(rows, per_key, key, count):
        if "grams" in rows.columns:
            joined.append(rows.where("grams <= 0").count())
        return left_join_by_key(rows, per_key, key, count)

    monkeypatch.setattr(ngram_join, "left_join_by_key", watched)
    docs = spark.range(300).selectExpr("id as doc_id", "case id % 6 when 0 then '' when 3 then null else "
                                       "concat('some words of text number ', id % 50, ' and its end') end as text")
    rows = ngram_join.near_duplicates(docs).collect()
    assert joined and not any(joined) and len(rows) == 300
    empty = [r for r in rows if r.doc_id % 3 == 0]
    assert all(r.class_id == r.doc_id and r.kept and (r.n_links, r.n_text_links, r.copies) == (0, 0, 1) for r in empty)
    assert all(r.copies > 1 for r in rows if r.doc_id % 3)


def test_left_join_with_a_hot_key(spark):
    rows = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 0, id) as k")
    other = spark.range(0, 4000, 2).selectExpr("id as k", "id * 2 as v")
    other = other.join(rows.groupBy("k").count(), "k")
    found = left_join_by_key(rows, other, "k", "count").collect()
    assert len(found) == 4000
    assert all(r.v == (2 * r.k if r.k % 2 == 0 else None) for r in found)


def plain_shards(rows, limit):
    def key(i):
        return int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)

    out, open_ = [], [(0, 0, [(key(i), len((t or "").encode()) + 1, i) for i, t in rows])]
    while open_:
        depth, node, held = open_.pop()
        if sum(h[1] for h in held) <= limit or len(held) == 1 or depth == 60:
            out.append((depth, node, held))
            continue
        for bit in (0, 1):
            part = [h for h in held if h[0] >> (59 - depth) & 1 == bit]
            if part:
                open_.append((depth + 1, node * 2 + bit, part))
    return out


@pytest.mark.parametrize("limit", [2000, 50_000, 10**9])
def test_shards(spark, limit):
    docs = awkward_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    shards = sharding.assign_shards(docs, limit).collect()
    assert len(shards) == len(rows)
    held = defaultdict(list)
    for r in shards:
        held[r.shard].append(r)
    for group in held.values():
        assert sum(r.bytes for r in group) == group[0].shard_bytes and len(group) == group[0].shard_docs
        assert group[0].shard_bytes <= limit or len(group) == 1
    plain = {f"{d}:{n}": sorted((h[2] or -1) for h in g) for d, n, g in plain_shards(rows, limit) if d < 60}
    shallow = {k: sorted((r.doc_id or -1) for r in g) for k, g in held.items() if g[0].depth < 60}
    assert shallow == plain  # rows of one id may split further, on the row's own bits


def test_equal_ids_are_split_by_row(spark):
    docs = spark.createDataFrame([(7, "x" * 99) for _ in range(50)], "doc_id long, text string")
    shards = sharding.assign_shards(docs, 1000).collect()
    assert len(shards) == 50 and max(r.shard_bytes for r in shards) <= 1000 and min(r.depth for r in shards) > 60


def test_shards_are_written_whole(spark, scratch):
    docs = table(spark, SF_SMALL, "documents")
    shards = sharding.write_shards(docs, 100_000, scratch + "/shards")
    back = spark.read.parquet(scratch + "/shards")
    assert back.count() == docs.count() and back.select("shard").distinct().count() == shards.select("shard").distinct().count()


def test_repeated_and_null_ids_are_written_once_each(spark, scratch):
    docs = spark.createDataFrame([(5, "x" * 99), (5, "x" * 99), (5, "y" * 50), (5, "z"), (6, "one"), (None, "no id"), (None, None)],
                                 "doc_id long, text string").repartition(3)
    sharding.write_shards(docs, 120, scratch + "/shards")
    back = spark.read.parquet(scratch + "/shards").select("doc_id", "text").collect()
    assert sorted(map(tuple, back), key=str) == sorted(map(tuple, docs.collect()), key=str)


def test_a_cluster_of_several_blocks_is_counted_whole(spark, monkeypatch):
    """Blocks of a few rows: every pair of blocks meets, and no link is lost or counted twice."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 4)
    monkeypatch.setattr(ngram_join, "BUCKET_ROWS", 3)
    base = prose(99, 90).split()
    texts = []
    for i in range(30):
        words = list(base)
        words[i * 3] = f"other{i}"
        texts.append((i, " ".join(words)))
    texts += [(100 + i, texts[3][1]) for i in range(5)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.class_id, r.n_links, r.kept) for r in ngram_join.near_duplicates(docs).collect()}
    sets = {i: set(grams(t)) for i, t in texts}
    for i in found:
        links = sum(j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in sets)
        assert found[i][1] == links
    assert {c for c, _, _ in found.values()} == {0} and sum(k for *_, k in found.values()) == 1
