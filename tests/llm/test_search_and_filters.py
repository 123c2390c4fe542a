"""Top-k search and URL filters against plain computations."""

import math

import duckdb
import numpy as np
import pytest
from cases import awkward_pages, awkward_vectors
from pyspark.sql import functions as F

from envtrack.llm import topk, url_filter


def plain_top(rows, k, scale=256):
    sound = []
    for n, (ident, vec) in enumerate(rows):
        if vec is not None and all(x is not None and math.isfinite(x) for x in vec):
            sound.append((n, ident, [math.floor(scale * float(np.float32(x))) for x in vec]))
    out = []
    for n, ident, q in sound:
        if ident is None or ident % 50:
            continue
        best = sorted((-sum(a * b for a, b in zip(q, v)), i is None, i if i is not None else 0)
                      for m, i, v in sound if m != n)[:k]
        out += [(ident, r, None if none else i, -s) for r, (s, none, i) in enumerate(best, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [1, 5, 200])
def test_top_k_with_ties_and_unsound_vectors(spark, k):
    vectors = awkward_vectors(spark).repartition(3)
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    found = topk.top_k(vectors, F.col("id") % 50 == 0, k=k).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_top(rows, k)


def test_top_k_in_several_blocks_and_with_large_numbers(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rows = [(i * 10, [float((i * 7919 + j * 104729) % 2001 - 1000) * 3e3 for j in range(5)]) for i in range(80)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = topk.top_k(vectors, F.col("id") % 50 == 0).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_top(rows, 5)


def test_score_types_agree():
    rng = np.random.default_rng(0)
    x, q = rng.integers(-50, 50, (40, 9)), rng.integers(-50, 50, (6, 9))
    for largest in (50, 2**40, 2**62):
        lists = topk.Lists(q, largest)
        assert (sum(lists.scores(x)).astype(np.int64) == x @ q.T).all()


def test_verdicts(spark):
    rows = {r.page_id: r for r in url_filter.judge_pages(awkward_pages(spark), url_filter.RULES).collect()}
    verdict = {i: (r.rule, r.verdict) for i, r in rows.items()}
    assert verdict[1] == ("net/", "block")
    assert verdict[2] == (None, "block") and verdict[3] == (None, "block")  # aliases, directly and by a chain
    assert verdict[4] == ("example.net/en/", "allow") and verdict[5] == ("org/fr/", "allow")  # explicit allow
    assert verdict[6] == verdict[7] == (None, "allow")
    assert verdict[8] == verdict[9] == verdict[10] == (None, "allow") and rows[8].host == rows[8].path == ""
    assert verdict[11] == (None, "allow") and verdict[12] == ("net/", "block") and verdict[13] == (None, "allow")
    assert verdict[14] == ("example.com/de/", "block") and rows[14].host == "example.com"
    assert verdict[15] == verdict[16] == (None, "block") and verdict[17] == (None, "allow")
    assert verdict[18] == verdict[19] == (None, "block") and verdict[20] == (None, "allow")
    assert verdict[None] == ("net/", "block") or verdict[None][0] == "example.net/en/"


def test_sql_agrees_on_links(spark):
    pages = awkward_pages(spark).where("page_id is not null").dropDuplicates(["page_id"])
    frame = pages.select("page_id", "url", "html").toPandas()
    con = duckdb.connect()
    con.register("frame", frame)
    con.execute("CREATE VIEW pages AS SELECT * FROM frame")
    expected = sorted(con.sql(url_filter.ORACLE).fetchall(), key=str)
    found = url_filter.judge_pages(pages, url_filter.RULES).select("page_id", "host", "path", "rule", "verdict")
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected


def test_no_python_on_the_main_path(spark):
    plan = url_filter.judge_pages(awkward_pages(spark), url_filter.RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def linked(target):
    return f'<link rel="canonical" href="{target}">'


def against_sql(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    found = url_filter.judge_pages(pages, url_filter.RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted((tuple(r) for r in found), key=str) == sorted(con.sql(url_filter.ORACLE).fetchall(), key=str)
    return {r.page_id: (r.rule, r.verdict) for r in found}


def test_a_path_that_was_made_up_blocks_nothing(spark):
    """An empty path is not ``/``: neither the page nor what it links to is blocked by a rule on ``/``."""
    verdict = against_sql(spark, [(1, "http://a.net", None), (2, "http://b.net", linked("http://ok.org/x")),
                                  (3, "http://ok.org/x", None), (4, "http://c.org/y", linked("http://d.net/")),
                                  (5, "http://e.org/z", linked("http://f.net")), (6, "http://d.net", linked("/"))])
    assert verdict[1] == verdict[2] == verdict[3] == verdict[5] == (None, "allow")
    assert verdict[4] == verdict[6] == (None, "block")  # d.net/ as it is written


def test_links_with_a_url_on_a_third_of_the_pages(spark):
    """Chains, circles and one very common URL that no rule blocks."""
    rows = [(i, "http://common.org/start", linked("/start") if i % 2 else None) for i in range(300)]
    for i in range(300, 600):
        host = ["x.org", "y.org", "z.net", "example.com"][i % 4]
        target = f"http://{['x.org', 'y.org', 'z.net', 'example.com'][(i + 1) % 4]}/{'de/' if i % 5 else ''}{i + 1}"
        rows.append((i, f"http://{host}/{'de/' if (i - 1) % 5 else ''}{i}", linked(target) if i % 7 else None))
    verdict = against_sql(spark, rows)
    assert all(verdict[i] == (None, "allow") for i in range(300))
    assert {v for i, (_, v) in verdict.items() if i >= 300} == {"allow", "block"}
    assert any(rule is None and v == "block" for rule, v in verdict.values())
