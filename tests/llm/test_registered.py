"""Every registered query on awkward and on empty tables; the pipeline; SQL where there is some."""

import os
from collections import Counter

import duckdb
import pytest
from cases import write_tables
from conftest import SF_SMALL

import corpus_pipeline
from envtrack.llm import queries
from envtrack.llm.common import table

from test_dedup import grams, plain_classes, plain_groups

ONE_FOR_EACH = {"op1_exact_dedup": "documents", "op4_sharding": "documents", "op5_url_filter": "pages",
                "op6_ngram_join": "documents", "op7_quality": "documents", "op8_bpe_encoding": "documents",
                "op9_lm_scoring": "documents"}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    full, empty = (str(tmp_path_factory.mktemp(n)) for n in ("full", "empty"))
    write_tables(spark, full)
    write_tables(spark, empty, empty=True)
    return full, empty


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_awkward_rows(spark, folders, name):
    out = queries.QUERIES[name](spark, folders[0])
    rows = out.collect()
    if name in ONE_FOR_EACH:
        ids = "page_id" if name == "op5_url_filter" else "doc_id"
        source = table(spark, folders[0], ONE_FOR_EACH[name])
        assert Counter(r[ids] for r in rows) == Counter(r[0] for r in source.select(ids).collect())
    elif name == "op12_divergence_audit":
        assert rows == []  # one language with one source: nothing to compare, no term above the language's share
    else:
        assert rows


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, folders, name):
    out = queries.QUERIES[name](spark, folders[1])
    assert out.count() == 0
    assert out.dtypes == queries.QUERIES[name](spark, folders[0]).dtypes


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    out = queries.QUERIES[name](spark, SF_SMALL)
    expected = con.sql(queries.ORACLE[name])
    assert sorted(out.columns) == sorted(expected.columns)
    columns = ", ".join(sorted(out.columns))
    found = Counter(tuple(r) for r in out.select(*sorted(out.columns)).collect())
    assert found == Counter(con.sql(f"SELECT {columns} FROM expected").fetchall())


def test_pipeline(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], SF_SMALL).cache())
        if name != "packing":
            assert seen[-1].columns == columns
    source, good, distinct, different, packed = ([tuple(r) for r in s.collect()] for s in seen)
    assert set(good) <= set(source) and len(good) > 0.7 * len(source)
    groups, number = plain_groups(seen[1].collect())
    assert len(distinct) == number and {r[0] for r in distinct} == {k[1] for k in groups}
    classes = plain_classes([(r[0], r[1]) for r in distinct])
    assert sorted(r[0] for r in different) == sorted({k[1] for k in classes})
    assert all(grams(r[1]) is not None for r in different)
    assert {r[0] for r in packed} == {r[0] for r in different}
    again = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter((r.doc_id, r.doc_tokens) for r in again if r.start == 0) == Counter(
        (r[0], r[4]) for r in packed if r[1] == 0)


def test_pipeline_on_awkward_and_empty_tables(spark, folders):
    assert corpus_pipeline.run(spark, folders[0]).count() > 0
    assert corpus_pipeline.run(spark, folders[1]).count() == 0
