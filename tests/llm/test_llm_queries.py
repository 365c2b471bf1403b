"""Registered queries against their SQL, and the edge cases every operator must bear."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from gridtide.llm import (  # noqa: E402
    bpe,
    exact_dedup,
    line_dedup,
    lm,
    merkle,
    minhash,
    mixing,
    quality_rules,
    queries,
    repair,
    toxicity,
    url_filter,
    vptree,
)
from oracle import connect, differences  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = contract.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", queries.SQL)
def test_query_equals_sql(llm, name):
    assert differences(queries.QUERIES[name](llm, SF_DIR), connect(SF_DIR), queries.SQL[name]) == []


@pytest.mark.parametrize(
    "run",
    [quality_rules.op1, line_dedup.op2, minhash.op3, bpe.op7, lm.op8, mixing.op9, repair.op10, merkle.op11, exact_dedup.op12],
    ids=lambda f: f.__module__.rsplit(".", 1)[-1],
)
def test_odd_documents(llm, odd, run):
    docs, n = odd
    out = run(llm, docs).collect()
    assert len(out) == n
    by_id = {r["doc_id"]: r for r in out}
    assert by_id.keys() == ({1, 2, 3, 4, 5, None, 7, 8, 9} if n else set())


def test_odd_documents_toxicity(llm, odd):
    docs, n = odd
    labels = llm.createDataFrame([(4, 0, 1), (None, 0, 1), (9, 1, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.op6(llm, docs, labels).count() == n
    none = toxicity.op6(llm, docs, labels.limit(0))
    assert {r["score"] for r in none.collect()} == ({0.0} if n else set())
    assert toxicity.cleaned(llm, docs, labels.limit(0)).columns == docs.columns


def test_odd_stages_keep_columns(llm, odd):
    docs, n = odd
    for stage in (line_dedup.deduplicated, minhash.deduplicated, mixing.mixed):
        out = stage(llm, docs)
        assert out.columns == docs.columns
        out.collect()


OWN_NAMES = ("_key", "_row", "_copy", "_rate", "_goal_source", "_score", "_threshold", "_gone", "_kept_text", "_at", "given0")


def test_columns_named_as_the_stages_own(llm, documents):
    """They come back as they were, whatever a stage calls its own."""
    rows = [(i, f"Text number {i} is a good and clean one.\nIts second line has {i} words.", "en", "ab"[i % 2]) for i in range(12)]
    docs = documents(rows).selectExpr("*", *[f"'{n} of ' || doc_id AS {n}" for n in OWN_NAMES])
    labels = llm.createDataFrame([(i, 1, i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    stages = [line_dedup.deduplicated, minhash.deduplicated, mixing.mixed, lambda s, d: toxicity.cleaned(s, d, labels)]
    for stage in stages:
        out = stage(llm, docs)
        assert out.columns == docs.columns
        left = out.collect()
        assert all(r[n] == f"{n} of {r['doc_id']}" for r in left for n in OWN_NAMES)
    assert len(minhash.deduplicated(llm, docs).collect()) >= 1


def test_odd_pages(llm):
    pages = llm.createDataFrame(
        [(1, None, None), (2, "no scheme", "x"), (3, "HTTP://A.NET", None), (4, "http://a.net/", "<link rel=canonical href='/b'>"), (None, "", "")],
        "page_id long, url string, html string",
    ).selectExpr("*", "'x' AS host", "'y' AS path", "1 AS node")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.op5(llm, pages).collect()}
    assert got[1] == got[2] == got[None] == ("", "", None, "allow")
    assert got[3] == ("a.net", "", None, "block")  # the same node as page 4, which a rule blocks
    assert got[4] == ("a.net", "/", "net/", "block")
    assert url_filter.op5(llm, pages.limit(0)).count() == 0


def test_odd_vectors(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, [nan, 1.0]), (150, None), (200, []), (3, [2.0, 0.0]), (2, [2.0, 0.0]),
            (4, [inf, 1.0]), (5, [1.0, None]), (6, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (7, [-1.0, 0.0]), (7, [-1.0, 0.0]), (0, [1.0, 0.0])]
    table = llm.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS shard", "2 AS score")
    got = [tuple(r) for r in vptree.op4(llm, table).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 7, -1.0), (0, 4, 7, -1.0)]
    assert vptree.op4(llm, table.limit(0)).count() == 0
