"""Exact dedup against a dictionary of texts, and its filters against sets."""

import hashlib
import random
import re

import numpy as np
import pytest

from gridtide.llm import exact_dedup


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 70_000])
def test_filters_miss_no_key(n):
    draw = np.random.default_rng(n)
    keys = draw.integers(0, 1 << 64, n, dtype=np.uint64)
    held = exact_dedup.Fuse.of(np.concatenate([keys, keys[:5]]))
    assert held.may_hold(keys).all()
    assert held.may_hold(draw.integers(0, 1 << 64, 100_000, dtype=np.uint64)).sum() < 20
    assert len(held.prints) <= max(64, 2 * n)


def copies(seed=2):
    draw = random.Random(seed)
    base = [" ".join(draw.choice(["ab", "c", "dé", " "]) for _ in range(draw.randrange(1, 6))) for _ in range(120)]
    texts = []
    for _ in range(600):
        text = draw.choice(base)
        texts.append(draw.choice([text, text.replace(" ", "\t\n"), text.replace(" ", ""), f" {text}\x0b\r\x0c"]))
    rows = list(enumerate(texts)) + [(1000, None), (1001, ""), (1002, " \n"), (None, "ab c"), (None, "abc"), (5, texts[5]), (5, texts[5]), (7, "another text of an id")]
    return rows + [(2000 + i, "one very common text") for i in range(300)]


def plain(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for body, members in groups.items():
        members.sort()
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), k == 0, sha) for k, m in enumerate(members)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"batches": 1}, {"batches": 5, "bits": 2, "shard_keys": 4}, {"batches": 2, "bits": 8, "shard_keys": 1000}])
def test_exact_dedup(llm, documents, options):
    """Also with keys of so few bits that most of what the filters let pass differs in its bytes."""
    rows = copies()
    got = exact_dedup.op12(llm, documents(rows).selectExpr("*", "1 AS row", "2 AS batch", "3 AS sha", "4 AS body"), **options)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_rows_that_stay(llm, documents):
    rows = copies()
    docs = documents(rows).selectExpr("*", "doc_id AS row", "text AS body")
    got = exact_dedup.deduplicated(llm, docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=repr) == sorted((r[0] for r in plain(rows) if r[3]), key=repr)
    assert exact_dedup.deduplicated(llm, docs.limit(0)).count() == 0


def test_only_what_passes_a_filter_is_compared(llm, documents):
    seen = []

    class Watched(exact_dedup.ExactDedup):
        def byte_equal(self, pairs):
            seen.append(pairs.count())
            return super().byte_equal(pairs)

    rows = [(i, f"text {i} of its own") for i in range(400)] + [(1000 + i, f"text {i}\tof its own") for i in range(10)]
    found = Watched(llm, documents(rows), batches=2)
    assert found.result().where("group_size = 2").count() == 20
    assert sum(seen) == found.links[0].count() <= 10
