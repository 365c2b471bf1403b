"""The manifest against a plain tree, in which every level is a list."""

import hashlib
import random
import zlib

import pytest

from gridtide.llm import merkle

LOWERED = str.maketrans(merkle.UPPER, merkle.LOWER_CASE)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, fan):
    """The top, and for each node what is left and right of it, level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(places):
            run = at // fan * fan
            paths[k].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + fan])))
        nodes = [h(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)]
        places = [at // fan for at in places]
    return nodes[0], paths


def plain(rows, fan):
    by_source, out = {}, []
    for row in rows:
        own = leaf(row, row[1])
        hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None
        by_source.setdefault(row[3], []).append((row[0], own, leaf(row, row[1].translate(LOWERED)) if hit else own))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(tree([r[1] for r in by_source[s]], fan))
    root, tops = tree([t[0] for t in trees], fan)
    for s, (subroot, paths), top in zip(sources, trees, tops):
        for (doc_id, own, used), path in zip(by_source[s], paths):
            for left, right in (whole := path + top):
                used = h(left, used, right)
            out.append((doc_id, own, subroot, root, h(*[x + y for x, y in whole]), used, used == root))
    return sorted(out, key=repr)


def corpus(n, sources, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        source = None if draw.random() < 0.1 else f"Src{int(sources * draw.random() ** 2)}é"
        text = None if i % 17 == 0 else " ".join(draw.choice(["Ab", "cd", "Éf", "x|1:"]) for _ in range(draw.randrange(6)))
        rows.append((i if i % 23 else None, text, draw.choice(["en", None]), source, len(text or "") or None))
    return rows + rows[:5] + [rows[7]] * 30 + [(8, "other text of the same id", "en", rows[8][3], 3)]


FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
OUT = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("fan, digits, n, sources", [(16, 3, 500, 3), (2, 2, 150, 40), (3, 1, 90, 1), (16, 3, 1, 1)])
def test_manifest(llm, monkeypatch, fan, digits, n, sources):
    """Several tables of blocks in both forests, runs that are not full, and lone leaves."""
    for name, value in (("FAN", fan), ("DIGITS", digits), ("BLOCK", fan**digits)):
        monkeypatch.setattr(merkle, name, value)
    rows = corpus(max(n, 9), sources)[: n if n == 1 else None]
    docs = llm.createDataFrame(rows, FIELDS).selectExpr("*", "'x' AS leaf", "'y' AS tree", "1 AS pos", "2 AS salt", "3 AS path").repartition(5)
    got = sorted((tuple(r[c] for c in OUT) for r in merkle.op11(llm, docs).collect()), key=repr)
    want = plain(rows, fan)
    assert got == want
    assert {r[6] for r in want} == ({True, False} if n > 1 else {want[0][6]})


def test_proofs_need_no_join(llm, documents):
    """The only joins are of the ranks, which come from written tables."""
    plan = merkle.op11(llm, documents([(i, str(i)) for i in range(40)]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" in plan
