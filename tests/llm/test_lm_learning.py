"""What the language model learns from: every training text, whole."""

import random
import zlib

import numpy as np

from gridtide.llm import lm


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(2)
    w = {n: draw.standard_normal(s) * 0.3 for n, s in lm._PARAMETERS.items() if n != "embed"}
    lengths = np.array([3, 40, 0])
    first = np.concatenate([[0], np.cumsum(lengths)])
    x, full, _, _, at = lm.inputs(w, draw.standard_normal((9, lm.DIM)), draw.integers(0, 9, first[-1]), first)
    x, target = x.astype(np.float64), draw.integers(0, lm.CLASSES, len(at))

    def loss():
        z = lm.attention(w, x, full)[-1][at] @ w["out"] + w["bias"]
        return (np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), target]).mean()

    g, dx = lm.gradients(w, x, full, at, target)
    for values, told in [(w[n], g[n]) for n in ("query", "key", "value", "mix", "nearness", "out", "bias")] + [(x, dx)]:
        for place in map(tuple, np.argwhere(full[:, None] & (x == x))[::97] if values is x else draw.integers(0, values.shape, (6, values.ndim))):
            kept = values[place]
            values[place] = kept + 1e-4
            up = loss()
            values[place] = kept - 1e-4
            down = loss()
            values[place] = kept
            assert abs((up - down) / 2e-4 - told[place]) < 1e-4


def test_pieces_predict_each_row_once_from_what_is_before_it(monkeypatch):
    """A text learned from in pieces gives the gradients it gives whole."""
    draw = np.random.default_rng(3)
    first, place = np.array([0, 70, 75, 75]), draw.integers(0, 20, 75)
    flat, lengths = draw.integers(0, 50, 31).astype(np.uint16), np.array([1, 2] * 10 + [1])
    lengths[-1] = 31 - lengths[:-1].sum()
    seen = {}

    def told(w, x, full, predicted, target):
        seen["rows"] = seen.get("rows", 0) + len(predicted)
        state = lm_attention(w, x, full)[-1][predicted]
        seen.setdefault("states", []).extend(zip(target.tolist(), state.round(4).tolist()))
        return {n: np.zeros_like(a) for n, a in w.items() if n not in ("embed", "start")}, np.zeros_like(x)

    lm_attention = lm.attention
    monkeypatch.setattr(lm, "gradients", told)
    found = []
    for piece in (lm.PIECE, 2 * lm.STRIDE):
        monkeypatch.setattr(lm, "PIECE", piece)
        seen.clear()
        w = {n: np.random.default_rng(1).standard_normal(s).astype(np.float32) for n, s in lm._PARAMETERS.items()}
        lm.Learner(lm.Network(np.arange(lm.SUBWORDS) % 100, w)).learn(first, place, flat, lengths, np.ones(3, bool), 1)
        assert seen["rows"] == 78
        found.append(np.array([[t, *s] for t, s in sorted(seen["states"])]))
    assert np.allclose(*found, atol=1e-3)


def test_long_texts_are_learned_from(llm, documents):
    """All texts are longer than 20,000 characters; which word comes next is plain from the last."""
    draw = random.Random(5)
    names = [a + b for a in ("red", "blue", "green", "white") for b in ("fox", "owl", "cat", "dog", "bee")]

    def text():
        at = draw.randrange(20)
        return " ".join(names[(at := (at + (1 if draw.random() < 0.9 else 7)) % 20)] for _ in range(4000))

    rows = [(i, text()) for i in range(40)]
    assert min(len(t) for _, t in rows) > 20_000
    got = lm.op8(llm, documents(rows)).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 10 == 0} != set()
    assert sum(r["score"] - r["base_score"] for r in held) > 0.05 * sum(r["n_tokens"] for r in held)


def test_every_training_text_is_learned_from(llm, documents, monkeypatch):
    """Rounds and tasks together learn from each row once; many short texts, twice if they are few."""
    rows = documents([(i, f"word{i % 7} " * (i % 5 + 1)) for i in range(300)])
    spread = rows.repartition(6)
    monkeypatch.setattr(lm, "LANE_WORDS", 120)
    runs = lm.stored(llm, spread.select("doc_id", lm.held_out().alias("held"), "text").mapInArrow(lm._runs(), lm.RUN), "runs")
    net = lm.fit(llm, runs, 10)
    shared = llm.sparkContext.broadcast(net)
    parts = runs.mapInArrow(lm._learnt(shared), lm.LEARNT).where("part = -1").collect()
    training = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10]
    assert sum(np.frombuffer(p["weights"])[0] for p in parts) == sum(i % 5 + 2 for i in training)
    assert len(parts) > 1 and np.isfinite(net.w["embed"]).all()


def test_all_passes_at_any_size(llm, documents, monkeypatch):
    """A corpus of many texts is gone over as often as one of few."""
    calls, learnt = [], lm._learnt
    monkeypatch.setattr(lm, "_learnt", lambda shared: calls.append(1) or learnt(shared))
    found = {}
    for n in (300, 6000):
        calls.clear()
        assert lm.scored(llm, documents([(i, f"word{i % 7} here") for i in range(n)])).count() == n
        found[n] = len(calls)
    assert found == {300: 3, 6000: 3}  # one round a pass
