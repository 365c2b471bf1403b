"""What operators take of a worker's memory and time, told by plans and calls instead of clocks."""

import io
from contextlib import redirect_stdout

import numpy as np
import pyarrow as pa
import pytest

from gridtide.llm import line_dedup, lm, minhash, repair, toxicity


@pytest.fixture(scope="module")
def toxic_model():
    texts = [b"bad words here" if i % 3 == 0 else b"good words there" for i in range(60)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return toxicity.train(np.array([float(i % 3 == 0) for i in range(60)]), np.frombuffer(b"".join(texts), np.uint8), offsets, epochs=2)


def test_toxicity_scores_in_one_worker_a_task(llm, documents, toxic_model):
    docs = documents([(i, "bad words here" if i % 3 == 0 else "good words there") for i in range(40)])
    labels = llm.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")
    fitted = pa.array([0, 1, 2, 3], pa.int64())
    met = toxicity.reached(llm, docs, labels, llm.sparkContext.broadcast(toxic_model), fitted)
    told = io.StringIO()
    with redirect_stdout(told):
        met.explain()
    assert told.getvalue().count("MapInArrow") == 1
    free = docs.where(~toxicity.held_out()).where("doc_id > 3").count()
    assert sum(r["n"] for r in met.collect()) == free


def test_toxicity_scores_some_texts_at_a_time(toxic_model):
    """Memory of a worker follows the bytes scored at once, whatever a batch holds."""

    class Shared:
        value = toxic_model

    texts = [f"{'bad' if i % 3 == 0 else 'good'} words {i} " * 2000 for i in range(60)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(62)), "text": texts})
    got = list(toxicity._score(Shared)([batch]))
    sizes = [sum(len(t or "") for t in b.column("text").to_pylist()) for b in got]
    assert max(sizes) <= 1 << 19 < sum(sizes)
    whole = "".join(t or "" for t in texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t or "") for t in texts])])
    want = toxicity.scores(toxic_model, *toxicity.buckets_of(np.frombuffer(whole, np.uint8), offsets))
    assert [d for b in got for d in b.column("doc_id").to_pylist()] == list(range(62))
    assert np.allclose(np.concatenate([b.column("_score").to_numpy() for b in got]), want, atol=1e-12)

def test_parts_of_words_have_the_ids_of_whole_texts():
    """The encoder keeps parts of words; what stands around a part does not change its ids."""
    encoder = repair.WordEncoder()
    ends = ["Don't", "x's", "'s'S", "-'s", "a1b22", "é", "É.", "é.", ".é", "1́", "≠", "×a×", "a÷", "ª1", "ΣΣ.", "a—,b", "一二3.", "<|a|>", "a~~b", "x_y", "\x1ca\x1d", "a b.", " ", "İx", "\U0001f600!!"]
    texts = [*ends, *(a + b for a in ends for b in ends), *(f"{a} {b}" for a in ends for b in ends), "", " "]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    ids, lengths = encoder.encode(np.frombuffer(b"".join(data), np.uint8), offsets)
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert lengths.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_equal_words_with_other_signs_are_encoded_once():
    encoder = repair.WordEncoder()
    words = ["word", "word,", "(word)", "Word.", "word!!", "word12"]
    encoder.encode(np.frombuffer(" ".join(words).encode(), np.uint8), np.array([0, len(" ".join(words))]))
    assert len(encoder.keys) == len({"word", ",", "(", ")", ".", "!!", "1", "2"})


def test_subwords_of_many_words_at_once_are_those_of_each():
    subwords = lm.Subwords()
    words = ["don't", "'s", "x's", "a1", "12", "...", "é", "É", "ñandú!", "a ", " a", " ", "  ", "a b", "—", "　", "a\x1cb", "\x1d", "\u0085", " x", "日本", "<|endoftext|>", "x" * 300]
    words = words * 3 + [f"word{k}" for k in range(5000)] + words
    data = [w.encode() for w in words]
    ends = np.cumsum([len(d) for d in data])
    starts = ends - [len(d) for d in data]
    calls, one = [], subwords.enc.encode_to_numpy
    subwords.enc = type("Counted", (), {"encode_to_numpy": lambda self, *a, **k: calls.append(1) or one(*a, **k)})()
    flat, lengths = subwords._learn(np.frombuffer(b"".join(data), np.uint8), starts, ends)
    want = [lm.encoding().encode_ordinary(" " + d.lower().decode()) for d in data]
    assert lengths.tolist() == [len(x) for x in want]
    assert flat.tolist() == [i for x in want for i in x]
    assert len(calls) < 200  # one a word before


@pytest.mark.parametrize("scale", [1.0, 200.0], ids=["flat", "steep"])
def test_scores_of_classes_with_and_without_row_maxima(scale):
    draw = np.random.default_rng(3)
    w = {n: (draw.standard_normal(s) * (0.3 if len(s) > 1 else 0.1)).astype(np.float32) for n, s in lm._PARAMETERS.items() if n != "embed"}
    w["out"], w["query"] = w["out"] * np.float32(scale), w["query"] * np.float32(scale)
    net = lm.Network(np.zeros(lm.SUBWORDS, np.uint8), w)
    vectors = draw.standard_normal((50, lm.DIM)).astype(np.float32)
    classes, first = draw.integers(0, lm.CLASSES, 50), np.array([0, 0, 7, 100, 140])
    place = draw.integers(0, 50, 140)
    got = lm.class_scores(net, vectors, classes, place, first)
    x, full, begin, words, predictions = lm.inputs(w, vectors, place, first)
    state = lm.attention(w, x, full)[-1][predictions].astype(np.float64)
    z = state @ w["out"] + w["bias"]
    target = np.full(len(x), lm.END)
    target[words - 1] = classes[place]
    want = (z[np.arange(len(z)), target[predictions]] - z.max(axis=1) - np.log(np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1))) / np.log(10)
    assert np.isfinite(got).all()
    assert np.allclose(got, want, rtol=1e-4, atol=1e-4 * scale)


def test_means_of_subwords_of_words_of_any_length():
    draw = np.random.default_rng(4)
    embed = draw.standard_normal((lm.SUBWORDS, lm.DIM)).astype(np.float32)
    lengths = np.array([1, 2, 3, 7, 8, 9, 20, 1, 4])
    flat = draw.integers(0, lm.SUBWORDS, lengths.sum())
    got = lm.word_vectors(embed, flat, lengths)
    assert np.array_equal(got, np.add.reduceat(embed[flat], np.cumsum(lengths) - lengths, axis=0) / lengths[:, None].astype(np.float32))


@pytest.mark.parametrize("step", [line_dedup._lines(line_dedup.SIMILAR), minhash._sketches, minhash._full_sets], ids=["lines", "sketches", "sets"])
def test_lines_and_shingles_come_from_some_texts_at_a_time(step):
    """Memory of a worker follows the bytes looked at once; the rows are those of all texts at once."""
    texts = [f"Some line {k} of words.\n" * 1000 for k in range(70)] + [None, ""]
    ids = list(range(len(texts)))
    batch = pa.RecordBatch.from_pydict({"key": ids, "row": ids, "node": ids, "doc_id": ids, "text": pa.array(texts)})
    got = list(step([batch]))
    assert len(got) >= sum(len(t or "") for t in texts) / (1 << 19)
    one_by_one = [b for k in ids for b in step([batch.slice(k, 1)])]
    assert pa.Table.from_batches(got).to_pylist() == pa.Table.from_batches(one_by_one).to_pylist()
