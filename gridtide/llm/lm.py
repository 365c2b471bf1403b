"""Language-model scoring: causal self-attention over subword ids, with corpus counts.

A word is a run of subword ids; the first of them gives its class (the most frequent
first ids one class each, then one for all others, and one for the end of a text).
A network of one causal self-attention layer, trained in numpy, predicts the class of
the next word from the subword embeddings of the words before it, and the counts of
the whole training corpus give the word within its class:

    log10 P(text) = sum of log10 P(class | words before) + log10 (c + 0.1) / (C + 0.1 (V + 1))

with the word's count c, its class's count C and distinct words V. Words never seen
share one slot per class, as they share one in the unigram base score.

Texts are scored in blocks of STRIDE words; a block attends to itself and to the block
before it, so windows of 2 * STRIDE words overlap by half, and each word is scored once.

Classes, weights and counts are learned from all training texts: runs of texts keep their
distinct words as sorted hashes with their subword ids, and what learns reads the runs. Classes
and the start of the biases come from counts of first ids. Weights are learned in rounds: in a
round each task learns by Adam over batches of texts from its share of the runs, and
the mean of what the tasks learned is where the next round starts (weighted by their words;
a subword's embedding by its occurrences, so what only some tasks saw is not diluted). Tasks grow with the
corpus, a task's share of a round does not. Every text is learned from PASSES times, whatever the size of the
corpus; long ones in pieces that begin with the block of words before them.

For the counts the hashes are dealt by range, summed, and the sums go back to the runs. What is
shuffled is packed arrays, one row per run and range; a frequent word is one
entry per run, whatever its count.

Defined cases: NULL and empty texts have the end as their only token; a NULL id is
training; rows that repeat an id are scored, and counted, one by one; without
training texts all counts are 0 and the network is untrained. Equal words are told by
64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import RANKS, encoding
from .repair import ragged
from .shared import LOWER, Words, distinct, stored, text_runs

DIM, STRIDE, CLASSES = 16, 16, 128
OTHER, END = CLASSES - 2, CLASSES - 1
SUBWORDS = 50257
PASSES = 3  # over all training texts
ROUNDS, LANE_WORDS = 4, 1_000_000  # of one pass over the corpus; words a task learns from in a round
PIECE = 256 * STRIDE  # rows of a text learned from at once
TEXTS, RATE = 24, 0.01
SLICE = 1024  # subwords whose embeddings are merged together
MANY = 8  # subwords of a word up to which their embeddings are summed for all words at once
STEEP = 60.0  # what exp takes, either way, without leaving the range of 32-bit floats
RUN_BYTES = 2 << 20
RANGE_WORDS = 2_000_000
CACHE_WORDS = 1_000_000
SMOOTH = 0.1  # fixed value of the base score

_PARAMETERS = {
    "embed": (SUBWORDS, DIM), "start": (DIM,), "query": (DIM, DIM), "key": (DIM, DIM), "value": (DIM, DIM),
    "mix": (DIM, DIM), "nearness": (2 * STRIDE,), "out": (DIM, CLASSES), "bias": (CLASSES,),
}


@dataclass
class Network:
    class_of: np.ndarray  # first subword id -> class
    w: dict[str, np.ndarray]


def odd_blanks(data: np.ndarray) -> np.ndarray:
    """Bytes that may begin a blank beyond ASCII (with more characters than are blank), or are separators of ASCII."""
    odd = (data >= 0x1C) & (data < 0x20)
    lead = np.flatnonzero(data[:-1] >= 0xC2)
    a, b = data[lead], data[lead + 1]
    odd[lead] = ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A)) | ((a == 0xE2) & (b <= 0x81)) | ((a == 0xE3) & (b == 0x80))
    return odd


class Subwords:
    """Subword ids of distinct words, each word encoded once per process; packed, so that
    a million words take some tens of megabytes."""

    def __init__(self, ranks: str = RANKS):
        self.enc = encoding(ranks)
        self.opens = np.zeros(self.enc.n_vocab, dtype=bool)  # subwords that begin with a blank
        self.opens[[k for k in range(self.enc.n_vocab) if self.enc.decode_single_token_bytes(k).startswith(b" ")]] = True
        self._forget()

    def _forget(self):
        self.keys, self.slot = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.starts, self.flat = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint16)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words, each with a blank before it, and how many each has. The encoding splits at that blank whatever
        stands around, so words are encoded many at once; only a word with a blank of another kind is encoded alone."""
        size = ends - starts
        first = np.cumsum(size + 1) - size - 1
        joined = np.full(int((size + 1).sum()), 32, dtype=np.uint8)
        joined[ragged(first + 1, size)] = LOWER[data[ragged(starts, size)]]
        alone = np.logical_or.reduceat(odd_blanks(joined), first)
        raw, ids, lengths = joined.tobytes(), [], np.zeros(len(size), dtype=np.int64)
        edges = np.unique(np.concatenate([np.flatnonzero(np.diff(alone)) + 1, np.arange(0, len(size), 2000), [len(size)]])).tolist()
        for lo, hi in zip(edges[:-1], edges[1:]):
            step = 1 if alone[lo] else hi - lo
            for k in range(lo, hi, step):
                got = self.enc.encode_to_numpy(raw[first[k] : first[k + step - 1] + size[k + step - 1] + 1].decode(), disallowed_special=())
                ids.append(got.astype(np.uint16))
                lengths[k : k + step] = len(got) if alone[lo] else np.diff(np.flatnonzero(self.opens[got]), append=len(got))
        return np.concatenate(ids), lengths

    def of(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words with ascending hashes, and how many each has."""
        if len(self.keys) > CACHE_WORDS:
            self._forget()
        at = np.minimum(np.searchsorted(self.keys, hashes), max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[at] != hashes) if len(self.keys) else np.arange(len(hashes))
        if len(new):
            flat, lengths = self._learn(data, starts[new], ends[new])
            where = np.searchsorted(self.keys, hashes[new])
            self.slot = np.insert(self.slot, where, len(self.keys) + np.arange(len(new)))
            self.keys = np.insert(self.keys, where, hashes[new])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
            self.flat = np.concatenate([self.flat, flat])
        slot = self.slot[np.searchsorted(self.keys, hashes)]
        lengths = self.starts[slot + 1] - self.starts[slot]
        return self.flat[ragged(self.starts[slot], lengths)], lengths


_subwords: list[Subwords] = []


def distinct_words(data: np.ndarray, offsets: np.ndarray):
    """Sorted hashes of the distinct words, the place of each word among them, first word
    of each text, and the subword ids of the distinct words."""
    if not _subwords:
        _subwords.append(Subwords())
    found = Words(data, offsets)
    hashes, example, place = distinct(found.hashes)
    flat, lengths = _subwords[0].of(hashes, data, found.starts[example], found.ends[example])
    return hashes, place, found.first, flat, lengths


def word_vectors(embed: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Mean subword embedding of each distinct word."""
    if not len(lengths):
        return np.zeros((0, DIM), dtype=np.float32)
    starts = np.cumsum(lengths) - lengths
    out = embed[flat[starts]]
    more = left = np.flatnonzero(lengths > 1)
    if len(more):
        rest = embed[flat[starts[more] + 1]]
        for k in range(2, min(int(lengths.max()), MANY)):  # all third subwords, all fourth ones, ...
            here = lengths[left] > k
            left = left[here]
            rest[np.flatnonzero(lengths[more] > k)] += embed[flat[starts[left] + k]]
        out[more] += rest
        many = np.flatnonzero(lengths > MANY)
        if len(many):
            size = lengths[many]
            out[many] = np.add.reduceat(embed[flat[ragged(starts[many], size)]], np.cumsum(size) - size, axis=0)
    return out / lengths[:, None].astype(np.float32)


def laid_out(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Rows of the inputs of each text in blocks: one empty block, then a start and the
    words, filled up to whole blocks. Returns the row of each start, of each word,
    of each prediction (words, then the end), and the number of rows."""
    n = np.diff(first)
    blocks = 1 + -(-(n + 1) // STRIDE)
    begin = (np.cumsum(blocks) - blocks) * STRIDE + STRIDE
    words = ragged(begin + 1, n)
    return begin, words, ragged(begin, n + 1), int(blocks.sum()) * STRIDE


_distance = np.arange(STRIDE)[:, None] + STRIDE - np.arange(2 * STRIDE)[None, :]
_future = _distance < 0


def attention(w: dict[str, np.ndarray], x: np.ndarray, full: np.ndarray):
    """States of all rows. x: rows x DIM; full: rows that hold a start or a word."""
    q, k, v = np.split(x @ np.concatenate([w["query"], w["key"], w["value"]], axis=1), 3, axis=1)
    blocks = lambda a: a.reshape(-1, STRIDE, *a.shape[1:])
    both = lambda a: np.concatenate([np.concatenate([np.zeros_like(a[:1]), a[:-1]]), a], axis=1)
    q, k, v = blocks(q), both(blocks(k)), both(blocks(v))
    s = np.matmul(q, k.transpose(0, 2, 1))
    s *= np.float32(DIM**-0.5)
    s += np.where(_future, np.float32(-1e9), w["nearness"][np.maximum(_distance, 0)]).astype(np.float32)
    # Rows past the end of a text are in the future of all that is predicted; the block before a start is empty.
    s[np.concatenate([[True], ~full[::STRIDE][:-1]]), :, :STRIDE] = -1e9
    s -= s.max(axis=2, keepdims=True)
    np.exp(s, out=s)
    s *= (1 / (s @ np.ones(2 * STRIDE, s.dtype)))[:, :, None]
    heard = np.matmul(s, v)
    return q, k, v, s, heard, x + heard.reshape(-1, DIM) @ w["mix"]


def inputs(w, vectors: np.ndarray, place: np.ndarray, first: np.ndarray):
    begin, words, predictions, rows = laid_out(first)
    x = np.zeros((rows, DIM), dtype=np.float32)
    full = np.zeros(rows, dtype=bool)
    x[begin], x[words] = w["start"], vectors[place]
    full[begin] = full[words] = True
    return x, full, begin, words, predictions


BLOCKS_AT_ONCE = 512  # their windows fit a core's cache


def states(w: dict[str, np.ndarray], x: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """``attention`` without what training needs. Rows past the end of a text are in the
    future of all that is predicted, so of the empty rows only those before a start are masked."""
    qkv = (x @ np.concatenate([w["query"] * np.float32(DIM**-0.5), w["key"], w["value"]], axis=1)).reshape(-1, STRIDE, 3 * DIM)
    near = np.where(_future, np.float32(-1e9), w["nearness"][np.maximum(_distance, 0)]).astype(np.float32)
    most, ones = float(np.abs(w["nearness"]).max()), np.ones(2 * STRIDE, np.float32)
    starts = begin // STRIDE
    out = np.empty_like(x)
    for lo in range(1, len(qkv), BLOCKS_AT_ONCE):
        hi = min(lo + BLOCKS_AT_ONCE, len(qkv))
        both = np.concatenate([qkv[lo - 1 : hi - 1, :, DIM:], qkv[lo:hi, :, DIM:]], axis=1)
        s = np.matmul(qkv[lo:hi, :, :DIM], both[:, :, :DIM].transpose(0, 2, 1))
        flat = max(float(s.max()), -float(s.min())) + most <= STEEP
        s += near
        s[starts[np.searchsorted(starts, lo) : np.searchsorted(starts, hi)] - lo, :, :STRIDE] = -1e9
        if not flat:
            s -= s.max(axis=2, keepdims=True)
        np.exp(s, out=s)
        heard = np.matmul(s, both[:, :, DIM:])
        heard /= (s.reshape(-1, 2 * STRIDE) @ ones).reshape(-1, STRIDE, 1)
        rows = slice(lo * STRIDE, hi * STRIDE)
        out[rows] = x[rows] + heard.reshape(-1, DIM) @ w["mix"]
    return out


def class_scores(net: Network, vectors: np.ndarray, classes: np.ndarray, place: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log10 P(class) of each prediction: of each text its words, then its end."""
    x, _, begin, words, predictions = inputs(net.w, vectors, place, first)
    target = np.full(len(x), END)
    target[words - 1] = classes[place]
    state, target = states(net.w, x, begin)[predictions], target[predictions]
    out, ones = np.empty(len(predictions)), np.ones(CLASSES, np.float32)
    for lo in range(0, len(predictions), 2048):
        z = state[lo : lo + 2048] @ net.w["out"]
        z += net.w["bias"]
        if max(float(z.max()), -float(z.min())) > STEEP:
            z -= z.max(axis=1, keepdims=True)
        own = z[np.arange(len(z)), target[lo : lo + 2048]]
        np.exp(z, out=z)
        out[lo : lo + 2048] = own - np.log(z @ ones)
    return out / np.log(10)


def gradients(w: dict[str, np.ndarray], x: np.ndarray, full: np.ndarray, predicted: np.ndarray, target: np.ndarray):
    """Of the mean cross-entropy of the classes after the predicted rows: by weight, and by row of ``x``."""
    q, k, v, s, heard, state = attention(w, x, full)
    g = {"out": np.zeros_like(w["out"]), "bias": np.zeros_like(w["bias"])}
    dstate = np.zeros_like(x)
    for lo in range(0, len(predicted), 2048):
        rows = predicted[lo : lo + 2048]
        own, ones = state[rows], np.ones(len(rows), x.dtype)
        p = own @ w["out"]
        p += w["bias"]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p *= (1 / (len(predicted) * (p @ np.ones(CLASSES, x.dtype))))[:, None]
        p[np.arange(len(p)), target[lo : lo + 2048]] -= x.dtype.type(1 / len(predicted))
        g["out"] += own.T @ p
        g["bias"] += ones @ p
        dstate[rows] = p @ w["out"].T
    g["mix"] = heard.reshape(-1, DIM).T @ dstate
    dheard = (dstate @ w["mix"].T).reshape(heard.shape)
    ds = np.matmul(dheard, v.transpose(0, 2, 1))
    ds -= np.einsum("bij,bij->bi", ds, s)[:, :, None]
    ds *= s
    g["nearness"] = np.bincount(np.maximum(_distance, 0).ravel(), weights=ds.sum(axis=0).ravel(), minlength=2 * STRIDE)
    split = lambda a: a[:, STRIDE:] + np.concatenate([a[1:, :STRIDE], np.zeros_like(a[:1, :STRIDE])])
    dv = split(np.matmul(s.transpose(0, 2, 1), dheard))
    ds *= np.float32(DIM**-0.5)
    dq, dk = np.matmul(ds, k), split(np.matmul(ds.transpose(0, 2, 1), q))
    d = np.concatenate([dq.reshape(-1, DIM), dk.reshape(-1, DIM), dv.reshape(-1, DIM)], axis=1)
    g["query"], g["key"], g["value"] = np.split(x.T @ d, 3, axis=1)
    return g, dstate + d @ np.concatenate([w["query"], w["key"], w["value"]], axis=1).T


def summed_rows(values: np.ndarray, place: np.ndarray, places: int) -> np.ndarray:
    """Sums of rows by place."""
    cells = place[:, None] * DIM + np.arange(DIM)
    return np.bincount(cells.ravel(), weights=values.ravel(), minlength=places * DIM).reshape(places, DIM).astype(np.float32)


class Learner:
    """What a task learns in a round: weights, moments of Adam, and how often it met each subword."""

    def __init__(self, net: Network):
        self.class_of, self.w = net.class_of, {n: a.copy() for n, a in net.w.items()}
        self.moments = {n: (np.zeros_like(a), np.zeros_like(a)) for n, a in net.w.items()}
        self.met, self.rows, self.steps = np.zeros(SUBWORDS, np.int64), 0, 0

    def learn(self, first: np.ndarray, place: np.ndarray, flat: np.ndarray, lengths: np.ndarray, training: np.ndarray, seed: int) -> None:
        """From the training texts of a run, in a drawn order."""
        starts, opening = np.cumsum(lengths) - lengths, len(lengths)
        n = np.diff(first) + 1  # rows of each text: its start, its words
        begin = first[:-1] + np.arange(len(n))
        tokens = np.full(int(n.sum()), opening, dtype=np.int64)
        tokens[ragged(begin + 1, n - 1)] = place
        target = np.full(len(tokens), END)
        classes = self.class_of[flat[starts]]
        target[ragged(begin, n - 1)] = classes[place]
        own = np.flatnonzero(training)
        pieces = -(-n[own] // PIECE)
        text = np.repeat(own, pieces)
        lo = ragged(np.zeros(len(own), np.int64), pieces) * PIECE
        known = np.where(lo > 0, STRIDE, 0)  # rows that only lead up to the first prediction
        many = np.minimum(n[text] - lo, PIECE) + known
        lo += begin[text] - known
        order = np.random.default_rng(seed).permutation(len(lo))
        for k in range(0, len(order), TEXTS):
            batch = order[k : k + TEXTS]
            self._step(tokens, target, lo[batch], many[batch], known[batch], flat, starts, lengths)

    def _step(self, tokens, target, lo, many, known, flat, starts, lengths) -> None:
        w, opening = self.w, len(lengths)
        source = ragged(lo, many)
        blocks = 1 + -(-many // STRIDE)
        begin = (np.cumsum(blocks) - blocks) * STRIDE + STRIDE
        at = ragged(begin, many)
        asked = np.ones(len(at), dtype=bool)
        asked[ragged(np.cumsum(many) - many, known)] = False
        mark = np.zeros(opening + 1, dtype=bool)
        mark[tokens[source]] = True
        mark[opening] = True  # the start comes last, whether or not the batch has one
        used = np.flatnonzero(mark)
        place = (np.cumsum(mark) - 1)[tokens[source]]
        used = used[:-1]
        ids, parts = flat[ragged(starts[used], lengths[used])], lengths[used]
        vectors = np.concatenate([word_vectors(w["embed"], ids, parts), w["start"][None]])
        x = np.zeros((int(blocks.sum()) * STRIDE, DIM), dtype=np.float32)
        full = np.zeros(len(x), dtype=bool)
        x[at], full[at] = vectors[place], True
        g, dx = gradients(w, x, full, at[asked], target[source[asked]])
        dvectors = summed_rows(dx[at], place, len(used) + 1)
        g["start"] = dvectors[-1]
        times = np.bincount(place, minlength=len(used) + 1)[:-1]
        touched, where = np.unique(ids, return_inverse=True)
        if len(ids):
            g["embed"] = summed_rows(np.repeat(dvectors[:-1] / parts[:, None].astype(np.float32), parts, axis=0), where, len(touched))
            self.met[: int(ids.max()) + 1] += np.bincount(ids, weights=np.repeat(times, parts)).astype(np.int64)
        self.rows += int(asked.sum())
        self.steps += 1
        for name, d in g.items():
            rows = touched if name == "embed" else slice(None)
            m1, m2 = self.moments[name]
            m1[rows] = 0.9 * m1[rows] + 0.1 * d
            m2[rows] = 0.99 * m2[rows] + 0.01 * d * d
            change = RATE * (m1[rows] / (1 - 0.9**self.steps)) / (np.sqrt(m2[rows] / (1 - 0.99**self.steps)) + 1e-8)
            w[name][rows] -= change.astype(np.float32)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))


RUN = (
    "run long, doc_ids array<long>, held array<boolean>, first binary, place binary, "
    "hashes binary, counts binary, flat binary, lengths binary"
)


def _runs():
    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi, data, offsets in text_runs(batch.column("text"), RUN_BYTES):
                hashes, place, first, flat, lengths = distinct_words(data, offsets)
                held = batch.column("held").slice(lo, hi - lo)
                training = np.repeat(~held.to_numpy(zero_copy_only=False), np.diff(first))
                counts = np.bincount(place[training], minlength=len(hashes))
                packed = [
                    first.astype("<i8"), place.astype("<u4"), hashes.astype("<u8"), counts.astype("<u4"),
                    flat.astype("<u2"), lengths.astype("<u4"),
                ]
                one = lambda column: pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), column)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(task << 32) + number]),
                        one(pa.concat_arrays([batch.column("doc_id").slice(lo, hi - lo)])),
                        one(pa.concat_arrays([held])),
                        *(pa.array([x.tobytes()], pa.binary()) for x in packed),
                    ],
                    names=[f.split()[0] for f in RUN.split(", ")],
                )
                number += 1

    return run


def unpacked(batch: pa.RecordBatch, row: int, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_py(), kind)


def _heads():
    """How often each subword begins a word of the training texts."""

    def run(batches):
        heads = np.zeros(SUBWORDS, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                lengths = unpacked(batch, k, "lengths", "<u4").astype(np.int64)
                first = unpacked(batch, k, "flat", "<u2")[np.cumsum(lengths) - lengths]
                heads += np.bincount(first, weights=unpacked(batch, k, "counts", "<u4"), minlength=SUBWORDS).astype(np.int64)
        found = np.flatnonzero(heads)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(heads[found])], names=["head", "n"])

    return run


LEARNT = "part int, task int, ids binary, weights binary, rows binary"
DENSE = [n for n in _PARAMETERS if n != "embed"]


def _learnt(shared):
    """What a task learned: the embeddings of the subwords it met, in slices, and all other weights in one (-1)."""

    def run(batches):
        task, learner = TaskContext.get().partitionId(), Learner(shared.value)
        for batch in batches:
            for k in range(batch.num_rows):
                first, place = unpacked(batch, k, "first", "<i8"), unpacked(batch, k, "place", "<u4")
                flat, lengths = unpacked(batch, k, "flat", "<u2"), unpacked(batch, k, "lengths", "<u4").astype(np.int64)
                training = ~batch.column("held")[k].values.to_numpy(zero_copy_only=False)
                learner.learn(first, place, flat, lengths, training, batch.column("run")[k].as_py())
        if learner.steps:
            dense = np.concatenate([learner.w[n].ravel() for n in DENSE])
            found = [(-1, np.zeros(1, np.int64), np.array([learner.rows]), dense)]
            met = np.flatnonzero(learner.met)
            for ids in np.split(met, np.flatnonzero(np.diff(met // SLICE)) + 1) if len(met) else ():
                found.append((int(ids[0]) // SLICE, ids, learner.met[ids], learner.w["embed"][ids]))
            for part, ids, weights, rows in found:
                one = [ids.astype("<i8"), weights.astype("<f8"), rows.astype("<f4")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([task], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in one)],
                    names=[f.split()[0] for f in LEARNT.split(", ")],
                )

    return run


def _mean(pdf: pd.DataFrame) -> pd.DataFrame:
    """Weighted means of the rows of one part over tasks, in the order of the tasks."""
    part = int(pdf["part"].iloc[0])
    size = SLICE if part >= 0 else 1
    total, weight = 0.0, np.zeros(size)
    for row in pdf.sort_values("task").itertuples():
        ids, w = np.frombuffer(row.ids, "<i8") % SLICE, np.frombuffer(row.weights, "<f8")
        own = np.frombuffer(row.rows, "<f4").reshape(len(ids), -1)
        whole = np.zeros((size, own.shape[1]))
        whole[ids] = own * w[:, None]
        total = total + whole
        weight[ids] += w
    at = np.flatnonzero(weight)
    ids, rows = at + max(part, 0) * SLICE, total[at] / weight[at, None]
    return pd.DataFrame({"part": [part], "ids": [ids.astype("<i8").tobytes()], "rows": [rows.astype("<f4").tobytes()]})


def fit(spark: SparkSession, runs: DataFrame, seed: int = 5) -> Network:
    """Classes and weights from all training texts of the runs."""
    draw = np.random.default_rng(seed)
    w = {n: (draw.standard_normal(s) * (0.3 if len(s) > 1 else 0.0)).astype(np.float32) for n, s in _PARAMETERS.items()}
    heads = np.zeros(SUBWORDS, np.int64)
    counted = runs.select("counts", "flat", "lengths").mapInArrow(_heads(), "head long, n long")
    for row in counted.groupBy("head").agg(F.sum("n").alias("n")).collect():  # SUBWORDS rows at most
        heads[row["head"]] = row["n"]
    top = np.argsort(-heads, kind="stable")[:OTHER]
    top = top[heads[top] > 0]
    class_of = np.full(SUBWORDS, OTHER, dtype=np.uint8)
    class_of[top] = np.arange(len(top))
    net = Network(class_of, w)
    words = int(heads.sum())
    if not words:
        return net
    w["bias"][:] = np.log(np.bincount(class_of, weights=heads, minlength=CLASSES) + 1.0)
    rounds = min(ROUNDS, -(-words // LANE_WORDS))
    lanes = -(-words // (rounds * LANE_WORDS))
    for k in range(rounds * PASSES):
        share = runs.where(F.pmod(F.xxhash64("run"), F.lit(rounds)) == k % rounds).select("run", "held", "first", "place", "flat", "lengths")
        shared = spark.sparkContext.broadcast(net)
        learnt = share.coalesce(lanes).mapInArrow(_learnt(shared), LEARNT)
        for row in learnt.groupBy("part").applyInPandas(_mean, "part int, ids binary, rows binary").collect():  # the weights once
            rows = np.frombuffer(row["rows"], "<f4")
            if row["part"] >= 0:
                w["embed"][np.frombuffer(row["ids"], "<i8")] = rows.reshape(-1, DIM)
            else:
                cuts = np.cumsum([w[n].size for n in DENSE])[:-1]
                w.update({n: x.reshape(w[n].shape).copy() for n, x in zip(DENSE, np.split(rows, cuts))})
        shared.destroy()
    return net


def _dealt(ranges: int, shared):
    """Parts of each run's counts by range of the hash."""
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], dtype=np.uint64)

    def run(batches):
        for batch in batches:
            for k, number in enumerate(batch.column("run").to_pylist()):
                hashes, counts = unpacked(batch, k, "hashes", "<u8"), unpacked(batch, k, "counts", "<u4")
                lengths = unpacked(batch, k, "lengths", "<u4").astype(np.int64)
                classes = shared.value.class_of[unpacked(batch, k, "flat", "<u2")[np.cumsum(lengths) - lengths]]
                cut = np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])
                full = np.flatnonzero(np.diff(cut))
                parts = [[x[cut[r] : cut[r + 1]].tobytes() for r in full] for x in (hashes, counts, classes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int64()), pa.array([number] * len(full), pa.int64()), *(pa.array(x, pa.binary()) for x in parts)],
                    names=["part", "run", "hashes", "counts", "classes"],
                )

    return run


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of the words of one range, in the order of each run, and totals by class."""
    hashes = np.concatenate([np.frombuffer(x, "<u8") for x in pdf["hashes"]])
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["counts"]]).astype(np.int64)
    classes = np.concatenate([np.frombuffer(x, "u1") for x in pdf["classes"]])
    words, example, place = np.unique(hashes, return_index=True, return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(words)).astype(np.int64)
    seen = total > 0
    by_class = np.bincount(classes[example], weights=total, minlength=CLASSES).astype(np.int64)
    distinct = np.bincount(classes[example][seen], minlength=CLASSES)
    ends = np.cumsum([len(x) // 8 for x in pdf["hashes"]])
    back = [x.astype("<u8").tobytes() for x in np.split(total[place], ends[:-1])]
    empty = np.zeros(0, np.int64)
    return pd.DataFrame(
        {
            "run": pdf["run"], "part": pdf["part"], "counts": back,
            "tokens": [by_class if i == 0 else empty for i in range(len(pdf))],
            "distinct": [distinct if i == 0 else empty for i in range(len(pdf))],
        }
    )


SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(shared):
    def run(batches):
        net, tokens, distinct, ends = shared.value
        n, v = int(tokens.sum()) + ends, int(distinct.sum()) + (ends > 0)
        within = np.log10(tokens + SMOOTH * (distinct + 1.0))
        unigram = np.log10(n + SMOOTH * (v + 1.0))
        end_count = np.log10(ends + SMOOTH)
        for batch in batches:
            for k in range(batch.num_rows):
                first, place = unpacked(batch, k, "first", "<i8"), unpacked(batch, k, "place", "<u4")
                flat, lengths = unpacked(batch, k, "flat", "<u2"), unpacked(batch, k, "lengths", "<u4").astype(np.int64)
                classes = net.class_of[flat[np.cumsum(lengths) - lengths]]
                parts = sorted(batch.column("parts")[k].as_py() or (), key=lambda x: x["part"])
                counts = np.concatenate([np.frombuffer(x["counts"], "<u8") for x in parts]) if parts else np.zeros(0, np.uint64)
                logs = np.log10(counts + SMOOTH)
                vectors = word_vectors(net.w["embed"], flat, lengths)
                word = logs - within[classes]
                texts = len(first) - 1
                n_words = np.diff(first)
                known = np.bincount(np.repeat(np.arange(texts), n_words), weights=(counts > 0)[place], minlength=texts).astype(np.int64)
                total = np.empty(texts)
                base = np.empty(texts)
                step = 0
                while step < texts:  # some texts at a time, for the memory of their windows
                    to = max(step + 1, int(np.searchsorted(first, first[step] + 50_000, side="right")) - 1)
                    to = min(to, texts)
                    own = first[step : to + 1] - first[step]
                    here = place[first[step] : first[to]]
                    predicted = class_scores(net, vectors, classes, here, own)
                    marks = own + np.arange(len(own))
                    predicted[ragged(marks[:-1], np.diff(own))] += word[here]
                    total[step:to] = np.add.reduceat(predicted, marks[:-1]) + end_count - np.log10(ends + SMOOTH * 2.0)
                    sums = np.concatenate([[0.0], np.cumsum(logs[here] - unigram)])
                    base[step:to] = sums[own[1:]] - sums[own[:-1]] + end_count - unigram
                    step = to
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[k].values, batch.column("held")[k].values, pa.array(n_words + 1),
                        pa.array(known + (1 if ends else 0)), pa.array(base), pa.array(total),
                    ],
                    names=[f.split()[0] for f in SCORE.split(", ")],
                )

    return run


def scored(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """SCORE and train_tokens for each document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held"), "text")
    runs = stored(spark, rows.mapInArrow(_runs(), RUN), "runs")
    size = runs.agg(F.sum(F.length("lengths") / 4).alias("words"), F.sum(F.size(F.filter("held", lambda x: ~x))).alias("ends")).first()
    ends = int(size["ends"] or 0)
    net = fit(spark, runs)
    ranges = max(1, -(-int(size["words"] or 0) // RANGE_WORDS))
    dealt = runs.select("run", "hashes", "counts", "flat", "lengths").mapInArrow(
        _dealt(ranges, spark.sparkContext.broadcast(net)), "part long, run long, hashes binary, counts binary, classes binary"
    )
    summed = dealt.groupBy("part").applyInPandas(_summed, "run long, part long, counts binary, tokens array<long>, distinct array<long>")
    summed = stored(spark, summed, "counts")
    totals = [np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)]
    by_class = summed.where(F.size("tokens") > 0).select(F.posexplode(F.arrays_zip("tokens", "distinct")).alias("class", "x"))
    for row in by_class.groupBy("class").agg(F.sum("x.tokens").alias("t"), F.sum("x.distinct").alias("d")).collect():  # CLASSES rows
        totals[0][row["class"]], totals[1][row["class"]] = row["t"], row["d"]
    back = summed.groupBy("run").agg(F.collect_list(F.struct("part", "counts")).alias("parts")).withColumnRenamed("run", "_run")
    joined = runs.join(back, F.col("run") == F.col("_run"), "left").select("doc_ids", "held", "first", "place", "flat", "lengths", "parts")
    out = joined.mapInArrow(_scores(spark.sparkContext.broadcast((net, *totals, ends))), SCORE)
    return out.withColumn("train_tokens", F.lit(int(totals[0].sum()) + ends).cast("long"))


def op8(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return scored(spark, docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
