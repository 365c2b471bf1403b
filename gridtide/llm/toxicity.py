"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed embeddings of the word and of some of its
prefixes. Filters of several widths run over the whole text, each keeps its maximum,
and a logistic layer gives the score. Thresholds are calibrated by language on
all labelled rows that are neither held out nor fitted on; a language with fewer than
LANGUAGE_POSITIVES toxic ones there, or none, gets the threshold of all languages
together, and CUT if these have too few as well. Language is no input of the score.

The classifier is fitted on a bounded sample: the ``sample`` labelled rows with the
smallest hash of their id, among texts of at most SAMPLE_CHARS characters. Everything
else covers all data: each text is scored as a whole, in the task that reads it, and
nothing is shuffled but labels, ids and scores.

Defined cases: NULL and empty texts get the score of a text without words; an id
without a label, or a NULL id, is only scored; repeated rows are scored alike;
several labels of one id count as the largest; without labelled rows, or with labels of one kind only, all scores are 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .shared import RUN_BYTES, Words, lean, same_columns, small_side, text_runs

PREFIXES = (4, 6, 7)
BUCKETS = 1 << 22
DIM, FILTERS, WIDTHS = 12, 8, (1, 2, 3)
PAD = max(WIDTHS)
SAMPLE, SAMPLE_CHARS = 8000, 20_000
SEEN_IN = 4  # buckets in fewer sample texts are not trained
CUT = 0.3  # fixed value: the cut of ``predicted``
LANGUAGE_POSITIVES = 15
GRID = tuple(round(0.1 + 0.05 * i, 2) for i in range(13))  # the thresholds to choose from


@dataclass
class Model:
    place: np.ndarray  # bucket -> row of the embeddings, 0 where untrained
    embeddings: np.ndarray  # row 0 is zero
    weights: np.ndarray  # DIM x (sum of widths * FILTERS)
    out: np.ndarray
    bias: float
    fitted: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))  # sample rows that weights are fitted on


def buckets_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and of its prefixes, and the first word of each text."""
    found = Words(data, offsets, prefixes=PREFIXES)
    salted = [found.hashes, *(h + np.uint64(k) for k, h in zip(PREFIXES, found.prefixes))]
    return np.stack([(h % np.uint64(BUCKETS)).astype(np.int32) for h in salted], axis=1), found.first


def _laid_out(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding rows of all texts with PAD empty places after each, where each text
    begins there, and the number of its places that filters start from."""
    n = np.diff(first)
    starts = first[:-1] + PAD * np.arange(len(n))
    out = np.zeros((len(rows) + PAD * len(n), rows.shape[1]), dtype=rows.dtype)
    out[np.arange(len(rows)) + PAD * np.repeat(np.arange(len(n)), n)] = rows
    return out, starts, n + 1


def _responses(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Response of each filter at each place."""
    y = x @ weights
    out, at = np.empty((len(x), FILTERS * len(WIDTHS)), dtype=np.float32), 0
    for i, width in enumerate(WIDTHS):
        part = y[:, at : at + FILTERS].copy()
        for k in range(1, width):
            part[:-k] += y[k:, at + k * FILTERS : at + (k + 1) * FILTERS]
        out[:, i * FILTERS : (i + 1) * FILTERS] = part
        at += width * FILTERS
    return out


def scores(model: Model, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    return _scores(model, model.place[buckets], first)


def _scores(model: Model, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    rows, starts, n = _laid_out(rows, first)
    x = model.embeddings[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        x += model.embeddings[rows[:, k]]
    peaks = np.maximum.reduceat(_inside(_responses(x, model.weights), starts, n), starts, axis=0) if len(starts) else np.zeros((0, 1))
    return 1.0 / (1.0 + np.exp(-np.clip(peaks.astype(np.float64) @ model.out + model.bias, -40, 40)))


def _inside(responses: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Responses with the places after each text's last one (an empty place) left out of the maximum."""
    for k in range(1, PAD):
        responses[starts + n - 1 + k] = 0.0
    return responses


def train(labels: np.ndarray, data: np.ndarray, offsets: np.ndarray, epochs: int = 14, seed: int = 7) -> Model:
    """Fit by Adagrad on mini-batches; the epoch with the least loss on a fifth of the sample is kept."""
    draw = np.random.default_rng(seed)
    n_texts = len(labels)
    parts, seen, ends = [], np.zeros(BUCKETS, dtype=np.int32), [np.zeros(1, dtype=np.int64)]
    for lo in range(0, n_texts, 200):  # some texts at a time, for the memory of the driver
        hi = min(lo + 200, n_texts)
        some, begin = buckets_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        text = np.repeat(np.arange(hi - lo), np.diff(begin))
        pairs = np.unique((text[:, None] * np.int64(BUCKETS) + some).ravel())
        seen += np.bincount(pairs % BUCKETS, minlength=BUCKETS).astype(np.int32)
        parts.append(some)
        ends.append(ends[-1][-1] + begin[1:])
    first = np.concatenate(ends)
    place = np.zeros(BUCKETS, dtype=np.int32)
    used = np.flatnonzero(seen >= SEEN_IN)
    place[used] = np.arange(1, len(used) + 1)
    for i, some in enumerate(parts):
        parts[i] = place[some]
    rows_all = np.concatenate(parts)
    del parts, some, seen
    e = (draw.standard_normal((len(used) + 1, DIM)) * 0.1).astype(np.float32)
    e[0] = 0
    columns = FILTERS * sum(WIDTHS)
    w = (draw.standard_normal((DIM, columns)) * 0.3).astype(np.float32)
    v = (draw.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(np.float64)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    b = float(np.log(share / (1 - share)))
    ge, gw, gv, gb = (np.full_like(x, 1e-3) for x in (e, w, v, np.zeros(1)))
    order = draw.permutation(n_texts)
    held, kept = order[: n_texts // 5], order[n_texts // 5 :]
    fitted = np.sort(kept)
    column_of = [sum(WIDTHS[:i]) * FILTERS for i in range(len(WIDTHS))]
    best, best_loss = None, np.inf

    def gathered(texts):
        lengths = (first[texts + 1] - first[texts]).astype(np.int64)
        ends = np.cumsum(lengths)
        take = np.repeat(first[texts] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        return rows_all[take], np.concatenate([[0], ends])

    for _ in range(epochs):
        for lo in range(0, len(kept), 64):
            batch = draw.permutation(kept)[:64] if lo == 0 else kept[lo : lo + 64]
            rows, starts, n = _laid_out(*gathered(batch))
            x = e[rows].sum(axis=1)
            r = _inside(_responses(x, w), starts, n)
            peak = np.maximum.reduceat(r, starts, axis=0)
            owner = np.repeat(np.arange(len(batch)), np.diff(np.append(starts, len(r))))
            # the first place that reaches the peak
            hit_t, hit_f = np.nonzero(r == peak[owner])
            cell = owner[hit_t] * r.shape[1] + hit_f
            _, one = np.unique(cell, return_index=True)
            at = np.zeros(peak.shape, dtype=np.int64)
            at.ravel()[cell[one]] = hit_t[one]
            p = 1 / (1 + np.exp(-np.clip(peak @ v + b, -40, 40)))
            d = (p - labels[batch]) / len(batch)
            dv, db = peak.T @ d, d.sum()
            dpeak = d[:, None] * v
            dw = np.zeros_like(w)
            touched, change = [], []
            for i, width in enumerate(WIDTHS):
                where, slope = at[:, i * FILTERS : (i + 1) * FILTERS], dpeak[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(width):
                    c = slice(column_of[i] + k * FILTERS, column_of[i] + (k + 1) * FILTERS)
                    xs = x[where + k]
                    dw[:, c] = np.einsum("bfd,bf->df", xs, slope)
                    touched.append(rows[where + k].reshape(-1, rows.shape[1]))
                    change.append((slope[:, :, None] * w[:, c].T[None]).reshape(-1, DIM))
            where, delta = np.concatenate(touched), np.concatenate(change)
            ids, inverse = np.unique(where.ravel(), return_inverse=True)
            de = np.zeros((len(ids), DIM))
            np.add.at(de, inverse, np.repeat(delta, where.shape[1], axis=0))
            real = ids > 0
            ids, de = ids[real], de[real]
            ge[ids] += de**2
            e[ids] -= (0.15 * de / np.sqrt(ge[ids])).astype(np.float32)
            gw += dw**2
            w -= (0.05 * dw / np.sqrt(gw)).astype(np.float32)
            gv += dv**2
            v -= 0.05 * dv / np.sqrt(gv)
            gb += db**2
            b -= float(0.05 * db / np.sqrt(gb[0]))
        kept = draw.permutation(kept)
        model = Model(place, e.copy(), w.copy(), v.copy(), b, fitted)
        got = np.concatenate([_scores(model, *gathered(held[i : i + 256])) for i in range(0, len(held), 256)]) if len(held) else np.zeros(0)
        y = labels[held]
        loss = -np.mean(np.log(np.clip(np.where(y == 1, got, 1 - got), 1e-9, 1))) if len(held) else 0.0
        if loss < best_loss or best is None:
            best, best_loss = model, loss
    return best


def calibrated(counts: list[tuple[str | None, int, int, int]]) -> dict[str | None, float]:
    """Thresholds by language from (lang, toxic, thresholds reached, rows); None has that of all languages.

    The threshold with the best F1 is taken, in a tie the one nearest CUT.
    """
    tables: dict[str | None, np.ndarray] = {None: np.zeros((2, len(GRID) + 1), dtype=np.int64)}
    for lang, toxic, reached, n in counts:
        for key in {lang, None}:
            tables.setdefault(key, np.zeros((2, len(GRID) + 1), dtype=np.int64))[toxic, reached] += n
    out = {None: CUT}
    for key in sorted(tables, key=lambda k: (k is not None, k or "")):
        over = tables[key][:, ::-1].cumsum(axis=1)[:, ::-1]  # rows that reach so many thresholds or more
        if over[1, 0] < LANGUAGE_POSITIVES:
            continue
        f1 = [2 * over[1, k] / (over[:, k].sum() + over[1, 0]) for k in range(1, len(GRID) + 1)]
        out[key] = min((t for t, f in zip(GRID, f1) if f >= max(f1) - 1e-12), key=lambda t: abs(t - CUT))
    return out


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled ids that are not held out."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.where(~held_out())


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Model, pa.Array] | None:
    """The model from the labelled rows that are not held out, and the ids it is fitted on; None without any, and where
    all of them are labelled alike, which teaches nothing."""
    known = known_labels(labels).withColumn("_order", F.xxhash64("doc_id"))
    # Twice the sample, as long texts are left out of it; both are fixed numbers of rows.
    chosen = known.orderBy("_order", "doc_id").limit(2 * sample).withColumnRenamed("doc_id", "_id")
    rows = (
        docs.select("doc_id", "lang", "text")
        .where(F.length(F.coalesce("text", F.lit(""))) <= SAMPLE_CHARS)
        .join(small_side(chosen, 2 * sample), F.col("doc_id") == F.col("_id"))
        .orderBy("_order", "doc_id", F.xxhash64("text"))
        .limit(sample)
        .select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
        .toArrow()
    )
    if not rows.num_rows:
        return None
    _, _, data, offsets = next(iter(text_runs(rows.column("text"), most=1 << 62)))
    y = (rows.column("toxic").to_numpy() > 0).astype(np.float64)
    if y.min() == y.max():
        return None
    model = train(y, data, offsets)
    return model, rows.column("doc_id").combine_chunks().take(pa.array(model.fitted))


def _score(shared, fitted=None):
    """Batches with the score of each row; rows of the ``fitted`` ids are left out."""

    def run(batches):
        model = shared.value
        for batch in batches:
            if fitted is not None:
                batch = batch.filter(pc.invert(pc.is_in(batch.column("doc_id"), value_set=fitted.value)))
            for lo, hi, data, offsets in text_runs(batch.column("text"), RUN_BYTES):
                got = scores(model, *buckets_of(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, hi - lo) for c in range(batch.num_columns)), pa.array(got)], names=[*batch.schema.names, "_score"]
                )

    return run


def reached(spark: SparkSession, docs: DataFrame, labels: DataFrame, shared, fitted: pa.Array) -> DataFrame:
    """(lang, toxic, reached, n): rows by how many thresholds of GRID they reach, over all labelled
    rows that are neither held out nor fitted on. Texts stay in the task that reads them."""
    own = docs.select("doc_id", "lang", "text").where(F.col("doc_id").isNotNull() & ~held_out())
    # One Python worker a task: each takes memory, and keeps it for the tasks that follow.
    got = own.mapInArrow(lean(_score(shared, spark.sparkContext.broadcast(fitted))), StructType([*own.schema.fields, StructField("_score", DoubleType())]))
    steps = sum(((F.col("_score") >= t).cast("int") for t in GRID), F.lit(0))
    known = known_labels(labels).select(F.col("doc_id").alias("_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    met = got.select("doc_id", "lang", steps.alias("reached")).join(small_side(known), F.col("doc_id") == F.col("_id"))
    return met.groupBy("lang", "toxic", "reached").agg(F.count("*").alias("n"))


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with _score, and _threshold by their language."""
    found = fit(docs, labels)
    if found is None:
        return docs.withColumn("_score", F.lit(0.0)).withColumn("_threshold", F.lit(CUT))
    model, fitted = found
    shared = spark.sparkContext.broadcast(model)
    thresholds = calibrated([tuple(r) for r in reached(spark, docs, labels, shared, fitted).collect()])
    schema = StructType([*docs.schema.fields, StructField("_score", DoubleType())])
    out = docs.mapInArrow(lean(_score(shared)), schema)
    threshold = F.lit(thresholds.pop(None))
    for lang, cut in thresholds.items():
        threshold = F.when(F.col("lang") == lang, F.lit(cut)).otherwise(threshold)
    return out.withColumn("_threshold", threshold)


def op6(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(spark, docs.select("doc_id", "lang", "text"), labels).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= CUT).cast("int").alias("predicted"),
        F.col("_threshold").alias("threshold"),
        (F.col("_score") >= F.col("_threshold")).alias("flagged"),
    )


@same_columns
def cleaned(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below the threshold of their language."""
    return scored(spark, docs, labels).where("_score < _threshold").select(*docs.columns)
