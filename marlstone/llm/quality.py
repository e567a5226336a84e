"""Quality classifier: naive Bayes support vectors.

Features of a text are indicators of word unigrams and of word-shape unigrams and
bigrams, hashed to BUCKETS. Each indicator is scaled by the log ratio of its rates
in the two classes, the scaled vector is brought to unit length, and a linear
hinge-loss model is fitted by dual coordinate descent. A logistic curve over the
margin gives a score from 0 to 1.

Defined results: a null text scores as an empty one (the model's intercept); very
long texts count whole; labels that are null are skipped and repeated ones count
each time; with no labelled rows, or rows of one class only, every text gets the
same prior score; an empty table gives an empty result. Only the id and the text
are read, so other columns and their names do not matter.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merging import give_back, parts, space_words
from .shipping import ship

BUCKETS = 1 << 18
#: Labelled rows of each class that the model is fitted on, at most: those with the smallest hash of their id.
MAX_ROWS_PER_CLASS = 3000
MEMO_WORDS = 200_000
_RUN = re.compile(r"[^\W\d_]+|[0-9]+")
_MEMO: dict[str, tuple[int, int]] = {}


def _shape(m: re.Match) -> str:
    run = m[0]
    return "9" if run[0].isdigit() else "A" if len(run) > 1 and run.isupper() else "B" if run[0].isupper() else "a"


def _hashes(word: str) -> tuple[int, int]:
    """Bucket of the word, 32-bit hash of its shape."""
    raw = word.encode("utf-8", "surrogatepass")
    return zlib.crc32(b"w" + raw) % BUCKETS, zlib.crc32(_RUN.sub(_shape, word).encode("utf-8", "surrogatepass"))


def _forget() -> None:
    """At the end of a task: the worker process goes on to tasks of other stages."""
    _MEMO.clear()
    give_back()


def features(texts: pa.Array):
    """Yields (first row, rows, row of each indicator, bucket of each indicator), distinct and in row order."""
    for begin, part in parts(texts):
        part = pc.replace_substring(part, "\n", " \n ")
        distinct, index, offsets = space_words(part)
        if len(_MEMO) > MEMO_WORDS:
            _MEMO.clear()
        for w in distinct:
            if w not in _MEMO:
                _MEMO[w] = _hashes(w)
        word, shape = np.array([_MEMO[w] for w in distinct], np.int64).reshape(-1, 2)[index].T
        there = np.array([w != "" for w in distinct], bool)[index]
        row = np.repeat(np.arange(len(part)), np.diff(offsets))[there].astype(np.int64)
        word, shape = word[there], shape[there].astype(np.uint64)
        bucket = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 18)).astype(np.int64)
        together = row[1:] == row[:-1]
        pair = shape[:-1][together] * np.uint64(0x85EBCA77C2B2AE63) ^ shape[1:][together]
        keys = np.concatenate([np.unique(row * BUCKETS + word), np.unique(row * BUCKETS + bucket(shape + np.uint64(1))), np.unique(row[1:][together] * BUCKETS + bucket(pair))])
        keys = np.unique(keys)
        yield begin, len(part), keys // BUCKETS, keys % BUCKETS


def _descend(rows: list[np.ndarray], labels: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Log-count ratios, hinge-loss weights over the scaled unit vectors, and the intercept."""
    good, bad = np.ones(BUCKETS), np.ones(BUCKETS)
    for x, y in zip(rows, labels):
        (good if y == 1 else bad)[x] += 1
    ratio = np.log(good / ((labels == 1).sum() + 2)) - np.log(bad / ((labels != 1).sum() + 2))
    scaled = [ratio[x] / max(1e-9, np.sqrt((ratio[x] ** 2).sum())) for x in rows]
    w, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    sign = np.where(labels == 1, 1.0, -1.0)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            x, v, s = rows[i], scaled[i], sign[i]
            step = (1 - s * (w[x] @ v + bias)) / (v @ v + 1)
            new = min(max(alpha[i] + step, 0.0), cost)
            if new != alpha[i]:
                d = (new - alpha[i]) * s
                w[x] += d * v
                bias += d
                alpha[i] = new
    return ratio, w, bias


def _margins(rows: list[np.ndarray], ratio: np.ndarray, w: np.ndarray, bias: float) -> np.ndarray:
    return np.array([w[x] @ ratio[x] / max(1e-9, np.sqrt((ratio[x] ** 2).sum())) + bias for x in rows])


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, epochs: int = 10, seed: int = 7, folds: int = 4) -> dict:
    """Log-count ratios, hinge-loss weights and the logistic curve from the indicators of each row. The curve is fitted
    on margins of rows that their own model has not seen."""
    n_good, n_bad = int((labels == 1).sum()), int((labels != 1).sum())
    prior = (n_good + 1) / (n_good + n_bad + 2)
    if not n_good or not n_bad:
        return {"weight": np.zeros(BUCKETS), "square": np.zeros(BUCKETS), "bias": 0.0, "slope": 0.0, "shift": float(np.log(prior / (1 - prior)))}
    ratio, w, bias = _descend(rows, labels, cost, epochs, seed)
    margin, part = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
    for label in (0, 1):  # each fold has its share of both classes
        at = np.flatnonzero((labels == 1) == label)
        part[at] = np.arange(len(at)) % folds
    for k in range(folds):
        out, rest = np.flatnonzero(part == k), np.flatnonzero(part != k)
        if len(out) and 0 < (labels[rest] == 1).sum() < len(rest):
            margin[out] = _margins([rows[i] for i in out], *_descend([rows[i] for i in rest], labels[rest], cost, epochs, seed))
        elif len(out):
            margin[out] = _margins([rows[i] for i in out], ratio, w, bias)
    target = np.where(labels == 1, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    a, b = 4.0, 0.0
    for _ in range(50):  # Newton steps of the logistic fit, lightly held to where they start
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        h = p * (1 - p)
        grad = np.array([((p - target) * margin).sum() + 0.1 * (a - 4), (p - target).sum() + 0.1 * b])
        hess = np.array([[(h * margin * margin).sum() + 0.1, (h * margin).sum()], [(h * margin).sum(), h.sum() + 0.1]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return {"weight": w * ratio, "square": ratio * ratio, "bias": bias, "slope": float(a), "shift": float(b)}


def scores(texts: pa.Array, model: dict) -> np.ndarray:
    out = np.zeros(len(texts))
    for begin, n, row, x in features(texts):
        total = np.bincount(row, weights=model["weight"][x], minlength=n)
        norm = np.sqrt(np.bincount(row, weights=model["square"][x], minlength=n))
        out[begin : begin + n] = total / np.maximum(norm, 1e-9) + model["bias"]
    return 1 / (1 + np.exp(-np.clip(model["slope"] * out + model["shift"], -500, 500)))


def in_training(id_col: F.Column) -> F.Column:
    """Rows that labels may be learnt from; the others are held out."""
    return F.crc32(id_col.cast("string")) % 5 != 0


def fit_quality_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows_per_class: int = MAX_ROWS_PER_CLASS) -> dict:
    """Fits on ``max_rows_per_class`` labelled rows of each class at most. The indicators of these rows alone, as numbers,
    go to the driver; the sample is bounded, so it is broadcast to the scan of the documents."""
    ship(docs.sparkSession)
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(in_training(F.col("id")) & F.col("label").isNotNull())
    best = lambda df: df.orderBy(F.xxhash64("id"), "id").limit(max_rows_per_class)
    sample = best(usable.filter("label = 1")).union(best(usable.filter("label <> 1")))

    def extract(batches):
        for batch in batches:
            rows = [b""] * batch.num_rows
            for begin, n, row, x in features(batch.column(1)):
                ends = np.searchsorted(row, np.arange(n + 1))
                for i in range(n):
                    rows[begin + i] = x[ends[i] : ends[i + 1]].astype("<i4").tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(2), pa.array(rows, pa.binary())], names=["id", "label", "x"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id").select("id", "text", "label")
    got = sorted(picked.mapInArrow(extract, "id string, label int, x binary").collect())
    return fit([np.frombuffer(r.x, "<i4").astype(np.int64) for r in got], np.array([r.label for r in got], np.int64))


def quality_scores(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) of every row; one narrow pass. The model (two arrays of BUCKETS) is broadcast."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            got = scores(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got), pa.array((got >= threshold).astype(np.int32))], names=["id", "held_out", "score", "predicted"])
        _forget()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(~in_training(F.col(id_col)), F.lit(False)).alias("held_out"))
    return rows.mapInArrow(score, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns, in one pass."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(place).cast(pa.string()), shared.value) >= threshold))
        _forget()

    return docs.mapInArrow(keep, docs.schema)
