"""Toxicity by non-negative positive-unlabelled learning.

A linear model over indicators of lower-case words is trained from confirmed toxic texts (P) and texts of any kind (U). With
class prior p and logistic loss l, the risk of the negatives is not measured but derived: R- = E_U l(-z) - p E_P l(-z). Where
this estimate falls below zero, which no real risk can, the step goes up its gradient instead of down the whole risk. The
words are those whose rates in P and U differ by WORD_SCORE standard errors. Margins become scores by an isotonic estimate of
p f_P / f_U on folds that their model has not seen.

Labels, and unlabelled texts too, come from rows outside the held-out third only; of the labels only the positives and their
share (the prior) are used. Bounds, all on rows that the model is fitted on: MAX_POSITIVE, MAX_UNLABELLED, MAX_WORDS. Every
text is scored whole.

Defined results: a null text scores as an empty one, an empty one as a text without any of the words; labels that are null
are skipped, repeated or contradicting ones count once, as toxic if one says so; of rows that share an id the text that
sorts first is learnt from; a null id is never learnt from and not held out; without positives every text scores the
prior; an empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merging import give_back
from .shipping import checkpointed, ship

#: Rows that the model is fitted on at most: those with the smallest hash of their id.
MAX_POSITIVE = 3000
MAX_UNLABELLED = 12_000
MAX_WORDS = 1000
WORD_SCORE = 5.0
WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    """Distinct lower-case runs of letters; no list of all words is made, so memory follows the distinct ones."""
    return {m[0] for m in WORD.finditer((text or "").lower())}


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(word, row) of each indicator."""
    return np.concatenate(rows) if rows else np.zeros(0, np.int64), np.repeat(np.arange(len(rows)), [len(r) for r in rows])


def margins(rows: list[np.ndarray], w: np.ndarray, bias: float) -> np.ndarray:
    word, row = _flat(rows)
    return np.bincount(row, weights=w[word], minlength=len(rows)) + bias


def corrected_risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """(risk of the positives, corrected risk of the negatives, slope of the step's objective at each margin of P, of U)."""
    positive, negative = prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    sp, su = prior * _sigmoid(zp) / len(zp), _sigmoid(zu) / len(zu)
    if negative >= 0:
        return positive, negative, -prior / len(zp) + np.zeros(len(zp)), su  # both parts down
    return positive, negative, sp, -su  # up the negative part alone


def train(p: list[np.ndarray], u: list[np.ndarray], n_words: int, prior: float, epochs: int = 30, rate: float = 0.02, decay: float = 1e-4, batch: int = 1000, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and intercept: Adam over mini-batches of both sets, averaged over the second half of the steps."""
    draw = np.random.default_rng(seed)
    w = np.zeros(n_words + 1)
    w[-1] = np.log(prior / (1 - prior))  # the intercept is the last weight
    first, second, total, steps, averaged = np.zeros_like(w), np.zeros_like(w), np.zeros_like(w), 0, 0
    parts = max(1, -(-len(u) // batch))
    for epoch in range(epochs):
        for a, b in zip(np.array_split(draw.permutation(len(p)), parts), np.array_split(draw.permutation(len(u)), parts)):
            if not len(a) or not len(b):
                continue
            (xp, rp), (xu, ru) = _flat([p[i] for i in a]), _flat([u[i] for i in b])
            zp, zu = np.bincount(rp, weights=w[xp], minlength=len(a)) + w[-1], np.bincount(ru, weights=w[xu], minlength=len(b)) + w[-1]
            _, _, gp, gu = corrected_risk(zp, zu, prior)
            g = np.bincount(xp, weights=gp[rp], minlength=n_words + 1) + np.bincount(xu, weights=gu[ru], minlength=n_words + 1) + decay * w
            g[-1] = gp.sum() + gu.sum()
            steps += 1
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            w = w - rate * (first / (1 - 0.9**steps)) / (np.sqrt(second / (1 - 0.999**steps)) + 1e-8)
            if epoch >= epochs // 2:
                total, averaged = total + w, averaged + 1
    w = total / averaged if averaged else w
    return w[:-1], float(w[-1])


def posterior(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots (margin, score) of the non-decreasing least-squares fit of prior f_P / f_U, by pooling adjacent violators."""
    z = np.concatenate([zp, zu])
    order = np.argsort(z, kind="stable")
    above = np.concatenate([np.full(len(zp), prior / max(1, len(zp))), np.zeros(len(zu))])[order]
    below = np.concatenate([np.zeros(len(zp)), np.full(len(zu), 1 / max(1, len(zu)))])[order]
    blocks: list[list[float]] = []  # [sum above, sum below, first margin, last margin]
    for x, g, h in zip(z[order].tolist(), above.tolist(), below.tolist()):
        blocks.append([g, h, x, x])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g, h, _, x = blocks.pop()
            blocks[-1][0] += g
            blocks[-1][1] += h
            blocks[-1][3] = x
    score = [min(1.0, g / h) if h > 0 else 1.0 for g, h, _, _ in blocks]
    return np.array([x for b in blocks for x in b[2:]]), np.repeat(score, 2)


def fit(p: list[np.ndarray], u: list[np.ndarray], n_words: int, prior: float, folds: int = 2) -> dict:
    """Weights by word, intercept, and the knots from margins to scores."""
    if not p or not u:
        return {"weight": np.zeros(n_words), "bias": 0.0, "at": np.zeros(1), "score": np.array([prior])}
    w, bias = train(p, u, n_words, prior)
    zp, zu = margins(p, w, bias), margins(u, w, bias)
    if len(p) >= folds and len(u) >= folds:
        for k in range(folds):
            other = train([x for i, x in enumerate(p) if i % folds != k], [x for i, x in enumerate(u) if i % folds != k], n_words, prior)
            zp[k::folds], zu[k::folds] = margins(p[k::folds], *other), margins(u[k::folds], *other)
    at, score = posterior(zp, zu, prior)
    return {"weight": w, "bias": bias, "at": at, "score": score}


def scored(z: np.ndarray, model: dict) -> np.ndarray:
    """Scores of margins; a hundredth follows the margin itself, so that order is kept within a step of the fit."""
    if len(model["at"]) == 1:
        return np.full(len(z), float(model["score"][0]))
    return 0.99 * np.interp(z, model["at"], model["score"]) + 0.01 * _sigmoid(z)


def in_training(id_col: F.Column) -> F.Column:
    """Rows that may be learnt from; the others are held out."""
    return F.crc32(id_col.cast("string")) % 3 != 1


def _sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most_p: int, most_u: int) -> tuple[DataFrame, float]:
    """(toxic, free, words) of the sampled rows, checkpointed, and the class prior. The ids of the sample are bounded by
    most_p and most_u and so broadcast to the scan of the texts."""
    ids = lambda df: df.orderBy(F.xxhash64("id"), "id")
    judged = labels.select(F.col(id_col).alias("id"), (F.col(label_col).cast("int") == 1).alias("toxic")).filter(in_training(F.col("id")) & F.col("toxic").isNotNull())
    judged = judged.groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = judged.agg(F.count("*").alias("n"), F.count_if("toxic").alias("toxic")).first()
    prior = (known["toxic"] + 1) / (known["n"] + 2)
    every = docs.select(F.col(id_col).alias("id"))
    # of many documents only those with small hashes are looked at, three times as many as are taken
    share = min(1.0, 3 * most_u / max(1, every.count()))
    few = every.filter(in_training(F.col("id")) & (F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <= int(share * (1 << 30)))).distinct()
    picked = ids(judged.filter("toxic").select("id")).limit(most_p).withColumn("toxic", F.lit(True)).join(few.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 30)), "id").limit(most_u).withColumn("free", F.lit(True)), "id", "full")

    def cut(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([sorted(words(t)) for t in batch.column(2).to_pylist()], pa.list_(pa.string()))], names=["toxic", "free", "words"])
        give_back()

    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked), "id")
    one = texts.groupBy("id").agg(F.max(F.coalesce("toxic", F.lit(False))).alias("toxic"), F.max(F.coalesce("free", F.lit(False))).alias("free"), F.min("text").alias("text"))
    return checkpointed(one.select("toxic", "free", "text").mapInArrow(cut, "toxic boolean, free boolean, words array<string>")), prior


def fit_toxicity_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, max_words: int = MAX_WORDS) -> dict:
    """Fits on at most ``max_positive`` confirmed and ``max_unlabelled`` unlabelled texts. Words are counted where the texts
    are; what goes to the driver is at most ``max_words`` words and, for each sampled text, which of them it holds."""
    ship(docs.sparkSession)
    sample, prior = _sampled(docs, labels, id_col, text_col, label_col, max_positive, max_unlabelled)
    n = sample.agg(F.count_if("toxic").alias("p"), F.count_if("free").alias("u")).first()
    if not n["p"] or not n["u"]:
        return {"vocabulary": {}, **fit([], [], 0, prior)}
    counted = sample.select("toxic", "free", F.explode("words").alias("word")).groupBy("word").agg(F.count_if("toxic").alias("p"), F.count_if("free").alias("u"))
    rate = (F.col("p") + F.col("u")) / (n["p"] + n["u"])
    error = F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-12)) * (1 / n["p"] + 1 / n["u"]))
    telling = counted.withColumn("z", F.abs(F.col("p") / n["p"] - F.col("u") / n["u"]) / error).filter(F.col("z") >= WORD_SCORE)
    vocabulary = {r["word"]: i for i, r in enumerate(telling.orderBy(F.desc("z"), "word").limit(max_words).select("word").collect())}

    def indexed(batches):
        for batch in batches:
            held = [np.array(sorted(vocabulary[w] for w in ws if w in vocabulary), "<i4").tobytes() for ws in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(held, pa.binary())], names=["toxic", "free", "x"])

    rows = sorted(sample.mapInArrow(indexed, "toxic boolean, free boolean, x binary").toArrow().to_pylist(), key=lambda r: (r["toxic"], r["free"], r["x"]))
    order = np.random.default_rng(0).permutation(len(rows))  # the same for any partitioning
    held = [(rows[i]["toxic"], rows[i]["free"], np.frombuffer(rows[i]["x"], "<i4").astype(np.int64)) for i in order.tolist()]
    return {"vocabulary": vocabulary, **fit([x for t, _, x in held if t], [x for _, f, x in held if f], len(vocabulary), prior)}


def toxicity_scores(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted) of every row; one narrow pass. The model (MAX_WORDS weights) is broadcast."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        m = shared.value
        weight = dict(zip(m["vocabulary"], m["weight"].tolist()))
        for batch in batches:
            z = np.array([sum(weight[w] for w in sorted(weight.keys() & words(t.as_py()))) for t in batch.column(1)], np.float64) + m["bias"]
            got = scored(z, m)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got), pa.array((got >= threshold).astype(np.int32))], names=["id", "held_out", "score", "predicted"])
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(~in_training(F.col(id_col)), F.lit(False)).alias("held_out"))
    return rows.mapInArrow(score, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)
