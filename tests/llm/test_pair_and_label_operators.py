"""Fill-in-middle, hard negatives and toxicity against brute force, with the cases that their docstrings define."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.llm import fillmiddle, hardneg, toxicity

TEXT = "doc_id bigint, text string"


# fill in the middle


def plain_transform(doc_id, text):
    """The contract in plain terms: units as a list, parts by joining them."""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(x), len(y), "<S>" + z + "<P>" + x + "<M>" + y
    return n, "psm", len(x), len(y), "<P>" + x + "<S>" + z + "<M>" + y


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.text(st.sampled_from("aZ <>PSM\né\U0001f600ı"), max_size=30))
def test_transform_and_restore(doc_id, text):
    got = fillmiddle.transform(str(doc_id), text)
    assert got == plain_transform(doc_id, text)
    assert fillmiddle.restore(got[4], got[1]) == text


def test_fill_in_middle_keeps_rows_and_columns(spark):
    texts = ["", None, "Hello, world of many words", "a <M> marker", "x" * 300_000 + " y" * 300_000, "twice the same", "twice the same", "İß\n\t.", "<" * 50]
    rows = [(i if i != 6 else 5, t, i, "k") for i, t in enumerate(texts)] + [(None, "no id at all", 9, "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, N int, `a.b` string").withColumnRenamed("N", "Form")
    got = fillmiddle.restore_texts(fillmiddle.fill_in_middle(docs.withColumn("made", F.lit(1)).withColumn("kept", F.lit(2)))).collect()
    assert set(got[0].asDict()) == {"doc_id", "text", "a.b", "made", "kept", "n", "form", "prefix_chars", "middle_chars", "output", "restored"}
    for r in got:
        want = plain_transform("" if r.doc_id is None else r.doc_id, r.text or "")
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want and r.restored == (r.text or "") and r["a.b"] == "k"
    assert len({(r.form, r.output) for r in got if r.doc_id == 5}) == 1
    digest = fillmiddle.fill_in_middle_digest(docs)
    assert digest.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    outputs = {hashlib.sha256(r.output.encode()).hexdigest() for r in got}
    assert {r.output_sha256 for r in digest.collect()} == outputs
    assert fillmiddle.fill_in_middle(docs.filter("false")).count() == 0 == fillmiddle.fill_in_middle_digest(docs.filter("false")).count()


# hard negatives


def plain_negatives(rows, anchors, n_positives=5, n_negatives=3, low=50, high=95):
    """Every score of every anchor, in Python integers."""
    sound = {}
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * x) for x in v])
        sound[i] = min(sound.get(i, row), row)
    out = set()
    for a, (label, v) in sound.items():
        if not anchors(a):
            continue
        score = {b: sum(x * y for x, y in zip(v, w)) for b, (_, w) in sound.items() if b != a and len(w) == len(v)}
        best = lambda ids: sorted(ids, key=lambda b: (-score[b], b))
        for p in best([b for b in score if sound[b][0] == label])[:n_positives]:
            fits = [b for b in score if sound[b][0] != label and low * score[p] <= 100 * score[b] <= high * score[p]]
            out |= {(a, p, k + 1, b, score[p], score[b]) for k, b in enumerate(best(fits)[:n_negatives])}
    return out


VECTORS = "vec_id bigint, embedding array<float>, label int, id string, score string"


def mined(spark, rows, **how):
    df = spark.createDataFrame([(i, v, label, "x", "y") for i, label, v in rows], VECTORS)
    return {tuple(r) for r in hardneg.hard_negatives(df, F.col("id") % 5 == 0, **how).collect()}


@pytest.mark.parametrize("bits", [4, 10])
def test_hard_negatives_by_brute_force(spark, bits):
    rng = random.Random(bits)
    rows = [(i, rng.randint(0, 2), [rng.choice([0.1, 0.11, 0.5, 0.9, -0.2]) for _ in range(3)]) for i in range(-7, 60)]
    same = [0.5, 0.5, 0.5]
    rows += [(i, 1 if i % 3 else 2, same) for i in range(100, 125)]  # a large group of one score: ids decide
    rows += [(200, None, same), (205, 1, None), (210, 1, [0.1, None, 0.2]), (215, 2, [0.1, float("nan"), 0.2]), (220, 2, [float("inf"), 0.1, 0.1]), (None, 1, same), (225, 1, []), (230, 1, [0.5, 0.5]), (231, 1, [0.4, 0.5]), (232, 2, [0.3, 0.3]), (100, 0, same), (100, 1, same), (101, 1, same)]
    rng.shuffle(rows)
    got = mined(spark, rows, digit_bits=bits, block_rows=16, block_anchors=4)
    assert got == plain_negatives(rows, lambda i: i % 5 == 0)
    assert any(len({x[5] for x in got if x[:2] == k}) == 1 for k in {x[:2] for x in got})  # ties were decided


def test_hard_negatives_of_few_and_of_large_numbers(spark):
    assert mined(spark, []) == set() == mined(spark, [(5, 1, [1.0])]) == mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])])
    one = [(5, 1, [1.0, 1.0]), (6, 1, [1.0, 1.0]), (7, 2, [0.9, 0.9])]
    assert mined(spark, one) == {(5, 6, 1, 7, 131072, 117760)} == plain_negatives(one, lambda i: i % 5 == 0)
    big = [(5, 1, [3e6, 1.0]), (6, 1, [3e6, 1.0]), (7, 2, [2.5e6, 7.0]), (8, 2, [2e6, 3.0])]
    assert mined(spark, big) == plain_negatives(big, lambda i: i % 5 == 0) != set()
    assert mined(spark, [(5, 1, [3e38]), (6, 1, [3e38]), (7, 2, [1e38])]) == set()  # held at the end of the range, so equal


def test_products_are_exact():
    rng = np.random.default_rng(3)
    for most, kind in ((100, "<i2"), (1 << 20, "<i4"), (1 << 28, "<i8")):
        a, b = rng.integers(-most, most, (4, 5)).astype(kind), rng.integers(-most, most, (6, 5)).astype(kind)
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert hardneg.products(a, b).tolist() == want


# toxicity


def test_slopes_are_those_of_the_risk():
    rng = np.random.default_rng(0)
    for shift in (0.0, 4.0):  # the second has a negative estimate for the negatives
        zp, zu = rng.normal(shift, 1, 7), rng.normal(-shift, 1, 9)
        positive, negative, gp, gu = toxicity.corrected_risk(zp, zu, 0.3)
        assert positive == pytest.approx(0.3 * np.mean(np.log1p(np.exp(-zp)))) and negative == pytest.approx(np.mean(np.log1p(np.exp(zu))) - 0.3 * np.mean(np.log1p(np.exp(zp))))
        objective = (lambda p, u: sum(toxicity.corrected_risk(p, u, 0.3)[:2])) if negative >= 0 else (lambda p, u: -toxicity.corrected_risk(p, u, 0.3)[1])
        assert (negative < 0) == (shift > 0)
        for z, g, at in ((zp, gp, lambda d: objective(zp + d, zu)), (zu, gu, lambda d: objective(zp, zu + d))):
            for i in range(len(z)):
                d = np.eye(len(z))[i] * 1e-6
                assert g[i] == pytest.approx((at(d) - at(-d)) / 2e-6, abs=1e-6)


def test_posterior_by_brute_force():
    rng = np.random.default_rng(1)
    zp, zu, prior = rng.normal(1, 1, 12).round(2), rng.normal(0, 1, 20).round(2), 0.2
    at, score = toxicity.posterior(zp, zu, prior)
    z = np.concatenate([zp, zu])
    order = np.argsort(z, kind="stable")
    g, h = np.concatenate([np.full(12, prior / 12), np.zeros(20)])[order], np.concatenate([np.zeros(12), np.full(20, 1 / 20)])[order]
    ratio = lambda a, b: g[a : b + 1].sum() / h[a : b + 1].sum() if h[a : b + 1].sum() > 0 else np.inf
    want = [min(1.0, max(min(ratio(a, b) for b in range(i, 32)) for a in range(i + 1))) for i in range(32)]
    assert (np.diff(at) >= 0).all() and (np.diff(score) >= -1e-12).all()
    strict = [i for i in range(32) if (z[order] == z[order][i]).sum() == 1]
    assert [np.interp(z[order][i], at, score) for i in strict] == pytest.approx([want[i] for i in strict])


def corpus(n, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(300)]
    bad = ["vilea", "vileb", "vilec"]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 60))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                text.insert(rng.randint(0, len(text)), rng.choice(bad))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def learnt(spark):
    rows = corpus(1500)
    docs = spark.createDataFrame([r[:2] for r in rows], TEXT)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if held_out(i) or zlib.crc32(f"label{i}".encode()) % 2], "doc_id bigint, toxic int")
    return rows, docs, labels, toxicity.fit_toxicity_model(docs, labels)


def test_toxicity_on_held_out_rows(learnt):
    rows, docs, labels, model = learnt
    assert {"vilea", "vileb", "vilec"} <= set(model["vocabulary"]) and len(model["vocabulary"]) < 30
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, model).collect()}
    assert len(got) == len(rows) and all(r.held_out == held_out(i) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for i, r in got.items())
    unseen = [(y, got[i].predicted) for i, _, y in rows if held_out(i)]
    assert sum(p for y, p in unseen if y) >= 0.95 * sum(y for y, _ in unseen) and sum(p for y, p in unseen if not y) <= 2


def test_labels_of_held_out_rows_and_of_the_clean_are_not_learnt(spark, learnt):
    rows, docs, labels, model = learnt
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit_toxicity_model(docs.repartition(3), turned.orderBy(F.desc("doc_id")))
    assert again["vocabulary"] == model["vocabulary"] and again["weight"] == pytest.approx(model["weight"]) and again["score"] == pytest.approx(model["score"])


def test_toxicity_of_odd_rows(spark, learnt):
    _, docs, labels, model = learnt
    odd = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "vilea " * 200_000, 5), (4, "VILEA!vileb?vilec", 5), (4, "VILEA!vileb?vilec", 5), (None, "some text", 5)], "doc_id bigint, text string, score int")
    got = toxicity.toxicity_scores(odd, model).collect()
    of = {i: [r for r in got if r.doc_id == i] for i in (1, 2, 3, 4, None)}
    assert of[1][0].score == of[2][0].score < 0.7 and of[4][0].score == of[4][1].score >= 0.7 and of[None][0].held_out is False
    assert toxicity.toxicity_scores(odd.filter("false"), model).count() == 0
    clash = labels.unionByName(labels.withColumn("toxic", F.lit(None).cast("int"))).withColumn("text", F.lit("other")).withColumn("p", F.lit(1))
    again = toxicity.fit_toxicity_model(docs.withColumn("toxic", F.lit(9)).withColumn("words", F.lit("w")).unionByName(docs.withColumn("toxic", F.lit(9)).withColumn("words", F.lit("w"))), clash)
    assert again["vocabulary"] == model["vocabulary"]  # repeated rows and null labels change nothing
    for known in (labels.filter("toxic = 0"), labels.filter("false")):
        flat = toxicity.fit_toxicity_model(docs, known)
        assert len({r.score for r in toxicity.toxicity_scores(docs, flat).collect()}) == 1
    assert toxicity.fit_toxicity_model(docs.filter("false"), labels)["vocabulary"] == {}


def test_bounds_of_the_sample_hold(spark, learnt):
    _, docs, labels, _ = learnt
    sample, prior = toxicity._sampled(docs, labels, "doc_id", "text", "toxic", 20, 50)
    n = sample.agg(F.count_if("toxic").alias("p"), F.count_if("free").alias("u")).first()
    assert n["p"] == 20 and 30 <= n["u"] <= 50 and 0 < prior < 1


def test_words_are_runs_of_letters():
    assert toxicity.words("It's a_b 3x Été IT") == {"it", "s", "a", "b", "x", "été"} and toxicity.words(None) == set()
    assert list(itertools.islice(toxicity.words("..."), 1)) == []
