"""Positive-unlabelled quality scores: parts against plain computations, and held-out labels."""

import random
import zlib

import numpy as np
import pytest

from lakejobs.llm import quality
from lakejobs.llm import queries as llm
from tests.conftest import MEDIUM, SMALL
from tests.llm.test_operators import ROWS, SCHEMA, prose


def rank_auc(scores, truth):
    good, bad = scores[truth == 1], scores[truth == 0]
    return np.mean([(g > bad).mean() + (g == bad).mean() / 2 for g in good])


def test_measures_are_those_of_plain_counting():
    text = "Ab ab ab!\nÉÀ 12 ab　x\n\n!! Ab"
    m = dict(zip(quality.NAMES, quality.measures(text)))
    n = len(text)
    assert m["upper"] == 4 / n and m["!"] == 3 / n and m["digit"] == 2 / n and m["line"] == 3 / n and m["blank"] == 6 / n
    words = text.split()
    assert words == ["Ab", "ab", "ab!", "ÉÀ", "12", "ab", "x", "!!", "Ab"]
    assert m["same as before"] == 0 and m["distinct"] == 7 / 9 and m["most frequent word"] == 2 / 9 and m["words without a letter"] == 2 / 7
    assert m["distinct lines"] == 1 and m["distinct pairs"] == 1 and m["1>0"] == pytest.approx(2 / (n - 1))
    assert quality.measures("a a a a")[quality.NAMES.index("same as before")] == 1
    assert not quality.measures(None).any() and not quality.measures("").any()
    # A whole long text counts, not its beginning.
    long = quality.measures("word " * 20000 + "$" * 100000)
    assert long[quality.NAMES.index("$")] == 0.5


@pytest.mark.parametrize("share", [0.3, 0.6, 0.8])
def test_prior_and_risk(share):
    """Two clouds of measures: the prior is found, and scores are probabilities although no bad row is labelled."""
    rng = np.random.default_rng(4)
    dims = len(quality.NAMES)
    good = lambda n: rng.normal(0.0, 1.0, (n, dims)) * (np.arange(dims) < 4)
    bad = lambda n: rng.normal(2.5, 1.0, (n, dims)) * (np.arange(dims) < 4)
    n = int(3000 * share)
    model = quality.train(good(1500), np.concatenate((good(n), bad(3000 - n))))
    assert abs(model.prior - share) < 0.06
    a, b = model.scores(good(1000)), model.scores(bad(1000))
    assert (a >= 0.5).mean() > 0.95 and (b < 0.5).mean() > 0.95


def test_prior_of_equal_scores_is_defined():
    assert quality.estimate_prior(np.zeros(50), np.zeros(80)) == 0.99
    assert 0.01 <= quality.estimate_prior(np.ones(50), np.zeros(80)) <= 0.05


def corpus(n):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 60).split()
        bad = rng.random() < 0.25
        if bad:
            words = [w + rng.choice(["###", "$$$"]) for w in words]
        rows.append((i, " ".join(words), "en", "s", 0))
        if rng.random() < 0.6:
            labels.append((i, int(not bad), 0))
    return rows, labels


def test_held_out_rows(spark):
    rows, labels = corpus(700)
    docs = spark.createDataFrame(rows + [rows[1]] * 400, SCHEMA)
    known = spark.createDataFrame(labels + [(None, 1, None), (3, None, 0), (10**9, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, known)
    assert abs(model.prior - 0.75) < 0.08
    found = {r.doc_id: (r.score, r.predicted) for r in quality.score(docs, model).collect()}
    held = [(i, y) for i, y, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([found[i][1] == y for i, y in held]) > 0.97
    # Bad labels teach nothing: without them the model is the same.
    positive = quality.fit(docs, known.where("quality = 1"))
    assert np.array_equal(model.weights, positive.weights)


def test_held_out_labels_are_not_used(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, SCHEMA)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, t) for i, y, t in labels]
    first, second = (quality.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped))
    assert np.array_equal(first.weights, second.weights)


def test_query_on_held_out_labels(spark):
    rows = llm.QUERIES["op12_quality"](spark, MEDIUM)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    found = rows.collect()
    assert len(found) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in found)
    held = [(r.score, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    scores, truth = np.array([s for s, _ in held]), np.array([y for _, y in held])
    assert rank_auc(scores, truth) > 0.97 and ((scores >= 0.3) == truth).mean() > 0.94


def test_odd_and_empty_tables(spark):
    odd = spark.createDataFrame(ROWS, SCHEMA).withColumnRenamed("lang", "Score").withColumnRenamed("source", "predicted")
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for docs, known in ((odd, labels), (odd.limit(0), labels), (odd, labels.limit(0)), (odd.limit(0), labels.limit(0))):
        model = quality.fit(docs, known)
        rows = quality.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    again = {}
    for r in quality.score(odd, quality.fit(odd, labels)).collect():
        assert again.setdefault(r.text, r.score) == r.score
    assert quality.score(spark.read.parquet(f"{SMALL}/documents.parquet"), model).columns[-2:] == ["score", "predicted"]
