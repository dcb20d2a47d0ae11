"""Toxicity scores: held-out documents, and the learner against plain loops."""

from __future__ import annotations

import math
import pickle
import re

import numpy as np
import pytest
from cases import TEXTS, documents

from tradelake.llm import toxicity
from tradelake.llm.common import held_out


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet")


@pytest.fixture(scope="module")
def given_labels(spark):
    return spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


@pytest.fixture(scope="module")
def model(given, given_labels):
    return toxicity.fit(given, given_labels)


def toxic_labels(spark, rows=((0, 1), (2, 1), (3, 0), (5, 0), (8, 0), (7, 0), (None, 1), (4, None))):
    return spark.createDataFrame([(d, 0, t) for d, t in rows], "doc_id bigint, quality int, toxic int")


def test_held_out_documents(given, given_labels, model):
    rows = (
        toxicity.score(given.filter(held_out(given["doc_id"])), model)
        .selectExpr("row.doc_id", "row.text", "toxic_score", "predicted")
        .join(given_labels, "doc_id")
        .collect()
    )
    assert len(rows) > 500
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.97
    assert all(0 <= r.toxic_score <= 1 and r.predicted == int(r.toxic_score >= 0.3) for r in rows)
    # Nearly all clean documents are left alone, and the scores are probabilities.
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.005
    assert abs(np.mean([r.toxic_score for r in rows]) - np.mean([r.toxic for r in rows])) < 0.03


def test_weights_are_few_and_travel(model):
    assert 0 < len(model.indices) < 2000
    sent = pickle.dumps(model)
    assert len(sent) < 64 << 10
    texts = ["", "one word", "you are an idiot and a clown"]
    assert (pickle.loads(sent).scores(texts) == model.scores(texts)).all()


def test_learns_nothing_from_held_out_rows(given, given_labels):
    chosen = toxicity.labelled(given, given_labels)
    assert chosen.filter(held_out(chosen["doc_id"])).count() == 0
    few = toxicity.labelled(given, given_labels, 20)
    assert max(r["count"] for r in few.groupBy("toxic").count().collect()) <= 20


def test_scores_equal_plain_loops(model):
    texts = ["", "12 %%", "You IDIOT, you idiot! and a moron", "der Clown; été ñandú " * 40, "a b c d e"]
    table = dict(zip(model.indices.tolist(), model.weights.tolist(), strict=True))
    for text, score in zip(texts, model.scores(texts), strict=True):
        words = re.findall(r"[^\W\d_]+", text.lower())
        wanted = set()
        for i, word in enumerate(words):
            wanted |= set(toxicity.features([word])[1].tolist())
            for reach in (1, 2, 3):
                if i + reach < len(words):
                    own = toxicity.features([" ".join(words[i : i + reach + 1])])[1]
                    # Words come first, then pairs by reach: the last pair is the widest.
                    wanted.add(int(own[-1]))
        raw = model.bias + sum(table.get(f, 0.0) for f in wanted)
        assert math.isclose(score, 1 / (1 + math.exp(-raw)), rel_tol=1e-9)


def test_learner_equals_plain_loops():
    """One coordinate at a time, as FTRL-proximal is written down."""
    rng = np.random.default_rng(5)
    learner = toxicity.Ftrl(6)
    z, n = [0.0] * 6, [0.0] * 6

    def weight(i):
        if abs(z[i]) <= toxicity.LAMBDA_1:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.LAMBDA_2
        return -(z[i] - math.copysign(toxicity.LAMBDA_1, z[i])) / rate

    for _ in range(300):
        at = np.flatnonzero(rng.random(6) < 0.5)
        slope = float(rng.normal(0.4, 1))
        own = learner.weights(at)
        assert np.allclose(own, [weight(i) for i in at])
        learner.step(at, own, slope)
        for i in at:
            w = weight(i)
            sigma = (math.sqrt(n[i] + slope**2) - math.sqrt(n[i])) / toxicity.ALPHA
            z[i] += slope - sigma * w
            n[i] += slope**2
    assert np.allclose(learner.z, z) and np.any(learner.weights(slice(None)) != 0)


def test_features_stay_in_their_text():
    texts = ["ab cd ef", "", "gh", "ij kl"]
    owner, ids = toxicity.features(texts)
    together = sorted(zip(owner.tolist(), ids.tolist(), strict=True))
    alone = sorted((i, f) for i, t in enumerate(texts) for f in toxicity.features([t])[1].tolist())
    assert together == alone
    # Three words, two pairs of neighbours, one pair with a word between.
    assert np.bincount(owner, minlength=4).tolist() == [6, 0, 1, 3]


def test_a_feature_of_one_text_weighs_nothing():
    rows = [("bad thing " + "only here once", 1)] + [("bad thing", 1)] * 30 + [("good thing", 0)] * 30
    model = toxicity.train(rows)
    alone = set(toxicity.features(["only here once"])[1].tolist())
    assert not alone & set(model.indices.tolist())
    assert model.scores(["bad thing"])[0] > 0.9 > 0.1 > model.scores(["good thing"])[0]


def test_odd_documents(spark, model):
    docs = documents(spark)
    for own in (model, toxicity.fit(docs, toxic_labels(spark))):
        rows = toxicity.score(docs, own).collect()
        assert len(rows) == len(TEXTS)
        assert all(0 <= r.toxic_score <= 1 for r in rows)
        kept = toxicity.clean_documents(docs, own)
        assert kept.columns == docs.columns
        assert kept.count() == sum(not r.predicted for r in rows)
    again = toxicity.score(docs.repartition(3), model).collect()
    assert sorted(r.toxic_score for r in again) == sorted(r.toxic_score for r in toxicity.score(docs, model).collect())


def test_without_labels(spark):
    docs = documents(spark)
    one_sided = toxicity.fit(docs, toxic_labels(spark, [(0, 1), (2, 1)]))
    assert not len(one_sided.indices)
    assert len({r.toxic_score for r in toxicity.score(docs, one_sided).collect()}) == 1
    nothing = toxicity.fit(documents(spark, []), toxic_labels(spark, []))
    assert nothing.scores(["x"])[0] == 0.5
    assert toxicity.score(documents(spark, []), nothing).collect() == []
